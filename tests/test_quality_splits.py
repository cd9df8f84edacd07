import hashlib

import pytest
from pyspark.sql import functions as F

from replyloom.operators import pairs, quality, splits
from replyloom.schemas import SUPPORT_PAIRS, expectations, require


def pair(spark, *rows):
    """rows: (pair_id, conversation, customer tweet, customer text, response text, delay)."""
    data = [
        (i, conv, cust, i, "1", q, r, q, r, "t", "t", delay, False, False, False, False, 2)
        for i, conv, cust, q, r, delay in rows
    ]
    return spark.createDataFrame(data, SUPPORT_PAIRS)


def test_quality_cascade_order(spark):
    df = pair(
        spark,
        (1, 1, 1, None, "fine", 5),
        (2, 1, 2, "  ", "fine", 5),
        (3, 1, 3, "@1 https://x", "fine", 5),
        (4, 1, 4, "?", "fine", 5),
        (5, 1, 5, "question", " ", 5),
        (6, 1, 6, "question", "fine", -1),
        (7, 1, 7, "question", "fine", None),
        (8, 1, 8, "@5 ok", "fine", 5),
        (9, 1, 9, "?", "", 5),
        (10, 1, 10, "question", "", 5),
        (11, 1, 10, "question", "fine", 5),
        (12, 1, 12, "yes", "fine", 0),
    )
    got = {r.pair_id: r.quality_reason for r in quality.quality_flags(df).collect()}
    assert got == {
        1: "empty_customer_text", 2: "empty_customer_text", 3: "url_or_mention_only_customer",
        4: "ultra_short_customer_message", 5: "empty_response_text", 6: "impossible_chronology", 7: "valid",
        8: "ultra_short_customer_message", 9: "ultra_short_customer_message", 10: "empty_response_text",
        11: "duplicate_customer_turn", 12: "valid",
    }
    assert quality.keep_clean(quality.quality_flags(df)).count() == 2


def test_hot_question_marks_all_but_the_first(spark):
    df = pair(spark, *[(i, 1, 77 if i % 3 else i, "question", "fine", 1) for i in range(1, 301)])
    later = quality.mark_duplicates(df, ["customer_tweet_id"], "pair_id").filter("is_duplicate")
    assert later.count() == 199 and later.agg(F.min("pair_id")).first()[0] == 2
    every = quality.mark_duplicates(df, ["customer_tweet_id"], "pair_id", keep_first=False).filter("is_duplicate")
    assert every.count() == 200


def test_pair_audit(spark):
    df = pair(spark, (1, 1, 1, "q text", "reply text", -1), (2, 1, 1, "x", "abc", 1), (3, 1, 3, "@1", "https://x", None))
    row = quality.pair_audit(df).first().asDict()
    assert row == {
        "total_pairs": 3, "broken_references": 0, "negative_delays": 1, "duplicate_pairs": 0,
        "repeated_customer_turns": 1, "rows_of_repeated_turns": 2, "empty_customer": 1, "ultra_short_customer": 1,
        "empty_response": 1, "ultra_short_response": 1,
    }


def test_text_preserved_counts_changes(spark):
    raw = pair(spark, (1, 1, 1, "a", "b", 1), (2, 1, 2, None, "b", 1))
    clean = pair(spark, (1, 1, 1, "a", "B", 1), (2, 1, 2, None, "b", 1))
    row = pairs.text_preserved(raw, clean).first()
    assert (row.compared, row.changed) == (2, 1)


def position(conv, seed=42):
    return hashlib.md5(f"{seed}:{conv}".encode()).hexdigest(), conv


@pytest.mark.parametrize("n", [0, 1, 7, 40, 333])
def test_split_sizes_and_membership(spark, n):
    convs = list(range(1, n + 1))
    golden = [c for c in (3, 5, 8, 900) if c in convs or c == 900]
    clean = spark.createDataFrame([(c,) for c in convs for _ in range(1 + c % 3)], "conversation_id bigint")
    gold = spark.createDataFrame([(c,) for c in golden], "conversation_id bigint")
    fitted = splits.fit_conversation_split(clean, gold)
    got = {r.conversation_id: r.split for r in splits.assign_split(clean, gold, fitted).distinct().collect()}
    free = sorted((c for c in convs if c not in golden), key=position)
    n_train, n_validation = round(0.70 * n), round(0.15 * n)
    expected = {c: "test" for c in convs}
    expected |= {c: "train" for c in free[:n_train]}
    expected |= {c: "validation" for c in free[n_train : n_train + n_validation]}
    assert got == expected


def test_split_when_golden_exceed_the_test_share(spark):
    clean = spark.createDataFrame([(c,) for c in range(10)], "conversation_id bigint")
    gold = clean.filter("conversation_id < 8")
    fitted = splits.fit_conversation_split(clean, gold)
    got = [r.split for r in splits.assign_split(clean, gold, fitted).collect()]
    assert got.count("train") == 2 and got.count("test") == 8


def test_sample_is_exact_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "pair_id")
    one = [r.pair_id for r in splits.seeded_sample(df, "pair_id", 25).collect()]
    two = [r.pair_id for r in splits.seeded_sample(df.repartition(7), "pair_id", 25).collect()]
    assert one == two == sorted(range(1000), key=position)[:25]
    assert splits.seeded_sample(df, "pair_id", 5000).count() == 1000


def test_leakage_and_missing(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "conversation_id bigint")

    rows = splits.leakage({"a": ids(1, 2, 2, 3), "b": ids(2, 3, 4), "c": ids(9)}).collect()
    assert {(r.left_set, r.right_set): r.shared for r in rows} == {("a", "b"): 2, ("a", "c"): 0, ("b", "c"): 0}
    assert [r[0] for r in splits.missing_keys(ids(1, 1, 2), ids(2)).collect()] == [1]


def test_expectations(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y")], "t string, intent string")
    checks = dict(required=["t", "u"], not_null=["t", "u"], domains={"intent": ["x"]}, row_count=2)
    got = {r.check_name: r.violations for r in expectations(df, **checks).collect()}
    assert got == {"column:t": 0, "column:u": 1, "not_null:t": 1, "domain:intent": 1, "row_count": 0}
    with pytest.raises(ValueError, match="not_null:t: 1"):
        require(df, **checks)
    assert require(df, required=["t"]) is df
