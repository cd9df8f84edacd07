import random

import pytest
from pyspark.sql import functions as F

from replyloom.operators import pairs, threads
from replyloom.schemas import TWEETS
from replyloom.plans.queries import QUERIES
from replyloom.sources.messages import messages


def tweets(spark, rows):
    """rows: id -> (parent, children) or a full tuple."""
    data = []
    for tid, (parent, children, *rest) in rows.items():
        author, inbound, at, text = rest or ("1", True, "Tue Oct 31 22:10:47 +0000 2017", "t")
        data.append((tid, author, inbound, at, text, children, parent))
    return spark.createDataFrame(data, TWEETS)


def walk(rows):
    """The plain definition: follow parents inside the set until none is left or one repeats."""
    up = {t: p for t, (p, *_) in rows.items() if p in rows}
    out = {}
    for t in rows:
        seen, at = set(), t
        while at in up and at not in seen:
            seen.add(at)
            at = up[at]
        out[t] = at
    return out


CASES = {
    "branch": {1: (None, None), 2: (1, None), 3: (1, None), 4: (2, None)},
    "missing parent": {5: (99, None), 6: (5, None)},
    "two cycle with tail": {1: (2, None), 2: (1, None), 3: (2, None), 4: (3, None), 9: (None, None)},
    "three cycle with tails": {1: (2, None), 2: (3, None), 3: (1, None), 4: (3, None), 5: (4, None), 6: (1, None)},
    "self": {1: (1, None), 2: (1, None)},
    "chain of 300": {i: (i - 1 if i else None, None) for i in range(300)},
    "long tail into a cycle": {**{i: (i - 1, None) for i in range(2, 40)}, 1: (2, None)},
}


@pytest.mark.parametrize("name", CASES)
def test_roots(spark, name):
    rows = CASES[name]
    got = {r.tweet_id: r.conversation_id for r in threads.thread_roots(tweets(spark, rows)).collect()}
    assert got == walk(rows)


def test_roots_of_random_graphs(spark):
    rng = random.Random(7)
    for n in (30, 60):
        rows = {i: (rng.choice([None, *range(n + 3)]), None) for i in range(n)}
        got = {r.tweet_id: r.conversation_id for r in threads.thread_roots(tweets(spark, rows)).collect()}
        assert got == walk(rows)


def test_neighbourhood_follows_declared_pointers_only(spark):
    rows = {
        1: (None, "2"),
        2: (1, "3, x,77"),
        3: (2, None),
        4: (3, None),  # points at 3, but 3 does not list it
        5: (None, "2"),  # lists 2, but nothing points at 5
    }
    got = {r.tweet_id: r.hop for r in threads.neighbourhood(tweets(spark, rows), F.col("tweet_id") == 2).collect()}
    assert got == {2: 0, 1: 1, 3: 1, 77: 1}


def test_neighbourhood_stops_after_hops(spark):
    rows = {i: (i - 1 if i else None, None) for i in range(10)}
    frame = tweets(spark, rows)
    for hops in (1, 2, 3, 4):
        got = {r.tweet_id for r in threads.neighbourhood(frame, F.col("tweet_id") == 8, hops).collect()}
        assert got == set(range(8 - hops, 9))


def dated(i, minute):
    return f"Tue Oct 31 22:{minute:02d}:00 +0000 2017"


def conversation_rows(n):
    return {
        i: (i - 1 if i else None, None, "Brand" if i % 2 else "7", i % 2 == 0, dated(i, (i * 7) % 60), f"turn {i}")
        for i in range(n)
    }


def test_records_split_long_threads(spark):
    frame = tweets(spark, {**conversation_rows(23), 100: (None, None, "8", True, "junk", "alone")})
    threaded = threads.thread_length(frame.join(threads.thread_roots(frame), "tweet_id"))
    whole = threads.conversation_records(threaded).collect()
    assert sorted(len(r.tweets) for r in whole) == [1, 23]
    full = next(r for r in whole if r.conversation_id == 0)
    assert [t.created_at for t in full.tweets] == sorted(t.created_at for t in full.tweets)
    cut = threads.conversation_records(threaded, turns_per_record=5, slice_rows=4)
    parts = sorted((r for r in cut.collect() if r.conversation_id == 0), key=lambda r: r.part)
    assert [len(r.tweets) for r in parts] == [5, 5, 5, 5, 3]
    assert [t.tweet_id for r in parts for t in r.tweets] == [t.tweet_id for t in full.tweets]
    assert {r.conversation_length for r in parts} == {23} and [r.first_position for r in parts] == [0, 5, 10, 15, 20]
    flat = [sorted(map(str, threads.flatten_records(threads.conversation_records(threaded, n)).drop("part").collect())) for n in (2, 5, 100)]
    assert flat[0] == flat[1] == flat[2]
    places = threads.flatten_records(cut).filter("conversation_id = 0").select("position").collect()
    assert sorted(r.position for r in places) == list(range(23))


def test_first_of_repeated_ids_is_the_earliest(spark):
    rows = {1: (None, None, "7", True, dated(1, 30), "ask"), 2: (1, None, "Brand", False, dated(1, 40), "late")}
    frame = tweets(spark, rows)
    early = frame.filter("tweet_id = 2").withColumn("created_at", F.lit("Wed Nov 01 01:00:00 +0000 2017"))
    same = frame.filter("tweet_id = 2").withColumn("in_response_to_tweet_id", F.lit(None).cast("bigint"))
    got = threads.extract_brand(frame.unionByName(early).unionByName(same), "Brand").collect()
    assert sorted((r.tweet_id, r.created_at[:3], r.in_response_to_tweet_id) for r in got) == [(2, "Tue", None)] or [
        (r.tweet_id, r.created_at[:3]) for r in sorted(got, key=lambda r: r.tweet_id)
    ] == [(1, "Tue"), (2, "Tue")]


def test_record_audit(spark):
    lines = ['{"conversation_id":1,"tweets":[{"tweet_id":1},{"tweet_id":2}]}', '{"tweets":[]}', '{"conversation_id":3}']
    row = threads.audit_records(spark.createDataFrame([(line,) for line in lines], "value string")).first()
    assert (row.conversations, row.total_turns, row.missing_keys) == (3, 2, 2)


def test_pairs_only_join_inbound_questions(spark):
    rows = {
        1: (None, None, "7", True, dated(1, 1), "question"),
        2: (1, None, "Brand", False, dated(2, 3), "please restart"),
        3: (1, None, "Other", False, dated(3, 4), "not ours"),
        4: (2, None, "Brand", False, dated(4, 5), "to itself"),
        5: (99, None, "Brand", False, dated(5, 6), "to nobody"),
        6: (1, None, "Brand", False, "junk", "undated"),
    }
    got = {r.pair_id: r for r in pairs.support_pairs(tweets(spark, rows), "Brand").collect()}
    assert set(got) == {2, 6}
    assert got[2].turn_delay_seconds == 120 and got[6].turn_delay_seconds is None
    assert got[2].response_has_troubleshooting and not got[6].response_has_troubleshooting
    numbered = pairs.number_pairs(pairs.support_pairs(tweets(spark, rows), "Brand"), slice_rows=1)
    assert sorted((r.pair_id, r.response_tweet_id) for r in numbered.collect()) == [(1, 2), (2, 6)]


def test_record_problems_are_told_apart(spark):
    lines = [
        '{"id": 1, "tweets": [{"text": "a"}]}', '{"id": 2, "tweets": []}', '{"id": null, "tweets": [{"text": null}]}', '{"tweets": {"text": "a"}}',
        '{"id": "7", "tweets": [{"text": 5}], "more": true}', '{"id": 1, "tweets": [', "", None, "[1]", '{"id": 3000000000000, "tweets": null}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    required = {"id": "BIGINT", "tweets": "ARRAY", "tweets[0].text": "STRING"}
    found = {(r.field, r.problem): r.lines for r in threads.record_problems(df, required).collect()}
    assert found == {
        (None, "malformed"): 3, ("id", "missing"): 2, ("id", "null"): 1, ("id", "wrong type"): 1,
        ("tweets", "missing"): 1, ("tweets", "null"): 1, ("tweets", "wrong type"): 1,
        ("tweets[0].text", "missing"): 4, ("tweets[0].text", "null"): 1, ("tweets[0].text", "wrong type"): 1,
    }
    assert {r.lines for r in threads.record_problems(df.limit(0), required).collect()} == {0}
    schema = threads.record_schema(df.filter("value LIKE '%tweets\": [{%'")).first().schema
    assert schema.startswith("OBJECT<") and "more: BOOLEAN" in schema


def test_a_first_turn_without_text_is_no_defect_of_its_record(spark, tmp_path):
    """The first turn of conversation 318 has no text; the query retypes, renames, empties or cuts none of its lines."""
    turns = [(318, 0, "user", "hello"), (318, 1, "assistant", "hi there")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.text for r in messages(spark, str(tmp_path)).filter("inbound").collect()] == [None]
    problems = QUERIES["record_problems"](spark, str(tmp_path)).collect()
    assert len(problems) == 13 and all(r.lines == 0 for r in problems)


def test_rounds_leave_nothing_inferred_behind(spark):
    """Rounds go on from tables: what a checkpoint keeps of its plan doubled the planning time of every round of a long chain."""
    chain = spark.range(20).selectExpr("id AS tweet_id", "nullif(id - 1, -1) AS in_response_to_tweet_id")
    roots = threads.thread_roots(chain)
    assert {tuple(r) for r in roots.collect()} == {(i, 0) for i in range(20)}
    assert "ExistingRDD" not in roots._jdf.queryExecution().toString()
