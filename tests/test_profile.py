import pytest

from replyloom.operators import profile
from replyloom.schemas import TWEETS
from replyloom.vocabulary import DOMAIN_PATTERNS


def message(tid, author, inbound, text, parent=None, at="Tue Oct 31 22:10:47 +0000 2017"):
    return (tid, author, inbound, at, text, None, parent)


@pytest.fixture(scope="module")
def tweets(spark):
    return spark.createDataFrame(
        [
            message(1, "7", True, "@Alpha my wifi é"),
            message(2, "Alpha", False, "Send a DM https://t.co/x", 1),
            message(3, "Beta", False, "hello there", 1, "Wed Nov 01 22:10:47 +0000 2017"),
            message(4, "8", True, "@none @Beta @Alpha hi"),
            message(5, "9", True, "nobody"),
            message(6, "9", True, None, 2),
        ],
        TWEETS,
    )


def test_link_brands(tweets):
    got = {r.tweet_id: (r.brand, r.link) for r in profile.link_brands(tweets).collect()}
    assert got == {1: ("Alpha", "reply"), 4: ("Beta", "mention"), 5: (None, "unmatched"), 6: (None, "unmatched")}


def test_brand_profile(tweets):
    rows = {r.brand: r for r in profile.brand_profile(tweets, min_total=2).collect()}
    alpha = rows["Alpha"]
    assert (alpha.total_tweets, alpha.outbound_tweets, alpha.inbound_tweets, alpha.inbound_first_turn) == (2, 1, 1, 1)
    assert (alpha.unique_customers, alpha.pct_outbound_dm, alpha.pct_outbound_url) == (1, 100.0, 100.0)
    assert alpha.pct_ascii == 50.0 and alpha.escalation_balance_score == 35.0
    assert rows["Beta"].escalation_balance_score == 65.0
    assert profile.brand_profile(tweets).collect() == []
    assert [r.brand for r in profile.brand_profile(tweets, min_total=1, top=1).collect()] == ["Alpha"]


def test_profile_core_and_columns(tweets):
    doubled = tweets.unionByName(tweets.filter("tweet_id = 5"))
    core = profile.profile_core(doubled).first()
    assert (core.total_rows, core.unique_ids, core.duplicate_ids, core.customers, core.brands) == (7, 6, 1, 3, 2)
    assert str(core.last_at) == "2017-11-01 22:10:47"
    columns = {r.column_name: r for r in profile.column_profile(doubled).collect()}
    assert columns["text"].nulls == 1 and columns["text"].null_pct == 14.29 and columns["text"].duplicate_rows == 1
    assert columns["inbound"].data_type == "boolean"


def test_sides_and_starters(tweets):
    sides = {r.side: r.tweets for r in profile.direction_counts(tweets, "Alpha").collect()}
    assert sides == {"brand": 1, "customer": 4, "other": 1}
    assert {r.tweet_id for r in profile.thread_starters(tweets).collect()} == {1, 4, 5}


def test_thread_lengths(spark):
    rows = [(1,)] * 3 + [(2,)] + [(3,)] * 7
    df = spark.createDataFrame(rows, "conversation_id long")
    row = profile.thread_length_stats(df).first()
    assert (row.conversations, row.mean_turns, row.median_turns, row.std_turns) == (3, 3.67, 3.0, 3.06)
    buckets = {r.bucket[0]: r.conversations for r in profile.thread_length_buckets(df).collect()}
    assert buckets == {"1": 1, "2": 0, "3": 1, "4": 0, "5": 1}


def test_domains(spark):
    texts = ["battery", "my wifi and battery", "@user thanks", "nothing here", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "pair_id int, customer_text_normalized string")
    hits = {r.domain: r.hits for r in profile.domain_hits(df).collect()}
    assert hits["Battery & Power"] == 2 and hits["Clarification / Courtesy Follow-up"] == 1
    assert len(hits) == len(DOMAIN_PATTERNS)
    row = profile.domain_coverage(df).first()
    assert (row.total, row.matched, row.unmatched, row.matched_pct) == (5, 2, 3, 40.0)
    assert [r.pair_id for r in profile.unmatched_examples(df, "pair_id", n=2).collect()] == [2, 3]


def test_frequency_and_ngrams(spark):
    df = spark.createDataFrame([("a", "red fish blue fish"), ("a", "red fish"), ("b", "the fish")], "g string, t string")
    assert {r.g: (r.n, r.pct) for r in profile.frequency(df, "g").collect()} == {"a": (2, 66.67), "b": (1, 33.33)}
    rows = [(r.n, r.term, r.occurrences) for r in profile.top_ngrams(df, "t", ["the"], {1: 2, 2: 1}).collect()]
    assert sorted(rows) == [(1, "fish", 4), (1, "red", 2), (2, "red fish", 2)]
