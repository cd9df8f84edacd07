"""Text functions against Python's own regular expressions."""

import re

import pytest
from pyspark.sql import functions as F

from replyloom import vocabulary as V
from replyloom.functions import text as X
from replyloom.functions.dialect import unicode_regex
from replyloom.sources.messages import from_turns

TEXTS = [
    "plain text",
    "  two   blanks and\na line  ",
    "@115854 hello @115854, and @115854_x and @7é",
    " wide　space\x1c",
    "see https://example.org/a?b=c and T.CO/abc",
    "thanks ^HP",
    "thanks /LS ",
    "this and/or",
    "ok^AB x",
    "@a https://x",
    "?",
    "",
    None,
    "Type I️ turns into a ? box",
    "searching... now",
    "searching...x",
    "turns off at 20%",
    "turn off at 20%x",
    "Können wir über iOS 11.0.3 reden? WLAN wi-fi",
    "don't can't the battery_life drained 123abc abc123 é abcé",
    "[URL] and [url] @user_name t.co/x",
    "ＷＩＦＩ ſettings Kelvin",
    "laǵ lagé xlag lag",
    "😀lag😀 mic📱 id",
]


def apply(spark, column, texts=TEXTS):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", column.alias("o"))
    return [r.o for r in rows.orderBy("i").collect()]


def normalize(t, reply=False):
    if t is None:
        return ""
    t = re.sub(r"\s+", " ", t).strip()
    t = re.sub(X.NUMERIC_HANDLE, "@user", t)
    return re.sub(X.AGENT_SIGNATURE, "", t).strip() if reply else t


@pytest.mark.parametrize(
    "make, expected",
    [
        (X.normalize_question, normalize),
        (X.normalize_reply, lambda t: normalize(t, True)),
        (X.mask_links, lambda t: re.sub(X.LINK, "[URL]", t or "", flags=re.I)),
        (X.substantive, lambda t: re.sub(X.MENTION_OR_LINK, "", t or "").strip()),
        (
            X.modelling_text,
            lambda t: re.sub(r"\s+", " ", re.sub(X.MENTION_LINK_OR_TOKEN, " ", (t or "").lower())).strip(),
        ),
        (X.ascii_words, lambda t: re.findall(r"\b[a-z]{3,}\b", (t or "").lower())),
        (X.model_words, lambda t: re.findall(r"\b\w\w+\b", (t or "").lower())),
        (
            lambda t: X.ascii_words(t, ["the", "and"]),
            lambda t: [w for w in re.findall(r"\b[a-z]{3,}\b", (t or "").lower()) if w not in ("the", "and")],
        ),
    ],
)
def test_text_functions_match_python(spark, make, expected):
    got = apply(spark, make(F.col("t")))
    assert got == [expected(t) for t in TEXTS]


@pytest.mark.parametrize("pattern", [*V.INTENT_PATTERNS.values(), *[r.pattern for r in V.INTENT_RULES], *V.DOMAIN_PATTERNS.values()])
def test_patterns_match_python(spark, pattern):
    words = sorted(set(re.findall(r"[a-z0-9]+", pattern)))
    texts = [t for t in TEXTS if t] + [f"my {w} now" for w in words] + [f"x{w}y {w}é {w}_" for w in words]
    texts = [t.lower() for t in texts]
    got = apply(spark, F.col("t").rlike(unicode_regex(pattern)), texts)
    assert got == [bool(re.search(pattern, t)) for t in texts]


@pytest.mark.parametrize("pattern", [*V.REPLY_SIGNALS.values(), X.SIGNATURE_CARET, X.SIGNATURE_SLASH])
def test_signals_match_python(spark, pattern):
    texts = [t for t in TEXTS if t] + ["Send a DM", "dm.", "admin", "iOS 11", "Turn Off", "re-pair", "^HP.", "/LSx", "x/LS ok"]
    ignore = pattern in V.REPLY_SIGNALS.values()
    got = apply(spark, F.col("t").rlike(unicode_regex(pattern, ignore)), texts)
    assert got == [bool(re.search(pattern, t, re.I if ignore else 0)) for t in texts]


def test_ngrams(spark):
    words = F.split("t", " ")
    df = spark.createDataFrame([("a b c d",), ("a",), ("a b",)], "t string").select(words.alias("w"))
    out = df.select(*[X.ngrams(F.col("w"), n).alias(f"n{n}") for n in (1, 2, 3)]).collect()
    assert out[0].n2 == ["a b", "b c", "c d"] and out[0].n3 == ["a b c", "b c d"]
    assert out[1].n2 == [] and out[1].n3 == [] and out[1].n1 == ["a"]
    assert out[2].n2 == ["a b"] and out[2].n3 == []


def test_child_ids(spark):
    texts = ["119249, 119251,x", "", None, " 7 ", "1,,2", "99999999999999999999", "-3,4"]
    assert apply(spark, X.child_ids(F.col("t")), texts) == [[119249, 119251], [], [], [7], [1, 2], [], [4]]


def test_created_at(spark):
    texts = [
        "Tue Oct 31 22:10:47 +0000 2017",
        "Wed Feb 30 00:00:00 +0000 2017",
        "Tue Oct 31 22:10:47 +0100 2017",
        "Tue Foo 31 22:10:47 +0000 2017",
        "Tue anF 31 22:10:47 +0000 2017",
        "junk",
        None,
        "Fri Mar 4 20:44:00 +0000 2016",
    ]
    got = apply(spark, X.parse_created_at(F.col("t")).cast("string"), texts)
    assert got == ["2017-10-31 22:10:47", None, None, None, None, None, None, "2016-03-04 20:44:00"]


def test_seconds_between_and_ascii(spark):
    row = (
        spark.createDataFrame([("Tue Oct 31 22:10:47 +0000 2017", "Tue Oct 31 22:11:50 +0000 2017", "abc é", "a\nb")], "a string, b string, c string, d string")
        .select(
            X.seconds_between(X.parse_created_at(F.col("b")), X.parse_created_at(F.col("a"))).alias("d"),
            X.seconds_between(X.parse_created_at(F.col("c")), X.parse_created_at(F.col("a"))).alias("n"),
            X.is_ascii(F.col("c")).alias("c"),
            X.is_ascii(F.col("d")).alias("e"),
        )
        .first()
    )
    assert (row.d, row.n, row.c, row.e) == (63, None, False, True)


def test_stop_lists(spark):
    english = set(V.english_stop_words())
    for words, noise in (
        (V.profile_stop_words(), V.PROFILE_NOISE), (V.cluster_stop_words(), V.CLUSTER_NOISE), (V.topic_stop_words(), V.TOPIC_NOISE)
    ):
        assert set(words) == english | set(noise)
    assert {"apple", "hello"} <= set(V.PROFILE_NOISE) and {"user", "url"} <= set(V.CLUSTER_NOISE) and "today" in V.TOPIC_NOISE


def test_times_do_not_depend_on_the_session_zone(spark):
    gap = [("Sun Mar 12 01:59:59 +0000 2017", "Sun Mar 12 02:30:10 +0000 2017")]
    df = spark.createDataFrame(gap, "a string, b string")
    turns = spark.createDataFrame([(c, t, "user", "x") for c in range(300) for t in range(3)], "conv_id long, turn long, role string, text string")
    seen = set()
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            a, b = X.parse_created_at(F.col("a")), X.parse_created_at(F.col("b"))
            row = df.select(X.seconds_between(b, a).alias("s"), X.micros_since_epoch(b).alias("u"), F.hour(b).alias("h")).first()
            dates = tuple(sorted(r.created_at for r in from_turns(turns).select("created_at").collect()))
            seen.add((row.s, row.u, row.h, dates))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1
    seconds, micros, hour, _ = seen.pop()
    assert (seconds, micros, hour) == (1811, 1489285810000000, 2)
