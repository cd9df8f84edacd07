import re

import pytest

from replyloom import vocabulary as V
from replyloom.operators import rules
from replyloom.sources.files import confusable_pairs, taxonomy_rows

# Questions with a known intent.
KNOWN = {
    "Why is my battery draining so fast?": "battery_power",
    "The autocorrect changes everything I type": "keyboard_typing",
    "My Wi-Fi keeps disconnecting": "connectivity_network",
    "Why is my battery draining so fast after iOS 11?": "battery_power",
    "Every time I type letter I it turns into question mark in a box": "keyboard_typing",
    "Can't remember my Apple ID password to download apps": "account_billing",
    "My screen is cracked and unresponsive": "hardware_audio_display",
    "Bluetooth won't pair with my car": "connectivity_network",
    "Calendar keeps freezing and crashing": "performance_system",
    "When will the new update be available?": "software_update",
    "Thank you so much for your help!": "general_inquiry_other",
    "This is a completely generic sentence.": "general_inquiry_other",
}


def python_rule(text):
    for rule in V.INTENT_RULES:
        if re.search(rule.pattern, text.lower()):
            return rule.label, rule.confidence, rule.name
    return V.NO_RULE.label, V.NO_RULE.confidence, V.NO_RULE.name


def test_known_questions(spark):
    df = spark.createDataFrame([(q,) for q in KNOWN], "customer_text string")
    got = {r.customer_text: r for r in rules.rule_predict(df).collect()}
    for question, intent in KNOWN.items():
        row = got[question]
        assert row.predicted_intent == intent
        assert (row.predicted_intent, row.confidence, row.matched_rule) == python_rule(question)


def test_null_text_falls_back(spark):
    df = spark.createDataFrame([(None,), ("",)], "customer_text string")
    assert {r.matched_rule for r in rules.rule_predict(df).collect()} == {"fallback_no_match"}
    labelled = rules.label_intent(df, "customer_text")
    assert {r.intent for r in labelled.collect()} == {V.FALLBACK}


def test_label_order(spark):
    texts = ["battery and keyboard", "charge on my card", "charged twice", "update my battery", "glitchy update", "nothing"]
    df = spark.createDataFrame([(t,) for t in texts], "customer_text_normalized string")
    got = {r[0]: r.intent for r in rules.label_intent(df).collect()}
    for text in texts:
        expected = next((k for k, p in V.INTENT_PATTERNS.items() if re.search(p, text)), V.FALLBACK)
        assert got[text] == expected


@pytest.mark.parametrize(
    "url, dm, store, trouble, expected",
    [
        (False, True, False, True, 0),
        (True, False, True, True, 0),
        (True, False, False, True, 1),
        (True, True, False, False, 2),
        (False, False, True, False, 2),
        (True, False, False, False, 3),
        (False, False, False, False, 4),
    ],
)
def test_response_type(spark, url, dm, store, trouble, expected):
    df = spark.createDataFrame([(url, dm, store, trouble)], ", ".join(f"{n} boolean" for n in V.REPLY_SIGNALS))
    row = df.select(rules.response_type().alias("t"), rules.response_type(V.PROFILE_RESPONSE_TYPES).alias("p")).first()
    assert (row.t, row.p) == (V.RESPONSE_TYPES[expected], V.PROFILE_RESPONSE_TYPES[expected])


def test_majority(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "intent string")
    test = spark.createDataFrame([("x",), ("y",)], "intent string")
    assert [r.predicted_intent for r in rules.majority_predict(test, train).collect()] == ["a", "a"]
    assert [r.predicted_intent for r in rules.majority_predict(test).collect()] == [V.FALLBACK] * 2
    assert rules.majority_predict(test.limit(0)).collect() == []


def test_taxonomy_is_closed(spark):
    rows = taxonomy_rows(spark, V.TAXONOMY)
    assert sorted(r.intent for r in rows.collect()) == sorted(V.INTENTS)
    assert {r.confusable_with for r in confusable_pairs(rows).collect()} <= set(V.INTENTS)
    assert V.FALLBACK in V.INTENTS
