"""SQL functions made from the rules against the operators that use the same rules."""

import pytest
from pyspark.sql import functions as F

from replyloom.operators import rules
from replyloom.plans import sql_functions
from replyloom.vocabulary import Rule

TEXTS = [
    "Why is my battery draining so fast after iOS 11?", "Every time I type letter I it turns into question mark in a box",
    "My screen is cracked", "Calendar keeps freezing and crashing", "", None, "it's a \\ 'quoted' line\n@115854 see https://t.co/x ^HP",
    "I typed @12 café /LS", "searching... now", "DM us, we'd like to reset the settings", "see you in the Apple Store",
]


@pytest.fixture(scope="module")
def texts(spark):
    sql_functions.register(spark, "t_")
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def by_id(df, *columns):
    return sorted(tuple(r) for r in df.select("id", *columns).collect())


def test_scalar_functions_equal_the_operators(spark, texts):
    sql = spark.sql("SELECT id, p.*, intent, kind FROM (SELECT id, t_predict_intent(text) AS p, t_label_intent(text) AS intent, t_response_type(text) AS kind FROM {t})", t=texts)
    predicted = rules.rule_predict(texts, "text")
    assert by_id(sql, "predicted_intent", "confidence", "matched_rule") == by_id(predicted, "predicted_intent", "confidence", "matched_rule")
    assert by_id(sql, "intent") == by_id(rules.label_intent(texts, "text"), "intent")
    typed = rules.signal_flags(texts, "text").withColumn("kind", rules.response_type())
    assert by_id(sql, "kind") == by_id(typed, "kind")


def test_text_functions_equal_the_operators(spark, texts):
    from replyloom.functions import text as X

    sql = spark.sql("SELECT id, t_mask_links(text) a, t_normalize_question(text) b, t_normalize_reply(text) c FROM {t}", t=texts)
    own = texts.select("id", X.mask_links(F.col("text")).alias("a"), X.normalize_question(F.col("text")).alias("b"), X.normalize_reply(F.col("text")).alias("c"))
    assert by_id(sql, "a", "b", "c") == by_id(own, "a", "b", "c")


def test_table_function_keeps_order_and_gives_nothing_for_nothing(spark, texts):
    rows = spark.sql("SELECT * FROM t_predict(array('my battery is dead', null, 'my battery is dead'))").collect()
    assert [r.position for r in rows] == [0, 1, 2] and rows[0][2:] == rows[2][2:] and rows[1].predicted_intent == rules.NO_RULE.label
    assert spark.sql("SELECT * FROM t_predict(array())").collect() == []


def test_other_specifications(spark):
    own = Rule("it's", r"\bpay\\?'?day\b", "r", 0.25)
    sql_functions.register(spark, "o_", rules=[own])
    found = spark.sql("SELECT p.* FROM (SELECT o_predict_intent('PAY\\\\day soon') AS p)").first()
    assert tuple(found) == ("it's", 0.25, "r")


def test_no_python_in_the_plan(spark, texts):
    plan = spark.sql("SELECT t_predict_intent(text) FROM {t}", t=texts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
