"""Rules and text functions as SQL functions, generated from the same specifications that the operators take.

``register`` makes them known to a session. They are SQL expressions, so Spark inlines them into the calling plan: filters
are pushed through them and no Python runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from replyloom.functions.dialect import BLANKS, unicode_regex
from replyloom.functions.text import AGENT_SIGNATURE, LINK, NUMERIC_HANDLE
from replyloom.vocabulary import FALLBACK, INTENT_PATTERNS, INTENT_RULES, NO_RULE, REPLY_SIGNALS, RESPONSE_TYPES, Rule

PREDICTION = "predicted_intent STRING, confidence DOUBLE, matched_rule STRING"


def literal(text: str) -> str:
    """A SQL string with backslashes and quotes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(value: str, pattern: str, ignore_case: bool = False) -> str:
    return f"regexp_like({value}, {literal(unicode_regex(pattern, ignore_case))})"


def _prediction(rule: Rule) -> str:
    return (
        f"named_struct('predicted_intent', {literal(rule.label)}, 'confidence', {float(rule.confidence)!r}D, "
        f"'matched_rule', {literal(rule.name)})"
    )


def statements(
    prefix: str = "",
    rules: Sequence[Rule] = INTENT_RULES,
    no_rule: Rule = NO_RULE,
    patterns: Mapping[str, str] = INTENT_PATTERNS,
    fallback: str = FALLBACK,
    signals: Mapping[str, str] = REPLY_SIGNALS,
    response_types: Sequence[str] = RESPONSE_TYPES,
) -> dict[str, str]:
    """The CREATE statement of every function by name, in the order in which they build on each other."""
    link, handle, signature = (literal(unicode_regex(p, i)) for p, i in ((LINK, True), (NUMERIC_HANDLE, False), (AGENT_SIGNATURE, False)))
    spaces = literal(unicode_regex(r"\s+"))
    first_rule = " ".join(f"WHEN {_matches('lowered', r.pattern)} THEN {_prediction(r)}" for r in rules)
    first_label = " ".join(f"WHEN {_matches('lowered', p)} THEN {literal(label)}" for label, p in patterns.items())
    lowered = "lower(coalesce(text, ''))"
    flags = ", ".join(f"'{name}', {_matches('coalesce(text, ' + repr('') + ')', p, True)}" for name, p in signals.items())
    url, dm, store, helps = signals
    both, trouble, handover, article, other = map(literal, response_types)
    kind = f"STRUCT<{', '.join(c.replace(' ', ': ', 1) for c in PREDICTION.split(', '))}>"
    flag_kind = f"STRUCT<{', '.join(f'{name}: BOOLEAN' for name in signals)}>"
    body = {
        "rule_of_lowered": f"(lowered STRING) RETURNS {kind} RETURN CASE {first_rule} ELSE {_prediction(no_rule)} END",
        "predict_intent": f"(text STRING) RETURNS {kind} RETURN {prefix}rule_of_lowered({lowered})",
        "predict": f"(texts ARRAY<STRING>) RETURNS TABLE (position INT, text STRING, {PREDICTION}) RETURN "
        f"SELECT position, text, p.predicted_intent, p.confidence, p.matched_rule FROM "
        f"(SELECT position, text, {prefix}predict_intent(text) AS p FROM (SELECT posexplode(texts) AS (position, text)))",
        "label_of_lowered": f"(lowered STRING) RETURNS STRING RETURN CASE {first_label} ELSE {literal(fallback)} END",
        "label_intent": f"(text STRING) RETURNS STRING RETURN {prefix}label_of_lowered({lowered})",
        "reply_signals": f"(text STRING) RETURNS {flag_kind} RETURN named_struct({flags})",
        "type_of_signals": f"(s {flag_kind}) RETURNS STRING RETURN CASE WHEN s.{helps} AND (s.{dm} OR s.{store}) THEN {both} "
        f"WHEN s.{helps} THEN {trouble} WHEN s.{dm} OR s.{store} THEN {handover} WHEN s.{url} THEN {article} ELSE {other} END",
        "response_type": f"(text STRING) RETURNS STRING RETURN {prefix}type_of_signals({prefix}reply_signals(text))",
        "mask_links": f"(text STRING) RETURNS STRING RETURN regexp_replace(coalesce(text, ''), {link}, '[URL]')",
        "normalize_question": f"(text STRING) RETURNS STRING RETURN "
        f"regexp_replace(trim(regexp_replace(coalesce(text, ''), {spaces}, ' ')), {handle}, '@user')",
        "normalize_reply": f"(text STRING) RETURNS STRING RETURN "
        f"btrim(regexp_replace({prefix}normalize_question(text), {signature}, ''), {literal(BLANKS)})",
    }
    return {prefix + name: f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{rest}" for name, rest in body.items()}


def register(spark: SparkSession, prefix: str = "", **specifications) -> list[str]:
    """Create the functions in the session; returns their names. ``specifications`` replace the library's rules and patterns.

    Scalar: ``predict_intent`` (a struct), ``label_intent``, ``reply_signals`` (a struct of flags), ``response_type``, ``mask_links``,
    ``normalize_question``, ``normalize_reply``. Table function: ``predict(texts)``, one row per text of the array in order. Null texts count as empty ones.
    """
    made = statements(prefix, **specifications)
    for statement in made.values():
        spark.sql(statement)
    return list(made)
