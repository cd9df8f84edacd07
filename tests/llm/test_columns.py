"""Operators that return whole documents keep columns of any name."""

import pytest

from replyloom.llm import jaccard, langid, mixing, secrets, token_counts
from replyloom.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
OPERATORS = {
    "known_languages": lambda df: langid.known_languages(df, langid.fit(df.select("doc_id", "text", "lang"))),
    "predict": lambda df: langid.predict(df, None).drop("lang_pred", "score", "cross_entropy", "rejected"),
    "one_per_group": jaccard.one_per_group,
    "redact": secrets.redact,
    "mixed_documents": lambda df: mixing.mixed_documents(df, share=1.0),
    "token_counts": lambda df: token_counts.token_counts(df, PATH, output="n"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_dots_and_blanks_in_names(spark, name):
    rows = [(i, f"some words of text number {i} secret=abcdefgh{i}", "en", "s", 3, f"d{i}", f"q{i}") for i in range(4)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, `a.b` STRING, `c d.e` STRING"
    df = spark.createDataFrame(rows, schema)
    out = OPERATORS[name](df)
    kept = [c for c in df.columns if c in out.columns]
    assert kept == [c for c in df.columns if name != "token_counts" or c != "text"]
    found = sorted((r["doc_id"], r["a.b"], r["c d.e"]) for r in out.collect())
    assert found and set(found) <= {(r[0], r[5], r[6]) for r in rows}


def test_ledger_is_used_again(spark, make):
    """A second run scans only what is new, and replaces what the first run found."""
    texts = ["token=abcdefgh1", "clean", "token=zyxwvut9"]
    rows = [(i, t, "en", "s", len(t), *"abcd") for i, t in enumerate(texts)]
    ledger = secrets.update_ledger(secrets.addressed(make(rows[:2])), None, secrets.REDACTED)
    # A finding that no scan gives shows that the ledger's row was taken.
    marked = ledger.selectExpr("sha", "rule_version", "IF(size(spans) > 0, transform(spans, s -> named_struct('start', s.start + 6, 'rule', s.rule, 'end', s.`end`)), spans) AS spans")
    found = {r.doc_id: r.text for r in secrets.redact(make(rows), ledger=marked).collect()}
    assert found == {0: "token=[assign]", 1: "clean", 2: "[assign]"}
    # Findings of other rules are not taken.
    other = secrets.update_ledger(secrets.addressed(make(rows[:2])), None, secrets.RULES)
    assert {r.text for r in secrets.redact(make(rows), ledger=other).collect()} == {"[assign]", "clean"}
    assert secrets.rules_version(secrets.RULES) != secrets.rules_version(secrets.REDACTED)
