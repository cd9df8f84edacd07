"""Language models: probabilities, held-out accuracy, odd texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyloom.llm import langid
from replyloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.fit(documents.filter(langid.training_fold(F.col("doc_id"))).select("doc_id", "text", "lang"))


def plain_probability(parts, context, symbol):
    """Interpolated Kneser-Ney by dictionaries, for one language."""

    def counts(n):
        if n == langid.ORDER:
            grams = {}
            for s in parts:
                for i in range(len(s) - n + 1):
                    g = tuple(s[i : i + n])
                    grams[g] = grams.get(g, 0) + 1
            return grams
        seen = {tuple(s[i : i + n + 1]) for s in parts for i in range(len(s) - n)}
        grams = {}
        for g in seen:
            grams[g[1:]] = grams.get(g[1:], 0) + 1
        return grams

    def p(context, symbol):
        grams = counts(len(context) + 1)
        if not context:
            total = sum(grams.values())
            unseen = max(langid.DISCOUNT * len(grams) / total, 1e-3) / 1024
            return max(grams[(symbol,)] - langid.DISCOUNT, 0) / total + unseen if (symbol,) in grams else unseen
        own = {g: c for g, c in grams.items() if g[:-1] == context}
        if not own:
            return p(context[1:], symbol)
        total = sum(own.values())
        return max(own.get((*context, symbol), 0) - langid.DISCOUNT, 0) / total + langid.DISCOUNT * len(own) / total * p(context[1:], symbol)

    return p(tuple(context), symbol)


def test_probabilities_equal_the_plain_formula():
    texts = {"x": ["abracadabra abba", "cab"], "y": ["the thin thing", "in that"]}
    parts = {k: [langid.symbols(langid._code_points(t)).astype(np.uint64) for t in v] for k, v in texts.items()}
    models = langid._merge(list(parts), [langid._fit_language(parts[lang]) for lang in parts])
    text = langid.symbols(langid._code_points("that cabbage thq abra")).astype(np.uint64)
    got = models.log_probabilities(text, 0)
    for i in range(len(text)):
        for k, lang in enumerate(parts):
            want = plain_probability(parts[lang], text[max(0, i - langid.ORDER + 1) : i].tolist(), int(text[i]))
            assert got[i, k] == pytest.approx(np.log(want), rel=1e-4)


def test_chunks_do_not_change_totals(models, monkeypatch):
    text = langid.symbols(langid._code_points("The thing and of the other in was " * 50)).astype(np.uint64)
    whole, _ = models.totals(text)
    monkeypatch.setattr(langid, "CHUNK_CHARS", 37)
    assert models.totals(text)[0] == pytest.approx(whole)


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language_id"](spark, SF).join(truth, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


UNLEARNED = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "xqzvk jwqpx zzkqv bxqj wvkz qpxj vkzq",
]


def test_unlearned_languages_are_rejected(spark, make, models):
    texts = [t * k for t in UNLEARNED for k in (1, 40)]
    found = langid.predict(make([(i, t, None, "s", 1, *"abcd") for i, t in enumerate(texts)]), models).collect()
    assert all(r.rejected for r in found)
    learned = spark.read.parquet(f"{SF}/documents.parquet").filter("text RLIKE '\\\\p{L}'")
    assert langid.known_languages(learned, models).count() == learned.count()


def test_one_odd_calibration_document_lifts_no_bound(models):
    rng = np.random.default_rng(1)
    texts = [("x", rng.choice(np.array([97, 98, 32], np.uint64), 2000)) for _ in range(60)]
    junk = [("x", np.arange(5000, 5000 + n, dtype=np.uint64)) for n in (20, 3000)]
    one = langid._merge(["x"], [langid._fit_language([s for _, s in texts[:20]])])
    langid._calibrate(one, texts[20:] + junk)
    assert all(one.decide(*one.totals(s))[3] for _, s in junk)
    assert not any(one.decide(*one.totals(s[:n]))[3] for _, s in texts for n in (5, 100, 2000))


def test_sample_is_filled_to_its_bound(make):
    rows = [(i, f"{i:03d} words " * 100, "en", "s", 1, *"abcd") for i in range(50)]
    rows += [(7, f"same id {i:03d} " * 90, "en", "s", 1, *"abcd") for i in range(200)] + rows[:3] * 300
    documents = make(rows).select("doc_id", "text", "lang")
    lengths = lambda **bounds: [len(r.text) for r in langid._sample(documents, **bounds).collect()]
    assert sum(lengths(sample=400, chars=25_500)) == 25_500
    assert len(lengths(sample=10, chars=10**6)) == 10
    assert len(lengths(sample=240, chars=10**6)) == 240
    assert len(lengths(sample=400, chars=10**6)) == 250


def test_odd_rows(make, odd_rows, models):
    frame = make(odd_rows)
    found = langid.predict(frame, models).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    kept = langid.known_languages(frame, models)
    assert kept.columns == frame.columns and kept.filter("text IS NULL").count() == 0


def test_nothing_to_learn_from(make, odd_rows):
    unlabelled = make([(*r[:2], None, *r[3:]) for r in odd_rows])
    models = langid.fit(unlabelled.select("doc_id", "text", "lang"))
    assert models is None
    assert {r.lang_pred for r in langid.predict(unlabelled, models).collect()} == {"und"}
    assert langid.predict(make([]), models).count() == 0


def test_one_short_document_is_enough(make):
    models = langid.fit(make([(1, "a", "en", "s", 1, *"abcd")]).select("doc_id", "text", "lang"))
    assert langid.predict(make([(2, "hello there", None, "s", 1, *"abcd")]), models).first().lang_pred == "en"
