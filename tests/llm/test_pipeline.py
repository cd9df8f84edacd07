"""The pipeline's stages on the smallest tables and on odd rows, each against its own brute force."""

from collections import Counter

import pytest
from test_jaccard import expected as components
from test_mixing import expected as mix
from test_packing import check

import __spark_entry__ as entry_point
import corpus_pipeline
from replyloom.llm import secrets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after every stage, each written and read again."""
    out = tmp_path_factory.mktemp("pipeline")
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    frames = {"documents": frame}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, SF).write.parquet(str(out / name))
        frame = frames[name] = spark.read.parquet(str(out / name))
    return frames


def rows(frame):
    return [tuple(r) for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard", "secret_scan", "source_mix", "best_fit_packing"]
    for name in names[:-1]:
        assert stages[name].schema == stages["documents"].schema


def test_texts_with_letters_stay(stages):
    kept = {r[0] for r in rows(stages["language_id"])}
    assert kept == {r[0] for r in rows(stages["documents"]) if any(c.isalpha() for c in r[1] or "")}


def test_one_of_each_group_stays(stages):
    before = rows(stages["language_id"])
    wanted, _ = components(before, 5, 80)
    assert sorted(r[0] for r in rows(stages["ngram_jaccard"])) == sorted({c for _, _, c in wanted})


def test_copies_from_four_fifths_on_go(spark, make):
    """Appended blocks: five-word similarities of 0.80, 0.833 and 0.79 to one text each."""
    frames = []
    for k, extra in enumerate([49, 39, 52]):
        text = [f"w{k}x{i}" for i in range(200)]
        frames += [" ".join(text), " ".join(text + [f"e{k}x{i}" for i in range(extra)])]
    rows = [(i, t, "en", "s", len(t), *"abcd") for i, t in enumerate(frames)]
    assert sorted(r[0] for r in corpus_pipeline.ngram_jaccard(spark, make(rows), SF).collect()) == [0, 2, 4, 5]


def test_secrets_are_gone(spark, stages):
    before = {r[0]: r[1] for r in rows(stages["ngram_jaccard"])}
    after = {r[0]: r for r in rows(stages["secret_scan"])}
    assert set(before) == set(after)
    found = {r.doc_id: r.spans for r in secrets.digest(stages["ngram_jaccard"]).collect()}
    assert any(found.values())
    for doc_id, (_, text, _, _, n) in after.items():
        assert n == len(text) and (text == before[doc_id]) == (not found[doc_id])
    assert secrets.digest(stages["secret_scan"]).filter("spans <> ''").count() == 0


def test_documents_are_drawn_as_the_mix_says(stages):
    before = rows(stages["secret_scan"])
    wanted = {(d, s): taken // size for d, s, size, _, _, taken in mix(before) if size}
    drawn = Counter((r[0], r[3]) for r in rows(stages["source_mix"]))
    assert drawn == {k: n for k, n in wanted.items() if n}


def test_packing(stages):
    sequences, tokens = check(stages["best_fit_packing"].collect(), rows(stages["source_mix"]), 1024)
    assert sequences <= 1.02 * tokens / 1024 + 1


def test_run_is_registered(spark, stages):
    found = entry_point.queries()["pipeline"](spark, SF)
    assert found.columns == stages["best_fit_packing"].columns
    assert found.count() == stages["best_fit_packing"].count()


def test_odd_rows(spark, make, odd_rows):
    for data in (odd_rows, []):
        frame = make(data)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == make([]).columns
        assert (corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() > 0) == bool(data)
