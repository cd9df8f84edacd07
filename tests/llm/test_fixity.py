"""The fixity audit against comparing every record."""

import random

from replyloom.llm import fixity
from replyloom.session import materialize

SCHEMA = "page_id BIGINT, digest STRING, length BIGINT, replica_digest STRING, replica_length BIGINT"


def records(n):
    rng = random.Random(9)
    out = []
    for i in range(n):
        digest, length = f"{rng.getrandbits(64):x}", rng.randint(1, 500)
        kind = rng.random()
        other = ("changed", length) if kind < 0.02 else ("cut", length // 2) if kind < 0.03 else (None, 0) if kind < 0.035 else (digest, length)
        out.append((None if i == 3 else i // 2, digest, length, *other))
    return out


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out, start, other, file = [], 0, 0, None
    for n, (page, digest, length, replica, replica_length) in enumerate(ordered):
        if n // fixity.FILE_RECORDS != file:
            file, start, other = n // fixity.FILE_RECORDS, 0, 0
        ends_apart = start + length != other + replica_length
        status = "missing" if replica is None else "changed" if replica != digest else "moved" if start != other or ends_apart else "ok"
        out.append((page, file, n % fixity.FILE_RECORDS, start, status))
        start += length
        other += replica_length if replica is not None else 0
    return sorted(out, key=repr)


def run(spark, rows):
    placed = materialize(fixity.laid_out(spark.createDataFrame(rows, SCHEMA), ["page_id", "digest"]))
    return sorted(((r.page_id, r.file, r.place, r.start, r.status) for r in fixity.audited(placed).collect()), key=repr)


def test_against_comparing_all(spark):
    rows = records(1300)
    assert run(spark, rows) == expected(rows)


def test_equal_replicas_and_empty(spark):
    rows = [(i, f"d{i}", 5, f"d{i}", 5) for i in range(600)]
    assert {r[-1] for r in run(spark, rows)} == {"ok"}
    assert run(spark, []) == []


def test_only_branches_that_differ_are_read(spark):
    rows = [(i, f"d{i}", 5, "other" if i == 77 else f"d{i}", 5) for i in range(512)]
    placed = materialize(fixity.laid_out(spark.createDataFrame(rows, SCHEMA), ["page_id", "digest"]))
    ours = materialize(fixity.tree(fixity.leaves(placed.select("file", "place", "digest", "length"))))
    theirs = fixity.leaves(placed.select("file", "place", placed.replica_digest.alias("digest"), "length"))
    found = fixity.audit(ours, materialize(fixity.tree(theirs))).collect()
    assert [(r.file, r.place, r.status) for r in found] == [(0, 77, "changed")]
    assert fixity.roots(ours).count() == 1


def test_null_content_is_a_record(spark):
    content = fixity.record(spark.sql("SELECT 1")["1"].cast("string"), spark.sql("SELECT 1")["1"].cast("string"))
    assert content is not None
