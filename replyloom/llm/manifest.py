"""Merkle manifest of a dataset: leaves in order within groups, groups in order below one root.

A level is one table of nodes (grp, idx, digest). Every node equijoins its level once per sibling, on the sibling's
computed index: its own with the last bit flipped (XOR) where runs hold two, else its run's start plus its slot shifted by one to fan-out - 1
places. So a level writes all siblings of all nodes, and the rows of slot zero emit the parents. Indices are dense,
so a group with a third of all rows is dealt like any other. Proofs go down again: a node's path is its own siblings
and its parent's path, one join a level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.operators.ordering import number_rows
from replyloom.session import materialize

FAN_OUT = 3


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the texts in a row."""
    return F.sha2(F.concat(*parts, F.lit("")).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it; null has a mark of its own."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column | str) -> Column:
    return hashed(*[field(F.col(v) if isinstance(v, str) else v) for v in values])


def levels_of(count: int, fan_out: int = FAN_OUT) -> int:
    """Levels above ``count`` leaves: none above a single one."""
    height, held = 0, 1
    while held < count:
        height, held = height + 1, held * fan_out
    return height


def _height(count: Column, most: int, fan_out: int) -> Column:
    return reduce(lambda out, h: F.when(count <= fan_out**h, h).otherwise(out), reversed(range(most)), F.lit(most))


def _siblings(idx: Column, fan_out: int) -> list[Column]:
    """Indices of the other nodes of a run, by computed shifts of the own slot."""
    if fan_out == 2:
        return [idx.bitwiseXOR(F.lit(1))]
    slot = idx % fan_out
    return [idx - slot + (slot + shift) % fan_out for shift in range(1, fan_out)]


def with_siblings(nodes: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """A level's nodes with ``run``: the digests of a node's run in order, its own included; missing ones are null.

    Columns beside grp, idx and digest stay.
    """
    joined = nodes.select("*", *[s.alias(f"at{i}") for i, s in enumerate(_siblings(F.col("idx"), fan_out))])
    for i in range(fan_out - 1):
        other = nodes.select(F.col("grp").alias(f"grp{i}"), F.col("idx").alias(f"idx{i}"), F.col("digest").alias(f"digest{i}"))
        on = (F.col("grp") == F.col(f"grp{i}")) & (F.col(f"at{i}") == F.col(f"idx{i}"))
        joined = joined.join(other, on, "left")
    slot = F.col("idx") % fan_out
    # The node in slot j is the own one, or the sibling whose shift leads there.
    found = []
    for j in range(fan_out):
        shifted = F.col("digest")
        for i in range(fan_out - 1):
            shifted = F.when((slot + i + 1) % fan_out == j, F.col(f"digest{i}")).otherwise(shifted)
        found.append(shifted)
    return joined.select(*nodes.columns, F.array(*found).alias("run"))


def parents(level: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """The nodes above: each slot-zero row emits the digest of its run."""
    first = level.filter(F.col("idx") % fan_out == 0)
    digest = F.unhex(hashed(F.array_join(F.transform("run", lambda d: F.lower(F.hex(d))), "")))
    return first.select("grp", F.floor(F.col("idx") / fan_out).cast("bigint").alias("idx"), digest.alias("digest"))


def build(nodes: DataFrame, counts: DataFrame, fan_out: int = FAN_OUT) -> tuple[list[DataFrame], DataFrame]:
    """Levels with siblings, lowest first, and (grp, n, height, top) of every group.

    ``nodes`` (grp, idx, digest) has the dense indices 0 to n - 1 in each group of ``counts`` (grp, n). A level holds the groups
    that still have more than one node.
    """
    most = levels_of(counts.agg(F.max("n")).first()[0] or 0, fan_out)
    sized = counts.withColumn("height", _height(F.col("n"), most, fan_out))
    levels: list[DataFrame] = []
    for h in range(most + 1):
        ended = sized.filter(F.col("height") == h)
        # Index 0 is asked for below the parents, where the table's files can leave rows out.
        first = parents(levels[-1].filter("idx = 0"), fan_out) if h else nodes.filter("idx = 0")
        top = ended.join(first.select("grp", F.col("digest").alias("top")), "grp")
        tops = tops.unionByName(top) if h else top
        if h < most:
            level = parents(levels[-1], fan_out) if h else nodes
            levels.append(materialize(with_siblings(level.join(ended.select("grp"), "grp", "left_anti"), fan_out)))
    return levels, tops


def _step(idx: Column, run: Column, fan_out: int) -> Column:
    """A level of a path: the own slot, then the digests of the others in order."""
    slot = idx % fan_out
    others = F.filter(run, lambda d, i: (i != slot) & d.isNotNull())
    return F.concat(slot.cast("string"), F.array_join(F.transform(others, lambda d: F.lower(F.hex(d))), ""))


def paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """``nodes`` with ``path``, the steps from a node to the top of its group and what follows there.

    ``tops`` (grp, height, path and columns to carry along) says where a group's top lies. Each level is joined once with the
    one above it, so the plan is a chain.
    """
    carried = [c for c in tops.columns if c not in ("grp", "height", "path")]
    below = None
    for h in range(len(levels), -1, -1):
        ended = tops.filter(F.col("height") == h).drop("height")
        if h:
            out = ["grp", "idx", "path", *carried]
            ends = ended.withColumn("idx", F.lit(0).cast("bigint")).select(*out)
        else:
            out = [*nodes.columns, "path", *carried]
            ends = nodes.join(ended, "grp").select(*out)
        if h < len(levels):
            up, step = F.floor(F.col("idx") / fan_out).cast("bigint"), _step(F.col("idx"), F.col("run"), fan_out)
            own = levels[h].withColumn("up", up).withColumn("step", step).drop("run")
            above = below.select(F.col("grp").alias("g"), F.col("idx").alias("i"), F.col("path").alias("rest"), *carried)
            joined = own.join(above, (F.col("grp") == F.col("g")) & (F.col("up") == F.col("i")))
            ends = joined.withColumn("path", F.concat(F.array("step"), "rest")).select(*out).unionByName(ends)
        below = ends
    return below


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the other nodes of its runs lead to."""

    def up(digest: Column, step: Column) -> Column:
        before = 64 * F.substring(step, 1, 1).cast("int")
        left = F.substring(step, F.lit(2), before)
        return hashed(left, digest, F.substring(step, before + 2, F.length(step)))

    return F.aggregate(path, start, up)


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, from below to above and left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.substring(s, F.lit(2), F.length(s))), ""))


def manifest(
    documents: DataFrame, leaf_digest: Column, checked_digest: Column, group: str = "source", order: str = "doc_id", fan_out: int = FAN_OUT
) -> DataFrame:
    """(order, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Leaves ascend by ``order`` in each ``group``; nulls come first in both, and rows of one id by their digest. Groups ascend
    bytewise. ``checked_digest`` is the leaf as it is found now: ``folded_root`` is recomputed from it and the siblings that the manifest
    holds, and ``verified`` tells whether that is the root. Rows that repeat are leaves of their own; an empty table gives
    no rows. Other columns of any name are not read. Texts are read once, to be hashed.
    """
    leaf_bytes, checked = F.unhex(leaf_digest), F.unhex(checked_digest)
    rows = materialize(
        documents.select(F.col(order).alias("key"), F.col(group).cast("string").alias("name"), leaf_bytes.alias("digest"), checked.alias("checked"))
        # What is found as it was need not travel twice.
        .withColumn("checked", F.when(F.col("checked") != F.col("digest"), F.col("checked")))
    )
    slices = max(rows.sparkSession.sparkContext.defaultParallelism, 1)
    slice_rows = min(1_000_000, max(10_000, -(-rows.count() // slices)))
    numbered = materialize(number_rows(rows, ["name"], ["key", "digest", "checked"], "number", slice_rows))
    names = numbered.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    groups = materialize(number_rows(names, [], ["name"], "grp"))
    nodes = materialize(
        numbered.alias("r")
        .join(groups.alias("g"), F.col("r.name").eqNullSafe(F.col("g.name")))
        .select("g.grp", (F.col("r.number") - 1).alias("idx"), "r.digest", "r.key", "r.checked")
    )
    levels, tops = build(nodes, groups.select("grp", "n"), fan_out)
    tops = materialize(tops)
    upper = tops.select(F.lit(0).cast("bigint").alias("grp"), (F.col("grp") - 1).alias("idx"), F.col("top").alias("digest"), "height")
    upper_levels, upper_top = build(upper, upper.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), fan_out)
    one = upper_top.first()
    root = F.lit(one.top.hex() if one else None).cast("string")
    end = upper_top.select("grp", "height", F.array().cast("array<string>").alias("path"))
    ends = paths(upper, upper_levels, end, fan_out).select(
        (F.col("idx") + 1).alias("grp"), "height", "path", F.col("digest").alias("subroot")
    )
    found = paths(nodes, levels, materialize(ends), fan_out)
    again = folded(F.lower(F.hex(F.coalesce("checked", "digest"))), F.col("path"))
    return found.select(
        F.col("key").alias(order), F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        root.alias("root"), proof(F.col("path")).alias("proof_sha256"), again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
