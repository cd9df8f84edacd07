"""Merkle fixity audit of WARC replicas.

Records are hashed, and every file's records, in order of their offsets, are the leaves of a tree with a fan-out of
``FAN``. A node hashes its children's digests and offset ranges. Two replicas are compared at their roots; only
the children of nodes that differ are looked at, level by level, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.operators.ordering import number_rows
from replyloom.session import materialize

FAN = 8
LEVELS = 3
#: Records per file: a tree of LEVELS levels under its root.
FILE_RECORDS = FAN**LEVELS


def record(url: Column, payload: Column) -> Column:
    """A WARC response record as text; nulls count as empty."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def fixity(content: Column) -> tuple[Column, Column]:
    """Digest and length in bytes of a record."""
    data = content.cast("binary")
    return F.sha2(data, 256), F.octet_length(data).cast("bigint")


def laid_out(records: DataFrame, order: list[str], file_records: int = FILE_RECORDS) -> DataFrame:
    """Add ``file`` and ``place``: records in ``order`` fill one file after the other. Nulls come first."""
    numbered = number_rows(records, [], order, "_n")
    place = F.col("_n") - 1
    return numbered.withColumns(
        {"file": F.floor(place / file_records), "place": place % file_records}
    ).drop("_n")


def leaves(records: DataFrame) -> DataFrame:
    """Add each record's ``start`` and ``end`` offset in its file to (file, place, digest, length)."""
    order = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("length").over(order)
    return records.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))


def tree(records: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(file, level, node, hash, start, end) of all nodes above the records of one replica.

    Level 0 are the records, the roots are at ``levels``. A node has at most ``fan`` children.
    """
    nodes = records.select(
        "file", F.lit(0).alias("level"), F.col("place").alias("node"), F.col("digest").alias("hash"), "start", "end"
    )
    out = nodes
    for level in range(1, levels + 1):
        child = F.struct("node", "hash", "start", "end")
        nodes = (
            nodes.groupBy("file", F.floor(F.col("node") / fan).alias("parent"))
            .agg(F.array_sort(F.collect_list(child)).alias("children"))
            .select(
                "file",
                F.lit(level).alias("level"),
                F.col("parent").alias("node"),
                F.sha2(
                    F.array_join(
                        F.transform(
                            "children",
                            lambda c: F.concat_ws(":", c["hash"], c["start"].cast("string"), c["end"].cast("string")),
                        ),
                        ",",
                    ),
                    256,
                ).alias("hash"),
                F.col("children")[0]["start"].alias("start"),
                F.element_at("children", -1)["end"].alias("end"),
            )
        )
        out = out.unionByName(nodes)
    return out


def audit(ours: DataFrame, theirs: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(file, place, status, checked) of the records in which two trees differ.

    ``status``: ``changed`` (another digest), ``moved`` (the same digest at another offset), ``missing`` (only ours has
    it) or ``extra``. The trees should be written tables, partitioned or not; each level reads the
    nodes under the branches that differed one level up.
    """
    branches = None
    for level in range(levels, -1, -1):
        a = ours.filter(F.col("level") == level).select("file", "node", F.struct("hash", "start", "end").alias("a"))
        b = theirs.filter(F.col("level") == level).select("file", "node", F.struct("hash", "start", "end").alias("b"))
        if branches is not None:
            up = lambda t: t.withColumn("_up", F.floor(F.col("node") / fan))
            a = up(a).join(branches, ["file", "_up"], "left_semi").drop("_up")
            b = up(b).join(branches, ["file", "_up"], "left_semi").drop("_up")
        differing = a.join(b, ["file", "node"], "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
        if level:
            branches = materialize(differing.select("file", F.col("node").alias("_up")))
    status = (
        F.when(F.col("b").isNull(), "missing")
        .when(F.col("a").isNull(), "extra")
        .when(F.col("a.hash") != F.col("b.hash"), "changed")
        .otherwise("moved")
    )
    return differing.select("file", F.col("node").alias("place"), status.alias("status"))


def roots(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    return nodes.filter(F.col("level") == levels).select("file", "hash", "end")


def audited(records: DataFrame) -> DataFrame:
    """Audit two replicas of one archive; one row per record of ours.

    ``records`` (file, place, digest, length, replica_digest, replica_length) is a written table; a record with a null
    ``replica_digest`` is missing there. Adds ``start`` and ``status`` (``ok`` or as in ``audit``). An empty table stays empty.
    """
    ours = leaves(records.select("file", "place", "digest", "length"))
    theirs = leaves(
        records.filter("replica_digest IS NOT NULL").select(
            "file", "place", F.col("replica_digest").alias("digest"), F.col("replica_length").alias("length")
        )
    )
    found = audit(materialize(tree(ours)), materialize(tree(theirs)))
    starts = ours.select("file", "place", "start")
    return (
        records.join(starts, ["file", "place"])
        .join(found, ["file", "place"], "left")
        .withColumn("status", F.coalesce("status", F.lit("ok")))
    )
