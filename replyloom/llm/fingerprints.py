"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, or each stretch of ``PARAGRAPH`` characters of a longer line. Its digest is 48 bits of a hash
with 16 check bits, and goes into one cell of each of three tables; a cell holds how many digests it has
and their exclusive or. Cells of two versions subtract; a cell left with one digest gives it away, and
peeling it from its other cells uncovers the next, until the differing digests are recovered.

The fingerprint of a text is a sketch of ``CELLS`` cells. Versions that differ in more paragraphs than it can hold are
compared again with larger sketches: digests are dealt by their bits into parts, each with a small sketch of its own,
parts that do not peel get larger ones. Everything is a Spark expression over rows of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.session import materialize

PARAGRAPH = 200
CELLS = 24
#: Expected digests of both versions per part when larger sketches are made.
PART_LOAD = 4
#: Cells of a part's sketch, tried in this order.
PART_CELLS = (12, 24, 96, 384)
ROWS_PER_RANGE = 512
RANGES = 64


def paragraphs(text: Column) -> Column:
    """The distinct digests of a text's paragraphs; line ends belong to no paragraph."""
    units = F.regexp_extract_all(text, F.lit(rf"[^\n\r]{{1,{PARAGRAPH}}}"), F.lit(0))
    return F.array_distinct(F.transform(units, digest))


def digest(unit: Column) -> Column:
    """48 hash bits above 16 check bits, so that a lone digest can be told from a mixture."""
    high = F.shiftrightunsigned(F.xxhash64(unit), 16)
    return F.shiftleft(high, 16).bitwiseOR(_check(high))


def _check(high: Column) -> Column:
    return F.xxhash64(high, F.lit("check")).bitwiseAND(F.lit(0xFFFF))


def _is_digest(value: Column) -> Column:
    return value.bitwiseAND(F.lit(0xFFFF)) == _check(F.shiftrightunsigned(value, 16))


def _place(value: Column, table: int, width: int) -> Column:
    """The cell of a digest within one of the three tables of ``width`` cells."""
    return F.pmod(F.shiftrightunsigned(value, 20 + 14 * table), F.lit(width)).cast("int")


def sketch(digests: Column, cells: int) -> Column:
    """``cells`` structs (n, x) from an array of distinct digests."""
    width = cells // 3
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("x"))

    def table(t: int) -> Column:
        def fill(placed: Column) -> Column:
            def cell(i: Column) -> Column:
                mine = F.filter(placed, lambda p: p["at"] == i)
                return F.aggregate(
                    mine, empty, lambda s, p: F.struct((s["n"] + 1).alias("n"), s["x"].bitwiseXOR(p["x"]).alias("x"))
                )

            return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), cell)

        return _let(F.transform(digests, lambda d: F.struct(d.alias("x"), _place(d, t, width).alias("at"))), fill)

    return F.concat(*[table(t) for t in range(3)])


def subtract(a: Column, b: Column) -> Column:
    """Cells of what only ``a`` or only ``b`` holds."""
    return F.zip_with(
        a, b, lambda p, q: F.struct((p["n"] - q["n"]).alias("n"), p["x"].bitwiseXOR(q["x"]).alias("x"))
    )


def peel(cells: Column, count: int, rounds: int = 8) -> Column:
    """(found, done): the recovered digests, and whether no cell is left.

    Each round takes the digests of all cells that hold one, and removes them from their other cells.
    """
    width = count // 3

    def alone(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & _is_digest(c["x"])

    def step(state: Column) -> Column:
        def remove(kept: Column) -> Column:
            def strip(c: Column, i: Column) -> Column:
                mine = F.filter(kept, lambda d: (d["p0"] == i) | (d["p1"] == i) | (d["p2"] == i))
                return F.aggregate(
                    mine, c, lambda s, d: F.struct((s["n"] - d["n"]).alias("n"), s["x"].bitwiseXOR(d["x"]).alias("x"))
                )

            stripped = F.struct(
                F.transform(state["cells"], strip).alias("cells"),
                F.concat(state["found"], F.transform(kept, lambda d: d["x"])).alias("found"),
            )
            return F.when(F.size(kept) > 0, stripped).otherwise(state)

        places = lambda x: [(_place(x, t, width) + t * width).alias(f"p{t}") for t in range(3)]
        single = F.array_distinct(F.filter(state["cells"], alone))
        placed = F.transform(single, lambda c: F.struct(c["n"].alias("n"), c["x"].alias("x"), *places(c["x"])))
        return _let(placed, remove)

    start = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("found"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        start,
        lambda s, _: step(s),
        lambda s: F.struct(
            s["found"].alias("found"), (~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["x"] != 0))).alias("done")
        ),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a column used inside a lambda is computed again at each use."""
    return F.transform(F.array(value), body)[0]


def encode(cells: Column, n: Column) -> Column:
    """A fingerprint as text: the number of distinct paragraphs, then every cell as count and digest in hex."""
    one = F.transform(cells, lambda c: F.concat_ws(":", c["n"].cast("string"), F.lower(F.hex(c["x"]))))
    return F.concat(n.cast("string"), F.lit(";"), F.array_join(one, ","))


def likeness(n_a: Column, n_b: Column, differing: Column) -> Column:
    """Shared among all distinct paragraphs of two versions, 1 for two without any."""
    both = (n_a + n_b - differing) / 2
    return F.when(n_a + n_b == 0, 1.0).otherwise(both / (n_a + n_b - both))


def larger(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """(keys, more): differing digests of rows whose small sketches did not peel, by sketches in parts."""
    parts = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / PART_LOAD)).cast("bigint")
    side = lambda c, sign: F.transform(c, lambda d: F.struct(d.alias("x"), F.lit(sign).alias("side")))
    rows = pairs.select(*keys, parts.alias("_parts"), F.explode(F.concat(side(a, 1), side(b, -1))).alias("_d"))
    part = F.pmod(F.xxhash64("_d.x", F.lit("part")), F.col("_parts"))
    grouped = (
        rows.select(*keys, part.alias("_part"), "_d.*")
        .groupBy(*keys, "_part")
        .agg(
            F.collect_list(F.when(F.col("side") == 1, F.col("x"))).alias("_a"),
            F.collect_list(F.when(F.col("side") == -1, F.col("x"))).alias("_b"),
        )
    )
    count = F.size(F.array_except("_a", "_b")) + F.size(F.array_except("_b", "_a"))
    for cells in reversed(PART_CELLS):
        count = _peeled_or(peel(subtract(sketch(F.col("_a"), cells), sketch(F.col("_b"), cells)), cells), count)
    return grouped.select(*keys, count.cast("bigint").alias("_n")).groupBy(*keys).agg(F.sum("_n").alias("more"))


def _peeled_or(peeled: Column, rest: Column) -> Column:
    """The number of recovered digests, or ``rest``, which is only evaluated when peeling failed."""
    return _let(peeled, lambda p: F.when(p["done"], F.size(p["found"])).otherwise(rest))


def with_next(documents: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, text, own, next_text, next): each document with the one that follows it by doc_id, the last with the first.

    ``own`` and ``next`` are the paragraph digests of both.

    Ties are ordered by the hash of the text; a null id comes first. Rows are dealt by ranges of the order, so the text
    is moved once: the first document of a range is also sent to the range before it.
    """
    keyed = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({"_h": F.xxhash64("text"), "own": paragraphs(F.col("text"))})
    # Ids and hashes as one number, in order wherever doubles tell neighbours apart.
    spot = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300)) + F.col("_h") / F.lit(2.0**64)
    stats = keyed.agg(
        F.percentile_approx(spot, [i / RANGES for i in range(RANGES + 1)], 10_000).alias("q"), F.count(F.lit(1)).alias("n")
    ).first()
    edges = sorted(set(stats.q or []))
    subs = max(1, -(-stats.n // (rows_per_range * RANGES)))
    high = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[1:-1]]).cast("array<double>"), lambda e: e <= spot))
    low_edge = F.get(F.array(*[F.lit(float(e)) for e in edges] or [F.lit(0.0)]), high)
    high_edge = F.get(F.array(*[F.lit(float(e)) for e in edges] or [F.lit(0.0)]), high + 1)
    inner = F.floor((spot - low_edge) / (high_edge - low_edge) * subs)
    bounded = F.least(F.greatest(F.coalesce(inner, F.lit(0)), F.lit(0)), F.lit(subs - 1))
    placed = keyed.withColumn("_range", high.cast("bigint") * subs + bounded)
    starts = placed.groupBy("_range").agg(F.min(F.struct("doc_id", "_h")).alias("one"))
    # One row per range: ranges are numbered within each of the outer ranges, then over those.
    starts = materialize(starts.withColumn("_outer", F.floor(F.col("_range") / subs)))
    inside = Window.partitionBy("_outer").orderBy("_range")
    ends = starts.groupBy("_outer").agg(F.max("_range").alias("_end"))
    outer = Window.orderBy("_outer")
    before = ends.select(
        "_outer", F.coalesce(F.lag("_end").over(outer), F.max("_end").over(Window.partitionBy())).alias("_last")
    )
    previous = (
        starts.withColumn("_previous", F.lag("_range").over(inside))
        .join(before, "_outer")
        .select(F.col("one.doc_id").alias("_id"), F.col("one._h").alias("_hash"), F.coalesce("_previous", "_last").alias("_to"))
    )
    guests = (
        keyed.join(previous, keyed.doc_id.eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")))
        .dropDuplicates(["_to"])
        .select("doc_id", "text", "own", "_h", F.col("_to").alias("_range"), F.lit(True).alias("_guest"))
    )
    rows = placed.withColumn("_guest", F.lit(False)).select(guests.columns).unionByName(guests)
    order = Window.partitionBy("_range").orderBy("_guest", "doc_id", "_h")
    following = rows.withColumns({"next_text": F.lead("text").over(order), "next": F.lead("own").over(order)})
    return following.filter("NOT _guest").select("doc_id", "text", "own", "next_text", "next")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per document.

    The edited text has its last quarter of code points replaced by the start of the next document. A null text
    counts as empty and has no paragraphs. Equal texts have equal fingerprints; texts without common paragraphs have likeness 0.
    """
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.substring("next_text", F.lit(1), quarter)
    )
    rows = (
        with_next(documents)
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn("_edited", edited)
        .select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            "n_chars",
            F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
            F.col("own").alias("_own"),
            paragraphs(F.col("_edited")).alias("_changed"),
            F.col("next").alias("_next"),
        )
    )
    rows = materialize(rows)
    sketched = rows.select(
        "_row", "doc_id", "n_chars", "edited_sha256",
        *[F.size(c).cast("bigint").alias(f"n{c}") for c in ("_own", "_changed", "_next")],
        sketch(F.col("_own"), CELLS).alias("s_own"),
        sketch(F.col("_changed"), CELLS).alias("s_changed"),
        sketch(F.col("_next"), CELLS).alias("s_next"),
    )
    sketched = materialize(
        sketched.withColumn("_p1", peel(subtract(F.col("s_own"), F.col("s_changed")), CELLS))
        .withColumn("_p2", peel(subtract(F.col("s_own"), F.col("s_next")), CELLS))
        .select(
            "_row", "doc_id", "n_chars", "edited_sha256", "n_own", "n_changed", "n_next",
            encode(F.col("s_own"), F.col("n_own")).alias("fingerprint"),
            encode(F.col("s_changed"), F.col("n_changed")).alias("edited_fingerprint"),
            F.when(F.col("_p1.done"), F.size("_p1.found").cast("bigint")).alias("_d1"),
            F.when(F.col("_p2.done"), F.size("_p2.found").cast("bigint")).alias("_d2"),
        )
    )
    failed = sketched.filter("_d1 IS NULL OR _d2 IS NULL").select("_row", "_d1", "_d2")
    again = rows.join(failed, "_row")
    retry = larger(
        again.filter("_d1 IS NULL").select("_row", F.lit(1).alias("_with"), F.col("_own").alias("a"), F.col("_changed").alias("b"))
        .unionByName(
            again.filter("_d2 IS NULL").select("_row", F.lit(2).alias("_with"), F.col("_own").alias("a"), F.col("_next").alias("b"))
        ),
        ["_row", "_with"], "a", "b",
    )
    found = retry.groupBy("_row").agg(
        F.max(F.when(F.col("_with") == 1, F.col("more"))).alias("_m1"), F.max(F.when(F.col("_with") == 2, F.col("more"))).alias("_m2")
    )
    return sketched.join(found, "_row", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("n_own"), F.col("n_changed"), F.coalesce("_d1", "_m1")).alias("near_edited"),
        likeness(F.col("n_own"), F.col("n_next"), F.coalesce("_d2", "_m2")).alias("near_next"),
    )
