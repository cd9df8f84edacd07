"""Reply graph: bounded neighbourhoods, thread roots, lengths, nested records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.functions.text import child_ids, parse_created_at
from replyloom.operators.ordering import first_rows, number_rows
from replyloom.session import cut_lineage, materialize, write_counting


def links(tweets: DataFrame) -> DataFrame:
    """Declared pointers of every tweet, as (src, dst): its parent and its listed children."""
    pointers = F.array_union(
        child_ids(F.col("response_tweet_id")),
        F.array_compact(F.array("in_response_to_tweet_id")),
    )
    return tweets.select(F.col("tweet_id").alias("src"), F.explode(pointers).alias("dst"))


def child_links(tweets: DataFrame) -> DataFrame:
    """Listed children only, as (tweet_id, child_id)."""
    return tweets.select("tweet_id", F.explode(child_ids(F.col("response_tweet_id"))).alias("child_id"))


def neighbourhood(tweets: DataFrame, seed: Column, hops: int = 3) -> DataFrame:
    """Ids within ``hops`` declared pointers of the seed tweets, with their distance.

    Each round is one semi join and one aggregation that removes repeats and known ids together.
    Ids that are pointed at but absent from ``tweets`` are kept, as they may be wanted by the caller.
    """
    seeds = tweets.filter(seed)
    reached = (
        seeds.select("tweet_id", F.lit(0).alias("hop"))
        .unionByName(links(seeds).select(F.col("dst").alias("tweet_id"), F.lit(1).alias("hop")))
        .groupBy("tweet_id")
        .agg(F.min("hop").alias("hop"))
    )
    # Every hop reads the pointers only.
    pointers = materialize(links(tweets))
    for hop in range(2, hops + 1):
        reached = cut_lineage(reached)
        frontier = reached.filter(F.col("hop") == hop - 1)
        step = pointers.join(frontier, pointers.src == frontier.tweet_id, "left_semi").select(
            F.col("dst").alias("tweet_id"), F.lit(hop).alias("hop")
        )
        reached = reached.unionByName(step).groupBy("tweet_id").agg(F.min("hop").alias("hop"))
    return reached


def brand_outbound(brand: str) -> Column:
    return (F.col("author_id") == brand) & ~F.col("inbound")


def thread_roots(tweets: DataFrame) -> DataFrame:
    """(tweet_id, conversation_id): the last tweet reached by following parents inside ``tweets``.

    On a cycle the walk stops where it entered, so a tweet on a cycle is its own root. ``tweet_id`` is unique.
    """
    parents = tweets.select("tweet_id", F.col("in_response_to_tweet_id").alias("parent"))
    known = tweets.select(F.col("tweet_id").alias("parent"), F.lit(True).alias("_known"))
    linked = (
        parents.filter(F.col("parent").isNotNull() & (F.col("parent") != F.col("tweet_id")))
        .join(known, "parent", "left")
        .select("tweet_id", F.when(F.col("_known"), F.col("parent")).alias("parent"))
    )
    unlinked = parents.filter(F.col("parent").isNull() | (F.col("parent") == F.col("tweet_id"))).select(
        "tweet_id", F.lit(None).cast("bigint").alias("parent")
    )
    return _double(linked.unionByName(unlinked))


def _double(nodes: DataFrame) -> DataFrame:
    """Pointer doubling over (tweet_id, parent), where a parent is null or present in ``nodes``.

    A settled row points at its root. Only unsettled rows are joined again, so the rows under a hot
    root leave the loop as soon as they reach it.
    """
    unsettled = ~F.col("settled")
    state, left = write_counting(
        nodes.select(
            "tweet_id",
            F.coalesce("parent", "tweet_id").alias("ptr"),
            F.col("parent").isNull().alias("settled"),
        ),
        unsettled,
    )
    done, active = [state.filter("settled")], state.filter(unsettled)
    round_no, bound = 0, None
    while left:
        # A chain can only be as long as the jumps made so far plus the rows still unsettled;
        # rows that stay unsettled beyond that lead into a cycle.
        bound = bound or 2**round_no + left
        if 2**round_no >= bound:
            break
        everything = done[0]
        for piece in done[1:]:
            everything = everything.unionByName(piece)
        target = everything.unionByName(active).select(
            F.col("tweet_id").alias("ptr"), F.col("ptr").alias("next"), F.col("settled").alias("arrives")
        )
        jumped = active.join(target, "ptr").select(
            "tweet_id", F.col("next").alias("ptr"), F.col("arrives").alias("settled")
        )
        moved, remaining = write_counting(jumped, unsettled)
        done.append(moved.filter("settled"))
        active = moved.filter(unsettled)
        round_no += 1
        if remaining < left:
            left, bound = remaining, 2**round_no + remaining
    roots = done[0]
    for piece in done[1:]:
        roots = roots.unionByName(piece)
    roots = roots.select("tweet_id", F.col("ptr").alias("conversation_id"))
    if not left:
        return roots
    # The pointers of the leftover rows are exactly the tweets on cycles: make those roots and go again.
    on_cycle = active.select(F.col("ptr").alias("tweet_id")).distinct().withColumn("_cycle", F.lit(True))
    rest = (
        nodes.join(active.select("tweet_id"), "tweet_id", "left_semi")
        .join(on_cycle, "tweet_id", "left")
        .select("tweet_id", F.when(F.col("_cycle").isNull(), F.col("parent")).alias("parent"))
    )
    return roots.unionByName(_double(rest))


def thread_length(tweets: DataFrame) -> DataFrame:
    """Add the number of tweets of each conversation; meant for narrow rows such as ``thread_roots``.

    Counts are pre-aggregated and joined as one row per thread, so a hot thread is safe.
    """
    sizes = tweets.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("conversation_length"))
    return tweets.join(sizes, "conversation_id")


def extract_brand(tweets: DataFrame, brand: str, hops: int = 3) -> DataFrame:
    """All tweets of the brand's conversations with ``conversation_id`` and ``conversation_length``.

    Of several rows with one id the earliest stays, then the first by all its columns. Lengths are joined
    to the ids first, so a text is moved once for that, by its unique id.
    """
    reached = neighbourhood(tweets, brand_outbound(brand), hops)
    at = parse_created_at(F.col("created_at")).asc_nulls_last()
    rest = [c for c in tweets.columns if c != "tweet_id"]
    first = first_rows(tweets.join(reached, "tweet_id", "left_semi"), ["tweet_id"], [at, *rest])
    # Read by the walk along the parents and by the final join, so it is written once.
    kept = materialize(first.select(*tweets.columns))
    return kept.join(thread_length(thread_roots(kept)), "tweet_id").select(
        *tweets.columns, "conversation_id", "conversation_length"
    )


TURN_COLUMNS = [
    "tweet_id", "author_id", "inbound", "created_at", "text", "in_response_to_tweet_id", "response_tweet_id",
]


def conversation_records(threaded: DataFrame, turns_per_record: int = 10_000, slice_rows: int = 1_000_000) -> DataFrame:
    """Nested records per thread, turns in time order (ties by id, undated turns last).

    Every turn is numbered within its thread, and each ``turns_per_record`` of them are one record: ``part`` numbers a
    thread's records and ``first_position`` is the place of a record's first turn. No task ever holds more
    than one record's worth of a thread.
    """
    dated = threaded.select(
        "conversation_id",
        "conversation_length",
        parse_created_at(F.col("created_at")).alias("_at"),
        *TURN_COLUMNS,
    ).withColumn("_undated", F.col("_at").isNull())
    numbered = number_rows(dated, ["conversation_id"], ["_undated", "_at", "tweet_id"], "_n", slice_rows)
    part = F.floor((F.col("_n") - 1) / turns_per_record).cast("bigint")
    turn = F.struct(F.col("_n").alias("_order"), F.struct(*TURN_COLUMNS).alias("turn"))
    return (
        numbered.groupBy("conversation_id", "conversation_length", part.alias("part"))
        .agg(F.array_sort(F.collect_list(turn)).alias("sorted"))
        .select(
            "conversation_id",
            "conversation_length",
            "part",
            (F.col("part") * turns_per_record).alias("first_position"),
            F.transform("sorted", lambda t: t["turn"]).alias("tweets"),
        )
    )


def flatten_records(records: DataFrame) -> DataFrame:
    """Nested records back to one row per turn with its position in the thread."""
    turns = records.select(
        "conversation_id", "conversation_length", "part", "first_position", F.posexplode("tweets").alias("_at", "turn")
    )
    position = (F.col("first_position") + F.col("_at")).cast("bigint").alias("position")
    return turns.select("conversation_id", "conversation_length", "part", position, "turn.*")


def audit_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Counts over JSON lines: threads, turns, and lines without the required keys."""
    doc = F.from_json(value, "conversation_id BIGINT, part BIGINT, tweets ARRAY<STRUCT<tweet_id: BIGINT>>")
    return lines.select(doc.alias("doc")).agg(
        F.count_if(F.coalesce(F.col("doc.part"), F.lit(0)) == 0).alias("conversations"),
        F.coalesce(F.sum(F.greatest(F.size("doc.tweets"), F.lit(0)).cast("bigint")), F.lit(0)).alias("total_turns"),
        F.count_if(F.col("doc.conversation_id").isNull() | F.col("doc.tweets").isNull()).alias("missing_keys"),
    )


def record_problems(lines: DataFrame, required: Mapping[str, str], value: str = "value") -> DataFrame:
    """(field, problem, lines) over JSON lines, for every required field and each of the ways in which it can be wrong.

    ``required`` names paths (``tweets``, ``tweets[0].tweet_id``) and the beginning of the type they must have, as Spark names the types
    of semi-structured values (``BIGINT``, ``STRING``, ``ARRAY``, ``OBJECT``). Problems are ``missing`` (the path is not there), ``null``
    (it holds null) and ``wrong type``; a line that is no JSON counts as ``malformed`` with a null field and nowhere else. A null line is
    malformed too. Problems that do not occur have 0 lines.
    """
    parsed = lines.select(F.try_parse_json(value).alias("v"))
    counts = [F.count_if(F.col("v").isNull()).alias("malformed")]
    kinds = []
    for i, (path, kind) in enumerate(required.items()):
        at = F.variant_get("v", "$." + path, "variant")
        there = at.isNotNull()
        problems = {
            "missing": F.col("v").isNotNull() & ~there,
            "null": there & F.is_variant_null(at),
            "wrong type": there & ~F.is_variant_null(at) & ~F.startswith(F.schema_of_variant(at), F.lit(kind)),
        }
        for name, condition in problems.items():
            counts.append(F.count_if(condition).alias(f"c{i}_{name[0]}"))
            kinds.append((path, name, f"c{i}_{name[0]}"))
    row = lambda field, problem, n: F.struct(F.lit(field).cast("string").alias("field"), F.lit(problem).alias("problem"), F.col(n).alias("lines"))
    rows = [row(None, "malformed", "malformed"), *[row(*k) for k in kinds]]
    return parsed.agg(*counts).select(F.inline(F.array(*rows)))


def record_schema(lines: DataFrame, value: str = "value") -> DataFrame:
    """(schema): the merged type of all lines that are JSON, found without naming any field."""
    return lines.select(F.try_parse_json(value).alias("v")).agg(F.schema_of_variant_agg("v").alias("schema"))
