"""Distinct counts and overlaps from stored sketches.

A sketch per group is aggregated once and kept as a column. Later questions (any union of groups, what two groups share) merge sketches
and never read the rows again. Merging is exact: a union's sketch is the one of all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Both kinds keep 2^14 registers or hashes.
LG_SIZE = 14
#: Relative bounds that hold in 99.7 % of cases (three standard errors): of the HyperLogLog estimate, and of what a union of the
#: hashed samples holds. Up to 2^14 distinct values the hashed samples are whole and their counts exact.
HLL_BOUND = 3 * 0.8326 / 2 ** (LG_SIZE / 2)
THETA_BOUND = 3 / 2 ** (LG_SIZE / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, hll, theta): one row per group; each task sends one sketch of bounded size per group. Null values do not count."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.hll_sketch_agg(value, LG_SIZE).alias("hll"), F.theta_sketch_agg(value, LG_SIZE).alias("theta")
    )


def united(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*keys).agg(
        F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta", LG_SIZE).alias("theta")
    )


def estimates(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, hll_distinct, theta_distinct) of every row of sketches."""
    return sketches.select(
        *keys, F.hll_sketch_estimate("hll").alias("hll_distinct"), F.theta_sketch_estimate("theta").alias("theta_distinct")
    )


def shared(sketches: DataFrame, key: str) -> DataFrame:
    """(left_set, right_set, shared, together): estimated overlaps of every two groups, from one row of sketches per group.

    Meant for named sets (splits, kinds, brands of a report): the sketches are joined on the order of the names, groups x groups rows.
    ``together`` is the estimated union, by which the error of ``shared`` is bounded.
    """
    left = sketches.select(F.col(key).alias("left_set"), F.col("theta").alias("a"))
    right = sketches.select(F.col(key).alias("right_set"), F.col("theta").alias("b"))
    both = left.join(right, F.col("left_set") < F.col("right_set"))
    return both.select(
        "left_set", "right_set", F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("shared"),
        F.theta_sketch_estimate(F.theta_union("a", "b", LG_SIZE)).alias("together"),
    )


def within(estimate: Column, exact: Column, bound: float, of: Column | None = None) -> Column:
    """Whether an estimate differs from the exact count by no more than ``bound`` times it, or times ``of``."""
    return F.abs(estimate - exact) <= F.lit(bound) * (exact if of is None else of) + 0.5
