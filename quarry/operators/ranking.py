"""Ordering operators: ranks within a group, prefixes, top-k, de-duplication.

Ranks are exact and never pull a whole group into one task:

``rank_within`` sorts with a range-partitioned ``orderBy`` (a hot group is
spread over many partitions), writes that order, and turns the
position inside each partition into a rank by adding how many rows of the
same group sit in earlier partitions. The carry table has one row per
(partition, group) pair, so its window runs over at most #partitions rows
per group.

``top_k_within`` / ``prefix_within`` use ``row_number() <= k``, which Spark
plans as a ``WindowGroupLimit``: every map task keeps at most k rows per
group before the shuffle, so the final window sees a bounded group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.execution import bounded_broadcast, kept

_LOCAL_BITS = 33  # monotonically_increasing_id = (partition << 33) + row index


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


# Largest group a single window task may sort (rows). Above it, or when no
# group-size bound is known, ranks are computed by the distributed method.
WINDOW_GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, group_cols: Sequence[str]) -> int:
    """Row count of the biggest group (a partial aggregate plus one max)."""
    if not group_cols:
        return df.count()
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    return int(sizes.agg(F.max("_n")).collect()[0][0] or 0)


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                name: str = "rank", window_rows: int = WINDOW_GROUP_ROWS,
                group_bound: int | None = None, hidden: Sequence[str] = (), made: list[str] | None = None) -> DataFrame:
    """Add a 1-based rank (distinct positions, like row_number) per group.

    ``order_cols`` must make the order total inside a group (end with a
    unique tie-breaker such as ``ord``) for the result to be deterministic.
    Rows with a null group key form one group, on either path.

    Strategy: measure the largest group first. If every group is within
    ``window_rows`` a plain ``row_number`` window is safe (one task per group
    is bounded). Otherwise - a hot query holding a large share of all rows -
    the distributed range-sort method below is used. ``group_bound`` is a
    known upper bound on group size (e.g. the passage count for per-query
    groups of distinct passages); when given it replaces the measurement.
    ``hidden``: columns that only give the order and are left out of the result.
    ``made``: gets the folder of the table that the distributed method writes, if any.
    """
    group_cols = list(group_cols)
    size = group_bound if group_bound is not None else (largest_group(df, group_cols) if group_cols else None)
    if group_cols and size <= window_rows:
        w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
        return df.withColumn(name, F.row_number().over(w).cast("long")).drop(*hidden)
    return _rank_by_range_sort(df, group_cols, order_cols, name, hidden, made)


def rank_by_score(df: DataFrame, group_cols: Sequence[str], score: str = "score", name: str = "rank",
                  window_rows: int = WINDOW_GROUP_ROWS, group_bound: int | None = None, hidden: Sequence[str] = (),
                  made: list[str] | None = None) -> DataFrame:
    """``rank_within`` by score (``score_key``), ties by ``ord``. The rounded score is a
    column: a sort would round anew in every comparison."""
    keyed = df.withColumn("_key", F.round(score, 9))
    return rank_within(keyed, group_cols, [F.col("_key").desc(), F.col("ord")], name, window_rows, group_bound, ["_key", *hidden], made)


def _rank_by_range_sort(df: DataFrame, group_cols: list[str], order_cols: Sequence[str | Column],
                        name: str, hidden: Sequence[str] = (), made: list[str] | None = None) -> DataFrame:
    ordered = df.orderBy(*_cols(group_cols), *_cols(order_cols))
    part = F.spark_partition_id().cast("long")
    tagged, path = kept(ordered.select(
        *[c for c in df.columns if c not in hidden],
        part.alias("_part"),
        (F.monotonically_increasing_id() - F.shiftleft(part, _LOCAL_BITS)).alias("_local"),
    ), "ranked")
    if made is not None:
        made.append(path)
    stats = tagged.groupBy("_part", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_start"))
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    keys = {c: f"_key{i}" for i, c in enumerate(group_cols)}
    stats = stats.select(F.col("_part").alias("_of"), *[F.col(c).alias(k) for c, k in keys.items()], "_start",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))
    same = F.col("_part") == F.col("_of")
    for c, k in keys.items():
        same = same & F.col(c).eqNullSafe(F.col(k))  # a null group is a group
    out = tagged.join(bounded_broadcast(stats), same).withColumn(
        name, (F.col("_carry") + F.col("_local") - F.col("_start") + 1).cast("long"))
    return out.drop("_part", "_of", *keys.values(), "_local", "_start", "_carry")


def global_rank(df: DataFrame, order_cols: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """1-based position in a global order, computed without a single-partition window."""
    return rank_within(df, [], order_cols, name)


def top_k_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                 k: int, name: str = "rank") -> DataFrame:
    """Rows ranked 1..k per group (ranks included); planned as WindowGroupLimit."""
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    return df.withColumn(name, F.row_number().over(w).cast("long")).where(F.col(name) <= k)


def prefix_within(df: DataFrame, group_cols: Sequence[str], k: int, ord_col: str = "ord") -> DataFrame:
    """First k rows per group in input (``ord``) order - not a top-k by score."""
    return top_k_within(df, group_cols, [ord_col], k, name="_prefix_pos").drop("_prefix_pos")


def first_wins(df: DataFrame, key_cols: Sequence[str], ord_col: str = "ord") -> DataFrame:
    """Keep, per key, the row with the smallest ``ord``.

    ``min_by`` is an ordinary aggregate, so it combines map-side: a key with
    millions of copies leaves each map task as one row.
    """
    key_cols = list(key_cols)
    rest = [c for c in df.columns if c not in key_cols]
    packed = F.min_by(F.struct(*rest), F.col(ord_col)).alias("_first")
    return df.groupBy(*key_cols).agg(packed).select(*key_cols, *[F.col(f"_first.{c}").alias(c) for c in rest])


def score_key(score: str | Column = "score", digits: int = 9) -> Column:
    """Descending sort key for scores.

    Distributed sums add terms in arrival order, so equal scores may differ
    in the last bits from run to run; rounding to ``digits`` places makes
    ties (then broken by ``ord``) reproducible.
    """
    c = F.col(score) if isinstance(score, str) else score
    return F.round(c, digits).desc()
