"""Running aggregates over ordered groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.session import broadcast_if_small, materialize

# Width of one segment of the ordering column. A group is never held by fewer
# tasks than it has segments, however large it grows.
SEGMENT = 100_000

# Rows a group may have and still be ordered by a single task.
HOT_GROUP = 1_000_000

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int = HOT_GROUP) -> DataFrame | None:
    """Keys of groups with more than ``limit`` rows, or None when there are none.

    The count reads only the key columns and combines map-side. At most one key per ``limit``
    input rows can come back.
    """
    hot = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > limit).select(*keys)
    return None if hot.isEmpty() else materialize(hot, "hot-groups")


def split_hot(df: DataFrame, keys: Sequence[str], limit: int = HOT_GROUP) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups or None)."""
    hot = hot_groups(df, keys, limit)
    if hot is None:
        return df, None
    hot = broadcast_if_small(hot)
    return df.join(hot, list(keys), "left_anti"), materialize(df.join(hot, list(keys), "left_semi"), "hot-rows")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    aggs: Mapping[str, tuple[str, Column]],
    limit: int = HOT_GROUP,
    segment: int = SEGMENT,
) -> DataFrame:
    """Adds running ``sum``/``max``/``min`` columns per ``keys`` in ``order`` (current row included).

    Ordinary groups use a window. Groups with more than ``limit`` rows are cut into segments.
    """
    usual, hot = split_hot(df, keys, limit)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cols = [
        (F.coalesce(F.sum(x).over(w), F.lit(0)) if kind == "sum" else _AGG[kind](x).over(w)).alias(name)
        for name, (kind, x) in aggs.items()
    ]
    out = usual.select(*df.columns, *cols)
    return out if hot is None else out.unionByName(running_segments(hot, keys, order, aggs, segment))


def running_segments(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    aggs: Mapping[str, tuple[str, Column]],
    segment: int = SEGMENT,
) -> DataFrame:
    """Adds running ``sum``/``max``/``min`` columns per ``keys`` in ``order`` (current row included).

    A plain window would put a whole group into one task. Here the window runs inside
    fixed-width segments of the group; what earlier segments contribute is a tiny
    per-segment total that is carried over by a join. ``order`` must be an integer and
    unique within a group.
    """
    seg = "_segment"
    values = {name: f"_in_{name}" for name in aggs}
    part = df.withColumn(seg, F.floor(F.col(order) / segment).cast("bigint"))
    for name, (_, expr) in aggs.items():
        part = part.withColumn(values[name], expr)

    within = Window.partitionBy(*keys, seg).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)

    totals = part.groupBy(*keys, seg).agg(
        *[_AGG[kind](values[name]).alias(f"_total_{name}") for name, (kind, _) in aggs.items()]
    )
    carry = totals.select(
        *keys,
        seg,
        F.row_number().over(Window.partitionBy(*keys).orderBy(seg)).alias("_nth"),
        *[_AGG[kind](f"_total_{name}").over(before).alias(f"_carry_{name}") for name, (kind, _) in aggs.items()],
    ).filter("_nth > 1")

    out = part.select(
        *df.columns,
        seg,
        *[_AGG[kind](values[name]).over(within).alias(f"_here_{name}") for name, (kind, _) in aggs.items()],
    ).join(carry, [*keys, seg], "left")
    merged = []
    for name, (kind, _) in aggs.items():
        here, past = F.col(f"_here_{name}"), F.col(f"_carry_{name}")
        if kind == "sum":
            merged.append((F.coalesce(here, F.lit(0)) + F.coalesce(past, F.lit(0))).alias(name))
        else:
            merged.append((F.greatest(here, past) if kind == "max" else F.least(here, past)).alias(name))
    return out.select(*df.columns, *merged)


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``, the 1-based place of each row within ``keys`` by ``order``, for groups of any size.

    Rows are dealt out by range of keys and order, so a large group lies in several ranges; each range is numbered
    for itself, and what the ranges before hold of its group is added. Rows must differ in keys or order, and have all keys.
    """
    dealt = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_rows"))
    ahead = counts.select(*keys, "_range", F.sum("_rows").over(before).alias("_ahead"))
    placed = dealt.withColumn("_here", F.row_number().over(within)).join(ahead, [*keys, "_range"])
    return placed.select(*df.columns, (F.col("_here") + F.coalesce("_ahead", F.lit(0))).cast("bigint").alias(name))
