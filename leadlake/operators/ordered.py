"""Order-dependent operators that stay exact when one key holds a large share of all rows.

First, last and top-k per key need no care: `row_number() <= k` is cut per task before the shuffle (WindowGroupLimit).
Previous-value and running-number operators must see every row of a key. The rows of each key are therefore split into slices
that follow the order, each slice is one window group, and the slices are tied together by one small row per slice. That is one
plan for every key and size: rows are shuffled once, slice ends twice. Slice ends of previous values are as wide as the rows, and
where keys are short nearly every row is one; so there only keys in crowded buckets are sliced, and buckets are counted first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.session import collect_once


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int = 1,
               rank_as: str | None = None) -> DataFrame:
    """The first `limit` rows per key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col("_rank") <= limit)
    return ranked.withColumnRenamed("_rank", rank_as) if rank_as else ranked.drop("_rank")


KEY_BUCKETS = 4_096
HOT_ROWS = 100_000


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))


def _hot_buckets(df: DataFrame, keys: Sequence[str], hot_rows: int) -> list[int]:
    """Buckets that may hold a key of very many rows: over `hot_rows` rows in them, and four times the mean of all buckets.

    Buckets are counted, not keys, so the count is cut per task to one row per bucket, and at most KEY_BUCKETS numbers come back.
    """
    sizes = df.groupBy(_bucket(keys).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    limit = F.greatest(F.lit(hot_rows), F.sum("_rows").over(Window.partitionBy(F.lit(1))) * 4 / KEY_BUCKETS)
    return [row[0] for row in collect_once(sizes.withColumn("_limit", limit).where("_rows > _limit").select("_bucket"))]


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], slice_by: Column,
                  alias: str = "previous", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add a struct of `values` from the row before in `order` within `keys`; NULL struct for the first row.

    `slice_by` must not decrease along `order`. `order` must be unique within `keys`. Runs one job that counts rows: only keys in
    hot buckets (see `_hot_buckets`) are sliced, and which ones are changes no result. Pass a stored frame if `df` is costly.
    """
    hot = _hot_buckets(df, keys, hot_rows)
    rows, groups, sequence = df, list(keys), list(order)
    if hot:
        is_hot = _bucket(keys).isin(hot)
        # Last value of each slice, handed to the next slice that has rows, as a row before its first one.
        ends = df.where(is_hot).withColumn("_slice", slice_by).groupBy(*keys, "_slice").agg(
            F.max_by(F.struct(*values), F.struct(*order)).alias("_carry"))
        following = F.lead(F.struct("_slice")).over(Window.partitionBy(*keys).orderBy("_slice"))
        carried = ends.withColumn("_next", following).where(F.col("_next").isNotNull()).select(
            *keys, F.col("_next._slice").alias("_slice"), "_carry.*", F.lit(0).alias("_is_row"))
        rows = df.withColumns({"_slice": F.when(is_hot, slice_by), "_is_row": F.lit(1)}).unionByName(carried, allowMissingColumns=True)
        groups, sequence = [*groups, "_slice"], ["_is_row", *sequence]
    within = Window.partitionBy(*groups).orderBy(*sequence)
    # Values are looked up one by one: a struct of them would be shuffled beside them.
    before = F.struct(*[F.lag(value).over(within).alias(value) for value in values])
    rows = rows.withColumn(alias, F.when(F.lag(F.lit(1)).over(within).isNotNull(), before))
    return rows.where(F.col("_is_row") == 1).drop("_slice", "_is_row") if hot else rows


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column, alias: str = "position",
                  starts: DataFrame | None = None) -> DataFrame:
    """Add the position of each row within `keys` in `order`, counted slice by slice. `slice_by` must not decrease along `order`.

    Positions begin at zero, or at the key's `start` in `starts` (keys, start; one row per key).
    """
    sliced = df.withColumn("_slice", slice_by)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*keys, "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    if starts is not None:
        # Starts meet the one row per slice, never the rows themselves.
        bases = bases.join(starts.select(*keys, F.col("start").alias("_from")), list(keys), "left").select(
            *keys, "_slice", (F.col("_base") + F.coalesce("_from", F.lit(0))).alias("_base"))
    # The base rides along as one extra leading row per slice, so the rows themselves are shuffled once.
    rows = sliced.withColumns({"_is_row": F.lit(1), "_base": F.lit(None).cast("long")})
    within = Window.partitionBy(*keys, "_slice").orderBy("_is_row", *order)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.unionByName(bases.withColumn("_is_row", F.lit(0)), allowMissingColumns=True).withColumns({
        "_count": F.sum("_is_row").over(so_far),
        "_start": F.first("_base").over(so_far),
    })
    return numbered.where(F.col("_is_row") == 1).withColumn(
        alias, F.col("_count") - 1 + F.col("_start")).drop("_slice", "_is_row", "_base", "_count", "_start")
