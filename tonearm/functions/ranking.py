"""Top-k lists and positions inside groups, shaped so that no task holds an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 256


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rnum") -> DataFrame:
    """`row_number` per group. A `name <= k` filter put directly on top is cut before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def ranked_in_buckets(
    df: DataFrame, group: Sequence[str], buckets: Sequence[tuple[Column, bool]], order: Sequence[Column], name: str = "rnum"
) -> DataFrame:
    """`row_number` of all rows of groups of any size.

    `buckets` (column, descending; missing values come last) cut each group into parts that follow
    each other in `order` and have few values per group. Parts are ranked apart, and a window over
    the sizes of a group's parts tells where each begins, so that a group spreads over as many tasks
    as it has parts.
    """
    marks = [f"_part{i}" for i in range(len(buckets))]
    keys = [*group, *marks]
    rows = df.withColumns({mark: column for mark, (column, _) in zip(marks, buckets)})
    steps = [
        F.desc_nulls_last(mark) if descending else F.asc_nulls_last(mark)
        for mark, (_, descending) in zip(marks, buckets)
    ]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy(*steps).rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    begins = begins.select("_before", *[F.col(k).alias("_of_" + k) for k in keys])
    local = rows.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col("_of_" + k)) for k in keys])
    number = (F.col("_before") + F.col("_local")).cast("int")
    return local.join(begins, same).withColumn(name, number).select(*df.columns, name)


def count_and_name(count: str, name: str) -> list[tuple[Column, bool]]:
    """Parts for the order (count descending, name): counts from 16 on in steps of an eighth of a
    doubling, which grow rare; smaller ones each by itself and by the first two letters of the name."""
    few = F.col(count) < 16
    step = F.when(few, F.col(count)).otherwise(F.floor(F.log2(F.col(count).cast("double")) * 8) - 16)
    return [(step, True), (few & F.col(name).isNull(), False), (F.when(few, F.substring(name, 1, 2)), False)]


def top_list(rank: Column | str, value: Column | str, k: int) -> Column:
    """Aggregate: values of rank 1..k in rank order. A NULL value uses up its rank and is left out."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    value = F.col(value) if isinstance(value, str) else value
    keep = (rank <= k) & value.isNotNull()
    pairs = F.collect_list(F.when(keep, F.struct(rank.alias("r"), value.alias("v"))))
    return F.transform(F.array_sort(pairs), lambda p: p["v"])


def bucket_of(column: Column) -> Column:
    """Even split of an identifier into BUCKETS parts (two hex digits of its digest)."""
    return F.conv(F.substring(F.sha2(column.cast("string"), 256), 1, 2), 16, 10).cast("int")


def running_total(
    df: DataFrame, group: Sequence[str], key: str, amount: Column | int, prefix: str = "upto"
) -> DataFrame:
    """Running total of `amount` per group in (bucket, key) order, and the total of the group.

    Two levels: a window over at most BUCKETS sub-totals per group gives the offsets, a
    window per (group, bucket) gives the rest. So one group of any size spreads over
    BUCKETS tasks instead of being sorted by one.
    """
    group = list(group)
    amount = F.lit(amount) if isinstance(amount, int) else amount
    rows = df.withColumn("_bucket", bucket_of(F.col(key))).withColumn("_amount", amount)
    sums = rows.groupBy(*group, "_bucket").agg(F.sum("_amount").alias("_sum"))
    upto = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = sums.select(
        *group,
        "_bucket",
        F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(whole).alias(prefix + "_all"),
    )
    inner = Window.partitionBy(*group, "_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_local", F.sum("_amount").over(inner))
        .join(offsets, [*group, "_bucket"])
        .withColumn(prefix, F.col("_offset") + F.col("_local"))
        .drop("_bucket", "_amount", "_offset", "_local")
    )


def positions(df: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """Adds `position` (1..n, gap free) and `position_all` (n) per group; `key` is unique in it."""
    return running_total(df, group, key, 1, prefix="position")
