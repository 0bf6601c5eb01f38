"""Global order on a cluster: running totals, surrogate keys and exact quantiles.

A window without a partition (or over one huge partition) runs in a single task. Here the
rows are range-partitioned by the order, each partition is summed on its own, and the
totals of the earlier partitions are added. A range boundary cuts at most one group, so
the offsets are at most as many rows as there are partitions - the only thing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeledger.session import pin


def running_total(
    df: DataFrame, order: list[Column | str], value: str, alias: str, group: list[str] | None = None
) -> DataFrame:
    """Adds ``alias`` = sum of ``value`` up to and including the row, per ``group``.

    ``group + order`` must identify a row; ``value`` should be a long or a decimal, so that
    the result does not depend on the partitioning. The partitioned rows are pinned to the
    checkpoint folder because both passes must see the same partition ids.
    """
    group = group or []
    # adaptive execution merges neighbouring ranges of a small table; their order stays
    cut = pin(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    here = W.partitionBy("_part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = cut.withColumn(alias, F.sum(value).over(here))

    totals = cut.groupBy("_part", *group).agg(F.sum(value).alias("_total"))
    earlier = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    earlier = earlier.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.sum("_total").over(earlier)).filter(F.col("_offset").isNotNull())
    renamed = offsets.select(
        F.col("_part").alias("_opart"), *[F.col(g).alias(f"_o_{g}") for g in group], "_offset"
    )
    same = F.col("_part") == F.col("_opart")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    # at most one row per range partition, so bounded by spark.sql.shuffle.partitions
    joined = local.join(F.broadcast(renamed), same, "left")
    total = F.col(alias) + F.coalesce(F.col("_offset"), F.lit(0))
    return joined.select(*df.columns, total.alias(alias))


def surrogate_keys(values: DataFrame, column: str, key: str) -> DataFrame:
    """1..n over the sorted distinct values of one column."""
    distinct = values.select(column).distinct().withColumn("_one", F.lit(1).cast("long"))
    return running_total(distinct, [column], "_one", key).select(key, column)


def quantiles(df: DataFrame, group: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per (non-null) group: columns ``group``, ``n`` and one per probability.

    Equal values are counted first; the quantile is then read off the running count. No
    group is collected anywhere, unlike with the exact percentile aggregate.
    """
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    counted = present.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_count"))
    running = running_total(counted, [value], "_count", "_upto", group)
    placed = running.join(running.groupBy(*group).agg(F.max("_upto").alias("n")), group)
    picks = []
    for name, p in probabilities.items():
        at = F.lit(p) * (F.col("n") - 1)
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.min(F.when(F.col("_upto") > place, F.col(value))).alias(f"_{name}_{side}"))
    picked = placed.groupBy(*group, "n").agg(*picks)
    result = []
    for name, p in probabilities.items():
        at = F.lit(p) * (F.col("n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        result.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return picked.select(*group, "n", *result)


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group. Spark cuts each map task to ``n`` rows per group before the shuffle."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, time: str, group: list[str] | None = None) -> DataFrame:
    """Row with the largest ``time`` (missing times lose), per group or overall."""
    group = group or []
    rest = [c for c in df.columns if c not in group and c != time]
    newest = df.groupBy(*group).agg(F.max(F.struct(time, *rest)).alias("_row"))
    return newest.select(*group, "_row.*").select(*df.columns)


def latest_two(df: DataFrame, time: str, value: str, group: list[str]) -> DataFrame:
    """Newest and second newest non-null value per group: ``latest``, ``previous``, ``delta``."""
    points = df.filter(F.col(value).isNotNull())
    ranked = points.withColumn("_rn", F.row_number().over(W.partitionBy(*group).orderBy(F.col(time).desc())))
    two = ranked.filter(F.col("_rn") <= 2).groupBy(*group)
    pair = two.agg(
        F.max(F.when(F.col("_rn") == 1, F.col(value))).alias("latest"),
        F.max(F.when(F.col("_rn") == 2, F.col(value))).alias("previous"),
    )
    return pair.withColumn("delta", F.col("latest") - F.col("previous"))
