"""Customer history: first purchase, month offset, order sequence, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeledger.operators.joins import left_join_m1


def first_purchase(orders: DataFrame) -> DataFrame:
    """Earliest purchase per known customer (aggregate, joined back by the caller)."""
    known = orders.filter(F.col("customer_unique_id").isNotNull())
    return known.groupBy("customer_unique_id").agg(
        F.min("order_purchase_timestamp").alias("customer_first_purchase_timestamp")
    )


def purchase_sequence(orders: DataFrame) -> DataFrame:
    """Dense rank of the purchase time within each customer; unknown customers form one group.

    ``orders`` has one row per order. Equal times of a customer share a rank, so the work is
    done on distinct (customer, time). The rank is counted in two steps - distinct times on
    earlier days, plus the rank within the day - so no task ever holds more than one day of a
    customer (or of the unknown group), however large that group is. The customer is kept
    in a struct because a struct around null is itself not null and joins by plain equality.
    """
    dated = orders.filter(F.col("order_purchase_timestamp").isNotNull())
    times = dated.select(F.struct("customer_unique_id").alias("customer_group"), "order_purchase_timestamp").distinct()
    times = times.withColumn("_day", F.to_date("order_purchase_timestamp"))
    in_day = W.partitionBy("customer_group", "_day").orderBy("order_purchase_timestamp")
    ranked = times.withColumn("_rank", F.row_number().over(in_day))
    per_day = ranked.groupBy("customer_group", "_day").agg(F.max("_rank").alias("_times"))
    before = W.partitionBy("customer_group").orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    per_day = per_day.select(
        "customer_group", "_day", F.coalesce(F.sum("_times").over(before), F.lit(0)).alias("_earlier")
    )
    ranked = ranked.join(per_day, ["customer_group", "_day"])
    # re-keyed by an aggregate so that the join back is known not to multiply orders
    return ranked.groupBy("customer_group", "order_purchase_timestamp").agg(
        F.min(F.col("_earlier") + F.col("_rank")).alias("customer_order_sequence")
    )


def with_purchase_history(orders: DataFrame, number_unknown: bool = True) -> DataFrame:
    """``orders`` with the columns of `first_purchase` and `purchase_sequence` over these same rows.

    Unknown customers are numbered as one group, or not at all. ``orders`` has one row per order, all
    with a purchase time. The rows are dealt out once, by customer and day; each day's number of times
    and first time go on to the customer and come back. Equal times are ordered by all other columns,
    so that both readers of that shuffle read the same columns and it is written a single time.
    """
    day = F.struct("customer_unique_id", F.to_date("order_purchase_timestamp").alias("day"))
    dated = orders.withColumn("_day", day).drop("customer_unique_id")
    rest = [c for c in orders.columns if c not in ("customer_unique_id", "order_purchase_timestamp")]
    in_day = W.partitionBy("_day").orderBy("order_purchase_timestamp", *rest)
    repeated = F.lag("order_purchase_timestamp").over(in_day) == F.col("order_purchase_timestamp")
    marked = dated.withColumn("_new", F.when(repeated, 0).otherwise(1))
    ranked = marked.withColumn("_rank", F.sum("_new").over(in_day.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_new")

    per_day = ranked.groupBy("_day").agg(F.max("_rank").alias("_times"), F.min("order_purchase_timestamp").alias("_first"))
    # a struct around null is itself not null, so unknown customers are a group like any other
    per_day = per_day.withColumn("_group", F.struct("_day.customer_unique_id"))
    by_day = W.partitionBy("_group").orderBy("_day")
    days = per_day.select(
        "_day",
        F.coalesce(F.sum("_times").over(by_day.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"),
        F.min("_first").over(by_day.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_first"),
    )
    joined = left_join_m1(ranked, days, ["_day"], keyed=True).withColumn("customer_unique_id", F.col("_day.customer_unique_id"))
    known = F.col("customer_unique_id").isNotNull()
    return joined.select(
        *orders.columns,
        F.when(known, F.col("_first")).alias("customer_first_purchase_timestamp"),
        F.when(known | F.lit(number_unknown), F.col("_earlier") + F.col("_rank")).alias("customer_order_sequence"),
    )


def retention(cohorts: DataFrame) -> DataFrame:
    """Cohort rows with the customers of month 0 and the retention rate in percent."""
    base = cohorts.filter(F.col("cohort_order_month_number") == 0).groupBy("purchase_cohort_month")
    baseline = base.agg(F.sum("customers").alias("baseline_customers"))
    joined = cohorts.join(baseline, "purchase_cohort_month", "left")
    return joined.withColumn(
        "retention_rate", F.try_divide(F.col("customers"), F.col("baseline_customers")) * 100
    )


def pivot_by_offset(cohorts: DataFrame, value: str, offsets: list[int] | None = None) -> DataFrame:
    """Cohort month x month offset matrix of the mean of ``value``; columns are `m<offset>`.

    ``offsets=None`` finds the offsets present; the calendar bounds their number.
    """
    numbered = cohorts.withColumn(
        "_offset", F.concat(F.lit("m"), F.coalesce("cohort_order_month_number", F.lit(0)).cast("string"))
    )
    grouped = numbered.groupBy("purchase_cohort_month")
    columns = None if offsets is None else [f"m{o}" for o in offsets]
    return grouped.pivot("_offset", columns).agg(F.avg(value))
