"""Semantic marts over the published table, and the analyses built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.scalars import month_key, month_key_from_parts, try_number
from tradeledger.functions.stable import share, stable_avg, stable_total
from tradeledger.operators.ordered import running_total
from tradeledger.plans.shared import State, double_mean, double_states, double_sum, rows_where, share as share_groups

MONEY = "decimal(38,6)"


def _mart(df: DataFrame, by: list[str], **measures) -> DataFrame:
    return df.groupBy(*by).agg(*[column.alias(name) for name, column in measures.items()]).orderBy(*by)


def _items():
    return F.count("order_item_id")


def _delayed():
    return share(F.col("is_delayed"))


def logistics_mart(df: DataFrame) -> DataFrame:
    return _mart(
        df,
        ["order_year", "order_month", "customer_state", "seller_state"],
        total_items=_items(),
        delayed_rate=_delayed(),
        avg_delivery_time_days=stable_avg("delivery_time_days"),
        avg_dispatch_time_days=stable_avg("seller_dispatch_time_days"),
        avg_carrier_time_days=stable_avg("carrier_delivery_time_days"),
        avg_freight_to_price_ratio=stable_avg("freight_to_price_ratio"),
    )


def seller_mart(df: DataFrame) -> DataFrame:
    mart = _mart(
        df,
        ["seller_key", "seller_state", "seller_volume_tier"],
        total_items=_items(),
        seller_order_count=F.max("seller_order_count"),
        avg_ticket=stable_avg("total_item_value"),
        avg_delivery_time_days=F.max("seller_avg_delivery_days"),
        delay_rate=F.max("seller_delay_rate"),
        avg_review_score=stable_avg("review_score_mean"),
    )
    return mart.orderBy("seller_volume_tier", "seller_key")


def cohort_mart(df: DataFrame, cohort: str = "order_month") -> DataFrame:
    """Customers, orders and ticket per cohort and month offset.

    ``order_month`` names a cohort after the month of the order itself, the convention of
    the published column. ``first_purchase`` is the textbook cohort: the month of the
    customer's first purchase, which is the order month moved back by the offset.
    """
    if cohort == "first_purchase":
        month = F.make_date("order_year", "order_month", F.lit(1))
        first = F.date_format(F.add_months(month, -F.col("cohort_order_month_number")), "yyyy-MM")
        df = df.withColumn("purchase_cohort_month", first)
    elif cohort != "order_month":
        raise ValueError(f"unknown cohort definition: {cohort}")
    return _mart(
        df,
        ["purchase_cohort_month", "cohort_order_month_number"],
        customers=F.countDistinct("customer_unique_id"),
        orders=F.countDistinct("order_id"),
        items=_items(),
        avg_ticket=stable_avg("total_item_value"),
        delayed_rate=_delayed(),
    )


def category_mart(df: DataFrame) -> DataFrame:
    return _mart(
        df,
        ["order_year", "order_month", "product_category_name_english", "payment_type_mode"],
        orders=F.countDistinct("order_id"),
        items=_items(),
        revenue=stable_total("total_item_value"),
        avg_ticket=stable_avg("total_item_value"),
        delayed_rate=_delayed(),
        avg_review_score=stable_avg("review_score_mean"),
        avg_freight_to_price_ratio=stable_avg("freight_to_price_ratio"),
    )


def state_mart(df: DataFrame) -> DataFrame:
    return _mart(
        df,
        ["order_year", "order_month", "customer_state"],
        orders=F.countDistinct("order_id"),
        items=_items(),
        active_sellers=F.countDistinct("seller_key"),
        revenue=stable_total("total_item_value"),
        avg_ticket=stable_avg("total_item_value"),
        delayed_rate=_delayed(),
        avg_delivery_time_days=stable_avg("delivery_time_days"),
        avg_review_score=stable_avg("review_score_mean"),
    )


MARTS = {
    "logistics_slice": logistics_mart,
    "seller_slice": seller_mart,
    "cohort_slice": cohort_mart,
    "category_slice": category_mart,
    "state_performance_slice": state_mart,
}


MART_GRAINS = {
    "logistics_slice": ["order_year", "order_month", "customer_state", "seller_state"],
    "seller_slice": ["seller_key", "seller_state", "seller_volume_tier"],
    "cohort_slice": ["purchase_cohort_month", "cohort_order_month_number"],
    "category_slice": ["order_year", "order_month", "product_category_name_english", "payment_type_mode"],
    "state_performance_slice": ["order_year", "order_month", "customer_state"],
}


def shared_marts(df: DataFrame) -> dict[str, DataFrame]:
    """All marts of the published table from two scans of it; the rows are those of ``MARTS``."""
    keys = {k: F.col(k) for k in dict.fromkeys(k for own in MART_GRAINS.values() for k in own)}
    states = {
        "rows": State(F.lit(1).cast("long"), "count"),
        "items": rows_where(F.col("order_item_id").isNotNull()),
        "delayed": rows_where(F.col("is_delayed")),
    }
    for name in ("seller_order_count", "seller_avg_delivery_days", "seller_delay_rate"):
        states[name] = State(F.col(name), "max")
    means = ("delivery_time_days", "seller_dispatch_time_days", "carrier_delivery_time_days", "freight_to_price_ratio", "total_item_value", "review_score_mean")
    for name in means:
        states |= double_states(name, name)
    distinct = {
        "orders": (F.col("order_id"), ["cohort_slice", "category_slice", "state_performance_slice"]),
        "customers": (F.col("customer_unique_id"), ["cohort_slice"]),
        "active_sellers": (F.col("seller_key"), ["state_performance_slice"]),
    }
    groups = share_groups(df, keys, MART_GRAINS, states, distinct, cells=False)
    col, late = F.col, F.col("delayed").cast("double") / F.col("rows")
    revenue = F.coalesce(double_sum("total_item_value"), F.lit(0.0))
    measures = {
        "logistics_slice": {
            "total_items": col("items"), "delayed_rate": late, "avg_delivery_time_days": double_mean("delivery_time_days"),
            "avg_dispatch_time_days": double_mean("seller_dispatch_time_days"), "avg_carrier_time_days": double_mean("carrier_delivery_time_days"),
            "avg_freight_to_price_ratio": double_mean("freight_to_price_ratio"),
        },
        "seller_slice": {
            "total_items": col("items"), "seller_order_count": col("seller_order_count"), "avg_ticket": double_mean("total_item_value"),
            "avg_delivery_time_days": col("seller_avg_delivery_days"), "delay_rate": col("seller_delay_rate"), "avg_review_score": double_mean("review_score_mean"),
        },
        "cohort_slice": {
            "customers": col("customers"), "orders": col("orders"), "items": col("items"), "avg_ticket": double_mean("total_item_value"), "delayed_rate": late,
        },
        "category_slice": {
            "orders": col("orders"), "items": col("items"), "revenue": revenue, "avg_ticket": double_mean("total_item_value"), "delayed_rate": late,
            "avg_review_score": double_mean("review_score_mean"), "avg_freight_to_price_ratio": double_mean("freight_to_price_ratio"),
        },
        "state_performance_slice": {
            "orders": col("orders"), "items": col("items"), "active_sellers": col("active_sellers"), "revenue": revenue,
            "avg_ticket": double_mean("total_item_value"), "delayed_rate": late, "avg_delivery_time_days": double_mean("delivery_time_days"),
            "avg_review_score": double_mean("review_score_mean"),
        },
    }
    made = {}
    for name, own in measures.items():
        by = MART_GRAINS[name]
        rows = groups.grain(by).select(*by, *[c.alias(n) for n, c in own.items()])
        made[name] = rows.orderBy(*(["seller_volume_tier", "seller_key"] if name == "seller_slice" else by))
    return made


# ---- analyses ------------------------------------------------------------


def executive_kpis(published: DataFrame) -> DataFrame:
    """Revenue, orders, revenue per order and active sellers in one row."""
    totals = published.agg(
        stable_total(try_number("total_item_value")).alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("seller_key").alias("active_sellers"),
    )
    return totals.withColumn("average_ticket", F.try_divide("revenue", "orders"))


def monthly_revenue(df: DataFrame) -> DataFrame:
    """Revenue per month; the month comes from a ready column, year + month, or the purchase time."""
    if "order_year_month" in df.columns:
        month = F.col("order_year_month")
    elif {"order_year", "order_month"} <= set(df.columns):
        month = month_key_from_parts("order_year", "order_month")
    elif "order_purchase_timestamp" in df.columns:
        month = month_key("order_purchase_timestamp")
    else:
        raise ValueError("no column to derive the month from")
    grouped = df.groupBy(month.alias("order_year_month"))
    return grouped.agg(stable_total("total_item_value").alias("revenue")).orderBy("order_year_month")


def filtered_sellers(sellers: DataFrame, tier: str | None = None, state: str | None = None) -> DataFrame:
    if tier is not None:
        sellers = sellers.filter(F.col("seller_volume_tier") == tier)
    if state is not None:
        sellers = sellers.filter(F.col("seller_state") == state)
    return sellers


def seller_sla(sellers: DataFrame) -> DataFrame:
    """Per tier: sellers, mean delay rate in percent, mean delivery time (means over seller rows)."""
    return sellers.groupBy("seller_volume_tier").agg(
        F.count(F.lit(1)).alias("sellers"),
        (stable_avg("delay_rate") * 100).alias("avg_delay_rate"),
        stable_avg("avg_delivery_time_days").alias("avg_delivery_days"),
    )


def seller_headline(sellers: DataFrame) -> DataFrame:
    return sellers.agg(
        F.countDistinct("seller_key").alias("sellers"),
        F.coalesce(F.sum(F.coalesce("seller_order_count", F.lit(0))), F.lit(0)).alias("orders"),
        (stable_avg("delay_rate") * 100).alias("avg_delay_rate"),
        stable_avg("avg_delivery_time_days").alias("avg_delivery_days"),
    )


def top_sellers(published: DataFrame, n: int = 15) -> DataFrame:
    revenue = published.groupBy("seller_key").agg(stable_total("total_item_value").alias("total_item_value"))
    return revenue.orderBy(F.desc("total_item_value"), "seller_key").limit(n)


def seller_ranking(sellers: DataFrame, n: int = 20) -> DataFrame:
    """Sellers by estimated revenue = mean item value x orders."""
    estimate = F.coalesce("avg_ticket", F.lit(0.0)) * F.coalesce("seller_order_count", F.lit(0))
    ranked = sellers.withColumn("estimated_revenue", estimate)
    return ranked.orderBy(F.desc("estimated_revenue"), "seller_key", "seller_state").limit(n)


def category_pareto(categories: DataFrame, cut: float = 80.0) -> tuple[DataFrame, DataFrame]:
    """Categories by revenue with cumulative percent, and the number of them up to ``cut`` (at least 1).

    Revenue is kept as a decimal here: running totals of doubles would depend on how the
    rows were partitioned.
    """
    revenue = categories.groupBy(F.coalesce("product_category_name_english", F.lit("unknown")).alias("category"))
    revenue = revenue.agg(F.sum(F.col("revenue").cast(MONEY)).cast("decimal(28,6)").alias("revenue"))
    running = running_total(revenue, [F.desc("revenue"), "category"], "revenue", "_upto")
    total = running.agg(F.sum("revenue").cast("double").alias("_total")).scalar()
    percent = F.try_divide(F.col("_upto").cast("double"), total) * 100
    pareto = running.select(
        "category",
        F.col("revenue").cast("double").alias("revenue"),
        F.when(total > 0, percent).otherwise(0.0).alias("cum_pct"),
    )
    within = F.count(F.when(F.col("cum_pct") <= cut, 1))
    return pareto, pareto.agg(F.greatest(F.lit(1), within).cast("long").alias("categories"))
