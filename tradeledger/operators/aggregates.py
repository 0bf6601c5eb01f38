"""Order-grain and seller-grain aggregates that feed the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.scalars import bins
from tradeledger.functions.stable import MILLION, stable_sum, stable_total

# Tier names and the upper bounds of the first three tiers.
TIER_LABELS = ("long_tail", "scaled", "core", "strategic")
TIER_BOUNDS = (25, 100, 500)


def payments_by_order(payments: DataFrame, null_total_as_zero: bool = True) -> DataFrame:
    total = stable_total if null_total_as_zero else stable_sum
    return payments.groupBy("order_id").agg(
        F.count("payment_sequential").alias("payment_count"),
        total("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("max_payment_installments"),
        # most frequent type; the smallest one on a tie; nulls do not vote
        F.mode("payment_type", deterministic=True).alias("payment_type_mode"),
    )


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    commented = F.trim(F.coalesce(F.col("review_comment_message"), F.lit(""))) != ""
    return reviews.groupBy("order_id").agg(
        F.count("review_id").alias("review_count"),
        F.avg("review_score").alias("review_score_mean"),
        F.max("review_score").alias("review_score_max"),
        F.min("review_score").alias("review_score_min"),
        F.max("review_creation_date").alias("latest_review_creation_date"),
        F.max("review_answer_timestamp").alias("latest_review_answer_timestamp"),
        F.max(F.when(commented, 1).otherwise(0)).alias("has_review_comment"),
    )


def _weighted_mean(value: Column, weight: Column) -> Column:
    first = (value - F.floor(value)) * MILLION
    second = (first - F.floor(first)) * MILLION
    total = F.sum(F.floor(value) * weight) + (
        F.sum(F.floor(first) * weight) + F.sum(F.floor(second) * weight) / MILLION
    ) / MILLION
    return total / F.greatest(F.sum(F.when(value.isNotNull(), weight)), F.lit(1))


def seller_metrics(
    items: DataFrame,
    orders: DataFrame,
    delivery_days: Column,
    delayed: Column,
    tier_bounds: tuple[int, ...] = TIER_BOUNDS,
    copies: str | None = None,
) -> DataFrame:
    """Orders, mean delivery time and delay rate per seller, over item rows.

    ``copies`` names a column that says how many item rows a row stands for.

    Items are first counted per (seller, order). That makes the distinct order count a
    plain count, shrinks the input of the join, and spreads a dominant seller over all
    its orders before anything is grouped by seller.
    """
    size = F.count(F.lit(1)) if copies is None else F.sum(copies)
    per_order = items.groupBy("seller_id", "order_id").agg(size.alias("_items"))
    dated = per_order.join(
        orders.select("order_id", delivery_days.alias("_days"), delayed.alias("_late")), "order_id", "left"
    )
    weight = F.col("_items")
    late = F.coalesce(F.col("_late"), F.lit(False))
    per_seller = dated.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("seller_order_count"),
        _weighted_mean(F.col("_days"), weight).alias("seller_avg_delivery_days"),
        (F.sum(F.when(late, weight).otherwise(0)) / F.sum(weight)).alias("seller_delay_rate"),
    )
    return per_seller.withColumn("seller_volume_tier", bins("seller_order_count", tier_bounds, TIER_LABELS))
