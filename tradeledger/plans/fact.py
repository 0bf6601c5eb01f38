"""The item-grain wide fact.

Shape of the plan: everything that belongs to an order (customer, history, payments,
reviews) is joined at order grain first, where keys are unique and rows are few. The customer
and the history are found from the keys of the orders alone. The item table is shuffled once, by
order: copies and repeated grains are merged, the sellers' orders counted and the order's columns
joined on that shuffle. Products, and sellers that are too many to be broadcast, are found from
pairs of order and key. Every right side is an aggregate keyed by its join key, so a query that
reads only a few fact columns loses the joins it does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeledger.functions.scalars import (
    days_between,
    later_than,
    month_key,
    month_offset,
    plus_null_as_zero,
    ratio_if_positive,
    whole_days_between,
)
from tradeledger.operators import aggregates as agg
from tradeledger.operators import cleaning as cl
from tradeledger.operators.cohorts import with_purchase_history
from tradeledger.operators.joins import few_keys, left_join_m1
from tradeledger.session import stage
from tradeledger.sources.commerce import Commerce

PURCHASE = "order_purchase_timestamp"
APPROVED = "order_approved_at"
CARRIER = "order_delivered_carrier_date"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"

# Sellers (about 200 bytes each) and category names up to these numbers are broadcast.
BROADCAST_SELLERS = 500_000
BROADCAST_CATEGORIES = 100_000

FACT_COLUMNS = [
    "order_id", "order_item_id", "customer_id", "customer_unique_id", "product_id", "seller_id",
    "order_status", PURCHASE, APPROVED, "shipping_limit_date", CARRIER, DELIVERED, ESTIMATED,
    "order_date", "order_year", "order_month", "purchase_cohort_month",
    "customer_first_purchase_timestamp", "cohort_order_month_number", "customer_order_sequence",
    "is_first_order", "delivery_time_days", "seller_dispatch_time_days", "carrier_delivery_time_days",
    "estimated_delay_days", "is_delayed", "price", "freight_value", "freight_to_price_ratio",
    "total_item_value", "payment_count", "total_payment_value", "max_payment_installments",
    "payment_type_mode", "review_count", "review_score_mean", "review_score_max", "review_score_min",
    "has_review_comment", "latest_review_creation_date", "latest_review_answer_timestamp",
    "product_category_name", "product_category_name_english", "product_name_lenght",
    "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm",
    "product_height_cm", "product_width_cm", "customer_zip_code_prefix", "customer_city",
    "customer_state", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_order_count",
    "seller_avg_delivery_days", "seller_delay_rate", "seller_volume_tier",
]


def _with_history(orders: DataFrame, purchases: DataFrame, t: Commerce, number_unknown: bool) -> DataFrame:
    """Customer and history columns of the orders; only the orders of ``purchases`` count.

    An order without purchase time finds none: it is no purchase, and none of its rows stays in the fact.
    """
    dated = purchases.filter(F.col(PURCHASE).isNotNull()).select("order_id", "customer_id", PURCHASE)
    owned = left_join_m1(dated, cl.clean_customers(t.customers), ["customer_id"], keyed=True).drop("customer_id")
    history = with_purchase_history(owned, number_unknown).drop(PURCHASE)
    return left_join_m1(orders, history, ["order_id"], keyed=True)


def _order_calendar(orders: DataFrame, duration) -> DataFrame:
    return orders.withColumns(
        {
            "order_date": F.to_date(PURCHASE),
            "order_year": F.year(PURCHASE),
            "order_month": F.month(PURCHASE),
            "purchase_cohort_month": month_key(PURCHASE),
            "cohort_order_month_number": month_offset("customer_first_purchase_timestamp", PURCHASE),
            "is_first_order": F.col("customer_order_sequence") == 1,
            "delivery_time_days": duration(PURCHASE, DELIVERED),
            "seller_dispatch_time_days": duration(APPROVED, CARRIER),
            "carrier_delivery_time_days": duration(CARRIER, DELIVERED),
            "estimated_delay_days": duration(ESTIMATED, DELIVERED),
            "is_delayed": later_than(DELIVERED, ESTIMATED),
        }
    )


def _looked_up(rows: DataFrame, valid: DataFrame, sides: list[DataFrame], key: str) -> DataFrame:
    """``rows``, which lie by order, with the columns that ``sides`` have for their ``key``.

    Only pairs (order_id, ``key``) of the items go to the sides. What they find goes to the partition of the
    order, where each row takes it from its pair. That is a union, as two tables by order lie by order
    together; a join over both columns would shuffle both sides again.
    """
    found = valid.select("order_id", key)
    for side in sides:
        found = left_join_m1(found, side, [key], keyed=True)
    columns = [c for c in found.columns if c not in ("order_id", key)]
    own = [c for c in rows.columns if c not in ("order_id", key)]
    packed = rows.select("order_id", key, F.struct(*own).alias("_row"))
    both = found.repartition("order_id").unionByName(packed, allowMissingColumns=True)
    pair = W.partitionBy("order_id", key).orderBy(F.col("_row").isNotNull())
    pair = pair.rowsBetween(W.unboundedPreceding, W.currentRow)
    taken = both.withColumns({c: F.first(c).over(pair) for c in columns}).filter(F.col("_row").isNotNull())
    return taken.select("order_id", key, "_row.*", *columns)


def _enrich(valid: DataFrame, items: DataFrame, orders: DataFrame, t: Commerce, metrics: DataFrame) -> DataFrame:
    """The item table joined to the product, translation, seller, metric and order sides.

    ``items`` lie by order and have one row per grain, ``valid`` are the rows they come from. Sellers and
    category names that are few enough are broadcast to the finished rows; more sellers are found as the
    products are, more names (or names beside so many sellers) go with the products.
    """
    products, names = cl.clean_products(t.products), cl.clean_translation(t.translation)
    few_sellers = few_keys([t.items, t.sellers], "seller_id", BROADCAST_SELLERS)
    few_names = few_sellers and few_keys([t.translation], "product_category_name", BROADCAST_CATEGORIES)
    sellers = [cl.clean_sellers(t.sellers), metrics]
    products = products if few_names else left_join_m1(products, names, ["product_category_name"], keyed=True)
    rows = _looked_up(items, valid, [products], "product_id")
    rows = rows if few_sellers else _looked_up(rows, valid, sellers, "seller_id")
    rows = left_join_m1(rows, orders, ["order_id"], keyed=True)
    if few_names:
        rows = left_join_m1(rows, F.broadcast(names), ["product_category_name"], keyed=True)
    for side in sellers if few_sellers else []:
        rows = left_join_m1(rows, F.broadcast(side), ["seller_id"], keyed=True)
    return rows


def build_fact(t: Commerce, tier_bounds: tuple[int, ...] = agg.TIER_BOUNDS, staged: bool = False) -> DataFrame:
    """60-column fact; durations in fractional days, missing money counts as zero.

    Items and orders feed several branches (the rows themselves, the sellers' metrics, the
    customers' history). ``staged=True`` writes the cleaned items and the order keys once to
    the checkpoint folder, so that a full build scans and cleans the raw items a single
    time. The default stays lazy, which is better for a query that needs few columns.
    """
    valid = cl.valid_items(t.items)
    valid = stage(cl.distinct_rows(valid), "items") if staged else valid
    # the first row of a repeated grain survives; the seller metrics still count all of them
    items = cl.distinct_rows(valid.repartition("order_id"))
    first = cl.keep_one(items, cl.GRAIN, ["shipping_limit_date", "price", "freight_value"])
    orders = cl.clean_orders(t.orders)
    # a count that is read keeps all columns of the distinct rows, so that their shuffle serves here too
    sold = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_items")).filter("_items > 0")

    purchases = orders.select("order_id", "customer_id", PURCHASE).join(sold, "order_id", "left_semi")
    purchases = stage(purchases, "purchases") if staged else purchases
    order_side = _with_history(orders, purchases, t, number_unknown=True)
    order_side = _order_calendar(order_side, days_between)
    order_side = left_join_m1(
        order_side, agg.payments_by_order(cl.distinct_rows(t.payments)), ["order_id"], keyed=True
    )
    order_side = left_join_m1(order_side, agg.reviews_by_order(cl.distinct_rows(t.reviews)), ["order_id"], keyed=True)

    metrics = agg.seller_metrics(
        items, orders, days_between(PURCHASE, DELIVERED), later_than(DELIVERED, ESTIMATED), tier_bounds
    )
    fact = _enrich(valid, first, order_side, t, metrics)
    fact = fact.withColumns(
        {
            "is_delayed": F.coalesce("is_delayed", F.lit(False)),
            "total_item_value": plus_null_as_zero("price", "freight_value"),
            "freight_to_price_ratio": ratio_if_positive("freight_value", "price"),
        }
    )
    return fact.filter(cl.row_is_consistent()).select(*FACT_COLUMNS)


def build_fact_whole_days(t: Commerce, tier_bounds: tuple[int, ...] = agg.TIER_BOUNDS) -> DataFrame:
    """The SQL-model variant: whole-day durations, rows without price dropped, history over all orders."""
    valid = cl.valid_staged_items(t.items)
    items = cl.keep_one(valid.repartition("order_id"), cl.GRAIN, ["shipping_limit_date"])
    orders = cl.clean_orders(t.orders)
    order_side = _with_history(orders, orders, t, number_unknown=False)
    order_side = _order_calendar(order_side, whole_days_between)
    payments = agg.payments_by_order(cl.stage_payments(t.payments), null_total_as_zero=False)
    reviews = agg.reviews_by_order(cl.stage_reviews(t.reviews))
    order_side = left_join_m1(order_side, payments, ["order_id"], keyed=True)
    order_side = left_join_m1(order_side, reviews, ["order_id"], keyed=True)
    # every item has a price; to count prices keeps the columns of the rows, so that their shuffle serves here too
    counted = items.groupBy("seller_id", "order_id").agg(F.count("price").alias("_copies"))
    metrics = agg.seller_metrics(
        counted, orders, whole_days_between(PURCHASE, DELIVERED), later_than(DELIVERED, ESTIMATED), tier_bounds, "_copies"
    )
    fact = _enrich(valid, items, order_side, t, metrics)
    fact = fact.withColumns(
        {
            "is_delayed": F.coalesce("is_delayed", F.lit(False)),
            "total_item_value": F.col("price") + F.col("freight_value"),
            "freight_to_price_ratio": ratio_if_positive("freight_value", "price"),
        }
    )
    return fact.filter(cl.row_is_consistent(null_price_passes=False)).select(*FACT_COLUMNS)


def require_rows(fact: DataFrame, minimum: int = 100_001, name: str = "fact_orders_enriched") -> int:
    """Row count of the fact; raises below the contractual minimum."""
    rows = fact.count()
    if rows < minimum:
        raise ValueError(f"{name} needs at least {minimum} rows, found {rows}")
    return rows
