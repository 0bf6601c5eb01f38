"""Cleaning, typing, de-duplication and split of rejected rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAIN = ["order_id", "order_item_id", "product_id", "seller_id"]


# ---- names and types -----------------------------------------------------


def snake_case(name: str) -> str:
    """`CustomerID` -> `customer_id`, `Order ID` -> `order_id`."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)
    return "_".join(word.lower() for word in words)


def with_snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def with_lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def date_like(name: str) -> bool:
    return "date" in name or "timestamp" in name or name.endswith("_at")


def parse_date_columns(df: DataFrame) -> DataFrame:
    """Text columns with a date-like name become timestamps; unreadable values become null."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.try_to_timestamp(F.col(c)).alias(c) if c in texts and date_like(c) else F.col(c)
            for c in df.columns
        ]
    )


# ---- de-duplication ------------------------------------------------------


def keep_one(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all other columns, nulls first.

    Written as an aggregate, not a window: copies are merged before the shuffle, so a key
    that owns a third of the rows sends one row per map task, and later joins know that
    the key is unique.
    """
    order = [c for c in (order or []) if c not in keys]
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _present(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


# ---- the cleaned commerce tables -----------------------------------------


def clean_orders(orders: DataFrame) -> DataFrame:
    typed = parse_date_columns(orders).filter(_present("order_id", "customer_id"))
    return keep_one(typed, ["order_id"], ["order_purchase_timestamp"])


def item_rejections() -> list[tuple[str, Column]]:
    """Reasons why an item row does not enter the fact, by the raw columns alone."""
    missing = [(f"missing_{c}", F.col(c).isNull()) for c in GRAIN]
    return missing + [
        ("negative_price", F.coalesce(F.col("price"), F.lit(0.0)) < 0),
        ("negative_freight", F.coalesce(F.col("freight_value"), F.lit(0.0)) < 0),
    ]


def valid_items(items: DataFrame) -> DataFrame:
    """The accepted rows, copies included."""
    typed = parse_date_columns(items)
    for _, rejected in item_rejections():
        typed = typed.filter(~rejected)
    return typed


def clean_items(items: DataFrame) -> DataFrame:
    return distinct_rows(valid_items(items))


def split_rejected(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with all their reasons joined in `rejection_reason`."""
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    tagged = df.withColumn("rejection_reason", F.array_join(reasons, "|"))
    accepted = tagged.filter(F.col("rejection_reason") == "").drop("rejection_reason")
    return accepted, tagged.filter(F.col("rejection_reason") != "")


def clean_customers(customers: DataFrame) -> DataFrame:
    return keep_one(customers.filter(_present("customer_id")), ["customer_id"], ["customer_unique_id"])


def clean_products(products: DataFrame) -> DataFrame:
    return keep_one(products.filter(_present("product_id")), ["product_id"], ["product_category_name"])


def clean_sellers(sellers: DataFrame) -> DataFrame:
    return keep_one(sellers.filter(_present("seller_id")), ["seller_id"], ["seller_state"])


def clean_translation(translation: DataFrame) -> DataFrame:
    named = translation.filter(_present("product_category_name"))
    return keep_one(named, ["product_category_name"], ["product_category_name_english"])


# ---- staging models: casts, required keys, one row per key ----------------


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def valid_staged_items(items: DataFrame) -> DataFrame:
    """As `valid_items`, but a missing price or freight rejects the row."""
    typed = _typed(items, {"order_item_id": "int", "price": "double", "freight_value": "double"})
    return typed.filter(_present("order_id", "product_id", "seller_id")).filter("price >= 0 and freight_value >= 0")


def stage_items(items: DataFrame) -> DataFrame:
    """As `clean_items`, but a missing price or freight rejects the row and the grain is unique."""
    return keep_one(valid_staged_items(items), GRAIN, ["shipping_limit_date"])


def stage_payments(payments: DataFrame) -> DataFrame:
    types = {"payment_sequential": "int", "payment_installments": "int", "payment_value": "double"}
    return _typed(payments, types).filter(_present("order_id"))


def stage_reviews(reviews: DataFrame) -> DataFrame:
    typed = _typed(reviews, {"review_score": "int"}).filter(_present("order_id"))
    return keep_one(typed, ["review_id"], ["review_creation_date"])


# ---- after the joins -----------------------------------------------------


def row_is_consistent(null_price_passes: bool = True) -> Column:
    """Purchase time known, money not negative, delivery not before purchase."""
    price, freight = F.col("price"), F.col("freight_value")
    if null_price_passes:
        price, freight = F.coalesce(price, F.lit(0.0)), F.coalesce(freight, F.lit(0.0))
    days = F.col("delivery_time_days")
    return (
        F.col("order_purchase_timestamp").isNotNull()
        & (price >= 0)
        & (freight >= 0)
        & (days.isNull() | (days >= 0))
    )
