"""Canonical commerce tables read from the benchmark Parquet tables.

The eight tables have the column names and types of a marketplace export. Missing
and invalid values are injected by fixed arithmetic on the keys, so that every
cleaning rule has rows to act on at each scale.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Commerce:
    orders: DataFrame
    items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    translation: DataFrame
    payments: DataFrame
    reviews: DataFrame


# Schemas of the input tables. Declared, so that planning reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def _later(ts: str, days: str = "0", hours: str = "0"):
    return F.expr(f"{ts} + make_dt_interval(cast({days} as int), cast({hours} as int))")


def _orders(spark: SparkSession, root: str) -> DataFrame:
    purchase = "(o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int)))"
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.expr(
            "case when o_orderkey % 97 = 13 then null when o_orderstatus = 'F' then 'delivered' "
            "when o_orderstatus = 'O' then 'shipped' when o_orderpriority = '1-URGENT' then 'canceled' "
            "else 'processing' end"
        ).alias("order_status"),
        F.expr(f"case when o_orderkey % 199 <> 7 then {purchase} end").alias("order_purchase_timestamp"),
        F.when(F.expr("o_orderkey % 50 <> 7"), _later(purchase, "0", "(o_custkey % 9) * 5 - 1")).alias(
            "order_approved_at"
        ),
        F.when(F.expr("o_orderstatus in ('F', 'O')"), _later(purchase, "1 + o_orderkey % 9", "7")).alias(
            "order_delivered_carrier_date"
        ),
        F.when(F.expr("o_orderstatus = 'F'"), _later(purchase, "o_orderkey % 83 - 2", "o_custkey % 13")).alias(
            "order_delivered_customer_date"
        ),
        _later("o_orderdate", "60").alias("order_estimated_delivery_date"),
    )


def _items(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.expr("case when not (l_orderkey % 499 = 0 and l_linenumber = 3) then l_partkey end").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.expr(
            "case when (l_orderkey + l_linenumber) % 211 = 0 then null "
            "when (l_orderkey * 7 + l_linenumber) % 307 = 0 then -l_extendedprice else l_extendedprice end"
        ).alias("price"),
        F.expr("l_extendedprice * l_tax").alias("freight_value"),
    )


def _with_state(df: DataFrame, spark: SparkSession, root: str, key: str, alias: str) -> DataFrame:
    nation = table(spark, root, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(alias))
    return df.join(nation, key, "left")


def _customers(spark: SparkSession, root: str) -> DataFrame:
    customer = table(spark, root, "customer").filter("c_custkey % 60 <> 59")
    return _with_state(customer, spark, root, "c_nationkey", "customer_state").select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("c_custkey div 2").alias("customer_unique_id"),
        F.expr("cast(c_nationkey * 1000 + c_custkey % 1000 as int)").alias("customer_zip_code_prefix"),
        F.expr("lower(concat(c_mktsegment, ' ', cast(c_custkey % 7 as string)))").alias("customer_city"),
        "customer_state",
    )


def _sellers(spark: SparkSession, root: str) -> DataFrame:
    supplier = table(spark, root, "supplier").filter("s_suppkey % 50 <> 49")
    return _with_state(supplier, spark, root, "s_nationkey", "seller_state").select(
        F.col("s_suppkey").alias("seller_id"),
        F.expr("cast(s_nationkey * 1000 + s_suppkey % 1000 as int)").alias("seller_zip_code_prefix"),
        F.expr("concat('city ', cast(s_suppkey % 11 as string))").alias("seller_city"),
        "seller_state",
    )


CATEGORY = "case when p_partkey % 40 <> 0 then lower(concat(p_type, '_', substring(p_brand, 7, 2))) end"


def _products(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.expr(CATEGORY).alias("product_category_name"),
        F.expr("length(p_name)").alias("product_name_lenght"),
        F.expr("p_size * 10").alias("product_description_lenght"),
        F.expr("p_size % 6").alias("product_photos_qty"),
        F.expr("p_retailprice / 2").alias("product_weight_g"),
        F.expr("cast(p_size as double)").alias("product_length_cm"),
        F.expr("cast(p_size % 13 as double)").alias("product_height_cm"),
        F.expr("cast(p_size % 17 as double)").alias("product_width_cm"),
    )


def _translation(spark: SparkSession, root: str) -> DataFrame:
    named = table(spark, root, "part").filter("p_type <> 'PROMO'")
    return named.select(
        F.expr(CATEGORY).alias("product_category_name"),
        F.concat(F.lit("en_"), F.expr(CATEGORY)).alias("product_category_name_english"),
    )


def _payments(spark: SparkSession, root: str) -> DataFrame:
    paid = table(spark, root, "events").filter("event_type in ('purchase', 'click')")
    return paid.select(
        F.expr("event_id div 3").alias("order_id"),
        F.expr("cast(event_id % 3 + 1 as int)").alias("payment_sequential"),
        F.expr(
            "case user_id % 5 when 0 then 'credit_card' when 1 then 'boleto' when 2 then 'voucher' "
            "when 3 then 'debit_card' else null end"
        ).alias("payment_type"),
        F.expr("cast(user_id % 10 + 1 as int)").alias("payment_installments"),
        F.expr("case when event_id % 89 <> 0 then value * 100 end").alias("payment_value"),
    )


def _reviews(spark: SparkSession, root: str) -> DataFrame:
    rated = table(spark, root, "events").filter("event_type in ('view', 'signup')")
    return rated.select(
        F.expr("event_id div 2").alias("review_id"),
        F.expr("event_id div 3").alias("order_id"),
        F.expr("cast(event_id % 5 + 1 as int)").alias("review_score"),
        F.expr("case user_id % 3 when 0 then '  ' when 1 then null else props end").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.expr("ts + make_dt_interval(2, cast(user_id % 24 as int))").alias("review_answer_timestamp"),
    )


def commerce(spark: SparkSession, root: str) -> Commerce:
    return Commerce(
        orders=_orders(spark, root),
        items=_items(spark, root),
        customers=_customers(spark, root),
        products=_products(spark, root),
        sellers=_sellers(spark, root),
        translation=_translation(spark, root),
        payments=_payments(spark, root),
        reviews=_reviews(spark, root),
    )
