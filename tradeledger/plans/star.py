"""BI star schema: six dimensions, one fact, and its key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.scalars import date_key, display_label, mapped, month_key, pseudonym
from tradeledger.functions.stable import count_where
from tradeledger.operators.cleaning import keep_one
from tradeledger.operators.joins import left_join_m1, missing_keys
from tradeledger.operators.ordered import surrogate_keys
from tradeledger.session import stage

# Groups shown in the BI model.
PAYMENT_GROUPS = {"credit_card": "Card", "debit_card": "Card", "voucher": "Voucher", "boleto": "Boleto"}
STATUS_GROUPS = {
    "delivered": "Closed",
    "shipped": "In Fulfillment",
    "invoiced": "In Fulfillment",
    "processing": "In Fulfillment",
    "approved": "In Fulfillment",
    "created": "Open",
    "unavailable": "Exception",
    "canceled": "Exception",
}
PRODUCT_ATTRIBUTES = [
    "product_category_name", "product_category_name_english", "category_label", "product_name_lenght",
    "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm",
    "product_height_cm", "product_width_cm",
]


#: Columns of the fact that the star's fact table carries as they are.
CARRIED_TIMES = ["order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date"]
CARRIED_MEASURES = [
    "price", "freight_value", "total_item_value", "payment_count", "total_payment_value", "max_payment_installments",
    "review_count", "review_score_mean",
]
CARRIED_DELIVERY = ["delivery_time_days", "estimated_delay_days", "is_delayed"]
CUSTOMER_ATTRIBUTES, SELLER_ATTRIBUTES = ["customer_unique_id", "customer_state"], ["seller_state"]
#: Columns that keys, labels and dates are made from.
SOURCES = ["order_id", "order_item_id", "product_id", "seller_id", "customer_id", "order_date", "payment_type_mode", "order_status"]


def required_columns() -> set[str]:
    """Every column of the fact that a table of the star is made from."""
    made = {"category_label"}
    attributes = PRODUCT_ATTRIBUTES + CUSTOMER_ATTRIBUTES + SELLER_ATTRIBUTES
    return {*SOURCES, *attributes, *CARRIED_TIMES, *CARRIED_MEASURES, *CARRIED_DELIVERY} - made


def normalise_for_bi(fact: DataFrame) -> DataFrame:
    """Required columns present, labels filled and trimmed, delay flag never null."""
    missing = sorted(required_columns() - set(fact.columns))
    if missing:
        raise ValueError(f"columns missing in the fact: {', '.join(missing)}")

    def label(*candidates):
        return F.trim(F.coalesce(*candidates))

    return fact.withColumns(
        {
            "category_label": label(
                F.col("product_category_name_english"), F.col("product_category_name"), F.lit("unknown")
            ),
            "payment_type_mode": label(F.col("payment_type_mode"), F.lit("unknown")),
            "order_status": label(F.col("order_status"), F.lit("unknown")),
            "customer_state": label(F.col("customer_state"), F.lit("NA")),
            "seller_state": label(F.col("seller_state"), F.lit("NA")),
            "is_delayed": F.coalesce("is_delayed", F.lit(False)),
        }
    )


# ---- dimensions ----------------------------------------------------------


def dim_date(df: DataFrame) -> DataFrame:
    days = df.select(F.to_date("order_date").alias("order_date")).filter("order_date is not null").distinct()
    return days.select(
        date_key("order_date").alias("date_key"),
        "order_date",
        F.year("order_date").alias("year"),
        F.concat(F.lit("Q"), F.quarter("order_date").cast("string")).alias("quarter"),
        F.month("order_date").alias("month"),
        F.date_format("order_date", "MMM").alias("month_name"),
        month_key("order_date").alias("year_month"),
        F.weekofyear("order_date").alias("week_of_year"),
        F.dayofmonth("order_date").alias("day"),
        F.date_format("order_date", "EEEE").alias("weekday_name"),
    ).orderBy("order_date")


def _keyed(df: DataFrame, natural: str, attributes: list[str]) -> DataFrame:
    """One row per natural key; hashing the key is left to the caller, after the de-duplication."""
    return keep_one(df.filter(F.col(natural).isNotNull()).select(natural, *attributes), [natural])


def dim_product(df: DataFrame) -> DataFrame:
    products = _keyed(df, "product_id", PRODUCT_ATTRIBUTES)
    return products.select(pseudonym("product_id", "product_id").alias("product_key"), *PRODUCT_ATTRIBUTES)


def dim_payment(df: DataFrame) -> DataFrame:
    types = surrogate_keys(df.select(F.col("payment_type_mode").alias("payment_type")), "payment_type", "payment_key")
    return types.select(
        "payment_key",
        "payment_type",
        mapped("payment_type", PAYMENT_GROUPS).alias("payment_group"),
        display_label("payment_type").alias("payment_description"),
    )


def dim_order_status(df: DataFrame) -> DataFrame:
    statuses = surrogate_keys(df, "order_status", "order_status_key")
    return statuses.select(
        "order_status_key",
        "order_status",
        mapped("order_status", STATUS_GROUPS).alias("status_group"),
        display_label("order_status").alias("status_description"),
    )


def dim_customer(df: DataFrame) -> DataFrame:
    return _keyed(df, "customer_id", CUSTOMER_ATTRIBUTES).select(
        pseudonym("customer_id", "customer_id").alias("customer_key"),
        pseudonym("customer_unique_id", "customer_unique_id").alias("customer_master_key"),
        "customer_state",
    )


def dim_seller(df: DataFrame) -> DataFrame:
    return _keyed(df, "seller_id", SELLER_ATTRIBUTES).select(
        pseudonym("seller_id", "seller_id").alias("seller_key"), "seller_state"
    )


# ---- fact ----------------------------------------------------------------


def lookup(df: DataFrame, dim: DataFrame, natural: str, dim_natural: str, key: str) -> DataFrame:
    """Adds the surrogate ``key`` of the dimension row with the same natural key."""
    keys = dim.select(F.col(dim_natural).alias(natural), key)
    return left_join_m1(df, keys, [natural])


def fact_sales(df: DataFrame, payments: DataFrame, statuses: DataFrame, keys_only: bool = False) -> DataFrame:
    keyed = lookup(df, payments, "payment_type_mode", "payment_type", "payment_key")
    keyed = lookup(keyed, statuses, "order_status", "order_status", "order_status_key")
    order_key = pseudonym("order_id", "order_id")
    product_key, seller_key = pseudonym("product_id", "product_id"), pseudonym("seller_id", "seller_id")
    item_key = F.concat_ws("_", order_key, F.col("order_item_id").cast("string"), product_key, seller_key)
    carried = [
        *CARRIED_TIMES,
        *CARRIED_MEASURES,
        F.col("review_score_mean").isNotNull().cast("int").alias("review_available"),
        *CARRIED_DELIVERY,
        F.col("order_delivered_customer_date").isNotNull().cast("int").alias("delivered_flag"),
    ]
    return keyed.select(
        item_key.alias("order_item_key"),
        order_key.alias("order_key"),
        "order_item_id",
        date_key("order_date").alias("date_key"),
        product_key.alias("product_key"),
        "payment_key",
        "order_status_key",
        pseudonym("customer_id", "customer_id").alias("customer_key"),
        seller_key.alias("seller_key"),
        *([] if keys_only else carried),
    )


PRIMARY_KEYS = {
    "fact_sales": "order_item_key",
    "dim_date": "date_key",
    "dim_product": "product_key",
    "dim_payment": "payment_key",
    "dim_order_status": "order_status_key",
    "dim_customer": "customer_key",
    "dim_seller": "seller_key",
}
FOREIGN_KEYS = {
    "date_key": "dim_date",
    "product_key": "dim_product",
    "payment_key": "dim_payment",
    "order_status_key": "dim_order_status",
    "customer_key": "dim_customer",
    "seller_key": "dim_seller",
}


def star_schema(fact: DataFrame) -> dict[str, DataFrame]:
    rows = normalise_for_bi(fact)
    # both numbered dimensions from one scan: a row for a pair of labels
    labels = stage(rows.select("payment_type_mode", "order_status").distinct(), "star-labels")
    payments, statuses = dim_payment(labels), dim_order_status(labels)
    return {
        "fact_sales": fact_sales(rows, payments, statuses),
        "dim_date": dim_date(rows),
        "dim_product": dim_product(rows),
        "dim_payment": payments,
        "dim_order_status": statuses,
        "dim_customer": dim_customer(rows),
        "dim_seller": dim_seller(rows),
    }


def key_tables(fact: DataFrame) -> dict[str, DataFrame]:
    """The tables of the star with the columns that its key checks read.

    The columns that keys are made from are staged, so that the fact is computed once for all tables.
    """
    rows = stage(normalise_for_bi(fact).select(*SOURCES), "star-keys")
    payments, statuses = dim_payment(rows), dim_order_status(rows)

    def keys(natural: str, key: str) -> DataFrame:
        return _keyed(rows, natural, []).select(pseudonym(natural, natural).alias(key))

    return {
        "fact_sales": fact_sales(rows, payments, statuses, keys_only=True),
        "dim_date": dim_date(rows),
        "dim_product": keys("product_id", "product_key"),
        "dim_payment": payments,
        "dim_order_status": statuses,
        "dim_customer": keys("customer_id", "customer_key"),
        "dim_seller": keys("seller_id", "seller_key"),
    }


# ---- checks --------------------------------------------------------------


def _check(df: DataFrame, name: str, failed, details: str) -> DataFrame:
    return df.agg(failed.alias("failed_rows")).select(
        F.lit(name).alias("check_name"),
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("status"),
        "failed_rows",
        F.lit(details).alias("details"),
    )


def primary_key_checks(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """Null and repeated primary keys per table, counted on pre-aggregated keys."""
    parts = []
    for name, key in (keys or PRIMARY_KEYS).items():
        counted = tables[name].groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        nulls = F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0))
        repeats = count_where(F.col("_key").isNotNull() & (F.col("_n") > 1))
        parts.append(_check(counted, f"primary_key__{name}", nulls + repeats, key))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_checks(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """Distinct fact keys without a dimension row, for all foreign keys at once.

    Fact and dimensions become tagged (name, key) rows that merge before one shuffle, instead of a
    join and a shuffle of the fact's keys for each foreign key.
    """
    keys = keys or FOREIGN_KEYS

    def tagged(df: DataFrame, name: str, column: str, in_fact: bool) -> Column:
        return F.struct(F.lit(name).alias("name"), F.col(column).cast("string").alias("key"), F.lit(in_fact).alias("fact"), F.lit(not in_fact).alias("dim"))

    fact = tables["fact_sales"]
    sides = [fact.select(F.inline(F.array(*[tagged(fact, fk, fk, True) for fk in keys])))]
    sides += [tables[dim].select(F.inline(F.array(tagged(tables[dim], fk, fk, False)))) for fk, dim in keys.items()]
    met = reduce(DataFrame.unionByName, sides).groupBy("name", "key").agg(F.max("fact").alias("fact"), F.max("dim").alias("dim"))
    failed = count_where(F.col("key").isNotNull() & F.col("fact") & ~F.col("dim"))
    counted = met.groupBy("name").agg(failed.alias("failed"))
    # a key that no side has yet still has its row
    wide = counted.agg(*[F.coalesce(F.max(F.when(F.col("name") == fk, F.col("failed"))), F.lit(0)).alias(fk) for fk in keys])
    rows = [
        F.struct(
            F.lit(f"foreign_key__{fk}").alias("check_name"), F.when(F.col(fk) == 0, "PASS").otherwise("FAIL").alias("status"),
            F.col(fk).alias("failed_rows"), F.lit(dim).alias("details"),
        )
        for fk, dim in keys.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def generic_headers(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower().startswith("column")]


def verify_star(tables: dict[str, DataFrame]) -> DataFrame:
    """All key checks; raises on a generic header, a missing key column or a failed check."""
    for name, df in tables.items():
        if generic_headers(df):
            raise ValueError(f"{name} has generic headers: {', '.join(generic_headers(df))}")
    missing = sorted(set(FOREIGN_KEYS) - set(tables["fact_sales"].columns))
    if missing:
        raise ValueError(f"fact_sales lacks foreign keys: {', '.join(missing)}")
    checks = primary_key_checks(tables).unionByName(foreign_key_checks(tables))
    # thirteen checks: one row per declared key
    failed = sorted(r.check_name for r in checks.filter("status = 'FAIL'").select("check_name").collect())
    if failed:
        raise ValueError("star schema checks failed: " + ", ".join(failed))
    return checks
