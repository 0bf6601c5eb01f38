"""The minimised, pseudonymised copy of the fact and the controls that guard it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.scalars import md5_key, pseudonym
from tradeledger.functions.stable import count_where

# The published contract.
PUBLISHED_COLUMNS = [
    "order_id", "order_item_id", "customer_unique_id", "order_status", "order_purchase_timestamp",
    "order_delivered_customer_date", "order_estimated_delivery_date", "order_date", "order_year",
    "order_month", "purchase_cohort_month", "cohort_order_month_number", "customer_order_sequence",
    "is_first_order", "seller_key", "seller_volume_tier", "seller_order_count",
    "seller_avg_delivery_days", "seller_delay_rate", "delivery_time_days",
    "seller_dispatch_time_days", "carrier_delivery_time_days", "estimated_delay_days", "is_delayed",
    "price", "freight_value", "freight_to_price_ratio", "total_item_value", "payment_type_mode",
    "review_score_mean", "product_category_name", "product_category_name_english",
    "customer_state", "seller_state",
]
PSEUDONYM_PREFIX = {"order_id": "order_id", "customer_unique_id": "customer_unique_id", "seller_key": "seller_id"}
DEFAULT_FILL = {
    "customer_state": "NA",
    "seller_state": "NA",
    "order_status": "unknown",
    "payment_type_mode": "unknown",
    "seller_volume_tier": "long_tail",
}
FORBIDDEN_COLUMNS = [
    "customer_id", "product_id", "seller_id", "customer_zip_code_prefix", "customer_city",
    "seller_zip_code_prefix", "seller_city", "latest_review_creation_date",
    "latest_review_answer_timestamp", "shipping_limit_date", "order_delivered_carrier_date",
    "order_approved_at", "payment_count", "total_payment_value", "max_payment_installments",
    "review_count", "review_score_max", "review_score_min", "has_review_comment",
]


@dataclass(frozen=True)
class PrivacyContract:
    required: list[str] = field(default_factory=lambda: list(PUBLISHED_COLUMNS))
    forbidden: list[str] = field(default_factory=lambda: list(FORBIDDEN_COLUMNS))
    pseudonyms: dict[str, str] = field(
        default_factory=lambda: {c: f"{p}_" for c, p in PSEUDONYM_PREFIX.items()}
    )
    defaults: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_FILL))
    protected: list[str] = field(default_factory=lambda: list(FORBIDDEN_COLUMNS))


def pseudonymise(fact: DataFrame) -> DataFrame:
    """order_id, customer_unique_id and seller_id as prefixed tokens (seller as `seller_key`)."""
    columns = {"seller_key": pseudonym("seller_id", "seller_id")} if "seller_id" in fact.columns else {}
    for name in ("order_id", "customer_unique_id"):
        columns[name] = pseudonym(name, PSEUDONYM_PREFIX[name])
    return fact.withColumns(columns)


def publish(fact: DataFrame) -> DataFrame:
    """Published projection: tokens instead of keys, 34 columns at most, defaults for gaps."""
    tokens = pseudonymise(fact)
    kept = tokens.select(*[c for c in PUBLISHED_COLUMNS if c in tokens.columns])
    return kept.fillna({c: v for c, v in DEFAULT_FILL.items() if c in kept.columns})


def publish_md5(fact: DataFrame) -> DataFrame:
    """SQL-model variant: md5 seller key, order and customer keys left as they are."""
    known = fact.filter(F.col("order_purchase_timestamp").isNotNull())
    keyed = known.withColumn("seller_key", md5_key("seller_id")).fillna({"payment_type_mode": "unknown"})
    return keyed.select(*PUBLISHED_COLUMNS)


# ---- controls ------------------------------------------------------------


def _status(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def _list(names: list[str]) -> str:
    return ", ".join(names) if names else "none"


def token_checks(published: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Every non-null value of a pseudonymised column starts with its prefix; one scan for all."""
    bad = [
        count_where(F.col(c).isNotNull() & ~F.startswith(F.col(c).cast("string"), F.lit(p))).alias(c)
        for c, p in prefixes.items()
    ]
    rows = [
        F.struct(
            F.lit(f"pseudonymized__{c}").alias("check_name"),
            _status(F.col(c) == 0).alias("status"),
            F.col(c).alias("failed_rows"),
            F.lit(f"expected prefix {p}").alias("details"),
        )
        for c, p in prefixes.items()
    ]
    return published.agg(*bad).select(F.inline(F.array(*rows)))


def default_fill_checks(published: DataFrame, source: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """No nulls are left, and the rows that were null in the source carry the default.

    Rows are not matched one by one. Per published primary key the source must have as many
    "null or already default" rows as the published table has default rows; both sides are
    counted in one shuffle over their union, without a join that could multiply rows.
    """
    grain = ["order_id", "order_item_id"]
    columns = list(defaults)
    expected = [
        (F.col(c).isNull() | (F.col(c) == F.lit(defaults[c]))).cast("long").alias(c) for c in columns
    ]
    carried = [(F.coalesce(F.col(c) == F.lit(defaults[c]), F.lit(False))).cast("long").alias(c) for c in columns]
    nulls = [F.col(c).isNull().cast("long").alias(f"_null_{c}") for c in columns]
    no_nulls = [F.lit(0).cast("long").alias(f"_null_{c}") for c in columns]
    minus = [(-F.col(c)).alias(c) for c in columns]
    left = pseudonymise(source).select(*grain, *expected, *no_nulls)
    right = published.select(*grain, *carried, *nulls)
    right = right.select(*grain, *minus, *[f"_null_{c}" for c in columns])
    per_grain = left.unionByName(right).groupBy(*grain)
    balance = per_grain.agg(*[F.sum(c).alias(c) for c in columns + [f"_null_{c}" for c in columns]])
    totals = balance.agg(
        *[count_where(F.col(c) != 0).alias(c) for c in columns],
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(f"default_fill__{c}").alias("check_name"),
            _status((F.col(c) == 0) & (F.col(f"_null_{c}") == 0)).alias("status"),
            (F.col(c) + F.col(f"_null_{c}")).alias("failed_rows"),
            F.concat(
                F.lit("nulls="), F.col(f"_null_{c}").cast("string"), F.lit(" | keys without default="),
                F.col(c).cast("string"),
            ).alias("details"),
        )
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def column_checks(columns: list[str], contract: PrivacyContract, policy: PrivacyContract) -> list[tuple]:
    """Checks that need only the column names and the two documents."""
    present = set(columns)
    missing = sorted(set(contract.required) - present)
    exposed = sorted(set(contract.forbidden) & present)
    extra = sorted(present - set(contract.required))
    leaked = sorted(set(contract.protected) & present)
    rows = [
        ("required_columns", missing, f"missing: {_list(missing)}"),
        ("forbidden_columns_absent", exposed, f"exposed: {_list(exposed)}"),
        ("unexpected_columns", extra, f"unexpected: {_list(extra)}"),
        ("classification_leakage", leaked, f"exposed: {_list(leaked)}"),
        ("policy_required_columns_alignment", set(contract.required) ^ set(policy.required), "required columns"),
        ("policy_forbidden_columns_alignment", set(contract.forbidden) ^ set(policy.forbidden), "forbidden columns"),
        (
            "policy_pseudonymization_alignment",
            contract.pseudonyms.items() ^ policy.pseudonyms.items(),
            "pseudonym prefixes",
        ),
        ("policy_default_fill_alignment", contract.defaults.items() ^ policy.defaults.items(), "default values"),
    ]
    return [(name, "FAIL" if bad else "PASS", len(bad), details) for name, bad, details in rows]


def privacy_checks(
    published: DataFrame,
    source: DataFrame,
    contract: PrivacyContract | None = None,
    policy: PrivacyContract | None = None,
) -> DataFrame:
    """All privacy controls as rows: check_name, status, failed_rows, details."""
    contract = contract or PrivacyContract()
    policy = policy or contract
    spark = published.sparkSession
    schema = "check_name string, status string, failed_rows long, details string"
    checks = spark.createDataFrame(column_checks(published.columns, contract, policy), schema)
    absent = [
        (f"{kind}__{c}", "FAIL", 1, "required column is missing")
        for kind, names in (("pseudonymized", contract.pseudonyms), ("default_fill", contract.defaults))
        for c in names
        if c not in published.columns
    ]
    if absent:
        checks = checks.unionByName(spark.createDataFrame(absent, schema))
    prefixes = {c: p for c, p in contract.pseudonyms.items() if c in published.columns}
    if prefixes:
        checks = checks.unionByName(token_checks(published, prefixes))
    defaults = {c: v for c, v in contract.defaults.items() if c in published.columns and c in source.columns}
    if defaults:
        checks = checks.unionByName(default_fill_checks(published, source, defaults))
    return checks


class PublicationBlocked(RuntimeError):
    """Raised before anything is written when a privacy control fails."""


def gated_publish(fact: DataFrame, write, contract: PrivacyContract | None = None, published=None) -> DataFrame:
    """Build, verify, then hand the published table to ``write``; a failed control aborts first."""
    published = publish(fact) if published is None else published
    checks = privacy_checks(published, fact, contract)
    # one row per control: the number of contract columns bounds what comes back
    failed = sorted(r.check_name for r in checks.filter("status = 'FAIL'").select("check_name").collect())
    if failed:
        raise PublicationBlocked("privacy controls failed: " + ", ".join(failed))
    write(published)
    return published
