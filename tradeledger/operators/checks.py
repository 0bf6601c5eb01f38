"""Data-quality checks: every rule is a Column, all rules of a table run in one aggregate.

``evaluate`` turns aggregate metrics into check rows, for the whole table or per group
(``by``), without a scan per rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.functions.stable import count_where, pct
from tradeledger.operators.contracts import NUMERIC, STAMPS, duplicate_members
from tradeledger.operators.profiling import column_counts, null_counts, order_gaps

# Thresholds of the fact checks.
CRITICAL_COLUMNS = [
    "order_id", "order_item_id", "customer_id", "product_id", "seller_id",
    "order_purchase_timestamp", "price", "freight_value",
]
GRAIN = ["order_id", "order_item_id", "product_id", "seller_id"]
COVERED_COLUMNS = ["customer_unique_id", "customer_state", "seller_state", "payment_type_mode"]
#: Every column that `row_checks` reads.
ROW_CHECK_COLUMNS = CRITICAL_COLUMNS + [
    "order_approved_at", "order_delivered_customer_date", "review_score_mean", "product_category_name",
    "estimated_delay_days", *COVERED_COLUMNS,
]
MAX_REVIEW_MISSING_PCT = 35.0
MAX_CATEGORY_MISSING_PCT = 5.0
MAX_UNDELIVERED_PCT = 5.0
MAX_JOIN_MISSING_PCT = 1.0
MAX_GAP_ORDERS_PCT = 5.0
MAX_DELIVERY_BEFORE_APPROVAL_PCT = 0.1
MIN_RECORDS = 100_001
GUARDED_WORDS = ("revenue", "price", "value", "amount", "qty", "quant", "score", "total", "freight")
DATE_WORDS = ("date", "data", "timestamp", "dt_")
HIGH_NULL_PCT = 30.0


@dataclass(frozen=True)
class Check:
    """``metric`` is an aggregate; ``status`` maps the finished metric (and row count) to a status.

    Checks that count offending rows also say which (``bad_rows``) and how the count becomes the
    metric (``from_counts``, of offending rows and rows), so that counts of parts can be merged.
    """

    name: str
    metric: Column
    status: Callable[[Column, Column], Column]
    threshold: float
    severity: str
    details: str = ""
    bad_rows: Column | None = None
    from_counts: Callable[[Column, Column], Column] = lambda bad, rows: bad


def _pass_if(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def none_allowed(name: str, bad_rows: Column, severity: str, details: str = "") -> Check:
    return Check(name, count_where(bad_rows), lambda m, n: _pass_if(m == 0), 0.0, severity, details, bad_rows)


def at_most_pct(name: str, bad_rows: Column, limit: float, severity: str, details: str = "") -> Check:
    metric = F.round(F.coalesce(pct(bad_rows), F.lit(0.0)), 2)

    def merged(bad: Column, rows: Column) -> Column:
        share_of = F.when(rows > 0, bad.cast("double") / F.nullif(rows, F.lit(0)) * 100)
        return F.round(F.coalesce(share_of, F.lit(0.0)), 2)

    return Check(name, metric, lambda m, n: _pass_if(m <= limit), limit, severity, details, bad_rows, merged)


def at_least_rows(name: str, minimum: int, severity: str = "high", details: str = "") -> Check:
    return Check(name, F.count(F.lit(1)), lambda m, n: _pass_if(m >= minimum), float(minimum), severity, details, F.lit(True))


def always_failing(name: str, metric: float, threshold: float, severity: str, details: str) -> Check:
    return Check(name, F.max(F.lit(metric)), lambda m, n: F.lit("FAIL"), threshold, severity, details)


def evaluate(df: DataFrame, checks: list[Check], by: list[str] | None = None) -> DataFrame:
    """Rows (by..., check_name, status, metric_value, threshold, severity, details)."""
    by = by or []
    metrics = [c.metric.alias(f"_m{i}") for i, c in enumerate(checks)]
    return _check_rows(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *metrics), checks, by)


def evaluate_counts(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """As ``evaluate`` from one row of counts: rows, and bad_0, bad_1, ... for the checks with ``bad_rows``."""
    metrics = [
        (c.metric if c.bad_rows is None else c.from_counts(F.max(f"bad_{i}"), F.max("rows"))).alias(f"_m{i}") for i, c in enumerate(checks)
    ]
    return _check_rows(counts.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("_rows"), *metrics), checks, [])


def _check_rows(wide: DataFrame, checks: list[Check], by: list[str]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            c.status(F.col(f"_m{i}"), F.col("_rows")).alias("status"),
            F.col(f"_m{i}").cast("double").alias("metric_value"),
            F.lit(float(c.threshold)).alias("threshold"),
            F.lit(c.severity).alias("severity"),
            F.lit(c.details).alias("details"),
        )
        for i, c in enumerate(checks)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


# ---- fact suite ----------------------------------------------------------


def critical_nulls() -> list[Check]:
    return [none_allowed(f"critical_nulls__{c}", F.col(c).isNull(), "high", f"null values in {c}") for c in CRITICAL_COLUMNS]


def negative_values() -> list[Check]:
    return [
        none_allowed(name, F.coalesce(F.col(c), F.lit(0.0)) < 0, "high", f"negative values in {c}")
        for name, c in (("negative_price_values", "price"), ("negative_freight_values", "freight_value"))
    ]


def _residual_status(metric: Column, rows: Column) -> Column:
    share = F.round(F.try_divide(metric, rows) * 100, 4)
    return (
        F.when(share > MAX_DELIVERY_BEFORE_APPROVAL_PCT, "FAIL").when(metric > 0, "WARN").otherwise("PASS")
    )


def temporal_coherence() -> list[Check]:
    purchase, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    delivered = F.col("order_delivered_customer_date")
    name = "temporal_coherence__"
    return [
        none_allowed(name + "approval_before_purchase", approved < purchase, "medium", "approved before purchase"),
        none_allowed(name + "delivery_before_purchase", delivered < purchase, "high", "delivered before purchase"),
        Check(
            name + "delivery_before_approval",
            count_where(delivered < approved),
            _residual_status,
            MAX_DELIVERY_BEFORE_APPROVAL_PCT,
            "medium",
            "delivered before approval; a small residue is only a warning",
            delivered < approved,
        ),
    ]


def missing_percentages() -> list[Check]:
    return [
        at_most_pct(
            "review_score_missing_pct", F.col("review_score_mean").isNull(), MAX_REVIEW_MISSING_PCT, "medium",
            "rows without review score",
        ),
        at_most_pct(
            "category_missing_pct", F.col("product_category_name").isNull(), MAX_CATEGORY_MISSING_PCT, "medium",
            "rows without product category",
        ),
        at_most_pct(
            "undelivered_orders_pct", F.col("order_delivered_customer_date").isNull(), MAX_UNDELIVERED_PCT, "medium",
            "rows without delivery date",
        ),
    ]


def delay_null_consistency() -> list[Check]:
    differs = F.col("order_delivered_customer_date").isNull() != F.col("estimated_delay_days").isNull()
    return [none_allowed("delay_null_consistency", differs, "high", "delivery date and delay must be null together")]


def dimension_coverage(columns: list[str]) -> list[Check]:
    checks = []
    for c in COVERED_COLUMNS:
        name = f"dimension_join_missing_pct__{c}"
        if c in columns:
            checks.append(at_most_pct(name, F.col(c).isNull(), MAX_JOIN_MISSING_PCT, "medium", f"rows without {c}"))
        else:
            checks.append(always_failing(name, 100.0, MAX_JOIN_MISSING_PCT, "medium", f"column {c} is absent"))
    return checks


def record_volume(minimum: int = MIN_RECORDS) -> list[Check]:
    return [at_least_rows("record_volume_above_100k", minimum, details="rows of the fact")]


def grain_duplicates(fact: DataFrame, grain: list[str] | None = None, name: str = "granularity_duplicates") -> DataFrame:
    grain = grain or GRAIN
    check = Check(
        name, F.max("duplicate_rows"), lambda m, n: _pass_if(m == 0), 0.0, "high", "grain: " + ", ".join(grain)
    )
    return evaluate(duplicate_members(fact, grain), [check])


def reconciliation_check(fact: DataFrame) -> DataFrame:
    check = at_most_pct(
        "payment_reconciliation_gap_over_1_real_pct", F.col("abs_gap") > 1.0, MAX_GAP_ORDERS_PCT, "medium",
        "orders whose items and payments differ by more than 1",
    )
    return evaluate(order_gaps(fact), [check])


def row_checks(columns: list[str], minimum: int = MIN_RECORDS) -> list[Check]:
    """All checks that need nothing but the rows themselves: one pass."""
    return (
        critical_nulls()
        + negative_values()
        + temporal_coherence()
        + missing_percentages()
        + delay_null_consistency()
        + dimension_coverage(columns)
        + record_volume(minimum)
    )


def schema_check(df: DataFrame, expected: list[str], name: str = "expected_schema") -> DataFrame:
    missing = sorted(set(expected) - set(df.columns))
    status = "FAIL" if missing else "PASS"
    row = (name, status, float(len(missing)), 0.0, "high", f"missing: {', '.join(missing) or 'none'}")
    schema = "check_name string, status string, metric_value double, threshold double, severity string, details string"
    return df.sparkSession.createDataFrame([row], schema)


# Columns every consumer of the fact relies on.
EXPECTED_FACT_COLUMNS = [
    "order_id", "order_item_id", "customer_id", "product_id", "seller_id", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date", "price",
    "freight_value", "review_score_mean", "product_category_name", "order_year", "order_month",
    "order_date", "delivery_time_days", "estimated_delay_days", "is_delayed", "total_item_value",
]


def fact_quality_suite(fact: DataFrame, minimum: int = MIN_RECORDS) -> DataFrame:
    """25 results from three aggregates: rows, grain, orders."""
    parts = [
        schema_check(fact, EXPECTED_FACT_COLUMNS),
        evaluate(fact, row_checks(fact.columns, minimum)),
        grain_duplicates(fact),
        reconciliation_check(fact),
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- generic checks for any table ----------------------------------------

RULE_COLUMNS = ["check_name", "status", "severity", "affected_columns", "affected_rows", "recommendation", "rule_source"]


def _rule_row(name: str, failed: Column, severity: str, columns: Column, rows: Column, advice: str, source: str):
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        F.when(failed, severity).otherwise("low").alias("severity"),
        columns.alias("affected_columns"),
        rows.cast("long").alias("affected_rows"),
        F.lit(advice).alias("recommendation"),
        F.lit(source).alias("rule_source"),
    )


def null_percent_by_column(df: DataFrame) -> DataFrame:
    share = F.round(F.col("null_count") / F.greatest("total_rows", F.lit(1)) * 100, 2)
    return null_counts(df).select("column_name", share.alias("null_pct"), (share > HIGH_NULL_PCT).alias("over_30pct"))


def duplicate_extras(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def cardinality(df: DataFrame) -> DataFrame:
    """Distinct values per column with null as one value; unique and constant columns flagged."""
    values = F.col("unique_count") + F.when(F.col("null_count") > 0, 1).otherwise(0)
    rows = F.col("non_null_count") + F.col("null_count")
    return column_counts(df).select(
        "column_name",
        values.alias("cardinality"),
        ((values == rows) & (rows > 0)).alias("possible_unique_key"),
        (values <= 1).alias("constant"),
    )


def _date_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if any(w in f.name.lower() for w in DATE_WORDS) or isinstance(f.dataType, (*STAMPS, T.DateType))
    ]


def _as_time(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (*STAMPS, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    return F.try_to_timestamp(F.col(name).cast("string")).cast("timestamp_ntz")


def _moment(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def negative_number_checks(df: DataFrame) -> DataFrame:
    """Columns whose name promises an amount must not be negative."""
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NUMERIC) and any(w in f.name.lower() for w in GUARDED_WORDS)
    ]
    masks = {f"negative_values__{c}": (c, F.coalesce(F.col(c), F.lit(0)) < 0) for c in names}
    return _masked(df, masks, "medium", "Validate the rule, correct negative values or document exceptions.")


def future_date_checks(df: DataFrame, as_of: str) -> DataFrame:
    masks = {f"future_dates__{c}": (c, _as_time(df, c) > _moment(as_of)) for c in _date_columns(df)}
    return _masked(df, masks, "medium", "Correct reference dates or check time zones.")


def _masked(df: DataFrame, masks: dict[str, tuple[str, Column]], severity: str, advice: str) -> DataFrame:
    wide = df.agg(*[count_where(mask).alias(name) for name, (_, mask) in masks.items()])
    rows = [
        _rule_row(name, F.col(name) > 0, severity, F.lit(column), F.col(name), advice, "built_in")
        for name, (column, _) in masks.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def _summary_check(df: DataFrame, name: str, severity: str, advice: str, flagged: DataFrame, flag: str) -> DataFrame:
    """FAIL with the flagged column names and all rows affected, or PASS."""
    total = df.agg(F.count(F.lit(1)).alias("_n")).scalar()
    names = F.array_join(F.sort_array(F.collect_list(F.when(F.col(flag), F.col("column_name")))), ", ")
    hit = flagged.agg(names.alias("_names"))  # one entry per column of the schema
    failed = F.col("_names") != ""
    rows = F.when(failed, total).otherwise(0)
    return hit.select(F.inline(F.array(_rule_row(name, failed, severity, F.col("_names"), rows, advice, "built_in"))))


def table_quality_checks(df: DataFrame, as_of: str, rules: list[dict] | None = None) -> DataFrame:
    """Built-in checks of any table plus declared rules."""
    extras = duplicate_extras(df).select(
        F.inline(
            F.array(
                _rule_row(
                    "duplicate_rows", F.col("duplicate_rows") > 0, "high", F.lit(""), F.col("duplicate_rows"),
                    "Remove duplicates and validate the grain.", "built_in",
                )
            )
        )
    )
    parts = [
        _summary_check(
            df, "high_null_columns_over_30pct", "high", "Review source completeness.",
            null_percent_by_column(df), "over_30pct",
        ),
        extras,
        _summary_check(
            df, "constant_columns", "medium", "Drop or review constant columns.", cardinality(df), "constant"
        ),
    ]
    if any(isinstance(f.dataType, NUMERIC) and any(w in f.name.lower() for w in GUARDED_WORDS) for f in df.schema.fields):
        parts.append(negative_number_checks(df))
    if _date_columns(df):
        parts.append(future_date_checks(df, as_of))
    if rules:
        parts.append(run_quality_rules(df, rules, as_of))
    return reduce(DataFrame.unionByName, parts)


# ---- declared data-quality rules -----------------------------------------


def _rule_mask(df: DataFrame, rule: dict, columns: list[str], as_of: str) -> Column | None:
    """Rows that violate the rule; None where the rule is not decided row by row."""
    kind, params, first = rule["type"], rule.get("params", {}), F.col(columns[0])
    if kind == "not_null":
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    if kind == "accepted_range":
        low = F.lit(float(params.get("min", float("-inf"))))
        high = F.lit(float(params.get("max", float("inf"))))
        return ~F.coalesce(first.cast("double"), low).between(low, high)
    if kind == "no_future_dates":
        return _as_time(df, columns[0]) > _moment(as_of)
    if kind == "no_negative_values":
        return F.coalesce(first, F.lit(0)) < 0
    if kind == "allowed_values":  # a missing value is not an allowed value
        return ~F.coalesce(first.isin(list(params.get("allowed", []))), F.lit(False))
    return None


def run_quality_rules(df: DataFrame, rules: list[dict], as_of: str, source: str = "contract") -> DataFrame:
    """Check rows of declared rules; unknown rule types are skipped, absent columns fail.

    Row-wise rules and null shares share one aggregate; each `unique` rule adds one grouping.
    """
    aggregates: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    rows, parts = [], []
    for i, rule in enumerate(rules):
        columns = [c for c in rule.get("columns", []) if c in df.columns]
        severity, advice = rule.get("severity", "medium"), rule.get("recommendation", "Review data quality issue.")

        def row(failed, names, affected, rule=rule, severity=severity, advice=advice):
            return _rule_row(rule["name"], failed, severity, names, affected, advice, source)

        if not columns:
            rows.append(row(F.lit(True), F.lit(", ".join(rule.get("columns", []))), F.lit(0)))
        elif rule["type"] == "unique":
            members = duplicate_members(df, columns)
            found = row(F.col("duplicate_rows") > 0, F.lit(", ".join(columns)), F.col("duplicate_rows"))
            parts.append(members.select(F.inline(F.array(found))))
        elif rule["type"] == "max_null_pct":
            limit = float(rule.get("params", {}).get("max_null_pct", 0))
            for c in columns:
                aggregates.append(F.coalesce(pct(F.col(c).isNull()), F.lit(0.0)).alias(f"_p{i}_{c}"))
            over = [F.when(F.col(f"_p{i}_{c}") > limit, F.lit(c)) for c in columns]
            names = F.concat_ws(", ", *over)
            rows.append(row(names != "", names, F.when(names != "", F.col("_rows")).otherwise(0)))
        else:
            mask = _rule_mask(df, rule, columns, as_of)
            if mask is None:
                continue
            shown = ", ".join(columns) if rule["type"] == "not_null" else columns[0]
            aggregates.append(count_where(mask).alias(f"_c{i}"))
            rows.append(row(F.col(f"_c{i}") > 0, F.lit(shown), F.col(f"_c{i}")))
    if rows:
        parts.insert(0, df.agg(*aggregates).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


# ---- business rules ------------------------------------------------------

OPERATORS = {
    ">=": lambda a, b: a < b,
    ">": lambda a, b: a <= b,
    "<=": lambda a, b: a > b,
    "<": lambda a, b: a >= b,
    "==": lambda a, b: a != b,
}


def business_rule_failure(rule: dict) -> Column:
    """True on rows that break the rule. Missing values break only `expression` and `not_null_if`."""
    kind, params = rule["type"], rule.get("params", {})
    if kind == "range":
        value = F.col(rule["column"])
        low, high = params.get("min"), params.get("max")
        failed = F.lit(False)
        failed = failed if low is None else failed | (value < F.lit(low))
        failed = failed if high is None else failed | (value > F.lit(high))
    elif kind == "not_null_if":
        failed = (F.col(params["if_column"]) == F.lit(params["if_equals"])) & F.col(rule["column"]).isNull()
    elif kind == "accepted_values":
        failed = ~F.col(rule["column"]).isin(list(params.get("allowed", [])))
    elif kind == "compare_columns":
        left, right = rule["columns"]
        operator = params.get("operator", "==")
        if operator not in OPERATORS:
            raise ValueError(f"unsupported operator in compare_columns: {operator}")
        failed = OPERATORS[operator](F.col(left), F.col(right))
    elif kind == "expression":
        text = str(params.get("expression", "")).strip()
        if not text:
            raise ValueError(f"rule {rule['rule_id']} has no expression")
        failed = ~F.coalesce(F.expr(text), F.lit(False))
    else:
        raise ValueError(f"unsupported rule type: {kind}")
    return F.coalesce(failed, F.lit(False))


def run_business_rules(df: DataFrame, rules: list[dict], by: list[str] | None = None) -> DataFrame:
    """rule_id, status, severity, failed_rows, failure_pct, details; one aggregate for all rules."""
    if not rules:
        raise ValueError("a business-rule contract needs at least one rule")
    by = by or []
    counts = [count_where(business_rule_failure(r)).alias(f"_c{i}") for i, r in enumerate(rules)]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counts)
    rows = []
    for i, rule in enumerate(rules):
        failed = F.col(f"_c{i}")
        share = F.round(F.coalesce(F.try_divide(failed, F.col("_rows")), F.lit(0.0)) * 100, 4)
        limit = rule.get("params", {}).get("max_failure_pct")
        tolerated = F.lit(False) if limit is None else share <= float(limit)
        text = str(rule.get("description", ""))
        note = f"{text} Residual failures within the tolerance of {limit}%."
        rows.append(
            F.struct(
                F.lit(rule["rule_id"]).alias("rule_id"),
                F.when((failed == 0) | tolerated, "PASS").otherwise("FAIL").alias("status"),
                F.lit(rule["severity"]).alias("severity"),
                failed.alias("failed_rows"),
                share.alias("failure_pct"),
                F.when(tolerated & (failed > 0), note).otherwise(text).alias("details"),
            )
        )
    return wide.select(*by, F.inline(F.array(*rows)))


# ---- column tests of the SQL models --------------------------------------


def run_column_tests(df: DataFrame, model: str, tests: list[tuple]) -> DataFrame:
    """Generic tests (`unique`, `not_null`, `accepted_values` with its list): failing keys or rows."""
    parts, counts = [], []
    for name, kind, *allowed in tests:
        if kind == "unique":
            keys = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
            parts.append((name, kind, keys.agg(count_where(F.col("_n") > 1).alias("failures"))))
        elif kind == "not_null":
            counts.append((name, kind, F.col(name).isNull()))
        else:
            counts.append((name, kind, ~F.col(name).isin(allowed[0])))
    frames = [
        one.select(F.lit(model).alias("model"), F.lit(n).alias("column_name"), F.lit(k).alias("test"), "failures")
        for n, k, one in parts
    ]
    if counts:
        wide = df.agg(*[count_where(mask).alias(f"_f{i}") for i, (_, _, mask) in enumerate(counts)])
        rows = [
            F.struct(
                F.lit(model).alias("model"), F.lit(n).alias("column_name"), F.lit(k).alias("test"),
                F.col(f"_f{i}").alias("failures"),
            )
            for i, (n, k, _) in enumerate(counts)
        ]
        frames.append(wide.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, frames)


def quality_score(failed_checks: Column) -> Column:
    return F.greatest(F.lit(0), 100 - 10 * failed_checks)


def status_summary(checks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """passed / warning / failed / total per group of check rows."""
    status = F.upper(F.trim(F.coalesce("status", F.lit(""))))
    return checks.groupBy(*(by or [])).agg(
        count_where(status == "PASS").alias("passed"),
        count_where(status == "WARN").alias("warning"),
        count_where(status.isin("FAIL", "FAILED", "ERROR")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def failures(checks: DataFrame, severities: tuple[str, ...] = ("high", "medium")) -> DataFrame:
    return checks.filter((F.col("status") == "FAIL") & F.col("severity").isin(list(severities)))
