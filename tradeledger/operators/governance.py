"""Gates, scorecards, observability, monitoring and history, per group of any table.

Everything takes frames with one row per dataset (or per dataset and check); grouping
columns name the dataset, so the same plan decides for one table or for every seller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.scalars import try_number
from tradeledger.functions.stable import count_where
from tradeledger.operators.checks import (
    Check,
    at_least_rows,
    at_most_pct,
    evaluate,
    grain_duplicates,
    none_allowed,
    quality_score,
    schema_check,
)
from tradeledger.operators.ordered import latest_two, quantiles

# Gate thresholds and weights.
MIN_QUALITY = 80
REVIEW_RISK = 60
HIGH_RISK = 80
SEVERITY_WEIGHT = {"high": 3, "medium": 2, "low": 1}
UNKNOWN_WEIGHT = 2


# ---- gates ---------------------------------------------------------------


def readiness_gate(datasets: DataFrame) -> DataFrame:
    """Approved / Needs Review / Blocked with severity, reasons and required actions.

    Input columns: data_quality_score, privacy_risk_score, critical_rule_failures,
    freshness_status, schema_contract_status, has_sensitive_data_without_protection.
    """
    quality, risk = F.col("data_quality_score"), F.col("privacy_risk_score")
    failures, fresh = F.col("critical_rule_failures"), F.col("freshness_status")
    not_fresh = fresh.isin("warning", "stale")
    findings: list[tuple[Column, Column, str]] = [
        (
            failures > 0,
            F.format_string("Critical rule failures detected: %d.", failures),
            "Resolve critical quality rule failures before publication.",
        ),
        (
            F.col("has_sensitive_data_without_protection"),
            F.lit("Sensitive data found without masking/anonymization."),
            "Mask, anonymize, or remove sensitive data before publication.",
        ),
        (
            F.col("schema_contract_status") == "failed",
            F.lit("Schema contract validation failed."),
            "Fix schema contract violations and revalidate.",
        ),
        (
            quality < MIN_QUALITY,
            F.format_string(f"Data quality score below recommended threshold (%d < {MIN_QUALITY}).", quality),
            "Investigate failed checks and improve data quality score.",
        ),
        (
            risk >= REVIEW_RISK,
            F.format_string(f"Privacy risk score is elevated (%d >= {REVIEW_RISK}).", risk),
            "Review privacy controls and mitigation actions.",
        ),
        (
            not_fresh,
            F.format_string("Freshness status requires attention: %s.", fresh),
            "Refresh dataset and confirm SLA/freshness compliance.",
        ),
    ]
    blocked = reduce(lambda a, b: a | b, [c for c, _, _ in findings[:3]])
    review = reduce(lambda a, b: a | b, [c for c, _, _ in findings[3:]])
    clean = ~blocked & ~review
    ok_reason = F.when(clean, "All publication controls are within acceptable thresholds.")
    ok_action = F.when(clean, "Proceed with publication and keep routine monitoring.")
    severity = (
        F.when(blocked, "Critical")
        .when((risk >= HIGH_RISK) | (fresh == "stale"), "High")
        .when(review, "Medium")
        .otherwise("Low")
    )
    return datasets.withColumns(
        {
            "decision": F.when(blocked, "Blocked").when(review, "Needs Review").otherwise("Approved"),
            "severity": severity,
            "reasons": F.array_compact(F.array(*[F.when(c, text) for c, text, _ in findings], ok_reason)),
            "required_actions": F.array_compact(F.array(*[F.when(c, todo) for c, _, todo in findings], ok_action)),
        }
    )


def batch_gate(datasets: DataFrame, approved_at: str, approver: str = "publication_gate_cli") -> DataFrame:
    """The batch decision (70/89, 60/80, no critical issue) with approver stamp on approval."""
    quality, risk = F.col("quality_score"), F.col("lgpd_risk_score")
    blocked = (quality < 70) | (risk > 80) | (F.col("critical_issues") > 0)
    review = quality.between(70, 89) | risk.between(61, 80)
    decision = F.when(blocked, "Blocked").when(review, "Needs Review").otherwise("Approved")
    approved = F.col("decision") == "Approved"
    reason = (
        F.when(
            F.col("decision") == "Blocked",
            "Publication blocked because quality, privacy risk, or critical issues breached hard thresholds.",
        )
        .when(
            F.col("decision") == "Needs Review",
            "Publication requires manual review because quality or LGPD risk is in the review range.",
        )
        .otherwise("Publication approved because quality, LGPD risk, and critical issue thresholds passed.")
    )
    return datasets.withColumn("decision", decision).withColumns(
        {
            "reason": reason,
            "approved_by": F.when(approved, approver).otherwise(""),
            "approved_at": F.when(approved, approved_at).otherwise(""),
        }
    )


def gate_signals(checks: DataFrame, classes: DataFrame, contracts: DataFrame, freshness: DataFrame) -> DataFrame:
    """Inputs of the readiness gate per dataset_name, from check rows of each kind.

    A dataset without contract rows counts as passed, without a freshness row as fresh.
    """
    failed = F.upper("status") == "FAIL"
    by = "dataset_name"
    rules = checks.groupBy(by).agg(
        count_where(failed & F.lower("severity").isin("high", "critical")).alias("critical_rule_failures"),
        quality_score(count_where(failed)).alias("data_quality_score"),
    )
    sensitive = F.col("lgpd_classification") == "sensitive_personal_data"
    open_columns = sensitive & ~F.col("recommended_action").isin("anonymize", "remove")
    protection = classes.groupBy(by).agg(
        (count_where(open_columns) > 0).alias("has_sensitive_data_without_protection")
    )
    contract = contracts.groupBy(by).agg(
        F.when(count_where(failed) > 0, "failed").otherwise("passed").alias("schema_contract_status")
    )
    metric, limit = try_number("metric_value"), try_number("threshold")
    state = F.when(F.upper("status") == "PASS", "fresh").when(metric <= limit * 1.5, "warning").otherwise("stale")
    stale_rank = F.when(state == "fresh", 0).when(state == "warning", 1).otherwise(2)
    age = freshness.groupBy(by).agg(F.max(stale_rank).alias("_rank"))
    out = rules.join(protection, by, "left").join(contract, by, "left").join(age, by, "left")
    return out.select(
        by,
        "critical_rule_failures",
        "data_quality_score",
        F.coalesce("has_sensitive_data_without_protection", F.lit(False)).alias("has_sensitive_data_without_protection"),
        F.coalesce("schema_contract_status", F.lit("passed")).alias("schema_contract_status"),
        F.element_at(
            F.array(F.lit("fresh"), F.lit("warning"), F.lit("stale")), F.coalesce("_rank", F.lit(0)) + 1
        ).alias("freshness_status"),
    )


# ---- scorecards ----------------------------------------------------------


def _health(score: Column) -> Column:
    return F.when(score >= 95, "healthy").when(score >= 80, "attention").otherwise("critical")


def scorecard_metrics(checks: DataFrame, by: tuple[str, ...] = ("dataset_name", "dimension")) -> DataFrame:
    """Severity-weighted share of passed checks; anything but PASS has failed, WARN included."""
    severity = F.lower(F.trim(F.coalesce("severity", F.lit("medium"))))
    weight = F.lit(UNKNOWN_WEIGHT)
    for name, value in SEVERITY_WEIGHT.items():
        weight = F.when(severity == name, value).otherwise(weight)
    passed = F.upper("status") == "PASS"
    out = checks.groupBy(*by).agg(
        F.round(F.sum(F.when(passed, weight).otherwise(0)) / F.sum(weight) * 100, 2).alias("score"),
        F.count(F.lit(1)).alias("total_checks"),
        count_where(~F.coalesce(passed, F.lit(False))).alias("failed_checks"),
    )
    return out.withColumn("status", _health(F.col("score")))


def collect_check_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Stacks check rows of several kinds as (dataset_name, dimension, status, severity)."""
    parts = []
    for dimension, df in sources.items():
        severity = F.col("severity") if "severity" in df.columns else F.lit("medium")
        parts.append(
            df.select("dataset_name", F.lit(dimension).alias("dimension"), "status", severity.alias("severity"))
        )
    return reduce(DataFrame.unionByName, parts)


def dataset_scorecards(metrics: DataFrame) -> DataFrame:
    mean = F.round(F.sum(F.col("score").cast("decimal(12,2)")).cast("double") / F.count(F.lit(1)), 2)
    out = metrics.groupBy("dataset_name").agg(mean.alias("governance_score"))
    return out.withColumn("status", _health(F.col("governance_score")))


# ---- observability -------------------------------------------------------


def latest_and_baseline(history: DataFrame, time: str, value: str, by: list[str]) -> DataFrame:
    """Newest value and the median of all earlier ones, per group with at least two points."""
    points = history.select(*by, time, try_number(value).alias("_v")).filter(F.col("_v").isNotNull())
    newest = points.groupBy(*by).agg(F.max(F.struct(time, "_v")).alias("_last"))
    newest = newest.select(*by, F.col(f"_last.{time}").alias("_t"), F.col("_last._v").alias("latest"))
    earlier = points.join(newest, by).filter(F.col(time) < F.col("_t"))
    median = quantiles(earlier.select(*by, "_v"), by, "_v", {"baseline": 0.5}).drop("n")
    return newest.drop("_t").join(median, by, "left")


def _history_check(
    df: DataFrame, by: list[str], name: str, metric: Column, ok: Column, limit: float, severity: str, digits: int
) -> DataFrame:
    enough = metric.isNotNull()
    return df.select(
        *by,
        F.lit(name).alias("check_name"),
        F.when(~enough | ok, "PASS").otherwise("FAIL").alias("status"),
        F.when(enough, severity).otherwise("low").alias("severity"),
        F.when(enough, F.round(metric, digits)).alias("metric_value"),
        F.lit(float(limit)).alias("threshold"),
        F.when(enough, "evaluated").otherwise("insufficient_history").alias("details"),
    )


def row_count_anomaly(history: DataFrame, time: str, by: list[str]) -> DataFrame:
    """Newest row count at most 30 % away from the median of the earlier ones."""
    points = latest_and_baseline(history, time, "row_count", by)
    latest, base = F.col("latest"), F.col("baseline")
    change = F.when(base == 0, F.when(latest == 0, 0.0).otherwise(100.0)).otherwise(
        F.abs(F.try_divide(latest - base, base)) * 100
    )
    return _history_check(points, by, "row_count_anomaly", change, change <= 30.0, 30.0, "medium", 2)


def null_rate_drift(history: DataFrame, time: str, by: list[str]) -> DataFrame:
    points = latest_and_baseline(history, time, "null_rate", by)
    drift = F.col("latest") - F.col("baseline")
    return _history_check(points, by, "null_rate_drift", drift, drift <= 10.0, 10.0, "medium", 4)


def _trend(history: DataFrame, time: str, by: list[str], column: str) -> DataFrame:
    numbers = history.select(*by, time, try_number(column).alias("_v"))
    return latest_two(numbers, time, "_v", by)


def privacy_risk_trend(history: DataFrame, time: str, by: list[str]) -> DataFrame:
    delta = F.col("delta")
    points = _trend(history, time, by, "privacy_risk_score")
    return _history_check(points, by, "privacy_risk_trend", delta, delta <= 15.0, 15.0, "high", 2)


def quality_score_trend(history: DataFrame, time: str, by: list[str]) -> DataFrame:
    delta = F.col("delta")
    points = _trend(history, time, by, "data_quality_score")
    return _history_check(points, by, "quality_score_trend", delta, delta >= -10.0, -10.0, "high", 2)


def state_checks(datasets: DataFrame, by: list[str]) -> DataFrame:
    """freshness_status and schema_drift rows from (by, freshness_status, missing_columns)."""
    fresh = F.col("freshness_status") == "fresh"

    def row(name, ok, metric, limit):
        return F.struct(
            F.lit(name).alias("check_name"),
            F.when(ok, "PASS").otherwise("FAIL").alias("status"),
            F.lit("high").alias("severity"),
            metric.cast("double").alias("metric_value"),
            F.lit(limit).alias("threshold"),
            F.lit("evaluated").alias("details"),
        )

    age = F.when(fresh, 0).when(F.col("freshness_status") == "warning", 1).otherwise(2)
    rows = F.array(
        row("freshness_status", fresh, age, 0.0),
        row("schema_drift", F.col("missing_columns") == 0, F.col("missing_columns"), 0.0),
    )
    return datasets.select(*by, F.inline(rows))


def observability_suite(history: DataFrame, datasets: DataFrame, time: str, by: list[str]) -> DataFrame:
    """The six checks per dataset."""
    parts = [state_checks(datasets, by)] + [
        check(history, time, by) for check in (row_count_anomaly, null_rate_drift, privacy_risk_trend, quality_score_trend)
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- published-layer monitoring ------------------------------------------

# What the published table must offer.
PUBLISHED_EXPECTED = [
    "order_id", "order_item_id", "customer_unique_id", "order_purchase_timestamp", "purchase_cohort_month",
    "customer_order_sequence", "is_first_order", "seller_key", "seller_volume_tier", "seller_delay_rate",
    "delivery_time_days", "seller_dispatch_time_days", "carrier_delivery_time_days", "estimated_delay_days",
    "is_delayed", "price", "freight_value", "freight_to_price_ratio", "total_item_value",
]
PUBLISHED_CRITICAL = ["order_id", "order_item_id", "seller_key", "order_purchase_timestamp", "price", "freight_value"]
MAX_FRESHNESS_HOURS = 36
PUBLISHED_MIN_ROWS = 100_001


def published_row_checks(columns: list[str], min_rows: int = PUBLISHED_MIN_ROWS) -> list[Check]:
    checks = [at_least_rows("published_min_rows", min_rows)]
    for c in PUBLISHED_CRITICAL:
        name = f"published_critical_nulls__{c}"
        bad = F.col(c).isNull() if c in columns else F.lit(True)
        checks.append(none_allowed(name, bad, "high"))
    for c, limit in (("purchase_cohort_month", 0.0), ("seller_delay_rate", 1.0)):
        bad = F.col(c).isNull() if c in columns else F.lit(True)
        checks.append(at_most_pct(f"published_missing_pct__{c}", bad, limit, "medium"))
    return checks


def freshness_check(modified_at: DataFrame, as_of: str, max_hours: int = MAX_FRESHNESS_HOURS) -> DataFrame:
    """Age of the newest file; ``modified_at`` has one timestamp column of that name."""
    age = F.timestamp_diff("SECOND", F.col("modified_at"), F.lit(as_of).cast("timestamp"))
    newest = F.round(F.min(age) / 3600, 2)
    check = Check(
        "published_file_freshness_hours",
        newest,
        lambda m, n: F.when(m <= max_hours, "PASS").otherwise("FAIL"),
        float(max_hours),
        "high",
    )
    return evaluate(modified_at, [check])


def file_times(spark, path: str) -> DataFrame:
    """Modification time of every data file under ``path``, from file metadata."""
    return spark.read.parquet(path).select(F.col("_metadata.file_modification_time").alias("modified_at")).distinct()


def monitor_published(published: DataFrame, min_rows: int = PUBLISHED_MIN_ROWS) -> DataFrame:
    """Schema, key, volume, null and coverage checks: one wide aggregate and one key grouping."""
    parts = [schema_check(published, PUBLISHED_EXPECTED, "published_expected_schema")]
    if {"order_id", "order_item_id"} <= set(published.columns):
        parts.append(
            grain_duplicates(published, ["order_id", "order_item_id"], "published_primary_key_duplicates")
        )
    parts.append(evaluate(published, published_row_checks(published.columns, min_rows)))
    return reduce(DataFrame.unionByName, parts)


def alert_payload(checks: DataFrame, source: str = "published_layer_monitoring", environment: str = "prod") -> DataFrame:
    """One JSON text with the failed checks and the worst severity."""
    rank = F.when(F.col("severity") == "high", 3).when(F.col("severity") == "medium", 2).otherwise(1)
    failed = F.col("status") == "FAIL"
    entry = F.struct("check_name", "status", "metric_value", "threshold", "severity", "details")
    # check rows are bounded by the number of declared checks
    agg = checks.agg(
        count_where(failed).alias("failed_checks"),
        F.coalesce(F.max(F.when(failed, rank)), F.lit(1)).alias("_rank"),
        F.sort_array(F.collect_list(F.when(failed, entry))).alias("results"),
    )
    worst = F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")), F.col("_rank"))
    payload = F.struct(
        F.lit(source).alias("source"),
        F.lit(environment).alias("environment"),
        F.when(F.col("failed_checks") > 0, "FAIL").otherwise("PASS").alias("status"),
        "failed_checks",
        worst.alias("max_severity"),
        "results",
    )
    return agg.select(F.to_json(payload).alias("payload"))


# ---- history -------------------------------------------------------------


def history_row(sizes: DataFrame, nulls: DataFrame, checks: DataFrame, by: list[str]) -> DataFrame:
    """One history row per dataset.

    ``sizes``: by, row_count, duplicate_rows, privacy_risk_score, freshness_status;
    ``nulls``: by, column_name, null_pct; ``checks``: by, status, severity.
    """
    failed = F.upper("status") == "FAIL"
    grave = F.lower("severity").isin("high", "critical")
    rules = checks.groupBy(*by).agg(
        count_where(failed).alias("failed_rules_count"),
        count_where(failed & ~grave).alias("warning_rules_count"),
        count_where(failed & grave).alias("critical_rules_count"),
    )
    rate = nulls.groupBy(*by).agg(
        F.round(F.sum(F.col("null_pct").cast("decimal(12,6)")).cast("double") / F.count(F.lit(1)), 4).alias("null_rate")
    )
    row = sizes.join(rules, by, "left").join(rate, by, "left")
    duplicates = F.coalesce(F.try_divide(F.col("duplicate_rows"), F.col("row_count")), F.lit(0.0)) * 100
    failures = F.coalesce("failed_rules_count", F.lit(0))
    return row.select(
        *by,
        "row_count",
        F.coalesce("null_rate", F.lit(0.0)).alias("null_rate"),
        F.round(duplicates, 4).alias("duplicate_rate"),
        "freshness_status",
        quality_score(failures).alias("data_quality_score"),
        "privacy_risk_score",
        failures.alias("failed_rules_count"),
        F.coalesce("warning_rules_count", F.lit(0)).alias("warning_rules_count"),
        F.coalesce("critical_rules_count", F.lit(0)).alias("critical_rules_count"),
    )


def operational_rollup(logs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals and means of an execution log; unreadable numbers are left out."""
    status = F.upper(F.coalesce("status", F.lit("")))
    rows = try_number("rows_processed", "bigint")
    rejected = try_number("records_rejected", "bigint")
    quality, risk = try_number("quality_score", "bigint"), try_number("lgpd_risk_score", "bigint")
    return logs.groupBy(*(by or [])).agg(
        count_where(status.isin("FAILED", "ERROR")).alias("failures"),
        count_where(status.isin("WARNING", "WARN")).alias("warnings"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_processed"),
        F.coalesce(F.sum(rejected), F.lit(0)).alias("records_rejected"),
        F.avg(quality).alias("avg_quality_score"),
        F.avg(risk).alias("avg_risk_score"),
    )


def checks_summary_row(checks: DataFrame, dataset: str, as_of: str) -> DataFrame:
    """One log row per run: dataset, time, failure counts, score and the resulting status."""
    failed = F.col("status") == "FAIL"
    grave = F.lower("severity").isin("high", "critical")
    counted = checks.agg(
        count_where(failed).alias("failed_rules_count"),
        count_where(failed & ~grave).alias("warning_rules_count"),
        count_where(failed & grave).alias("critical_rules_count"),
    )
    return counted.select(
        F.lit(dataset).alias("dataset_name"),
        F.lit(as_of).alias("execution_timestamp"),
        quality_score(F.col("failed_rules_count")).alias("data_quality_score"),
        "failed_rules_count",
        "warning_rules_count",
        "critical_rules_count",
        F.when(F.col("failed_rules_count") == 0, "Approved").otherwise("Blocked").alias("publication_status"),
    )
