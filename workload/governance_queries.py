"""Gates, scorecards, observability, monitoring and history over groups of rows (id M, D18, E12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.operators import checks as ck
from tradeledger.operators import governance as gv
from workload.base import cte, query
from workload.inputs import fact, published
from workload.profile_queries import load
from workload.quality_queries import FAMILIES

# ---- execution log -------------------------------------------------------

cte(
    "run_log",
    """
select event_type || '-' || cast(day as varchar) as execution_id, event_type as dataset_name, finished_at,
  case when bad * 100 > n * 12 then 'FAILED' when bad * 100 > n * 10 then 'warn' else 'SUCCESS' end as status,
  case when day(day) % 7 = 0 then 'n/a' else cast(n as varchar) end as rows_processed,
  cast(bad as varchar) as records_rejected, cast(100 - bad * 100 // n as varchar) as quality_score,
  cast(n % 60 as varchar) as lgpd_risk_score
from (select event_type, cast(ts as date) as day, max(ts) as finished_at, count(*) as n,
        count(*) filter (value < 5) as bad from events group by 1, 2)
""",
)


def run_log(spark, root):
    events = load(spark, root, "events")
    daily = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.max("ts").alias("finished_at"),
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("value") < 5, 1)).alias("bad"),
    )
    return daily.select(
        F.concat_ws("-", "event_type", F.col("day").cast("string")).alias("execution_id"),
        F.col("event_type").alias("dataset_name"),
        "finished_at",
        F.when(F.expr("bad * 100 > n * 12"), "FAILED")
        .when(F.expr("bad * 100 > n * 10"), "warn")
        .otherwise("SUCCESS")
        .alias("status"),
        F.when(F.dayofmonth("day") % 7 == 0, "n/a").otherwise(F.col("n").cast("string")).alias("rows_processed"),
        F.col("bad").cast("string").alias("records_rejected"),
        F.expr("cast(100 - bad * 100 div n as string)").alias("quality_score"),
        (F.col("n") % 60).cast("string").alias("lgpd_risk_score"),
    )


@query(
    "operational_log_rollup",
    """
select dataset_name, count(*) filter (upper(status) in ('FAILED', 'ERROR')) as failures,
  count(*) filter (upper(status) in ('WARNING', 'WARN')) as warnings,
  cast(coalesce(sum(try_cast(rows_processed as bigint)), 0) as bigint) as rows_processed,
  cast(coalesce(sum(try_cast(records_rejected as bigint)), 0) as bigint) as records_rejected,
  avg(try_cast(quality_score as bigint)) as avg_quality_score, avg(try_cast(lgpd_risk_score as bigint)) as avg_risk_score
from run_log group by 1
""",
)
def _(spark, root):
    return gv.operational_rollup(run_log(spark, root), ["dataset_name"])


# ---- gates ---------------------------------------------------------------

cte(
    "gate_inputs",
    """
select l_suppkey as seller, cast(100 - 100 * count(*) filter (l_discount >= 0.09) // count(*) as bigint) as data_quality_score,
  cast(100 * count(*) filter (l_tax >= 0.04) // count(*) as bigint) as privacy_risk_score,
  count(*) filter (l_quantity = 50 and l_discount = 0.1 and l_tax = 0.08) as critical_rule_failures,
  case when max(l_shipdate) < timestamp '2001-10-20' then 'stale'
       when max(l_shipdate) < timestamp '2001-10-27' then 'warning' else 'fresh' end as freshness_status,
  case when l_suppkey % 10 = 0 then 'failed' else 'passed' end as schema_contract_status,
  l_suppkey % 17 = 3 as has_sensitive_data_without_protection
from lineitem group by l_suppkey
""",
)


def gate_inputs(spark, root):
    lines = load(spark, root, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("seller")).agg(
        F.expr("100 - 100 * count_if(l_discount >= 0.09) div count(*)").alias("data_quality_score"),
        F.expr("100 * count_if(l_tax >= 0.04) div count(*)").alias("privacy_risk_score"),
        F.expr("count_if(l_quantity = 50 and l_discount = 0.1 and l_tax = 0.08)").alias("critical_rule_failures"),
        F.expr(
            "case when max(l_shipdate) < timestamp_ntz '2001-10-20' then 'stale' "
            "when max(l_shipdate) < timestamp_ntz '2001-10-27' then 'warning' else 'fresh' end"
        ).alias("freshness_status"),
        F.expr("case when l_suppkey % 10 = 0 then 'failed' else 'passed' end").alias("schema_contract_status"),
        F.expr("l_suppkey % 17 = 3").alias("has_sensitive_data_without_protection"),
    )


@query(
    "readiness_gate_per_seller",
    """
select *, case when blocked then 'Blocked' when review then 'Needs Review' else 'Approved' end as decision,
  case when blocked then 'Critical' when privacy_risk_score >= 80 or freshness_status = 'stale' then 'High'
       when review then 'Medium' else 'Low' end as severity,
  concat_ws(' / ',
    case when critical_rule_failures > 0 then 'Critical rule failures detected: ' || critical_rule_failures || '.' end,
    case when has_sensitive_data_without_protection then 'Sensitive data found without masking/anonymization.' end,
    case when schema_contract_status = 'failed' then 'Schema contract validation failed.' end,
    case when data_quality_score < 80
      then 'Data quality score below recommended threshold (' || data_quality_score || ' < 80).' end,
    case when privacy_risk_score >= 60 then 'Privacy risk score is elevated (' || privacy_risk_score || ' >= 60).' end,
    case when freshness_status in ('warning', 'stale')
      then 'Freshness status requires attention: ' || freshness_status || '.' end,
    case when not blocked and not review then 'All publication controls are within acceptable thresholds.' end) as reasons,
  (critical_rule_failures > 0)::int + has_sensitive_data_without_protection::int
    + (schema_contract_status = 'failed')::int + (data_quality_score < 80)::int + (privacy_risk_score >= 60)::int
    + (freshness_status in ('warning', 'stale'))::int + (not blocked and not review)::int as actions
from (select *, critical_rule_failures > 0 or has_sensitive_data_without_protection or schema_contract_status = 'failed'
    as blocked, data_quality_score < 80 or privacy_risk_score >= 60 or freshness_status in ('warning', 'stale') as review
  from gate_inputs)
""".replace("select *, case when blocked then", "select * exclude (blocked, review), case when blocked then"),
)
def _(spark, root):
    decided = gv.readiness_gate(gate_inputs(spark, root))
    return decided.withColumns(
        {"reasons": F.array_join("reasons", " / "), "actions": F.size("required_actions")}
    ).drop("required_actions")


@query(
    "batch_gate_per_brand",
    """
select *, case when decision = 'Blocked' then
    'Publication blocked because quality, privacy risk, or critical issues breached hard thresholds.'
  when decision = 'Needs Review' then
    'Publication requires manual review because quality or LGPD risk is in the review range.'
  else 'Publication approved because quality, LGPD risk, and critical issue thresholds passed.' end as reason,
  case when decision = 'Approved' then 'publication_gate_cli' else '' end as approved_by,
  case when decision = 'Approved' then '2024-02-01T00:00:00Z' else '' end as approved_at
from (select *, case when quality_score < 70 or lgpd_risk_score > 80 or critical_issues > 0 then 'Blocked'
    when quality_score between 70 and 89 or lgpd_risk_score between 61 and 80 then 'Needs Review'
    else 'Approved' end as decision
  from (select p_brand || '/' || p_type as dataset_name,
      cast(100 - 100 * count(*) filter (p_size > 44) // count(*) as bigint) as quality_score,
      cast(100 * count(*) filter (p_size <= 22) // count(*) as bigint) as lgpd_risk_score,
      count(*) filter (p_size = 50 and p_partkey % 7 = 0) as critical_issues
    from part group by 1))
""",
)
def _(spark, root):
    part = load(spark, root, "part")
    datasets = part.groupBy(F.concat_ws("/", "p_brand", "p_type").alias("dataset_name")).agg(
        F.expr("100 - 100 * count_if(p_size > 44) div count(*)").alias("quality_score"),
        F.expr("100 * count_if(p_size <= 22) div count(*)").alias("lgpd_risk_score"),
        F.expr("count_if(p_size = 50 and p_partkey % 7 = 0)").alias("critical_issues"),
    )
    return gv.batch_gate(datasets, "2024-02-01T00:00:00Z")


# ---- check rows per dataset ----------------------------------------------

ROW_FAMILIES = (
    "critical_nulls",
    "negative_price_and_freight",
    "temporal_coherence",
    "missing_pct_checks",
    "delay_null_consistency",
    "dimension_join_coverage",
    "minimum_volume",
)


def _per_state(row: str) -> str:
    """A check row of the whole fact as one row per customer state."""
    row = row.replace("select '", "select dataset_name, '", 1)
    row = row.replace("count(*) as n from fact", "count(*) as n, coalesce(customer_state, 'none') as dataset_name from fact group by all")
    return row


cte("state_checks", "\nunion all\n".join(_per_state(r) for f in ROW_FAMILIES for r in FAMILIES[f]))


def state_checks(spark, root):
    rows = fact(spark, root).withColumn("dataset_name", F.coalesce("customer_state", F.lit("none")))
    return ck.evaluate(rows, ck.row_checks(rows.columns, 50_000), ["dataset_name"])


query("checks_per_state", "select * from state_checks")(lambda s, r: state_checks(s, r).drop("details"))

cte(
    "state_contracts",
    """
select coalesce(customer_state, 'none') as dataset_name, 'min_rows' as check_name,
  case when count(*) >= 2300 then 'PASS' else 'FAIL' end as status, '' as severity
from fact group by 1
""",
)


def state_contracts(spark, root):
    grouped = fact(spark, root).groupBy(F.coalesce("customer_state", F.lit("none")).alias("dataset_name"))
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(
        "dataset_name",
        F.lit("min_rows").alias("check_name"),
        F.when(F.col("n") >= 2300, "PASS").otherwise("FAIL").alias("status"),
        F.lit("").alias("severity"),
    )


WEIGHT = "case lower(trim(severity)) when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 2 end"
HEALTH = "case when {s} >= 95 then 'healthy' when {s} >= 80 then 'attention' else 'critical' end"
cte(
    "metrics",
    f"""
select *, {HEALTH.format(s="score")} as status from (
  select dataset_name, dimension,
    round(sum(case when status = 'PASS' then {WEIGHT} else 0 end) / sum({WEIGHT}) * 100, 2) as score,
    count(*) as total_checks, count(*) filter (status <> 'PASS') as failed_checks
  from (select dataset_name, 'data_quality' as dimension, status, severity from state_checks
        union all select dataset_name, 'schema_contracts', status, severity from state_contracts) group by 1, 2)
""",
)


def metrics(spark, root):
    sources = {"data_quality": state_checks(spark, root), "schema_contracts": state_contracts(spark, root)}
    return gv.scorecard_metrics(gv.collect_check_sources(sources))


@query(
    "severity_weighted_score",
    f"""
select dataset_name, round(sum(case when status = 'PASS' then {WEIGHT} else 0 end) / sum({WEIGHT}) * 100, 2) as score,
  count(*) as total_checks, count(*) filter (status <> 'PASS') as failed_checks,
  {HEALTH.format(s=f"round(sum(case when status = 'PASS' then {WEIGHT} else 0 end) / sum({WEIGHT}) * 100, 2)")} as status
from state_checks group by 1
""",
)
def _(spark, root):
    return gv.scorecard_metrics(state_checks(spark, root), ("dataset_name",))


query("scorecard_metrics", "select * from metrics")(metrics)


@query(
    "dataset_scorecards",
    f"""
select *, {HEALTH.format(s="governance_score")} as status from (
  select dataset_name, round(cast(sum(cast(score as decimal(12, 2))) as double) / count(*), 2) as governance_score
  from metrics group by 1)
""",
)
def _(spark, root):
    return gv.dataset_scorecards(metrics(spark, root))


@query(
    "gate_signal_derivation",
    """
select c.dataset_name, count(*) filter (c.status = 'FAIL' and c.severity in ('high', 'critical')) as critical_rule_failures,
  greatest(0, 100 - 10 * count(*) filter (c.status = 'FAIL')) as data_quality_score,
  coalesce(any_value(l.open), false) as has_sensitive_data_without_protection,
  coalesce(any_value(case when k.status = 'FAIL' then 'failed' else 'passed' end), 'passed') as schema_contract_status,
  coalesce(any_value(f.state), 'fresh') as freshness_status
from state_checks c
left join state_contracts k on c.dataset_name = k.dataset_name
left join (select n_name, n_nationkey % 4 = 1 as open from nation) l on c.dataset_name = l.n_name
left join (select n_name, case when n_nationkey % 5 < 3 then 'fresh' when 30 + n_nationkey <= 36 * 1.5 and n_nationkey % 5 = 3
    then 'warning' else 'stale' end as state from nation where n_nationkey < 20) f on c.dataset_name = f.n_name
group by 1
""",
)
def _(spark, root):
    nation = load(spark, root, "nation")
    classes = nation.select(
        F.col("n_name").alias("dataset_name"),
        F.when(F.col("n_nationkey") % 4 < 2, "sensitive_personal_data").otherwise("personal_data").alias("lgpd_classification"),
        F.when(F.col("n_nationkey") % 4 == 1, "mask").otherwise("anonymize").alias("recommended_action"),
    )
    key = F.col("n_nationkey")
    freshness = nation.filter("n_nationkey < 20").select(
        F.col("n_name").alias("dataset_name"),
        F.when(key % 5 < 3, "PASS").otherwise("FAIL").alias("status"),
        F.when(key % 5 == 3, (30 + key).cast("string")).otherwise("missing").alias("metric_value"),
        F.lit("36").alias("threshold"),
    )
    return gv.gate_signals(state_checks(spark, root), classes, state_contracts(spark, root), freshness)


# ---- observability -------------------------------------------------------

cte(
    "history",
    """
select event_type as dataset_name, cast(ts as date) as day, count(*) as row_count,
  count(*) filter (value < 25) * 100.0::double / count(*) as null_rate, count(*) % 40 as privacy_risk_score,
  100 - count(*) % 30 as data_quality_score
from events group by 1, 2
""",
)


def history(spark, root):
    events = load(spark, root, "events")
    n, low = F.count(F.lit(1)), F.count(F.when(F.col("value") < 25, 1))
    return events.groupBy(F.col("event_type").alias("dataset_name"), F.to_date("ts").alias("day")).agg(
        n.alias("row_count"),
        (low * 100.0 / n).alias("null_rate"),
        (n % 40).alias("privacy_risk_score"),
        (100 - n % 30).alias("data_quality_score"),
    )


def _check_columns(name: str, metric: str, ok: str, limit: float, severity: str, digits: int) -> str:
    return (
        f"dataset_name, '{name}' as check_name, case when ({metric}) is null or {ok} then 'PASS' else 'FAIL' end as status, "
        f"case when ({metric}) is null then 'low' else '{severity}' end as severity, round({metric}, {digits}) as metric_value, "
        f"{limit}::double as threshold, "
        f"case when ({metric}) is null then 'insufficient_history' else 'evaluated' end as details"
    )


def _median_sql(name: str, column: str, metric: str, limit: float, digits: int) -> str:
    return f"""
select {_check_columns(name, metric, f"({metric}) <= {limit}", limit, "medium", digits)}
from (select dataset_name, max(v) filter (rn = 1) as latest, quantile_cont(v, 0.5) filter (rn > 1) as base
  from (select dataset_name, cast({column} as double) as v,
          row_number() over (partition by dataset_name order by day desc) as rn from history) group by 1)
"""


def _trend_sql(name: str, column: str, ok: str, limit: float) -> str:
    return f"""
select {_check_columns(name, "delta", ok, limit, "high", 2)}
from (select dataset_name, cast(max(v) filter (rn = 1) - max(v) filter (rn = 2) as double) as delta
  from (select dataset_name, {column} as v, row_number() over (partition by dataset_name order by day desc) as rn
        from history) group by 1)
"""


PCT = "case when base = 0 then (case when latest = 0 then 0.0 else 100.0 end) else abs((latest - base) / base) * 100 end"
OBSERVE = {
    "row_count_anomaly": _median_sql("row_count_anomaly", "row_count", PCT, 30.0, 2),
    "null_rate_drift": _median_sql("null_rate_drift", "null_rate", "latest - base", 10.0, 4),
    "privacy_risk_trend": _trend_sql("privacy_risk_trend", "privacy_risk_score", "delta <= 15", 15.0),
    "quality_score_trend": _trend_sql("quality_score_trend", "data_quality_score", "delta >= -10", -10.0),
}
for key, check in (
    ("row_count_anomaly", gv.row_count_anomaly),
    ("null_rate_drift", gv.null_rate_drift),
    ("privacy_risk_trend", gv.privacy_risk_trend),
    ("quality_score_trend", gv.quality_score_trend),
):
    query(key, OBSERVE[key])(lambda s, r, c=check: c(history(s, r), "day", ["dataset_name"]))

STATE_SQL = """
select dataset_name, 'freshness_status' as check_name, case when age = 0 then 'PASS' else 'FAIL' end as status,
  'high' as severity, cast(age as double) as metric_value, 0.0::double as threshold, 'evaluated' as details
from dataset_state
union all select dataset_name, 'schema_drift', case when missing = 0 then 'PASS' else 'FAIL' end, 'high',
  cast(missing as double), 0.0::double, 'evaluated' from dataset_state
"""
cte(
    "dataset_state",
    """
select event_type as dataset_name, case when max(ts) >= timestamp '2024-01-30 23:30:00' then 0
    when max(ts) >= timestamp '2024-01-30 23:25:00' then 1 else 2 end as age,
  min(user_id) as missing from events group by 1
""",
)


def dataset_state(spark, root):
    newest = F.max("ts")
    status = (
        F.when(newest >= F.lit("2024-01-30 23:30:00").cast("timestamp_ntz"), "fresh")
        .when(newest >= F.lit("2024-01-30 23:25:00").cast("timestamp_ntz"), "warning")
        .otherwise("stale")
    )
    return load(spark, root, "events").groupBy(F.col("event_type").alias("dataset_name")).agg(
        status.alias("freshness_status"), F.min("user_id").alias("missing_columns")
    )


@query("observability_suite", "\nunion all\n".join([STATE_SQL, *OBSERVE.values()]))
def _(spark, root):
    return gv.observability_suite(history(spark, root), dataset_state(spark, root), "day", ["dataset_name"])


# ---- monitoring and history ----------------------------------------------


def _mon(name: str, metric: str, ok: str, limit: float, severity: str, source: str = "published") -> str:
    return (
        f"select '{name}' as check_name, case when {ok} then 'PASS' else 'FAIL' end as status, "
        f"cast(m as double) as metric_value, {limit}::double as threshold, '{severity}' as severity "
        f"from (select {metric} as m from {source})"
    )


MONITOR = [
    _mon("published_expected_schema", "case when count(*) < 0 then 1 else 0 end", "m = 0", 0, "high"),
    _mon(
        "published_primary_key_duplicates",
        "coalesce(sum(c) filter (c > 1), 0)",
        "m = 0",
        0,
        "high",
        "(select count(*) as c from published group by order_id, order_item_id)",
    ),
    _mon("published_min_rows", "count(*)", "m >= 50000", 50000, "high"),
    *[
        _mon(f"published_critical_nulls__{c}", f"count(*) filter ({c} is null)", "m = 0", 0, "high")
        for c in gv.PUBLISHED_CRITICAL
    ],
    *[
        _mon(
            f"published_missing_pct__{c}",
            f"round(avg(case when {c} is null then 1 else 0 end) * 100, 2)",
            f"m <= {limit}",
            limit,
            "medium",
        )
        for c, limit in (("purchase_cohort_month", 0.0), ("seller_delay_rate", 1.0))
    ],
]
cte("monitoring", "\nunion all\n".join(MONITOR))
query("published_monitoring", "select * from monitoring")(
    lambda s, r: gv.monitor_published(published(s, r), 50_000).drop("details")
)


@query(
    "published_freshness_hours",
    """
select 'published_file_freshness_hours' as check_name, case when h <= 36 then 'PASS' else 'FAIL' end as status,
  h as metric_value, 36.0::double as threshold, 'high' as severity
from (select round(min(datediff('second', date_trunc('second', ts), timestamp '2024-02-01 12:00:00')) / 3600, 2) as h
  from events)
""",
)
def _(spark, root):
    times = load(spark, root, "events").select(F.date_trunc("second", F.col("ts").cast("timestamp")).alias("modified_at"))
    return gv.freshness_check(times, "2024-02-01 12:00:00").drop("details")


@query(
    "alert_payload",
    """
select '{"source":"published_layer_monitoring","environment":"prod","status":"' || case when count(*) > 0 then 'FAIL' else 'PASS' end
  || '","failed_checks":' || count(*) || ',"max_severity":"'
  || case when bool_or(severity = 'high') then 'high' when bool_or(severity = 'medium') then 'medium' else 'low' end
  || '","results":[' || coalesce(string_agg(
    '{"check_name":"' || check_name || '","status":"FAIL","metric_value":' || metric_value || ',"threshold":' || threshold
    || ',"severity":"' || severity || '","details":"'
    || case check_name when 'published_primary_key_duplicates' then 'grain: order_id, order_item_id' else '' end || '"}',
    ',' order by check_name), '') || ']}' as payload
from monitoring where status = 'FAIL'
""",
)
def _(spark, root):
    return gv.alert_payload(gv.monitor_published(published(spark, root), 50_000))


@query(
    "history_row_per_dataset",
    """
select d.*, round(coalesce(n.null_rate, 0), 4) as null_rate, 100 - least(10, f) * 10 as data_quality_score,
  f as failed_rules_count, w as warning_rules_count, c as critical_rules_count
from (select coalesce(customer_state, 'none') as dataset_name, count(*) as row_count,
        round((count(*) - count(distinct order_id)) / count(*) * 100, 4) as duplicate_rate,
        count(*) % 100 as privacy_risk_score, 'fresh' as freshness_status from fact group by 1) d
join (select dataset_name, count(*) filter (status = 'FAIL') as f,
        count(*) filter (status = 'FAIL' and severity not in ('high', 'critical')) as w,
        count(*) filter (status = 'FAIL' and severity in ('high', 'critical')) as c from state_checks group by 1) s
  on d.dataset_name = s.dataset_name
join (select coalesce(customer_state, 'none') as dataset_name,
        cast(cast(round(avg(case when product_category_name is null then 1 else 0 end) * 100, 2) as decimal(12, 6))
          + cast(round(avg(case when review_score_mean is null then 1 else 0 end) * 100, 2) as decimal(12, 6)) as double) / 2
          as null_rate from fact group by 1) n on d.dataset_name = n.dataset_name
""",
)
def _(spark, root):
    rows = fact(spark, root).withColumn("dataset_name", F.coalesce("customer_state", F.lit("none")))
    sizes = rows.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.count(F.lit(1)) - F.countDistinct("order_id")).alias("duplicate_rows"),
        (F.count(F.lit(1)) % 100).alias("privacy_risk_score"),
        F.lit("fresh").alias("freshness_status"),
    )
    missing = [
        F.round(F.avg(F.when(F.col(c).isNull(), 1).otherwise(0)) * 100, 2).alias(c)
        for c in ("product_category_name", "review_score_mean")
    ]
    nulls = rows.groupBy("dataset_name").agg(*missing).unpivot(
        "dataset_name", ["product_category_name", "review_score_mean"], "column_name", "null_pct"
    )
    return gv.history_row(sizes, nulls, state_checks(spark, root), ["dataset_name"])
