import json
from datetime import date

import pytest

from tradeledger.operators import governance as gv

INPUT = (
    "dataset string, data_quality_score int, privacy_risk_score int, critical_rule_failures int, "
    "freshness_status string, schema_contract_status string, has_sensitive_data_without_protection boolean"
)


@pytest.mark.parametrize(
    ("row", "decision", "severity", "reasons"),
    [
        ((95, 20, 0, "fresh", "passed", False), "Approved", "Low", 1),
        ((79, 20, 0, "fresh", "passed", False), "Needs Review", "Medium", 1),
        ((95, 60, 0, "fresh", "passed", False), "Needs Review", "Medium", 1),
        ((95, 80, 0, "fresh", "passed", False), "Needs Review", "High", 1),
        ((95, 20, 0, "warning", "passed", False), "Needs Review", "Medium", 1),
        ((95, 20, 0, "stale", "passed", False), "Needs Review", "High", 1),
        ((95, 20, 1, "fresh", "passed", False), "Blocked", "Critical", 1),
        ((95, 20, 0, "fresh", "failed", False), "Blocked", "Critical", 1),
        ((95, 20, 0, "fresh", "passed", True), "Blocked", "Critical", 1),
        ((10, 99, 3, "stale", "failed", True), "Blocked", "Critical", 6),
    ],
)
def test_readiness_gate(spark, row, decision, severity, reasons):
    got = gv.readiness_gate(spark.createDataFrame([("d", *row)], INPUT)).first()
    assert (got["decision"], got["severity"], len(got["reasons"])) == (decision, severity, reasons)
    assert len(got["required_actions"]) == reasons


@pytest.mark.parametrize(
    ("row", "decision"),
    [
        ((92, 45, 0), "Approved"),
        ((89, 45, 0), "Needs Review"),
        ((90, 60, 0), "Approved"),
        ((90, 61, 0), "Needs Review"),
        ((69, 10, 0), "Blocked"),
        ((95, 81, 0), "Blocked"),
        ((95, 10, 1), "Blocked"),
    ],
)
def test_batch_gate(spark, row, decision):
    df = spark.createDataFrame([row], "quality_score int, lgpd_risk_score int, critical_issues int")
    got = gv.batch_gate(df, "2026-01-01", "me").first()
    assert got["decision"] == decision
    assert (got["approved_by"], got["approved_at"]) == (("me", "2026-01-01") if decision == "Approved" else ("", ""))


def test_scorecards(spark):
    checks = spark.createDataFrame(
        [
            ("a", "data_quality", "PASS", "high"),
            ("a", "data_quality", "WARN", "low"),
            ("a", "data_quality", "FAIL", "critical"),  # unknown weight 2
            ("a", "rules", "PASS", None),
            ("b", "rules", "PASS", "low"),
        ],
        "dataset_name string, dimension string, status string, severity string",
    )
    metrics = gv.scorecard_metrics(checks)
    got = {(r["dataset_name"], r["dimension"]): (r["score"], r["total_checks"], r["failed_checks"]) for r in metrics.collect()}
    assert got == {("a", "data_quality"): (50.0, 3, 2), ("a", "rules"): (100.0, 1, 0), ("b", "rules"): (100.0, 1, 0)}
    cards = {r["dataset_name"]: (r["governance_score"], r["status"]) for r in gv.dataset_scorecards(metrics).collect()}
    assert cards == {"a": (75.0, "critical"), "b": (100.0, "healthy")}


def history(spark, *points):
    rows = [("d", date(2024, 1, i + 1), *p) for i, p in enumerate(points)]
    schema = "dataset_name string, day date, row_count string, null_rate double, privacy_risk_score int, data_quality_score int"
    return spark.createDataFrame(rows, schema)


def state(spark, freshness="fresh", missing=0):
    return spark.createDataFrame([("d", freshness, missing)], "dataset_name string, freshness_status string, missing_columns int")


def statuses(df):
    return {r["check_name"]: r["status"] for r in df.collect()}


def test_observability_all_pass(spark):
    log = history(spark, ("100", 1.0, 10, 90), ("oops", 1.0, 10, 90), ("110", 2.0, 20, 85))
    got = statuses(gv.observability_suite(log, state(spark), "day", ["dataset_name"]))
    assert len(got) == 6 and set(got.values()) == {"PASS"}


def test_observability_all_fail(spark):
    log = history(spark, ("100", 1.0, 10, 90), ("300", 20.0, 40, 60))
    got = statuses(gv.observability_suite(log, state(spark, "stale", 2), "day", ["dataset_name"]))
    assert len(got) == 6 and set(got.values()) == {"FAIL"}


def test_observability_needs_two_points(spark):
    log = history(spark, ("100", 1.0, 10, 90))
    got = gv.observability_suite(log, state(spark), "day", ["dataset_name"]).collect()
    drift = {r["check_name"]: (r["status"], r["severity"], r["details"]) for r in got if r["check_name"] not in ("freshness_status", "schema_drift")}
    assert set(drift.values()) == {("PASS", "low", "insufficient_history")}


def test_zero_baseline(spark):
    rows = gv.row_count_anomaly(history(spark, ("0", 0.0, 0, 0), ("5", 0.0, 0, 0)), "day", ["dataset_name"])
    assert rows.first()["metric_value"] == 100.0


def test_alert_payload_lists_failures_only(spark):
    checks = spark.createDataFrame(
        [("a", "PASS", 0.0, 0.0, "high", ""), ("b", "FAIL", 2.0, 0.0, "medium", "x")],
        "check_name string, status string, metric_value double, threshold double, severity string, details string",
    )
    doc = json.loads(gv.alert_payload(checks).first()["payload"])
    assert (doc["status"], doc["failed_checks"], doc["max_severity"]) == ("FAIL", 1, "medium")
    assert [r["check_name"] for r in doc["results"]] == ["b"]
    calm = json.loads(gv.alert_payload(checks.filter("status = 'PASS'")).first()["payload"])
    assert (calm["status"], calm["max_severity"], calm["results"]) == ("PASS", "low", [])


def test_signals_fall_back_to_passed_and_fresh(spark):
    checks = spark.createDataFrame([("d", "FAIL", "critical"), ("d", "FAIL", "low")], "dataset_name string, status string, severity string")
    none = spark.createDataFrame([], "dataset_name string, status string, metric_value string, threshold string, lgpd_classification string, recommended_action string")
    got = gv.gate_signals(checks, none, none, none).first()
    assert (got["critical_rule_failures"], got["data_quality_score"]) == (1, 80)
    assert (got["schema_contract_status"], got["freshness_status"]) == ("passed", "fresh")


def test_operational_rollup_ignores_unreadable_numbers(spark):
    logs = spark.createDataFrame(
        [("SUCCESS", "10", "0", "90", "5"), ("warn", "x", "2", None, "7"), (None, "5", None, "80", "9")],
        "status string, rows_processed string, records_rejected string, quality_score string, lgpd_risk_score string",
    )
    got = gv.operational_rollup(logs).first().asDict()
    assert got == {
        "failures": 0, "warnings": 1, "rows_processed": 15, "records_rejected": 2,
        "avg_quality_score": 85.0, "avg_risk_score": 7.0,
    }
