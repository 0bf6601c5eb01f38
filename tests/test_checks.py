from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradeledger.operators import checks as ck
from tradeledger.operators import contracts as ct

AS_OF = "2024-01-01 00:00:00"


@pytest.fixture
def fact(spark):
    t = datetime(2018, 1, 1)
    row = ("o1", 1, "c1", "p1", "s1", t, t, t, 10.0, 1.0, 5.0, "cat", "u1", "SP", "SP", "card", 0.5, 11.0, 22.0)
    names = (
        "order_id string, order_item_id int, customer_id string, product_id string, seller_id string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, price double, freight_value double, review_score_mean double, "
        "product_category_name string, customer_unique_id string, customer_state string, seller_state string, "
        "payment_type_mode string, estimated_delay_days double, total_item_value double, total_payment_value double"
    )
    second = (row[0], 2, *row[2:])
    return spark.createDataFrame([row, second], names)


def by_name(df, key="check_name"):
    return {r[key]: r for r in (x.asDict() for x in df.collect())}


def test_suite_has_25_results_and_passes(fact):
    got = by_name(ck.fact_quality_suite(fact, minimum=2))
    assert len(got) == 25
    failed = {n for n, r in got.items() if r["status"] != "PASS"}
    assert failed == {"expected_schema"}  # the small frame lacks derived columns


@pytest.mark.parametrize(
    ("column", "value", "check", "status"),
    [
        ("price", "-1.0D", "negative_price_values", "FAIL"),
        ("customer_id", "cast(null as string)", "critical_nulls__customer_id", "FAIL"),
        ("order_item_id", "1", "granularity_duplicates", "FAIL"),
        ("total_payment_value", "0.0D", "payment_reconciliation_gap_over_1_real_pct", "FAIL"),
        ("estimated_delay_days", "cast(null as double)", "delay_null_consistency", "FAIL"),
        ("review_score_mean", "cast(null as double)", "review_score_missing_pct", "FAIL"),
        ("order_approved_at", "timestamp_ntz '2017-01-01'", "temporal_coherence__approval_before_purchase", "FAIL"),
    ],
)
def test_suite_reacts_to_damage(fact, column, value, check, status):
    assert by_name(ck.fact_quality_suite(fact.withColumn(column, F.expr(value)), 2))[check]["status"] == status


def test_residual_delivery_before_approval_warns(spark):
    t, later = datetime(2018, 1, 1), datetime(2018, 1, 2)
    df = spark.range(2000).select(
        F.lit(t).alias("order_purchase_timestamp"),
        F.when(F.col("id") == 0, F.lit(later)).otherwise(F.lit(t)).alias("order_approved_at"),
        F.lit(t).alias("order_delivered_customer_date"),
    )
    got = by_name(ck.evaluate(df, ck.temporal_coherence()))
    assert got["temporal_coherence__delivery_before_approval"]["status"] == "WARN"


def test_absent_dimension_column_counts_as_missing(fact):
    got = by_name(ck.evaluate(fact.drop("seller_state"), ck.dimension_coverage(fact.drop("seller_state").columns)))
    row = got["dimension_join_missing_pct__seller_state"]
    assert (row["status"], row["metric_value"]) == ("FAIL", 100.0)


def test_checks_per_group(fact):
    grouped = fact.withColumn("g", F.col("order_item_id")).withColumn("price", F.when(F.col("g") == 2, -1.0).otherwise(1.0))
    got = {(r["g"], r["check_name"]): r["status"] for r in ck.evaluate(grouped, ck.negative_values(), ["g"]).collect()}
    assert got[1, "negative_price_values"] == "PASS" and got[2, "negative_price_values"] == "FAIL"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [
            ("a", 10.0, "2020-01-01", "x@y.com", "open"),
            ("a", None, "2030-01-01", None, None),
            ("b", -5.0, "bad", "z", "odd"),
        ],
        "order_id string, revenue double, order_date string, customer_email string, order_status string",
    )


RULES = [
    {"name": "nn", "type": "not_null", "columns": ["customer_email", "revenue"], "severity": "high"},
    {"name": "uq", "type": "unique", "columns": ["order_id"], "severity": "high"},
    {"name": "rg", "type": "accepted_range", "columns": ["revenue"], "params": {"min": 0, "max": 100}},
    {"name": "fd", "type": "no_future_dates", "columns": ["order_date"]},
    {"name": "ng", "type": "no_negative_values", "columns": ["revenue"]},
    {"name": "np", "type": "max_null_pct", "columns": ["revenue", "order_id"], "params": {"max_null_pct": 10}},
    {"name": "av", "type": "allowed_values", "columns": ["order_status"], "params": {"allowed": ["open"]}},
    {"name": "ab", "type": "not_null", "columns": ["nope"], "severity": "high"},
    {"name": "uk", "type": "mystery", "columns": ["order_id"]},
]


def test_declared_rules(table):
    got = by_name(ck.run_quality_rules(table, RULES, AS_OF))
    rows = {n: (r["status"], r["affected_rows"], r["affected_columns"]) for n, r in got.items()}
    assert rows == {
        "nn": ("FAIL", 1, "customer_email, revenue"),
        "uq": ("FAIL", 2, "order_id"),
        "rg": ("FAIL", 1, "revenue"),
        "fd": ("FAIL", 1, "order_date"),
        "ng": ("FAIL", 1, "revenue"),
        "np": ("FAIL", 3, "revenue"),
        "av": ("FAIL", 2, "order_status"),  # a missing value is not allowed
        "ab": ("FAIL", 0, "nope"),
    }
    assert got["nn"]["severity"] == "high"


def test_generic_table_checks(table):
    got = by_name(ck.table_quality_checks(table.unionByName(table.limit(1)), AS_OF))
    assert got["duplicate_rows"]["affected_rows"] == 1
    assert got["negative_values__revenue"]["status"] == "FAIL"
    assert got["future_dates__order_date"]["affected_rows"] == 1
    assert got["constant_columns"]["status"] == "PASS"
    # 1 of 3 rows without revenue, email and status
    nulls = by_name(ck.table_quality_checks(table, AS_OF))["high_null_columns_over_30pct"]
    assert (nulls["status"], nulls["affected_rows"]) == ("FAIL", 3)
    assert nulls["affected_columns"] == "customer_email, order_status, revenue"


def test_cardinality_counts_null_as_a_value(table):
    got = {r["column_name"]: r for r in (x.asDict() for x in ck.cardinality(table).collect())}
    assert got["order_status"]["cardinality"] == 3 and got["order_status"]["possible_unique_key"]
    assert got["order_id"]["cardinality"] == 2


def test_business_rules(spark):
    df = spark.createDataFrame(
        [(-1.0, None, "unknown", 1, 2), (5.0, None, "delivered", None, 2), (5.0, "d", None, 3, 2)],
        "price double, delivered string, status string, a int, b int",
    )

    def rule(name, kind, **rest):
        return {"rule_id": name, "type": kind, "severity": "high", **rest}

    rules = [
        rule("range", "range", column="price", params={"min": 0}),
        rule("cond", "not_null_if", column="delivered", params={"if_column": "status", "if_equals": "delivered"}),
        rule("values", "accepted_values", column="status", params={"allowed": ["delivered"]}),
        rule("expr", "expression", params={"expression": "a >= b"}),
        rule("tolerated", "range", column="price", params={"min": 0, "max_failure_pct": 40}),
    ] + [
        rule(op, "compare_columns", columns=["a", "b"], params={"operator": op}) for op in (">=", ">", "<=", "<", "==")
    ]
    got = by_name(ck.run_business_rules(df, rules), "rule_id")
    failed = {n: r["failed_rows"] for n, r in got.items()}
    assert failed == {
        "range": 1, "cond": 1, "values": 1, "expr": 2, "tolerated": 1,
        ">=": 1, ">": 1, "<=": 1, "<": 1, "==": 2,
    }
    assert got["tolerated"]["status"] == "PASS" and "tolerance" in got["tolerated"]["details"]
    assert got["range"]["failure_pct"] == 33.3333
    with pytest.raises(ValueError, match="operator"):
        ck.business_rule_failure(rule("x", "compare_columns", columns=["a", "b"], params={"operator": "!="}))
    with pytest.raises(ValueError, match="unsupported rule type"):
        ck.business_rule_failure(rule("x", "nope"))


def test_contract(spark):
    df = spark.createDataFrame([(1, "a", 1.5), (1, "b", 2.5)], "id long, name string, price double")
    contract = {
        "dataset_name": "t", "layer": "raw", "primary_key": ["id"], "min_rows": 3,
        "columns": {"id": "integer", "name": "integer", "price": "float", "gone": "string"},
    }
    checks = ct.validate_contract(df, contract)
    got = {r["check_name"]: r["status"] for r in checks.collect()}
    assert got == {
        "missing_columns": "FAIL", "unexpected_columns": "PASS", "type__id": "PASS", "type__name": "FAIL",
        "type__price": "PASS", "min_rows": "FAIL", "primary_key_duplicates": "FAIL",
    }
    pair = {r["check_name"]: (r["expected"], r["actual"]) for r in ct.expected_and_actual(checks).collect()}
    assert pair["type__name"] == ("integer", "string")
    with pytest.raises(ValueError, match="unknown contract type"):
        ct.type_matches(df.schema["id"].dataType, "money")


def test_status_summary_and_failures(spark):
    checks = spark.createDataFrame([("PASS", "low"), ("warn", "low"), ("ERROR", "high"), ("FAIL", "medium"), ("FAIL", "low")], "status string, severity string")
    assert ck.status_summary(checks).first().asDict() == {"passed": 1, "warning": 1, "failed": 3, "total": 5}
    assert ck.failures(checks).count() == 1
