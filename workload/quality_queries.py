"""Data quality, business rules, contracts and publication controls (ids B21, D21, J, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.operators import checks as ck
from tradeledger.operators import contracts as ct
from tradeledger.plans import published as pb
from tradeledger.sources.commerce import commerce
from workload.base import cte, pseudonym, query
from workload.inputs import fact, published
from workload.profile_queries import COLUMNS, load

MIN_ROWS = 50_000
AS_OF = "2001-06-01 00:00:00"

# ---- fact suite ----------------------------------------------------------


def _row(name: str, metric: str, ok: str, threshold: float, severity: str, source: str = "fact") -> str:
    """One check row; ``ok`` is a condition on m, or a full CASE giving the status."""
    status = ok if ok.startswith("case") else f"case when {ok} then 'PASS' else 'FAIL' end"
    return (
        f"select '{name}' as check_name, {status} as status, cast(m as double) as metric_value, "
        f"cast({threshold} as double) as threshold, '{severity}' as severity "
        f"from (select {metric} as m, count(*) as n from {source})"
    )


def _none(name: str, bad: str, severity: str) -> str:
    return _row(name, f"count(*) filter ({bad})", "m = 0", 0, severity)


def _pct(name: str, bad: str, limit: float, source: str = "fact") -> str:
    metric = f"round(avg(case when {bad} then 1 else 0 end) * 100, 2)"
    return _row(name, metric, f"m <= {limit}", limit, "medium", source)


DELIVERED, APPROVED, PURCHASE = "order_delivered_customer_date", "order_approved_at", "order_purchase_timestamp"
FAMILIES: dict[str, list[str]] = {
    "critical_nulls": [_none(f"critical_nulls__{c}", f"{c} is null", "high") for c in ck.CRITICAL_COLUMNS],
    "negative_price_and_freight": [
        _none("negative_price_values", "coalesce(price, 0) < 0", "high"),
        _none("negative_freight_values", "coalesce(freight_value, 0) < 0", "high"),
    ],
    "temporal_coherence": [
        _none("temporal_coherence__approval_before_purchase", f"{APPROVED} < {PURCHASE}", "medium"),
        _none("temporal_coherence__delivery_before_purchase", f"{DELIVERED} < {PURCHASE}", "high"),
        _row(
            "temporal_coherence__delivery_before_approval",
            f"count(*) filter ({DELIVERED} < {APPROVED})",
            "case when round(m / n * 100, 4) > 0.1 then 'FAIL' when m > 0 then 'WARN' else 'PASS' end",
            0.1,
            "medium",
        ),
    ],
    "missing_pct_checks": [
        _pct("review_score_missing_pct", "review_score_mean is null", 35.0),
        _pct("category_missing_pct", "product_category_name is null", 5.0),
        _pct("undelivered_orders_pct", f"{DELIVERED} is null", 5.0),
    ],
    "delay_null_consistency": [
        _none("delay_null_consistency", f"({DELIVERED} is null) <> (estimated_delay_days is null)", "high")
    ],
    "dimension_join_coverage": [
        _pct(f"dimension_join_missing_pct__{c}", f"{c} is null", 1.0)
        for c in ("customer_unique_id", "customer_state", "seller_state", "payment_type_mode")
    ],
    "minimum_volume": [_row("record_volume_above_100k", "count(*)", f"m >= {MIN_ROWS}", MIN_ROWS, "high")],
    "grain_duplicates_all_members": [
        _row(
            "granularity_duplicates",
            "cast(coalesce(sum(c) filter (c > 1), 0) as bigint)",
            "m = 0",
            0,
            "high",
            "(select count(*) as c from fact group by order_id, order_item_id, product_id, seller_id)",
        )
    ],
    "payment_reconciliation_check": [
        _pct("payment_reconciliation_gap_over_1_real_pct", "gap > 1", 5.0, "order_gaps")
    ],
}
SCHEMA_ROW = (
    "select 'expected_schema' as check_name, 'PASS' as status, 0.0::double as metric_value, "
    "0.0::double as threshold, 'high' as severity where (select count(*) from fact) >= 0"
)
SUITE = "\nunion all\n".join([row for rows in FAMILIES.values() for row in rows] + [SCHEMA_ROW])
cte("suite", SUITE)
PARTS = {
    "critical_nulls": lambda f: ck.evaluate(f, ck.critical_nulls()),
    "negative_price_and_freight": lambda f: ck.evaluate(f, ck.negative_values()),
    "temporal_coherence": lambda f: ck.evaluate(f, ck.temporal_coherence()),
    "missing_pct_checks": lambda f: ck.evaluate(f, ck.missing_percentages()),
    "delay_null_consistency": lambda f: ck.evaluate(f, ck.delay_null_consistency()),
    "dimension_join_coverage": lambda f: ck.evaluate(f, ck.dimension_coverage(f.columns)),
    "minimum_volume": lambda f: ck.evaluate(f, ck.record_volume(MIN_ROWS)),
    "grain_duplicates_all_members": ck.grain_duplicates,
    "payment_reconciliation_check": ck.reconciliation_check,
}
for key, build in PARTS.items():
    query(key, "\nunion all\n".join(FAMILIES[key]))(lambda s, r, b=build: b(fact(s, r)).drop("details"))


def suite(spark, root):
    return ck.fact_quality_suite(fact(spark, root), MIN_ROWS)


query("quality_suite", "select * from suite")(lambda s, r: suite(s, r).drop("details"))
query(
    "failed_checks_high_medium", "select * from suite where status = 'FAIL' and severity in ('high', 'medium')"
)(lambda s, r: ck.failures(suite(s, r)).drop("details"))
query(
    "check_status_summary",
    "select count(*) filter (status = 'PASS') as passed, count(*) filter (status = 'WARN') as warning, "
    "count(*) filter (status in ('FAIL', 'FAILED', 'ERROR')) as failed, count(*) as total from suite",
)(lambda s, r: ck.status_summary(suite(s, r)))
query(
    "quality_score",
    "select greatest(0, 100 - 10 * count(*) filter (status = 'FAIL')) as data_quality_score from suite",
)(
    lambda s, r: suite(s, r).agg(
        ck.quality_score(F.count(F.when(F.col("status") == "FAIL", 1))).alias("data_quality_score")
    )
)

# ---- generic checks ------------------------------------------------------


@query(
    "null_pct_per_column",
    "select column_name, null_pct, null_pct > 30 as over_30pct from ("
    + "\nunion all\n".join(
        f"select '{c}' as column_name, round(count(*) filter ({c} is null) / count(*) * 100, 2) as null_pct from raw_orders"
        for c in COLUMNS["raw_orders"].split()
    )
    + ")",
)
def _(spark, root):
    return ck.null_percent_by_column(commerce(spark, root).orders)


@query(
    "duplicate_rows_extras_only",
    """
select cast(sum(n - 1) as bigint) as duplicate_rows
from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
""",
)
def _(spark, root):
    return ck.duplicate_extras(load(spark, root, "lineitem").select("l_orderkey", "l_linenumber"))


def _cardinality(c: str) -> str:
    values = f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end)"
    return (
        f"select '{c}' as column_name, cast({values} as bigint) as cardinality, {values} = count(*) as "
        f"possible_unique_key, {values} <= 1 as constant from raw_orders"
    )


@query(
    "cardinality_unique_and_constant",
    "\nunion all\n".join(_cardinality(c) for c in COLUMNS["raw_orders"].split()),
)
def _(spark, root):
    return ck.cardinality(commerce(spark, root).orders)


def _affected(name: str, column: str, bad: str, table: str) -> str:
    return (
        f"select '{name}' as check_name, case when m > 0 then 'FAIL' else 'PASS' end as status, "
        f"case when m > 0 then 'medium' else 'low' end as severity, '{column}' as affected_columns, "
        f"m as affected_rows from (select count(*) filter ({bad}) as m from {table})"
    )


@query(
    "keyword_guarded_negative_checks",
    "\nunion all\n".join(
        _affected(f"negative_values__{c}", c, f"coalesce({c}, 0) < 0", "raw_items") for c in ("price", "freight_value")
    ),
)
def _(spark, root):
    rows = ck.negative_number_checks(commerce(spark, root).items)
    return rows.drop("recommendation", "rule_source")


@query(
    "future_dates",
    "\nunion all\n".join(
        _affected(f"future_dates__{c}", c, f"{c} > timestamp '{AS_OF}'", "raw_orders")
        for c in COLUMNS["raw_orders"].split()
        if "date" in c or "timestamp" in c or c.endswith("_at")
    ),
)
def _(spark, root):
    return ck.future_date_checks(commerce(spark, root).orders, AS_OF).drop("recommendation", "rule_source")


ORDER_COLUMNS = COLUMNS["raw_orders"].split()


def _listed(condition: str) -> str:
    """Names of the columns of raw_orders for which the aggregate ``condition`` holds."""
    return "concat_ws(', ', " + ", ".join(f"case when {condition.format(c=c)} then '{c}' end" for c in ORDER_COLUMNS) + ")"


TABLE_CHECKS = [
    # name, severity, columns, affected rows, advice, source, relation
    (
        "high_null_columns_over_30pct", "high", _listed("count(*) filter ({c} is null) * 100 > 30 * count(*)"),
        "case when cols <> '' then total else 0 end", "Review source completeness.", "built_in", "raw_orders",
    ),
    (
        "duplicate_rows", "high", "''", "total - max(different)", "Remove duplicates and validate the grain.", "built_in",
        "raw_orders, (select count(*) as different from (select distinct * from raw_orders))",
    ),
    (
        "constant_columns", "medium", _listed("count(distinct {c}) + max(case when {c} is null then 1 else 0 end) <= 1"),
        "case when cols <> '' then total else 0 end", "Drop or review constant columns.", "built_in", "raw_orders",
    ),
    *(
        (
            f"future_dates__{c}", "medium", f"'{c}'", f"count(*) filter ({c} > timestamp '{AS_OF}')",
            "Correct reference dates or check time zones.", "built_in", "raw_orders",
        )
        for c in ORDER_COLUMNS
        if "date" in c or "timestamp" in c or c.endswith("_at")
    ),
    (
        "status_allowed", "medium", "'order_status'",
        "count(*) filter (not coalesce(order_status in ('delivered', 'shipped', 'processing'), false))",
        "Review data quality issue.", "contract", "raw_orders",
    ),
]


def _table_check_sql(name, severity, columns, affected, advice, source, relation) -> str:
    found = affected.replace("cols", f"({columns})").replace("total", "count(*)")
    return (
        f"select '{name}' as check_name, case when m > 0 then 'FAIL' else 'PASS' end as status, "
        f"case when m > 0 then '{severity}' else 'low' end as severity, c as affected_columns, cast(m as bigint) as affected_rows, "
        f"'{advice}' as recommendation, '{source}' as rule_source from (select {columns} as c, {found} as m from {relation})"
    )


@query(
    "table_quality_checks",
    "\nunion all\n".join(_table_check_sql(*check) for check in TABLE_CHECKS)
    + "\nunion all select 'absent_column_fails', 'FAIL', 'high', 'customer_email', 0, 'Review data quality issue.', 'contract'",
)
def _(spark, root):
    return ck.table_quality_checks(commerce(spark, root).orders, AS_OF, ORDER_RULES)


# ---- declared rules ------------------------------------------------------

RULES = {
    "rule_not_null": {"type": "not_null", "columns": ["product_id", "price"], "severity": "high"},
    "rule_unique": {"type": "unique", "columns": ["order_id", "order_item_id"], "severity": "high"},
    "rule_accepted_range": {"type": "accepted_range", "columns": ["price"], "params": {"min": 1000, "max": 90000}},
    "rule_no_future_dates": {"type": "no_future_dates", "columns": ["shipping_limit_date"], "severity": "low"},
    "rule_no_negative_values": {"type": "no_negative_values", "columns": ["price"], "severity": "high"},
    "rule_max_null_pct": {
        "type": "max_null_pct",
        "columns": ["price", "product_id", "seller_id"],
        "params": {"max_null_pct": 0.1},
    },
}
ORDER_RULES = [
    {
        "name": "status_allowed",
        "type": "allowed_values",
        "columns": ["order_status"],
        "severity": "medium",
        "params": {"allowed": ["delivered", "shipped", "processing"]},
    },
    {"name": "unknown_type_is_skipped", "type": "no_such_rule", "columns": ["order_id"]},
    {"name": "absent_column_fails", "type": "not_null", "columns": ["customer_email"], "severity": "high"},
]
BAD = {
    "rule_not_null": ("product_id, price", "product_id is null or price is null"),
    "rule_accepted_range": ("price", "not coalesce(price, 1000) between 1000 and 90000"),
    "rule_no_future_dates": ("shipping_limit_date", f"shipping_limit_date > timestamp '{AS_OF}'"),
    "rule_no_negative_values": ("price", "coalesce(price, 0) < 0"),
}


def _rule_sql(name: str) -> str:
    severity = RULES[name].get("severity", "medium")
    if name == "rule_unique":
        shown = "'order_id, order_item_id'"
        found = "select coalesce(sum(n) filter (n > 1), 0) as m from (select count(*) as n from raw_items group by order_id, order_item_id)"
    elif name == "rule_max_null_pct":
        cols = RULES[name]["columns"]
        over = ", ".join(f"case when avg(case when {c} is null then 1 else 0 end) * 100 > 0.1 then '{c}' end" for c in cols)
        return (
            f"select '{name}' as check_name, case when c <> '' then 'FAIL' else 'PASS' end as status, "
            f"case when c <> '' then '{severity}' else 'low' end as severity, c as affected_columns, "
            f"case when c <> '' then n else 0 end as affected_rows "
            f"from (select concat_ws(', ', {over}) as c, count(*) as n from raw_items)"
        )
    else:
        shown, bad = f"'{BAD[name][0]}'", BAD[name][1]
        found = f"select count(*) filter ({bad}) as m from raw_items"
    return (
        f"select '{name}' as check_name, case when m > 0 then 'FAIL' else 'PASS' end as status, "
        f"case when m > 0 then '{severity}' else 'low' end as severity, {shown} as affected_columns, "
        f"cast(m as bigint) as affected_rows from ({found})"
    )


for key, rule in RULES.items():
    query(key, _rule_sql(key))(
        lambda s, r, k=key, x=rule: ck.run_quality_rules(commerce(s, r).items, [{"name": k, **x}], AS_OF).drop(
            "recommendation", "rule_source"
        )
    )


@query(
    "rule_allowed_values",
    """
select 'status_allowed' as check_name, case when m > 0 then 'FAIL' else 'PASS' end as status,
  case when m > 0 then 'medium' else 'low' end as severity, 'order_status' as affected_columns, m as affected_rows
from (select count(*) filter (order_status is null or order_status not in ('delivered', 'shipped', 'processing')) as m
      from raw_orders)
union all select 'absent_column_fails', 'FAIL', 'high', 'customer_email', 0::bigint
""",
)
def _(spark, root):
    rows = ck.run_quality_rules(commerce(spark, root).orders, ORDER_RULES, AS_OF)
    return rows.drop("recommendation", "rule_source")


# ---- business rules ------------------------------------------------------

BUSINESS = {
    "business_rule_range": (
        {"type": "range", "column": "price", "params": {"min": 2000, "max": 80000}},
        "price < 2000 or price > 80000",
    ),
    "business_rule_not_null_if": (
        {
            "type": "not_null_if",
            "column": "review_score_mean",
            "params": {"if_column": "order_status", "if_equals": "delivered"},
        },
        "order_status = 'delivered' and review_score_mean is null",
    ),
    "business_rule_accepted_values": (
        {"type": "accepted_values", "column": "payment_type_mode", "params": {"allowed": ["boleto", "credit_card"]}},
        "payment_type_mode not in ('boleto', 'credit_card')",
    ),
    "business_rule_compare_columns": (
        {
            "type": "compare_columns",
            "columns": ["order_delivered_customer_date", "order_approved_at"],
            "params": {"operator": ">="},
        },
        "order_delivered_customer_date < order_approved_at",
    ),
    "business_rule_expression": (
        {"type": "expression", "params": {"expression": "total_item_value >= price and delivery_time_days < 70"}},
        "not coalesce(total_item_value >= price and delivery_time_days < 70, false)",
    ),
}


def _business(name: str, limit: float | None = None) -> dict:
    rule = {"rule_id": name, "severity": "high", "description": name, **BUSINESS[name][0]}
    if limit is not None:
        rule["params"] = {**rule.get("params", {}), "max_failure_pct": limit}
    return rule


def _business_sql(name: str, limit: float | None = None) -> str:
    ok = "f = 0" if limit is None else f"f = 0 or round(f / n * 100, 4) <= {limit}"
    return (
        f"select '{name}' as rule_id, case when {ok} then 'PASS' else 'FAIL' end as status, 'high' as severity, "
        f"f as failed_rows, round(f / n * 100, 4) as failure_pct "
        f"from (select count(*) filter ({BUSINESS[name][1]}) as f, count(*) as n from fact)"
    )


for key in BUSINESS:
    query(key, _business_sql(key))(
        lambda s, r, k=key: ck.run_business_rules(fact(s, r), [_business(k)]).drop("details")
    )
query("business_rules_with_tolerance", "\nunion all\n".join(_business_sql(k, 30.0) for k in BUSINESS))(
    lambda s, r: ck.run_business_rules(fact(s, r), [_business(k, 30.0) for k in BUSINESS]).drop("details")
)


@query(
    "column_tests_unique_not_null_accepted",
    """
select 'orders' as model, 'order_id' as column_name, 'unique' as test, count(*) as failures
from (select order_id from raw_orders where order_id is not null group by 1 having count(*) > 1)
union all select 'orders', 'order_purchase_timestamp', 'not_null', count(*) from raw_orders
  where order_purchase_timestamp is null
union all select 'orders', 'order_status', 'accepted_values', count(*) from raw_orders
  where order_status not in ('delivered', 'shipped')
""",
)
def _(spark, root):
    tests = [
        ("order_id", "unique"),
        ("order_purchase_timestamp", "not_null"),
        ("order_status", "accepted_values", ["delivered", "shipped"]),
    ]
    return ck.run_column_tests(commerce(spark, root).orders, "orders", tests)


# ---- contracts and publication -------------------------------------------

CONTRACT = {
    "dataset_name": "order_items",
    "layer": "raw",
    "columns": {
        "order_id": "integer",
        "order_item_id": "integer",
        "product_id": "string",
        "seller_id": "integer",
        "shipping_limit_date": "datetime",
        "price": "float",
        "note": "string",
    },
    "min_rows": 1000,
    "primary_key": ["order_id", "order_item_id"],
}


@query(
    "contract_rows_and_primary_key",
    """
select 'min_rows' as check_name, case when count(*) >= 1000 then 'PASS' else 'FAIL' end as status,
  'Linhas observadas=' || count(*) || ' | minimo=1000' as details from raw_items
union all
select 'primary_key_duplicates', case when m = 0 then 'PASS' else 'FAIL' end,
  'Chave=[''order_id'', ''order_item_id''] | duplicados=' || m
from (select cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as m
      from (select count(*) as n from raw_items group by order_id, order_item_id))
""",
)
def _(spark, root):
    checks = ct.validate_contract(commerce(spark, root).items, CONTRACT)
    return checks.filter("check_name in ('min_rows', 'primary_key_duplicates')").select(
        "check_name", "status", "details"
    )


CONTRACT_ROWS = [
    ("missing_columns", "FAIL", "Ausentes: ['note']"),
    ("unexpected_columns", "FAIL", "Inesperadas: ['freight_value']"),
    ("type__order_id", "PASS", "Esperado=integer | atual=bigint"),
    ("type__order_item_id", "PASS", "Esperado=integer | atual=int"),
    ("type__product_id", "FAIL", "Esperado=string | atual=bigint"),
    ("type__seller_id", "PASS", "Esperado=integer | atual=bigint"),
    ("type__shipping_limit_date", "PASS", "Esperado=datetime | atual=timestamp_ntz"),
    ("type__price", "PASS", "Esperado=float | atual=double"),
]
cte(
    "contract_checks",
    "select 'order_items' as dataset_name, 'raw' as layer, check_name, status, details from ("
    + "\nunion all\n".join(
        "select '{}' as check_name, '{}' as status, '{}' as details".format(n, s, d.replace("'", "''"))
        for n, s, d in CONTRACT_ROWS
    )
    + """
union all
select 'min_rows', case when count(*) >= 1000 then 'PASS' else 'FAIL' end,
  'Linhas observadas=' || count(*) || ' | minimo=1000' from raw_items
union all
select 'primary_key_duplicates', case when m = 0 then 'PASS' else 'FAIL' end,
  'Chave=[''order_id'', ''order_item_id''] | duplicados=' || m
from (select cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as m
      from (select count(*) as n from raw_items group by order_id, order_item_id)))
""",
)


@query("contract_validation_all_checks", "select * from contract_checks")
def _(spark, root):
    return ct.validate_contract(commerce(spark, root).items, CONTRACT)


@query(
    "contract_expected_vs_actual_types",
    """
select *, trim(regexp_extract(details, 'Esperado=([^|]+)', 1)) as expected,
  trim(regexp_extract(details, 'atual=(.+)$', 1)) as actual from contract_checks where details like 'Esperado=%'
""",
)
def _(spark, root):
    return ct.expected_and_actual(ct.validate_contract(commerce(spark, root).items, CONTRACT))


@query(
    "pseudonymised_keys",
    f"""
select {pseudonym("order_id", "order_id")} as order_id,
  {pseudonym("customer_unique_id", "customer_unique_id")} as customer_unique_id,
  {pseudonym("seller_id", "seller_id")} as seller_key, order_item_id from fact
""",
)
def _(spark, root):
    return pb.pseudonymise(fact(spark, root)).select("order_id", "customer_unique_id", "seller_key", "order_item_id")


PREFIXES = {"order_id": "order_id_", "customer_unique_id": "customer_unique_id_", "seller_key": "wrong_"}


@query(
    "prefix_token_checks",
    "\nunion all\n".join(
        f"select 'pseudonymized__{c}' as check_name, case when f = 0 then 'PASS' else 'FAIL' end as status, "
        f"f as failed_rows from (select count(*) filter ({c} is not null and not starts_with({c}, '{p}')) as f from published)"
        for c, p in PREFIXES.items()
    ),
)
def _(spark, root):
    return pb.token_checks(published(spark, root), PREFIXES).drop("details")


# one default is dropped from the published side on purpose, so that a failing check is covered too
def _damaged(df):
    return df.withColumn("seller_state", F.when(F.col("seller_state") != "NA", F.col("seller_state")))


@query(
    "default_fill_checks",
    "\nunion all\n".join(
        f"""
select 'default_fill__{c}' as check_name,
  case when nulls = 0 and wrong = 0 then 'PASS' else 'FAIL' end as status, cast(nulls + wrong as bigint) as failed_rows
from (select count(*) filter (damaged is null) as nulls,
        count(distinct (order_id, order_item_id)) filter (source is null and damaged is null) as wrong
      from (select order_id, order_item_id, {c} as source,
              {"seller_state" if c == "seller_state" else f"coalesce({c}, '{v}')"} as damaged from fact))
"""
        for c, v in pb.DEFAULT_FILL.items()
    ),
)
def _(spark, root):
    source = fact(spark, root)
    return pb.default_fill_checks(_damaged(pb.publish(source)), source, pb.DEFAULT_FILL).drop("details")


def _control(name: str, failed: str, details: str) -> str:
    return (
        f"select '{name}' as check_name, case when f = 0 then 'PASS' else 'FAIL' end as status, f as failed_rows, "
        f"'{details}' as details from ({failed})"
    )


NOTHING = "select count(*) filter (order_id is null) as f from published"
CONTROLS = [
    _control("required_columns", NOTHING, "missing: none"),
    _control("forbidden_columns_absent", NOTHING, "exposed: none"),
    _control("unexpected_columns", NOTHING, "unexpected: none"),
    _control("classification_leakage", NOTHING, "exposed: none"),
    _control("policy_required_columns_alignment", NOTHING, "required columns"),
    _control("policy_forbidden_columns_alignment", NOTHING, "forbidden columns"),
    _control("policy_pseudonymization_alignment", NOTHING, "pseudonym prefixes"),
    _control("policy_default_fill_alignment", NOTHING, "default values"),
    *[
        _control(
            f"pseudonymized__{c}",
            f"select count(*) filter ({c} is not null and not starts_with({c}, '{p}_')) as f from published",
            f"expected prefix {p}_",
        )
        for c, p in pb.PSEUDONYM_PREFIX.items()
    ],
    *[
        _control(
            f"default_fill__{c}",
            f"select count(*) filter ({c} is null) as f from published",
            "nulls=0 | keys without default=0",
        )
        for c in pb.DEFAULT_FILL
    ],
]


@query("publish_controls", "\nunion all\n".join(CONTROLS))
def _(spark, root):
    source = fact(spark, root)
    return pb.privacy_checks(pb.publish(source), source)
