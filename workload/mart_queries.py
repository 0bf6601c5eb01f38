"""Marts, reports, analyses, order and reshape (ids D7-D46, E7-E12, F, G) and the star schema (N1-N9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.operators import cohorts
from tradeledger.operators import ordered as od
from tradeledger.plans import marts, reports, star
from tradeledger.plans.shared import GRAIN, double_mean, double_sum
from tradeledger.sources.commerce import table
from workload.base import cte, pseudonym, query, s_avg, s_sum, s_total, share
from workload.inputs import fact, published

# ---- marts ---------------------------------------------------------------

LATE = share("is_delayed")
cte(
    "m_logistics",
    f"""
select order_year, order_month, customer_state, seller_state, count(order_item_id) as total_items,
  {LATE} as delayed_rate, {s_avg("delivery_time_days")} as avg_delivery_time_days,
  {s_avg("seller_dispatch_time_days")} as avg_dispatch_time_days,
  {s_avg("carrier_delivery_time_days")} as avg_carrier_time_days,
  {s_avg("freight_to_price_ratio")} as avg_freight_to_price_ratio
from published group by 1, 2, 3, 4
""",
)
cte(
    "m_seller",
    f"""
select seller_key, seller_state, seller_volume_tier, count(order_item_id) as total_items,
  max(seller_order_count) as seller_order_count, {s_avg("total_item_value")} as avg_ticket,
  max(seller_avg_delivery_days) as avg_delivery_time_days, max(seller_delay_rate) as delay_rate,
  {s_avg("review_score_mean")} as avg_review_score
from published group by 1, 2, 3
""",
)
cte(
    "m_cohort",
    f"""
select purchase_cohort_month, cohort_order_month_number, count(distinct customer_unique_id) as customers,
  count(distinct order_id) as orders, count(order_item_id) as items, {s_avg("total_item_value")} as avg_ticket,
  {LATE} as delayed_rate
from published group by 1, 2
""",
)
cte(
    "m_category",
    f"""
select order_year, order_month, product_category_name_english, payment_type_mode,
  count(distinct order_id) as orders, count(order_item_id) as items, {s_total("total_item_value")} as revenue,
  {s_avg("total_item_value")} as avg_ticket, {LATE} as delayed_rate,
  {s_avg("review_score_mean")} as avg_review_score,
  {s_avg("freight_to_price_ratio")} as avg_freight_to_price_ratio
from published group by 1, 2, 3, 4
""",
)
cte(
    "m_state",
    f"""
select order_year, order_month, customer_state, count(distinct order_id) as orders, count(order_item_id) as items,
  count(distinct seller_key) as active_sellers, {s_total("total_item_value")} as revenue,
  {s_avg("total_item_value")} as avg_ticket, {LATE} as delayed_rate,
  {s_avg("delivery_time_days")} as avg_delivery_time_days, {s_avg("review_score_mean")} as avg_review_score
from published group by 1, 2, 3
""",
)
for key, build, mart in (
    ("logistics_mart", marts.logistics_mart, "m_logistics"),
    ("seller_mart", marts.seller_mart, "m_seller"),
    ("cohort_mart", marts.cohort_mart, "m_cohort"),
    ("category_payment_mart", marts.category_mart, "m_category"),
    ("state_performance_mart", marts.state_mart, "m_state"),
):
    query(key, f"select * from {mart}")(lambda s, r, b=build: b(published(s, r)))


@query(
    "join_health_missing_pct",
    "\nunion all\n".join(
        f"select '{c}' as column_name, round(avg(case when {c} is null then 1 else 0 end) * 100, 2) as missing_pct "
        "from fact"
        for c in (
            "customer_unique_id",
            "customer_state",
            "seller_state",
            "payment_type_mode",
            "product_category_name",
            "product_category_name_english",
        )
    ),
)
def _(spark, root):
    from tradeledger.operators.profiling import join_health

    return join_health(fact(spark, root))


cte(
    "order_gaps",
    f"""
select order_id, abs({s_total("total_item_value")} - coalesce(max(total_payment_value), 0)) as gap
from fact group by order_id
""",
)


@query(
    "payment_reconciliation",
    f"""
select count(*) as orders_reconciled, round({s_avg("gap")}, 4) as avg_abs_gap, round(max(gap), 4) as max_abs_gap,
  round({share("gap > 1")} * 100, 2) as orders_gap_gt_1_real_pct
from order_gaps
""",
)
def _(spark, root):
    from tradeledger.operators.profiling import payment_reconciliation

    return payment_reconciliation(fact(spark, root))


# ---- analyses ------------------------------------------------------------


@query(
    "executive_kpis",
    f"""
select {s_total("total_item_value")} as revenue, count(distinct order_id) as orders,
  count(distinct seller_key) as active_sellers,
  {s_total("total_item_value")} / nullif(count(distinct order_id), 0) as average_ticket
from published
""",
)
def executive_kpis(spark, root):
    return marts.executive_kpis(published(spark, root))


@query(
    "monthly_revenue",
    f"""
select cast(order_year as varchar) || '-' || lpad(cast(order_month as varchar), 2, '0') as order_year_month,
  {s_total("total_item_value")} as revenue
from published group by 1
""",
)
def _(spark, root):
    return marts.monthly_revenue(published(spark, root))


@query(
    "seller_sla_by_tier",
    f"""
select seller_volume_tier, count(*) as sellers, {s_avg("delay_rate")} * 100 as avg_delay_rate,
  {s_avg("avg_delivery_time_days")} as avg_delivery_days
from m_seller group by 1
""",
)
def _(spark, root):
    return marts.seller_sla(marts.seller_mart(published(spark, root)))


@query(
    "seller_headline_for_tier",
    f"""
select count(distinct seller_key) as sellers, coalesce(cast(sum(seller_order_count) as bigint), 0) as orders,
  {s_avg("delay_rate")} * 100 as avg_delay_rate, {s_avg("avg_delivery_time_days")} as avg_delivery_days
from m_seller where seller_volume_tier = 'core'
""",
)
def _(spark, root):
    sellers = marts.seller_mart(published(spark, root))
    return marts.seller_headline(marts.filtered_sellers(sellers, tier="core"))


@query(
    "frequency_tables",
    "\nunion all\n".join(
        f"select '{c}' as column_name, coalesce(cast({c} as varchar), 'unknown') as value, count(*) as n "
        f"from fact group by 2"
        for c in ("seller_volume_tier", "order_status", "payment_type_mode", "product_category_name")
    ),
)
def _(spark, root):
    from tradeledger.operators.profiling import frequencies

    columns = ["seller_volume_tier", "order_status", "payment_type_mode", "product_category_name"]
    return frequencies(fact(spark, root), columns)


# ---- reports -------------------------------------------------------------

CAT = "coalesce(product_category_name_english, product_category_name, 'unknown')"
ORDERS = "count(distinct order_id)"
REVENUE = f"round({s_total('total_item_value')}, 2)"
LATE_PCT = f"round({LATE} * 100, 2)"


def _mean(c: str) -> str:
    return f"round({s_avg(c)}, 2)"


MONTH = "make_date(order_year, order_month, 1)"
ITEM = _mean("total_item_value")
REPORT_SQL = {
    "order_status_exploration": f"""
select order_status, {ORDERS} as total_orders, count(*) as total_items, {REVENUE} as total_revenue,
  {ITEM} as avg_item_value from fact group by order_status""",
    "cleaning_audit_counters": """
select count(*) as total_rows, count(*) filter (price < 0) as negative_price_rows,
  count(*) filter (freight_value < 0) as negative_freight_rows,
  count(*) filter (order_delivered_customer_date < order_purchase_timestamp) as invalid_delivery_rows,
  count(*) filter (order_id is null) as null_order_id_rows from fact""",
    "kpi_row": f"""
select {ORDERS} as total_orders, count(*) as total_items, {REVENUE} as total_revenue, {ITEM} as avg_item_value,
  {_mean("delivery_time_days")} as avg_delivery_time_days, {LATE_PCT} as delayed_items_pct,
  {_mean("review_score_mean")} as avg_review_score from fact""",
    "monthly_series": f"""
select {MONTH} as order_month_date, {ORDERS} as total_orders, {REVENUE} as total_revenue,
  {_mean("delivery_time_days")} as avg_delivery_time_days, {LATE_PCT} as delayed_items_pct from fact group by 1""",
    "top_20_categories": f"""
select {CAT} as category, count(*) as total_items, {ORDERS} as total_orders, {REVENUE} as total_revenue,
  {ITEM} as avg_item_value, {LATE_PCT} as delayed_items_pct from fact group by 1
order by total_revenue desc, total_orders desc, category limit 20""",
    "top_categories_by_revenue": f"""
select {CAT} as category, count(*) as total_items, {ORDERS} as total_orders, {REVENUE} as total_revenue,
  {ITEM} as avg_item_revenue from fact group by 1
order by total_revenue desc, total_orders desc, category limit 20""",
    "monthly_revenue_evolution": f"""
select {MONTH} as order_month_date, order_year, order_month, {ORDERS} as total_orders, count(*) as total_items,
  {REVENUE} as total_revenue, {ITEM} as avg_item_revenue, {_mean("delivery_time_days")} as avg_delivery_time_days,
  {LATE_PCT} as delayed_orders_pct from fact group by 1, 2, 3""",
    "revenue_by_state": f"""
select customer_state, {ORDERS} as total_orders, count(*) as total_items, {REVENUE} as total_revenue,
  {ITEM} as avg_item_revenue, {LATE_PCT} as delayed_orders_pct
from fact where customer_state is not null group by 1""",
    "delivery_delay_by_category": f"""
select {CAT} as category, count(*) as total_items, {_mean("delivery_time_days")} as avg_delivery_time_days,
  {_mean("estimated_delay_days")} as avg_estimated_delay_days, {LATE_PCT} as delayed_items_pct,
  round({s_total("case when is_delayed then total_item_value else 0 end")}, 2) as delayed_revenue
from fact group by 1 having count(*) >= 100""",
    "payment_method_distribution": f"""
select coalesce(payment_type_mode, 'unknown') as payment_type, count(*) as total_items, {ORDERS} as total_orders,
  {REVENUE} as total_revenue, {ITEM} as avg_item_revenue, {LATE_PCT} as delayed_orders_pct from fact group by 1""",
    "executive_kpis_with_ticket": f"""
select {REVENUE} as receita_total, {ORDERS} as total_pedidos,
  round({s_total("total_item_value")} / nullif({ORDERS}, 0), 2) as ticket_medio,
  {_mean("review_score_mean")} as review_medio, {LATE_PCT} as percentual_pedidos_em_atraso from fact""",
    "revenue_over_time": f"""
select cast(date_trunc('month', order_date) as date) as mes_referencia, {ORDERS} as total_pedidos,
  {REVENUE} as receita_total, {ITEM} as receita_media_por_item from fact where order_date is not null group by 1""",
    "top_10_categories_by_revenue": f"""
select {CAT} as categoria, {ORDERS} as total_pedidos, {REVENUE} as receita_total, {ITEM} as ticket_medio_item,
  {_mean("freight_value")} as frete_medio, {LATE_PCT} as percentual_atraso from fact group by 1
order by receita_total desc, total_pedidos desc, categoria limit 10""",
    "orders_by_status": f"""
select order_status, {ORDERS} as total_pedidos, {REVENUE} as receita_total, {ITEM} as ticket_medio_item
from fact group by 1""",
    "states_by_delay_pct": f"""
select customer_state, {ORDERS} as total_pedidos, {REVENUE} as receita_total, {ITEM} as ticket_medio_item,
  {LATE_PCT} as percentual_atraso from fact where customer_state is not null group by 1""",
    "top_10_categories_by_mean_freight": f"""
select {CAT} as categoria, {ORDERS} as total_pedidos, {_mean("freight_value")} as frete_medio,
  {REVENUE} as receita_total from fact group by 1 having count(distinct order_id) >= 30
order by frete_medio desc, receita_total desc, categoria limit 10""",
    "category_detail": f"""
select {CAT} as categoria, {ORDERS} as total_pedidos, {REVENUE} as receita_total, {ITEM} as ticket_medio_item,
  {_mean("freight_value")} as frete_medio, {_mean("review_score_mean")} as review_medio,
  {_mean("delivery_time_days")} as prazo_medio_entrega_dias,
  {_mean("estimated_delay_days")} as atraso_estimado_medio_dias, {LATE_PCT} as percentual_atraso
from fact group by 1""",
}
for key, build in reports.REPORTS.items():
    query(key, REPORT_SQL[key])(lambda s, r, b=build: b(fact(s, r)))

GRAIN_SETS = ", ".join("(" + ", ".join(keys) + ")" for keys in reports.GRAINS.values())
GRAIN_KEYS = ", ".join(reports.KEYS)
GRAIN_NAMES = " ".join(
    f"when {sum(1 << (len(reports.KEYS) - 1 - i) for i, k in enumerate(reports.KEYS) if k not in keys)} then '{name}'"
    for name, keys in reports.GRAINS.items()
)


@query(
    "shared_report_groups",
    f"""
select case grouping({GRAIN_KEYS}) {GRAIN_NAMES} end as grain, {GRAIN_KEYS}, count(*) as rows, count(distinct order_id) as orders,
  {s_sum("total_item_value")} as revenue, {_mean("delivery_time_days")} as avg_delivery_time_days, {LATE} as delayed_rate
from (
  select *, coalesce(product_category_name_english, product_category_name, 'unknown') as category,
    coalesce(payment_type_mode, 'unknown') as payment_type, cast(date_trunc('month', order_date) as date) as mes_referencia
  from fact)
group by grouping sets ({GRAIN_SETS})
""",
)
def _(spark, root):
    """Every group of the seventeen reports from two scans of the fact."""
    shared = reports.shared_reports(fact(spark, root))
    return shared.table.select(
        F.col(GRAIN).alias("grain"), *reports.KEYS, "rows", "orders", double_sum("total_item_value").alias("revenue"),
        F.round(double_mean("delivery_time_days"), 2).alias("avg_delivery_time_days"), (F.col("delayed").cast("double") / F.col("rows")).alias("delayed_rate"),
    )


for key, name, mart in (
    ("logistics_mart_shared", "logistics_slice", "m_logistics"),
    ("seller_mart_shared", "seller_slice", "m_seller"),
    ("cohort_mart_shared", "cohort_slice", "m_cohort"),
    ("category_payment_mart_shared", "category_slice", "m_category"),
    ("state_performance_mart_shared", "state_performance_slice", "m_state"),
):
    query(key, f"select * from {mart}")(lambda s, r, n=name: marts.shared_marts(published(s, r))[n])

# ---- E7-E12, F, G --------------------------------------------------------

cte(
    "pareto",
    """
select category, cast(rev as double) as revenue,
  cast(sum(rev) over (order by rev desc, category rows unbounded preceding) as double)
    / cast(sum(rev) over () as double) * 100 as cum_pct
from (select coalesce(product_category_name_english, 'unknown') as category,
        cast(sum(cast(revenue as decimal(38, 6))) as decimal(28, 6)) as rev from m_category group by 1)
""",
)


@query("revenue_pareto", "select * from pareto")
def _(spark, root):
    return marts.category_pareto(marts.category_mart(published(spark, root)))[0]


@query(
    "revenue_pareto_cutoff",
    "select cast(greatest(1, count(*) filter (cum_pct <= 80)) as bigint) as categories from pareto",
)
def _(spark, root):
    return marts.category_pareto(marts.category_mart(published(spark, root)))[1]


cte(
    "daily_points",
    """
select event_type as dataset_name, cast(ts as date) as day, count(*) as row_count
from events group by 1, 2
""",
)


def daily_points(spark, root):
    events = table(spark, root, "events")
    return events.groupBy(F.col("event_type").alias("dataset_name"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "latest_vs_previous_delta",
    """
select dataset_name, max(row_count) filter (rn = 1) as latest, max(row_count) filter (rn = 2) as previous,
  max(row_count) filter (rn = 1) - max(row_count) filter (rn = 2) as delta
from (select *, row_number() over (partition by dataset_name order by day desc) as rn from daily_points)
group by 1
""",
)
def _(spark, root):
    return od.latest_two(daily_points(spark, root), "day", "row_count", ["dataset_name"])


@query(
    "latest_vs_median_baseline",
    """
select dataset_name, cast(max(row_count) filter (rn = 1) as double) as latest,
  quantile_cont(cast(row_count as double), 0.5) filter (rn > 1) as baseline
from (select *, row_number() over (partition by dataset_name order by day desc) as rn from daily_points)
group by 1
""",
)
def _(spark, root):
    from tradeledger.operators.governance import latest_and_baseline

    return latest_and_baseline(daily_points(spark, root), "day", "row_count", ["dataset_name"])


@query(
    "surrogate_keys_over_distinct_values",
    """
select p_name, row_number() over (order by p_name) as name_key from (select distinct p_name from part)
""",
)
def _(spark, root):
    return od.surrogate_keys(table(spark, root, "part"), "p_name", "name_key")


@query(
    "top_n_values_per_column",
    "select column_name, value, n from ("
    + "\nunion all\n".join(
        f"select '{c}' as column_name, {c} as value, count(*) as n from part group by 2" for c in ("p_brand", "p_type", "p_name")
    )
    + ") qualify row_number() over (partition by column_name order by n desc, value) <= 5",
)
def _(spark, root):
    from tradeledger.operators.profiling import frequencies

    part = table(spark, root, "part")
    counts = frequencies(part, ["p_brand", "p_type", "p_name"])
    return od.top_n(counts, ["column_name"], [F.desc("n"), F.asc("value")], 5)


@query(
    "latest_execution",
    """
select * from run_log
qualify row_number() over (partition by dataset_name order by finished_at desc nulls last, execution_id desc) = 1
""",
)
def _(spark, root):
    from workload.governance_queries import run_log

    return od.latest(run_log(spark, root), "finished_at", ["dataset_name"])


query("multi_key_sorted_mart", "select * from m_state order by order_year, order_month, customer_state")(
    lambda s, r: marts.state_mart(published(s, r)).orderBy("order_year", "order_month", "customer_state")
)


@query(
    "top_sellers_by_revenue",
    f"""
select seller_key, {s_total("total_item_value")} as total_item_value from published group by 1
order by 2 desc, 1 limit 15
""",
)
def _(spark, root):
    return marts.top_sellers(published(spark, root))


@query(
    "seller_ranking_by_estimated_revenue",
    """
select *, coalesce(avg_ticket, 0) * coalesce(seller_order_count, 0) as estimated_revenue from m_seller
order by estimated_revenue desc, seller_key, seller_state limit 20
""",
)
def _(spark, root):
    return marts.seller_ranking(marts.seller_mart(published(spark, root)))


@query(
    "history_union_new_row",
    """
select dataset_name, cast(day as varchar) as day, row_count, cast(null as varchar) as note from daily_points
union all select 'all', 'total', cast(sum(row_count) as bigint), 'appended' from daily_points
""",
)
def _(spark, root):
    history = daily_points(spark, root).withColumn("day", F.col("day").cast("string"))
    new = history.agg(F.sum("row_count").alias("row_count")).select(
        F.lit("all").alias("dataset_name"), F.lit("total").alias("day"), "row_count", F.lit("appended").alias("note")
    )
    return history.unionByName(new, allowMissingColumns=True)


@query(
    "distinct_dates_statuses_payment_types",
    """
select 'date' as kind, cast(order_date as varchar) as value from fact where order_date is not null group by 2
union all select 'status', order_status from bi_input group by 2
union all select 'payment', payment_type_mode from bi_input group by 2
""",
)
def _(spark, root):
    rows = star.normalise_for_bi(fact(spark, root))
    parts = [
        rows.select(F.lit("date").alias("kind"), F.col("order_date").cast("string").alias("value")),
        rows.select(F.lit("status").alias("kind"), F.col("order_status").alias("value")),
        rows.select(F.lit("payment").alias("kind"), F.col("payment_type_mode").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts).filter("value is not null").distinct()


cte(
    "retention_rows",
    """
select c.*, b.baseline_customers, c.customers / nullif(b.baseline_customers, 0) * 100 as retention_rate
from m_cohort c left join (
  select purchase_cohort_month as m, cast(sum(customers) as bigint) as baseline_customers
  from m_cohort where cohort_order_month_number = 0 group by 1) b on c.purchase_cohort_month = b.m
""",
)
cte(
    "m_cohort_first",
    f"""
select strftime(customer_first_purchase_timestamp, '%Y-%m') as purchase_cohort_month, cohort_order_month_number,
  count(distinct customer_unique_id) as customers, count(distinct order_id) as orders, count(order_item_id) as items,
  {s_avg("total_item_value")} as avg_ticket, {LATE} as delayed_rate
from fact group by 1, 2
""",
)
query("cohort_mart_by_first_purchase", "select * from m_cohort_first")(
    lambda s, r: marts.cohort_mart(published(s, r), "first_purchase")
)


@query(
    "cohort_retention_by_first_purchase",
    """
select c.*, b.baseline_customers, c.customers / nullif(b.baseline_customers, 0) * 100 as retention_rate
from m_cohort_first c left join (
  select purchase_cohort_month as m, cast(sum(customers) as bigint) as baseline_customers
  from m_cohort_first where cohort_order_month_number = 0 group by 1) b on c.purchase_cohort_month = b.m
""",
)
def _(spark, root):
    return cohorts.retention(marts.cohort_mart(published(spark, root), "first_purchase"))


query("cohort_retention", "select * from retention_rows")(
    lambda s, r: cohorts.retention(marts.cohort_mart(published(s, r)))
)

OFFSETS = list(range(80))  # months between the first and the last order of the calendar


def _pivot_sql(table: str, value: str) -> str:
    cells = ",\n  ".join(
        f"avg({value}) filter (coalesce(cohort_order_month_number, 0) = {o}) as m{o}" for o in OFFSETS
    )
    return f"select purchase_cohort_month, {cells} from {table} group by 1"


query("cohort_ticket_pivot", _pivot_sql("m_cohort", "avg_ticket"))(
    lambda s, r: cohorts.pivot_by_offset(marts.cohort_mart(published(s, r)), "avg_ticket", OFFSETS)
)
query("cohort_retention_pivot", _pivot_sql("retention_rows", "retention_rate"))(
    lambda s, r: cohorts.pivot_by_offset(
        cohorts.retention(marts.cohort_mart(published(s, r))), "retention_rate", OFFSETS
    )
)


@query(
    "melt_counts_to_long",
    """
unpivot (select event_type, count(*) filter (value > 100) as high, count(*) filter (value <= 100) as low,
  count(*) filter (value < 1) as tiny from events group by 1)
on high, low, tiny into name rule value n
""",
)
def _(spark, root):
    events = table(spark, root, "events")
    wide = events.groupBy("event_type").agg(
        F.count(F.when(F.col("value") > 100, 1)).alias("high"),
        F.count(F.when(F.col("value") <= 100, 1)).alias("low"),
        F.count(F.when(F.col("value") < 1, 1)).alias("tiny"),
    )
    return wide.unpivot("event_type", ["high", "low", "tiny"], "rule", "n")


# ---- star schema ---------------------------------------------------------


def _star(spark, root):
    return star.star_schema(fact(spark, root))


cte(
    "dim_date",
    """
select cast(strftime(order_date, '%Y%m%d') as integer) as date_key, order_date,
  cast(year(order_date) as integer) as year, 'Q' || cast(quarter(order_date) as varchar) as quarter,
  cast(month(order_date) as integer) as month, strftime(order_date, '%b') as month_name,
  strftime(order_date, '%Y-%m') as year_month, cast(weekofyear(order_date) as integer) as week_of_year,
  cast(day(order_date) as integer) as day, strftime(order_date, '%A') as weekday_name
from (select distinct order_date from fact where order_date is not null)
""",
)
cte(
    "dim_product",
    f"""
select {pseudonym("product_id", "product_id")} as product_key, product_category_name,
  product_category_name_english, category_label, product_name_lenght, product_description_lenght,
  product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
from bi_input where product_id is not null
qualify row_number() over (partition by product_id order by order_id) = 1
""",
)
cte(
    "dim_payment",
    """
select row_number() over (order by payment_type) as payment_key, payment_type,
  case when payment_type in ('credit_card', 'debit_card') then 'Card' when payment_type = 'voucher' then 'Voucher'
       when payment_type = 'boleto' then 'Boleto' else 'Other' end as payment_group,
  case payment_type when 'credit_card' then 'Credit Card' when 'debit_card' then 'Debit Card'
    else upper(substr(payment_type, 1, 1)) || substr(payment_type, 2) end as payment_description
from (select distinct payment_type_mode as payment_type from bi_input)
""",
)
cte(
    "dim_order_status",
    """
select row_number() over (order by order_status) as order_status_key, order_status,
  case when order_status = 'delivered' then 'Closed' when order_status = 'created' then 'Open'
       when order_status in ('shipped', 'invoiced', 'processing', 'approved') then 'In Fulfillment'
       when order_status in ('unavailable', 'canceled') then 'Exception' else 'Other' end as status_group,
  upper(substr(order_status, 1, 1)) || substr(order_status, 2) as status_description
from (select distinct order_status from bi_input)
""",
)
cte(
    "dim_customer",
    f"""
select distinct {pseudonym("customer_id", "customer_id")} as customer_key,
  {pseudonym("customer_unique_id", "customer_unique_id")} as customer_master_key, customer_state from bi_input
where customer_id is not null
""",
)
cte(
    "dim_seller",
    f"""
select distinct {pseudonym("seller_id", "seller_id")} as seller_key, seller_state from bi_input
where seller_id is not null
""",
)
cte(
    "fact_sales",
    f"""
select {pseudonym("order_id", "order_id")} || '_' || cast(order_item_id as varchar) || '_' ||
    {pseudonym("product_id", "product_id")} || '_' || {pseudonym("seller_id", "seller_id")} as order_item_key,
  {pseudonym("order_id", "order_id")} as order_key, order_item_id,
  cast(strftime(order_date, '%Y%m%d') as integer) as date_key,
  {pseudonym("product_id", "product_id")} as product_key, p.payment_key, s.order_status_key,
  {pseudonym("customer_id", "customer_id")} as customer_key, {pseudonym("seller_id", "seller_id")} as seller_key,
  order_purchase_timestamp, order_approved_at, order_delivered_customer_date, order_estimated_delivery_date,
  price, freight_value, total_item_value, payment_count, total_payment_value, max_payment_installments,
  review_count, review_score_mean, case when review_score_mean is not null then 1 else 0 end as review_available,
  delivery_time_days, estimated_delay_days, is_delayed,
  case when order_delivered_customer_date is not null then 1 else 0 end as delivered_flag
from bi_input b left join dim_payment p on b.payment_type_mode = p.payment_type
left join dim_order_status s on b.order_status = s.order_status
""",
)
for key, build in (
    ("dim_date", star.dim_date),
    ("dim_product", star.dim_product),
    ("dim_payment", star.dim_payment),
    ("dim_order_status", star.dim_order_status),
    ("dim_customer", star.dim_customer),
    ("dim_seller", star.dim_seller),
):
    query(key, f"select * from {key}")(lambda s, r, b=build: b(star.normalise_for_bi(fact(s, r))))
query("fact_sales", "select * from fact_sales")(lambda s, r: _star(s, r)["fact_sales"])


def _check_sql(name: str, failed: str, details: str) -> str:
    return (
        f"select '{name}' as check_name, case when ({failed}) = 0 then 'PASS' else 'FAIL' end as status, "
        f"cast(({failed}) as bigint) as failed_rows, '{details}' as details"
    )


@query(
    "star_primary_key_checks",
    "\nunion all\n".join(
        _check_sql(
            f"primary_key__{t}",
            f"select count(*) - count(distinct {k}) from {t}",
            k,
        )
        for t, k in star.PRIMARY_KEYS.items()
    ),
)
def _(spark, root):
    return star.primary_key_checks(star.key_tables(fact(spark, root)))


@query(
    "star_foreign_key_checks",
    "\nunion all\n".join(
        _check_sql(
            f"foreign_key__{k}",
            f"select count(distinct {k}) from fact_sales where {k} is not null and {k} not in (select {k} from {t})",
            t,
        )
        for k, t in star.FOREIGN_KEYS.items()
    ),
)
def _(spark, root):
    return star.foreign_key_checks(star.key_tables(fact(spark, root)))
