"""Profiling, EDA and inventory (ids A4, I, N10, N11)."""

from __future__ import annotations

from tradeledger.operators import catalog, privacy
from tradeledger.operators import profiling as pf
from tradeledger.sources.commerce import SCHEMAS, commerce, table
from tradeledger.sources.readers import inventory, run_sql
from workload.base import cte, query, s_avg
from workload.inputs import fact

TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels"]
COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "raw_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "raw_orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at "
    "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
}


def load(spark, root, name):
    return table(spark, root, name)


def _each(table: str, row: str) -> str:
    """One select per column of ``table``; ``{c}`` in ``row`` is the column."""
    parts = [f"select '{c}' as column_name, {row.replace('{c}', c)} from {table}" for c in COLUMNS[table].split()]
    return "\nunion all\n".join(parts)


@query(
    "raw_inventory",
    "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as rows from {t}" for t in TABLES
    ),
)
def _(spark, root):
    return inventory({t: load(spark, root, t) for t in TABLES}).select("table_name", "rows")


SPARK_TYPES = {"long": "bigint"}


def _fields(t: str) -> list[tuple[str, str]]:
    pairs = [field.split() for field in SCHEMAS[t].split(", ")]
    return [(name, SPARK_TYPES.get(kind, kind)) for name, kind in pairs]


@query(
    "raw_inventory_with_types",
    "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as rows, {len(_fields(t))} as columns_count, "
        f"'{', '.join(f'{n}: {k}' for n, k in _fields(t))}' as dtypes, "
        f"'{', '.join(n for n, _ in _fields(t) if 'date' in n)}' as date_columns, '' as encoding from {t}"
        for t in TABLES
    ),
)
def _(spark, root):
    return inventory({t: load(spark, root, t) for t in TABLES})


@query(
    "parquet_scan_projection",
    "select o_orderkey, o_totalprice from orders where o_orderdate >= date '2000-01-01' and o_orderstatus = 'F'",
)
def _(spark, root):
    orders = load(spark, root, "orders")
    recent = orders.filter("o_orderdate >= timestamp_ntz '2000-01-01' and o_orderstatus = 'F'")
    return recent.select("o_orderkey", "o_totalprice")


@query(
    "parameterised_sql",
    "select p_brand, count(*) as parts from part where p_size >= 10 and p_type = 'PROMO' group by 1",
)
def _(spark, root):
    text = "select p_brand, count(*) as parts from parts where p_size >= :low and p_type = :kind group by p_brand"
    return run_sql(spark, text, {"low": 10, "kind": "PROMO"}, parts=load(spark, root, "part"))


@query(
    "null_profile_per_column",
    "select 'order_items' as table_name, * from ("
    + _each(
        "raw_items",
        "count(*) filter ({c} is null) as null_count, count(*) filter ({c} is null) / count(*) as null_ratio",
    )
    + ")",
)
def _(spark, root):
    return pf.nulls_profile(commerce(spark, root).items, "order_items")


@query(
    "profile_sorted_desc_asc",
    _each("raw_orders", "count(*) filter ({c} is null) as null_count") + "\norder by null_count desc, column_name",
)
def _(spark, root):
    return pf.nulls_profile(commerce(spark, root).orders, "orders").select("column_name", "null_count")


KEYS_ROW = (
    "count({c}) as non_null_count, count(distinct {c}) as unique_non_null_count, "
    "count(distinct {c}) / count({c}) as uniqueness_ratio, count(*) filter ({c} is null) as null_count, "
    "count(distinct {c}) = count(*) as is_possible_key"
)


@query(
    "candidate_key_detection",
    "\nunion all\n".join(
        f"select '{c}' as column_name, {KEYS_ROW.replace('{c}', c)} from raw_items"
        for c in ("order_id", "order_item_id", "product_id", "seller_id")
    ),
)
def _(spark, root):
    return pf.candidate_keys(commerce(spark, root).items)


SEMANTIC = {"o_orderdate": "date", "o_orderstatus": "categorical", "o_orderpriority": "categorical"}
DTYPES = {"o_orderdate": "timestamp_ntz", "o_totalprice": "double"}


@query(
    "column_profile",
    "\nunion all\n".join(
        f"select 'orders' as table_name, '{c}' as column_name, "
        f"'{DTYPES.get(c, 'string' if c in SEMANTIC else 'bigint')}' as dtype, "
        f"'{SEMANTIC.get(c, 'numeric')}' as semantic_type, count({c}) as non_null_count, "
        f"count(distinct {c}) as unique_count from orders"
        for c in COLUMNS["orders"].split()
    ),
)
def _(spark, root):
    return pf.columns_profile(load(spark, root, "orders"), "orders")


@query(
    "duplicate_profile_all_members",
    """
select 'order_lines' as table_name, cast(sum(n) as bigint) as total_rows,
  cast(coalesce(sum(n) filter (n > 1), 0) as bigint) as duplicate_rows,
  cast(coalesce(sum(n) filter (n > 1), 0) as bigint) / cast(sum(n) as bigint) as duplicate_ratio
from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
""",
)
def _(spark, root):
    lines = load(spark, root, "lineitem").select("l_orderkey", "l_linenumber")
    return pf.duplicate_profile(lines, "order_lines")


@query(
    "union_of_table_profiles",
    "\nunion all\n".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as null_count, "
        f"count(*) filter ({c} is null) / count(*) as null_ratio from {t}"
        for t in ("customer", "orders", "part")
        for c in COLUMNS[t].split()
    ),
)
def _(spark, root):
    return pf.profile_tables({t: load(spark, root, t) for t in ("customer", "orders", "part")})["nulls"]


def _profile(t: str, n: str, kind: str) -> str:
    role = "date" if "date" in n else "categorical" if kind == "string" else "numeric"
    return (
        f"select '{t}' as table_name, '{n}' as column_name, '{kind}' as dtype, '{role}' as semantic_type, "
        f"count({n}) as non_null_count, count(distinct {n}) as unique_count from {t}"
    )


@query(
    "dataset_profiling_run",
    "\nunion all\n".join(_profile(t, n, k) for t in ("customer", "orders", "part", "lineitem") for n, k in _fields(t)),
)
def _(spark, root):
    tables = {t: load(spark, root, t) for t in ("customer", "orders", "part", "lineitem")}
    return pf.profile_tables(tables)["columns"]


NUM = {"p_partkey", "p_size", "p_retailprice"}


def _describe(c: str) -> str:
    if c in NUM:
        return (
            f"select '{c}' as column_name, count({c}) as count, cast(null as bigint) as \"unique\", "
            f"cast(null as varchar) as top, cast(null as bigint) as freq, {s_avg(f'cast({c} as double)')} as mean, "
            f"round(stddev_samp({c}), 6) as std, cast(min({c}) as double) as min, "
            f"quantile_cont(cast({c} as double), 0.25) as \"25%\", quantile_cont(cast({c} as double), 0.5) as \"50%\", "
            f"quantile_cont(cast({c} as double), 0.75) as \"75%\", cast(max({c}) as double) as max from part"
        )
    empty = ", ".join(f'cast(null as double) as "{m}"' for m in ("mean", "std", "min", "25%", "50%", "75%", "max"))
    return (
        f"select '{c}', count({c}), count(distinct {c}), (select {c} from part group by 1 "
        f"order by count(*) desc, {c} limit 1), (select count(*) from part group by {c} order by 1 desc limit 1), "
        f"{empty} from part"
    )


@query("describe_all_columns", "\nunion all\n".join(_describe(c) for c in COLUMNS["part"].split()))
def _(spark, root):
    return pf.describe(load(spark, root, "part"), digits=6)


@query(
    "top_categories_with_pct",
    "\nunion all\n".join(
        f"(select '{c}' as column_name, {c} as category, count(*) as count, "
        f"round(count(*) / (select count(*) from part) * 100, 2) as percentage from part group by 2 "
        f"order by 3 desc, 2 limit 5)"
        for c in ("p_name", "p_brand", "p_type")
    ),
)
def _(spark, root):
    return pf.top_categories(load(spark, root, "part"))


LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    "\nunion all\n".join(
        f"select '{a}' as column_name, "
        + ", ".join(f"{'1.0::double' if a == b else f'round(corr({a}, {b}), 9)'} as {b}" for b in LINE)
        + " from lineitem"
        for a in LINE
    ),
)
def _(spark, root):
    from pyspark.sql import functions as F

    matrix = pf.correlation_matrix(load(spark, root, "lineitem").select(*LINE))
    return matrix.select("column_name", *[F.round(c, 9).alias(c) for c in LINE])


def _iqr(c: str) -> str:
    return f"""
select '{c}' as column_name, q1, q3, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_bound,
  q3 + 1.5 * (q3 - q1) as upper_bound,
  count(*) filter (v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) as outlier_count,
  round(count(*) filter (v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) / count(*) * 100, 2) as outlier_pct
from (select cast({c} as double) as v,
        quantile_cont(cast({c} as double), 0.25) over () as q1, quantile_cont(cast({c} as double), 0.75) over () as q3
      from events) group by q1, q3
"""


@query("iqr_outliers", "\nunion all\n".join(_iqr(c) for c in ("event_id", "user_id", "value")))
def _(spark, root):
    return pf.iqr_outliers(load(spark, root, "events"))


@query(
    "null_pct_profile_sorted",
    _each(
        "raw_orders",
        "count(*) filter ({c} is null) as null_count, "
        "round(count(*) filter ({c} is null) / count(*) * 100, 2) as null_pct",
    ),
)
def _(spark, root):
    return pf.null_percentages(commerce(spark, root).orders)


def _jb(c: str) -> str:
    return f"""
select 'jarque_bera_normality' as test_name, '{c}' as target, round(jb, 4) as statistic,
  round(exp(-jb / 2), 6) as p_value,
  case when exp(-jb / 2) < 0.05 then 'non_normal' else 'cannot_reject_normality' end as interpretation
from (select n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) as jb
  from (select count(*) as n, avg(power(x - m, 2)) as m2, avg(power(x - m, 3)) as m3, avg(power(x - m, 4)) as m4
        from (select cast({c} as double) as x, avg(cast({c} as double)) over () as m from labels)))
"""


@query("jarque_bera_normality", "\nunion all\n".join(_jb(c) for c in ("doc_id", "quality", "toxic")))
def _(spark, root):
    return pf.jarque_bera(load(spark, root, "labels"))


cte(
    "line_pairs",
    "\nunion all\n".join(
        f"select '{a}' as column_x, '{b}' as column_y, corr({a}, {b}) as r, count(*) as n from lineitem"
        for i, a in enumerate(LINE)
        for b in LINE[i + 1 :]
    ),
)


@query(
    "pearson_significance",
    """
select 'pearson_correlation_significance' as test_name, column_x || '~' || column_y as target,
  round(r, 4) as statistic,
  case when abs(0.5 * ln((1 + r) / (1 - r)) * sqrt(n - 3)) > 1.959963984540054
       then 'significant_correlation' else 'weak_evidence' end as interpretation
from line_pairs order by abs(r) desc, column_x, column_y limit 1
""",
)
def _(spark, root):
    tested = pf.pearson_significance(load(spark, root, "lineitem").select(*LINE))
    return tested.drop("p_value")


@query(
    "histogram_40_bins",
    """
select cast(least(40, floor((v - lo) / (hi - lo) * 40) + 1) as integer) as bin, count(*) as n
from (select o_totalprice as v, min(o_totalprice) over () as lo, max(o_totalprice) over () as hi from orders) group by 1
""",
)
def _(spark, root):
    return pf.histogram(load(spark, root, "orders"), "o_totalprice")


@query(
    "box_stats",
    """
select 'o_totalprice' as column_name, count(*) as n, min(o_totalprice) as minimum,
  quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.5) as median,
  quantile_cont(o_totalprice, 0.75) as q3, max(o_totalprice) as maximum from orders
""",
)
def _(spark, root):
    return pf.box_stats(load(spark, root, "orders"), "o_totalprice")


def _assets(spark, root):
    assets = [
        {"asset_name": t, "zone": "raw_landing", "path": f"{t}.parquet", "asset_type": "source_table", "grain": "row"}
        for t in TABLES
    ]
    assets.append(
        {
            "asset_name": "fact_orders_enriched",
            "zone": "curated",
            "path": "fact_orders_enriched.parquet",
            "grain": "order item",
            "primary_key": "order_id + order_item_id + product_id + seller_id",
            "source_assets": "orders, lineitem, customer, supplier, part, events",
            "publication_ready": True,
        }
    )
    frames = {t: load(spark, root, t) for t in TABLES}
    frames["fact_orders_enriched"] = fact(spark, root)
    return catalog.asset_catalog(assets, frames)


@query(
    "asset_catalog",
    "\nunion all\n".join(
        f"select '{t}' as asset_name, 'raw_landing' as zone, 'parquet' as file_format, count(*) as record_count, "
        f"false as publication_ready from {t}"
        for t in TABLES
    )
    + "\nunion all select 'fact_orders_enriched', 'curated', 'parquet', count(*), true from fact",
)
def _(spark, root):
    return _assets(spark, root).select("asset_name", "zone", "file_format", "record_count", "publication_ready")


@query(
    "asset_rollup_per_zone",
    "select 'raw_landing' as zone, 8::bigint as assets, 0::bigint as publishable "
    "union all select 'curated', count(distinct 1), count(distinct 1) from fact",
)
def _(spark, root):
    return catalog.zone_rollup(_assets(spark, root))


@query(
    "column_catalog_search",
    """
select column_name, distinct_count, null_pct from (
  select 'c_custkey' as column_name, count(distinct c_custkey) as distinct_count, 0.0::double as null_pct from customer
  union all select 'c_nationkey', count(distinct c_nationkey), 0.0 from customer)
""",
)
def _(spark, root):
    customers = load(spark, root, "customer")
    found = catalog.column_catalog(customers, privacy.classify_columns(customers), search="KEY")
    return found.select("column_name", "distinct_count", "null_pct")
