"""Incremental states, sketches, quarantine, group documents and footers (ids A4, A14, B20, I2-I6, I11, J11, N10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.operators import cleaning, states
from tradeledger.operators.checks import ROW_CHECK_COLUMNS, Check, evaluate, negative_values
from tradeledger.operators.comoments import wide_correlation
from tradeledger.operators.profiling import column_counts
from tradeledger.operators.quarantine import write_quarantine
from tradeledger.session import shared_path, stage
from tradeledger.sources import readers, writers
from tradeledger.sources.commerce import commerce, table
from workload.base import query
from workload.inputs import fact
from workload.quality_queries import MIN_ROWS

KEY_CHECKS = "('expected_schema', 'granularity_duplicates', 'payment_reconciliation_gap_over_1_real_pct')"


@query("incremental_row_checks_after_a_change", f"select check_name, status, metric_value, threshold, severity from suite where check_name not in {KEY_CHECKS}")
def _(spark, root):
    """Row checks of the fact from stored states, after one year has been replaced."""
    path, store = shared_path(spark, "checked-fact"), shared_path(spark, "check-states")
    # the fact is computed and written once, with the columns that the checks read
    fact(spark, root).select(*ROW_CHECK_COLUMNS, "order_year", "order_month").write.partitionBy("order_year").parquet(path)
    last = spark.read.parquet(path).agg(F.max("order_year")).first()[0]
    year = f"{path}/order_year={last}"
    whole = stage(spark.read.parquet(year), "last-year")
    whole.filter(F.col("order_month") < 3).write.mode("overwrite").parquet(year)
    states.incremental_row_checks(spark, path, "order_year", store, MIN_ROWS)
    whole.write.mode("overwrite").parquet(year)
    checks, read = states.incremental_row_checks(spark, path, "order_year", store, MIN_ROWS)
    if read != [str(last)]:
        raise RuntimeError(f"read {read}, only {last} has changed")
    return checks.drop("details")


ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"


@query(
    "sketch_profile_of_orders",
    "\nunion all\n".join(
        f"select '{c}' as column_name, count(*) as rows, count(*) filter ({c} is null) as null_count, true as unique_within_4_errors, "
        f"{'true' if c in ('o_orderkey', 'o_custkey', 'o_totalprice') else 'cast(null as boolean)'} as median_within_bound from orders"
        for c in ORDERS.split()
    ),
)
def _(spark, root):
    """Profile from mergeable sketches by order status, held against the exact counts."""
    path, store = shared_path(spark, "profiled-orders"), shared_path(spark, "profile-states")
    orders = table(spark, root, "orders").select(*ORDERS.split())
    orders.withColumn("part", F.col("o_orderstatus")).write.partitionBy("part").parquet(path)
    kept, _ = states.refresh(spark, path, "part", store, lambda df: states.column_states(df.drop("part")))
    profile = states.sketch_profile(kept).alias("s").join(column_counts(orders).alias("e"), "column_name")
    near = F.abs(F.col("s.unique_count") - F.col("e.unique_count")) <= 4 * states.DISTINCT_ERROR * F.col("e.unique_count")
    medians = {r["column_name"]: r["q50"] for r in profile.collect() if r["q50"] is not None}
    ranks = orders.agg(*[F.avg((F.col(c) <= m).cast("int")).alias(f"le_{c}") for c, m in medians.items()], *[F.avg((F.col(c) < m).cast("int")).alias(f"lt_{c}") for c, m in medians.items()]).first()
    bound = 2 * states.QUANTILE_ERROR
    ok = {c: ranks[f"lt_{c}"] - bound <= 0.5 <= ranks[f"le_{c}"] + bound for c in medians}
    within = F.create_map(*[F.lit(v) for pair in ok.items() for v in pair])
    return profile.select("column_name", "s.rows", "s.null_count", near.alias("unique_within_4_errors"), F.element_at(within, F.col("column_name")).alias("median_within_bound"))


@query("sketched_candidate_keys", "select 'o_orderkey' as column_name, count(*) as non_null_count, count(distinct o_orderkey) as unique_non_null_count from orders")
def _(spark, root):
    """Candidate keys: the exact pass covers only what the sketches leave open."""
    orders = table(spark, root, "orders").select(*ORDERS.split())
    kept = states.column_states(orders.withColumn(states.PART, F.col("o_orderstatus")))
    return states.sketched_keys(kept, orders, ["o_orderkey", "o_custkey"]).select("column_name", "non_null_count", "unique_non_null_count")


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey")
PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]]


@query(
    "wide_correlation_pairs",
    "\nunion all\n".join(f"select '{a}' as column_x, '{b}' as column_y, round(corr({a}, {b}), 7) as r, count(*) as n from lineitem" for a, b in PAIRS),
)
def _(spark, root):
    """All pairs from exact co-moments by blocks."""
    found = wide_correlation(table(spark, root, "lineitem"), list(NUMBERS))
    return found.withColumn("r", F.round("r", 7))


@query(
    "quarantine_counts",
    """
with r as (
  select order_id is null as missing_order_id, order_item_id is null as missing_order_item_id, product_id is null as missing_product_id,
    seller_id is null as missing_seller_id, coalesce(price, 0) < 0 as negative_price, coalesce(freight_value, 0) < 0 as negative_freight from raw_items),
t as (select *, missing_order_id or missing_order_item_id or missing_product_id or missing_seller_id or negative_price or negative_freight as bad from r)
select 'rows' as kind, count(*) as observed, count(*) as written from t
union all select 'accepted', count(*) filter (not bad), count(*) filter (not bad) from t
union all select 'rejected', count(*) filter (bad), count(*) filter (bad) from t
union all select 'reason__negative_price', count(*) filter (negative_price), count(*) filter (negative_price) from t
""",
)
def _(spark, root):
    """Accepted and rejected items of one write, its observed counts beside those of the files."""
    done = write_quarantine(commerce(spark, root).items, cleaning.item_rejections(), shared_path(spark, "quarantine"))
    kept, gone = done.accepted.count(), done.rejected.count()
    negative = done.rejected.filter(F.array_contains(F.split("rejection_reason", r"\|"), "negative_price")).count()
    written = {"rows": kept + gone, "accepted": kept, "rejected": gone, "reason__negative_price": negative}
    return spark.createDataFrame([(k, done.counts[k], n) for k, n in written.items()], "kind string, observed long, written long")


@query(
    "group_check_documents",
    """
with c as (
  select seller_id, count(*) filter (coalesce(price, 0) < 0) > 0 as a, count(*) filter (coalesce(freight_value, 0) < 0) > 0 as b from raw_items group by seller_id)
select seller_id, cast(2 as bigint) as total_checks, cast(a as bigint) + cast(b as bigint) as failed_checks, true as in_manifest from c where seller_id is not null
""",
)
def _(spark, root):
    """One document a seller, found through the manifest."""
    path = shared_path(spark, "seller-checks")
    checks: list[Check] = negative_values()
    rows = evaluate(commerce(spark, root).items.filter("seller_id is not null"), checks, ["seller_id"])
    manifest = writers.write_group_documents(rows, path, ["seller_id"], "now")
    documents = spark.read.json(f"{path}/documents").select("*", F.col("_metadata.file_name").alias("_file"))
    placed = documents.join(manifest.select("file_name", "first_group", "last_group"), F.col("_file") == F.col("file_name"), "left")
    inside = F.coalesce((F.col("seller_id") >= F.col("first_group.seller_id")) & (F.col("seller_id") <= F.col("last_group.seller_id")), F.lit(False))
    return placed.select("seller_id", "total_checks", "failed_checks", inside.alias("in_manifest"))


TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


@query("counts_from_footers", "\nunion all\n".join(f"select '{t}' as table_name, count(*) as rows from {t}" for t in TABLES))
def _(spark, root):
    """Row counts of Parquet tables without reading a data page."""
    counts = readers.footer_counts(spark, {t: f"{root}/{t}.parquet" for t in TABLES})
    frames = {t: table(spark, root, t) for t in TABLES}
    return readers.inventory(frames, counts=counts).select("table_name", "rows")
