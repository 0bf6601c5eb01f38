"""Sources and sinks through real files (ids A1, A12-A16): written to the shared folder, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeledger.operators.checks import fact_quality_suite
from tradeledger.session import shared_path
from tradeledger.sources import csv_scan, writers
from tradeledger.sources.commerce import table
from tradeledger.sources.readers import read_csv
from workload.base import query
from workload.inputs import fact

DOCUMENTS = """
select cast(doc_id as varchar) as doc_id, nullif(lang, '') as lang, nullif(source, '') as source,
  case when coalesce(text, '') <> '' then md5(text) end as text_md5, cast(length(nullif(text, '')) as bigint) as n_chars
from documents
"""


@query("csv_scan_with_line_breaks", DOCUMENTS)
def _(spark, root):
    """Texts with line breaks, quotes and separators through a CSV file."""
    path = shared_path(spark, "documents-csv")
    writer = table(spark, root, "documents").select("doc_id", "lang", "source", "text").write
    writer.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    rows = csv_scan.scan(spark, path).rows
    return rows.select("doc_id", "lang", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


@query(
    "csv_scan_rejects",
    """
select '3 fields, the header has 2' as reason, count(*) as records from nation where n_nationkey % 5 = 1
union all
select 'kept', count(*) from nation where n_nationkey % 5 <> 1
""",
)
def _(spark, root):
    """Records that do not fit the header go to the rejects, the others are kept."""
    path = shared_path(spark, "nations-csv")
    nations = table(spark, root, "nation")
    more = F.when(F.col("n_nationkey") % 5 == 1, F.lit(',"more"')).otherwise("")
    line = F.concat(F.col("n_nationkey").cast("string"), F.lit(',"'), "n_name", F.lit('\nof region"'), more)
    header = spark.range(1).select(F.lit("n_nationkey,n_name").alias("line"))
    # one file: the header, then the lines
    lines = header.withColumn("at", F.lit(-1)).unionByName(nations.select(line.alias("line"), F.col("n_nationkey").cast("int").alias("at")))
    lines.repartitionByRange(1, "at").sortWithinPartitions("at").select("line").write.text(path)
    found = csv_scan.scan(spark, path)
    kept = found.rows.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("records"))
    return found.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("records")).unionByName(kept)


CUSTOMERS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query(
    "dual_sink_round_trip",
    f"select 'parquet' as format, {CUSTOMERS} from customer union all select 'csv', {CUSTOMERS} from customer",
)
def _(spark, root):
    """The same rows as Parquet (partitioned) and as CSV."""
    path = shared_path(spark, "customers")
    rows = table(spark, root, "customer").selectExpr(*CUSTOMERS.split(", "))
    writers.write_dual(rows, path, ["c_mktsegment"])
    csv, _, _ = read_csv(spark, f"{path}.csv", schema=rows.schema)
    parquet = spark.read.schema(rows.schema).parquet(f"{path}.parquet").select(*rows.columns)
    return parquet.select(F.lit("parquet").alias("format"), "*").unionByName(csv.select(F.lit("csv").alias("format"), "*"))


@query("bi_csv_round_trip", f"select {CUSTOMERS}, 'utf-8-sig' as encoding from customer")
def _(spark, root):
    """`;` separated CSV with a byte-order mark."""
    path = shared_path(spark, "customers-bi")
    rows = table(spark, root, "customer").selectExpr(*CUSTOMERS.split(", "))
    writers.write_bi_csv(rows, path)
    back, encoding, _ = read_csv(spark, path, schema=rows.schema, sep=";")
    return back.withColumn("encoding", F.lit(encoding))


@query(
    "jsonl_round_trip",
    """
select o_orderkey, o_orderstatus as status, o_totalprice as price, cast(count(l_linenumber) as bigint) as n_lines,
  array_to_string(list(cast(l_linenumber as varchar) order by l_linenumber), ',') as lines
from orders join lineitem on l_orderkey = o_orderkey group by all
""",
)
def _(spark, root):
    """Nested records, one in a line."""
    path = shared_path(spark, "orders-jsonl")
    lines = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("lines"))
    rows = table(spark, root, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    writers.write_jsonl(rows.select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("features"), "lines"), path)
    back = spark.read.schema("o_orderkey long, features struct<status: string, price: double>, lines array<long>").json(path)
    return back.select("o_orderkey", "features.*", F.size("lines").cast("long").alias("n_lines"), F.array_join(F.col("lines").cast("array<string>"), ",").alias("lines"))


@query(
    "run_log_exactly_once",
    """
select 'daily ' || o_orderstatus as run, o_orderstatus as status, count(*) as n_orders, sum(o_totalprice) > 0 as has_revenue
from orders group by o_orderstatus
""",
)
def _(spark, root):
    """A log of runs where each run is written twice and one attempt is stopped before its commit."""
    path = shared_path(spark, "run-log")
    totals = table(spark, root, "orders").groupBy(F.col("o_orderstatus").alias("status"))
    totals = totals.agg(F.count(F.lit(1)).alias("n_orders"), (F.sum("o_totalprice") > 0).alias("has_revenue")).persist()
    for status in [r["status"] for r in totals.select("status").collect()]:
        for _ in range(2):
            writers.append_log(totals.filter(F.col("status") == status), path, f"daily {status}")
    totals.write.parquet(f"{path}/{writers.RUN}=stopped/{writers.ATTEMPT}=0")
    totals.unpersist()
    return writers.read_log(spark, path, with_run=True).withColumnRenamed(writers.RUN, "run")


SUITE = "select 'now' as generated_at_utc, cast(count(*) as bigint) as total_checks from generate_series(1, 25) t(i)"


@query("check_summary_document", SUITE)
def _(spark, root):
    """The JSON document of the quality suite: its totals agree with its array."""
    path = shared_path(spark, "summary-json")
    writers.write_summary_json(fact_quality_suite(fact(spark, root), 1), path, "now")
    doc = spark.read.json(path)
    same = (F.size("checks") == F.col("total_checks")) & (
        F.size(F.filter("checks", lambda c: c["status"] == "FAIL")) == F.col("failed_checks")
    )
    return doc.filter(same).select("generated_at_utc", "total_checks")
