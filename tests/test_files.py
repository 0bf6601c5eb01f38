"""Scans and sinks with real files, and the whole batch run."""

import json
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeledger.plans import batch
from tradeledger.sources import readers, writers
from tradeledger.sources.commerce import commerce


def write(path, data):
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize(
    ("data", "encoding", "city"),
    [
        ("order_id,city\n1,São\n".encode(), "utf-8", "São"),
        ("\ufefforder_id,city\n1,São\n".encode(), "utf-8-sig", "São"),
        ("order_id,city\n1,São\n".encode("latin-1"), "latin-1", "São"),
    ],
)
def test_csv_encodings(spark, tmp_path, data, encoding, city):
    df, found, dates = readers.read_csv(spark, write(tmp_path / "t.csv", data))
    assert (found, dates, df.columns) == (encoding, [], ["order_id", "city"])
    assert df.first()["city"] == city


def test_csv_dates_are_parsed_unless_unreadable(spark, tmp_path):
    good, _, dates = readers.read_csv(spark, write(tmp_path / "a.csv", b"id,order_date\n1,2020-01-02 10:00:00\n"))
    assert dates == ["order_date"] and good.first()["order_date"].year == 2020
    bad, _, dates = readers.read_csv(spark, write(tmp_path / "b.csv", b"id,order_date\n1,2020-01-02 10:00:00\n2,never\n"))
    assert dates == [] and bad.schema["order_date"].dataType.simpleString() == "string"


def test_layered_read_prefers_the_standardised_copy(spark, tmp_path):
    write(tmp_path / "T.csv", b"Order ID,CustomerName\n1,x\n")
    landing = standardized = str(tmp_path)
    assert readers.read_layered(spark, "T", standardized, landing).columns == ["order_id", "customer_name"]
    spark.range(3).withColumnRenamed("id", "Order ID").write.parquet(f"{standardized}/T.parquet")
    assert readers.read_layered(spark, "T", standardized, landing).count() == 3
    assert readers.read_any(spark, f"{standardized}/T.parquet").count() == 3
    assert readers.missing_files(spark, landing, ["T.csv", "U.csv"]) == ["U.csv"]


def test_parameters_are_bound(spark):
    df = spark.createDataFrame([("a", 1), ("b' or 1=1", 2)], "k string, v int")
    assert readers.run_sql(spark, "select v from t where k = :k", {"k": "b' or 1=1"}, t=df).first()["v"] == 2


def test_dual_and_bi_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "ação", 2020), (2, "b;c", 2021)], "id int, name string, order_year int")
    writers.write_dual(df, str(tmp_path / "d"), ["order_year"])
    assert spark.read.parquet(str(tmp_path / "d.parquet")).count() == 2
    assert sorted(p.name for p in (tmp_path / "d.parquet").iterdir() if p.is_dir()) == ["order_year=2020", "order_year=2021"]
    assert spark.read.option("header", True).csv(str(tmp_path / "d.csv")).columns == ["id", "name", "order_year"]
    writers.write_bi_csv(df.coalesce(1), str(tmp_path / "bi"))
    text = next((tmp_path / "bi").glob("part-*.csv")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfid;name;order_year") and "ação".encode() in text and b'"b;c"' in text


def test_log_append_adds_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    writers.append_log(spark.createDataFrame([(1,)], "a int"), path)
    writers.append_log(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert {(r["a"], r["b"]) for r in writers.read_log(spark, path).collect()} == {(1, None), (2, "x")}


def test_a_run_leaves_one_set_of_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1,), (2,)], "a int")
    for _ in range(2):
        writers.append_log(rows, path, "2024-01-01 00:00:00")
    writers.append_log(rows.limit(1), path, "7")

    def stop(*args):
        raise RuntimeError("stopped before the commit")

    with monkeypatch.context() as m:
        m.setattr(writers, "_commit", stop)
        for run in ("7", "never finished"):
            with pytest.raises(RuntimeError):
                writers.append_log(rows, path, run)
    got = [(r["log_run"], r["a"]) for r in writers.read_log(spark, path, with_run=True).collect()]
    assert sorted(got) == [("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:00", 2), ("7", 1)]
    writers.append_log(rows, path, "never finished")
    assert writers.read_log(spark, path).count() == 5
    with pytest.raises(ValueError, match="named by"):
        writers.append_log(rows, path, "../up")


def test_json_sinks(spark, tmp_path):
    checks = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "check_name string, status string")
    writers.write_summary_json(checks, str(tmp_path / "s"), "now")
    doc = json.loads(next((tmp_path / "s").glob("part-*.json")).read_text())
    assert (doc["total_checks"], doc["failed_checks"], len(doc["checks"])) == (2, 1, 2)
    writers.write_jsonl(checks.select(F.struct("*").alias("features")), str(tmp_path / "l"))
    lines = "".join(p.read_text() for p in (tmp_path / "l").glob("part-*.json")).splitlines()
    assert {json.loads(line)["features"]["check_name"] for line in lines} == {"a", "b"}


def test_inventory(spark, root):
    t = commerce(spark, root)
    got = {r["table_name"]: r for r in readers.inventory({"items": t.items, "orders": t.orders}, {"items": "utf-8"}).collect()}
    assert got["items"]["rows"] == t.items.count() and got["items"]["encoding"] == "utf-8"
    assert "order_approved_at" not in got["orders"]["date_columns"]
    assert "shipping_limit_date" in got["items"]["date_columns"]


def test_batch_run(spark, root, tmp_path):
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    run = batch.Run(spark, commerce(spark, root), str(tmp_path), now, min_rows=1000, tier_bounds=(490, 560, 610))
    seconds = batch.run_all(run)
    assert list(seconds) == list(batch.STEPS)
    batch.monitor(run)  # the step again: still one row for the run
    history = run.path("monitoring", "history.parquet")
    assert writers.read_log(spark, history).count() == 1
    batch.monitor(replace(run, run_id="next"))
    assert {r["log_run"] for r in writers.read_log(spark, history, with_run=True).collect()} == {now, "next"}
    assert run.published().count() == run.fact().count()
    monitoring = {r["check_name"]: r["status"] for r in run.read("monitoring", "published_monitoring").collect()}
    assert len(monitoring) == 12 and monitoring["published_file_freshness_hours"] == "PASS"
    manifest = run.read("reports", "manifest").collect()
    assert len(manifest) == 17 and all(r["rows"] > 0 for r in manifest)
    assert Path(run.path("semantic", "cohort_slice.csv")).is_dir()
    cards = {r["dataset_name"] for r in run.read("monitoring", "scorecards").collect()}
    assert cards == {"fact_orders_enriched", "fact_orders_dashboard"}
    catalog = {r["asset_name"]: r["record_count"] for r in run.read("monitoring", "catalog").collect()}
    assert catalog["fact_orders_enriched"] == run.fact().count() and len(catalog) == 15


def test_too_small_a_fact_stops_the_run(spark, root, tmp_path):
    run = batch.Run(spark, commerce(spark, root), str(tmp_path), "2024-01-01 00:00:00")
    with pytest.raises(ValueError, match="at least 100001"):
        batch.run_all(run)


def test_group_documents_and_their_manifest(spark, tmp_path):
    rows = [(s, f"check {c}", "FAIL" if (s * c) % 5 == 0 else "PASS") for s in range(300) for c in range(4)]
    checks = spark.createDataFrame(rows, "seller long, check_name string, status string")
    with readers._settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):  # as with many groups
        manifest = writers.write_group_documents(checks, str(tmp_path / "g"), ["seller"], "now").collect()
    documents = spark.read.json(str(tmp_path / "g" / "documents")).collect()
    assert len(documents) == 300 == sum(m["documents"] for m in manifest) and len(manifest) > 1
    for d in documents:
        own = [r for r in rows if r[0] == d["seller"]]
        assert (d["total_checks"], d["failed_checks"], len(d["checks"])) == (4, sum(r[2] == "FAIL" for r in own), 4)
        assert sum(m["first_group"]["seller"] <= d["seller"] <= m["last_group"]["seller"] for m in manifest) == 1


def test_counts_come_from_footers(spark, tmp_path):
    paths = {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}
    spark.range(1000).repartition(3).write.parquet(paths["a"])
    spark.range(7).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(paths["b"])
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert readers.footer_counts(spark, paths) == {"a": 1000, "b": 7}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    with readers.from_footers(spark):
        plan = readers.footer_plan(spark, paths["a"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_quarantine_reads_its_input_once(spark, tmp_path):
    from tradeledger.operators.cleaning import split_rejected
    from tradeledger.operators.quarantine import write_quarantine

    spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") - 20.0).alias("price")).write.parquet(str(tmp_path / "in"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.read.parquet(str(tmp_path / "in")).mapInArrow(counted, "id long, price double")
    rules = [("missing_price", F.col("price").isNull()), ("negative_price", F.col("price") < 0), ("odd", F.col("id") % 2 == 1)]
    done = write_quarantine(df, rules, str(tmp_path / "out"))
    assert reads.value == 1000
    kept, gone = split_rejected(df, [(n, F.coalesce(c, F.lit(False))) for n, c in rules])
    assert sorted(map(tuple, done.accepted.collect())) == sorted(map(tuple, kept.collect()))
    assert sorted(map(str, done.rejected.collect())) == sorted(map(str, gone.collect()))
    assert done.counts["rows"] == 1000 and done.counts["accepted"] == kept.count() and done.counts["reason__odd"] == 500
