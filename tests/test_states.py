"""Partition states: reruns read changed partitions only, and agree with a full run."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from __spark_entry__ import queries

from tradeledger.operators import checks as ck
from tradeledger.operators import profiling as pf
from tradeledger.operators import states
from tradeledger.plans.fact import build_fact
from tradeledger.sources.commerce import commerce
from workload import state_queries
from workload.quality_queries import MIN_ROWS


@pytest.fixture(scope="module")
def fact(spark, root, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states") / "source")
    build_fact(commerce(spark, root), (490, 560, 610)).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_checks_read_changed_partitions_only(spark, fact, tmp_path):
    path, store = str(tmp_path / "fact"), str(tmp_path / "states")
    years = sorted(str(r[0]) for r in fact.select("order_year").distinct().collect() if r[0] is not None)

    def run():
        got, read = states.incremental_row_checks(spark, path, "order_year", store, 10)
        full = spark.read.parquet(path)
        assert rows(got) == rows(ck.evaluate(full, ck.row_checks(full.columns, 10)))
        return set(read)

    part = fact.filter((F.col("order_year") != int(years[0])) | (F.col("order_month") < 4))
    part.write.partitionBy("order_year").parquet(path)
    assert set(years) <= run()  # the first run reads everything
    assert run() == set()
    fact.filter(F.col("order_year") == int(years[0])).drop("order_year").write.mode("overwrite").parquet(f"{path}/order_year={years[0]}")
    assert run() == {years[0]}
    fact.limit(7).drop("order_year").write.mode("append").parquet(f"{path}/order_year={years[1]}")
    assert run() == {years[1]}
    import shutil

    shutil.rmtree(f"{path}/order_year={years[2]}")
    assert run() == set()  # a partition that is gone is left out without reading


def test_only_the_changed_partition_is_planned(spark, fact, tmp_path):
    path, store, seen = str(tmp_path / "fact"), str(tmp_path / "states"), []
    fact.filter(F.col("order_year").isNotNull()).write.partitionBy("order_year").parquet(path)

    def build(df):
        seen.append(df.select(F.input_file_name().alias("f")).distinct().collect())
        return df.groupBy(states.PART).count()

    states.refresh(spark, path, "order_year", store, build)
    year = fact.agg(F.max("order_year")).first()[0]
    fact.limit(5).drop("order_year").write.mode("append").parquet(f"{path}/order_year={year}")
    _, read = states.refresh(spark, path, "order_year", store, build)
    assert read == [str(year)] and len(seen) == 2
    assert seen[1] and all(f"order_year={year}/" in r["f"] for r in seen[1])


def test_sketches_stay_within_their_bounds(spark, tmp_path):
    n = 60_000
    df = spark.range(n).select(
        F.col("id").alias("key_id"), (F.col("id") % 5000).alias("many"), (F.col("id") % 7).alias("few"), (F.rand(3) * 1000).alias("x"),
        F.when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 3000)).alias("word"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 100).alias("holes"), F.lit(None).cast("double").alias("nothing"), (F.col("id") % 3).alias("p"),
    )
    path = str(tmp_path / "t")
    df.write.partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    profile, read = states.profile_incrementally(spark, path, "p", str(tmp_path / "s"))
    assert sorted(read) == ["0", "1", "2"]
    got = {r["column_name"]: r for r in profile.collect()}
    exact = {r["column_name"]: r for r in pf.column_counts(table).collect()}
    assert set(got) == set(exact)
    for c, r in got.items():
        assert (r["rows"], r["null_count"]) == (n, exact[c]["null_count"])
        assert abs(r["unique_count"] - exact[c]["unique_count"]) <= 4 * states.DISTINCT_ERROR * max(exact[c]["unique_count"], 1), c
    ranks = table.agg(*[F.avg((F.col("x") <= got["x"][q]).cast("int")).alias(q) for q in ("q25", "q50", "q75")]).first()
    assert all(abs(ranks[i] - p) <= 2 * states.QUANTILE_ERROR for i, p in enumerate((0.25, 0.5, 0.75)))
    assert got["word"]["frequent"][0]["item"] == "hot" and abs(got["word"]["frequent"][0]["count"] - n // 4) <= n / 100
    assert got["nothing"]["q50"] is None and got["nothing"]["unique_count"] == 0
    kept, _ = states.refresh(spark, path, "p", str(tmp_path / "s"), states.column_states)
    assert [r["column_name"] for r in states.sketched_keys(kept, table).collect()] == ["key_id"] or {r["column_name"] for r in states.sketched_keys(kept, table).collect()} == {"key_id", "x"}
    assert states.sketched_keys(kept, table, ["few"]).count() == 0


def test_no_cells_are_shuffled(spark):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("s")).withColumn(states.PART, F.lit("a"))
    plan = states.column_states(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_row_checks_need_no_other_columns(fact):
    """The columns that a table of checks keeps, and that no column of it is kept for nothing."""
    checks = ck.row_checks(fact.columns, 10)
    assert rows(ck.evaluate(fact.select(*ck.ROW_CHECK_COLUMNS), checks)) == rows(ck.evaluate(fact, checks))
    for c in ck.ROW_CHECK_COLUMNS:
        with pytest.raises(AnalysisException):
            ck.evaluate(fact.select(*ck.ROW_CHECK_COLUMNS).drop(c), checks).collect()


def test_the_fact_is_computed_once_for_both_check_runs(spark, root, monkeypatch):
    plans = []

    def seen(*names):
        plans.append(build_fact(commerce(spark, root), (490, 560, 610)))
        return plans[-1]

    monkeypatch.setattr(state_queries, "fact", seen)
    monkeypatch.setattr(DataFrame, "persist", lambda self, *level: pytest.fail("whole rows of the fact are kept"))
    checks = queries()["incremental_row_checks_after_a_change"](spark, root)
    full = ck.evaluate(plans[0], ck.row_checks(plans[0].columns, MIN_ROWS)).drop("details")
    assert len(plans) == 1 and rows(checks) == rows(full)
