"""Shared aggregates against the reports and marts that scan the fact on their own."""

import pytest
from pyspark.sql import functions as F

from tradeledger.plans import marts, reports, shared
from tradeledger.plans.fact import build_fact
from tradeledger.plans.published import publish
from tradeledger.sources.commerce import commerce


@pytest.fixture(scope="module")
def tables(spark, root, tmp_path_factory):
    """The fact with some odd rows, and the published table, as files."""
    folder = str(tmp_path_factory.mktemp("shared"))
    fact = build_fact(commerce(spark, root), (490, 560, 610))
    odd = fact.limit(40).withColumns({c: F.lit(None).cast(fact.schema[c].dataType) for c in ("order_id", "customer_state", "order_date", "is_delayed", "payment_type_mode")})
    fact.unionByName(odd).unionByName(fact.limit(30)).write.parquet(f"{folder}/fact")
    publish(fact).write.parquet(f"{folder}/published")
    return spark.read.parquet(f"{folder}/fact"), spark.read.parquet(f"{folder}/published")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_reports_have_the_same_rows_in_the_same_order(tables):
    both = reports.shared_reports(tables[0])
    for name, report in reports.REPORTS.items():
        one, two = report(tables[0]), report(both)
        assert two.dtypes == one.dtypes and rows(two) == rows(one), name


def test_marts_have_the_same_rows(tables):
    made = marts.shared_marts(tables[1])
    assert list(made) == list(marts.MARTS)
    for name, mart in marts.MARTS.items():
        one, two = mart(tables[1]), made[name]
        assert two.dtypes == one.dtypes and sorted(rows(two), key=str) == sorted(rows(one), key=str), name


def test_an_empty_table(tables):
    nothing = tables[0].limit(0)
    both = reports.shared_reports(nothing)
    for name, report in reports.REPORTS.items():
        assert rows(report(both)) == rows(report(nothing)), name
    assert all(not rows(m) for m in marts.shared_marts(tables[1].limit(0)).values())


def test_two_scans_for_all(tables, monkeypatch):
    plans = []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(shared, "stage", seen)
    reports.shared_reports(tables[0])
    marts.shared_marts(tables[1])
    assert [p.count("Relation [") for p in plans] == [2, 2]


def test_distinct_counts_of_a_hot_order_and_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), F.col("id") % 700)).alias("o"),
        (F.col("id") % 2).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") / 7).alias("v"),
    )
    made = shared.share(
        df, {"k": F.col("k")}, {"all": [], "k": ["k"]}, {"rows": shared.State(F.lit(1).cast("long"), "count"), **shared.double_states("v", "v")},
        {"orders": (F.col("o"), ["all", "k"])},
    )
    assert made.grain([]).first()["orders"] == df.select("o").distinct().count()
    want = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.countDistinct("o").alias("n")).collect()}
    assert {r["k"]: r["orders"] for r in made.grain(["k"]).collect()} == want


def test_sets_of_an_entity_and_nothing_wider_are_shuffled(tables, monkeypatch):
    plans = []
    monkeypatch.setattr(shared, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    reports.shared_reports(tables[0])
    marts.shared_marts(tables[1])
    # one aggregate of the entities with their sets, none of (group, entity) rows or of all keys together
    assert all("collect_set" in p and p.count("Aggregate [") == 4 for p in plans)


def test_null_keys_and_entities_in_several_groups(spark):
    df = spark.createDataFrame([(None, "a", "x"), (None, "a", "y"), (1, "a", "x"), (1, None, "x"), (2, None, "z"), (1, "b", None)], "k int, o string, c string")
    made = shared.share(
        df, {"k": F.col("k"), "c": F.col("c")}, {"all": [], "k": ["k"], "kc": ["k", "c"]}, {"rows": shared.State(F.lit(1).cast("long"), "count")},
        {"orders": (F.col("o"), ["all", "k", "kc"]), "seen": (F.col("c"), ["k"])}, cells=False,
    )
    assert made.grain([]).first()["orders"] == 2
    assert {(r["k"], r["orders"], r["seen"]) for r in made.grain(["k"]).collect()} == {(None, 1, 2), (1, 2, 1), (2, 0, 1)}
    assert {(r["k"], r["c"], r["orders"]) for r in made.grain(["k", "c"]).collect()} == {(None, "x", 1), (None, "y", 1), (1, "x", 1), (2, "z", 0), (1, None, 1)}


def test_a_report_counts_orders_apart_from_its_measures(tables):
    plan = reports.category_detail(tables[0])._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Aggregate [" in line]
    # the aggregate over (category, order) has no measures
    assert any("order_id" in line for line in lines) and not any("order_id" in line and "sum(" in line for line in lines)
    assert "Expand" not in plan and "count(distinct" not in plan
    got = {r["categoria"]: r["total_pedidos"] for r in reports.category_detail(tables[0]).collect()}
    want = tables[0].groupBy(reports._category().alias("c")).agg(F.countDistinct("order_id").alias("n")).collect()
    assert got == {r["c"]: r["n"] for r in want}
