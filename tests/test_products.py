"""Published table, marts, reports and star schema on the smallest scale and on damaged copies."""

import math

import pytest
from pyspark.sql import functions as F

from tradeledger.operators import catalog, cohorts
from tradeledger.operators import governance as gv
from tradeledger.operators import profiling as pf
from tradeledger.plans import marts, published, reports, star
from tradeledger.plans.fact import build_fact
from tradeledger.session import stage
from tradeledger.sources.commerce import commerce


@pytest.fixture(scope="module")
def fact(spark, root):
    return stage(build_fact(commerce(spark, root), (490, 560, 610)), "fact")


@pytest.fixture(scope="module")
def table(fact):
    return published.publish(fact)


def failed(checks):
    return sorted(r["check_name"] for r in checks.filter("status = 'FAIL'").collect())


def test_published_columns_and_defaults(fact, table):
    assert table.columns == published.PUBLISHED_COLUMNS and len(table.columns) == 34
    assert not set(table.columns) & set(published.FORBIDDEN_COLUMNS)
    assert table.count() == fact.count()
    for column, value in published.DEFAULT_FILL.items():
        assert table.filter(F.col(column).isNull()).count() == 0
        assert fact.filter(F.col(column).isNull()).count() <= table.filter(F.col(column) == value).count()


def test_privacy_checks_pass_on_a_clean_copy(fact, table):
    checks = published.privacy_checks(table, fact)
    assert checks.count() == 16 and failed(checks) == []


def test_privacy_checks_find_damage(fact, table):
    damaged = (
        table.withColumn("customer_id", F.lit("x"))
        .withColumn("seller_key", F.lit("raw"))
        .withColumn("customer_state", F.when(F.col("customer_state") == "NA", "XX").otherwise(F.col("customer_state")))
        .drop("price")
    )
    got = failed(published.privacy_checks(damaged, fact))
    for name in ("required_columns", "forbidden_columns_absent", "unexpected_columns", "classification_leakage"):
        assert name in got
    assert "pseudonymized__seller_key" in got and "default_fill__customer_state" in got


def test_policy_alignment(fact, table):
    policy = published.PrivacyContract(forbidden=["other"], defaults={"order_status": "?"})
    got = failed(published.privacy_checks(table, fact, policy=policy))
    assert got == ["policy_default_fill_alignment", "policy_forbidden_columns_alignment"]


def test_publish_aborts_before_writing(fact, table):
    written = []
    published.gated_publish(fact, written.append)
    assert len(written) == 1
    with pytest.raises(published.PublicationBlocked, match="required_columns"):
        published.gated_publish(fact, written.append, published=table.drop("price"))
    assert len(written) == 1


def test_monitoring(table):
    # the input repeats (order_id, order_item_id) over products and has rows without price
    assert failed(gv.monitor_published(table, 1)) == [
        "published_critical_nulls__price",
        "published_primary_key_duplicates",
    ]
    table = table.fillna({"price": 0.0}).dropDuplicates(["order_id", "order_item_id"])
    assert failed(gv.monitor_published(table, 1)) == []
    checks = gv.monitor_published(table.drop("seller_key", "seller_delay_rate"), 10**9)
    got = failed(checks)
    assert got == [
        "published_critical_nulls__seller_key",
        "published_expected_schema",
        "published_min_rows",
        "published_missing_pct__seller_delay_rate",
    ]


def test_marts_cover_all_rows(table):
    rows = table.count()
    assert marts.logistics_mart(table).agg(F.sum("total_items")).first()[0] == rows
    for mart in (marts.cohort_mart, marts.category_mart, marts.state_mart):
        assert mart(table).agg(F.sum("items")).first()[0] == rows
    frame = table.select("seller_key", "total_item_value").toPandas()
    got = marts.top_sellers(table, 3).toPandas()
    expected = frame.groupby("seller_key")["total_item_value"].sum().sort_values(ascending=False).head(3)
    assert got["seller_key"].tolist() == expected.index.tolist()
    assert got["total_item_value"].tolist() == pytest.approx(expected.tolist())


def test_pareto(spark):
    df = spark.createDataFrame([("a", 60.0), ("b", 30.0), (None, 10.0), ("a", 10.0)], "product_category_name_english string, revenue double")
    pareto, cut = marts.category_pareto(df)
    got = [(r["category"], r["revenue"]) for r in pareto.orderBy("cum_pct").collect()]
    assert got == [("a", 70.0), ("b", 30.0), ("unknown", 10.0)]
    assert cut.first()["categories"] == 1
    assert marts.category_pareto(df.limit(0))[1].first()["categories"] == 1


def test_retention_and_pivot(spark):
    df = spark.createDataFrame(
        [("2020-01", 0, 10, 1.0), ("2020-01", 2, 5, 2.0), ("2020-02", 1, 3, 3.0)],
        "purchase_cohort_month string, cohort_order_month_number int, customers long, avg_ticket double",
    )
    kept = cohorts.retention(df)
    got = {(r["purchase_cohort_month"], r["cohort_order_month_number"]): r["retention_rate"] for r in kept.collect()}
    assert got == {("2020-01", 0): 100.0, ("2020-01", 2): 50.0, ("2020-02", 1): None}
    wide = cohorts.pivot_by_offset(kept, "retention_rate").orderBy("purchase_cohort_month").collect()
    assert wide[0]["m2"] == 50.0 and set(wide[0].asDict()) == {"purchase_cohort_month", "m0", "m1", "m2"}


def test_monthly_revenue_month_sources(spark):
    df = spark.createDataFrame([(2020, 3, 5.0), (2020, 3, 1.0)], "order_year int, order_month int, total_item_value double")
    assert marts.monthly_revenue(df).first().asDict() == {"order_year_month": "2020-03", "revenue": 6.0}
    ready = df.withColumn("order_year_month", F.lit("x"))
    assert marts.monthly_revenue(ready).first()["order_year_month"] == "x"
    stamped = df.select("total_item_value", F.lit("2021-04-01").cast("timestamp").alias("order_purchase_timestamp"))
    assert marts.monthly_revenue(stamped).first()["order_year_month"] == "2021-04"
    with pytest.raises(ValueError):
        marts.monthly_revenue(df.select("total_item_value"))


def test_every_report_runs_on_an_empty_fact(fact):
    for name, report in reports.REPORTS.items():
        assert report(fact.limit(0)).count() in (0, 1), name


def test_star_schema_is_closed(fact):
    tables = star.star_schema(fact)
    checks = star.verify_star(tables)
    assert checks.count() == 13 and failed(checks) == []
    assert tables["fact_sales"].count() == fact.count()
    assert [r["payment_key"] for r in tables["dim_payment"].orderBy("payment_type").collect()] == list(
        range(1, tables["dim_payment"].count() + 1)
    )
    credit = {r["payment_type"]: (r["payment_group"], r["payment_description"]) for r in tables["dim_payment"].collect()}
    assert credit["credit_card"] == ("Card", "Credit Card") and credit["unknown"] == ("Other", "Unknown")


def test_every_column_of_the_star_is_asked_for(fact):
    assert {"payment_count", "total_payment_value", "review_count", "estimated_delay_days"} <= star.required_columns()
    for c in sorted(star.required_columns()):
        with pytest.raises(ValueError, match=f"columns missing in the fact: {c}$"):
            star.star_schema(fact.drop(c))


def test_all_foreign_keys_take_one_exchange_of_keys(fact):
    plan = star.foreign_key_checks(star.star_schema(fact))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and plan.count("Aggregate [name") == 2  # keys, then names


def test_key_checks_compute_the_fact_once(fact, monkeypatch):
    written = []
    monkeypatch.setattr(star, "stage", lambda df, name: written.append((name, df.columns)) or stage(df, name))
    tables = star.key_tables(fact)
    assert written == [("star-keys", star.SOURCES)]
    for check in (star.primary_key_checks, star.foreign_key_checks):
        own = check(tables)
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, check(star.star_schema(fact)).collect()))
        # nothing but the staged copy is read
        assert not set(fact.inputFiles()) & set(own.inputFiles()) and own.inputFiles()
    twice = star.key_tables(fact.unionByName(fact.limit(3)))
    assert failed(star.primary_key_checks(twice)) == ["primary_key__fact_sales"]


def test_numbered_dimensions_share_one_scan(fact, monkeypatch):
    written = []
    monkeypatch.setattr(star, "stage", lambda df, name: written.append(name) or stage(df, name))
    tables = star.star_schema(fact)
    assert written == ["star-labels"]
    assert tables["dim_order_status"].count() == fact.select(F.coalesce("order_status", F.lit("unknown"))).distinct().count()


def test_star_checks_find_open_and_repeated_keys(fact):
    tables = star.star_schema(fact)
    broken = {**tables, "dim_seller": tables["dim_seller"].filter("seller_state = 'NATION_1'")}
    broken["dim_date"] = tables["dim_date"].unionByName(tables["dim_date"])
    with pytest.raises(ValueError, match="foreign_key__seller_key, primary_key__dim_date"):
        star.verify_star(broken)
    with pytest.raises(ValueError, match="generic headers"):
        star.verify_star({**tables, "dim_date": tables["dim_date"].withColumnRenamed("day", "Column1")})
    with pytest.raises(ValueError, match="columns missing"):
        star.normalise_for_bi(fact.drop("price"))


def test_profiles(spark):
    df = spark.createDataFrame(
        [("1", 1.0, True), ("2", 2.0, False), ("2", 2.0, False), (None, 4.0, True)], "order_id string, price double, is_late boolean"
    )
    out = pf.profile_tables({"t": df})
    assert out["duplicates"].first()["duplicate_rows"] == 2
    nulls = {r["column_name"]: r["null_count"] for r in out["nulls"].collect()}
    assert nulls == {"order_id": 1, "price": 0, "is_late": 0}
    kinds = {r["column_name"]: (r["semantic_type"], r["unique_count"]) for r in out["columns"].collect()}
    assert kinds == {"order_id": ("id", 2), "price": ("numeric", 3), "is_late": ("categorical", 2)}
    key = out["keys"].first()
    assert key["column_name"] == "order_id" and not key["is_possible_key"] and key["uniqueness_ratio"] == pytest.approx(2 / 3)


def test_statistics_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = 2 * x + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), 5.0) for a, b in zip(x, y)], "x double, y double, k double")
    z = (x - x.mean()) / x.std()
    jb = 200 / 6 * ((z**3).mean() ** 2 + ((z**4).mean() - 3) ** 2 / 4)
    got = {r["target"]: r for r in pf.jarque_bera(df).collect()}
    assert set(got) == {"x", "y"} and got["x"]["statistic"] == pytest.approx(jb, abs=1e-4)
    r = np.corrcoef(x, y)[0, 1]
    test = pf.pearson_significance(df).first()
    p = math.erfc(abs(0.5 * math.log((1 + r) / (1 - r)) * math.sqrt(197)) / math.sqrt(2))
    assert test["target"] == "x~y" and test["statistic"] == pytest.approx(r, abs=1e-4) and test["p_value"] == pytest.approx(p, abs=1e-6)
    matrix = {m["column_name"]: m for m in pf.correlation_matrix(df).collect()}
    assert matrix["y"]["x"] == pytest.approx(r) and matrix["k"]["x"] is None and matrix["k"]["k"] == 1.0
    described = {m["column_name"]: m for m in pf.describe(df).collect()}
    assert described["x"]["std"] == pytest.approx(x.std(ddof=1)) and described["x"]["50%"] == pytest.approx(np.median(x))
    assert pf.histogram(df, "x").agg(F.sum("n")).first()[0] == 200
    assert pf.histogram(df, "k").first().asDict() == {"bin": 1, "n": 200}


def test_outliers(spark):
    df = spark.createDataFrame([(v,) for v in (10.0, 12.0, 1000.0, 11.0, None)], "revenue double")
    row = pf.iqr_outliers(df).first()
    assert row["outlier_count"] == 1 and row["outlier_pct"] == 25.0


def test_features(spark):
    payload = '{"category": "case", "compatibility": ["a", "b"], "summary": "s"}'
    df = spark.createDataFrame([(1, "t", payload, "reference", "m"), (2, " ", "{}", "reference", "n")], "source_id int, title string, payload string, extraction_mode string, model_name string")
    flat = catalog.flatten_features(catalog.parse_features(df))
    row = flat.filter("source_id = 1").first()
    assert (row["category"], row["material"], row["compatibility"], row["quality_signals"]) == ("case", None, "a | b", "")
    kept = catalog.clean_feature_rows(flat, ["title", "category"])
    assert kept.count() == 1
    assert catalog.feature_summary(flat).first().asDict() == {
        "items": 2, "categories": 1, "extraction_mode": "reference", "model_name": "m",
    }
