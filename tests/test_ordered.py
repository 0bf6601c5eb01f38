"""Global order operators against brute force, with one group holding a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeledger.operators import ordered as od
from tradeledger.operators.cohorts import purchase_sequence


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 900
    key = np.where(np.arange(n) % 3 == 0, "hot", np.char.add("k", rng.integers(0, 40, n).astype(str)))
    frame = pd.DataFrame({"id": np.arange(n), "key": key, "v": rng.integers(0, 60, n).astype(float), "w": rng.integers(1, 9, n)})
    return frame, spark.createDataFrame(frame).repartition(6)


def test_running_total_per_group(skewed):
    frame, df = skewed
    got = od.running_total(df, ["v", "id"], "w", "total", ["key"]).toPandas().set_index("id")["total"].sort_index()
    expected = frame.sort_values(["key", "v", "id"]).groupby("key")["w"].cumsum().sort_index()
    assert got.tolist() == expected.tolist()


def test_running_total_over_everything_descending(skewed):
    frame, df = skewed
    got = od.running_total(df, [F.desc("v"), "id"], "w", "total").toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert got["total"].tolist() == frame.sort_values(["v", "id"], ascending=[False, True])["w"].cumsum().tolist()


def test_quantiles_match_linear_interpolation(skewed):
    frame, df = skewed
    got = od.quantiles(df, ["key"], "v", {"q1": 0.25, "q2": 0.5, "q3": 0.9}).toPandas().set_index("key").sort_index()
    expected = frame.groupby("key")["v"].quantile([0.25, 0.5, 0.9]).unstack().sort_index()
    assert got["n"].tolist() == frame.groupby("key").size().sort_index().tolist()
    np.testing.assert_allclose(got[["q1", "q2", "q3"]].to_numpy(), expected.to_numpy())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float)), min_size=1, max_size=30))
def test_quantiles_property(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = od.quantiles(df, ["g"], "v", {"q": 0.37}).collect()
    present = [v for v in values if v is not None]
    if not present:
        assert got == []
    else:
        assert got[0]["q"] == pytest.approx(np.quantile(present, 0.37))


def test_surrogate_keys_are_dense_and_sorted(skewed):
    frame, df = skewed
    got = od.surrogate_keys(df, "key", "k").toPandas().sort_values("k")
    assert got["key"].tolist() == sorted(frame["key"].unique())
    assert got["k"].tolist() == list(range(1, frame["key"].nunique() + 1))


def test_top_n_latest_and_delta(skewed, rows):
    frame, df = skewed
    top = od.top_n(df, ["key"], [F.desc("v"), F.asc("id")], 2)
    expected = frame.sort_values(["v", "id"], ascending=[False, True]).groupby("key").head(2)
    assert sorted(r["id"] for r in rows(top)) == sorted(expected["id"])
    newest = {r["key"]: r["id"] for r in rows(od.latest(df, "id", ["key"]))}
    assert newest == frame.groupby("key")["id"].max().to_dict()
    delta = {r["key"]: r["delta"] for r in rows(od.latest_two(df, "id", "v", ["key"]))}
    hot = frame[frame["key"] == "hot"].sort_values("id")["v"].tolist()
    assert delta["hot"] == hot[-1] - hot[-2]


def test_purchase_sequence_is_the_dense_rank_with_an_unknown_customer_group(spark):
    rng = np.random.default_rng(3)
    n = 600
    frame = pd.DataFrame(
        {
            "order_id": np.arange(n),
            "customer_unique_id": [None if i % 3 == 0 else int(rng.integers(0, 20)) for i in range(n)],
            "ts": pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 400, n) * 6, unit="h"),
        }
    )
    df = spark.createDataFrame(
        [(int(a), None if pd.isna(b) else int(b), c.to_pydatetime()) for a, b, c in frame.itertuples(index=False)],
        "order_id long, customer_unique_id long, order_purchase_timestamp timestamp_ntz",
    )
    got = {
        (r["customer_group"]["customer_unique_id"], r["order_purchase_timestamp"]): r["customer_order_sequence"]
        for r in purchase_sequence(df).collect()
    }
    frame["rank"] = frame.groupby("customer_unique_id", dropna=False)["ts"].rank(method="dense")
    expected = {
        (None if pd.isna(c) else int(c), t.to_pydatetime()): int(r)
        for c, t, r in frame[["customer_unique_id", "ts", "rank"]].itertuples(index=False)
    }
    assert got == expected
