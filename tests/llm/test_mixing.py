import random
import re

import duckdb
from helpers import RUN, documents, write
from pyspark.sql import functions as F

from tradeledger.llm import mixing, queries


def fill(sizes, cap=3):
    """Round by round: clamp, and share what is left."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), sum(sizes.values())
    while open_:
        left = budget - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] >= cap * sizes[s] - 1e-9}
        if not over:
            return target | share
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


def test_targets_equal_rounds_of_clamping(spark):
    rng = random.Random(2)
    for k in (1, 2, 5, 17):
        sizes = {None if i == 3 else f"s{i:02}": rng.choice((0, 1, 5, 50, 1000)) for i in range(k)}
        got = mixing.water_fill(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        wanted = fill(sizes)
        for r in got.collect():
            assert abs(r["target"] - wanted[r["source"]]) < 1e-6


def test_takes_come_near_the_targets_and_agree(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 60), "en", rng.choice(["a", "b", "b", "b", "c", "é", None]), 0) for i in range(600)]
    df = documents(spark, rows)
    first = mixing.mix(df, keep=["doc_id", "source"]).toPandas()
    again = mixing.mix(df.repartition(7), keep=["doc_id", "source"]).toPandas()
    key = ["doc_id"]
    assert first.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    assert (first.taken <= 3 * first["size"]).all() and (first.copies * first["size"] == first.taken).all()
    for _, part in first.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 60 and (part["size"].sum() == part.source_size).all()
    other = mixing.mix(df, seed=1, keep=["doc_id", "source"]).toPandas()
    assert (other.sort_values(key).taken.values != first.sort_values(key).taken.values).any()


def test_awkward_rows(spark):
    df = documents(spark, clashing=True)
    got = mixing.mix(df)
    assert got.columns.count("size") == 1 and got.columns.count("copies") == 1
    rows = got.collect()
    assert len(rows) == df.count() and {r["host"] for r in rows} == {"own host"}
    assert all(r["size"] == len(RUN.findall(r["text"] or "")) for r in rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(documents(spark, [])).count() == 0
    nothing = mixing.mix(documents(spark, [(1, None, "", "a", 0), (2, "", "", None, 0)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2


def test_repeated_rows_are_the_copies(spark):
    rows = [(i, "w " * (i % 7), "en", "abc"[i % 3], 0) for i in range(60)]
    mixed = mixing.mix(documents(spark, rows), keep=["doc_id"]).withColumn("time", F.lit("own"))
    copies = {r["doc_id"]: r["copies"] for r in mixed.collect() if r["copies"]}
    out = mixing.repeated(mixed)
    assert out.columns == mixed.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == copies


def test_rows_alike_are_taken_in_part(spark, tmp_path):
    """A thousand rows alike: the mix comes near the target, and the SQL agrees."""
    rows = [(7, "ten words " * 5, "en", "s1", 0)] * 1000 + [(i, "w " * 9000, "en", f"s{2 + i % 2}", 0) for i in (1, 2)] + [(3, "a b", "en", "s2", 0)] * 5
    docs = documents(spark, rows)
    got = mixing.mix(docs, keep=["doc_id", "source"]).toPandas()
    for _, part in got.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= part["size"].max() / 2 + 1e-6
    first = got[got.source == "s1"]
    assert 0 < (first.copies == first.copies.min()).sum() < 1000 and first.copies.max() == first.copies.min() + 1
    folder = write(spark, tmp_path, documents=docs)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = sorted(con.execute(queries.ORACLE["op8_mixing"]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["op8_mixing"](spark, folder).collect()) == want


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    df = documents(spark).withColumn("source", F.col("doc_id").cast("string"))
    rows = mixing.mix(df, keep=["doc_id"]).collect()
    assert len(rows) == df.count()


def test_no_window_holds_all_sources(spark):
    sizes = {f"host{i:04d}": (i * 7919) % 1000 for i in range(2000)} | {None: 5}
    got = mixing.water_fill(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    plan = got._jdf.queryExecution().analyzed().toString()
    # windows lie inside range partitions, or over one row for each of these
    assert not re.search(r"windowspecdefinition\((?!_part#|0, _part#)", plan)
    wanted = fill(sizes)
    targets = {r["source"]: r["target"] for r in got.collect()}
    assert set(targets) == set(sizes) and all(abs(targets[k] - wanted[k]) < 1e-6 for k in sizes)
