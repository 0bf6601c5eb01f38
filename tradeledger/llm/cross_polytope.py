"""Nearest neighbours by cross-polytope hashing with calibrated multiprobe tables.

A table turns unit vectors by fast Hadamard pseudo-rotations and assigns each to the nearest
signed axis, on several levels; the axes are its bucket. A query loses (largest coordinate - coordinate
of the axis) squared on each level, and probes every bucket whose loss is at most a threshold.
That threshold is calibrated: a bounded sample of the queries is held against all rows,
and the loss at which the wanted share of their true neighbours is collected is the threshold.
Candidates are ranked by their exact distance.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from tradeledger.llm.common import col
from tradeledger.operators.ordered import top_n
from tradeledger.session import stage

TABLES = 4
SEED = 42
#: Queries that the threshold is calibrated on, and the share of their neighbours to be collected.
SAMPLE, RECALL = 128, 0.96
#: Rows of a shard (buckets with the same first axes) that one task searches at once.
SHARD_ROWS = 8192
#: At most so many shards are split further; their list is broadcast.
SPLIT_SHARDS = 50_000
QUERY_BLOCK = 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, orthonormal; the width is a power of two."""
    x, h = x.copy(), 1
    n, d = x.shape
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tables:
    """Hash tables for vectors of one length: ``levels`` signed axes each."""

    def __init__(self, dim: int, rows: int, tables: int = TABLES, seed: int = SEED, shard_rows: int = SHARD_ROWS) -> None:
        self.dim, self.tables, self.size = dim, tables, 1 << max(0, dim - 1).bit_length()
        self.axes = 2 * self.size
        most = 60 // self.axes.bit_length()
        # finer buckets tell neighbours better apart; more levels as the rows grow
        self.levels = 2
        while self.axes**self.levels < rows / 4 and self.levels < most:
            self.levels += 1
        self.depth = 1  # levels that name a shard
        while rows > shard_rows * self.axes**self.depth and self.depth < self.levels:
            self.depth += 1
        self.rest = self.axes ** (self.levels - self.depth)
        self.signs = np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, self.levels, 3, self.size))

    def coordinates(self, units: np.ndarray, table: int, level: int) -> np.ndarray:
        """Coordinates on all signed axes after three rounds of signs and transform."""
        x = np.zeros((len(units), self.size))
        x[:, : self.dim] = units
        for signs in self.signs[table, level]:
            x = hadamard(x * signs)
        return np.concatenate([x, -x], axis=1)

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """Bucket number in each table, first level highest."""
        made = np.zeros((len(units), self.tables), np.int64)
        for t in range(self.tables):
            for level in range(self.levels):
                made[:, t] = made[:, t] * self.axes + self.coordinates(units, t, level).argmax(axis=1)
        return made

    def losses(self, units: np.ndarray, table: int) -> list[np.ndarray]:
        """For each level what every axis loses against the nearest one."""
        made = []
        for level in range(self.levels):
            x = self.coordinates(units, table, level)
            made.append((x.max(axis=1, keepdims=True) - x) ** 2)
        return made

    def loss(self, losses: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
        """Loss of every bucket (columns) for every query (rows)."""
        total, at = 0.0, buckets
        for own in reversed(losses):
            total = total + own[:, at % self.axes]
            at = at // self.axes
        return total

    def probed(self, losses: list[np.ndarray], query: int, threshold: float) -> np.ndarray:
        """First axes of all buckets within the threshold."""
        prefix, loss = np.zeros(1, np.int64), np.zeros(1)
        for own in losses[: self.depth]:
            total = loss[:, None] + own[query][None, :]
            i, axis = np.nonzero(total <= threshold)
            prefix, loss = prefix[i] * self.axes + axis, total[i, axis]
        return prefix

    def shard(self, table, bucket):
        return table * self.axes**self.depth + bucket // self.rest


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec, dim, key) of the rows that take part; the key is a digest of the vector.

    Vectors that are null, zero or empty, or hold a null or a non-finite number, take no part.
    """
    kind = rows.schema[vector].dataType.elementType
    exact = kind if isinstance(kind, (T.FloatType, T.DoubleType)) else T.DoubleType()
    given = rows.select(col(vec_id).cast("long").alias("vec_id"), col(vector).cast(T.ArrayType(exact)).alias("vec"))
    schema = T.StructType([*given.schema.fields, T.StructField("dim", T.IntegerType()), T.StructField("key", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            ids, vectors, dims, keys = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not v.is_valid or v.values.null_count or not len(v):
                    continue
                x = v.values.to_numpy(zero_copy_only=False) + 0.0  # one zero
                if not np.isfinite(x).all() or not x.any():
                    continue
                ids.append(i)
                vectors.append(x)
                dims.append(len(x))
                keys.append(hashlib.md5(x.tobytes()).digest())
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((ids, vectors, dims, keys), arrow)], schema=arrow)

    return given.mapInArrow(run, schema)


def sqrt_distances(q: np.ndarray, c: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances of the pairs (at, to), in blocks of bounded memory."""
    made = np.empty(len(at))
    step = max(1, (1 << 22) // max(1, q.shape[1]))
    for i in range(0, len(at), step):
        made[i : i + step] = np.sqrt(((q[at[i : i + step]] - c[to[i : i + step]]) ** 2).sum(axis=1))
    return made


def nearest(q: np.ndarray, c: np.ndarray, least: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, distance) of the ``k`` nearest allowed candidates of each query, ties to the smaller ``least``.

    A matrix product chooses, with a margin for its rounding; the exact distance decides.
    """
    qq, cc = (q * q).sum(axis=1), (c * c).sum(axis=1)
    d = qq[:, None] + cc[None, :] - 2 * (q @ c.T)
    d[np.isnan(d)] = np.inf  # beyond the double range
    if allowed is not None:
        d[~allowed] = np.inf
    if c.shape[0] > k:
        bound = np.partition(d, k - 1, axis=1)[:, k - 1]
    else:
        bound = np.full(len(q), np.inf)
    margin = 1e-9 * (qq + cc.max(initial=0.0))
    chosen = d <= (bound + margin)[:, None]
    if allowed is not None:
        chosen &= allowed
    at, to = np.nonzero(chosen)
    score = sqrt_distances(q, c, at, to)
    order = np.lexsort((least[to], score, at))
    at, to, score = at[order], to[order], score[order]
    first = np.searchsorted(at, np.arange(len(q)))
    near = np.arange(len(at)) - first[at] < k
    return at[near], to[near], score[near]


LAST = np.iinfo(np.int64).max


def least_ids(column: pa.Array) -> np.ndarray:
    """Smallest id of each candidate, null last."""
    return np.array([LAST if ids[0]["vec_id"] is None else ids[0]["vec_id"] for ids in column.to_pylist()], np.int64)


def calibrated(index: DataFrame, queries: DataFrame, tables: Tables, k: int, sample: int, recall: float) -> float:
    """Threshold that collects ``recall`` of the true neighbours of at most ``sample`` queries, the first by digest."""
    chosen = queries.orderBy("key").limit(sample).collect()
    if not chosen:
        return 0.0
    q = np.array([r["vec"] for r in chosen], np.float64)
    dim, one = tables.dim, index.schema["vec"].dataType
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("vec", one), T.StructField("n", T.IntegerType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        held, weight = np.empty((0, dim)), np.empty(0, np.int64)
        at, score, to = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        for batch in batches:
            c = matrix(batch.column(0), dim)
            n = np.array([len(x) for x in batch.column(1).to_pylist()])
            for i in range(0, len(c), 4096):
                own = c[i : i + 4096]
                a, t, s = nearest(q, own, np.zeros(len(own), np.int64), k + 1)
                # the best so far and the new ones
                at, score, to = np.concatenate([at, a]), np.concatenate([score, s]), np.concatenate([to, t + len(held)])
                held, weight = np.concatenate([held, own]), np.concatenate([weight, n[i : i + 4096]])
                order = np.lexsort((score, at))
                at, score, to = at[order], score[order], to[order]
                near = np.arange(len(at)) - np.searchsorted(at, np.arange(len(q)))[at] < k + 1
                at, score, to = at[near], score[near], to[near]
                used, to = np.unique(to, return_inverse=True)
                held, weight = held[used], weight[used]
        values = [at, score, list(held[to]), weight[to]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)

    found = top_n(index.select("vec", "ids").mapInArrow(run, schema), ["q"], [F.col("score")], k + 1)
    rows = found.orderBy("q", "score").collect()
    if not rows:
        return 0.0
    # neighbours are rows: a vector counts as often as it has ids, the query's own row once less
    left, picked = {}, []
    for r in rows:
        own = left.setdefault(r["q"], k)
        take = min(own, r["n"] - (r["score"] == 0.0))
        left[r["q"]] -= max(0, take)
        picked += [r] * max(0, take)
    if not picked:
        return 0.0
    near = unit(np.array([r["vec"] for r in picked], np.float64))
    of = np.array([r["q"] for r in picked])
    loss = np.full(len(picked), np.inf)
    buckets, units = tables.buckets(near), unit(q)
    for t in range(tables.tables):
        all_losses = tables.losses(units, t)
        total = np.zeros(len(picked))
        at = buckets[:, t]
        for own in reversed(all_losses):
            total += own[of, at % tables.axes]
            at = at // tables.axes
        loss = np.minimum(loss, total)
    # a little more than the loss itself, for another order of additions
    return float(np.quantile(loss, recall, method="higher") * (1 + 1e-9) + 1e-12)


def search(index: DataFrame, queries: DataFrame, tables: Tables, threshold: float, k: int) -> DataFrame:
    """(key, ckey, ids, score): the ``k`` nearest probed candidates of every query, one row each."""
    shape = tables.axes**tables.depth
    place = F.posexplode("buckets").alias("_t", "bucket")
    shard = (F.col("_t").cast("long") * shape + F.expr(f"bucket div {tables.rest}")).alias("shard")
    candidates = index.select("key", "vec", "ids", place).select(shard, "bucket", "key", "vec", "ids")
    # a shard over the limit is split by the candidates' digests; at most SPLIT_SHARDS of them
    total = index.count() * tables.tables
    limit = max(2 * SHARD_ROWS, total // SPLIT_SHARDS + 1)
    sizes = candidates.groupBy("shard").count().filter(F.col("count") > limit)
    split = sizes.select(F.col("shard").alias("_s"), F.ceil(F.col("count") / limit).cast("int").alias("_n"))
    split = F.broadcast(stage(split, "split-shards"))
    n = F.coalesce("_n", F.lit(1))
    candidates = candidates.join(split, F.col("shard") == F.col("_s"), "left").withColumn("salt", F.pmod(F.xxhash64("key"), n).cast("int"))

    probe_type = T.StructType([T.StructField("shard", T.LongType()), T.StructField("key", T.BinaryType()), queries.schema["vec"]])
    probe_arrow = to_arrow_schema(probe_type)
    dim = tables.dim

    def probes(batches):
        for batch in batches:
            units = unit(matrix(batch.column(1), dim)) if batch.num_rows else np.empty((0, dim))
            for t in range(tables.tables):
                losses = tables.losses(units, t)
                for i in range(0, len(units), 16):
                    own = [tables.probed(losses, j, threshold) + t * shape for j in range(i, min(i + 16, len(units)))]
                    at = np.repeat(np.arange(i, i + len(own)), [len(x) for x in own])
                    took = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own), pa.int64()), took.column(0), took.column(1)], schema=probe_arrow)

    asked = queries.select("key", "vec").mapInArrow(probes, probe_type)
    asked = asked.join(split, F.col("shard") == F.col("_s"), "left").withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1)))
    nothing = F.lit(None)
    both = candidates.select("shard", "salt", F.lit(0).alias("side"), "bucket", "key", "vec", "ids").unionByName(
        asked.select("shard", "salt", F.lit(1).alias("side"), nothing.cast("long").alias("bucket"), "key", "vec", nothing.cast(index.schema["ids"].dataType).alias("ids"))
    )
    # candidates of a shard come first and are held (a bounded number); its queries follow as a stream
    dealt = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "side")
    schema = T.StructType(
        [T.StructField("key", T.BinaryType()), T.StructField("ckey", T.BinaryType()), index.schema["ids"], T.StructField("score", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        now, held, ready = None, [], None
        for batch in batches:
            shards, salts, sides = (batch.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((np.diff(shards) != 0) | (np.diff(salts) != 0) | (np.diff(sides) != 0)) + 1
            edges = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if (shards[a], salts[a]) != now:
                    now, held, ready = (shards[a], salts[a]), [], None
                part = batch.slice(a, b - a)
                if sides[a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if ready is None:
                    own = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    buckets, inverse = np.unique(own.column("bucket").to_numpy(), return_inverse=True)
                    ready = (own, matrix(own.column("vec"), dim), least_ids(own.column("ids")), buckets, inverse)
                own, c, least, buckets, inverse = ready
                for i in range(0, part.num_rows, QUERY_BLOCK):
                    some = part.slice(i, QUERY_BLOCK)
                    q = matrix(some.column("vec"), dim)
                    within = tables.loss(tables.losses(unit(q), int(now[0] // shape)), buckets) <= threshold
                    at, to, score = nearest(q, c, least, k, within[:, inverse])
                    took = own.take(pa.array(to))
                    columns = [some.column("key").take(pa.array(at)), took.column("key"), took.column("ids"), pa.array(score)]
                    yield pa.RecordBatch.from_arrays([x.cast(f.type) if x.type != f.type else x for x, f in zip(columns, arrow)], schema=arrow)

    found = dealt.mapInArrow(run, schema)
    # the same candidate comes from each table at most; every task cuts its own lists first
    order = [F.col("score"), F.col("ids")[0]["vec_id"].asc_nulls_last(), F.col("ckey")]
    several = top_n(found, ["key"], order, k * tables.tables)
    return top_n(several.dropDuplicates(["key", "ckey"]), ["key"], order, k)


def neighbours(
    rows: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row for which ``is_query`` (of the id) holds.

    score is the Euclidean distance in double precision, ties go to the smaller vec_id (null last).
    Rows alike in id and vector count once; an id with several vectors is several rows. Vectors of
    another length than the query's are no candidates. Vectors that are null, empty, zero or not
    finite take no part. A query that has ``k`` candidates always gets ``k`` rows; where the probes
    find fewer, it is searched in all buckets. Distances beyond the double range are infinite.
    """
    own = stage(usable(rows, vec_id, vector), "vectors")
    made = None
    for r in own.select("dim").distinct().orderBy("dim").collect():  # one index for each length in use
        found = one_length(own.filter(F.col("dim") == r["dim"]), is_query, r["dim"], k, sample, recall)
        made = found if made is None else made.unionByName(found)
    if made is None:
        return own.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return made


def one_length(own: DataFrame, is_query, dim: int, k: int, sample: int, recall: float) -> DataFrame:
    ids = own.select("key", "vec_id").distinct()
    # equal vectors are one candidate with as many ids as can matter
    few = top_n(ids, ["key"], [F.col("vec_id").asc_nulls_last()], k + 1)
    few = few.groupBy("key").agg(F.collect_list(F.struct("vec_id")).alias("ids"))
    ordered = F.array_sort("ids", lambda a, b: F.when(a["vec_id"].eqNullSafe(b["vec_id"]), 0)
                           .when(a["vec_id"].isNull() | (a["vec_id"] > b["vec_id"]), 1).when(b["vec_id"].isNull(), -1).otherwise(-1))
    vectors = own.groupBy("key").agg(F.first("vec").alias("vec"))
    distinct = stage(vectors.join(few.select("key", ordered.alias("ids")), "key"), "distinct-vectors")
    tables = Tables(dim, distinct.count())
    schema = T.StructType([*distinct.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def hashed(batches):
        at = schema.fieldNames().index("vec")
        for batch in batches:
            buckets = tables.buckets(unit(matrix(batch.column(at), dim))) if batch.num_rows else np.empty((0, tables.tables), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(buckets), arrow.field("buckets").type)], schema=arrow)

    index = stage(distinct.mapInArrow(hashed, schema), "hashed-vectors")
    asking = stage(ids.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), F.col("key").alias("qkey")), "queries")
    queries = stage(index.join(asking.select(F.col("qkey").alias("key")).distinct(), "key", "left_semi").select("key", "vec"), "query-vectors")
    threshold = calibrated(index, queries, tables, k, sample, recall)
    found = stage(search(index, queries, tables, threshold, k + 1), "found")

    n_rows = min(ids.count(), k + 1)
    enough = found.groupBy("key").agg(F.sum(F.size("ids")).alias("_found")).filter(F.col("_found") >= n_rows)
    short = stage(queries.join(enough.select("key"), "key", "left_anti"), "short-queries")
    if not short.isEmpty():
        more = search(index, short, tables, float("inf"), k + 1)
        found = found.join(short.select("key"), "key", "left_anti").unionByName(more)

    each = found.select("key", "ckey", "score", F.explode("ids").alias("_id")).select("key", "ckey", "score", F.col("_id.vec_id").alias("vec_id"))
    answers = asking.join(each, F.col("qkey") == F.col("key")).filter(~((F.col("ckey") == F.col("qkey")) & F.col("vec_id").eqNullSafe(F.col("query_id"))))
    window = W.partitionBy("query_id", "qkey").orderBy("score", F.col("vec_id").asc_nulls_last(), "ckey")
    ranked = answers.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
