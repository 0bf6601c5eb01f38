"""Correlation of wide tables: exact co-moments by blocks, one pass for all pairs.

An aggregate with an expression a pair grows with the square of the columns in plan and code. Here
a task turns blocks of rows into matrix products. Values are cut to whole numbers of their column's
range (2^-42 of it), so every product and sum is exact: the result has the same digits on any
partitioning, in any order and after any retry. Rows where either of a pair is missing do not count.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradeledger.operators.profiling import numeric_names

#: Values are whole numbers of two halves of HALF bits; products of 2^BLOCK_BITS rows stay exact in doubles.
HALF, BLOCK_BITS = 21, 10
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


class _Exact:
    """Sums of matrices of whole numbers below 2^53, in two limbs."""

    def __init__(self, size: int) -> None:
        self.high, self.low = np.zeros((size, size), np.int64), np.zeros((size, size), np.int64)

    def add(self, m: np.ndarray) -> None:
        whole = m.astype(np.int64)
        self.high += whole >> 32
        self.low += whole & 0xFFFFFFFF

    def total(self) -> np.ndarray:
        return self.high.astype(object) * (1 << 32) + self.low.astype(object)


def _products(x: np.ndarray, middle: np.ndarray, reach: np.ndarray, sums: dict[str, _Exact]) -> None:
    """Adds the products of a block of rows to the sums."""
    present = np.isfinite(x)
    scale = np.where(reach > 0, reach, 1.0)
    whole = np.rint(np.where(present, (x - middle) / scale, 0.0) * 2.0 ** (2 * HALF))
    high = np.floor(whole / 2.0**HALF)
    low = whole - high * 2.0**HALF
    mask = present.astype(np.float64)
    for name, a, b in (
        ("n", mask, mask), ("h", high, mask), ("l", low, mask), ("hh", high * high, mask), ("hl", high * low, mask), ("ll", low * low, mask),
        ("xhh", high, high), ("xhl", high, low), ("xll", low, low),
    ):
        sums[name].add(a.T @ b)


def wide_correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Upper triangle of the correlation matrix as rows column_x, column_y, r, n.

    Null, NaN and infinite values are missing. r is null where a column is constant over the
    rows of a pair; n counts these rows.
    """
    names = columns or numeric_names(df)
    size, schema = len(names), T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), *[T.StructField(s, T.DecimalType(38, 0)) for s in SUMS]])
    arrow = to_arrow_schema(schema)
    values = df.select(*[F.col("`" + c.replace("`", "``") + "`").cast("double").alias(f"c{k}") for k, c in enumerate(names)])
    finite = [F.when(~F.isnan(f"c{k}") & (F.abs(F.col(f"c{k}")) < float("inf")), F.col(f"c{k}")) for k in range(size)]
    ends = values.agg(*[F.min(c) for c in finite], *[F.max(c) for c in finite]).first()  # two numbers a column
    low, high = (np.array([0.0 if v is None else v for v in part]) for part in (ends[:size], ends[size:]))
    middle, reach = low / 2 + high / 2, high / 2 - low / 2

    def run(batches):
        sums = {name: _Exact(size) for name in ("n", "h", "l", "hh", "hl", "ll", "xhh", "xhl", "xll")}
        step = 1 << BLOCK_BITS
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) if batch.num_rows else np.empty((0, size))
            for at in range(0, len(x), step):
                _products(x[at : at + step], middle, reach, sums)
        t = {name: s.total() for name, s in sums.items()}
        first = t["h"] * (1 << HALF) + t["l"]  # of the row's column, over rows that have both
        second = t["hh"] * (1 << 2 * HALF) + t["hl"] * (1 << HALF + 1) + t["ll"]
        cross = t["xhh"] * (1 << 2 * HALF) + (t["xhl"] + t["xhl"].T) * (1 << HALF) + t["xll"]
        i, j = np.triu_indices(size, 1)
        made = [i.tolist(), j.tolist()] + [
            [Decimal(int(v)) for v in m[a, b]]
            for m, a, b in ((t["n"], i, j), (first, i, j), (first, j, i), (second, i, j), (second, j, i), (cross, i, j))
        ]
        for at in range(0, len(i), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(v[at : at + 10_000], f.type) for v, f in zip(made, arrow)], schema=arrow)

    merged = values.mapInArrow(run, schema).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])
    out = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("r", T.DoubleType()), T.StructField("n", T.LongType())])
    out_arrow = to_arrow_schema(out)

    def finish(batches):
        for batch in batches:
            rs, ns = [], []
            for n, sx, sy, sxx, syy, sxy in zip(*(batch.column(s).to_pylist() for s in SUMS)):
                n, sx, sy, sxx, syy, sxy = map(int, (n, sx, sy, sxx, syy, sxy))
                dx, dy = n * sxx - sx * sx, n * syy - sy * sy
                rs.append(None if dx <= 0 or dy <= 0 else (n * sxy - sx * sy) / (math.sqrt(dx) * math.sqrt(dy)))
                ns.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("j"), pa.array(rs, pa.float64()), pa.array(ns, pa.int64())], schema=out_arrow)

    numbers = df.sparkSession.createDataFrame(list(enumerate(names)) or [(0, "")], "k int, name string")
    x, y = numbers.select(F.col("k").alias("_i"), F.col("name").alias("column_x")), numbers.select(F.col("k").alias("_j"), F.col("name").alias("column_y"))
    found = merged.mapInArrow(finish, out)
    return found.join(x, F.col("i") == F.col("_i")).join(y, F.col("j") == F.col("_j")).select("column_x", "column_y", "r", "n")
