"""Aggregate states kept by partition: a rerun reads only the partitions whose files have changed.

A table written by a partition column has states that merge (counts, sketches). They are stored
with a fingerprint of each partition's files: names, sizes and times, listed without reading
data. Refreshing computes the states of changed partitions, replaces them as a whole, and leaves out
those that are gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.functions.stable import count_where
from tradeledger.operators.checks import Check, evaluate_counts, row_checks
from tradeledger.operators.contracts import NUMERIC
from tradeledger.operators.profiling import column_counts, keys_from_counts

PART, PRINT = "state_part", "state_print"


def fingerprints(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """(state_part, state_print) of every partition of the table under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length", "modificationTime")
    part = F.url_decode(F.regexp_extract("path", f"/{partition}=([^/]*)/[^/]*$", 1))
    each = F.struct(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "length", F.unix_micros("modificationTime").alias("time"))
    listed = files.groupBy(part.alias(PART)).agg(F.array_sort(F.collect_list(each)).alias("_files"))
    return listed.select(PART, F.sha2(F.to_json("_files").cast("binary"), 256).alias(PRINT))


def refresh(
    spark: SparkSession, path: str, partition: str, store: str, build: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, list[str]]:
    """(current states, partitions that were read).

    ``build`` maps rows with a column ``state_part`` to states with that column. The states of a
    partition are replaced together, so a step that is stopped or run again leaves no rest.
    """
    now = fingerprints(spark, path, partition).collect()  # a row for a partition
    known = spark.createDataFrame(now, f"{PART} string, {PRINT} string")
    stored = _stored(spark, store)
    fresh = set() if stored is None else {tuple(r) for r in stored.select(PART, PRINT).distinct().collect()}
    changed = [r[PART] for r in now if (r[PART], r[PRINT]) not in fresh]
    if changed or stored is None:
        rows = spark.read.parquet(path)
        wanted = [None if p == "__HIVE_DEFAULT_PARTITION__" else p for p in changed]
        values = F.col(partition).isin([p for p in wanted if p is not None])
        rows = rows.filter(values | F.col(partition).isNull() if None in wanted else values)
        part = F.coalesce(F.col(partition).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        states = build(rows.withColumn(PART, part)).join(F.broadcast(known.withColumnRenamed(PART, "_p")), F.col(PART) == F.col("_p")).drop("_p")
        writer = states.withColumn("state_folder", F.col(PART)).write.partitionBy("state_folder").option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").parquet(store)
        stored = _stored(spark, store)
    if stored is None:
        raise ValueError(f"no partitions under {path}")
    same = (F.col(PART) == F.col("_p")) & (F.col(PRINT) == F.col("_f"))
    current = stored.join(F.broadcast(known.select(F.col(PART).alias("_p"), F.col(PRINT).alias("_f"))), same, "left_semi")
    return current.drop(PRINT), changed


def _stored(spark: SparkSession, store: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path) or not any(f.isDirectory() for f in system.listStatus(path)):
        return None
    return spark.read.parquet(store).drop("state_folder")


# ---- checks of rows --------------------------------------------------------


def check_states(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """Rows and offending rows of each partition, one aggregate."""
    counted = [count_where(c.bad_rows).alias(f"bad_{i}") for i, c in enumerate(checks) if c.bad_rows is not None]
    return rows.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"), *counted)


def incremental_row_checks(spark: SparkSession, path: str, partition: str, store: str, minimum: int) -> tuple[DataFrame, list[str]]:
    """(check rows of the fact, partitions that were read); the rows of `evaluate(fact, row_checks)`.

    The checks that compare rows with each other (grain, reconciliation) have no such states.
    """
    checks = row_checks(spark.read.parquet(path).columns, minimum)
    states, read = refresh(spark, path, partition, store, lambda rows: check_states(rows, checks))
    names = [c for c in states.columns if c != PART]
    merged = states.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in names])
    return evaluate_counts(merged, checks), read


# ---- sketches of columns ---------------------------------------------------

#: 2^14 registers: relative standard error of a distinct count.
DISTINCT_BITS = 14
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)
#: Rank error of a quantile at this size is below 0.5 %.
QUANTILE_SIZE, QUANTILE_ERROR = 800, 0.005
#: Values tracked for the most frequent ones; a value with more than 1 / (0.75 * tracked / 2) of the rows is never missed.
TRACKED, SHOWN = 1024, 5


def _number(f: T.StructField) -> bool:
    return isinstance(f.dataType, NUMERIC)


def _text(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def _name(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def column_states(rows: DataFrame) -> DataFrame:
    """(state_part, column_name, rows, nulls, distinct, quantiles, frequent) of every column from one pass.

    Only sketches of bounded size are shuffled, never cells.
    """
    fields = [f for f in rows.schema.fields if f.name != PART]
    made = [F.count(F.lit(1)).alias("rows")]
    parts = []
    for i, f in enumerate(fields):
        c = _name(f.name)
        key = F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else c
        made.append(F.count(c).alias(f"n{i}"))
        made.append(F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(key)), F.lit(DISTINCT_BITS)).alias(f"d{i}"))
        if _number(f):
            made.append(F.kll_sketch_agg_double(c.cast("double"), F.lit(QUANTILE_SIZE)).alias(f"q{i}"))
        if _text(f):
            made.append(F.expr(f"approx_top_k_accumulate(`{f.name.replace('`', '``')}`, {TRACKED})").alias(f"t{i}"))
        quantiles = F.col(f"q{i}") if _number(f) else F.lit(None).cast("binary")
        frequent = F.col(f"t{i}") if _text(f) else F.lit(None).cast("struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>")
        parts.append(
            F.struct(
                F.lit(f.name).alias("column_name"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct"),
                quantiles.alias("quantiles"), frequent.alias("frequent"),
            )
        )
    wide = rows.groupBy(PART).agg(*made)
    return wide.select(PART, "rows", F.inline(F.array(*parts)))


def merged_columns(states: DataFrame) -> DataFrame:
    """One row for a column from the states of all partitions."""
    merged = states.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("null_count"), F.hll_union_agg("distinct").alias("distinct"),
    )
    # columns without such a sketch take no part in its merge
    cuts = states.filter("quantiles is not null").groupBy(F.col("column_name").alias("_q")).agg(F.kll_merge_agg_double("quantiles").alias("quantiles"))
    top = states.filter("frequent is not null").groupBy(F.col("column_name").alias("_t")).agg(F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))
    return merged.join(cuts, F.col("column_name") == F.col("_q"), "left").join(top, F.col("column_name") == F.col("_t"), "left")


def sketch_profile(states: DataFrame) -> DataFrame:
    """column_name, rows, null_count, null_ratio, unique_count (estimate) with its standard error, quartiles and frequent values."""
    merged = merged_columns(states)
    points = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    cuts = F.when(F.col("_q").isNotNull() & (F.col("null_count") < F.col("rows")), F.kll_sketch_get_quantile_double("quantiles", points))
    top = F.when(F.col("_t").isNotNull(), F.expr(f"approx_top_k_estimate(frequent, {SHOWN})"))
    unique = F.least(F.hll_sketch_estimate("distinct"), F.col("rows") - F.col("null_count"))
    profile = merged.select("column_name", "rows", "null_count", F.coalesce(F.try_divide("null_count", "rows"), F.lit(0.0)).alias("null_ratio"),
                            unique.alias("unique_count"), F.lit(DISTINCT_ERROR).alias("unique_error"), cuts.alias("_cuts"), top.alias("frequent"))
    names = {f"q{25 * (i + 1)}": F.get("_cuts", F.lit(i)) for i in range(3)}
    return profile.select(*[c for c in profile.columns if c not in ("_cuts", "frequent")], *[c.alias(n) for n, c in names.items()], "frequent")


def sketched_keys(states: DataFrame, rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Candidate keys: the exact pass covers only columns without nulls whose estimate comes near the row count."""
    profile = sketch_profile(states)
    near = (F.col("null_count") == 0) & (F.col("rows") > 0) & (F.col("unique_count") >= F.col("rows") * (1 - 5 * DISTINCT_ERROR))
    likely = [r["column_name"] for r in profile.filter(near).select("column_name").collect()]  # at most a row a column
    likely = [c for c in rows.columns if c in likely and (columns is None or c in columns)]
    if not likely:
        return keys_from_counts(column_counts(rows.limit(0).select(*rows.columns[:1]))).limit(0)
    return keys_from_counts(column_counts(rows, likely)).filter("is_possible_key")


def profile_incrementally(spark: SparkSession, path: str, partition: str, store: str) -> tuple[DataFrame, list[str]]:
    """(sketch profile of the table, partitions that were read)."""
    states, read = refresh(spark, path, partition, store, column_states)
    return sketch_profile(states), read

