"""Sinks. All writes are distributed folder writes; small result sets may ask for one file."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Redistributes a table that arrived in fewer splits than there are cores (one large file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_dual(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """The same rows as `<path>.parquet` and `<path>.csv`, computed once."""
    write_parquet(df, f"{path}.parquet", partition_by)
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}.parquet").select(*df.columns)
    stored.write.mode("overwrite").option("header", True).csv(f"{path}.csv")


def write_bi_csv(df: DataFrame, path: str) -> None:
    """`;` separated CSV with a byte-order mark in front of the header of every part."""
    first, *rest = df.columns
    marked = df.withColumnRenamed(first, "\ufeff" + first).select("\ufeff" + first, *rest)
    marked.write.mode("overwrite").option("header", True).option("sep", ";").option("encoding", "UTF-8").csv(path)


def write_summary_json(checks: DataFrame, path: str, generated_at: str, array: str = "checks") -> None:
    """One JSON document: totals and the array of check rows (bounded by the declared checks)."""
    ordered = F.sort_array(F.collect_list(F.struct(*checks.columns)))
    doc = checks.agg(
        F.lit(generated_at).alias("generated_at_utc"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count(F.when(F.col("status") == "FAIL", 1)).alias("failed_checks"),
        ordered.alias(array),
    )
    doc.coalesce(1).write.mode("overwrite").json(path)


def write_group_documents(checks: DataFrame, path: str, by: list[str], generated_at: str, array: str = "checks") -> DataFrame:
    """One JSON document for each group of checks, and a manifest; returns the manifest.

    A document holds the declared checks of its group and no more. Documents are written sorted by
    range, so no task holds more than its share of the groups; the manifest has a row a file with its
    first and last group and the totals, and tells where a group's document is.
    """
    rest = [c for c in checks.columns if c not in by]
    totals = (F.count(F.lit(1)).alias("total_checks"), F.count(F.when(F.col("status") == "FAIL", 1)).alias("failed_checks"))
    documents = checks.groupBy(*by).agg(*totals, F.sort_array(F.collect_list(F.struct(*rest))).alias(array))
    documents = documents.select(F.lit(generated_at).alias("generated_at_utc"), *by, "total_checks", "failed_checks", array)
    documents.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").json(f"{path}/documents")
    spark = checks.sparkSession
    written = spark.read.schema(documents.schema).json(f"{path}/documents").select("*", F.col("_metadata.file_name").alias("file_name"))
    key = F.struct(*by)
    manifest = written.groupBy("file_name").agg(
        F.min(key).alias("first_group"), F.max(key).alias("last_group"), F.count(F.lit(1)).alias("documents"),
        F.sum("total_checks").alias("total_checks"), F.sum("failed_checks").alias("failed_checks"),
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest")


def write_scorecards_json(metrics: DataFrame, scorecards: DataFrame, path: str, generated_at: str) -> None:
    """Metrics and dataset scorecards in one document."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))

    cards = rows(scorecards, "dataset_scorecards").select("dataset_scorecards").scalar()
    doc = rows(metrics, "metrics").select(
        F.lit(generated_at).alias("generated_at_utc"), "metrics", cards.alias("dataset_scorecards")
    )
    doc.coalesce(1).write.mode("overwrite").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON record per line, nested values kept."""
    df.write.mode("overwrite").json(path)


RUN, ATTEMPT, COMMITS = "log_run", "log_attempt", "_commits"


def append_log(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Adds the rows of one run to a log table, exactly once.

    Every attempt writes to a folder of its own; then one atomic rename makes it the run's attempt.
    A step that is run again, or stopped before that rename, leaves one set of rows for its
    run. Without ``run_id`` each call is a run.
    """
    run, attempt = run_id or uuid4().hex, uuid4().hex
    if not re.fullmatch(r"[\w.: +-]+", run):
        raise ValueError(f"a run is named by letters, digits, blanks and .:_+-, not {run!r}")
    df.write.parquet(f"{path}/{RUN}={_escaped(run)}/{ATTEMPT}={attempt}")
    _commit(df.sparkSession, path, run, attempt)


def _escaped(name: str) -> str:
    return name.replace(":", "%3A")


def _commit(spark: SparkSession, path: str, run: str, attempt: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    mark, draft = fs.Path(f"{path}/{COMMITS}/{_escaped(run)}"), fs.Path(f"{path}/{COMMITS}/.{attempt}")
    system = draft.getFileSystem(conf)
    out = system.create(draft)
    out.write(bytearray(f"{run}\t{attempt}\n".encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(system.getUri(), conf).rename(system.makeQualified(draft), system.makeQualified(mark), overwrite)


def read_log(spark: SparkSession, path: str, with_run: bool = False) -> DataFrame:
    """The rows of every committed run (``with_run``: and its name); columns added later are null in older rows."""
    marks = spark.read.text(f"{path}/{COMMITS}").select(F.split("value", "\t").alias("m"))
    marks = marks.select(F.col("m")[0].alias("_run"), F.col("m")[1].alias("_attempt"))
    rows = spark.read.option("mergeSchema", True).schema(_log_schema(spark, path)).parquet(path)
    committed = rows.join(marks, (F.col(RUN) == F.col("_run")) & (F.col(ATTEMPT) == F.col("_attempt")))
    kept = [c for c in rows.columns if c not in (RUN, ATTEMPT)]
    return committed.select(*kept, *([RUN] if with_run else []))


def _log_schema(spark: SparkSession, path: str) -> T.StructType:
    """The merged schema; names of runs stay text also where they look like numbers or dates."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in (RUN, ATTEMPT) else f.dataType) for f in found.fields])
