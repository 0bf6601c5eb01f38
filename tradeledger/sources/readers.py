"""Scans: CSV with encoding fallback and line breaks in quotes, layered tables, parameterised SQL, raw inventory."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.operators.cleaning import with_snake_names
from tradeledger.sources import csv_scan


def date_columns(names: list[str]) -> list[str]:
    return [n for n in names if "date" in n.lower() or "timestamp" in n.lower()]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = True, sep: str = ","
) -> tuple[DataFrame, str, list[str]]:
    """(table, encoding, date columns). Date columns that hold unreadable text stay text.

    Quoted fields may hold line breaks; records that do not fit the header are left out (see
    `csv_scan.scan` for them). With a ``schema`` values that do not read as their type are null.
    """
    found = csv_scan.scan(spark, path, sep)
    df, encoding = found.rows, found.encoding
    if schema is not None:
        fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
        df = df.toDF(*[f.name for f in fields]).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
    elif infer:
        df = csv_scan.inferred(df)
    dates = date_columns(df.columns)
    texts = [c for c in dates if isinstance(df.schema[c].dataType, T.StringType)]
    if texts:
        unreadable = [
            F.count(F.when(F.col(c).isNotNull() & F.try_to_timestamp(F.col(c)).isNull(), 1)).alias(c) for c in texts
        ]
        bad = df.agg(*unreadable).first()
        if any(bad[c] for c in texts):
            return df, encoding, []
        df = df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in texts})
    return df, encoding, dates


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def missing_files(spark: SparkSession, folder: str, expected: list[str]) -> list[str]:
    return [name for name in expected if not _exists(spark, f"{folder}/{name}")]


def read_layered(spark: SparkSession, name: str, standardized: str, landing: str) -> DataFrame:
    """The standardised Parquet copy when there is one, else the landed CSV; snake_case names."""
    parquet = f"{standardized}/{name}.parquet"
    if _exists(spark, parquet):
        return with_snake_names(spark.read.parquet(parquet))
    return with_snake_names(read_csv(spark, f"{landing}/{name}.csv")[0])


def read_any(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path)[0]


def run_sql(spark: SparkSession, statement: str, parameters: dict | None = None, **views: DataFrame) -> DataFrame:
    """Parameterised statement over named frames; `:name` markers are bound, never pasted in."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(statement, args=parameters or {})


def inventory(tables: dict[str, DataFrame], encodings: dict[str, str] | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """Rows, columns, types, date columns and encoding per table; rows of ``counts`` are known without a scan."""
    encodings, counts = encodings or {}, counts or {}
    parts = []
    for name, df in tables.items():
        types = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in df.schema.fields)
        one = df.sparkSession.range(1)
        rows = one.select(F.lit(counts[name]).cast("long").alias("rows")) if name in counts else df.agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            rows.select(
                F.lit(name).alias("table_name"),
                "rows",
                F.lit(len(df.columns)).alias("columns_count"),
                F.lit(types).alias("dtypes"),
                F.lit(", ".join(date_columns(df.columns))).alias("date_columns"),
                F.lit(encodings.get(name, "")).alias("encoding"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@contextmanager
def _settings(spark: SparkSession, **values: str):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_plan(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a Parquet table as a pushed aggregate; to be run inside `from_footers`."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


@contextmanager
def from_footers(spark: SparkSession):
    """Counts of Parquet files come from their footers: the scan returns one row a file and no data page is read."""
    sources = "avro,csv,json,kafka,orc,text"  # Parquet through its newer source
    with _settings(spark, spark__sql__sources__useV1SourceList=sources, spark__sql__parquet__aggregatePushdown="true"):
        yield


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    """Rows of each Parquet table, one small job a table, a few at a time."""
    with from_footers(spark), ThreadPoolExecutor(6) as pool:
        jobs = {name: pool.submit(lambda p=p: footer_plan(spark, p).first()["rows"]) for name, p in paths.items()}
        return {name: job.result() for name, job in jobs.items()}
