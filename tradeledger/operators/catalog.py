"""Asset and column catalogs, and flattening of extracted product features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.operators.profiling import column_counts, null_percentages

# File endings and the format they stand for.
FORMATS = {"csv": "csv", "parquet": "parquet", "png": "png", "sql": "sql", "md": "markdown", "json": "json"}


def file_format(path: str) -> str:
    ending = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    return FORMATS.get(ending, ending or "unknown")


def asset_catalog(assets: list[dict], frames: dict[str, DataFrame], counts: dict[str, int] | None = None) -> DataFrame:
    """One row per asset: zone, format, grain, key, row and column count, publishable.

    ``counts`` are row counts that are known already (`readers.footer_counts`); other frames are counted.
    """
    counts = counts or {}
    parts = []
    for a in assets:
        df = frames[a["asset_name"]]
        fixed = {
            "asset_name": a["asset_name"],
            "zone": a["zone"],
            "asset_type": a.get("asset_type", "dataset"),
            "file_format": file_format(a["path"]),
            "grain": a.get("grain", ""),
            "primary_key": a.get("primary_key", ""),
            "source_assets": a.get("source_assets", ""),
            "column_count": len(df.columns),
            "publication_ready": bool(a.get("publication_ready", False)),
        }
        if a["asset_name"] in counts:
            counted = df.sparkSession.range(1).select(F.lit(counts[a["asset_name"]]).cast("long").alias("record_count"))
        else:
            counted = df.agg(F.count(F.lit(1)).alias("record_count"))
        parts.append(counted.select(*[F.lit(v).alias(k) for k, v in fixed.items()], "record_count"))
    return reduce(DataFrame.unionByName, parts)


def zone_rollup(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("zone").agg(
        F.count(F.lit(1)).alias("assets"), F.count(F.when(F.col("publication_ready"), 1)).alias("publishable")
    )


def column_catalog(
    df: DataFrame, classification: DataFrame, search: str | None = None, classes: list[str] | None = None
) -> DataFrame:
    """Column profile joined to its classification, with the catalog search."""
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column_name string, dtype string"
    )
    counts = column_counts(df)
    distinct = F.col("unique_count") + F.when(F.col("null_count") > 0, 1).otherwise(0)
    out = (
        types.join(null_percentages(df).select("column_name", "null_pct"), "column_name", "left")
        .join(counts.select("column_name", distinct.alias("distinct_count")), "column_name", "left")
        .join(classification.drop("dtype"), "column_name", "left")
    )
    if search:
        out = out.filter(F.contains(F.lower("column_name"), F.lit(search.lower())))
    if classes:
        out = out.filter(F.col("lgpd_classification").isin(classes))
    return out


# ---- extracted features --------------------------------------------------

LIST_FEATURES = [
    "compatibility", "quality_signals", "functional_features", "security_features",
    "aesthetic_signals", "target_use_cases",
]
FEATURE_SCHEMA = (
    "category string, material string, summary string, "
    + ", ".join(f"{name} array<string>" for name in LIST_FEATURES)
)


def parse_features(df: DataFrame, payload: str = "payload") -> DataFrame:
    return df.withColumn("features", F.from_json(F.col(payload), FEATURE_SCHEMA)).drop(payload)


def flatten_features(df: DataFrame) -> DataFrame:
    """Nested features as one wide row; lists become pipe-joined text, an absent list the empty text."""
    lists = [F.coalesce(F.array_join(f"features.{n}", " | "), F.lit("")).alias(n) for n in LIST_FEATURES]
    rest = [c for c in df.columns if c != "features"]
    return df.select(
        *rest,
        F.col("features.category").alias("category"),
        F.col("features.material").alias("material"),
        *lists,
        F.col("features.summary").alias("summary"),
    )


def clean_feature_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Blank keys become null; rows without any key are dropped."""
    cleaned = df.withColumns({k: F.nullif(F.trim(F.col(k)), F.lit("")) for k in keys})
    return cleaned.dropna(how="all", subset=keys)


def feature_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct("source_id").alias("items"),
        F.countDistinct("category").alias("categories"),
        F.coalesce(F.mode("extraction_mode", deterministic=True), F.lit("unknown")).alias("extraction_mode"),
        F.coalesce(F.mode("model_name", deterministic=True), F.lit("unknown")).alias("model_name"),
    )
