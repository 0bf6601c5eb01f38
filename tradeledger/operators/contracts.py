"""Schema contracts: columns and types from metadata, rows and keys from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)
STAMPS = (T.TimestampType, T.TimestampNTZType)
CONTRACT_TYPES = {
    "string": (T.StringType,),
    "integer": INTEGRAL,
    "float": NUMERIC,
    "numeric": NUMERIC,
    "boolean": (T.BooleanType,),
    "datetime": STAMPS,
    "timestamp": STAMPS,
    "date": (T.DateType,),
    "date_like": (T.DateType, *STAMPS),
}


def type_matches(actual: T.DataType, word: str) -> bool:
    if word not in CONTRACT_TYPES:
        raise ValueError(f"unknown contract type: {word}")
    return isinstance(actual, CONTRACT_TYPES[word])


def _names(names: list[str]) -> str:
    return str(names) if names else "nenhuma"


def _metadata_rows(df: DataFrame, contract: dict) -> list[tuple[str, str, str]]:
    expected: dict[str, str] = contract["columns"]
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(set(expected) - set(actual))
    rows = [("missing_columns", "FAIL" if missing else "PASS", f"Ausentes: {_names(missing)}")]
    if not contract.get("allow_unexpected_columns", False):
        extra = sorted(set(actual) - set(expected))
        rows.append(("unexpected_columns", "FAIL" if extra else "PASS", f"Inesperadas: {_names(extra)}"))
    for name, word in expected.items():
        if name in actual:
            ok = type_matches(actual[name], word)
            details = f"Esperado={word} | atual={actual[name].simpleString()}"
            rows.append((f"type__{name}", "PASS" if ok else "FAIL", details))
    return rows


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: total rows and rows that share their key with another row (all members counted)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
    )


def validate_contract(df: DataFrame, contract: dict) -> DataFrame:
    """Checks of one contract: dataset_name, layer, check_name, status, details."""
    spark = df.sparkSession
    names = (F.lit(contract["dataset_name"]).alias("dataset_name"), F.lit(contract["layer"]).alias("layer"))
    schema = "check_name string, status string, details string"
    metadata = spark.createDataFrame(_metadata_rows(df, contract), schema)
    key = list(contract.get("primary_key", []))
    minimum = int(contract.get("min_rows", 0))
    if key:
        sizes = duplicate_members(df, key)
    else:
        sizes = df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(0).cast("long").alias("duplicate_rows"))

    def row(name, ok, details):
        return F.struct(
            F.lit(name).alias("check_name"), F.when(ok, "PASS").otherwise("FAIL").alias("status"), details.alias("details")
        )

    data = [
        row(
            "min_rows",
            F.col("total_rows") >= minimum,
            F.format_string(f"Linhas observadas=%d | minimo={minimum}", F.col("total_rows")),
        )
    ]
    if key:
        data.append(
            row(
                "primary_key_duplicates",
                F.col("duplicate_rows") == 0,
                F.format_string(f"Chave={key} | duplicados=%d", F.col("duplicate_rows")),
            )
        )
    checks = metadata.unionByName(sizes.select(F.inline(F.array(*data))))
    return checks.select(*names, "check_name", "status", "details")


def expected_and_actual(checks: DataFrame) -> DataFrame:
    """Type checks with the expected and the actual type read back from their details."""
    pattern = r"Esperado=([^|]+)\|\s*atual=(.+)"
    found = checks.filter(F.regexp_like("details", F.lit(pattern)))
    return found.withColumns(
        {
            "expected": F.trim(F.regexp_extract("details", pattern, 1)),
            "actual": F.trim(F.regexp_extract("details", pattern, 2)),
        }
    )
