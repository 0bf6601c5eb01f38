"""Column and table profiles, value counts, outliers and simple statistical tests."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.functions.stable import count_where, pct, stable_avg, stable_total
from tradeledger.operators.contracts import INTEGRAL, NUMERIC, STAMPS, duplicate_members
from tradeledger.operators.ordered import quantiles, top_n
from tradeledger.session import stage

# ---- shared shapes -------------------------------------------------------


def column_groups(df: DataFrame) -> dict[str, list[str]]:
    """Column roles from names and types; an id column also keeps its other role."""
    groups = {"id_columns": [], "date_columns": [], "numeric_columns": [], "categorical_columns": []}
    for f in df.schema.fields:
        name = f.name.lower()
        if name.endswith("_id") or name == "id":
            groups["id_columns"].append(f.name)
        if isinstance(f.dataType, (*STAMPS, T.DateType)) or "date" in name or "timestamp" in name:
            groups["date_columns"].append(f.name)
        elif isinstance(f.dataType, NUMERIC):
            groups["numeric_columns"].append(f.name)
        elif isinstance(f.dataType, (T.BooleanType, T.StringType)):
            groups["categorical_columns"].append(f.name)
    return {role: sorted(names) for role, names in groups.items()}


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _as_text(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(name) if nested else F.col(name).cast("string")


def long_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One (column_name, value) row per cell, values as text."""
    columns = columns or df.columns
    texts = df.select(*[_as_text(df, c).alias(c) for c in columns])
    return texts.unpivot([], columns, "column_name", "value")


def long_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or numeric_names(df)
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows per distinct value of every column, null included.

    Two narrow columns instead of one wide expansion per distinct count: equal cells merge
    before the shuffle, and one shuffle serves distinct counts, modes and top lists.
    """
    return long_values(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _rows_from(agg: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """Turns a one-row aggregate with columns `<field prefix><name>` into one row per name."""
    rows = [
        F.struct(F.lit(n).alias("column_name"), *[F.col(f"{prefix}{n}").alias(f) for f, prefix in fields.items()])
        for n in names
    ]
    return agg.select("_rows", F.inline(F.array(*rows)))


# ---- null, key, column and duplicate profiles -----------------------------


def null_counts(df: DataFrame) -> DataFrame:
    """column_name, total_rows, null_count from a single pass."""
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[count_where(F.col(c).isNull()).alias(f"n_{c}") for c in df.columns]
    )
    long = _rows_from(agg, df.columns, {"null_count": "n_"})
    return long.select("column_name", F.col("_rows").alias("total_rows"), "null_count")


def nulls_profile(df: DataFrame, table_name: str) -> DataFrame:
    ratio = F.coalesce(F.try_divide("null_count", "total_rows"), F.lit(0.0))
    profile = null_counts(df).select(
        F.lit(table_name).alias("table_name"), "column_name", "null_count", ratio.alias("null_ratio")
    )
    return profile.orderBy(F.desc("null_count"), "column_name")


def null_percentages(df: DataFrame) -> DataFrame:
    share = F.round(F.col("null_count") / F.greatest("total_rows", F.lit(1)) * 100, 2)
    return null_counts(df).select("column_name", "null_count", share.alias("null_pct")).orderBy(
        F.desc("null_pct"), "column_name"
    )


def _kind(t: T.DataType) -> str:
    """Columns of one kind are unpivoted together in their own type; the rest as text."""
    if isinstance(t, INTEGRAL):
        return "long"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "double"
    return "timestamp_ntz" if isinstance(t, (*STAMPS, T.DateType)) else "text"


def column_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, non_null_count, null_count, unique_count (null not counted as a value).

    Cells are counted per (column, value) in their own type, which is cheaper to hash and to
    shuffle than text; equal cells merge before the shuffle.
    """
    kinds: dict[str, list[str]] = {}
    for c in columns or df.columns:
        kinds.setdefault(_kind(df.schema[c].dataType), []).append(c)
    present = F.col("value").isNotNull()
    parts = []
    for kind, names in kinds.items():
        if kind == "text":
            cells = long_values(df, names)
        else:
            typed = df.select(*[F.col(c).cast(kind).alias(c) for c in names])
            cells = typed.unpivot([], names, "column_name", "value")
        counted = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            counted.groupBy("column_name").agg(
                F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("non_null_count"),
                F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_count"),
                count_where(present).alias("unique_count"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def candidate_keys(df: DataFrame, id_columns: list[str] | None = None) -> DataFrame:
    return keys_from_counts(column_counts(df, id_columns or column_groups(df)["id_columns"]))


def keys_from_counts(counts: DataFrame) -> DataFrame:
    full = (F.col("non_null_count") > 0) & (F.col("null_count") == 0)
    named = [c for c in ("table_name",) if c in counts.columns]
    return counts.select(
        *named,
        "column_name",
        "non_null_count",
        F.col("unique_count").alias("unique_non_null_count"),
        F.coalesce(F.try_divide("unique_count", "non_null_count"), F.lit(0.0)).alias("uniqueness_ratio"),
        "null_count",
        (full & (F.col("unique_count") == F.col("non_null_count"))).alias("is_possible_key"),
    ).orderBy(*named, F.desc("is_possible_key"), F.desc("uniqueness_ratio"), "column_name")


def _semantic_types(df: DataFrame) -> dict[str, str]:
    groups = column_groups(df)
    kinds = {}
    for c in df.columns:
        for role in ("id", "date", "numeric"):
            if c in groups[f"{role}_columns"]:
                kinds[c] = role
                break
        else:
            kinds[c] = "categorical"
    return kinds


def column_roles(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, dtype, semantic_type from the schemas."""
    rows = [
        (name, f.name, f.dataType.simpleString(), kind)
        for name, df in tables.items()
        for f, kind in zip(df.schema.fields, _semantic_types(df).values())
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, column_name string, dtype string, semantic_type string")


def columns_profile(df: DataFrame, table_name: str) -> DataFrame:
    counts = column_counts(df).withColumn("table_name", F.lit(table_name))
    return column_roles({table_name: df}).join(counts, ["table_name", "column_name"], "left").drop("null_count")


def duplicate_profile(df: DataFrame, table_name: str) -> DataFrame:
    """Rows that have an equal twin; every member of a group of copies counts."""
    ratio = F.coalesce(F.try_divide("duplicate_rows", "total_rows"), F.lit(0.0))
    return duplicate_members(df, df.columns).select(
        F.lit(table_name).alias("table_name"), "total_rows", "duplicate_rows", ratio.alias("duplicate_ratio")
    )


def profile_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Null, column, key and duplicate profiles of all tables, each stacked into one frame.

    Cells are counted once per table and the counts (one row per column) are staged; the
    null, column and key profiles are read off them.
    """
    counted = [column_counts(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    counts = stage(reduce(DataFrame.unionByName, counted), "column_counts")
    rows = F.col("non_null_count") + F.col("null_count")
    roles = column_roles(tables)
    ids = [(name, c) for name, df in tables.items() for c in column_groups(df)["id_columns"]]
    out = {
        "nulls": counts.select(
            "table_name",
            "column_name",
            "null_count",
            F.coalesce(F.try_divide("null_count", rows), F.lit(0.0)).alias("null_ratio"),
        ),
        "columns": roles.join(counts, ["table_name", "column_name"], "left").drop("null_count"),
        "duplicates": reduce(
            DataFrame.unionByName, [duplicate_profile(df, name) for name, df in tables.items()]
        ),
    }
    if ids:
        named = next(iter(tables.values())).sparkSession.createDataFrame(ids, "table_name string, column_name string")
        out["keys"] = keys_from_counts(counts.join(named, ["table_name", "column_name"]))
    return out


# ---- frequencies ---------------------------------------------------------


def frequencies(df: DataFrame, columns: list[str], missing: str = "unknown") -> DataFrame:
    """column_name, value, n for the chosen columns; null counts as ``missing``."""
    filled = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in columns])
    return value_counts(filled, columns)


def top_categories(df: DataFrame, n: int = 5) -> DataFrame:
    columns = text_names(df)
    counts = frequencies(df, columns, "null").withColumnRenamed("value", "category")
    total = df.agg(F.count(F.lit(1)).alias("_rows")).scalar()
    top = top_n(counts, ["column_name"], [F.desc("n"), F.asc("category")], n)
    share = F.round(F.col("n") / F.greatest(total, F.lit(1)) * 100, 2)
    return top.select("column_name", "category", F.col("n").alias("count"), share.alias("percentage"))


# ---- statistics ----------------------------------------------------------


def describe(df: DataFrame, digits: int | None = None) -> DataFrame:
    """count / unique / top / freq for text, mean / std / min / quartiles / max for numbers."""

    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    numbers, texts = numeric_names(df), text_names(df)
    empty = {"unique": "long", "top": "string", "freq": "long"}
    measures = ["mean", "std", "min", "25%", "50%", "75%", "max"]
    parts = []
    if numbers:
        long = long_numbers(df, numbers)
        moments = long.groupBy("column_name").agg(
            F.count("value").alias("count"),
            stable_avg("value").alias("mean"),
            shown(F.stddev("value")).alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        cuts = quantiles(long, ["column_name"], "value", {"25%": 0.25, "50%": 0.5, "75%": 0.75}).drop("n")
        blank = [F.lit(None).cast(t).alias(c) for c, t in empty.items()]
        parts.append(moments.join(cuts, "column_name", "left").select("column_name", "count", *blank, *measures))
    if texts:
        counts = value_counts(df, texts).filter("value is not null")
        freq = counts.groupBy("column_name").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq")
        )
        top = top_n(counts, ["column_name"], [F.desc("n"), F.asc("value")], 1)
        top = top.select("column_name", F.col("value").alias("top"))
        blank = [F.lit(None).cast("double").alias(m) for m in measures]
        parts.append(freq.join(top, "column_name").select("column_name", "count", "unique", "top", "freq", *blank))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are present; null for a constant column."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    covariance = F.covar_pop(x, y)
    return F.when(varies, F.try_divide(covariance, F.stddev_pop(x) * F.stddev_pop(y)))


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Upper triangle of the correlation matrix as rows column_x, column_y, r, n; one pass."""
    names = columns or numeric_names(df)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    both = [count_where(F.col(a).isNotNull() & F.col(b).isNotNull()) for a, b in pairs]
    agg = df.agg(
        *[_safe_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
        *[n.alias(f"n{i}") for i, n in enumerate(both)],
    )
    rows = [
        F.struct(
            F.lit(a).alias("column_x"), F.lit(b).alias("column_y"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return agg.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Square matrix: one row per column, one column per column."""
    names = columns or numeric_names(df)
    pairs = correlation_pairs(df, names)
    mirrored = pairs.select("column_x", "column_y", "r").unionByName(
        pairs.select(F.col("column_y").alias("column_x"), F.col("column_x").alias("column_y"), "r")
    )
    wide = mirrored.groupBy(F.col("column_x").alias("column_name")).pivot("column_y", names).agg(F.first("r"))
    return wide.select(
        "column_name", *[F.when(F.col("column_name") == c, 1.0).otherwise(F.col(c)).alias(c) for c in names]
    )


def iqr_outliers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Values strictly outside 1.5 IQR around exact quartiles, per numeric column."""
    long = long_numbers(df, columns)
    cuts = quantiles(long, ["column_name"], "value", {"q1": 0.25, "q3": 0.75})
    bounds = cuts.withColumn("iqr", F.col("q3") - F.col("q1")).select(
        "column_name",
        "n",
        "q1",
        "q3",
        "iqr",
        (F.col("q1") - 1.5 * F.col("iqr")).alias("lower_bound"),
        (F.col("q3") + 1.5 * F.col("iqr")).alias("upper_bound"),
    )
    # one row per numeric column of the schema
    measured = long.join(F.broadcast(bounds), "column_name")
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    keys = bounds.columns
    counted = measured.groupBy(*keys).agg(count_where(outside).alias("outlier_count"))
    share = F.round(F.col("outlier_count") / F.greatest("n", F.lit(1)) * 100, 2)
    return counted.withColumn("outlier_pct", share).drop("n")


def jarque_bera(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Normality test on the first five numeric columns with n >= 8 and some variance."""
    names = columns or numeric_names(df)[:5]
    stats = (
        long_numbers(df, names)
        .filter(F.col("value").isNotNull())
        .groupBy("column_name")
        .agg(
            F.count("value").alias("n"),
            F.skewness("value").alias("skew"),
            F.kurtosis("value").alias("excess"),
            (F.min("value") < F.max("value")).alias("varies"),
        )
        .filter("n >= 8 and varies")
    )
    jb = F.col("n") / 6 * (F.pow("skew", F.lit(2)) + F.pow("excess", F.lit(2)) / 4)
    p = F.exp(-jb / 2)  # survival function of chi-square with two degrees of freedom
    return stats.select(
        F.lit("jarque_bera_normality").alias("test_name"),
        F.col("column_name").alias("target"),
        F.round(jb, 4).alias("statistic"),
        F.round(p, 6).alias("p_value"),
        F.when(p < 0.05, "non_normal").otherwise("cannot_reject_normality").alias("interpretation"),
    )


def strongest_pair(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The pair with the largest |r|, one row."""
    pairs = correlation_pairs(df, columns).filter("r is not null and n >= 8")
    return pairs.orderBy(F.desc(F.abs("r")), "column_x", "column_y").limit(1)


def _two_sided_p(batches):
    for rows in batches:
        rows["p_value"] = [math.erfc(z / math.sqrt(2)) for z in rows["z"]]
        yield rows


def pearson_significance(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fisher z test of the strongest correlation."""
    best = strongest_pair(df, columns)
    r = F.least(F.greatest(F.col("r"), F.lit(-0.999999)), F.lit(0.999999))
    z = F.abs(0.5 * F.log((1 + r) / (1 - r)) * F.sqrt(F.col("n") - 3))
    scored = best.select("column_x", "column_y", "r", z.alias("z"))
    # erfc has no SQL function; the frame has a single row
    schema = "column_x string, column_y string, r double, z double, p_value double"
    tested = scored.mapInPandas(_two_sided_p, schema)
    return tested.select(
        F.lit("pearson_correlation_significance").alias("test_name"),
        F.concat_ws("~", "column_x", "column_y").alias("target"),
        F.round("r", 4).alias("statistic"),
        F.round("p_value", 6).alias("p_value"),
        F.when(F.col("p_value") < 0.05, "significant_correlation").otherwise("weak_evidence").alias("interpretation"),
    )


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum belongs to the last bin."""
    present = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("value"))
    low = present.agg(F.min("value")).scalar()
    high = present.agg(F.max("value")).scalar()
    bucket = F.when(low < high, F.least(F.width_bucket("value", low, high, F.lit(bins)), F.lit(bins))).otherwise(1)
    return present.groupBy(bucket.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin")


def box_stats(df: DataFrame, column: str) -> DataFrame:
    one = df.select(F.lit(column).alias("column_name"), F.col(column).cast("double").alias("value"))
    ranks = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    return quantiles(one, ["column_name"], "value", ranks)


# ---- fact summaries ------------------------------------------------------

ENRICHED = [
    "customer_unique_id", "customer_state", "seller_state", "payment_type_mode",
    "product_category_name", "product_category_name_english",
]


def join_health(fact: DataFrame) -> DataFrame:
    """Percent of rows without each enriched attribute."""
    names = [c for c in ENRICHED if c in fact.columns]
    agg = fact.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.round(pct(F.col(c).isNull()), 2).alias(f"p_{c}") for c in names]
    )
    return _rows_from(agg, names, {"missing_pct": "p_"}).drop("_rows")


def order_gaps(fact: DataFrame) -> DataFrame:
    """Per order: |sum of item values - payment total|."""
    orders = fact.groupBy("order_id").agg(
        stable_total("total_item_value").alias("items_total"),
        F.coalesce(F.max("total_payment_value"), F.lit(0.0)).alias("paid_total"),
    )
    return orders.withColumn("abs_gap", F.abs(F.col("items_total") - F.col("paid_total")))


def payment_reconciliation(fact: DataFrame) -> DataFrame:
    return order_gaps(fact).agg(
        F.count(F.lit(1)).alias("orders_reconciled"),
        F.round(stable_avg("abs_gap"), 4).alias("avg_abs_gap"),
        F.round(F.max("abs_gap"), 4).alias("max_abs_gap"),
        F.round(pct(F.col("abs_gap") > 1.0), 2).alias("orders_gap_gt_1_real_pct"),
    )
