"""Personal-data classification of columns, masking actions, risk score, redaction of text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.functions import patterns as pt
from tradeledger.functions import scalars as sc
from tradeledger.functions.stable import count_where
from tradeledger.operators.contracts import INTEGRAL, STAMPS
from tradeledger.operators.profiling import long_values

CLASS_RANK = {"non_personal": 1, "indirect_identifier": 2, "personal_data": 3, "sensitive_personal_data": 4}
CLASSES = list(CLASS_RANK)
LEVELS = ["low", "medium", "high"]
ACTIONS = ["keep", "mask", "anonymize", "remove", "review"]


# ---- decisions from the column name --------------------------------------


def _hits(name: str, terms: list[str], match: str) -> bool:
    if match == "token":
        words = f"_{name}_"
        return any(f"_{term}_" in words for term in terms)
    return any(term in name for term in terms)


def class_from_name(column: str, match: str = "substring") -> tuple[str, str]:
    """Class and reason by the terms in the name. ``substring`` is eager on purpose; ``token`` is not."""
    name = column.strip().lower()
    if _hits(name, pt.SENSITIVE_TERMS, match):
        return "sensitive_personal_data", "Column name indicates sensitive data."
    if _hits(name, pt.PERSONAL_TERMS, match):
        return "personal_data", "Column name indicates personal data."
    if _hits(name, pt.INDIRECT_TERMS, match):
        return "indirect_identifier", "Column name indicates indirect identification risk."
    return "non_personal", "No personal-data indicators found in column name."


def _one_of(value: object, allowed: list[str], default: str, lower: bool = True) -> str:
    text = str(value).strip()
    text = text.lower() if lower else text
    return text if text in allowed else default


def declared_class(column: str, rules: dict | None) -> tuple[str, str, str, str] | None:
    """(class, risk, action, reason) from declared rules: exact name, then contained token, then regex."""
    rules = rules or {}
    name = column.strip().lower()
    exact = {str(k).strip().lower(): r for k, r in (rules.get("exact") or {}).items()}
    found = exact.get(name)
    if found is None:
        found = next((r for r in rules.get("contains") or [] if str(r["token"]).strip().lower() in name), None)
    if found is None:
        found = next((r for r in rules.get("regex") or [] if re.search(str(r["pattern"]), column)), None)
    if found is None:
        return None
    return (
        _one_of(found["lgpd_classification"], CLASSES, "non_personal", lower=False),
        _one_of(found["risk_level"], LEVELS, "medium"),
        _one_of(found["recommended_action"], ACTIONS, "review"),
        str(found["reason"]),
    )


def risk_and_action(kind: str, column: str) -> tuple[str, str]:
    name = column.lower()
    if kind == "sensitive_personal_data":
        return "high", "remove" if any(t in name for t in pt.REMOVE_SENSITIVE_TOKENS) else "anonymize"
    if kind == "personal_data":
        return "high", "remove" if any(t in name for t in pt.REMOVE_PERSONAL_TOKENS) else "mask"
    return ("medium", "review") if kind == "indirect_identifier" else ("low", "keep")


# ---- decisions from the values -------------------------------------------


def matches(text: Column, name: str) -> Column:
    """Whether the pattern ``name`` occurs in the text."""
    length, character = pt.NEEDS[name]
    possible = F.length(text) >= length
    if character is not None:
        possible = possible & F.contains(text, F.lit(character))
    return possible & F.regexp_like(text, F.lit(pt.VALUE_PATTERNS[name]))


def value_signals(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, non_null and one boolean per pattern; whole columns, one pass.

    The pattern that decides is the first that occurs anywhere in the column, so a maximum
    over all rows replaces a search through joined sample values and needs no row order.
    Cells are unpivoted first: five small aggregates per cell instead of five per column,
    which for a wide table would be too large to compile.
    """
    columns = columns or df.columns
    types = {c: df.schema[c].dataType for c in columns}
    whole = [c for c in columns if isinstance(types[c], INTEGRAL)]
    silent = [c for c in columns if isinstance(types[c], (T.BooleanType, T.DateType, *STAMPS))]
    texts = [c for c in columns if c not in whole and c not in silent]
    parts = []
    if texts:
        hits = {name: matches(F.col("value"), name) for name in pt.VALUE_PATTERNS}
        parts.append(_signal_rows(long_values(df, texts), hits))
    if whole:
        # the digits of an integer decide by their number alone: no text, no expression
        cells = df.select(*[F.col(c).cast("long").alias(c) for c in whole])
        size = F.abs("value")
        hits = {name: F.lit(False) for name in pt.VALUE_PATTERNS}
        hits["cpf"] = size.between(10**10, 10**11 - 1)
        hits["cnpj"] = size.between(10**13, 10**14 - 1)
        hits["phone"] = size >= 10**7
        parts.append(_signal_rows(cells.unpivot([], whole, "column_name", "value"), hits))
    if silent:
        # a printed date, time or boolean cannot contain any of the patterns
        counts = df.agg(*[F.count(c).alias(c) for c in silent])
        rows = counts.unpivot([], silent, "column_name", "non_null")
        parts.append(rows.select("*", *[F.lit(False).alias(name) for name in pt.VALUE_PATTERNS]))
    found = reduce(DataFrame.unionByName, parts)
    # a table without rows has no groups; its columns still get a row
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(found, "column_name", "left").select(
        "column_name",
        F.coalesce("non_null", F.lit(0)).alias("non_null"),
        *[F.coalesce(name, F.lit(False)).alias(name) for name in pt.VALUE_PATTERNS],
    )


def _signal_rows(cells: DataFrame, hits: dict[str, Column]) -> DataFrame:
    return cells.groupBy("column_name").agg(
        F.count("value").alias("non_null"), *[F.bool_or(hit).alias(name) for name, hit in hits.items()]
    )


# Reasons shown with a value decision.
FINDINGS = {
    "email": "Regex matched email pattern in sampled values.",
    "cpf": "Regex matched CPF pattern in sampled values.",
    "cnpj": "Regex matched CNPJ pattern in sampled values.",
    "phone": "Regex matched phone pattern in sampled values.",
    "ip": "Regex matched IP pattern in sampled values.",
    "none": "No personal-data regex pattern matched sampled values.",
    "empty": "Column has only null values.",
}


def value_label() -> Column:
    """Name of the deciding pattern, null when none matched."""
    return F.coalesce(*[F.when(F.col(name), F.lit(name)) for name in pt.VALUE_PATTERNS])


def classify_columns(
    df: DataFrame, rules: dict | None = None, match: str = "substring", sample_rows: int | None = None
) -> DataFrame:
    """One row per column: dtype, class, risk level, action and reason.

    Names decide on the driver (schema only); values are scanned in one aggregate over the
    whole table, or over ``sample_rows`` rows when the caller asks for that. Columns with a
    declared rule are not scanned at all.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = {c: d for c in df.columns if (d := declared_class(c, rules)) is not None}
    order = {c: i for i, c in enumerate(df.columns)}
    spark = df.sparkSession
    schema = (
        "position int, column_name string, dtype string, lgpd_classification string, risk_level string, "
        "recommended_action string, reason string"
    )
    parts = []
    if declared:
        fixed = [(order[c], c, types[c], d[0], d[1], d[2], d[3]) for c, d in declared.items()]
        parts.append(spark.createDataFrame(fixed, schema))
    scanned = [c for c in df.columns if c not in declared]
    if scanned:
        rows = df if sample_rows is None else df.limit(sample_rows)
        # what each column would be under each finding: at most columns x 7 rows, from names alone
        outcomes = []
        for c in scanned:
            name_class, name_reason = class_from_name(c, match)
            for finding, value_reason in FINDINGS.items():
                value_class = pt.PATTERN_CLASS.get(finding, "non_personal")
                final = max(name_class, value_class, key=CLASS_RANK.__getitem__)
                risk, action = risk_and_action(final, c)
                outcomes.append((order[c], c, finding, types[c], final, risk, action, f"{name_reason} {value_reason}"))
        decisions = spark.createDataFrame(outcomes, schema.replace("dtype", "finding string, dtype"))
        finding = F.when(F.col("non_null") == 0, "empty").otherwise(F.coalesce(value_label(), F.lit("none")))
        signals = value_signals(rows, scanned).select("column_name", finding.alias("finding"))
        parts.append(decisions.join(signals, ["column_name", "finding"]).drop("finding"))
    out = reduce(DataFrame.unionByName, parts)
    return out.orderBy("position").drop("position")


# ---- actions -------------------------------------------------------------


def masked(column: str) -> Column:
    """The mask that fits the column name, a full hash where none does."""
    name = column.lower()
    for words, mask in (
        (("email",), sc.mask_email),
        (("cpf",), sc.mask_cpf),
        (("cnpj",), sc.mask_cnpj),
        (("phone", "telefone"), sc.mask_phone),
    ):
        if any(w in name for w in words):
            return mask(column)
    return sc.hashed(column)


# Notes of the action log.
ACTION_NOTES = {
    "keep": "Column preserved.",
    "mask": "Masked direct identifier.",
    "anonymize": "Anonymized values.",
    "remove": "Column removed from dataset.",
    "review": "Column preserved and flagged for review.",
}


def apply_actions(df: DataFrame, actions: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The table after its column actions (one projection) and the action log."""
    projected, log = [], []
    for c in df.columns:
        action = actions.get(c)
        if action is not None:
            action = action.lower() if action.lower() in ACTIONS else "review"
            log.append((c, action, ACTION_NOTES[action]))
        if action == "remove":
            continue
        if action == "mask":
            projected.append(masked(c).alias(c))
        elif action == "anonymize":
            dated = "date" in c.lower() or "data" in c.lower()
            projected.append((sc.year_only(c) if dated else sc.hashed(c)).alias(c))
        else:
            projected.append(F.col(c))
    notes = df.sparkSession.createDataFrame(log, "column_name string, action string, note string")
    return df.select(*projected), notes


def apply_classification(df: DataFrame, classification: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As `apply_actions`, with the actions read from a classification (one row per column)."""
    rows = classification.select("column_name", "recommended_action").collect()
    return apply_actions(df, {r.column_name: r.recommended_action for r in rows})


# ---- risk ----------------------------------------------------------------


def risk_scores(classification: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Risk score 0..100 per dataset with its components.

    ``classification`` holds one row per column and a `total_rows` column; `null_pct` is
    optional. Points: 7 per personal, 15 per sensitive, 4 per indirect column, up to 15 for
    nulls in personal columns, 15 for a direct identifier, up to 15 for volume.
    """
    by = by or []
    kind = F.col("lgpd_classification")
    hint = F.regexp_like(F.lower("column_name"), F.lit("|".join(pt.DIRECT_HINTS)))
    critical = kind.isin("personal_data", "sensitive_personal_data")
    if "null_pct" in classification.columns:
        null_mean = F.avg(F.when(critical, F.coalesce("null_pct", F.lit(0.0))))
        # rounding to even, like the scorer it must agree with
        nulls = F.least(F.lit(15), F.coalesce(F.bround(null_mean * 0.2, 0).cast("int"), F.lit(0)))
    else:
        nulls = F.max(F.lit(0))
    rows = F.max("total_rows")
    volume = F.when(rows >= 100_000, 15).when(rows >= 10_000, 10).when(rows >= 1_000, 5).otherwise(0)
    parts = {
        "personal_data_exposure": count_where(kind == "personal_data") * 7,
        "sensitive_data_exposure": count_where(kind == "sensitive_personal_data") * 15,
        "indirect_identifier_exposure": count_where(kind == "indirect_identifier") * 4,
        "critical_null_penalty": nulls,
        "direct_identifier_bonus": F.when(F.bool_or(hint), 15).otherwise(0),
        "volume_penalty": volume,
    }
    scored = classification.groupBy(*by).agg(*[c.cast("long").alias(n) for n, c in parts.items()])
    total = reduce(lambda a, b: a + b, [F.col(n) for n in parts])
    score = F.greatest(F.lit(0), F.least(F.lit(100), total))
    scored = scored.withColumn("score", score)
    level = F.when(F.col("score") <= 30, "low").when(F.col("score") <= 70, "medium").otherwise("high")
    advice = F.when(F.col("score") <= 30, "approved").when(F.col("score") <= 70, "needs_review").otherwise("blocked")
    return scored.withColumns({"risk_level": level, "publication_recommendation": advice})


# ---- free text -----------------------------------------------------------


def pii_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Number of matches per pattern and document, over the whole text."""
    found = {n: F.regexp_count(F.col(text), F.lit(p)).cast("long") for n, p in pt.VALUE_PATTERNS.items()}
    return df.select(key, *[c.alias(f"{n}_hits") for n, c in found.items()])


def redacted(text: Column | str) -> Column:
    """Text with every match replaced by its pattern name, strongest identifier first."""
    out = sc.col(text)
    for name, pattern in pt.VALUE_PATTERNS.items():
        out = F.regexp_replace(out, F.lit(pattern), F.lit(f"[{name}]"))
    return out


def redact_text(df: DataFrame, key: str, text: str) -> DataFrame:
    clean = redacted(text)
    return df.select(key, clean.alias(text), (clean != F.col(text)).alias("redacted"))
