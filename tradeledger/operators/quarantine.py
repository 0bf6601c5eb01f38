"""One-pass quarantine: accepted and rejected rows from a single scan, counted while they are written."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tradeledger.functions.stable import count_where

FOLDER, REASON = "quarantine", "rejection_reason"


class Quarantined(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame  # with all reasons of a row, joined by |
    counts: dict[str, int]  # rows, accepted, rejected, and rows by reason


def write_quarantine(df: DataFrame, rules: list[tuple[str, Column]], path: str) -> Quarantined:
    """Writes the rows of ``df`` under ``path`` by whether a rule rejects them.

    The reasons are one column, the split is the folder, and the counts are observed by the write
    itself: the input is read once. A rule that is null does not reject.
    """
    hits = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules}
    reasons = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in hits.items()]))
    tagged = df.withColumn(REASON, F.array_join(reasons, "|"))
    rejected = F.col(REASON) != ""
    seen = Observation()
    counted = tagged.observe(
        seen, F.count(F.lit(1)).alias("rows"), count_where(~rejected).alias("accepted"), count_where(rejected).alias("rejected"),
        *[count_where(F.array_contains(F.split(F.col(REASON), r"\|"), name)).alias(f"reason__{name}") for name in hits],
    )
    folders = counted.withColumn(FOLDER, F.when(rejected, "rejected").otherwise("accepted"))
    folders.write.mode("overwrite").partitionBy(FOLDER).parquet(path)
    back = df.sparkSession.read.schema(folders.schema).parquet(path)
    kept = back.filter(F.col(FOLDER) == "accepted").select(*df.columns)
    gone = back.filter(F.col(FOLDER) == "rejected").select(*df.columns, REASON)
    return Quarantined(kept, gone, {k: int(v) for k, v in seen.get.items()})
