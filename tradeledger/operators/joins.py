"""Many-to-one joins and referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_side(right: DataFrame, on: list[str]) -> DataFrame:
    """``right`` with the promise that ``on`` is unique; the job fails where it is not.

    The check rides on the shuffle that the join needs anyway. Because the result is an
    aggregate keyed by ``on``, the optimizer also knows that it cannot multiply rows and
    drops the whole join from queries that read none of its columns.
    """
    rest = [c for c in right.columns if c not in on]
    if not rest:
        return right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).select(*on)
    grouped = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_row"))
    message = F.concat(
        F.lit(f"many-to-one join: duplicate right key ({', '.join(on)}) = "),
        F.to_json(F.struct(*on)),
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_row"))
    return grouped.select(*on, checked.alias("_row")).select(*on, "_row.*")


def left_join_m1(left: DataFrame, right: DataFrame, on: list[str], keyed: bool = False) -> DataFrame:
    """Left join that keeps the row count of ``left``.

    ``keyed=True`` says that ``right`` is already one row per key by construction.
    """
    return left.join(right if keyed else unique_side(right, on), on, "left")


def few_keys(tables: list[DataFrame], key: str, bound: int) -> bool:
    """True if no table has more than ``bound`` values of ``key`` (estimated, 5 %); reads that column only."""
    counts = [df.agg(F.approx_count_distinct(key)).first()[0] for df in tables]
    return max(counts) <= bound


def missing_keys(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Distinct non-null ``fk`` values of the fact without a row in the dimension."""
    keys = fact.filter(F.col(fk).isNotNull()).select(F.col(fk).alias(pk)).distinct()
    return keys.join(dim.select(pk), pk, "left_anti").select(F.col(pk).alias(fk))
