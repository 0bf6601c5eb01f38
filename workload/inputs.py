"""Tables that the registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeledger.plans.fact import build_fact
from tradeledger.plans.published import publish
from tradeledger.sources.commerce import commerce
from workload.base import TIERS


def fact(spark: SparkSession, root: str) -> DataFrame:
    return build_fact(commerce(spark, root), TIERS)


def published(spark: SparkSession, root: str) -> DataFrame:
    return publish(fact(spark, root))
