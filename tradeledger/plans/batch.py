"""The batch run over a folder of layers: every step reads files and writes files.

The steps are plain functions; run them one by one or through `run_all`, which stops at
the first step that raises.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeledger.operators import catalog, governance, privacy
from tradeledger.operators import checks as ck
from tradeledger.operators.contracts import validate_contract
from tradeledger.operators.profiling import profile_tables
from tradeledger.plans import marts, published, reports, star
from tradeledger.plans.fact import FACT_COLUMNS, build_fact
from tradeledger.sources import readers, writers
from tradeledger.sources.commerce import Commerce

TABLES = ("orders", "items", "customers", "products", "sellers", "translation", "payments", "reviews")


@dataclass(frozen=True)
class Run:
    """Where the layers live and what the run is measured against."""

    spark: SparkSession
    source: Commerce
    root: str
    as_of: str
    min_rows: int = ck.MIN_RECORDS
    tier_bounds: tuple[int, ...] = (25, 100, 500)
    # cleaned items written once and read by all branches; pays off when the source is large
    staged: bool = True
    business_rules: list[dict] = field(default_factory=lambda: list(BUSINESS_RULES))
    run_id: str | None = None  # name of the run in logs, ``as_of`` by default

    def raw(self) -> dict[str, DataFrame]:
        return {name: getattr(self.source, name) for name in TABLES}

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name) + ".parquet")

    def fact(self) -> DataFrame:
        return self.read("curated", "fact_orders_enriched").select(*FACT_COLUMNS)

    def published(self) -> DataFrame:
        return self.read("published", "fact_orders_dashboard").select(*published.PUBLISHED_COLUMNS)


BUSINESS_RULES = [
    {"rule_id": "price_not_negative", "type": "range", "column": "price", "severity": "high", "params": {"min": 0}},
    {
        "rule_id": "delivered_has_date",
        "type": "not_null_if",
        "column": "order_delivered_customer_date",
        "severity": "medium",
        "params": {"if_column": "order_status", "if_equals": "delivered"},
    },
    {
        "rule_id": "delivery_after_purchase",
        "type": "compare_columns",
        "columns": ["order_delivered_customer_date", "order_purchase_timestamp"],
        "severity": "high",
        "params": {"operator": ">="},
    },
    {
        "rule_id": "total_covers_price",
        "type": "expression",
        "severity": "medium",
        "params": {"expression": "price is null or total_item_value >= price"},
    },
]


def together(jobs: list[Callable[[], object]], workers: int = 6) -> list:
    """Submits independent writes at the same time, so that small jobs share the executors."""
    with ThreadPoolExecutor(workers) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def inventory(run: Run) -> None:
    writers.write_parquet(readers.inventory(run.raw()), run.path("monitoring", "inventory.parquet"))


def profiling(run: Run) -> None:
    """Standardised Parquet copies of all tables and their profiles."""
    together(
        [
            partial(writers.write_parquet, writers.spread(df), run.path("standardized", name + ".parquet"))
            for name, df in run.raw().items()
        ]
    )
    profiles = profile_tables({name: run.read("standardized", name) for name in TABLES})
    together(
        [
            partial(writers.write_parquet, df, run.path("monitoring", f"profile_{kind}.parquet"))
            for kind, df in profiles.items()
        ]
    )


def build(run: Run) -> int:
    """The fact as Parquet (by year) and CSV. Rebalancing sizes the files and splits a dominant year."""
    source = Commerce(**{name: run.read("standardized", name) for name in TABLES})
    fact = build_fact(source, run.tier_bounds, staged=run.staged).hint("rebalance", "order_year")
    writers.write_dual(fact, run.path("curated", "fact_orders_enriched"), ["order_year"])
    rows = run.fact().count()
    if rows < run.min_rows:
        raise ValueError(f"fact_orders_enriched needs at least {run.min_rows} rows, found {rows}")
    return rows


def publish(run: Run) -> None:
    target = run.path("published", "fact_orders_dashboard")
    published.gated_publish(run.fact(), lambda df: writers.write_dual(df, target, ["order_year"]))


def semantic(run: Run) -> None:
    made = marts.shared_marts(run.published())
    together([partial(writers.write_dual, mart, run.path("semantic", name)) for name, mart in made.items()])


def classify(run: Run) -> None:
    writers.write_parquet(privacy.classify_columns(run.fact()), run.path("monitoring", "classification.parquet"))


def _contract(name: str, layer: str, df: DataFrame, key: list[str], min_rows: int) -> dict:
    words = {"string": "string", "bigint": "integer", "int": "integer", "double": "float", "boolean": "boolean"}
    columns = {
        f.name: words.get(f.dataType.simpleString(), "date_like") for f in df.schema.fields
    }
    return {"dataset_name": name, "layer": layer, "columns": columns, "primary_key": key, "min_rows": min_rows}


def contracts(run: Run) -> None:
    fact, table = run.fact(), run.published()
    checks = validate_contract(
        fact, _contract("fact_orders_enriched", "curated", fact, ck.GRAIN, run.min_rows)
    ).unionByName(
        validate_contract(
            table, _contract("fact_orders_dashboard", "published", table, ["order_id", "order_item_id"], run.min_rows)
        )
    )
    writers.write_parquet(checks, run.path("monitoring", "schema_contracts.parquet"))


def quality(run: Run) -> None:
    fact = run.fact()
    suite = ck.fact_quality_suite(fact, run.min_rows)
    rules = ck.run_business_rules(fact, run.business_rules)
    together(
        [
            partial(writers.write_parquet, suite, run.path("monitoring", "quality.parquet")),
            partial(writers.write_parquet, rules, run.path("monitoring", "business_rules.parquet")),
        ]
    )


def monitor(run: Run) -> None:
    """Monitoring rows, alert payload and one history row a run, however often the step runs."""
    table = run.published()
    target = run.path("published", "fact_orders_dashboard") + ".parquet"
    age = governance.freshness_check(governance.file_times(run.spark, target), run.as_of)
    checks = age.unionByName(governance.monitor_published(table, run.min_rows))
    writers.write_parquet(checks, run.path("monitoring", "published_monitoring.parquet"))
    checks = run.read("monitoring", "published_monitoring")
    writers.write_summary_json(checks, run.path("monitoring", "published_monitoring_json"), run.as_of, "results")
    writers.write_jsonl(governance.alert_payload(checks), run.path("monitoring", "alert"))
    status = governance.checks_summary_row(checks, "fact_orders_dashboard", run.as_of)
    writers.append_log(status, run.path("monitoring", "history.parquet"), run.run_id or run.as_of)


def scorecards(run: Run) -> None:
    fact, table = F.lit("fact_orders_enriched"), F.lit("fact_orders_dashboard")
    sources = {
        "data_quality": run.read("monitoring", "quality").withColumn("dataset_name", fact),
        "business_rules": run.read("monitoring", "business_rules").withColumn("dataset_name", fact),
        "schema_contracts": run.read("monitoring", "schema_contracts"),
        "published_monitoring": run.read("monitoring", "published_monitoring").withColumn("dataset_name", table),
    }
    metrics = governance.scorecard_metrics(governance.collect_check_sources(sources))
    writers.write_parquet(metrics, run.path("monitoring", "scorecard_metrics.parquet"))
    metrics = run.read("monitoring", "scorecard_metrics")
    cards = governance.dataset_scorecards(metrics)
    writers.write_parquet(cards, run.path("monitoring", "scorecards.parquet"))
    writers.write_scorecards_json(metrics, cards, run.path("monitoring", "scorecards_json"), run.as_of)


def asset_catalog(run: Run) -> None:
    assets, frames = [], {}
    for name in TABLES:
        frames[name] = run.read("standardized", name)
        assets.append({"asset_name": name, "zone": "standardized", "path": f"{name}.parquet"})
    for layer, name, ready in (("curated", "fact_orders_enriched", False), ("published", "fact_orders_dashboard", True)):
        frames[name] = run.read(layer, name)
        assets.append({"asset_name": name, "zone": layer, "path": f"{name}.parquet", "publication_ready": ready})
    for name in marts.MARTS:
        frames[name] = run.read("semantic", name)
        assets.append({"asset_name": name, "zone": "semantic", "path": f"{name}.parquet", "publication_ready": True})
    counts = readers.footer_counts(run.spark, {a["asset_name"]: run.path(a["zone"], a["path"]) for a in assets})
    writers.write_parquet(catalog.asset_catalog(assets, frames, counts), run.path("monitoring", "catalog.parquet"))


def sql_reports(run: Run) -> DataFrame:
    """All reports as CSV with a manifest (query, path, rows, columns); rows are counted while writing."""
    shared = reports.shared_reports(run.fact())

    def write(name: str) -> tuple:
        report = reports.REPORTS[name](shared)
        target, seen = run.path("reports", name), Observation(name)
        counted = report.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").option("header", True).csv(target)
        return name, target, seen.get["rows"], len(report.columns)

    done = together([partial(write, name) for name in reports.REPORTS])
    manifest = run.spark.createDataFrame(done, "query string, path string, rows long, columns int")
    writers.write_parquet(manifest, run.path("reports", "manifest.parquet"))
    return manifest


def bi_export(run: Run) -> None:
    """Star schema: written once, verified from the files, exported as BI CSV."""
    schema = star.star_schema(run.fact())
    together([partial(writers.write_parquet, df, run.path("bi", name + ".parquet")) for name, df in schema.items()])
    tables = {name: run.read("bi", name) for name in star.PRIMARY_KEYS}
    star.verify_star(tables)
    together([partial(writers.write_bi_csv, df, run.path("bi", name + "_csv")) for name, df in tables.items()])


STEPS: dict[str, Callable[[Run], object]] = {
    "inventory": inventory,
    "profiling": profiling,
    "build_fact": build,
    "publish": publish,
    "semantic_marts": semantic,
    "classification": classify,
    "schema_contracts": contracts,
    "quality_checks": quality,
    "published_monitoring": monitor,
    "scorecards": scorecards,
    "catalog": asset_catalog,
    "sql_reports": sql_reports,
    "bi_export": bi_export,
}


def run_all(run: Run) -> dict[str, float]:
    """Every step in order; seconds per step."""
    seconds = {}
    for name, step in STEPS.items():
        begin = time.perf_counter()
        step(run)
        seconds[name] = round(time.perf_counter() - begin, 3)
    return seconds
