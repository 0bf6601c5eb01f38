"""The seventeen SQL reports as DataFrame plans over the fact.

Every report is one grouped aggregate: a key, measures, an order, and a limit only where the
report is a top list. A report runs over the fact itself, or over :func:`shared_reports`, which
reads the fact twice for all of them; the rows are the same.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions.stable import count_where, pct, stable_avg, stable_sum
from tradeledger.plans.shared import Shared, State, double_mean, double_states, double_sum, rows_where, share


class Measure(NamedTuple):
    """An aggregate of fact rows, and the same from shared states."""

    direct: Column
    shared: Column
    distinct_orders: bool = False


def _category() -> Column:
    return F.coalesce(F.col("product_category_name_english"), F.col("product_category_name"), F.lit("unknown"))


def _month_date() -> Column:
    return F.make_date("order_year", "order_month", F.lit(1))


def _payment() -> Column:
    return F.coalesce(F.col("payment_type_mode"), F.lit("unknown"))


def _late_value() -> Column:
    return F.when(F.col("is_delayed"), F.col("total_item_value")).otherwise(0.0)


def _r(c: Column) -> Column:
    return F.round(c, 2)


def _orders() -> Measure:
    return Measure(F.countDistinct("order_id"), F.col("orders"), distinct_orders=True)


def _rows() -> Measure:
    return Measure(F.count(F.lit(1)), F.col("rows"))


def _revenue() -> Measure:
    return Measure(_r(stable_sum("total_item_value")), _r(double_sum("total_item_value")))


def _mean(name: str) -> Measure:
    return Measure(_r(stable_avg(name)), _r(double_mean(name)))


def _late() -> Measure:
    some = F.when(F.col("rows") > 0, F.col("delayed").cast("double") / F.nullif(F.col("rows"), F.lit(0)))
    return Measure(_r(pct(F.col("is_delayed"))), _r(some * 100))


def _rows_where(name: str) -> Measure:
    return Measure(count_where(AUDIT[name]()), F.col(name))


AUDIT = {
    "negative_price_rows": lambda: F.col("price") < 0,
    "negative_freight_rows": lambda: F.col("freight_value") < 0,
    "invalid_delivery_rows": lambda: F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp"),
    "null_order_id_rows": lambda: F.col("order_id").isNull(),
}
KEYS = {
    "order_status": lambda: F.col("order_status"),
    "order_year": lambda: F.col("order_year"),
    "order_month": lambda: F.col("order_month"),
    "category": _category,
    "customer_state": lambda: F.col("customer_state"),
    "payment_type": _payment,
    "mes_referencia": lambda: F.trunc("order_date", "month"),
}
GRAINS = {
    "all": [],
    "status": ["order_status"],
    "month": ["order_year", "order_month"],
    "category": ["category"],
    "state": ["customer_state"],
    "payment": ["payment_type"],
    "date month": ["mes_referencia"],
}
MEANS = ("total_item_value", "delivery_time_days", "estimated_delay_days", "review_score_mean", "freight_value")


def shared_reports(fact: DataFrame) -> Shared:
    """The states of all reports; pass the result to them in place of the fact."""
    states = {"rows": State(F.lit(1).cast("long"), "count"), "delayed": rows_where(F.col("is_delayed"))}
    for name in MEANS:
        states |= double_states(name, name)
    states |= double_states("late_value", _late_value())
    states |= {name: rows_where(condition()) for name, condition in AUDIT.items()}
    keys = {name: c() for name, c in KEYS.items()}
    # the keys together have nearly as many combinations as there are rows, each grain on its own has few
    return share(fact, keys, GRAINS, states, {"orders": (F.col("order_id"), list(GRAINS))}, cells=False)


def _total(source: DataFrame | Shared, measures: dict[str, Measure]) -> DataFrame:
    if isinstance(source, Shared):
        return source.grain([]).select(*[m.shared.alias(name) for name, m in measures.items()])
    return source.agg(*[m.direct.alias(name) for name, m in measures.items()])


def _grouped(rows: DataFrame, names: list[str], keys: list[Column], measures: dict[str, Measure]) -> DataFrame:
    """The measures of each group.

    Distinct orders are counted from (key, order) pairs alone: an aggregate of all measures at once
    would keep the state of every measure for each pair, in each task.
    """
    others = [m.direct.alias(name) for name, m in measures.items() if not m.distinct_orders]
    out = rows.groupBy(*keys).agg(*others)
    if len(others) == len(measures):
        return out
    pairs = rows.select(*keys, "order_id").filter(F.col("order_id").isNotNull()).distinct()
    counted = pairs.groupBy(*[F.col(k).alias(f"_key_{k}") for k in names]).agg(F.count(F.lit(1)).alias("_orders"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in names])
    orders = F.coalesce(F.col("_orders"), F.lit(0).cast("long"))
    shown = [(orders if m.distinct_orders else F.col(name)).alias(name) for name, m in measures.items()]
    return out.join(counted, same, "left").select(*names, *shown)


def _report(
    source: DataFrame | Shared,
    by: dict[str, Column | str],
    measures: dict[str, Measure],
    order: list[str],
    having: Column | None = None,
    limit: int | None = None,
    grain: list[str] | None = None,
) -> DataFrame:
    """``order`` lists columns, a leading minus means descending; the key breaks ties.

    ``grain`` names the shared keys, where they are not those of ``by``; columns of ``by`` are then made from them.
    """
    keys = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in by.items()]
    if isinstance(source, Shared):
        renamed = {"categoria": "category"}
        made = {name: F.col(renamed.get(name, name)) for name in by if renamed.get(name, name) in source.keys}
        shown = [made[name].alias(name) if name in made else key for name, key in zip(by, keys)]
        out = source.grain(grain or list(by)).select(*shown, *[m.shared.alias(name) for name, m in measures.items()])
    else:
        out = _grouped(source, list(by), keys, measures)
    if having is not None:
        out = out.filter(having)
    sorting = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    out = out.orderBy(*sorting, *[k for k in by if k not in order])
    return out if limit is None else out.limit(limit)


def order_status_exploration(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_orders": _orders(),
        "total_items": _rows(),
        "total_revenue": _revenue(),
        "avg_item_value": _mean("total_item_value"),
    }
    return _report(fact, {"order_status": "order_status"}, measures, ["-total_revenue", "-total_orders"])


def cleaning_audit_counters(fact: DataFrame | Shared) -> DataFrame:
    return _total(fact, {"total_rows": _rows(), **{name: _rows_where(name) for name in AUDIT}})


def kpi_row(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_orders": _orders(),
        "total_items": _rows(),
        "total_revenue": _revenue(),
        "avg_item_value": _mean("total_item_value"),
        "avg_delivery_time_days": _mean("delivery_time_days"),
        "delayed_items_pct": _late(),
        "avg_review_score": _mean("review_score_mean"),
    }
    return _total(fact, measures)


def monthly_series(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_orders": _orders(),
        "total_revenue": _revenue(),
        "avg_delivery_time_days": _mean("delivery_time_days"),
        "delayed_items_pct": _late(),
    }
    by = {"order_month_date": _month_date()}
    return _report(fact, by, measures, ["order_month_date"], grain=["order_year", "order_month"])


def top_20_categories(fact: DataFrame | Shared, limit: int = 20) -> DataFrame:
    measures = {
        "total_items": _rows(),
        "total_orders": _orders(),
        "total_revenue": _revenue(),
        "avg_item_value": _mean("total_item_value"),
        "delayed_items_pct": _late(),
    }
    return _report(fact, {"category": _category()}, measures, ["-total_revenue", "-total_orders"], limit=limit)


def top_categories_by_revenue(fact: DataFrame | Shared, limit: int = 20) -> DataFrame:
    measures = {
        "total_items": _rows(),
        "total_orders": _orders(),
        "total_revenue": _revenue(),
        "avg_item_revenue": _mean("total_item_value"),
    }
    return _report(fact, {"category": _category()}, measures, ["-total_revenue", "-total_orders"], limit=limit)


def monthly_revenue_evolution(fact: DataFrame | Shared) -> DataFrame:
    by = {"order_month_date": _month_date(), "order_year": "order_year", "order_month": "order_month"}
    measures = {
        "total_orders": _orders(),
        "total_items": _rows(),
        "total_revenue": _revenue(),
        "avg_item_revenue": _mean("total_item_value"),
        "avg_delivery_time_days": _mean("delivery_time_days"),
        "delayed_orders_pct": _late(),
    }
    return _report(fact, by, measures, ["order_month_date"], grain=["order_year", "order_month"])


def revenue_by_state(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_orders": _orders(),
        "total_items": _rows(),
        "total_revenue": _revenue(),
        "avg_item_revenue": _mean("total_item_value"),
        "delayed_orders_pct": _late(),
    }
    known = F.col("customer_state").isNotNull()
    return _report(fact, {"customer_state": "customer_state"}, measures, ["-total_revenue", "-total_orders"], known)


def delivery_delay_by_category(fact: DataFrame | Shared, min_items: int = 100) -> DataFrame:
    measures = {
        "total_items": _rows(),
        "avg_delivery_time_days": _mean("delivery_time_days"),
        "avg_estimated_delay_days": _mean("estimated_delay_days"),
        "delayed_items_pct": _late(),
        "delayed_revenue": Measure(_r(stable_sum(_late_value())), _r(double_sum("late_value"))),
    }
    order = ["-delayed_items_pct", "-avg_estimated_delay_days", "-total_items"]
    return _report(fact, {"category": _category()}, measures, order, having=F.col("total_items") >= min_items)


def payment_method_distribution(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_items": _rows(),
        "total_orders": _orders(),
        "total_revenue": _revenue(),
        "avg_item_revenue": _mean("total_item_value"),
        "delayed_orders_pct": _late(),
    }
    by = {"payment_type": _payment()}
    return _report(fact, by, measures, ["-total_revenue", "-total_orders"])


def executive_kpis_with_ticket(fact: DataFrame | Shared) -> DataFrame:
    ticket = Measure(
        _r(stable_sum("total_item_value") / F.nullif(F.countDistinct("order_id"), F.lit(0))),
        _r(double_sum("total_item_value") / F.nullif(F.col("orders"), F.lit(0))),
    )
    measures = {
        "receita_total": _revenue(),
        "total_pedidos": _orders(),
        "ticket_medio": ticket,
        "review_medio": _mean("review_score_mean"),
        "percentual_pedidos_em_atraso": _late(),
    }
    return _total(fact, measures)


def revenue_over_time(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_pedidos": _orders(),
        "receita_total": _revenue(),
        "receita_media_por_item": _mean("total_item_value"),
    }
    by = {"mes_referencia": F.trunc("order_date", "month")}
    return _report(fact, by, measures, ["mes_referencia"], F.col("mes_referencia").isNotNull())


def top_10_categories_by_revenue(fact: DataFrame | Shared, limit: int = 10) -> DataFrame:
    measures = {
        "total_pedidos": _orders(),
        "receita_total": _revenue(),
        "ticket_medio_item": _mean("total_item_value"),
        "frete_medio": _mean("freight_value"),
        "percentual_atraso": _late(),
    }
    return _report(fact, {"categoria": _category()}, measures, ["-receita_total", "-total_pedidos"], limit=limit, grain=["category"])


def orders_by_status(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_pedidos": _orders(),
        "receita_total": _revenue(),
        "ticket_medio_item": _mean("total_item_value"),
    }
    return _report(fact, {"order_status": "order_status"}, measures, ["-receita_total", "-total_pedidos"])


def states_by_delay_pct(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_pedidos": _orders(),
        "receita_total": _revenue(),
        "ticket_medio_item": _mean("total_item_value"),
        "percentual_atraso": _late(),
    }
    known = F.col("customer_state").isNotNull()
    return _report(fact, {"customer_state": "customer_state"}, measures, ["-percentual_atraso", "-total_pedidos"], known)


def top_10_categories_by_mean_freight(fact: DataFrame | Shared, min_orders: int = 30, limit: int = 10) -> DataFrame:
    measures = {
        "total_pedidos": _orders(),
        "frete_medio": _mean("freight_value"),
        "receita_total": _revenue(),
    }
    having = F.col("total_pedidos") >= min_orders
    return _report(fact, {"categoria": _category()}, measures, ["-frete_medio", "-receita_total"], having, limit, ["category"])


def category_detail(fact: DataFrame | Shared) -> DataFrame:
    measures = {
        "total_pedidos": _orders(),
        "receita_total": _revenue(),
        "ticket_medio_item": _mean("total_item_value"),
        "frete_medio": _mean("freight_value"),
        "review_medio": _mean("review_score_mean"),
        "prazo_medio_entrega_dias": _mean("delivery_time_days"),
        "atraso_estimado_medio_dias": _mean("estimated_delay_days"),
        "percentual_atraso": _late(),
    }
    return _report(fact, {"categoria": _category()}, measures, ["-receita_total", "-total_pedidos"], grain=["category"])


REPORTS = {
    fn.__name__: fn
    for fn in (
        order_status_exploration,
        cleaning_audit_counters,
        kpi_row,
        monthly_series,
        top_20_categories,
        top_categories_by_revenue,
        monthly_revenue_evolution,
        revenue_by_state,
        delivery_delay_by_category,
        payment_method_distribution,
        executive_kpis_with_ticket,
        revenue_over_time,
        top_10_categories_by_revenue,
        orders_by_status,
        states_by_delay_pct,
        top_10_categories_by_mean_freight,
        category_detail,
    )
}
