"""Aggregates that many reports share: one pass for all groupings instead of one scan a report.

Rows are reduced to mergeable states (sums of whole numbers, counts, maxima) once, at the finest
grouping, and rolled up by grouping sets. Distinct counts are exact: a second aggregate has a row for
each entity with the sets of its keys, merged before its shuffle, so a hot key or entity stays spread.
The result has a row a group, and reports are projections of it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.session import stage

MILLION = 1e6
GRAIN = "_grain"


class State(NamedTuple):
    """A row's share of a measure and how shares merge: ``sum``, ``count`` (a sum that is 0 without rows) or ``max``."""

    value: Column
    merge: str = "sum"


def double_states(name: str, value: Column | str) -> dict[str, State]:
    """Parts of an order-independent sum of doubles, and the number of values."""
    c = F.col(value) if isinstance(value, str) else value
    first = (c - F.floor(c)) * MILLION
    second = (first - F.floor(first)) * MILLION
    return {
        f"{name}_0": State(F.floor(c)),
        f"{name}_1": State(F.floor(first)),
        f"{name}_2": State(F.floor(second)),
        f"{name}_n": State(F.when(c.isNotNull(), 1).otherwise(0).cast("long"), "count"),
    }


def double_sum(name: str) -> Column:
    return F.col(f"{name}_0") + (F.col(f"{name}_1") + F.col(f"{name}_2") / MILLION) / MILLION


def double_mean(name: str) -> Column:
    return double_sum(name) / F.greatest(F.col(f"{name}_n"), F.lit(1))


def rows_where(condition: Column) -> State:
    return State(F.when(condition, 1).otherwise(0).cast("long"), "count")


def _merged(name: str, state: State, value: Column) -> Column:
    if state.merge == "max":
        return F.max(value).alias(name)
    total = F.sum(value)
    return (F.coalesce(total, F.lit(0).cast("long")) if state.merge == "count" else total).alias(name)


class Shared:
    """The staged table of all groups, and views of it."""

    def __init__(self, table: DataFrame, keys: list[str], grains: dict[str, list[str]], states: dict[str, State]) -> None:
        self.table, self.keys, self.grains, self.states = table, keys, grains, states

    def grain(self, by: list[str]) -> DataFrame:
        """Groups of the grouping by the keys ``by``: its keys and states."""
        name = next(n for n, keys in self.grains.items() if set(keys) == set(by))
        rows = self.table.filter(F.col(GRAIN) == name)
        if by:
            return rows.select(*by, *[c for c in self.table.columns if c not in self.keys and c != GRAIN])
        # one row also for an empty table
        made = [c for c in self.table.columns if c not in self.keys and c != GRAIN]
        default = {n for n in made if n not in self.states or self.states[n].merge == "count"}
        return rows.agg(*[(F.coalesce(F.max(n), F.lit(0).cast("long")) if n in default else F.max(n)).alias(n) for n in made])


def _grain_name(grains: dict[str, list[str]], keys: list[str], grouping: Column) -> Column:
    """Name of a grouping from its grouping id: a bit for each key that it leaves out, the first key highest."""
    name = None
    for n, own in grains.items():
        bits = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own)
        name = F.when(grouping == bits, n) if name is None else name.when(grouping == bits, n)
    return name


def _counted(entities: DataFrame, names: list[str], grains: dict[str, list[str]], distinct: dict[str, tuple[Column, list[str]]]) -> DataFrame:
    """(grain, kind, key, number of entities) of every grain that a kind of entity is counted for.

    Rows merge to one an entity with the sets of its keys, a set for each grain: only these are shuffled, and
    a set has no more members than the grain has groups.
    """
    types = dict(entities.dtypes)
    kinds = []
    for kind, (_, wanted) in distinct.items():
        used = {k for g in wanted for k in grains[g]}
        own = [(F.col(k) if k in used else F.lit(None).cast(types[k])).alias(k) for k in names]
        kinds.append(F.struct(F.lit(kind).alias("_kind"), F.col(f"_e_{kind}").alias("_entity"), *own))
    each = entities.select(F.inline(F.array(*kinds))).filter(F.col("_entity").isNotNull())

    def group_of(g: str) -> Callable[[Column], Column]:
        return lambda key: F.struct(
            F.lit(g).alias(GRAIN), *[(key[k] if k in grains[g] else F.lit(None).cast(types[k])).alias(k) for k in names]
        )

    sets, members = [], []
    for i, g in enumerate(dict.fromkeys(g for _, wanted in distinct.values() for g in wanted)):
        asked = F.col("_kind").isin([kind for kind, (_, wanted) in distinct.items() if g in wanted])
        sets.append(F.collect_set(F.when(asked, F.struct(F.lit(0).alias("_"), *grains[g]))).alias(f"_s{i}"))
        members.append(F.transform(f"_s{i}", group_of(g)))
    met = each.groupBy("_kind", "_entity").agg(*sets).select("_kind", F.inline(F.concat(*members)))
    return met.groupBy(GRAIN, "_kind", *names).agg(F.count(F.lit(1)).alias("_n"))


def share(
    rows: DataFrame,
    keys: dict[str, Column],
    grains: dict[str, list[str]],
    states: dict[str, State],
    distinct: dict[str, tuple[Column, list[str]]],
    cells: bool = True,
) -> Shared:
    """All ``grains`` (lists of ``keys``) of ``rows`` with their ``states`` and exact ``distinct`` counts.

    ``distinct`` names for each count the entity (nulls do not count) and the grains that need it.
    With ``cells`` rows are first merged by all keys together: that pays off where the keys have
    far fewer combinations than there are rows.
    """
    names = list(keys)
    keyed = [c.alias(k) for k, c in keys.items()]
    own = rows.select(*keyed, *[s.value.alias(n) for n, s in states.items()])
    if cells:
        own = own.groupBy(*names).agg(*[_merged(n, s, F.col(n)) for n, s in states.items()])
    merged = [_merged(n, s, F.col(n)) for n, s in states.items()]
    sets = [[F.col(k) for k in own_keys] for own_keys in grains.values()]
    rolled = own.groupingSets(sets, *[F.col(k) for k in names]).agg(F.grouping_id().alias("_id"), *merged)
    nothing = [F.lit(None).cast("long").alias(n) for n in distinct]
    made = rolled.select(_grain_name(grains, names, F.col("_id")).alias(GRAIN), *names, *states, *nothing)

    if distinct:
        counted = _counted(rows.select(*keyed, *[e.cast("string").alias(f"_e_{k}") for k, (e, _) in distinct.items()]), names, grains, distinct)
        empty = [F.lit(None).cast(t).alias(n) for n, t in made.dtypes if n in states]
        counts = [F.when(F.col("_kind") == k, F.col("_n")).alias(k) for k in distinct]
        both = made.unionByName(counted.select(GRAIN, *names, *empty, *counts))
        ends = [_merged(n, s, F.col(n)) for n, s in states.items()]
        ends += [F.coalesce(F.sum(k), F.lit(0).cast("long")).alias(k) for k in distinct]
        made = both.groupBy(GRAIN, *names).agg(*ends)
    return Shared(stage(made, "shared-aggregates"), names, grains, states)
