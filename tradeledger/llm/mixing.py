"""Mixing sources to target weights by capped water-filling.

Sources share the budget by weight. None may be repeated more than ``max_epochs`` times: what
a capped source cannot take goes to the others by weight, until nothing is above its cap. In
order of size over weight the capped sources are a prefix, so the feasible level follows from
running sums, in whole numbers and without rounding between rounds.

A source's target is whole repetitions of all its documents and a fraction: the documents that
come first in a seeded order, up to the word at which the fraction is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.common import col, free_name
from tradeledger.operators.ordered import running_total
from tradeledger.session import stage

#: A plan has one row per source; more sources than this are joined without a broadcast.
BROADCAST_SOURCES = 10_000
#: Result columns; a kept column of such a name is left out.
MADE = ("size", "source_size", "target", "copies", "taken")


def words(text: Column) -> Column:
    """Number of runs of other characters than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets from a frame (source, source_size) of one row per source.

    Weights repeat ``cycle`` over the sources by code point, null last; the budget is the sum
    of all sizes. Adds weight and target (double).
    """
    name = F.col("source").asc_nulls_last()
    numbered = running_total(sources.withColumn("_one", F.lit(1).cast("long")), [name], "_one", "_place")
    weight = F.element_at(F.array(*[F.lit(c) for c in cycle]), ((F.col("_place") - 1) % len(cycle) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    zero = F.lit(0).cast("long")
    # in order of size over weight; sums by range partitions, however many sources there are
    weighed = numbered.withColumn("weight", weight.cast("long")).withColumns({"_cap": cap, "_fill": F.col("source_size") / F.col("weight")})
    fills = [F.col("_fill"), name]
    summed = running_total(running_total(weighed, fills, "_cap", "_caps"), fills, "weight", "_upto")
    sums = weighed.agg(F.sum("source_size").alias("_budget"), F.sum("weight").alias("_all"))
    whole = summed.crossJoin(F.broadcast(sums)).select(
        "source", "source_size", "weight", "_budget",
        (F.col("_caps") - F.col("_cap")).alias("_below"),
        (F.col("_all") - F.col("_upto") + F.col("weight")).alias("_open"),
    )
    wide = "decimal(38,0)"
    share = (F.col("_budget") - F.col("_below")).cast(wide) * F.col("weight").cast("decimal(9,0)")
    capped = whole.withColumn("_capped", share >= cap.cast(wide) * F.col("_open").cast("decimal(18,0)"))
    # the level of the rest, once the capped ones are full
    rest = capped.agg(
        (F.max("_budget") - F.sum(F.when(F.col("_capped"), cap).otherwise(zero))).alias("_left"),
        F.sum(F.when(F.col("_capped"), zero).otherwise(F.col("weight"))).alias("_weights"),
    )
    capped = capped.crossJoin(F.broadcast(rest))
    filled = (F.col("_left") * F.col("weight")).cast("double") / F.col("_weights").cast("double")
    target = F.when(F.col("_capped"), cap.cast("double")).otherwise(filled)
    return capped.select("source", "source_size", "weight", target.alias("target"))


def draw_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Seeded place of a document in its source; only rows alike in id and text share it."""
    none = F.lit("")
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), none), F.coalesce(text, none)).cast("binary"))


def mixing_plan(sized: DataFrame, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source: source_size, weight, target, whole repetitions and the last drawn key.

    ``sized`` has source, size and _key. The key at which the running size of a source comes
    closest to the fraction is found by range partitions, so that a source with a third of all
    rows is summed by many tasks.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = water_fill(sources, max_epochs, cycle)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("whole", epochs.cast("long"))
    plan = plan.withColumn("_part", F.col("target") - F.col("whole") * F.col("source_size"))
    # rows alike share a key: as many of them are drawn as come closest
    keyed = sized.filter("size > 0").groupBy("source", "_key").agg(F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    running = running_total(keyed, ["_key"], "_sum", "_upto", ["source"])
    plan = stage(plan, "mixing-targets")
    wanted = plan.select(F.col("source").alias("_source"), "_part")
    if plan.count() <= BROADCAST_SOURCES:
        wanted = F.broadcast(wanted)
    drawn = running.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    take = F.floor((F.col("_part") - (F.col("_upto") - F.col("_sum"))) * F.col("_n") / F.col("_sum") + 0.5)
    drawn = drawn.withColumn("_take", take).filter("_take >= 1")
    last = drawn.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("_key", "_take", "_n")).alias("_l"))
    last = last.select("_source", F.col("_l._key").alias("_last"), F.least("_l._take", "_l._n").alias("_take"), (F.col("_l._take") < F.col("_l._n")).alias("_some"))
    return plan.join(last, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source", "_part")


def mix(
    docs: DataFrame, seed: int = 42, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3), text: str = "text",
    source: str = "source", doc_id: str = "doc_id", keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns with size, source_size, target, copies and taken (copies times size).

    copies is how often the mix repeats the document, at most ``max_epochs``. The draw depends
    on seed, id and text alone, so reruns agree. Null and empty texts have size 0 and are
    never drawn; null sources are one source, the last. An empty table gives no rows. Of rows
    alike in id and text at the end of the draw only some are drawn, whichever of them.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in MADE]
    made = {"size": words(col(text)), "_key": draw_key(col(doc_id), col(text), seed), "_from": col(source)}
    sized = docs.select(F.struct(*[col(c) for c in keep]).alias("_row"), *[v.alias(k) for k, v in made.items()])
    # words are counted and keys made once for the plan, and once for the result
    narrow = stage(sized.select(F.col("_from").alias("source"), "size", "_key"), "mixing-sizes")
    plan = stage(mixing_plan(narrow, max_epochs, cycle), "mixing-plan")
    bounded = plan.count() <= BROADCAST_SOURCES
    joined = sized.join(F.broadcast(plan) if bounded else plan, F.col("_from").eqNullSafe(F.col("source")))
    if plan.filter("_some").isEmpty():
        joined = joined.withColumn("_drawn", F.coalesce(F.col("_key") <= F.col("_last"), F.lit(False)))
    else:
        # rows alike at the end of a draw are numbered, by ranges: a group may be very large
        at_end = F.coalesce((F.col("_key") == F.col("_last")) & F.col("_some"), F.lit(False))
        ends = stage(joined.filter(at_end), "mixing-ends").withColumns({"_id": F.monotonically_increasing_id(), "_one": F.lit(1).cast("long")})
        ends = running_total(ends, ["_id"], "_one", "_place", ["_key"]).withColumn("_drawn", F.col("_place") <= F.col("_take"))
        rest = joined.filter(~at_end).withColumn("_drawn", F.coalesce(F.col("_key") <= F.col("_last"), F.lit(False)))
        joined = rest.unionByName(ends.drop("_id", "_one", "_place"))
    copies = F.col("whole") + F.col("_drawn").cast("long")
    return joined.select(
        "_row.*", "size", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long").alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col("size"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mixed corpus: every row of :func:`mix` as often as it is taken; rows of 0 copies go."""
    names = mixed.columns
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias(free_name(mixed, "time"))
    return mixed.filter("copies > 0").select(*[col(c) for c in names], times).select(*[col(c) for c in names])
