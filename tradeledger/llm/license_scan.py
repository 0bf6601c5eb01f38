"""License scans: an exact set-similarity join of text blocks with license templates.

A text is cut into overlapping blocks of words, longer ones for longer templates. A block matches
a template if it contains at least the threshold's share of the template's distinct words. Words are ordered by how many
documents hold them, rarest first; a matching block must hold one of the template's first
words in that order (prefix filter), enough template words at all (length filter), and enough
of them from that word on (positional filter). What passes is counted exactly.

Base phrases are templates of threshold one whose words must, besides, stand consecutively.
Everything is built from column functions; only the counts of the templates' own words come
to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm.common import col

#: The smallest blocks have BLOCK words and begin every STRIDE words: any STRIDE + 1 words lie within
#: one. Longer templates are held against blocks of twice, four times ... that size.
BLOCK, STRIDE = 64, 32
THRESHOLD = 0.8
#: Up to so many prefix rows are literals of the plan and broadcast; more are a table that Spark joins as it sees fit.
MOST_PREFIXES = 10_000
#: Result columns; a kept column of such a name is left out.
MADE = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
MADE_BLOCKS = ("label", "share", "first_word", "last_word")
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # its words must stand consecutively

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def tokens(self) -> list[str]:
        return list(dict.fromkeys(self.words))

    @property
    def stride(self) -> int:
        """Words from block to block: the template's length fits in, wherever it begins."""
        stride = STRIDE
        while stride + 1 < len(self.words):
            stride *= 2
        return stride

    def needed(self, threshold: float) -> int:
        n = len(self.tokens)
        return n if self.phrase else max(math.ceil(threshold * n - 1e-9), 1)


#: Fixed values of the registered query: base phrases, then the method's own templates.
BASE = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
TEMPLATES = (
    Template("agpl", "affero general public license"),
    Template("apache-2-notice", "you may not use this file except in compliance with the license"),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc-text", "licensed under a creative commons attribution noncommercial license"),
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    # a whole license text
    Template(
        "mit-full",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
        "authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2"),
    Template("reserved", "copyright all rights reserved"),
)


def words(text: Column) -> Column:
    """Words of the lower-cased text, in order; none for null.

    ``lower`` turns one non-ASCII letter, the Kelvin sign, into an ASCII one; it is replaced
    by another letter first, so that only A-Z become a-z among ASCII letters.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(plain, NOT_WORD), "")


def global_order(texts: DataFrame, templates: tuple[Template, ...]) -> list[str]:
    """The templates' words, rarest first, by the number of documents that hold them."""
    vocabulary = sorted({t for template in templates for t in template.tokens})
    held = texts.select(F.explode(F.array_intersect(F.col("_words"), F.lit(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


PREFIX = "token string, template int, label string, phrase boolean, template_words array<string>, ordered array<string>, stride int, place int, needed int"


def prefix_rows(spark: SparkSession, templates: tuple[Template, ...], order: list[str], threshold: float) -> DataFrame:
    """One row per prefix word of each template, in global order; broadcast under a bound."""
    place = {w: i for i, w in enumerate(order)}
    rows = []
    for number, t in enumerate(templates):
        ordered = sorted(t.tokens, key=place.__getitem__)
        needed = t.needed(threshold)
        for i, word in enumerate(ordered[: len(ordered) - needed + 1]):
            rows.append((word, number, t.label, t.phrase, t.words, ordered, t.stride, i, needed))
    if len(rows) > MOST_PREFIXES:
        return spark.createDataFrame(rows, PREFIX)
    names = [field.split()[0] for field in PREFIX.split(", ")]
    literals = [F.struct(*[F.lit(v).alias(name) for name, v in zip(names, row)]) for row in rows]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*literals))))


def held_against(
    docs: DataFrame, templates: tuple[Template, ...], threshold: float, text: str, keep: list[str],
) -> DataFrame:
    """One row per block and template that pass the filters; a document's rows without a template keep it in the frame."""
    rows = docs.select(F.struct(*[col(c) for c in keep]).alias("_row"), words(col(text).cast("string")).alias("_words"))
    order = global_order(rows, templates)
    prefixes = prefix_rows(docs.sparkSession, templates, order, threshold)
    place = {w: i for i, w in enumerate(order)}

    # blocks around rare words of the templates of their size; all others can't match
    sizes = []
    for stride in sorted({t.stride for t in templates}):
        own = [t for t in templates if t.stride == stride]
        rare = sorted({w for t in own for w in sorted(t.tokens, key=place.__getitem__)[: len(t.tokens) - t.needed(threshold) + 1]})
        at = F.array_compact(F.transform("_words", lambda w, i: F.when(w.isin(rare), i)))
        numbers = F.flatten(F.transform(at, lambda i: F.array(F.floor(i / stride), F.floor(i / stride) - 1)))
        numbers = F.array_distinct(F.filter(numbers, lambda b: b >= 0))
        sizes.append(
            F.transform(
                numbers,
                lambda b: F.struct(F.lit(stride).alias("stride"), b.alias("number"), F.slice("_words", (b * stride + 1).cast("int"), 2 * stride).alias("words")),
            )
        )
    block = F.concat(*sizes)
    rows = rows.select("_row", F.size("_words").cast("long").alias("n_words"), block.alias("_blocks"))
    rows = rows.select(F.monotonically_increasing_id().alias("_id"), "_row", "n_words", "_blocks")
    blocks = rows.select("_id", "_row", "n_words", F.explode_outer("_blocks").alias("_block"))
    # a block's template words in global order
    held = F.filter(F.lit(order), lambda w: F.array_contains(F.col("_block.words"), w))
    blocks = blocks.withColumn("_held", F.when(F.col("_block").isNotNull(), held))
    probes = blocks.select("*", F.posexplode_outer("_held").alias("_at", "_token"))

    first = F.size(F.array_intersect(F.slice("ordered", 1, F.col("place")), F.col("_held"))) == 0  # each pair once
    length = F.size("_held") >= F.col("needed")
    position = 1 + F.least(F.size("ordered") - F.col("place") - 1, F.size("_held") - F.col("_at") - 1) >= F.col("needed")
    same = (F.col("_token") == F.col("token")) & (F.col("_block.stride") == F.col("stride"))
    joined = probes.join(prefixes, same & first & length & position, "left")

    overlap = F.size(F.array_intersect("ordered", "_held"))
    matches = overlap >= F.col("needed")
    starts = F.filter(
        F.sequence(F.lit(0), F.col("_block.stride") - 1),
        lambda s: F.slice(F.col("_block.words"), s + 1, F.size("template_words")) == F.col("template_words"),
    )
    starts = F.transform(starts, lambda s: F.col("_block.number") * F.col("_block.stride") + s)
    return joined.select(
        "_id", "_row", "n_words", (F.col("_block.number") * F.col("_block.stride")).alias("_begin"), F.col("_block.stride").alias("_stride"), "label", "phrase", F.coalesce(matches, F.lit(False)).alias("_match"),
        (overlap / F.size("ordered")).alias("_share"), F.when(F.col("phrase") & matches, starts).alias("_starts"),
    )


def matching_blocks(
    docs: DataFrame, templates: tuple[Template, ...] = BASE + TEMPLATES, threshold: float = THRESHOLD, text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The join itself: ``keep`` columns with label, share, first_word and last_word of every matching block.

    Words count from 0; share is the part of the template's words that the block holds. A
    phrase matches where its words stand consecutively, with share 1. Documents without a
    match (null and empty texts among them) have no row, repeated ones their own rows.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in MADE_BLOCKS]
    found = held_against(docs, templates, threshold, text, keep).filter("_match and (not phrase or size(_starts) > 0)")
    begin = F.col("_begin").cast("long")
    last = F.least(begin + 2 * F.col("_stride"), F.col("n_words")) - 1
    return found.select("_row.*", "label", F.col("_share").alias("share"), begin.alias("first_word"), last.alias("last_word"))


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = BASE + TEMPLATES, threshold: float = THRESHOLD, text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns with n_words, n_base, first_word, last_word, base_labels, labels and score.

    n_base counts all places of phrases; first_word and last_word are their smallest and
    largest start (null without one). labels has the phrases' labels and those of matching
    templates; score is the largest containment of a label (1 for a phrase, 0 for none). Null
    and empty texts have no words. Repeated rows each get their row.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in MADE]
    checked = held_against(docs, templates, threshold, text, keep)
    base = F.size("_starts") > 0
    template = F.col("_match") & ~F.col("phrase")
    found = checked.groupBy("_id").agg(
        F.first("_row").alias("_row"),
        F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(base, F.size("_starts"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(base, F.array_min("_starts"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.array_max("_starts"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("_base"),
        F.collect_set(F.when(base | template, F.col("label"))).alias("_labels"),
        F.coalesce(F.max(F.when(base, F.lit(1.0)).when(template, F.col("_share"))), F.lit(0.0)).alias("score"),
    )
    return found.select(
        "_row.*", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"), F.array_join(F.array_sort("_labels"), ",").alias("labels"), "score",
    )


def oracle(templates: tuple[Template, ...] = BASE + TEMPLATES, threshold: float = THRESHOLD, word_sql: str = "") -> str:
    """The registered query as a statement that holds every block against every template."""
    def array(values: list[str]) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    phrases = ", ".join(f"('{t.label}', {array(t.words)})" for t in templates if t.phrase)
    sets = ", ".join(f"('{t.label}', {array(t.tokens)}, {t.needed(threshold)}, {t.stride})" for t in templates if not t.phrase)
    strides = ", ".join(f"({s})" for s in sorted({t.stride for t in templates if not t.phrase}))
    return f"""
with d as (select row_number() over () as r, doc_id, {word_sql} as w from documents),
phrases(label, p) as (values {phrases}),
sets(label, s, needed, size) as (values {sets}),
sizes(size) as (values {strides}),
places as (
  select r, label, i - 1 as start from d, phrases, unnest(range(1, len(w) - len(p) + 2)) t(i)
  where list_contains(w, p[1]) and w[i:i + len(p) - 1] = p),
base as (
  select r, count(*) as n_base, min(start) as first_word, max(start) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels
  from places group by r),
blocks as (select r, size, w[b * size + 1:b * size + 2 * size] as words from d, sizes, unnest(range(0, (len(w) + size - 1) // size)) t(b)),
matched as (
  select r, label, len(list_intersect(list_distinct(words), s)) / len(s) as share from blocks join sets using (size)
  where len(list_intersect(list_distinct(words), s)) >= needed),
every as (select r, label, 1.0::double as share from places union all select r, label, share from matched),
labels as (select r, string_agg(distinct label, ',' order by label) as labels, max(share) as score from every group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
  cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
from d left join base using (r) left join labels using (r)
"""
