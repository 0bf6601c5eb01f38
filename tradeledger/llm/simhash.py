"""SimHash near-duplicates with pigeonring filtering.

The 64 bits of a fingerprint form a ring of segments. If two fingerprints differ in at most
``max_bits`` bits, then on some start of the ring every chain of consecutive segments has a
cumulative difference within its proportional budget. Chains whose budget is below one bit
are equal: their bits are the join key. The longer chains are tested bit by bit before the
full distance.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.llm.common import col, map_texts
from tradeledger.session import stage

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, words: int = 3, seed: int = SEED) -> int:
    """SimHash over the XXH64 of all word shingles, repeats included; 0 for a text without words."""
    tokens = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens])
        begin = [0, *ends[: len(tokens) - words].tolist()]
        stop = (ends[words - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin, stop)), np.uint64, len(stop))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "fp", words: int = 3) -> DataFrame:
    """``keep`` columns and the fingerprint as a signed long."""

    def make():
        return lambda texts: [[signed(fingerprint(t, words)) for t in texts]]

    return map_texts(docs, text, [T.StructField(name, T.LongType())], make, keep)


def rotated(x: Column, start: int, width: int) -> Column:
    """``x`` with segment ``start`` moved to the lowest bits."""
    if start == 0:
        return x
    return F.shiftrightunsigned(x, start * width).bitwiseOR(F.shiftleft(x, BITS - start * width))


def low_bits(n: int) -> Column:
    return F.lit(signed((1 << n) - 1)).cast("long")


class Ring:
    """Chain budgets of ``segments`` segments for at most ``max_bits`` differing bits."""

    def __init__(self, segments: int = 8, max_bits: int = 3) -> None:
        if BITS % segments or max_bits >= segments:
            raise ValueError("segments must divide 64 and outnumber the differing bits")
        self.segments, self.max_bits, self.width = segments, max_bits, BITS // segments
        self.budget = [length * max_bits // segments for length in range(segments + 1)]
        self.equal = self.budget.count(0) - 1  # chain that must be equal
        self.single = sum(b <= 1 for b in self.budget) - 1  # chain with one differing bit at most

    def keys(self, fp: Column) -> Column:
        """Join keys: start and blanked segment, the equal chain, and the chain of budget one but for that segment.

        At most one bit differs in the second chain, so two fingerprints that pass agree once
        the segment that holds the bit is blanked.
        """
        made = []
        chain = low_bits(self.single * self.width)
        for start in range(self.segments):
            turned = rotated(fp, start, self.width).bitwiseAND(chain)
            for blank in range(self.equal, max(self.single, self.equal + 1)):
                segment = F.lit(signed(~(((1 << self.width) - 1) << (blank * self.width)) & ((1 << BITS) - 1))).cast("long")
                made.append(F.struct(F.lit(start * self.segments + blank).cast("short").alias("slot"), turned.bitwiseAND(segment).alias("key")))
        return F.array(*made)

    def passes(self, x: Column, start: int) -> Column:
        """Every chain from ``start`` is within its budget; a chain is tested where the budget next rises."""
        turned = rotated(x, start, self.width)
        made = F.lit(True)
        for length in range(1, self.segments + 1):
            if length == self.segments or self.budget[length + 1] > self.budget[length]:
                part = turned.bitwiseAND(low_bits(length * self.width)) if length < self.segments else turned
                made = made & (F.bit_count(part) <= self.budget[length])
        return made

    def slot(self, x: Column) -> Column:
        """The one slot that reports a pair with difference ``x``: its first passing start, and the blank that hides the bit."""
        whole = None
        for start in range(self.segments):
            turned = rotated(x, start, self.width)
            blank = F.lit(start * self.segments + self.equal)
            for at in range(self.equal + 1, self.single):
                segment = F.lit(signed(((1 << self.width) - 1) << (at * self.width))).cast("long")
                blank = F.when(turned.bitwiseAND(segment) != 0, F.lit(start * self.segments + at)).otherwise(blank)
            whole = F.when(self.passes(x, start), blank) if whole is None else whole.when(self.passes(x, start), blank)
        return whole


def links(fingerprints: DataFrame, ring: Ring) -> DataFrame:
    """All pairs (a, b) of different fingerprints (column fp, distinct) within the distance, each once, a < b."""
    keyed = fingerprints.select("fp", F.explode(ring.keys(F.col("fp"))).alias("k")).select("k.slot", "k.key", "fp")
    left, right = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
    x = F.col("a").bitwiseXOR(F.col("b"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(x) <= ring.max_bits)
    joined = left.alias("l").join(
        right.alias("r"),
        (F.col("l.slot") == F.col("r.slot")) & (F.col("l.key") == F.col("r.key")) & close & (ring.slot(x) == F.col("l.slot")),
    )
    return joined.select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge (a, b).

    Alternates large and small stars until the edges stay the same. A round is two
    aggregations and joins, written to the shared folder; a hub is a minimum per task.
    """
    now, before = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        small = star(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = stage(small.filter("a <> b").distinct(), "edges")
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = tuple(found)


def star(edges: DataFrame) -> DataFrame:
    """(u, v, m) for each edge u = a, v = b, with m the smallest of u and its neighbours."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("_m"))
    joined = edges.select(F.col("a").alias("_u"), F.col("b").alias("v")).join(least, F.col("_u") == F.col("u"))
    return joined.select("u", "v", F.least("u", "_m").alias("m"))


def roots(fingerprinted: DataFrame, max_bits: int = 3, segments: int = 8) -> DataFrame:
    """(node, root) of every fingerprint that has a link; ``fingerprinted`` has a column fp."""
    distinct = stage(fingerprinted.select("fp").distinct(), "fingerprints")
    return components(links(distinct, Ring(segments, max_bits)))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, max_bits: int = 3, segments: int = 8
) -> DataFrame:
    """(doc_id, fingerprint of 16 hex digits, component_id) for every row.

    component_id is the smallest doc_id that links of at most ``max_bits`` bits reach. Equal
    fingerprints are one node, so exact copies are never paired. Texts without words (null,
    empty) have fingerprint zero and link like any other. Null ids belong to their group but
    never name it, unless it has no other. Repeated rows each get their row.
    """
    ids = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    own = stage(with_fingerprint(ids, "text", ["doc_id"], words=words), "simhash")
    found = stage(roots(own, max_bits, segments), "roots")
    # first one row per fingerprint, so that a large group of copies is one row
    least = own.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    grouped = least.join(found, F.col("fp") == F.col("node"), "left")
    grouped = grouped.select("fp", "_least", F.coalesce("root", "fp").alias("root"))
    named = grouped.groupBy(F.col("root").alias("_root")).agg(F.min("_least").alias("component_id"))
    of_fp = grouped.join(named, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    return own.join(of_fp, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 3, max_bits: int = 3, segments: int = 8
) -> DataFrame:
    """The rows of ``docs``, one of each group: smallest doc_id (null last), then smallest text digest.

    Rows alike in id and text count as one; the first by all columns (as JSON) stays.
    """
    digest = F.md5(F.coalesce(col(text).cast("string"), F.lit("")).cast("binary"))
    ids = docs.select(col(doc_id).alias("doc_id"), digest.alias("digest"), col(text).alias("text"))
    own = stage(with_fingerprint(ids, "text", ["doc_id", "digest"], words=words), "simhash")
    found = roots(own, max_bits, segments)
    alike = own.groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    # smallest row of each fingerprint first, then of each component
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "n")
    least = alike.groupBy("fp").agg(F.min(order).alias("row"))
    grouped = least.join(found, F.col("fp") == F.col("node"), "left")
    chosen = grouped.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("row").alias("row"))
    chosen = stage(chosen.select(F.col("row.doc_id").alias("_i"), F.col("row.digest").alias("_d"), F.col("row.n").alias("_n")), "chosen")
    kept = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(doc_id).alias("_id"), digest.alias("_digest"))
    kept = kept.join(chosen, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_digest") == F.col("_d")))
    if chosen.filter("_n > 1").isEmpty():
        return kept.select("row.*")
    # of rows alike in id and text the first by all columns
    several = kept.filter("_n > 1").groupBy("_id", "_digest").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.filter("_n = 1").select("row.*").unionAll(several.select("row.*"))
