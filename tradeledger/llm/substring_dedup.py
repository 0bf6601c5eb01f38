"""Suffix-array dedup: bytes covered by a string of 50 that an earlier document has too.

Equal windows of 50 bytes must meet in one place without sending all windows around. Every
window elects an anchor, the 20-byte gram of the smallest hash inside it: equal windows elect
equal grams at equal offsets. An anchor's context (80 bytes around it) holds every window
that can have elected it. Three passes over the texts, which are dealt out once:

1. Hashes of grams and contexts go to buckets by gram. An anchor whose context an earlier
   document has is settled: all its windows repeat. A gram that only one document has, or one
   context, is settled too. The rest must be compared byte by byte.
2. The contexts of these go to the buckets. There the column-wise construction inserts one
   symbol of every context in each round, keeping sorted order and common prefixes; windows
   are equal where 50 symbols are common, and the smallest document of a run has them first.
3. Marked windows are cut out of the texts.

A gram that many documents have amid other text (the edges of a popular line) would gather in
one bucket. Such hot grams are listed from a sample; their contexts are dealt out by context,
and in the second pass their windows by hash, the smallest document of each task only.

Copies of a context within a task are settled before they are sent, so that a popular text or
passage is one entry per task in its bucket and not one per document; what is settled goes to
buckets by document and tag. Whole copies of an earlier document are found by their digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.column_bwt import repeated_windows
from tradeledger.llm.common import chunks, col
from tradeledger.session import stage

WINDOW, GRAM = 50, 20
OFFSETS = WINDOW - GRAM + 1  # places of the gram in a window
SIDE = OFFSETS - 1  # bytes of context on either side
CONTEXT = GRAM + 2 * SIDE
BLOCK = 1 << 17  # positions hashed together
BUCKET_BYTES = 8 << 20  # text whose anchors share a bucket, on average
HELD = 400_000  # entries a task holds before it sends them
#: A gram is hot if at least this share of the sampled documents has it in contexts of their own.
HOT_SHARE, HOT_SAMPLE, HOT_LEAST, HOT_MOST = 0.01, 4000, 32, 10_000
LAST = (1 << 63) - 1  # a null id comes after all others
FULL, NEED = 1, 2
TAG = 3  # bytes of a text's tag: 16 bits of its checksum, and a bit for a null id
NO_ID = 1 << 16
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def window_hashes(values: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Polynomial hashes of all windows of each length, put together from lengths of powers of two."""
    out: list[np.ndarray | None] = [None] * len(lengths)
    done = [0] * len(lengths)
    x, size = values, 1
    while size <= max(lengths):
        for i, n in enumerate(lengths):
            if n & size:
                if out[i] is None:
                    out[i] = x
                else:
                    m = len(x) - done[i]
                    out[i] = out[i][:m] * power(size) + x[done[i] :]
                done[i] += size
        x = x[:-size] * power(size) + x[size:] if len(x) > size else x[:0]
        size *= 2
    return [h[: max(len(values) - n + 1, 0)] for h, n in zip(out, lengths)]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


@dataclass
class Texts:
    """Texts one after the other with SIDE empty positions around each."""

    data: np.ndarray  # bytes, 0 in between
    start: np.ndarray
    end: np.ndarray
    last: np.ndarray  # for each position the end of its text, 0 in between

    @classmethod
    def of(cls, texts: list[bytes]) -> Texts:
        sizes = np.array([len(t) for t in texts], np.int64)
        gap = bytes(SIDE)
        data = np.frombuffer(gap + b"".join(x for t in texts for x in (t, gap)), np.uint8)
        start = SIDE + np.concatenate([[0], np.cumsum(sizes + SIDE)[:-1]]).astype(np.int64)
        end = start + sizes
        owned = np.empty(2 * len(texts) + 1, np.int64)
        owned[0::2], owned[1::2] = 0, end
        spread = np.empty(2 * len(texts) + 1, np.int64)
        spread[0::2], spread[1::2] = SIDE, sizes
        return cls(data, start, end, np.repeat(owned, spread))

    def windows_of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into ``place``, offset, 64-bit hash) of all windows around the given anchors."""
        which = np.repeat(np.arange(len(place)), OFFSETS)
        offset = np.tile(np.arange(OFFSETS), len(place))
        start = place[which] - SIDE + offset
        ok = (start >= 0) & (self.last[start] >= start + WINDOW)
        which, offset, start = which[ok], offset[ok], start[ok]
        value = np.zeros(len(start), np.uint64)
        for k in range(WINDOW):
            value = value * np.uint64(BASE) + self.data[start + k].astype(np.uint64) + np.uint64(1)
        return which, offset, mixed(value)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the anchors of all windows, hashes of their grams and of their contexts (48 bits)."""
        places, grams, contexts = [], [], []
        n = len(self.data)
        for a in range(0, n, BLOCK):
            b = min(a + BLOCK, n - WINDOW + 1)  # windows that start in [a, b)
            if b <= a:
                break
            inside = self.last[a:b] >= np.arange(a, b) + WINDOW
            if not inside.any():
                continue
            low, high = max(a - SIDE, 0), min(b + WINDOW + SIDE, n)
            values = np.where(self.last[low:high] > 0, self.data[low:high].astype(np.uint64) + np.uint64(1), np.uint64(0))
            gram, context = window_hashes(values, (GRAM, CONTEXT))
            gram = mixed(gram)
            first = a - low
            bits = np.uint64((1 << 19) - 1)
            keyed = (gram[first : first + b - a + OFFSETS - 1] & ~bits) | np.arange(first, first + b - a + OFFSETS - 1, dtype=np.uint64)
            best = (sliding_least(keyed, OFFSETS)[inside] & bits).astype(np.int64)
            at = best[np.concatenate([[True], best[1:] != best[:-1]])]
            places.append(at + low)
            grams.append(gram[at])
            contexts.append(mixed(context[at - SIDE]) >> np.uint64(16))
        if not places:
            empty = np.zeros(0, np.uint64)
            return empty.astype(np.int64), empty, empty
        place = np.concatenate(places)
        place, keep = np.unique(place, return_index=True)
        return place, np.concatenate(grams)[keep], np.concatenate(contexts)[keep]

    def owner(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, place, "right") - 1


def planes(values: np.ndarray, size: int) -> bytes:
    """``size`` low bytes of each value, first bytes first: shuffle compression likes them together."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def from_planes(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel()


def rising(values: np.ndarray) -> bytes:
    """Sorted ids as differences."""
    v = values.astype(np.int64).view(np.uint64)
    return planes(np.concatenate([v[:1], v[1:] - v[:-1]]), 8)


def from_rising(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, 8), dtype=np.uint64).view(np.int64)


def spread(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    """Part of each row. The tag deals the rows of one id, or of no id, over many parts."""
    return (mixed(mixed(doc.astype(np.int64).view(np.uint64)) + tag.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def cut(number: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, places) of each value, places in their order."""
    order = np.argsort(number, kind="stable")
    if len(order):
        for part in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
            yield int(number[part[0]]), part


def gathered(table: pa.Table, name: str, size: int) -> np.ndarray:
    parts = [from_planes(x, size) for x in table.column(name).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def gathered_docs(table: pa.Table, name: str = "docs") -> np.ndarray:
    parts = [from_rising(x) for x in table.column(name).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def batches_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


REQUEST = pa.schema([("bucket", pa.int64())] + [(n, pa.binary()) for n in ("docs", "tags", "grams", "contexts", "done_docs", "done_tags", "done_contexts")])
REPLY = pa.schema([("part", pa.int64())] + [(n, pa.binary()) for n in ("docs", "tags", "contexts", "states")])
STRINGS = pa.schema([("bucket", pa.int64())] + [(n, pa.binary()) for n in ("docs", "tags", "grams", "contexts", "sides", "strings", "done_docs", "done_tags", "done_contexts", "done_masks")])


def sql_schema(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.int32(): "int"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def is_hot(gram: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether each gram is in the sorted list ``hot``."""
    if not len(hot):
        return np.zeros(len(gram), bool)
    return hot[np.minimum(np.searchsorted(hot, gram), len(hot) - 1)] == gram


def sample_contexts(batches):
    """(gram, context) of each anchor, once per chunk."""
    for _, _, texts, _ in read(batches):
        _, gram, context = Texts.of(texts).anchors()
        pairs = np.unique(np.column_stack([gram, context]), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, i].astype(np.uint64).view(np.int64)) for i in (0, 1)], names=["gram", "context"])


def hot_grams(dealt: DataFrame, rows: int) -> np.ndarray:
    """Sorted grams that many documents have amid other text, such as the edges of a popular line.

    Counted on a sample of about HOT_SAMPLE texts, drawn by their checksum; at most HOT_MOST. The
    list only decides where a gram's contexts are compared, never what comes out.
    """
    limit = min(HOT_SAMPLE * NO_ID // max(rows, 1), NO_ID - 1)
    sample = dealt.filter(F.col("tag").bitwiseAND(NO_ID - 1) <= limit)
    pairs = sample.select("doc", "tag", "text").mapInArrow(sample_contexts, "gram long, context long").distinct()
    counts = pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    least = max(HOT_LEAST, int(HOT_SHARE * min(rows, HOT_SAMPLE)))
    found = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(HOT_MOST).collect()
    return np.sort(np.array([r["gram"] for r in found], np.int64).view(np.uint64))


def requests(n_buckets: int, hot: np.ndarray):
    """Pass 1: (doc, tag, text) to hashes by bucket; a hot gram's contexts go to buckets of their own."""

    def send(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, tag, gram, context = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, context, gram))
        doc, tag, gram, context = doc[order], tag[order], gram[order], context[order]
        new = np.ones(len(doc), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
        done = doc > doc[first]  # an earlier document here has the same context
        again = ~new & ~done  # the same document once more
        bucket = ((gram >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
        lone = is_hot(gram, hot)
        bucket[lone] = n_buckets + ((mixed(context[lone]) >> np.uint64(8)) % np.uint64(n_buckets)).astype(np.int64)
        bucket[done] = spread(doc[done], tag[done], n_buckets)
        rows = []
        use = np.flatnonzero(~again)
        for number, part in cut(bucket[use]):
            part = use[part]
            row = {"bucket": number}
            for sign, prefix in ((False, ""), (True, "done_")):
                own = part[done[part] == sign]
                own = own[np.argsort(doc[own], kind="stable")]
                row |= {f"{prefix}docs": rising(doc[own]), f"{prefix}tags": planes(tag[own], TAG), f"{prefix}contexts": planes(context[own], 6)}
                if not sign:
                    row["grams"] = planes(gram[own], 4)
            rows.append(row)
        return batches_of(rows, REQUEST)

    def run(batches):
        held, size = [], 0
        for docs, tags, texts, _ in read(batches):
            found = Texts.of(texts)
            place, gram, context = found.anchors()
            owner = found.owner(place)
            held.append((docs[owner], tags[owner], gram, context))
            size += len(place)
            if size >= HELD:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)

    return run


def read(batches) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes], list[list]]]:
    """Chunks of (doc, tag, text, ...) batches; further columns as lists."""
    for batch in batches:
        docs, tags = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False), np.int64) for i in (0, 1))
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        more = [batch.column(i).to_pylist() for i in range(3, batch.num_columns)]
        for a, b in chunks(texts):
            yield docs[a:b], tags[a:b].astype(np.uint64), texts[a:b], [m[a:b] for m in more]


def settle(n_parts: int):
    """Bucket of pass 1: which anchors repeat as a whole, and which contexts must be compared.

    Of a hot gram (buckets from ``n_parts`` on) all first contexts are compared.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hot = key[0].as_py() >= n_parts
        doc, tag = gathered_docs(table), gathered(table, "tags", TAG)
        gram, context = gathered(table, "grams", 4), gathered(table, "contexts", 6)
        order = np.lexsort((tag, doc, context, gram))
        doc, tag, gram, context = doc[order], tag[order], gram[order], context[order]
        n = len(doc)
        new_gram, new_context = np.ones(n, bool), np.ones(n, bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        new_context[1:] = new_gram[1:] | (context[1:] != context[:-1])
        state = np.zeros(n, np.uint64)
        if n:
            starts = np.flatnonzero(new_gram)
            of = np.cumsum(new_gram) - 1
            least = np.minimum.reduceat(doc, starts)[of]
            first = doc[np.maximum.accumulate(np.where(new_context, np.arange(n), 0))]
            full = doc > first
            open_ = np.zeros(len(starts), bool)
            open_[of[~full & (doc > least)]] = True
            open_ |= hot
            state[full] = FULL
            state[~full & open_[of]] = NEED
        use = state > 0
        done_doc, done_tag, done_context = gathered_docs(table, "done_docs"), gathered(table, "done_tags", TAG), gathered(table, "done_contexts", 6)
        doc, tag = np.concatenate([doc[use], done_doc]), np.concatenate([tag[use], done_tag])
        context = np.concatenate([context[use], done_context])
        state = np.concatenate([state[use], np.full(len(done_doc), FULL, np.uint64)])
        return replies(doc, tag, context, state, 1, n_parts)

    return run


def replies(doc: np.ndarray, tag: np.ndarray, context: np.ndarray, state: np.ndarray, state_size: int, n_parts: int) -> pa.Table:
    rows = []
    for number, part in cut(spread(doc, tag, n_parts)):
        part = part[np.argsort(doc[part], kind="stable")]
        rows.append({
            "part": number, "docs": rising(doc[part]), "tags": planes(tag[part], TAG), "contexts": planes(context[part], 6),
            "states": planes(state[part], state_size),
        })
    return pa.Table.from_pylist(rows, schema=REPLY)


PER_DOC = pa.schema([("r_doc", pa.int64()), ("r_tag", pa.int32()), ("keys", pa.binary()), ("states", pa.binary())])


def per_document(state_size: int):
    """All replies to the documents of one part, a row for each document."""

    def run(table: pa.Table) -> pa.Table:
        doc, tag = gathered_docs(table), gathered(table, "tags", TAG)
        context, state = gathered(table, "contexts", 6), gathered(table, "states", state_size)
        order = np.lexsort((state, context, tag, doc))
        doc, tag, context, state = doc[order], tag[order], context[order], state[order]
        if len(doc):  # a context may be answered in several buckets
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (context[1:] != context[:-1])
            state = np.bitwise_or.reduceat(state, np.flatnonzero(new))
            doc, tag, context = doc[new], tag[new], context[new]
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tag.astype(np.int64)) != 0)) + 1
        rows = [
            {"r_doc": int(doc[p[0]]), "r_tag": int(tag[p[0]]), "keys": planes(context[p], 6), "states": planes(state[p], state_size)}
            for p in np.split(np.arange(len(doc)), cuts)
            if len(p)
        ]
        return pa.Table.from_pylist(rows, schema=PER_DOC)

    return run


def answer(found: Texts, place: np.ndarray, context: np.ndarray, keys: list[bytes | None], states: list[bytes | None], state_size: int) -> np.ndarray:
    """The state sent for each anchor, 0 for none."""
    owner = found.owner(place).astype(np.uint64) << np.uint64(48)
    asked = [from_planes(k, 6) | np.uint64(i << 48) for i, k in enumerate(keys) if k]
    out = np.zeros(len(place), np.uint64)
    if not asked or not len(place):
        return out
    key = np.concatenate(asked)
    value = np.concatenate([from_planes(s, state_size) for s, k in zip(states, keys) if k])
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    at = np.minimum(np.searchsorted(key, owner | context), len(key) - 1)
    hit = key[at] == owner | context
    out[hit] = value[at[hit]]
    return out


#: A chunk's documents are numbered in 16 bits beside a 48-bit context.
MOST_DOCS = 1 << 15


def pieces(chunk):
    docs, tags, texts, more = chunk
    for a in range(0, len(texts), MOST_DOCS):
        b = a + MOST_DOCS
        yield docs[a:b], tags[a:b], texts[a:b], [m[a:b] for m in more]


def contexts(n_buckets: int, hot: np.ndarray):
    """Pass 2: the bytes of the contexts that must be compared, and the hashes of a hot gram's windows."""

    def send_windows(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        """Each window goes to a bucket by its hash, for the smallest document here; others are settled."""
        doc, tag, context, offset, window = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((offset, context, tag, doc, window))
        doc, tag, context, offset, window = doc[order], tag[order], context[order], offset[order], window[order]
        new = np.ones(len(doc), bool)
        new[1:] = window[1:] != window[:-1]
        done = doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        bucket = n_buckets + (window % np.uint64(n_buckets)).astype(np.int64)
        bucket[done] = n_buckets + spread(doc[done], tag[done], n_buckets)
        rows = []
        for number, part in cut(bucket):
            own, settled = part[~done[part]], part[done[part]]
            own, settled = own[np.argsort(doc[own], kind="stable")], settled[np.argsort(doc[settled], kind="stable")]
            rows.append({
                "bucket": number, "docs": rising(doc[own]), "tags": planes(tag[own], TAG), "contexts": planes(context[own], 6),
                "sides": planes(offset[own].astype(np.uint64), 2), "grams": planes(window[own], 8), "strings": b"",
                "done_docs": rising(doc[settled]), "done_tags": planes(tag[settled], TAG), "done_contexts": planes(context[settled], 6),
                "done_masks": planes(np.uint64(1) << offset[settled].astype(np.uint64), 4),
            })
        return batches_of(rows, STRINGS)

    def send(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, tag, gram, context, side, string = (np.concatenate(x) for x in zip(*held))
        rows = []
        for number, part in cut(((gram >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)):
            part = part[np.argsort(doc[part], kind="stable")]
            rows.append({
                "bucket": number, "docs": rising(doc[part]), "tags": planes(tag[part], TAG), "grams": planes(gram[part], 4),
                "contexts": planes(context[part], 6), "sides": planes(side[part], 2), "strings": string[part].tobytes(),
                "done_docs": b"", "done_tags": b"", "done_contexts": b"", "done_masks": b"",
            })
        return batches_of(rows, STRINGS)

    def run(batches):
        held, size, hot_held, hot_size = [], 0, [], 0
        for docs, tags, texts, (keys, states) in (p for c in read(batches) for p in pieces(c)):
            use = [i for i, x in enumerate(states) if x and NEED in x]
            if not use:
                continue
            docs, tags = docs[use], tags[use]
            texts, keys, states = ([x[i] for i in use] for x in (texts, keys, states))
            found = Texts.of(texts)
            place, gram, context = found.anchors()
            pick = np.flatnonzero(answer(found, place, context, keys, states, 1) == NEED)
            owner = found.owner(place[pick])
            # each context of a document once
            pick = pick[np.unique(owner.astype(np.uint64) << np.uint64(48) | context[pick], return_index=True)[1]]
            lone = is_hot(gram[pick], hot)
            apart, pick = pick[lone], pick[~lone]
            if len(apart):
                owner = found.owner(place[apart])
                which, offset, window = found.windows_of(place[apart])
                hot_held.append((docs[owner][which], tags[owner][which], context[apart][which], offset, window))
                hot_size += len(which)
                if hot_size >= HELD:
                    yield send_windows(hot_held)
                    hot_held, hot_size = [], 0
            owner, at = found.owner(place[pick]), place[pick]
            left = np.minimum(at - found.start[owner], SIDE)
            right = np.minimum(found.end[owner] - at - GRAM, SIDE)
            around = at[:, None] + np.arange(-SIDE, GRAM + SIDE)
            string = found.data[np.clip(around, 0, len(found.data) - 1)]
            held.append((docs[owner], tags[owner], gram[pick], context[pick], (left << 8 | right).astype(np.uint64), string))
            size += len(pick)
            if size >= HELD // 10:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)
        if hot_size:
            yield send_windows(hot_held)

    return run


def compare_windows(table: pa.Table, n_parts: int) -> pa.Table:
    """Bucket of a hot gram's windows: the smallest document of each hash has it first."""
    doc, tag, context = gathered_docs(table), gathered(table, "tags", TAG), gathered(table, "contexts", 6)
    offset, window = gathered(table, "sides", 2), gathered(table, "grams", 8)
    order = np.lexsort((doc, window))
    first = np.ones(len(order), bool)
    first[1:] = window[order][1:] != window[order][:-1]
    least = doc[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    use = order[doc[order] > least]
    return replies(
        np.concatenate([doc[use], gathered_docs(table, "done_docs")]),
        np.concatenate([tag[use], gathered(table, "done_tags", TAG)]),
        np.concatenate([context[use], gathered(table, "done_contexts", 6)]),
        np.concatenate([np.uint64(1) << offset[use], gathered(table, "done_masks", 4)]),
        4,
        n_parts,
    )


def compare(n_parts: int):
    """Bucket of pass 2: windows that an earlier document has, by columns."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() >= n_parts:
            return compare_windows(table, n_parts)
        doc, tag = gathered_docs(table), gathered(table, "tags", TAG)
        gram, context, side = gathered(table, "grams", 4), gathered(table, "contexts", 6), gathered(table, "sides", 2).astype(np.int64)
        string = np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, CONTEXT) for x in table.column("strings").to_pylist()])
        order = np.argsort(gram, kind="stable")
        doc, tag, gram, context, side, string = doc[order], tag[order], gram[order], context[order], side[order], string[order]
        left, right = side >> 8, side & 255
        at = np.arange(CONTEXT)
        outside = (at < SIDE - left[:, None]) | (at >= SIDE + GRAM + right[:, None])
        symbols = string.astype(np.int16) + 1
        symbols[outside] = 0
        group = np.cumsum(np.concatenate([[False], gram[1:] != gram[:-1]]))
        masks = repeated_windows(symbols, group, doc, WINDOW)
        for offset in range(OFFSETS):  # windows that leave the text are none
            gone = (offset < SIDE - left) | (offset + WINDOW > SIDE + GRAM + right)
            masks[gone] &= ~np.uint64(1 << offset)
        use = masks > 0
        return replies(doc[use], tag[use], context[use], masks[use], 4, n_parts)

    return run


def cover(found: Texts, place: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Bytes inside marked windows; bit o of an anchor's mask is the window that begins SIDE - o before it."""
    marks = np.zeros(len(found.data) + WINDOW, np.int32)
    for offset in range(OFFSETS):
        start = place[(masks >> np.uint64(offset) & np.uint64(1)).astype(bool)] - SIDE + offset
        start = start[start >= 0]
        start = start[found.last[start] >= start + WINDOW]
        start = np.unique(start)
        np.add.at(marks, start, 1)
        np.add.at(marks, start + WINDOW, -1)
    return np.cumsum(marks)[: len(found.data)] > 0


def cutter(batches):
    """Pass 3: (doc, tag, text, full keys, states, masked keys, masks, copy) to spans and kept bytes."""
    every = np.uint64((1 << OFFSETS) - 1)
    for docs, tags, texts, (keys, states, masked, masks, copies) in (p for c in read(batches) for p in pieces(c)):
        found = Texts.of(texts)
        if any(k or m for k, m in zip(keys, masked)):
            place, _, context = found.anchors()
            state = answer(found, place, context, keys, states, 1)
            marks = answer(found, place, context, masked, masks, 4)
            gone = cover(found, place, np.where(state == FULL, every, marks))
        else:
            gone = np.zeros(len(found.data), bool)
        spans, kept = [], []
        for i, text in enumerate(texts):
            a, b = int(found.start[i]), int(found.end[i])
            if copies[i] and len(text) >= WINDOW:
                spans.append([{"start": 0, "end": len(text)}])
                kept.append(b"")
                continue
            own = gone[a:b]
            if not own.any():
                spans.append([])
                kept.append(text)
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[0::2], edge[1::2])])
            kept.append(found.data[a:b][~own].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64(), mask=tags >= NO_ID), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, SPAN), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row: removed byte ranges and the bytes that stay.

    A byte goes if a string of 50 bytes around it also starts in a document of a smaller id,
    judged on the input. Null texts are empty. Null ids come after all others and are equal
    among themselves; documents of one id don't remove each other's text. Texts under 50
    bytes stay. Repeated rows each get their row.
    """
    number = F.coalesce(col(doc_id).cast("long"), F.lit(LAST))
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    tag = F.crc32(body.cast("binary")).bitwiseAND(NO_ID - 1).cast("int")
    # the same columns in all passes, so that the texts are dealt out once
    dealt = docs.select(number.alias("doc"), (tag + F.when(col(doc_id).isNull(), NO_ID).otherwise(0)).alias("tag"), body.alias("text"))

    narrow = dealt.select("doc", "tag", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), F.octet_length("text").cast("long").alias("size"))
    narrow = stage(narrow, "digests")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    n = max(int(total) // BUCKET_BYTES, 16)
    earliest = narrow.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc").alias("_least"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    copies = narrow.join(earliest, F.col("digest") == F.col("_digest")).filter(F.col("doc") > F.col("_least"))
    copies = copies.select(F.col("doc").alias("c_doc"), F.col("tag").alias("c_tag"), F.col("digest").alias("c_digest")).distinct()

    hot = hot_grams(dealt, narrow.count())
    sent = dealt.mapInArrow(requests(n, hot), sql_schema(REQUEST))
    settled = sent.groupBy("bucket").applyInArrow(settle(n), sql_schema(REPLY))
    settled = stage(settled.groupBy("part").applyInArrow(per_document(1), sql_schema(PER_DOC)), "settled")

    dealt = dealt.repartition(max(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "doc", "tag")
    answered = (F.col("doc") == F.col("r_doc")) & (F.col("tag") == F.col("r_tag"))
    asked = dealt.join(settled, answered, "left")
    # tasks that run again must see the same rows together
    strings = asked.select("doc", "tag", "text", "keys", "states").sortWithinPartitions("doc", "tag")
    strings = strings.mapInArrow(contexts(n, hot), sql_schema(STRINGS))
    masks = strings.groupBy("bucket").applyInArrow(compare(n), sql_schema(REPLY))
    masks = masks.groupBy("part").applyInArrow(per_document(4), sql_schema(PER_DOC))
    masks = masks.select(F.col("r_doc").alias("m_doc"), F.col("r_tag").alias("m_tag"), F.col("keys").alias("m_keys"), F.col("states").alias("masks"))

    joined = dealt.join(settled, answered, "left")
    joined = joined.join(masks, (F.col("doc") == F.col("m_doc")) & (F.col("tag") == F.col("m_tag")), "left")
    # a tag is not enough here: a row is a copy only if its own digest is. The digest is compared
    # as a range, since as a third join key it would have the texts dealt out again
    same = (F.col("digest") >= F.col("c_digest")) & (F.col("digest") <= F.col("c_digest"))
    copied = (F.col("doc") == F.col("c_doc")) & (F.col("tag") == F.col("c_tag")) & same
    joined = joined.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))).join(copies, copied, "left")
    joined = joined.select("doc", "tag", "text", "keys", "states", "m_keys", "masks", F.col("c_doc").isNotNull().alias("copy"))
    return joined.mapInArrow(cutter, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
