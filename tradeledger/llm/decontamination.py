"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded batch of documents inside a task. Words become numbers of the benchmark's
vocabulary; a word the benchmark does not have ends a string, because no window can hold it.
The shard's strings (those at least as long as the shortest window) are sorted into a suffix
array, whose Burrows-Wheeler transform is kept in a wavelet matrix. All windows are searched
backwards at once if the shard has their last words at all, occurrences are located through sampled suffix positions, and the words
they cover are merged into removal spans.

The benchmark is read in blocks of bounded size, each broadcast on its own and held against
all documents; one block is one pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.llm.common import col, free_name, map_texts, ragged, safe_names
from tradeledger.session import stage

WINDOW = 10
#: Words of benchmark text in one broadcast block.
BLOCK_WORDS = 1_000_000
#: Words of one index; longer strings are cut with an overlap.
SHARD_WORDS = 1 << 20
SAMPLE_EVERY = 8
#: Last words of a window that a shard must have together, and the bits of their hash.
PROBE_WORDS, PROBE_BITS = 4, 24

#: Bytes to words: A-Z lower-cased, everything that is no word character to a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class WaveletMatrix:
    """Rank over a sequence of small numbers: a bit vector per binary digit, counted in words of 64 bits."""

    def __init__(self, values: np.ndarray, size: int) -> None:
        self.levels = max(int(size - 1).bit_length(), 1)
        self.bits: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            ones = (values >> level & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(int(len(values) - ones.sum()))
            values = np.concatenate([values[~ones], values[ones]])

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level in front of ``at``."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.bits[level][word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in front of its ``at``."""
        begin = np.zeros_like(at)
        for level in range(self.levels):
            set_bit = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            one_at, one_begin = self.ones(level, at), self.ones(level, begin)
            at = np.where(set_bit, self.zeros[level] + one_at, at - one_at)
            begin = np.where(set_bit, self.zeros[level] + one_begin, begin - one_begin)
        return at - begin

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs in front of it."""
        symbol, begin = np.zeros_like(at), np.zeros_like(at)
        for level in range(self.levels):
            bit = (self.bits[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            one_at, one_begin = self.ones(level, at), self.ones(level, begin)
            at = np.where(bit, self.zeros[level] + one_at, at - one_at)
            begin = np.where(bit, self.zeros[level] + one_begin, begin - one_begin)
            symbol = symbol << 1 | bit
        return symbol, at - begin


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Sorted suffixes of strings ended by 0; equal ones stay in the order of their ends.

    Prefix doubling: only suffixes that still share their place with others are compared on.
    """
    n = len(text)
    bits, place = max(int(size - 1).bit_length(), 1), max(n.bit_length(), 1)
    first = max(min((62 - place) // bits, 8), 1)
    padded = np.concatenate([text, np.zeros(first, np.int64)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)  # no string end so far
    for k in range(first):
        symbol = padded[k : k + n]
        key = key << bits | np.where(open_, symbol, 0)
        open_ &= symbol != 0
    packed = np.sort(key << place | np.arange(n))
    order, sorted_key = packed & ((1 << place) - 1), packed >> place
    new = np.ones(n, bool)
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~open_[order[1:]] | ~open_[order[:-1]]
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = group
    length = first
    alone = new & np.concatenate([new[1:], [True]])
    slots = np.flatnonzero(~alone)
    while len(slots):
        suffix = order[slots]
        second = rank[suffix + length]  # such a suffix has no end within ``length`` symbols
        by = np.lexsort((second, group[slots]))
        suffix, second, own = suffix[by], second[by], group[slots]
        order[slots] = suffix
        new = np.ones(len(slots), bool)
        new[1:] = (own[1:] != own[:-1]) | (second[1:] != second[:-1])
        group[slots] = np.maximum.accumulate(np.where(new, slots, 0))
        rank[suffix] = group[slots]
        alone = new & np.concatenate([new[1:], [True]])
        slots = slots[~alone]
        length *= 2
    return order


class FmIndex:
    """Search index of a collection of strings of numbers from 1, each ended by 0."""

    def __init__(self, text: np.ndarray, size: int) -> None:
        order = suffix_array(text, size)
        before = text[order - 1]  # the symbol in front; the first string is preceded by the last end
        self.matrix = WaveletMatrix(before, size)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        starts = np.ones(len(text), bool)
        starts[1:] = text[:-1] == 0  # walks end at the start of a string at the latest
        sampled = (starts | (np.arange(len(text)) % SAMPLE_EVERY == 0))[order]
        self.samples = order[sampled]
        self.marks = WaveletMatrix(sampled.astype(np.int64), 2)
        self.size = len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of all patterns of one length, found from their last word to their first."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size)
        alive = np.arange(len(patterns))
        for k in reversed(range(patterns.shape[1])):
            symbol = patterns[alive, k]
            low[alive] = self.first[symbol] + self.matrix.rank(symbol, low[alive])
            high[alive] = self.first[symbol] + self.matrix.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled one."""
        found = np.zeros(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            mark, rank = self.marks.access_rank(at)
            done = mark == 1
            found[left[done]] = self.samples[rank[done]] + steps
            left, at, steps = left[~done], at[~done], steps + 1
            symbol, rank = self.matrix.access_rank(at)
            at = self.first[symbol] + rank
        return found


@dataclass
class Block:
    """A bounded part of the benchmark: its words as numbers, and its distinct windows by length.

    Windows are places in ``words``; ``owners`` has for each window the items that have it, as
    offsets and item numbers. ``probes`` hashes the last words of each window.
    """

    vocabulary: dict[bytes, int]
    words: np.ndarray
    windows: dict[int, np.ndarray]
    owners: dict[int, tuple[np.ndarray, np.ndarray]]
    names: list[str]
    probes: dict[int, np.ndarray]

    @property
    def shortest(self) -> int:
        return min(self.windows)

    def patterns(self, length: int, which: np.ndarray) -> np.ndarray:
        return self.words[self.windows[length][which][:, None] + np.arange(length)].astype(np.int64)

    def items(self, length: int, window: int) -> list[str]:
        offsets, items = self.owners[length]
        return [self.names[i] for i in items[offsets[window] : offsets[window + 1]].tolist()]


def hashed(columns: list[np.ndarray]) -> np.ndarray:
    """PROBE_BITS bits of the numbers that stand together in the columns."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h + c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - PROBE_BITS)).astype(np.uint32)


def make_block(items: list[tuple[str, list[bytes]]], window: int) -> Block:
    """From (item, words)."""
    vocabulary: dict[bytes, int] = {}
    number: dict[str, int] = {}
    ids, begins, owners = [], defaultdict(list), defaultdict(list)
    at = 0
    for item, words in items:
        length = min(window, len(words))
        ids.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words), np.int32, len(words)))
        n = len(words) - length + 1
        begins[length].append(np.arange(at, at + n, dtype=np.int32))
        owners[length].append(np.full(n, number.setdefault(item, len(number)), np.int32))
        at += len(words)
    text = np.concatenate(ids)
    windows, by_window, probes = {}, {}, {}
    for length in begins:
        start, owner = np.concatenate(begins[length]), np.concatenate(owners[length])
        rows = np.ascontiguousarray(text[start[:, None] + np.arange(length)]).view(f"V{4 * length}").ravel()
        _, first, same = np.unique(rows, return_index=True, return_inverse=True)
        windows[length] = start[first]
        pairs = np.unique(same.astype(np.int64) << 32 | owner)
        by_window[length] = (ragged(np.bincount(pairs >> 32, minlength=len(first))), (pairs & 0xFFFFFFFF).astype(np.int32))
        probes[length] = hashed([text[windows[length] + k] for k in range(max(length - PROBE_WORDS, 0), length)])
    return Block(vocabulary, text, windows, by_window, list(number), probes)


def blocks(benchmark: DataFrame, window: int, block_words: int, item_id: str = "item_id", text: str = "text") -> Iterator[Block]:
    """Blocks of at most ``block_words`` words; the driver holds one at a time.

    An item that is longer is cut with an overlap of a window less one word, so no window is lost.
    """
    held, size = [], 0
    for row in benchmark.select(col(item_id).cast("string"), col(text).cast("string")).toLocalIterator():
        words = words_of((row[1] or "").encode())
        if not words:
            continue
        step = max(block_words - window + 1, 1)
        for a in range(0, max(len(words) - window, 0) + 1, step):
            piece = words[a : a + step + window - 1]
            if held and size + len(piece) > block_words:
                yield make_block(held, window)
                held, size = [], 0
            held.append((row[0] or "", piece))
            size += len(piece)
    if held:
        yield make_block(held, window)


def strings(ids: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shards as (text, place in ``ids`` of each of its symbols).

    Maximal runs of vocabulary words, at least as long as the shortest window; a run longer
    than half a shard is cut with an overlap of a window less one word.
    """
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]])))
    begin, end = edges[0::2], edges[1::2]
    long_enough = end - begin >= block.shortest
    begin, end = begin[long_enough], end[long_enough]
    step = SHARD_WORDS // 2
    if len(begin) and (end - begin).max() > step:
        pieces = [(a, min(a + step + max(block.windows) - 1, e)) for b, e in zip(begin, end) for a in range(b, e, step)]
        begin, end = np.array(pieces).T
    sizes = end - begin + 1  # with the end mark
    shard = ragged(sizes)[:-1] // SHARD_WORDS
    for cut in np.split(np.arange(len(begin)), np.flatnonzero(np.diff(shard)) + 1):
        if len(cut):
            at = np.arange(sizes[cut].sum()) - np.repeat(ragged(sizes[cut])[:-1], sizes[cut]) + np.repeat(begin[cut], sizes[cut])
            text = np.where(at < np.repeat(end[cut], sizes[cut]), ids[np.minimum(at, len(ids) - 1)], 0).astype(np.int64)
            yield text, at


def possible(text: np.ndarray, block: Block, length: int, met: dict[int, np.ndarray]) -> np.ndarray:
    """Windows whose last words the shard has together; only these are worth a search.

    The search begins with the last word, so a window that is left out would have ended there. A
    bit for each hash of the shard's word groups: no occurring window is lost.
    """
    n = min(PROBE_WORDS, length)
    if n not in met:
        bits = np.zeros(1 << PROBE_BITS >> 3, np.uint8)
        if len(text) >= n:
            h = hashed([text[k : len(text) - n + 1 + k] for k in range(n)])
            np.bitwise_or.at(bits, h >> 3, np.uint8(1) << (h & 7).astype(np.uint8))
        met[n] = bits
    probes = block.probes[length]
    return np.flatnonzero(met[n][probes >> 3] >> (probes & 7).astype(np.uint8) & 1)


def occurrences(ids: np.ndarray, block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window length, window numbers, places in ``ids``) of all occurrences."""
    for text, at in strings(ids, block):
        index, met = None, {}
        for length in block.windows:
            some = possible(text, block, length, met)
            if not len(some):
                continue
            index = index or FmIndex(text, len(block.vocabulary) + 1)
            low, high = index.search(block.patterns(length, some))
            counts = high - low
            which = np.repeat(np.arange(len(some)), counts)
            for a in range(0, len(which), SHARD_WORDS):  # a bounded number at a time
                part = which[a : a + SHARD_WORDS]
                rows = low[part] + np.arange(a, a + len(part)) - ragged(counts)[:-1][part]
                yield length, some[part], at[index.locate(rows)]


def scan(texts: list[bytes | None], block: Block) -> tuple[list[int], list[list[dict]], list[list[str]]]:
    """Words, merged spans of hit words and item ids of every text."""
    get, parts, sizes = block.vocabulary.get, [], []
    for t in texts:
        words = words_of(t)
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        sizes.append(len(words))
    gap = np.zeros(1, np.int64)  # strings end with their document
    ids = np.concatenate([x for p in parts for x in (p, gap)])
    starts = ragged(np.array(sizes) + 1)
    cover = np.zeros(len(ids) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for length, which, place in occurrences(ids, block):
        np.add.at(cover, place, 1)
        np.add.at(cover, place + length, -1)
        owner = np.searchsorted(starts, place, "right") - 1
        for doc, window in np.unique(np.column_stack([owner, which]), axis=0).tolist():
            items[doc].update(block.items(length, window))
    hit = np.cumsum(cover)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    begin, end = edges[0::2], edges[1::2]
    owner = np.searchsorted(starts, begin, "right") - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for doc, a, b in zip(owner.tolist(), (begin - starts[owner]).tolist(), (end - starts[owner]).tolist()):
        spans[doc].append({"start": a, "end": b})
    return sizes, spans, [sorted(i) for i in items]


def merged(spans: list[dict]) -> list[dict]:
    """Overlapping and touching spans as one."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ITEMS = T.ArrayType(T.StringType())


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``keep`` columns with n_words (long), spans (array of start, end in words) and items (array of ids).

    A window is ``window`` consecutive words of an item, or all words of a shorter one; an
    item without words has none. Null texts have no words. A null item id reads as an empty
    string; items of one id are one item. An empty benchmark finds nothing.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", ITEMS)]
    made = [f.name for f in fields]  # a kept column of such a name is left out
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    if text not in keep:
        body = free_name(docs, "body")
        docs, text = docs.select(*[col(c) for c in keep], col(text).alias(body)), body
    carried = list(dict.fromkeys([*keep, text]))
    context = docs.sparkSession.sparkContext
    found = None
    for block in blocks(benchmark, window, block_words):
        shared = context.broadcast(block)

        def make(shared=shared):
            def step(texts, spans=None, items=None):
                sizes, new_spans, new_items = scan(texts, shared.value)
                if spans is not None:
                    new_spans = [merged([*a, *b]) for a, b in zip(spans, new_spans)]
                    new_items = [sorted({*a, *b}) for a, b in zip(items, new_items)]
                return [sizes, new_spans, new_items]

            return step

        if found is None:
            found = map_texts(docs, text, fields, make, carried)
        else:  # the next block adds to what earlier ones found
            found = map_texts(stage(found, "decontamination"), text, fields, make, carried, inputs=["spans", "items"])
    if found is None:
        empty = lambda: lambda texts: [[len(words_of(t)) for t in texts], [[] for _ in texts], [[] for _ in texts]]
        found = map_texts(docs, text, fields, empty, keep)
    return found.select(*[col(c) for c in keep], "n_words", "spans", "items")


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the given ranges of words and what stands between their words."""
    plain = text.translate(WORD_BYTES)
    data = np.frombuffer(plain, np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], data, [False]]).astype(np.int8)))
    begin, end = edges[0::2], edges[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : begin[a]])
        at = end[b - 1]
    return b"".join([*out, text[at:]])


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every hit span cut out of its text; rows without one stay as they are."""
    plain = safe_names(docs)
    body = plain.columns[docs.columns.index(text)]
    found = find_benchmark(plain, benchmark, body, None, window, block_words)

    def make():
        def step(texts, spans):
            return [[t if not s else cut_words(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, spans)]]

        return step

    return map_texts(found, body, [], make, plain.columns, replace_text=True, inputs=["spans"]).toDF(*docs.columns)
