"""Alignment of two tokenizers over whole texts by an associative fragment monoid.

Both tokenizers cut the same bytes (a space and the text). Where a token of each ends at the
same byte, a group closes. A fragment is what is known of a byte range on its own: an open
prefix (tokens up to its first common end, whose group began in an earlier range), closed groups
and an open suffix. Two neighbouring fragments compose to the fragment of the joined range, and
the composition is associative, so very long texts are dealt out as pieces and reduced as a tree.

A link is a pair of tokens that end at the same byte. One of the two then is a suffix of the
other, so the pairs that can occur at all are known from the two vocabularies (some 10^5): counts
of pairs are an array of that size, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import defaultdict
from functools import cached_property, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradeledger.llm.common import col, map_texts, ragged, safe_names
from tradeledger.session import stage

#: Texts of more bytes are cut into pieces that are dealt out over tasks.
LONG_BYTES = 1 << 16
#: Neighbouring fragments that one group of the tree reduction composes.
FAN_IN = 16
#: Words whose alignment a worker remembers; beyond it the memory starts anew.
CACHED_WORDS = 3 << 16
#: A run of white space from this length on goes to the slower tokenizer of the same file.
LONG_RUN = re.compile(r"\s{500,}")
#: Both tokenizers have a token border before a single space between two visible characters.
BORDER = re.compile(r"(?<=\S) (?=\S)")
#: Pre-tokenization of byte-level vocabularies (fixed value, public).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Fragment(NamedTuple):
    """Tokens that end in a byte range. Without a common end (``cut`` false) all are in the prefix."""

    cut: bool
    prefix_a: tuple
    prefix_b: tuple
    groups: bytes  # closed groups as text, joined by ";"
    n_groups: int
    suffix_a: tuple
    suffix_b: tuple


EMPTY = Fragment(False, (), (), b"", 0, (), ())


def group_text(a, b) -> bytes:
    return (",".join(map(str, a)) + "|" + ",".join(map(str, b))).encode()


def joined(*parts: bytes) -> bytes:
    return b";".join(p for p in parts if p)


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges, ``x`` before ``y``."""
    if not y.cut:
        if not x.cut:
            return Fragment(False, x.prefix_a + y.prefix_a, x.prefix_b + y.prefix_b, b"", 0, (), ())
        return x._replace(suffix_a=x.suffix_a + y.prefix_a, suffix_b=x.suffix_b + y.prefix_b)
    if not x.cut:
        return y._replace(prefix_a=x.prefix_a + y.prefix_a, prefix_b=x.prefix_b + y.prefix_b)
    middle = group_text(x.suffix_a + y.prefix_a, x.suffix_b + y.prefix_b)
    return Fragment(
        True, x.prefix_a, x.prefix_b, joined(x.groups, middle, y.groups), x.n_groups + y.n_groups + 1, y.suffix_a, y.suffix_b
    )


def closed(x: Fragment) -> tuple[bytes, int]:
    """Groups of a whole text: its start closes the prefix, and both tokenizers end at its end."""
    if not x.cut:
        return b"", 0
    return joined(group_text(x.prefix_a, x.prefix_b), x.groups), x.n_groups + 1


class Tokens(NamedTuple):
    """Ids and byte ends of both tokenizers; ``ok`` if both spell the text."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    ok: bool


class Pair:
    """Two vocabularies: a byte-level BPE (A, a json file) and a sentence-piece model (B)."""

    def __init__(self, a_path: str, b_path: str) -> None:
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model["added_tokens"] if t["special"]}
        entries = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
        letters = byte_letters()
        spelled = {bytes(letters[c] for c in t): i for t, i in entries.items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        made = [entries.get(x + y) for x, y in merges]
        if len(spelled) != len(entries) or None in made or made != sorted(made):
            raise ValueError(f"{a_path} is not a byte-level vocabulary whose ids follow its merges")
        self.fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=spelled, special_tokens={})
        self.a_path = a_path
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for t, i in spelled.items():
            self.a_bytes[i] = t

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [piece_bytes(n) for n in names]
        # no piece goes from a visible character into a space: then no merge crosses a border
        self.splits = not any(re.search("[^▁]▁", n) for n in names)
        usable = [i for i in range(len(names)) if not (self.pieces.is_control(i) or self.pieces.is_unknown(i))]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.keys = self.possible(usable)

    def possible(self, usable: list[int]) -> np.ndarray:
        """Sorted keys of all id pairs in which one token's bytes end with the other's."""
        by_a = {t: i for i, t in enumerate(self.a_bytes) if t}
        by_b = defaultdict(list)
        for i in usable:
            by_b[self.b_bytes[i]].append(i)
        found = array("q")
        for t, a in by_a.items():
            for k in range(len(t)):
                found.extend((a << 32) | b for b in by_b.get(t[k:], ()))
        for t, ids in by_b.items():
            for k in range(1, len(t)):  # equal spellings are found above
                a = by_a.get(t[k:])
                if a is not None:
                    found.extend((a << 32) | b for b in ids)
        return np.unique(np.frombuffer(found, np.int64))

    @cached_property
    def slow(self) -> tokenizers.Tokenizer:
        """Loaded only where a text has a long run of white space."""
        made = tokenizers.Tokenizer.from_file(self.a_path)
        made.encode_special_tokens = True
        return made

    def links(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair in ``keys``."""
        wanted = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.keys, wanted)
        if (self.keys[np.minimum(at, len(self.keys) - 1)] != wanted).any():
            raise ValueError("a link that the vocabularies cannot have")
        return at.astype(np.int32)

    def encode(self, text: str) -> Tokens:
        """Tokens of a space and the text; byte ends count that space."""
        spaced = " " + text
        if LONG_RUN.search(spaced):
            a = self.slow.encode(spaced, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(spaced)
        b = self.pieces.encode(text, num_threads=1)
        want = spaced.encode()
        ok = b"".join([self.a_bytes[i] for i in a]) == want and b"".join([self.b_bytes[i] for i in b]) == want
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Tokens(a, np.cumsum(self.a_size[a]), b, np.cumsum(self.b_size[b]), ok)

    def words(self, text: str) -> list[str]:
        return BORDER.split(text) if self.splits else [text]


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in byte-level vocabularies: itself, or the next letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def piece_bytes(piece: str) -> bytes:
    coded = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(coded[1], 16)]) if coded else piece.replace("▁", " ").encode()


@lru_cache(maxsize=2)
def pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def group_texts(t: Tokens) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Text of every group that closes, its end, and the linked ids."""
    ends, ia, ib = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True, return_indices=True)
    a, b = list(map(str, t.a.tolist())), list(map(str, t.b.tolist()))
    texts, i, j = [], 0, 0
    for x, y in zip((ia + 1).tolist(), (ib + 1).tolist()):
        texts.append((a[i] + "|" + b[j] if x == i + 1 and y == j + 1 else ",".join(a[i:x]) + "|" + ",".join(b[j:y])).encode())
        i, j = x, y
    return texts, ends, t.a[ia], t.b[ib]


class Aligner:
    """Aligns texts word by word; words met before are looked up.

    Tokens of both kinds end before a single space between visible characters, so the fragment
    of such a word has closed groups only, and a text is the composition of its words.
    """

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.texts, self.text_ends = bytearray(), array("q", [0])
        self.n_a, self.n_b, self.n_groups = array("i"), array("i"), array("i")  # n_a is -1: not spelled by both
        self.first = array("q", [0])
        self.store = np.empty(1 << 16, np.int32)

    def put(self, word: str, texts: list[bytes], n_a: int, n_b: int, links: np.ndarray) -> None:
        end = self.first[-1] + len(links)
        if end > len(self.store):
            self.store = np.concatenate([self.store, np.empty(max(len(self.store), end), np.int32)])
        self.store[self.first[-1] : end] = links
        self.place[word] = len(self.n_a)
        self.texts += b";".join(texts)
        self.text_ends.append(len(self.texts))
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.n_groups.append(len(texts))
        self.first.append(end)

    def learn(self, words: list[str]) -> None:
        together = [w for w in words if w and not w[0].isspace() and not w[-1].isspace()] if self.pair.splits else []
        done = set()
        if len(together) > 1:
            t = self.pair.encode(" ".join(together))
            if t.ok:  # else each on its own tells which
                self.deal(together, t)
                done = set(together)
        for w in words:
            if w in done:
                continue
            t = self.pair.encode(w)
            if t.ok:
                self.deal([w], t)
            else:
                self.put(w, [], -1, 0, np.empty(0, np.int32))

    def deal(self, words: list[str], t: Tokens) -> None:
        texts, ends, a, b = group_texts(t)
        links = self.pair.links(a, b)
        word_ends = np.cumsum([len(w.encode()) + 1 for w in words])
        upto = np.searchsorted(ends, word_ends)
        if (ends[np.minimum(upto, len(ends) - 1)] != word_ends).any():
            raise ValueError("a token crosses a border")
        stop = (upto + 1).tolist()
        n_a = np.diff(np.searchsorted(t.a_ends, word_ends, "right"), prepend=0).tolist()
        n_b = np.diff(np.searchsorted(t.b_ends, word_ends, "right"), prepend=0).tolist()
        i = 0
        for w, j, x, y in zip(words, stop, n_a, n_b):
            self.put(w, texts[i:j], x, y, links[i:j])
            i = j

    def align(self, texts: list[str]) -> list[tuple[bool, int, int, int, bytes, np.ndarray]]:
        """(spelled by both, tokens of A, of B, groups, text of the groups, links) of each text."""
        if len(self.place) > CACHED_WORDS:
            self.forget()
        words = [self.pair.words(t) for t in texts]
        new = {w for own in words for w in own if w not in self.place}
        if new:
            self.learn(sorted(new))
        place = self.place
        flat = np.array([place[w] for own in words for w in own], np.int64)
        at = ragged(np.array([len(own) for own in words], np.int64)).tolist()
        n_a, n_b, n_groups = (np.array(x, np.int64) for x in (self.n_a, self.n_b, self.n_groups))
        first, ends, all_texts = np.array(self.first), self.text_ends, bytes(self.texts)
        # links of all words of the batch, one after the other
        counts = n_groups[flat]
        starts = ragged(counts)
        gathered = self.store[np.repeat(first[flat] - starts[:-1], counts) + np.arange(starts[-1])]
        made = []
        for i, j in zip(at, at[1:]):
            own = flat[i:j]
            if (n_a[own] < 0).any():
                made.append((False, 0, 0, 0, b"", np.empty(0, np.int32)))
                continue
            text = b";".join([all_texts[ends[w] : ends[w + 1]] for w in own.tolist()])
            made.append((True, int(n_a[own].sum()), int(n_b[own].sum()), int(counts[i:j].sum()), text, gathered[starts[i] : starts[j]]))
        return made


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker: its words are remembered from task to task."""
    return Aligner(pair(a_path, b_path))


def pieces(p: Pair, text: str, size: int) -> list[str]:
    """The text cut at borders into pieces of at least ``size`` bytes, but for the last; joined by a space they are the text."""
    made, now, length = [], [], 0
    for w in p.words(text):
        now.append(w)
        length += len(w.encode()) + 1
        if length >= size:
            made.append(" ".join(now))
            now, length = [], 0
    return [*made, " ".join(now)] if now else made


def range_fragments(p: Pair, text: str, size: int) -> list[tuple[int, bool, Fragment, int, int, np.ndarray]]:
    """(start byte, spelled, fragment, tokens of A, of B, links) for each range of ``size`` bytes of a piece.

    A token belongs to the range that has its last byte.
    """
    t = p.encode(text)
    total = len(text.encode()) + 1
    if not t.ok:
        return [(0, False, EMPTY, 0, 0, np.empty(0, np.int32))]
    made = []
    for start in range(0, total, size):
        stop = start + size if start + 2 * size <= total else total
        a0, a1 = np.searchsorted(t.a_ends, [start, stop], "right")
        b0, b1 = np.searchsorted(t.b_ends, [start, stop], "right")
        own = Tokens(t.a[a0:a1], t.a_ends[a0:a1], t.b[b0:b1], t.b_ends[b0:b1], True)
        common = np.intersect1d(own.a_ends, own.b_ends, assume_unique=True)
        if len(common):
            x, y = np.searchsorted(own.a_ends, common[[0, -1]], "right").tolist()
            u, v = np.searchsorted(own.b_ends, common[[0, -1]], "right").tolist()
            inner, _, _, _ = group_texts(Tokens(own.a[x:y], own.a_ends[x:y], own.b[u:v], own.b_ends[u:v], True))
            a, b = own.a.tolist(), own.b.tolist()
            fragment = Fragment(True, tuple(a[:x]), tuple(b[:u]), b";".join(inner), len(inner), tuple(a[y:]), tuple(b[v:]))
        else:
            fragment = Fragment(False, tuple(own.a.tolist()), tuple(own.b.tolist()), b"", 0, (), ())
        _, ia, ib = np.intersect1d(own.a_ends, own.b_ends, assume_unique=True, return_indices=True)
        made.append((start, True, fragment, len(own.a), len(own.b), p.links(own.a[ia], own.b[ib])))
        if stop == total:
            break
    return made


IDS = T.ArrayType(T.LongType())
FRAGMENT = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("cut", T.BooleanType()),
        T.StructField("prefix_a", IDS),
        T.StructField("prefix_b", IDS),
        T.StructField("groups", T.BinaryType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("suffix_a", IDS),
        T.StructField("suffix_b", IDS),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("links", T.BinaryType()),
    ]
)
#: What is kept of a text: links are places in ``Pair.keys`` as 32-bit numbers, in order.
ALIGNED = [
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("links", T.BinaryType()),
]


def shown(text: bytes, ok: bool, digest: bool) -> bytes:
    return hashlib.sha256(text).hexdigest().encode() if ok and digest else text


def short_texts(docs: DataFrame, a_path: str, b_path: str, keep: list[str], digest: bool) -> DataFrame:
    def make():
        own = aligner(a_path, b_path)

        def step(texts):
            found = own.align([(t or b"").decode() for t in texts])
            has = [bool(t) and f[0] for t, f in zip(texts, found)]
            return [
                [f[1] if h else 0 for h, f in zip(has, found)],
                [f[2] if h else 0 for h, f in zip(has, found)],
                [f[3] if h else 0 for h, f in zip(has, found)],
                [shown(f[4], True, digest).decode() if h else "" for h, f in zip(has, found)],
                [f[5].tobytes() if h else b"" for h, f in zip(has, found)],
            ]

        return step

    # small chunks: a worker's memory is mostly words and tokens of the chunk at hand
    return map_texts(docs, "text", ALIGNED, make, keep, slice_rows=256, chunk_bytes=1 << 18)


def long_texts(docs: DataFrame, a_path: str, b_path: str, keep: list[str], digest: bool, long_bytes: int, longest: int) -> DataFrame:
    """Pieces of each text are tokenized in tasks of their own and composed as a tree of byte ranges."""
    numbered = stage(docs.select(*keep, "text", F.monotonically_increasing_id().alias("_row")), "long-texts")

    def cut(batches):
        p = pair(a_path, b_path)
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = 0
                for piece in pieces(p, text, long_bytes):
                    yield pa.RecordBatch.from_pydict({"row": [row], "at": [at], "piece": [piece]}, schema=cut_schema)
                    at += len(piece.encode()) + 1

    cut_type = T.StructType([T.StructField("row", T.LongType()), T.StructField("at", T.LongType()), T.StructField("piece", T.StringType())])
    cut_schema, arrow = to_arrow_schema(cut_type), to_arrow_schema(FRAGMENT)
    dealt = numbered.select("_row", "text").mapInArrow(cut, cut_type).repartition("row", "at")

    def record(row, start, ok, x, n_a, n_b, links):
        return dict(zip(FRAGMENT.fieldNames(), (row, start, ok, *x, n_a, n_b, links)))

    def fragments(batches):
        p = pair(a_path, b_path)
        for batch in batches:
            for row, at, piece in zip(*(c.to_pylist() for c in batch.columns)):
                made = [record(row, at + s, ok, x, n_a, n_b, k.tobytes()) for s, ok, x, n_a, n_b, k in range_fragments(p, piece, long_bytes)]
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    def reduce(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        x, ok = EMPTY, all(r["ok"] for r in rows)
        for r in rows if ok else []:
            y = Fragment(r["cut"], *(tuple(r[c]) if c[1:-1].endswith("fix_") else r[c] for c in Fragment._fields[1:]))
            x = compose(x, y)
        total = [sum(r[c] for r in rows) if ok else 0 for c in ("n_a", "n_b")]
        links = b"".join(r["links"] for r in rows) if ok else b""
        return pa.Table.from_pylist([record(rows[0]["row"], rows[0]["start"], ok, x, *total, links)], schema=arrow)

    now, width = stage(dealt.mapInArrow(fragments, FRAGMENT), "fragments"), long_bytes
    while width <= longest:
        width *= FAN_IN
        now = now.groupBy("row", F.floor(F.col("start") / width)).applyInArrow(reduce, FRAGMENT)

    def whole(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x = Fragment(*(r[c] for c in Fragment._fields))
                text, n = closed(x)
                out = [r["row"], r["n_a"], r["n_b"], n, shown(text, r["ok"], digest).decode(), r["links"]]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, done)], schema=done)

    done_type = T.StructType([T.StructField("row", T.LongType()), *ALIGNED])
    done = to_arrow_schema(done_type)
    found = now.mapInArrow(whole, done_type)
    return numbered.select(*keep, "_row").join(found, F.col("_row") == F.col("row")).select(*keep, *[f.name for f in ALIGNED])


def align(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None,
    digest: bool = False, long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """Columns ``keep`` (all but the text by default), n_a, n_b, n_groups, groups and links of every row.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of decimal ids (with ``digest`` its SHA-256 in hex),
    ``links`` the linked pairs as 32-bit places in ``Pair.keys``. Texts that are null or empty, or that
    either tokenizer does not spell byte for byte, have no tokens: zeros, empty ``groups`` and links.
    Each row has its row, also repeated ones; kept columns named like a result are left out. The
    result is a table in the shared folder, read again.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != text or keep is not None]
    names = [c for c in names if c.lower() not in {f.name for f in ALIGNED}]
    plain = safe_names(docs.select(*[col(c) for c in names], col(text).cast("string")))
    own = plain.columns[:-1]
    plain = plain.withColumnRenamed(plain.columns[-1], "text")
    size = F.octet_length("text")
    short = short_texts(plain.filter(F.coalesce(size, F.lit(0)) <= long_bytes), a_path, b_path, own, digest)
    longest = plain.select(F.max(size)).first()[0] or 0
    if longest > long_bytes:
        long = long_texts(plain.filter(size > long_bytes), a_path, b_path, own, digest, long_bytes, longest)
        short = short.unionByName(long)
    return stage(short, "aligned").toDF(*names, *[f.name for f in ALIGNED])


def pair_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, n): how many links of the corpus hold each id pair, for pairs that occur.

    A task counts into one array over the possible pairs; at most that many rows leave it.
    """

    def count(batches):
        p = pair(a_path, b_path)
        n = np.zeros(len(p.keys), np.int64)
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), 256):
                links = np.frombuffer(b"".join(x for x in column.slice(at, 256).to_pylist() if x), np.int32)
                n += np.bincount(links, minlength=len(n))
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p.keys[met] >> 32), pa.array(p.keys[met] & 0xFFFFFFFF), pa.array(n[met])], ["a", "b", "n"])

    counted = aligned.select("links").mapInArrow(count, "a long, b long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def with_counts(aligned: DataFrame, counts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Adds n_links, n_best and count_sum to the rows of ``align``.

    The counts are collected: at most one row for each possible pair of the two vocabularies.
    """
    p = pair(a_path, b_path)
    got = counts.toArrow()
    a, b, n = (got.column(c).to_numpy() for c in ("a", "b", "n"))
    count = np.zeros(len(p.keys), np.int64)
    count[p.links(a, b)] = n
    best = np.zeros(len(p.b_bytes), np.int64)
    np.maximum.at(best, b, n)
    top = count == best[p.keys & 0xFFFFFFFF]
    names = [c for c in aligned.columns if c != "links" and c not in ("n_links", "n_best", "count_sum")]
    made = [T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]
    source = aligned.select(*[col(c) for c in names], "links")
    schema = T.StructType([*source.schema.fields[:-1], *made])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = [[], [], []]
            for links in batch.column(len(names)).to_pylist():
                at = np.frombuffer(links, np.int32)
                for values, v in zip(out, (len(at), top[at].sum(), count[at].sum())):
                    values.append(int(v))
            columns = [*batch.columns[:-1], *[pa.array(v, pa.int64()) for v in out]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(run, schema)
