import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import documents

from tradeledger.llm import column_bwt, queries
from tradeledger.llm import substring_dedup as sd

LAST = 1 << 70


def brute(rows):
    """(id, bytes, spans, kept) of each (id, text) row, window by window."""
    first = {}
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for i, b in bodies:
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            first[w] = min(first.get(w, LAST), LAST if i is None else i)
    out = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < (LAST if i is None else i):
                gone[k : k + 50] = b"\1" * 50
        edges = np.flatnonzero(np.diff(np.array([0, *gone, 0], np.int8)))
        spans = tuple(zip(edges[0::2].tolist(), edges[1::2].tolist()))
        out.append((i, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def found(df):
    rows = [(r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in df.collect()]
    return sorted(rows, key=str)


def test_equals_window_by_window(spark):
    rng = random.Random(11)
    parts = ["".join(rng.choices(alphabet, k=rng.choice((49, 50, 51, 60, 120, 300)))) for alphabet in ("ab", "abcdefgh ", "aé漢😀\n\x00") for _ in range(14)]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(rng.randrange(0, 7)):
            part = rng.choice(parts)
            if rng.random() < 0.3:
                k = rng.randrange(len(part))
                part = part[:k] + rng.choice("abxyz") + part[k + 1 :]
            text += part[rng.randrange(0, 9) :] + "".join(rng.choices("mnop", k=rng.randrange(0, 30)))
        rows.append((rng.choice((i, i, 1000 - i)), text, "", "", 0))
    rows += [(500 + i, rows[3][1], "", "", 0) for i in range(20)]  # whole copies
    got = found(sd.remove_repeats(documents(spark, rows).repartition(5)))
    assert got == brute([r[:2] for r in rows])
    assert sum(bool(g[2]) for g in got) > 50


def test_hot_grams_are_dealt_out(spark):
    rng = random.Random(8)
    line = "this very popular line stands in most of the documents, word by word, as it is"
    rows = []
    for i in range(300):
        around = ["".join(rng.choices("abcdef ", k=rng.randrange(0, 60))) for _ in range(2)]
        rows.append((i, around[0] + line[rng.choice((0, 0, 0, 5)) :] + around[1], "", "", 0))
    df = documents(spark, rows).repartition(4)
    dealt = df.selectExpr("doc_id as doc", "0 as tag", "text")
    assert len(sd.hot_grams(dealt, 300)) > 1
    got = found(sd.remove_repeats(df))
    assert got == brute([r[:2] for r in rows]) and sum(bool(g[2]) for g in got) > 250


def test_awkward_rows(spark):
    df = documents(spark, clashing=True)
    assert found(sd.remove_repeats(df)) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert sd.remove_repeats(documents(spark, [])).count() == 0
    assert found(sd.remove_repeats(documents(spark, [(1, None, "", "", 0), (2, "", "", "", 0)]))) == [(1, 0, (), b""), (2, 0, (), b"")]


def test_equal_tags_are_no_copies(spark):
    by_tag = {}
    for i in range(100_000):
        text = hashlib.sha256(str(i).encode()).hexdigest()
        other = by_tag.setdefault(zlib.crc32(text.encode()) & (sd.NO_ID - 1), text)
        if other != text:
            break
    for own in (None, 7):  # null ids, and one id on two rows
        rows = [(1, other, "", "", 0), (own, other, "", "", 0), (own, text, "", "", 0)]
        got = found(sd.remove_repeats(documents(spark, rows)))
        assert got == brute([r[:2] for r in rows])
        assert sorted(kept.decode() for i, _, _, kept in got if i == own) == ["", text]


def test_registered_query_on_the_small_table(spark, root):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.repeated_bytes(spark, root).collect()}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    for i, n, spans, kept in brute(rows):
        assert got[i] == (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
    assert len(got) == len(rows)


def test_every_window_has_its_anchor_wherever_blocks_end(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab ", k=n)).encode() for n in (0, 49, 50, 700, 3000, 51)]
    place, gram, context = sd.Texts.of(texts).anchors()
    monkeypatch.setattr(sd, "BLOCK", 333)
    again = sd.Texts.of(texts).anchors()
    assert all((a == b).all() for a, b in zip((place, gram, context), again))
    held = sd.Texts.of(texts)
    for a, b in zip(held.start, held.end):
        for q in range(a, b - 49):
            assert ((place >= q) & (place + sd.GRAM <= q + 50)).any()


def test_column_wise_order_and_common_prefixes():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 3, (80, 12)).astype(np.int16)
    group = np.sort(rng.integers(0, 5, 80))
    for column, order, common in column_bwt.columns(symbols, group):
        rows = [(group[i], *symbols[i, column:]) for i in order]
        assert rows == sorted(rows)
        for k in range(1, 80):
            a, b = rows[k - 1], rows[k]
            same = 0
            if a[0] == b[0]:
                while same < len(a) - 1 and a[same + 1] == b[same + 1]:
                    same += 1
            assert common[k] == same


def test_answers_of_one_id_are_dealt_over_many_parts():
    n = 20_000
    rng = np.random.default_rng(2)
    tag = rng.integers(0, sd.NO_ID, n).astype(np.uint64) | np.uint64(sd.NO_ID)
    doc, context, state = np.full(n, sd.LAST), rng.integers(0, 1 << 48, n).astype(np.uint64), np.ones(n, np.uint64)
    table = sd.replies(doc, tag, context, state, 1, 64)
    sizes = [len(x) for x in table.column("states").to_pylist()]
    assert len(sizes) == 64 and sum(sizes) == n and max(sizes) < 2 * n / 64
    parts = [set(sd.from_planes(x, sd.TAG).tolist()) for x in table.column("tags").to_pylist()]
    assert sum(map(len, parts)) == len(set(tag.tolist()))  # rows alike in id and tag meet


def test_settled_entries_of_one_id_are_dealt_over_many_buckets():
    text = hashlib.sha512(b"passage").hexdigest()
    docs, texts = [1] + [sd.LAST] * 400, [text] + [text + str(i) for i in range(400)]
    tags = [0] + [sd.NO_ID | zlib.crc32(t.encode()) & (sd.NO_ID - 1) for t in texts[1:]]
    batch = pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(tags, pa.int32()), pa.array(texts)], names=["doc", "tag", "text"])
    rows = [r for b in sd.requests(16, np.zeros(0, np.uint64))([batch]) for r in b.to_pylist()]
    assert sum(bool(r["done_docs"]) for r in rows) == 16


def test_packing():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 48, 100).astype(np.uint64)
    assert (sd.from_planes(sd.planes(values, 6), 6) == values).all()
    ids = np.sort(np.append(rng.integers(-(1 << 62), 1 << 62, 50), [sd.LAST, -(1 << 63)]))
    assert (sd.from_rising(sd.rising(ids)) == ids).all() and len(sd.from_rising(b"")) == 0
