import random

import numpy as np
from helpers import benchmark, documents, words
from pyspark.sql import functions as F

from tradeledger.llm import decontamination as dc


def brute(text, items, window=10):
    w = words(text)
    hit, ids = set(), set()
    for item, body in items:
        b = words(body)
        n = min(window, len(b))
        own = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in own:
                hit.update(range(i, i + n))
                ids.add("" if item is None else str(item))
    spans = []
    for i in sorted(hit):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return len(w), spans, sorted(ids)


def plain(r):
    return r["n_words"], [[s["start"], s["end"]] for s in r["spans"]], list(r["items"])


def random_tables():
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(12)] + ["É", "x1"]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice((1, 4, 9, 10, 11, 25))))) for i in range(12)]
    items += [(90, None), (91, " -- "), (None, "w1 w2 w3 w4 w1 w2"), (items[3][0], items[3][1])]
    rows = []
    for i in range(40):
        body = rng.choices(pool + ["out", "side"], k=rng.randrange(0, 80))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1] or ""
            cut = part.split()
            a = rng.randrange(0, max(len(cut) - 2, 1))
            body[len(body) // 2 : len(body) // 2] = cut[a:]
        rows.append((i, rng.choice((" ", " - ", "\n")).join(body).upper(), "", "", 0))
    return rows, items


def test_equals_window_by_window(spark):
    rows, items = random_tables()
    wanted = {r[0]: brute(r[1], items) for r in rows}
    docs, bench = documents(spark, rows), benchmark(spark, items)
    assert sum(bool(w[1]) for w in wanted.values()) > 10
    for block_words in (dc.BLOCK_WORDS, 30):  # one block, and many
        got = dc.find_benchmark(docs, bench, keep=["doc_id"], block_words=block_words).collect()
        assert {r["doc_id"]: plain(r) for r in got} == wanted


def test_awkward_rows(spark):
    from helpers import PASSAGE

    items = [(1, PASSAGE), (2, ""), (3, None), (4, "one")]
    docs = documents(spark, clashing=True)
    got = dc.find_benchmark(docs, benchmark(spark, items))
    assert got.columns.count("spans") == 1 and got.columns.count("n_words") == 1
    for r in got.collect():
        assert plain(r) == brute(r["text"], items)
    assert dc.find_benchmark(documents(spark, []), benchmark(spark, items)).count() == 0
    nothing = dc.find_benchmark(docs, benchmark(spark), keep=["doc_id"]).collect()
    assert len(nothing) == docs.count() and not any(r["spans"] for r in nothing)


def test_removal_keeps_the_rest(spark):
    from helpers import PASSAGE

    text = f"Before, {PASSAGE.upper()}! After É."
    docs = documents(spark, [(1, text, "en", "s", 5), (2, "Clean  text.\n", "en", "s", 5), (3, None, "en", "s", 0)]).withColumn("spans", F.lit("own"))
    got = {r["doc_id"]: r for r in dc.remove_benchmark(docs, benchmark(spark, [(1, PASSAGE)])).collect()}
    assert got[1]["text"] == "Before, ! After É." and got[2]["text"] == "Clean  text.\n" and got[3]["text"] is None
    assert got[1]["spans"] == "own" and got[1]["source"] == "s"


def test_index_finds_and_locates_everything():
    rng = np.random.default_rng(2)
    for size in (2, 3, 9):
        runs = [rng.integers(1, size + 1, rng.integers(1, 40)) for _ in range(60)] + [np.ones(200, np.int64)]
        text = np.concatenate([x for r in runs for x in (r, [0])]).astype(np.int64)
        order = dc.suffix_array(text, size + 1)
        # ends differ by their place, so a suffix reads: symbols, then the place of its end
        ends = np.flatnonzero(text == 0)
        after = ends[np.searchsorted(ends, np.arange(len(text)))]
        key = [tuple((1, int(x)) for x in text[i:e]) + ((0, int(e)),) for i, e in enumerate(after)]
        assert order.tolist() == sorted(range(len(text)), key=key.__getitem__)
        index = dc.FmIndex(text, size + 1)
        for length in (1, 3, 5):
            patterns = rng.integers(1, size + 1, (50, length))
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high):
                places = [i for i in range(len(text) - length + 1) if (text[i : i + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 11, 500)
    matrix = dc.WaveletMatrix(values, 11)
    at = np.arange(500)
    symbol, rank = matrix.access_rank(at)
    assert (symbol == values).all() and rank.tolist() == [int((values[:i] == values[i]).sum()) for i in at]
    asked = rng.integers(0, 11, 501)
    assert matrix.rank(asked, np.arange(501)).tolist() == [int((values[:i] == s).sum()) for i, s in enumerate(asked)]


def test_long_items_are_cut_without_losing_a_window(spark):
    rng = np.random.default_rng(6)
    item = " ".join(f"w{i}" for i in rng.integers(0, 40, 300))
    docs = documents(spark, [(i, " ".join(item.split()[a : a + 30]) + " tail", "en", "s", 0) for i, a in enumerate(range(0, 270, 7))])
    for block_words in (15, 64, 1000):
        got = dc.find_benchmark(docs, benchmark(spark, [(1, item), (2, "w1 w2")]), block_words=block_words).collect()
        for r in got:
            assert plain(r) == brute(r["text"], [(1, item), (2, "w1 w2")]), block_words


def test_windows_whose_last_words_the_shard_lacks_are_not_searched():
    rng = np.random.default_rng(7)
    items = [(str(i), [b"x%d" % x for x in rng.integers(0, 3000, 60)]) for i in range(200)]
    block = dc.make_block(items, 10)
    own = items[7][1][20:40]
    ids = np.array([block.vocabulary[w] for w in own] + [0])
    some = dc.possible(ids, block, 10, {})
    assert 11 <= len(some) < 100 < len(block.windows[10])
    assert [block.items(10, w) for w in some if (block.patterns(10, np.array([w]))[0] == ids[:10]).all()] == [["7"]]


def test_long_strings_are_cut_with_an_overlap(monkeypatch):
    monkeypatch.setattr(dc, "SHARD_WORDS", 64)
    rows, items = random_tables()
    items = [(i, " ".join(words(t))) for i, t in items if t]
    text = " ".join(t for _, t in items * 6)
    block = dc.make_block([("" if i is None else str(i), [w.encode() for w in words(t)]) for i, t in items if words(t)], 10)
    sizes, spans, ids = dc.scan([text.encode(), b"", None], block)
    n, wanted, wanted_ids = brute(text, items)
    assert sizes == [n, 0, 0] and [[s["start"], s["end"]] for s in spans[0]] == wanted and ids[0] == wanted_ids
