"""Token alignment against both tokenizers applied to whole texts, and the laws of the monoid."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers
from helpers import documents, write

from tradeledger.llm import queries, token_alignment as ta

A, B = queries.TOKENIZER_A, queries.TOKENIZER_B


@pytest.fixture(scope="module")
def plain():
    """Both libraries on whole texts: [(a, end)], [(b, end)] or None."""
    first = tokenizers.Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = ta.byte_letters()

    def tokens(text):
        if not text:
            return None
        want = (" " + text).encode()
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, ta.piece_bytes(second.id_to_piece(i))) for i in second.encode(text)]
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            return None
        made = []
        for own in (a, b):
            at, ends = 0, []
            for i, t in own:
                at += len(t)
                ends.append((i, at))
            made.append(ends)
        return made

    return tokens


def brute(plain, rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each (doc_id, text)."""
    found, counts = [], Counter()
    for doc_id, text in rows:
        t = plain(text)
        if t is None:
            found.append((doc_id, 0, 0, 0, "", []))
            continue
        a, b = t
        common = {e for _, e in a} & {e for _, e in b}
        groups, links, own_a, own_b, j = [], [], [], [], 0
        for i, end in a:
            own_a.append(i)
            if end in common:
                while True:
                    own_b.append(b[j][0])
                    j += 1
                    if b[j - 1][1] == end:
                        break
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                links.append((own_a[-1], own_b[-1]))
                own_a, own_b = [], []
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(groups), ";".join(groups), links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (d, n_a, n_b, n_g, len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), text)
        for d, n_a, n_b, n_g, text, links in found
    ]


ODD = [
    (20, "<|endoftext|> <s> </s> <unk> <0x41> special strings are plain text"),
    (21, "a lower block ▁ is not a space"),
    (22, " leading and  double   spaces \n\n and\ttabs 　   \x85 \x1c end "),
    (23, "\n"),
    (24, " "),
    (25, "漢字かな交じり文" * 400 + " tail"),
    (26, "x" * 9000),
    (27, " " * 3000 + "word" + "\n" * 2000),
    (28, "emoji 😀😃 family 👨‍👩‍👧 ﬁ ① É é ​ zero \x00 nul"),
    (29, "don't I'll we've it's 12345 3.14 e=mc² ---- ??!! 'S"),
]


def check(spark, plain, docs, **more):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = ta.align(docs, A, B, keep=["doc_id"], **more)
    got = ta.with_counts(found, ta.pair_counts(found, A, B), A, B)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got.collect()]
    want = brute(plain, rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_whole_texts(spark, plain):
    docs = documents(spark, clashing=True)
    odd = spark.createDataFrame([(i, t, None, None, 0) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    check(spark, plain, docs.unionByName(odd, allowMissingColumns=True))


def test_pieces_of_long_texts(spark, plain):
    rng = random.Random(3)
    words = ["over", "the", "Straße", "漢字かな", "naïve", "x\ny", "antidisestablishmentarianism", "😀", "?!", "▁"]
    texts = [(i, " ".join(rng.choices(words[: 9 if i else 10], k=900)), None, None, 0) for i in range(6)]
    texts += [(i, t, None, None, 0) for i, t in ODD]
    texts.append(texts[3])
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    check(spark, plain, docs, long_bytes=64)


def test_empty_table(spark):
    found = ta.align(documents(spark, []), A, B)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "n_a", "n_b", "n_groups", "groups", "links"]
    assert ta.with_counts(found, ta.pair_counts(found, A, B), A, B).count() == 0


def test_query_over_a_table(spark, plain, root):
    got = queries.QUERIES["op13_token_alignment"](spark, root).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    want = {r[0]: r for r in brute(plain, docs)}
    assert len(got) == len(docs)
    for r in got:
        w = want[r.doc_id]
        digest = hashlib.sha256(w[7].encode()).hexdigest() if w[1] else ""
        assert tuple(r) == (*w[:7], digest)


def test_query_of_rows_with_nulls(spark, tmp_path):
    folder = write(spark, tmp_path, documents=documents(spark))
    got = queries.QUERIES["op13_token_alignment"](spark, folder).collect()
    assert len(got) == documents(spark).count()
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r.doc_id in (2, 3))


def random_fragment(rng):
    def ids():
        return tuple(rng.randrange(90) for _ in range(rng.randrange(3)))

    if rng.random() < 0.4:
        return ta.Fragment(False, ids(), ids(), b"", 0, (), ())
    n = rng.randrange(3)
    groups = b";".join(ta.group_text((rng.randrange(90),), (rng.randrange(90),)) for _ in range(n))
    return ta.Fragment(True, ids(), ids(), groups, n, ids(), ids())


def test_composition_is_associative_with_a_neutral_element():
    rng = random.Random(5)
    for _ in range(2000):
        x, y, z = (random_fragment(rng) for _ in range(3))
        assert ta.compose(ta.compose(x, y), z) == ta.compose(x, ta.compose(y, z))
        assert ta.compose(ta.EMPTY, x) == x == ta.compose(x, ta.EMPTY)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_any_byte_ranges_compose_to_the_whole(size):
    p = ta.pair(A, B)
    for _, text in ODD[2:7]:
        text = text[:400]
        made = ta.range_fragments(p, text, size)
        whole = ta.EMPTY
        for _, ok, x, *_ in made:
            assert ok
            whole = ta.compose(whole, x)
        (_, _, once, n_a, n_b, links) = ta.range_fragments(p, text, 1 << 30)[0]
        assert ta.closed(whole) == ta.closed(once)
        assert sum(m[3] for m in made) == n_a and sum(m[4] for m in made) == n_b
        assert np.concatenate([m[5] for m in made]).tolist() == links.tolist()


def test_a_worker_that_forgets_its_words(plain, monkeypatch):
    monkeypatch.setattr(ta, "CACHED_WORDS", 2)
    own = ta.Aligner(ta.pair(A, B))
    for _ in range(2):
        for _, text in ODD:
            ok, n_a, _, _, groups, _ = own.align([text])[0]
            want = brute(plain, [(0, text)])[0]
            assert (ok, n_a, groups.decode()) == (want[1] > 0, want[1], want[7])
