import random

from helpers import documents, words

from tradeledger.llm import license_scan as ls


def brute(text):
    w = words(text)
    places = {t.label: [i for i in range(len(w) - len(t.words) + 1) if w[i : i + len(t.words)] == t.words] for t in ls.BASE}
    starts = [i for p in places.values() for i in p]
    base = sorted(k for k, p in places.items() if p)
    shares = {}
    for t in ls.TEMPLATES:
        for at in range(0, len(w), t.stride):
            held = len(set(w[at : at + 2 * t.stride]) & set(t.tokens))
            if held >= t.needed(ls.THRESHOLD):
                shares[t.label] = max(shares.get(t.label, 0), held / len(t.tokens))
    score = max([1.0] * bool(base) + list(shares.values()), default=0.0)
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(w), len(starts), first, last, ",".join(base), ",".join(sorted({*base, *shares})), score


def found(df):
    return sorted(((r[0], tuple(r)[1:]) for r in df.collect()), key=str)


def test_equals_every_block_against_every_template(spark):
    rng = random.Random(3)
    pool = [w for t in ls.BASE + ls.TEMPLATES for w in t.words] + ["lorem", "ipsum", "dolor"]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(1, 8)):
            t = rng.choice(ls.BASE + ls.TEMPLATES).words
            part = [w for w in t if rng.random() > rng.choice((0, 0.1, 0.3))]
            if rng.random() < 0.3:
                rng.shuffle(part)
            text += part + rng.choices(pool, k=rng.randrange(0, 40))
        rows.append((i, rng.choice((" ", ", ", "\n")).join(text).title(), "en", "s", 1))
    df = documents(spark, rows)
    assert found(ls.scan(df, keep=["doc_id"])) == sorted(((r[0], brute(r[1])) for r in rows), key=str)


def test_awkward_rows(spark):
    df = documents(spark, clashing=True)
    got = ls.scan(df)
    assert "own size" in [r["size"] for r in got.collect()] and got.columns.count("score") == 1
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found(ls.scan(df, keep=["doc_id"])) == sorted(((i, brute(t)) for i, t in rows), key=str)
    assert ls.scan(documents(spark, [])).count() == 0


def test_every_matching_block_is_found(spark):
    rng = random.Random(9)
    template = ls.TEMPLATES[1].words
    rows = []
    for i in range(30):
        parts = [rng.choices(["lorem", "ipsum", "license", "file"], k=rng.randrange(0, 90)) + template[rng.randrange(0, 4) :] for _ in range(3)]
        rows.append((i, " ".join(w for p in parts for w in p) + rng.choice(("", " cc by nc")), "en", "s", 1))
    wanted = []
    for doc_id, text, *_ in rows + [(99, None), (98, "")]:
        w = words(text)
        for t in ls.BASE + ls.TEMPLATES:
            for at in range(0, len(w), t.stride):
                block = w[at : at + 2 * t.stride]
                held = len(set(block) & set(t.tokens))
                inside = any(block[i : i + len(t.words)] == t.words for i in range(t.stride))
                if inside if t.phrase else held >= t.needed(ls.THRESHOLD):
                    wanted.append((doc_id, t.label, held / len(t.tokens), at, at + len(block) - 1))
    df = documents(spark, [*rows, (99, None, "", "", 0), (98, "", "", "", 0)])
    got = ls.matching_blocks(df, keep=["doc_id"])
    assert sorted(map(tuple, got.collect())) == sorted(wanted) and len(wanted) > 30
    assert ls.matching_blocks(documents(spark, clashing=True)).columns.count("share") == 1


def test_whole_license_texts_wherever_they_begin(spark, monkeypatch):
    full = next(t for t in ls.TEMPLATES if t.label == "mit-full")
    assert len(full.words) > 150 and full.stride >= len(full.words) - 1
    rng = random.Random(4)
    rows = []
    for i in range(24):
        kept = [w for w in full.words if rng.random() > (0, 0.1, 0.5)[i % 3]]
        rows.append((i, " ".join(["lorem"] * rng.randrange(0, 700) + kept + ["ipsum"] * rng.randrange(0, 300)), "en", "s", 1))
    df = documents(spark, rows)
    got = found(ls.scan(df, keep=["doc_id"]))
    assert got == sorted(((r[0], brute(r[1])) for r in rows), key=str)
    assert all("mit-full" in r[1][5] for r in got if r[0] % 3 == 0) and not any("mit-full" in r[1][5] for r in got if r[0] % 3 == 2)
    monkeypatch.setattr(ls, "MOST_PREFIXES", 0)  # as with thousands of license texts
    assert found(ls.scan(df, keep=["doc_id"])) == got


def test_filters_use_the_rarest_words(spark):
    df = documents(spark, [(i, "the license" if i else "mit", "", "", 0) for i in range(9)])
    order = ls.global_order(df.select(ls.words(df.text).alias("_words")), ls.BASE)
    assert order[-3:] == ["mit", "license", "the"]
    rows = ls.prefix_rows(spark, ls.BASE, order, 0.8).collect()
    assert {r["label"]: r["token"] for r in rows}["mit"] == "under" and len(rows) == len(ls.BASE)
