import random

import xxhash
from helpers import RUN, documents, lowered

from tradeledger.llm import simhash as sh


def brute_fingerprint(text):
    w = RUN.findall(lowered(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, bits=3):
    """Smallest fingerprint reachable."""
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    pairs = set()
    for a in fps:
        for b in fps:
            if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= bits:
                pairs.add((a, b))
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return pairs, {f: top(f) for f in fps}


def planted(rng, n=120):
    fps = {rng.getrandbits(64) for _ in range(n)} | {0, (1 << 64) - 1}
    for f in list(fps):
        for _ in range(rng.randrange(4)):
            g = f
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                g ^= 1 << b
            fps.add(g)
            f = g if rng.random() < 0.5 else f
    return sorted(sh.signed(f) for f in fps)


def test_links_and_groups_equal_all_pairs(spark):
    fps = planted(random.Random(9))
    pairs, groups = brute_groups(fps)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for segments, bits in ((8, 3), (4, 3), (16, 3), (8, 1), (8, 5)):
        wanted = pairs if bits == 3 else brute_groups(fps, bits)[0]
        got = [(r["a"], r["b"]) for r in sh.links(frame, sh.Ring(segments, bits)).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted
    found = {r["node"]: r["root"] for r in sh.roots(frame).collect()}
    assert found == {f: g for f, g in groups.items() if any(f in p for p in pairs)}


def test_long_chain_is_one_group(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in sh.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}
    assert sh.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    df = documents(spark, clashing=True)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    fps = {t: brute_fingerprint(t) for _, t in rows}
    assert fps[None] == fps[""] == 0
    _, groups = brute_groups(sorted(set(fps.values())))
    least = {}
    for i, t in rows:
        if i is not None:
            g = groups[fps[t]]
            least[g] = min(least.get(g, i), i)
    wanted = sorted(((i, f"{fps[t]:016x}", least.get(groups[fps[t]])) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in sh.near_duplicates(df).collect()), key=str) == wanted
    assert sh.near_duplicates(documents(spark, [])).count() == 0

    kept = sh.keep_one(df).collect()
    alone = {groups[fps[t]] for _, t in rows} - set(least)  # groups without any id
    assert sorted(str(r["doc_id"]) for r in kept) == sorted([str(i) for i in least.values()] + ["None"] * len(alone))
    assert kept[0]["fp"] == "own fp" and sh.keep_one(documents(spark, [])).count() == 0
