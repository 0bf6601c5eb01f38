import numpy as np
from helpers import RUN, documents, labels, write

from tradeledger.llm import quality_rules as qr
from tradeledger.llm import queries


def brute(text):
    text = text or ""
    w = RUN.findall(text)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if RUN.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_statistics(spark):
    texts = [r[1] for r in documents(spark).collect()] + ["a a a a", "a b c a b c", "x y z\nx y z\n\nx y z \n", "#*|<> é #", "a b", "a b c d a b c"]
    for t in texts:
        assert qr.statistics((t or "").encode())[:5] == brute(t)
    assert qr.covered_words(np.arange(10) % 3) == 10
    big = np.array([1 << 40, 1 << 41, 5, 7, 1 << 40, 1 << 41, 5])
    assert qr.covered_words(big) == 6


def test_learns_a_conjunction_and_the_column_agrees(spark):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.random((2000, len(qr.FEATURES) - 1)), rng.integers(1, 500, 2000)])
    bad = (x[:, 2] > 0.8) & (x[:, 8] < 250)
    rules = qr.learn(x, bad)
    said = np.zeros(len(x), bool)
    for rule in rules:
        said |= rule.covers(x)
    assert (said == bad).mean() > 0.97 and len(rules) < 6
    frame = qr.with_statistics(documents(spark), "text", ["doc_id"])
    hand = [qr.Rule([("repeat_share", ">=", 0.4)]), qr.Rule([("n_words", "<=", 3.0), ("upper_share", "<=", 0.5)])]
    kept, number = qr.verdict_columns(hand)
    for r in frame.withColumns({"kept": kept, "rule_number": number}).collect():
        m = qr.feature_matrix([r])
        wanted = next((i for i, rule in enumerate(hand) if rule.covers(m)[0]), None)
        assert r["rule_number"] == wanted and r["kept"] == (wanted is None)


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.quality_rule_verdicts(spark, folder).toPandas()
    assert ((got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words) == got.base_failed).all()
    assert not (got.kept & got.base_failed).any()
    known = got.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    rest = known[~known.base_failed]
    assert (rest.kept == (rest.quality == 1)).mean() > 0.97


def test_awkward_rows(spark, tmp_path):
    df = documents(spark, clashing=True)
    folder = write(spark, tmp_path, documents=df, labels=labels(spark, [(1, 1, 0), (5, 0, 0), (None, 0, 0), (2, None, 0)]))
    got = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in queries.quality_rule_verdicts(spark, folder).collect()}
    assert got == {(r["doc_id"], *brute(r["text"])) for r in df.collect()}
    folder = write(spark, tmp_path, documents=documents(spark, []), labels=labels(spark))
    assert queries.quality_rule_verdicts(spark, folder).count() == 0
