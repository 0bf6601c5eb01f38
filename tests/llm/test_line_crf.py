import itertools

import numpy as np
import pytest
from helpers import documents, labels, write
from pyspark.sql import functions as F

from tradeledger.llm import line_crf, queries


def brute(emit, pairs):
    """Marginals and expected pairs by listing all label sequences."""
    n = len(emit)
    good, expected, total = np.zeros(n), np.zeros((2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=n):
        score = np.exp(sum(emit[i] for i in range(n) if y[i]) + sum(pairs[y[i - 1], y[i]] for i in range(1, n)))
        total += score
        good += score * np.array(y)
        for i in range(1, n):
            expected[y[i - 1], y[i]] += score
    return good / total, expected / total


def test_forward_backward_equals_listing_all_sequences():
    rng = np.random.default_rng(1)
    sizes = [1, 5, 3, 7, 1, 2]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    emit, pairs = rng.normal(size=starts[-1]), rng.normal(size=(2, 2))
    good, expected = line_crf.marginals(emit, pairs, starts)
    wanted = [brute(emit[a:b], pairs) for a, b in zip(starts, starts[1:])]
    assert np.allclose(good, np.concatenate([w[0] for w in wanted]))
    assert np.allclose(expected, sum(w[1] for w in wanted))


def test_neighbouring_lines_decide_a_neutral_one():
    good = "Well formed sentences follow each other here, and they end properly."
    bad = "BUY!! NOW!! CHEAP!! PILLS!! HERE!!"
    texts = [f"{good}\nok\n{good}\n{good}".encode(), f"{bad}\nok\n{bad}\n{bad}".encode()] * 20
    model = line_crf.train(texts, [1, 0] * 20)
    mixed = line_crf.sequence_features([f"{good}\n{good}\nok\n{good}".encode(), f"{bad}\n{bad}\nok\n{bad}".encode()])
    marginal, _ = line_crf.marginals(model.emissions(mixed[0]), model.pairs, mixed[1])
    assert marginal[2] > 0.5 > marginal[6]
    again = line_crf.train(texts, [1, 0] * 20)
    assert np.array_equal(again.weights, model.weights)


def test_one_label_only():
    assert line_crf.train([b"a"], [1]).document_scores([b"x", b"", None]).min() > 0.99
    assert line_crf.train([b"a"], [0]).document_scores([b"x", b"", None]).max() < 0.01
    assert line_crf.train([], []).document_scores([None]).min() > 0.99


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.classified_documents(spark, folder).toPandas()
    return got.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")


def test_held_out_accuracy(scored):
    held = scored[scored.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.97
    assert ((scored.score >= 0.7) == (scored.predicted == 1)).all() and scored.score.between(0, 1).all()


def test_held_out_fold(scored):
    import zlib

    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(scored.doc_id, scored.held_out))


def test_awkward_rows(spark, tmp_path):
    df = documents(spark)
    folder = write(spark, tmp_path, documents=df, labels=labels(spark, [(1, 1, 0), (5, 0, 0), (None, 1, 0), (9, None, None), (1, 0, 0)]))
    got = queries.classified_documents(spark, folder).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1  # null, empty and white texts are alike
    folder = write(spark, tmp_path, documents=documents(spark, []), labels=labels(spark))
    assert queries.classified_documents(spark, folder).count() == 0
    model = line_crf.train([b"a"], [1])
    assert line_crf.classify(documents(spark, clashing=True), model).columns.count("score") == 1


def sample_tables(spark, folder, sized):
    """Documents in the order in which the sample takes them, of the given (bytes, label)."""
    ids = spark.range(1, 200).selectExpr("id").filter(~queries.held_out("id")).orderBy(F.xxhash64("id"), "id").limit(len(sized))
    ids = [r["id"] for r in ids.collect()]
    docs = [(i, "x" * n, "en", "a", n) for i, (n, _) in zip(ids, sized)]
    marks = [(i, label, 0) for i, (_, label) in zip(ids, sized)]
    return write(spark, folder, documents=documents(spark, docs), labels=labels(spark, marks))


def test_a_long_text_takes_nothing_from_the_sample(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "CRF_BYTES", 1000)
    taken = []
    monkeypatch.setattr(line_crf, "train", lambda texts, marks: taken.extend(zip(map(len, texts), marks)))
    sized = [(300, 1), (5000, 1), (200, 0), (400, 1), (600, 0), (100, 0)]
    queries.trained_crf(spark, sample_tables(spark, tmp_path / "long", sized))
    assert sorted(taken) == [(100, 0), (200, 0), (300, 1), (400, 1)]


def test_a_sample_without_one_of_the_labels_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "CRF_BYTES", 1000)
    with pytest.raises(ValueError, match="lacks one of the labels"):
        queries.trained_crf(spark, sample_tables(spark, tmp_path / "one", [(300, 1), (5000, 0), (400, 1)]))
