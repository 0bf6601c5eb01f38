"""The learners' samples: drawn from labels of documents at hand, loud when a label is missing."""

import pytest
from helpers import documents, labels, write

from tradeledger.llm import queries
from tradeledger.llm.common import labelled_sample, usable_labels

GOOD = "A plain sentence of several words follows another one. The river runs past the old mill every day.\n" * 6
BAD = "click here $$$ buy now *** >>>\n" * 30


def tables(spark, folder, more=()):
    rows = [(i, GOOD if i % 2 else BAD, "en", "a", 0) for i in range(120)]
    own = [(i, i % 2, 0) for i in range(120)]
    return write(spark, folder, documents=documents(spark, rows), labels=labels(spark, [*own, *more]))


def test_labels_of_other_documents_change_nothing(spark, tmp_path):
    other = [(1000 + i, i % 2, 0) for i in range(20_000)] + [(1, None, 0), (None, 1, 0), (3, 7, 0)]
    plain, crowded = tables(spark, tmp_path / "a"), tables(spark, tmp_path / "b", other)
    for learn in (queries.learned_rules, queries.trained_crf):
        one, two = learn(spark, plain, 200), learn(spark, crowded, 200)
        assert one and str(getattr(one, "__dict__", one)) == str(getattr(two, "__dict__", two))


def test_only_labels_of_the_documents_are_drawn(spark):
    docs = documents(spark, [(i, "t", None, None, 0) for i in range(40)])
    given = labels(spark, [(i, i % 3, 0) for i in range(4000)] + [(4, 0, 0)])
    drawn = labelled_sample(docs, given, "quality", 10).collect()
    assert len(drawn) == 10 and all(r["doc_id"] < 40 and r["label"] in (0, 1) for r in drawn)
    assert usable_labels(docs, given, "quality").filter("doc_id = 4").first()["label"] == 0


def test_a_sample_without_one_of_the_labels_is_an_error(spark, tmp_path):
    folder = tables(spark, tmp_path)
    for learn in (queries.learned_rules, queries.trained_crf):
        with pytest.raises(ValueError, match="lacks one of the labels"):
            learn(spark, folder, 1)
