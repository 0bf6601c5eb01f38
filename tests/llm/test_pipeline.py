import corpus_pipeline as cp
from helpers import benchmark, documents, labels, words, write

import __spark_entry__ as entry
from tradeledger.llm import pseudonyms, queries
from tradeledger.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_eleven_queries_are_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "pii", "mixing"]
    assert cp.ORACLE_SQL is None


def test_every_stage_against_its_definition(spark):
    """Each stage on all that its predecessor kept, held against plain Python."""
    from test_decontamination import brute
    from test_simhash import brute_fingerprint, brute_groups

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for name, function in cp.STAGES:
        frames.append(stage(function(spark, frames[-1], FOLDER), "test-stage"))
    assert all(f.columns == columns for f in frames[:-1])
    before, good, single, clean, private, mixed = ({r["doc_id"]: r for r in f.collect()} for f in frames)

    model = queries.trained_crf(spark, FOLDER)
    assert set(good) == {i for i, r in before.items() if model.document_scores([r["text"].encode()])[0] >= queries.GOOD_SCORE}
    assert 0 < len(good) < len(before)

    fps = {i: brute_fingerprint(r["text"]) for i, r in good.items()}
    _, groups = brute_groups(sorted(set(fps.values())))
    assert set(single) == {min(i for i in good if groups[fps[i]] == g) for g in set(groups.values())}

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for i, r in clean.items():
        n, spans, _ = brute(single[i]["text"], items)
        w = words(single[i]["text"])
        left = [x for k, x in enumerate(w) if not any(a <= k < b for a, b in spans)]
        assert words(r["text"]) == left and (spans or r == single[i])
    assert set(clean) == set(single)

    worker = pseudonyms.Pseudonymiser(queries.DEMO_KEY.encode())
    assert all(r["text"] == worker.text(clean[i]["text"])[0] and r["n_chars"] == len(r["text"]) for i, r in private.items())
    assert any(r["text"] != clean[i]["text"] for i, r in private.items())

    assert all(r["text"] == private[i]["text"] and r["copies"] > 0 for i, r in mixed.items())
    assert abs(sum(r["taken"] for r in mixed.values()) / sum(len(r["text"].split()) for r in private.values()) - 1) < 0.2
    run = {tuple(r) for r in cp.run(spark, FOLDER).collect()}
    assert run == {tuple(r) for r in frames[-1].collect()}


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    for df in (documents(spark, clashing=True), documents(spark, [])):
        folder = write(spark, tmp_path, documents=df, labels=labels(spark, [(1, 1, 0), (None, 0, 0)]), benchmark=benchmark(spark, [(1, "seven wizards mix a potion"), (None, None)]))
        at = spark.read.parquet(f"{folder}/documents.parquet")
        for k, (name, function) in enumerate(cp.STAGES):
            at = stage(function(spark, at, folder), "test-awkward")
            assert at.columns[: len(df.columns)] == df.columns and (k == 4 or at.columns == df.columns)
        if df.count():
            assert at.count() and {r["size"] for r in at.collect()} == {"own size"}
            assert not any("wizards" in (r["text"] or "") for r in at.collect())
