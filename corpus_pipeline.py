"""A training corpus from raw documents, stage by stage.

Every stage is (name, function of spark, docs, sf_dir). Its result is written as Parquet in the
shared folder and read again as the next stage's documents, so a lost executor costs a task
and never the chain. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm import decontamination, line_crf, mixing, pseudonyms, queries, simhash
from tradeledger.llm.common import col, free_name, safe_names, table
from tradeledger.session import stage

#: Fixed by the contract of the near-duplicate stage.
SHINGLE_WORDS, MAX_BITS = 3, 3


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text that a stage has changed, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    plain = safe_names(docs)
    body = plain.columns[docs.columns.index("text")]
    scored = line_crf.classify(plain, queries.trained_crf(spark, sf_dir), body)
    return scored.filter(F.col("score") >= queries.GOOD_SCORE).select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of the smallest id."""
    return simhash.keep_one(docs, words=SHINGLE_WORDS, max_bits=MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows are cut out of the texts."""
    return with_length(decontamination.remove_benchmark(docs, table(spark, sf_dir, "benchmark")))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses are replaced in the texts, with the session's secret."""
    plain = safe_names(docs)
    body = plain.columns[docs.columns.index("text")]
    done = pseudonyms.pseudonymise(plain, queries.pseudonym_key(spark), body)
    return with_length(done.select(*plain.columns).toDF(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document it takes, with the number of copies."""
    names = list(docs.columns)
    row, text, source, doc_id = (free_name(docs, c) for c in ("row", "body", "origin", "number"))
    packed = docs.select(
        F.struct(*[col(c) for c in names]).alias(row), col("text").alias(text), col("source").alias(source), col("doc_id").alias(doc_id)
    )
    mixed = mixing.mix(packed, text=text, source=source, doc_id=doc_id, keep=[row]).filter("copies > 0")
    made = [c for c in mixed.columns if c != row]
    taken = {n.lower() for n in names}
    return mixed.select(f"{row}.*", *[F.col(c).alias(c if c.lower() not in taken else f"mix_{c}") for c in made])


STAGES = [
    ("quality classifier", classify_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("pii", pseudonymise),
    ("mixing", mix_sources),
]

#: Trained weights and fingerprints have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
