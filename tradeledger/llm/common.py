"""What several operators share: tables, Arrow batches of texts, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Texts of at most so many bytes are handled together inside a task (a longer text alone).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def safe_names(df: DataFrame) -> DataFrame:
    """``df`` with columns _c0, _c1, ... that clash with nothing an operator adds."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t or b"") > limit:
            yield start, i
            start, size = i, 0
        size += len(t or b"")
    if start < len(texts):
        yield start, len(texts)


def sliced(batches: Iterator[pa.RecordBatch], rows: int | None) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that fewer become Python objects at once."""
    for b in batches:
        if rows is None:
            yield b
        else:
            yield from (b.slice(i, rows) for i in range(0, b.num_rows, rows))


def map_texts(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[..., list[list]]],
    keep: list[str] | None = None,
    replace_text: bool = False,
    inputs: list[str] | None = None,
    slice_rows: int | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (all by default) and new ones computed from the UTF-8 bytes of ``text``.

    ``make`` runs once in each task and returns a function from a list of texts (None for
    null), and one list for each of ``inputs``, to one list of values per field; with
    ``replace_text`` the first list is the new text. Rows stay in place: nothing is shuffled, and an Arrow batch is cut into chunks of
    bounded bytes.
    """
    made = {f.name.lower() for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    more = [col(c).alias(f"__in{i}") for i, c in enumerate(inputs or [])]
    # a kept text is sent to Python once
    own = keep.index(text) if text in keep and isinstance(df.schema[text].dataType, T.StringType) else len(keep)
    sent = [] if own < len(keep) else [col(text).cast("string").alias("__text")]
    source = df.select(*[col(c) for c in keep], *sent, *more)
    begin = len(keep) + len(sent)
    schema = T.StructType([*source.schema.fields[: len(keep)], *fields])
    arrow = to_arrow_schema(schema)
    at = keep.index(text) if replace_text else -1
    n_inputs = len(more)

    def run(batches):
        step = make()
        for batch in sliced(batches, slice_rows):
            texts = batch.column(own).cast(pa.binary()).to_pylist()
            others = [batch.column(begin + i).to_pylist() for i in range(n_inputs)]
            for a, b in chunks(texts, chunk_bytes):
                values = step(texts[a:b], *[o[a:b] for o in others])
                columns = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                if replace_text:
                    columns[at] = pa.array(values[0], pa.binary()).cast(pa.string())
                    values = values[1:]
                columns += [pa.array(v, f.type) for v, f in zip(values, list(arrow)[len(keep) :])]
                columns = [c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def held_out(doc_id: str):
    """True for the fold that no learner sees: crc32 of the id as text, remainder 2 of 4."""
    return F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def usable_labels(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the documents of ``docs`` that a learner may see: labels 0 and 1, without the held-out fold.

    One row for each id; contradicting labels count as the smaller one. Labels of other documents
    and other values are left out.
    """
    wanted = labels.select(col("doc_id").alias("doc_id"), col(label).cast("int").alias("label"))
    wanted = wanted.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    wanted = wanted.groupBy("doc_id").agg(F.min("label").alias("label"))
    return wanted.join(docs.select(col("doc_id").alias("doc_id")), "doc_id", "left_semi")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` training documents with their label: columns doc_id, text, label.

    The ids are drawn by a hash from the labels of ``docs``, the same on every run. Only
    these ids are broadcast, so the bound on the broadcast is ``rows``.
    """
    wanted = usable_labels(docs, labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select(col("doc_id").alias("doc_id"), col("text").cast("string").alias("text")).join(
        F.broadcast(wanted), "doc_id"
    )


def bounded_rows(df: DataFrame, rows: int) -> list:
    """The sample on the driver in a fixed order; repeated ids may exceed ``rows`` no further than the limit."""
    return df.orderBy("doc_id", *[c for c in df.columns if c != "doc_id"]).limit(rows).collect()


def ragged(counts: np.ndarray) -> np.ndarray:
    """Start offsets of consecutive groups of the given sizes, and the end."""
    return np.concatenate([[0], np.cumsum(counts)])
