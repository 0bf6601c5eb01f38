"""CSV scan that splits files anywhere, also inside quoted line breaks.

A byte split cannot know whether it begins inside a quoted field. So every line is first reduced to
its transition: the quote state behind it for either state before it. Transitions compose, so a
split reports one of four functions (a first pass, no text leaves the tasks), the functions are
composed in file order, and only then records are cut: those within a split at once, those that
cross splits from the pieces that the splits hand on. ``multiLine`` of the built-in reader would put
each file into one task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradeledger.session import stage

QUOTE = '"'
BYTE_ORDER_MARK = (0xEF, 0xBB, 0xBF)
#: Codes of the functions on the quote state: bit 0 is the state behind an outside start, bit 1 behind an inside one.
TO_OUTSIDE, SWAP, SAME, TO_INSIDE = 0b00, 0b01, 0b10, 0b11
OUTSIDE, INSIDE, CLOSED = 0, 1, 2


class Scan(NamedTuple):
    """``rows`` as text columns, ``rejects`` (file, record, reason), and the encoding found."""

    rows: DataFrame
    rejects: DataFrame
    encoding: str


def _walk(line: Column, entry: int, sep: str) -> Column:
    """Struct (state, seps) behind a line that begins in state ``entry``.

    A quote opens a field only at its start; inside, two quotes are one; elsewhere it is text.
    """

    def seps(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))

    def step(acc: Column, text: Column) -> Column:
        state, before, n = acc["state"], acc["text"], acc["n"]
        opens = F.endswith(before, F.lit(sep)) | ((n == 1) & (before == "") & (state == OUTSIDE))
        again = (state == CLOSED) & (before == "")
        behind = F.when(state == INSIDE, CLOSED).when(opens | again, INSIDE).otherwise(OUTSIDE)
        return F.struct(
            F.when(n == 0, state).otherwise(behind).alias("state"),
            text.alias("text"),
            (n + 1).alias("n"),
            F.when((n == 0) | (state == INSIDE), acc["seps"]).otherwise(acc["seps"] + seps(before)).alias("seps"),
        )

    start = F.struct(F.lit(entry).alias("state"), F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("seps"))

    def finish(acc: Column) -> Column:
        last = F.when(acc["state"] == INSIDE, 0).otherwise(seps(acc["text"]))
        return F.struct(F.when(acc["state"] == INSIDE, INSIDE).otherwise(OUTSIDE).alias("state"), (acc["seps"] + last).alias("seps"))

    return F.aggregate(F.split(line, QUOTE, -1), start, step, finish)


def _transition(line: Column, sep: str) -> Column:
    quoted = F.contains(line, F.lit(QUOTE))
    both = _walk(line, OUTSIDE, sep)["state"] + 2 * _walk(line, INSIDE, sep)["state"]
    return F.when(quoted, both).otherwise(SAME).cast("byte")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and split, in order within a split; bytes are kept as they are."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _behind(codes: np.ndarray, entry: int) -> np.ndarray:
    """State behind every line of consecutive lines that begin in state ``entry``."""
    at = np.arange(len(codes))
    fixed = (codes == TO_OUTSIDE) | (codes == TO_INSIDE)
    last = np.maximum.accumulate(np.where(fixed, at, -1))
    swaps = np.cumsum(codes == SWAP)
    start = np.where(last < 0, entry, codes[np.maximum(last, 0)] == TO_INSIDE)
    return start.astype(np.int64) ^ ((swaps - np.where(last < 0, 0, swaps[np.maximum(last, 0)])) & 1)


def _runs(batch: pa.RecordBatch):
    """(file, block, first row, end) of the splits in a batch; a split's lines stand together."""
    files, blocks = batch.column("file"), batch.column("block").to_numpy()
    files = files.dictionary_encode() if not isinstance(files, pa.DictionaryArray) else files
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
    edges = [0, *cuts.tolist(), len(blocks)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield files.dictionary[int(codes[a])].as_py(), int(blocks[a]), a, b


def survey(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(file, block, transition, broken) of each split: its function on the quote state, and whether bytes are not UTF-8."""
    lines = _lines(spark, path).select(
        "file", "block", _transition(F.col("value"), sep).alias("code"), (~F.is_valid_utf8("value")).alias("broken")
    )
    schema = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("transition", T.IntegerType()), T.StructField("broken", T.BooleanType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        now, found = None, None
        for batch in batches:
            codes = batch.column("code").to_numpy().astype(np.int64)
            broken = batch.column("broken").to_numpy(zero_copy_only=False)
            for file, block, a, b in _runs(batch):
                if now != (file, block):
                    if now:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), (*now, found[0] + 2 * found[1], found[2])))], schema=arrow)
                    now, found = (file, block), [0, 1, False]
                found = [int(_behind(codes[a:b], s)[-1]) for s in found[:2]] + [found[2] or bool(broken[a:b].any())]
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), (*now, found[0] + 2 * found[1], found[2])))], schema=arrow)

    return lines.mapInArrow(run, schema)


def _open_splits(splits: DataFrame) -> DataFrame:
    """(file, block) of the splits that begin inside a quoted field.

    The composition in file order: the last fixed state, changed by the swaps since. One row
    a split, so a window over a file is short.
    """
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    fixed = F.col("transition").isin(TO_OUTSIDE, TO_INSIDE)
    swaps = F.sum(F.when(F.col("transition") == SWAP, 1).otherwise(0)).over(W.partitionBy("file").orderBy("block"))
    counted = splits.withColumn("_swaps", swaps)
    last = F.last(F.when(fixed, F.struct("transition", "_swaps")), ignorenulls=True).over(before)
    upto = F.last("_swaps").over(before)
    placed = counted.select("file", "block", last.alias("_last"), upto.alias("_upto"))
    start = F.coalesce((F.col("_last.transition") == TO_INSIDE).cast("int"), F.lit(0))
    since = F.coalesce(F.col("_upto"), F.lit(0)) - F.coalesce(F.col("_last._swaps"), F.lit(0))
    return placed.filter((start + since) % 2 == 1).select("file", "block")


WHOLE, HEAD, TAIL = 0, 1, 2


def _pieces(spark: SparkSession, path: str, opened: DataFrame, sep: str) -> DataFrame:
    """Records of every split: whole ones, the head that ends an earlier split's record, and the tail that a later one ends."""
    starts = F.broadcast(opened.select(F.col("file").alias("_f"), F.col("block").alias("_b")))  # a row of some 100 bytes for a split at most
    lines = _lines(spark, path).join(starts, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")), "left")
    lines = lines.select(
        "file", "block", _transition(F.col("value"), sep).alias("code"), F.col("_b").isNotNull().alias("open"), F.col("value").cast("binary").alias("value")
    )
    schema = T.StructType(
        [T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("at", T.LongType()), T.StructField("kind", T.IntegerType()),
         T.StructField("ended", T.BooleanType()), T.StructField("record", T.BinaryType())]
    )
    arrow = to_arrow_schema(schema)

    def rows(file, block, ats, kinds, ended, records):
        n = len(ats)
        values = [[file] * n, [block] * n, ats, kinds, ended, records]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow)], schema=arrow)

    def run(batches):
        now, held = None, None  # held: lines of the record that is open
        state = at = kind = first = 0

        def rest():
            if held:
                # what the split leaves open: a tail, or a head that goes on
                yield rows(*now, [first], [TAIL if kind == WHOLE else HEAD], [False], [b"\n".join(held)])

        for batch in batches:
            codes = batch.column("code").to_numpy().astype(np.int64)
            for file, block, a, b in _runs(batch):
                if now != (file, block):
                    yield from rest()
                    now, at, held = (file, block), 0, []
                    state = int(batch.column("open")[a].as_py())
                    kind, first = (HEAD if state else WHOLE), 0
                behind = _behind(codes[a:b], state)
                before = np.concatenate([[state], behind[:-1]])
                single = (before == 0) & (behind == 0)
                values = batch.column("value").slice(a, b - a)
                alone = np.flatnonzero(single)
                if len(alone):
                    yield rows(file, block, at + alone, [WHOLE] * len(alone), [True] * len(alone), values.take(pa.array(alone)))
                many = np.flatnonzero(~single)
                out = ([], [], [], [])
                for i, value in zip(many.tolist(), values.take(pa.array(many)).to_pylist()):
                    if before[i] == 0:
                        kind, first, held = WHOLE, at + i, []
                    held.append(value)
                    if behind[i] == 0:
                        for o, v in zip(out, (first, kind, True, b"\n".join(held))):
                            o.append(v)
                        kind, held = WHOLE, []
                if out[0]:
                    yield rows(file, block, *out)
                state, at = int(behind[-1]), at + b - a
        yield from rest()

    return lines.mapInArrow(run, schema)


def records(spark: SparkSession, path: str, sep: str = ",") -> tuple[DataFrame, str]:
    """((file, block, at, ended, record) of every record, a staged table; ``utf-8`` or ``latin-1``)."""
    splits = stage(survey(spark, path, sep), "csv-splits")
    broken = splits.agg(F.coalesce(F.bool_or("broken"), F.lit(False))).first()[0]
    found = stage(_pieces(spark, path, _open_splits(splits), sep), "csv-records")
    whole = found.filter(F.col("kind") == WHOLE).select("file", "block", "at", "ended", "record")
    # a record that crosses splits: its tail and the heads up to the next tail
    number = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(W.partitionBy("file").orderBy("block", "at"))
    crossing = found.filter(F.col("kind") != WHOLE).withColumn("_number", number)
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "record"))).alias("_parts")
    crossing = crossing.groupBy("file", "_number").agg(parts, F.bool_or("ended").alias("ended"))
    text = F.aggregate(F.slice("_parts", 2, F.size("_parts")), F.col("_parts")[0]["record"], lambda a, p: F.concat(a, F.lit(b"\n"), p["record"]))
    crossing = crossing.select("file", F.col("_parts")[0]["block"].alias("block"), F.col("_parts")[0]["at"].alias("at"), "ended", text.alias("record"))
    made = whole.unionByName(crossing)
    decoded = F.decode("record", "ISO-8859-1") if broken else F.col("record").cast("string")
    # the line end of a record may have a carriage return in front
    ended = F.when(F.col("ended") & F.endswith(decoded, F.lit("\r")), F.left(decoded, F.length(decoded) - 1)).otherwise(decoded)
    return made.withColumn("record", ended), "latin-1" if broken else "utf-8"


def _starts_with_mark(spark: SparkSession, file: str) -> bool:
    """Whether a file begins with a UTF-8 byte-order mark, which the line reader drops (three bytes are read)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(file))
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return tuple(stream.read() for _ in BYTE_ORDER_MARK) == BYTE_ORDER_MARK
    finally:
        stream.close()


def _parsed(record: Column, names: list[str], sep: str) -> Column:
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE", "maxColumns": str(max(20480, len(names) + 1))}
    return F.from_csv(record, _ddl(names), options)


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in names)


def scan(spark: SparkSession, path: str, sep: str = ",") -> Scan:
    """Every record of the CSV files under ``path`` below their header, as text.

    Empty fields (also quoted ones) are null, blank lines are skipped, records with fewer fields
    than the header are filled with nulls. Records with more fields, and one that a file leaves
    open, are rejected with the reason. Each file has a header, the same in all of them.
    """
    found, encoding = records(spark, path, sep)
    blank = F.col("record") == ""
    shown = found.filter(~blank)
    first = shown.groupBy(F.col("file").alias("_f")).agg(F.min(F.struct("block", "at", "record")).alias("_first"))
    headers = first.select(F.col("_first.record").alias("h"), F.col("_f").alias("f")).groupBy("h").agg(F.min("f").alias("f")).limit(3).collect()
    if len(headers) > 1:
        raise ValueError(f"the files under {path} have different headers")
    if not headers:
        raise ValueError(f"no header under {path}")
    if encoding == "utf-8" and _starts_with_mark(spark, headers[0]["f"]):
        encoding = "utf-8-sig"
    header = headers[0]["h"]
    n = spark.range(1).select(_walk(F.lit(header), OUTSIDE, sep)["seps"]).first()[0] + 1
    line = spark.range(1).select(_parsed(F.lit(header), [f"c{i}" for i in range(n)], sep).alias("h")).select("h.*").first()
    names, seen = [], set()
    for i, name in enumerate(line):
        name, k = name if name is not None else f"Unnamed: {i}", 1
        while (unique := name if k == 1 else f"{name}.{k - 1}").lower() in seen:
            k += 1
        seen.add(unique.lower())
        names.append(unique)
    heads = F.broadcast(first.select("_f", F.col("_first.block").alias("_fb"), F.col("_first.at").alias("_fa")))  # a row a file
    body = shown.join(heads, F.col("file") == F.col("_f")).filter(~((F.col("block") == F.col("_fb")) & (F.col("at") == F.col("_fa"))))
    fields = F.when(F.contains("record", F.lit(QUOTE)), _walk(F.col("record"), OUTSIDE, sep)["seps"]).otherwise(
        F.length("record") - F.length(F.replace("record", F.lit(sep), F.lit("")))
    ) + 1
    reason = F.when(~F.col("ended"), "quoted field without an end").when(fields > n, F.concat(fields.cast("string"), F.lit(f" fields, the header has {n}")))
    judged = body.withColumn("reason", reason)
    rows = judged.filter(F.col("reason").isNull()).select(_parsed(F.col("record"), names, sep).alias("_row")).select("_row.*")
    return Scan(rows, judged.filter(F.col("reason").isNotNull()).select("file", "record", "reason"), encoding)


def inferred(rows: DataFrame) -> DataFrame:
    """Text columns whose values all read as whole numbers, numbers or booleans get that type; one aggregate."""
    def col(c):
        return F.col("`" + c.replace("`", "``") + "`")

    def fails(c, ok):
        return F.count(F.when(col(c).isNotNull() & ~ok, 1))

    tests = {
        "bigint": lambda c: F.coalesce(col(c).rlike(r"^[+-]?[0-9]+$") & col(c).try_cast("bigint").isNotNull(), F.lit(False)),
        "double": lambda c: F.coalesce(col(c).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.lit(False)),
        "boolean": lambda c: F.lower(col(c)).isin("true", "false"),
    }
    asked = [(c, kind) for c in rows.columns for kind in tests]
    found = rows.agg(*[F.count(col(c)) for c in rows.columns], *[fails(c, tests[kind](c)) for c, kind in asked]).first()
    filled = dict(zip(rows.columns, found))
    failed = dict(zip(asked, found[len(rows.columns) :]))
    made = []
    for c in rows.columns:
        kind = next((k for k in tests if filled[c] and not failed[c, k]), None)
        made.append((col(c).cast(kind) if kind else col(c)).alias(c))
    return rows.select(*made)
