"""Small tables with every awkward case, and plain versions of shared definitions."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use or return themselves.
CLASHING = ("size", "copies", "score", "labels", "n_words", "spans", "fp", "row", "body", "number", "_row", "host", "target")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lowered(text))


PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of stars and salt"


def awkward_rows():
    """Nulls, empty and white texts, repeated rows, equal texts, one id twice, a long text, other alphabets."""
    long_text = " ".join(f"{PASSAGE} number{i}x\nline {i} says É ñ ß" for i in range(1500))
    rows = [
        (1, PASSAGE + ". Released under the MIT License.", "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \t\n\r\x0b\x0c ", "en", "b", 7),
        (None, PASSAGE + " without an id", "en", None, 3),
        (None, None, None, None, None),
        (5, long_text, "en", "a", 9),
        (6, PASSAGE + ". Released under the MIT License.", "en", "a", 1),
        (7, "K Kelvin İstanbul ÀÉ 漢字 \x00 nul\x00byte 😀 🙂", "xx", "c", 1),
        (8, "one", "en", "c", 3),
        (9, "mail ann.lee42@mail7.example.com card 4111 1111 1111 1111 on 2021-02-29 and 2021-02-28", "en", "c", 3),
    ]
    return rows + [rows[0], rows[4], (5, "another text of an id in use", "en", "b", 2)]


def documents(spark, rows=None, clashing=False):
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, DOCS)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})
    return df


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
