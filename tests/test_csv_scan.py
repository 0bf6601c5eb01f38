"""The quote-aware CSV scan against an independent reader, cut at every byte."""

import random

import duckdb
import numpy as np
import pytest

from tradeledger.session import stage
from tradeledger.sources import csv_scan, readers

ODD = (
    'id,note,"the, name",x\n1,"a\nb","q ""quoted""",\n2,plain "text" here,,5\n\n3,"","line\r\nbreak ""\n"\n'
    '"4","é,\n,\n""",z,"last"\n5,a,b,"c"'
)
FILES = {
    "odd": ODD,
    "carriage returns": ODD.replace("\r\n", "\n").replace("\n", "\r\n"),
    "only breaks": 'a,b\n"\n\n\n","\n""\n"\n"","""\n"\n',
    "no quotes": "a,b\n1,2\n3,4\n",
    "mark": "﻿a,b\n1,\"x\ny\"\n",
    "header only": "a,b\n",
    "header with a break": '"a\nb",c\n1,2\n',
    "one column": 'a\n"x\n"\n"y"\n',
}


def other_reader(path):
    options = "all_varchar=true, header=true, quote='\"', escape='\"', delim=',', null_padding=true, strict_mode=false, parallel=false"
    return sorted(duckdb.execute(f"select * from read_csv('{path}', {options})").fetchall(), key=str)


@pytest.fixture
def cut(spark, monkeypatch):
    """Sets the largest split in bytes while the CSV files are read; staged tables are read as usual."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def back():
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)

    def staged(df, name):
        out = stage(df, name)
        if name == "csv-splits":
            return spark.createDataFrame(out.toPandas(), out.schema)
        back()
        return out

    def to(size):
        monkeypatch.setattr(csv_scan, "stage", staged)
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1000000")  # else the files are cut by the number of cores
        spark.conf.set(names[2], "1")

    yield to
    back()


def texts(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", list(FILES))
def test_equals_another_reader(spark, tmp_path, cut, name):
    path = tmp_path / "t.csv"
    path.write_bytes(FILES[name].encode())
    want = other_reader(path)
    for size in (1 << 20, 7) if name == "odd" else (7,):
        cut(size)
        found = csv_scan.scan(spark, str(path))
        assert texts(found.rows) == want, size
        assert found.rejects.count() == 0
        assert found.encoding == ("utf-8-sig" if name == "mark" else "utf-8")


def test_splits_at_every_byte(spark, tmp_path, cut):
    path = tmp_path / "t.csv"
    path.write_bytes(ODD.encode())
    want = other_reader(path)
    for size in (1, 17):  # splits begin at every byte, at every seventeenth
        cut(size)
        assert texts(csv_scan.scan(spark, str(path)).rows) == want, size


def test_transitions_compose_in_file_order(spark):
    rng, rows, want = random.Random(5), [], set()
    for f in range(4):
        state = 0
        for block in range(40):
            code = rng.choices((csv_scan.TO_OUTSIDE, csv_scan.SWAP, csv_scan.SAME, csv_scan.TO_INSIDE), (1, 4, 4, 1))[0]
            if state:
                want.add((f"f{f}", block * 10))
            rows.append((f"f{f}", block * 10, code, False))
            state = code >> state & 1
        codes = np.array([r[2] for r in rows if r[0] == f"f{f}"])
        for entry in (0, 1):
            state, naive = entry, []
            for c in codes.tolist():
                state = c >> state & 1
                naive.append(state)
            assert csv_scan._behind(codes, entry).tolist() == naive
    rng.shuffle(rows)
    splits = spark.createDataFrame(rows, "file string, block long, transition int, broken boolean")
    assert {tuple(r) for r in csv_scan._open_splits(splits).collect()} == want and len(want) > 20


def test_several_files_rejects_and_latin_1(spark, tmp_path, cut):
    (tmp_path / "a.csv").write_bytes("id,city\n1,São\n2,a,b\n3\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes('id,city\n4,"x\ny"\n5,"never\nends\n6,z\n'.encode())
    for size in (1 << 20, 5):
        cut(size)
        found = csv_scan.scan(spark, str(tmp_path))
        assert found.encoding == "latin-1"
        assert texts(found.rows) == [("1", "São"), ("3", None), ("4", "x\ny")]
        rejects = {(r["file"].rsplit("/", 1)[1], r["record"], r["reason"]) for r in found.rejects.collect()}
        assert rejects == {("a.csv", "2,a,b", "3 fields, the header has 2"), ("b.csv", '5,"never\nends\n6,z\n'.rstrip("\n"), "quoted field without an end")}
    (tmp_path / "c.csv").write_bytes(b"other,city\n1,x\n")
    with pytest.raises(ValueError, match="different headers"):
        csv_scan.scan(spark, str(tmp_path))


def test_empty_file_and_repeated_names(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"")
    with pytest.raises(ValueError, match="no header"):
        csv_scan.scan(spark, str(tmp_path / "e.csv"))
    (tmp_path / "n.csv").write_bytes(b"a,a,,A\n1,2,3,4\n")
    assert csv_scan.scan(spark, str(tmp_path / "n.csv")).rows.columns == ["a", "a.1", "Unnamed: 2", "A.2"]


def test_types_and_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b'n,x,flag,mixed,empty,review_date,"a.b"\n1,1.5,true,1,,2020-01-02,7\n-2,3,False,x,,2021-01-01 10:00:00,8\n')
    df, _, dates = readers.read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "boolean", "string", "string", "timestamp", "bigint"] and dates == ["review_date"]
    plain, _, _ = readers.read_csv(spark, str(path), schema="n int, x string, flag boolean, mixed int, empty int, d date, e long")
    assert [tuple(r)[:4] for r in plain.orderBy("n").collect()] == [(-2, "3", False, None), (1, "1.5", True, 1)]
