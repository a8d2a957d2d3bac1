"""Fixed-width files by byte ranges, and files that appear only when all tasks are done."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import fixed_width, record_files


def listed(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith("."))


@pytest.mark.parametrize("split", [1, 3, 1000])
def test_numbers_and_records_are_those_of_lines(spark, tmp_path, split):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"".join(b"%05d \xe9\x00x\n" % i for i in range(40)))
    (folder / "b.txt").write_bytes(b"first    \nlast    .")
    (folder / "empty.txt").write_bytes(b"")
    (folder / "_noise").write_bytes(b"not a record")
    got = record_files.read_fixed(spark, str(folder), 9, splitRecords=str(split))
    want = fixed_width.read_records(spark, [str(folder / "a.txt"), str(folder / "b.txt")])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.rdd.getNumPartitions() == {1: 42, 3: 15, 1000: 2}[split]


@pytest.mark.parametrize("text", [b"12345\n123\n12345\n", b"123\n1234567\n", b"12345\n12"])
def test_records_of_another_length_are_errors(spark, tmp_path, text):
    (tmp_path / "f.txt").write_bytes(text)
    with pytest.raises(Exception, match="5"):
        record_files.read_fixed(spark, str(tmp_path / "f.txt"), 5).collect()


def test_round_trip_replaces_and_appends(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.format_string("%04d", "id")).alias("record"), F.lit(1).alias("file"))
    path = str(tmp_path / "out")
    for mode, times in (("overwrite", 1), ("overwrite", 1), ("append", 2)):
        record_files.write_fixed(rows.repartition(5), path, 6, mode)
        back = record_files.read_fixed(spark, path, 6, splitRecords="64")
        want = sorted([f"{i:04d}  " if i % 7 else " " * 6 for i in range(1000)] * times)
        assert sorted(r["record"] for r in back.collect()) == want
        assert len(listed(tmp_path / "out")) == 5 * times


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path = tmp_path / "out"
    record_files.write_fixed(spark.createDataFrame([("old",)], "record string"), str(path), 4)
    before = listed(path)
    with pytest.raises(Exception, match="fit"):
        record_files.write_fixed(spark.range(100).repartition(4).select(F.when(F.col("id") == 50, "too long").otherwise("ok").alias("record")), str(path), 4)
    assert listed(path) == before
    assert [r["record"] for r in record_files.read_fixed(spark, str(path), 4).collect()] == ["old "]


def test_empty_tables(spark, tmp_path):
    record_files.write_fixed(spark.createDataFrame([], "record string"), str(tmp_path / "out"), 4)
    assert record_files.read_fixed(spark, str(tmp_path / "out"), 4).count() == 0


def test_stata_files(spark, tmp_path):
    rows = [(1, "a", 1.5, dt.date(2001, 2, 3), True), (2, None, None, None, None), (None, "é", -1.0, dt.date(1960, 1, 1), False)] * 5
    record_files.write_stata(spark.createDataFrame(rows, "n int, t string, v double, d date, b boolean").repartition(2), str(tmp_path / "out"), rowsPerFile="4")
    files = [p for p in (tmp_path / "out").iterdir() if p.suffix == ".dta"]
    back = pd.concat([pd.read_stata(p) for p in files])
    assert len(files) >= 4 and max(len(pd.read_stata(p)) for p in files) <= 4
    plain = lambda v: None if pd.isna(v) else v.date() if isinstance(v, pd.Timestamp) else v
    got = sorted(str(tuple(map(plain, r))) for r in back.itertuples(index=False))
    want = sorted(str((None if n is None else float(n), t or "", v, d, None if b is None else float(b))) for n, t, v, d, b in rows)
    assert got == want
