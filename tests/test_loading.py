"""Reading fixed-width and delimited text, typed fields, repeatable loads and arrivals."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions import dates, parsing, recode
from ledgerloom.sources import catalog, fixed_width, manifest, tabledef, text_tables
from ledgerloom.streaming import arrivals

SHORT = tabledef.TableDef.of("short", [("id", 1, 2, "int"), ("level", 3, 1, "'F' = felony; 'M' = misdemeanor; '' = other"), ("at", 4, 8, "date"), ("code", 12, 3, "int")])
LONG = tabledef.TableDef.of("long", [("id", 1, 2, "int"), ("level", 3, 1, "character"), ("more", 4, 13, "character")])


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize("text, lenient, prefixed", [("12 ", 12, 12), ("1A", None, 1), ("A", None, 0), ("   ", None, None), (" 12", 12, None), ("", None, None), (None, None, None), ("-3", None, -3), ("99999999999", None, None)])
def test_three_ways_to_read_a_number(spark, text, lenient, prefixed):
    assert one(spark, text, parsing.lenient_int) == lenient
    assert one(spark, text, parsing.prefix_int) == prefixed


def test_strict_numbers_raise(spark):
    assert one(spark, " 7 ", parsing.strict_number) == 7 and one(spark, "  ", parsing.strict_number) is None
    with pytest.raises(PySparkException):
        one(spark, "1A", parsing.strict_number)


def test_texts(spark):
    assert one(spark, "a\u0000bÿc", parsing.printable) == "a b c"
    assert one(spark, " \t x y\t", parsing.trimmed) == "x y" and one(spark, "  ", parsing.trimmed) is None
    assert one(spark, "say 'this' not that", parsing.between_quotes) == "this"
    assert one(spark, "AB  CD", lambda c: parsing.packed_codes(c, 2, 3)) == ["AB", "CD"]
    assert one(spark, "nan?", parsing.quiet_number) is None and one(spark, " 1.5", parsing.quiet_number) == 1.5
    bad = spark.createDataFrame([(bytearray(b"\xff\xfe"),), (bytearray("é".encode()),), (None,)], "b binary")
    assert [r["x"] for r in bad.select(parsing.valid_text(F.col("b")).alias("x")).collect()] == ["NA_unicode", "é", None]


def test_dates(spark):
    parts = spark.createDataFrame([(2001, 2, 30), (2001, 2, 28), (2001, 0, 1), (None, 1, 1)], "y int, m int, d int")
    assert [str(r["x"]) for r in parts.select(dates.date_of(F.col("y"), F.col("m"), F.col("d")).alias("x")).collect()] == ["None", "2001-02-28", "None", "None"]
    assert str(one(spark, "20010228", dates.compact_date)) == "2001-02-28" and one(spark, "20010230", dates.compact_date) is None
    assert str(one(spark, "02/28/2001", lambda c: dates.date_from(c, "MM/dd/yyyy"))) == "2001-02-28"
    years = spark.createDataFrame([(79,), (80,), (5,)], "yy int")
    assert [r["x"] for r in years.select(dates.century(F.col("yy")).alias("x")).collect()] == [2079, 1980, 2005]
    births = spark.createDataFrame([(99, 1990), (50, 1990), (93, 1990), (1950, 1990)], "yy int, court int")
    assert [r["x"] for r in births.select(dates.birth_year(F.col("yy"), F.col("court")).alias("x")).collect()] == [1899, 1950, 1993, 1950]


def test_recoding(spark):
    assert one(spark, "1", recode.race_label) == one(spark, "W", recode.race_label) == "White" and one(spark, "?", recode.race_label) is None
    assert one(spark, "Alpine County", recode.county_group).startswith("Alpine/") and one(spark, "Kern", recode.county_group) == "Kern"
    ages = spark.createDataFrame([(None,), (17,), (18,), (24,), (25,), (150,), (151,)], "a int")
    assert [r["x"] for r in ages.select(recode.right_closed(F.col("a"), recode.RELEASE_BANDS).alias("x")).collect()] == [None, None, "18-24", "18-24", "25-32", "45+", None]
    assert [r["x"] for r in ages.select(recode.population_band(F.col("a")).alias("x")).collect()][:3] == ["60+", "15-17", "18-24"]
    assert [r["x"] for r in ages.select(recode.age_class(F.col("a")).alias("x")).collect()][:3] == ["Adult", "Juvenile", "Adult"]
    with pytest.raises(ValueError):
        recode.remap(F.col("a"), [["x"]], [])


def test_labels():
    assert tabledef.parse_labels("'F' = felony; 'J' = juvenile court; '' = other") == ({"F": "felony", "J": "juvenile court"}, "other")
    with pytest.raises(ValueError):
        tabledef.parse_labels("felony")


def test_files_of_fixed_width(spark, tmp_path):
    (tmp_path / "b03.txt").write_bytes(b"01F20010228 12\n02M20010230 1A\n")
    (tmp_path / "a99.txt").write_bytes(b"  X\xff       A  \n\n")
    rows = fixed_width.read_records(spark, str(tmp_path))
    typed = SHORT.typed(SHORT.split(rows))
    got = {(r["file"], r["recno"]): (r["id"], r["level"], str(r["at"]), r["code"]) for r in typed.collect()}
    assert got == {("b03.txt", 1): (1, "felony", "2001-02-28", 12), ("b03.txt", 2): (2, "misdemeanor", "None", None), ("a99.txt", 1): (None, "other", "None", None)}
    keyed = {(r["file"], r["recno"]): r["db_id"] for r in fixed_width.surrogate_keys(rows, 10).collect()}
    assert keyed == {("a99.txt", 1): 10, ("b03.txt", 1): 11, ("b03.txt", 2): 12}
    years = {r["file"]: r["y"] for r in rows.select("file", fixed_width.file_year(F.col("file")).alias("y")).distinct().collect()}
    assert years == {"a99.txt": 1999, "b03.txt": 2003}
    assert fixed_width.wrong_length(rows, 14).count() == 0 and fixed_width.wrong_length(rows, 13).count() == 3


def test_layouts_by_length(spark):
    raw = spark.createDataFrame([("f", 1, "01F20010228 12"), ("f", 2, "02Mabcdefghijklm")], "file string, recno long, record string")
    got = {r["recno"]: (r["layout"], r["id"], r["code"], r["more"]) for r in tabledef.by_length(raw, {14: SHORT, 16: LONG}).collect()}
    assert got == {1: ("short", 1, 12, None), 2: ("long", 2, None, "abcdefghijklm")}
    with pytest.raises(PySparkException):
        tabledef.by_length(raw.union(raw.select("file", "recno", F.lit("?"))), {14: SHORT, 16: LONG}).collect()


def test_changes_of_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text("a")
    (tmp_path / "two.txt").write_text("b")
    found = manifest.scan_files(spark, str(tmp_path))
    known = [tuple(r) for r in found.collect()]
    again = spark.createDataFrame([(n, s, m, "other" if n == "one.txt" else h) for n, s, m, h in known] + [("gone.txt", 1, known[0][2], "x")], found.schema)
    assert {tuple(r) for r in manifest.changes(found, again).collect()} == {("one.txt", "changed"), ("two.txt", "same"), ("gone.txt", "deleted")}
    assert {r["state"] for r in manifest.changes(found, again.limit(0)).collect()} == {"new"}


def test_appending_twice_adds_once(spark, tmp_path):
    rows = spark.createDataFrame([("f:1", 1), ("f:2", 2), ("f:2", 2)], "internal_uid string, n int")
    target = str(tmp_path / "t")
    assert manifest.append_new(rows, target) == {"added": 2, "ignored": 1}
    more = rows.union(spark.createDataFrame([("f:3", 3)], rows.schema))
    assert manifest.append_new(more, target) == {"added": 1, "ignored": 3}
    assert sorted(r["internal_uid"] for r in spark.read.parquet(target).collect()) == ["f:1", "f:2", "f:3"]


def test_files_replace_their_own_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    manifest.replace_files(spark.createDataFrame([("a", 1), ("b", 1)], "file string, n int"), target)
    manifest.replace_files(spark.createDataFrame([("a", 2)], "file string, n int"), target)
    assert {(r["file"], r["n"]) for r in spark.read.parquet(target).collect()} == {("a", 2), ("b", 1)}


def test_arrivals_are_loaded_once(spark, tmp_path):
    folder, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    load = lambda: arrivals.load_arrivals(spark, str(folder), "internal_uid string, n int", target, state, lambda rows: rows).awaitTermination()
    (folder / "1.csv").write_text("a,1\nb,2\n")
    load()
    (folder / "2.csv").write_text("b,2\nc,3\n")
    load()
    load()
    assert sorted(r["internal_uid"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_a_batch_of_arrivals_costs_its_own_rows_and_runs_again_without_effect(spark, tmp_path):
    folder, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def load():
        return arrivals.load_arrivals(spark, str(folder), "internal_uid string, n int", target, state, lambda rows: rows.withColumn("m", F.col("n") * 2))

    (folder / "1.csv").write_text("".join(f"k{i},{i}\n" for i in range(500)))
    load().awaitTermination()
    # A batch that was written but not noted as done: its commit goes, and it is run again.
    (folder / "2.csv").write_text("k1,1\nnew,7\nnew,7\n,8\n,9\n")
    load().awaitTermination()
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    query = load()
    query.awaitTermination()
    rows = spark.read.parquet(target).collect()
    assert sorted(str(r["internal_uid"]) for r in rows) == sorted([*(f"k{i}" for i in range(500)), "new", "None"])
    assert all(r["m"] == 2 * r["n"] for r in rows)
    assert sum(p["numInputRows"] for p in query.recentProgress) <= 5


def test_new_rows_are_the_least_of_their_key(spark):
    rows = spark.createDataFrame([("a", 3, None), ("a", 2, "x"), ("b", 1, "y"), ("c", 5, "z")], "internal_uid string, n int, t string")
    for parts in (1, 4):
        got = manifest.new_rows(rows.repartition(parts), rows.filter("internal_uid = 'b'"))
        assert got.columns == rows.columns and sorted(tuple(r) for r in got.collect()) == [("a", 2, "x"), ("c", 5, "z")]


def test_catalog(spark, tmp_path):
    tables = catalog.Catalog(spark)
    catalog.write_csv(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), str(tmp_path / "t"))
    tables.add("t", str(tmp_path / "t"), "csv", "a int, b string", on_load=lambda df: df.withColumn("c", F.col("a") + 1), header="true", nullValue="NULL")
    assert sorted(tuple(r) for r in tables.load("t").collect()) == [(1, None, 2), (2, "x", 3)]
    tables.add("odd", "x", "sheet")
    with pytest.raises(ValueError):
        tables.load("odd")


def test_tables_printed_as_text(spark):
    assert one(spark, "  a b   c  d ", text_tables.columns_of) == ["a b", "c", "d"]
    names = spark.createDataFrame([("Kern County Court - Delano",), ("Plumas County Court - Almanor - Chester Branch",)], "n string")
    got = [tuple(r) for r in names.select(*(c.alias(f"c{i}") for i, c in enumerate(text_tables.split_district(F.col("n"))))).collect()]
    assert got[0] == ("Kern", "County", "Delano") and got[1][0] == "Plumas" and got[1][2] == "Almanor/Chester Branch"
