"""What no query reaches: sinks, tables, resuming, samples, statistics, orders over many tasks, and the command line."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom import __main__ as verbs
from ledgerloom.durable import checkpoint_dir
from ledgerloom.functions import predicates, recode
from ledgerloom.operators import aggregates, joins, local_fit, ordering, profile, reshape, sequences, stats
from ledgerloom.plans import release
from ledgerloom.sources import catalog, fixed_width, manifest, tabledef, text_tables


def test_delimited_files_with_and_without_a_header(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é"), (2, None)], "a int, b string")
    fixed_width.write_delimited(rows, str(tmp_path / "pipe"))
    back = catalog.read_csv(spark, str(tmp_path / "pipe"), "a int, b string", sep="|", encoding="UTF-8")
    assert sorted(map(tuple, back.collect()), key=str) == [(1, "é"), (2, None)]
    (tmp_path / "bare.csv").write_bytes("7,caf\xe9\n8,x\n".encode("latin-1"))
    assert sorted(map(tuple, catalog.read_csv(spark, str(tmp_path / "bare.csv"), "n int, t string", header=False).collect())) == [(7, "café"), (8, "x")]


def test_tables_are_made_extended_emptied_and_dropped(spark, tmp_path):
    name = f"made_{random.randrange(10**9)}"
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    options = {"path": str(tmp_path / name)}
    try:
        rows.write.options(**options).saveAsTable(name)
        catalog.create(rows, name, mode="append")
        tables = catalog.Catalog(spark)
        tables.add("t", name, "table")
        assert tables.load("t").count() == 4
        with pytest.raises(PySparkException):
            catalog.create(rows, name)
    finally:
        catalog.drop(spark, name)
    assert not spark.catalog.tableExists(name)


def test_truncating_keeps_the_table(spark):
    name = f"emptied_{random.randrange(10**9)}"
    try:
        catalog.create(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), name, partition_by=["b"])
        catalog.truncate(spark, name)
        assert spark.table(name).count() == 0
    finally:
        catalog.drop(spark, name)


def test_a_load_resumes_where_it_stopped(spark, tmp_path):
    for n in ("a", "b", "c"):
        (tmp_path / f"{n}.txt").write_text(f"{n}1\n{n}2\n")
    state = {"a.txt": (True, True), "b.txt": (True, False), "c.txt": (False, None)}
    known = spark.createDataFrame([(f, 1, None, "x", 0, 0, *done) for f, done in state.items()], manifest.MANIFEST)
    left = lambda m, stage: {r["file"] for r in manifest.pending(m, stage).collect()}
    assert left(known, "raw") == {"c.txt"} and left(known, "typed") == {"b.txt", "c.txt"}
    rows = spark.read.text(str(tmp_path)).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    raw = rows.join(manifest.pending(known, "raw"), "file", "left_semi")
    manifest.replace_files(raw, str(tmp_path / "out"))
    manifest.replace_files(raw, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    done = known.withColumn("raw_done", F.lit(True))
    assert left(done, "raw") == set()


def test_a_code_manual_is_split_from_the_right(spark):
    lines = ["01234 187(A) PC MURDER FIRST DEGREE         F 01 0100", "01235 242 PC BATTERY                       M 12 0200", "     continued words"]
    table = spark.createDataFrame([*enumerate(lines)], "lineno int, line string")
    got = text_tables.split_manual(table).orderBy("lineno").collect()
    assert (got[0]["code"], got[0]["code_type"], got[0]["offense_class"], got[0]["summary_code"]) == ("01234", "PC", "F", 1)
    assert got[1]["code_type"] == "PC" and got[1]["hierarchy"] == 200 and len(got) == 3


def test_samples_previews_and_names(spark):
    rows = spark.range(1000).withColumn("b", F.col("id") % 7)
    one, two = (sorted(r["id"] for r in reshape.sample_rows(rows.repartition(p), 20, "id", 3).collect()) for p in (1, 5))
    assert one == two and len(one) == 20 and one != sorted(r["id"] for r in reshape.sample_rows(rows, 20, "id", 4).collect())
    assert profile.preview(rows, 3, 1).columns == ["id"] and profile.preview(rows, 3).count() == 3
    assert reshape.truncated_names(rows.withColumnRenamed("b", "x" * 40)).columns == ["id", "x" * 32]
    assert set(profile.variable_summary(rows, "b", {"b": lambda df, c: df.select(F.max(c).alias("top"))}).columns) == {"top"}
    assert profile.variable_summary(rows.withColumn("b", F.col("b").cast("string")), "b").count() == 7


def test_null_tolerant_pairs_and_flags(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "q"), (3, "y", "q")], "i int, k string, w string")
    got = {(r[0], r[3]) for r in joins.wildcard_pairs(a, a, ["k"], ["w"]).collect()}
    assert got == {(1, 1), (2, 2), (2, 3), (3, 2), (3, 3)}
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean").select(predicates.is_true(F.col("f")), predicates.is_false(F.col("f")))
    assert [tuple(r) for r in flags.collect()] == [(True, False), (False, True), (False, False)]
    x = spark.createDataFrame([(0.0,), (2.0,)], "x double").select(recode.logistic(F.col("x")).alias("p"))
    assert [r["p"] for r in x.collect()] == pytest.approx([0.5, 1 / (1 + math.exp(-2))])


def test_a_version_that_lacks_a_code(spark):
    codes = spark.createDataFrame([("a", 0, "old a"), ("a", 1, "new a"), ("b", 0, "old b"), ("d", 0, "d one"), ("d", 0, "d two")], "code string, new int, name string")
    rows = spark.createDataFrame([("a", 2000), ("a", 2014), ("b", 2014), ("c", 2014), ("b", None), ("d", 2014), ("d", 2000), ("a", None)], "code string, year int")
    got = {(r["code"], r["year"]): r["name"] for r in joins.versioned_match(rows, codes, "code", "new", F.col("year") >= 2013, "name").collect()}
    assert got == {("a", 2000): "old a", ("a", 2014): "new a", ("b", 2014): "old b", ("c", 2014): "NA", ("b", None): "old b", ("d", 2014): "NA", ("d", 2000): "d two", ("a", None): "new a"}


def test_aggregates_that_must_agree(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    assert aggregates.assert_reconciled(a, a, ["k"], "n").first()["n_different"] == 0
    with pytest.raises(PySparkException):
        aggregates.assert_reconciled(a, a.withColumn("n", F.lit(1)), ["k"], "n").collect()


def test_statistics_of_known_values(spark):
    x = list(range(10))
    y = [2.0, 3.1, 3.9, 5.2, 5.8, 7.1, 8.0, 9.3, 9.7, 11.2]
    rows = spark.createDataFrame([("g", float(a), b) for a, b in zip(x, y, strict=True)] + [("h", 0.0, 1.0)], "k string, x double, y double")
    got = {r["k"]: r for r in stats.trend(rows, ["k"], "x", "y").collect()}
    slope = np.polyfit(x, y, 1)[0]
    assert got["g"]["slope"] == pytest.approx(slope) and got["h"]["p_value"] in (None, pytest.approx(math.nan, nan_ok=True))
    r2, df = got["g"]["r2"], 8
    t = math.sqrt(r2 * df / (1 - r2))
    grid = np.linspace(t, 2000, 2_000_001)
    tail = np.trapezoid((1 + grid**2 / df) ** (-(df + 1) / 2), grid) * math.gamma(4.5) / (math.sqrt(df * math.pi) * math.gamma(4))
    assert got["g"]["p_value"] == pytest.approx(2 * tail, rel=1e-3)
    interval = stats.jeffreys(spark.createDataFrame([(0, 10), (10, 10), (5, 10)], "h int, n int"), "h", "n").collect()
    assert [round(v, 4) for v in (interval[2]["low"], interval[2]["high"])] == [0.2235, 0.7765]
    assert interval[0]["low"] == pytest.approx(1 - interval[1]["high"], abs=1e-9)
    line = spark.createDataFrame([("g", float(i), 3.0 + 2 * i) for i in range(20)], "k string, x double, y double")
    smooth = {r["x"]: r["smooth"] for r in local_fit.loess(line, ["k"], "x", "y").collect()}
    assert all(v == pytest.approx(3 + 2 * x) for x, v in smooth.items()) and len(smooth) == 20


def local_lines(points, span):
    """By definition, for each distinct x of one group."""
    a, b = (np.array(c, float) for c in zip(*points))
    q, out = min(len(a), max(2, math.ceil(span * len(a)))), {}
    for x0 in set(a.tolist()):
        d = np.abs(a - x0)
        w = np.clip(1 - (d / max(np.sort(d)[q - 1], 1e-12)) ** 3, 0, None) ** 3
        line = np.stack([np.ones(len(a)), a - x0], 1) * np.sqrt(w)[:, None]
        out[x0] = float(np.linalg.lstsq(line, b * np.sqrt(w), rcond=None)[0][0])
    return out


@pytest.mark.parametrize("span, block", [(0.05, 5), (0.3, 8), (0.75, 4), (1.0, 16), (0.5, 4096)])
def test_local_lines_over_blocks(spark, span, block):
    rng = random.Random(block)
    groups = {
        None: [(float(rng.randrange(40)), rng.random()) for _ in range(300)],
        "even": [(i / 10, math.sin(i / 9)) for i in range(150)],
        "leap": [(x + rng.random(), rng.gauss(x, 1)) for x in [0.0] * 90 + [1e5] * 90],
        "tail": [(rng.paretovariate(0.5), rng.random()) for _ in range(160)],
        "same": [(2.0, float(i)) for i in range(9)],
        "one": [(1.0, 5.0)],
    }
    rows = [(k, x, y, "extra") for k, points in groups.items() for x, y in points] + [("even", None, 1.0, ""), ("even", 3.0, math.nan, ""), ("odd", math.inf, 1.0, "")]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "k string, x double, y double, n string").repartition(5)
    got = {(r["k"], r["x"]): (r["n"], r["smooth"]) for r in local_fit.loess(table, ["k"], "x", "y", span, block).collect()}
    want = {(k, x): v for k, points in groups.items() for x, v in local_lines(points, span).items()}
    assert set(got) == set(want)
    for key, v in want.items():
        assert got[key][1] == pytest.approx(v, rel=1e-6, abs=1e-6), key
    assert sum(n for n, _ in got.values()) == sum(map(len, groups.values()))


def test_local_lines_of_nothing(spark):
    assert local_fit.loess(spark.createDataFrame([], "k string, x int, y int"), ["k"], "x", "y").count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_orders_over_many_tasks(spark, parts):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.randrange(50)) for i in range(300)]
    table = spark.createDataFrame(rows, "i int, g string, v int").repartition(parts)
    got = {r["i"]: (r["nth"]) for r in ordering.numbered(table, ["v", "i"], "nth").collect()}
    assert got == {i: n + 1 for n, (i, _, _) in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    sums = {r["i"]: r["s"] for r in ordering.running(table, ["i"], F.col("v"), "s").collect()}
    assert sums == dict(zip(range(300), np.cumsum([r[2] for r in rows]).tolist(), strict=True))
    left = {r["i"] for r in ordering.without_positions(table, ["i"], [1, 300]).collect()}
    assert left == set(range(1, 299))
    for group in ([], ["g"]):
        near = {r["i"]: (r["_p_v"], r["_n_v"]) for r in ordering.with_neighbours(table, group, "i", ["v"]).collect()}
        lines = [[r for r in rows if r[1] == g] for g in "ab"] if group else [rows]
        want = {}
        for line in lines:
            for k, r in enumerate(line):
                want[r[0]] = (line[k - 1][2] if k else None, line[k + 1][2] if k + 1 < len(line) else None)
        assert near == want
    assert ordering.numbered(table.limit(0), ["i"], "nth").count() == 0


def test_sparse_series(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("b", 2), ("b", None)], "k string, y int")
    got = {(r["k"], r["y"]): r["n"] for r in aggregates.dense_series(rows, ["k"], "y").collect()}
    assert got == {("a", 1): 2, ("a", 2): 0, ("a", 3): 0, ("a", 4): 1, ("b", 1): 0, ("b", 2): 1, ("b", 3): 0, ("b", 4): 0}
    table = aggregates.dense_counts(spark.createDataFrame([("a", "x"), ("b", "y"), (None, "y")], "k string, l string"), ["k", "l"])
    assert {tuple(r) for r in table.collect()} == {("a", "x", 1), ("a", "y", 0), ("b", "x", 0), ("b", "y", 1)}
    codes = {r["k"]: r["c"] for r in sequences.dense_codes(rows, "k", "c").collect()}
    assert codes == {"a": 1, "b": 2}


def test_permuted_keys_are_a_permutation_by_seed(spark):
    rows = spark.range(50).union(spark.range(50))
    one, two = ({r["old"]: r["new"] for r in joins.permuted_keys(rows, "id", s).collect()} for s in (1, 2))
    assert sorted(one.values()) == list(range(1, 51)) and one != two


def test_county_table(spark):
    names = spark.createDataFrame([(1, "Alameda County"), (2, "Alpine County"), (3, "Amador County"), (55, "Tuolumne County")], "code int, name string")
    got = {r["name"]: (r["code_new"], r["name_new"]) for r in release.county_table(names, [["Alpine", "Amador", "Tuolumne"]]).collect()}
    assert got == {"Alameda": (1, "Alameda"), **dict.fromkeys(("Alpine", "Amador", "Tuolumne"), (2, "Alpine/Amador/Tuolumne"))}


def test_the_command_line_takes_records_to_a_release(spark, tmp_path):
    layout = [["bcs_jurisdiction", 1, 5, "character(5)"], ["ncic_jurisdiction", 6, 4, "character(4)"], ["arrest_year", 10, 4, "smallint"], ["arrest_month", 14, 2, "smallint"], ["arrest_day", 16, 2, "smallint"], ["offense_level", 18, 1, "'F' = felony; 'M' = misdemeanor"], ["offense_code", 19, 2, "smallint"], ["fbi_offense_code", 21, 4, "character(4)"], ["age", 25, 3, "smallint"], ["race", 28, 1, "'W' = White; 'B' = Black"], ["gender", 29, 1, "'1' = male; '2' = female"], ["disposition", 30, 1, "'1' = released; '2' = felony_complaint_sought"]]
    (tmp_path / "in").mkdir()
    line = lambda i: f"00001{'1900' if i % 3 else '3400'}2001{i % 12 + 1:02d}15{'FM'[i % 2]}{i % 6:02d}    {20 + i % 2:03d}{'WB'[i % 2]}{i % 2 + 1}{i % 2 + 1}"
    (tmp_path / "in" / "a01.txt").write_text("".join(line(i) + "\n" for i in range(60)))
    (tmp_path / "layout.json").write_text(json.dumps(layout))
    steps = [str(tmp_path / s) for s in ("in", "typed", "clean", "out")]
    verbs.main(["import", steps[0], steps[1], "--layout", str(tmp_path / "layout.json"), "--length", "30"], spark)
    verbs.main(["clean", steps[1], steps[2]], spark)
    cleaned = spark.read.parquet(steps[2]).withColumn("year", F.col("arrest_year"))
    cleaned.write.parquet(str(tmp_path / "year"))
    verbs.main(["anonymize", str(tmp_path / "year"), steps[3], "--k", "3", "--least", "1"], spark)
    files = {n: spark.read.option("header", "true").csv(f"{steps[3]}/{n}") for n in ("all", "released", "complaint_sought")}
    assert files["all"].count() == 60 == files["released"].count() + files["complaint_sought"].count()
    (tmp_path / "counties.csv").write_text("code,name\n19,North County\n34,South County\n40,East County\n")
    (tmp_path / "groups.json").write_text(json.dumps([["North", "South"]]))
    verbs.main(["anonymize", str(tmp_path / "year"), str(tmp_path / "grouped"), "--k", "1", "--least", "1", "--counties", str(tmp_path / "counties.csv"), "--groups", str(tmp_path / "groups.json")], spark)
    grouped = spark.read.option("header", "true").csv(str(tmp_path / "grouped" / "all"))
    assert {r["county"] for r in grouped.collect()} == {"1"} and grouped.count() == 60
    assert "ncic_jurisdiction" not in files["all"].columns and set(files["complaint_sought"].select("disposition").distinct().toPandas()["disposition"]) == {"complaint sought"}


def test_only_local_masters_get_a_folder_of_their_own(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
    assert checkpoint_dir(spark)


def test_layouts_from_rows():
    rows = [{"full_name": "db_id", "start": "NA", "length": 0, "type": "bigserial", "abbreviation": ""}, {"full_name": "age", "start": 3, "length": 2, "type": "smallint", "abbreviation": "ag"}]
    table = tabledef.TableDef.from_rows("short", rows, 6)
    assert [f.name for f in table.fields] == ["age"] and table.length == 6 and table.fields[0].is_whole
    assert tabledef.TableDef.of("made", [("db_id", 1, 2, "bigserial")]).fields[0].is_serial


def test_a_share_of_just_the_cut_lies_on_it(spark):
    from ledgerloom.operators.sequences import top_share

    shared = spark.createDataFrame([(1, 1, 0.01), (2, 1, 0.02), (3, 3, 0.05), (4, 95, 1.0)], "u int, n int, share_below double")
    found = lambda *how: sorted(r["u"] for r in top_share(shared, *how).collect())
    assert found(0.95) == [4] and found(0.95, "with_next") == [2, 3, 4]
    ties = spark.createDataFrame([(1, 1, 0.01), (2, 2, 0.02), (3, 2, 0.04), (4, 96, 1.0)], "u int, n int, share_below double")
    assert sorted(r["u"] for r in top_share(ties, 0.98, "strict").collect()) == [2, 3, 4]
