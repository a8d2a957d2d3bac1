"""Loads that fail between any two steps and are run again."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import fixed_width, loads


def parse(records):
    split = F.split("record", ",")
    return records.select("file", "recno", split[0].alias("internal_uid"), split[1].cast("int").alias("n"))


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.txt").write_text(text)


def told(table):
    return sorted((r["file"], r["recno"], r["internal_uid"], r["n"], r["db_id"]) for r in table.rows().collect())


def test_files_are_loaded_once_changed_and_forgotten(spark, tmp_path):
    folder, table = tmp_path / "in", loads.Loads(spark, str(tmp_path / "t"), parse)
    put(folder, a="k1,1\nk2,2\nk1,9\n", b="k3,3\nk2,8\n")
    assert table.run(str(folder)) == {"files": 2, "added": 3, "ignored": 2, "removed": 0}
    first = [("a.txt", 1, "k1", 1, 1), ("a.txt", 2, "k2", 2, 2), ("b.txt", 1, "k3", 3, 3)]
    assert told(table) == first
    assert table.run(str(folder)) == {"files": 0, "added": 0, "ignored": 0, "removed": 0} and table.generations() == [1]
    put(folder, c="k3,7\nk4,4\n", d="k4,5\n")
    assert table.run(str(folder)) == {"files": 2, "added": 1, "ignored": 2, "removed": 0}
    assert told(table) == [*first, ("c.txt", 2, "k4", 4, 4)]
    (folder / "b.txt").unlink()
    put(folder, a="k1,1\nk5,55\nk3,33\n")
    assert table.run(str(folder)) == {"files": 1, "added": 3, "ignored": 0, "removed": 3}
    # Numbers go on: none is given twice.
    assert told(table) == [("a.txt", 1, "k1", 1, 5), ("a.txt", 2, "k5", 55, 6), ("a.txt", 3, "k3", 33, 7), ("c.txt", 2, "k4", 4, 4)]
    assert {r["file"]: (r["n_read"], r["n_rows"]) for r in table.manifest().collect()} == {"a.txt": (3, 3), "c.txt": (2, 1), "d.txt": (1, 0)}
    assert told(table) == sorted((r["file"], r["recno"], r["internal_uid"], r["n"], r["db_id"]) for r in loads.read(spark, str(tmp_path / "t")).collect())
    for x in folder.iterdir():
        x.unlink()
    put(folder, e="k9,9\n")
    table.run(str(folder))
    assert told(table) == [("e.txt", 1, "k9", 9, 8)] and table.vacuum(1) == [1, 2, 3] and told(table) == [("e.txt", 1, "k9", 9, 8)] and table.vacuum(1) == []


@pytest.mark.parametrize("step", ["staged", "commit", "rename", "after"])
def test_a_load_that_fails_has_no_effect_until_it_is_run_again(spark, tmp_path, monkeypatch, step):
    folder, table = tmp_path / "in", loads.Loads(spark, str(tmp_path / "t"), parse)
    put(folder, a="k1,1\nk2,2\n")
    table.run(str(folder))
    before = told(table)
    put(folder, a="k1,1\nk2,20\nk6,6\n", b="k3,3\n")

    class Stopped(Exception):
        pass

    whole = {"staged": table.staged, "commit": table.commit}

    def stop(*args):
        if step == "staged":  # half of the rows are written, as other rows than they should be
            whole["staged"](args[0].limit(1).withColumn("n", F.lit(-1)), args[1])
        if step == "after":
            whole["commit"](*args)
        raise Stopped

    if step == "rename":
        monkeypatch.setattr(loads, "rename", stop)
    else:
        monkeypatch.setattr(table, "commit" if step == "after" else step, stop)
    with pytest.raises(Stopped):
        table.run(str(folder))
    monkeypatch.undo()
    again = loads.Loads(spark, str(tmp_path / "t"), parse)
    if step == "after":  # it was final already
        assert again.run(str(folder)) == {"files": 0, "added": 0, "ignored": 0, "removed": 0}
    else:
        assert told(again) == before
        assert again.run(str(folder)) == {"files": 2, "added": 4, "ignored": 0, "removed": 2}
    assert told(again) == [("a.txt", 1, "k1", 1, 3), ("a.txt", 2, "k2", 20, 4), ("a.txt", 3, "k6", 6, 5), ("b.txt", 1, "k3", 3, 6)]
    again.vacuum(1)
    assert again.generations() == [2] and len(told(again)) == 4 and not [p for p in (tmp_path / "t" / "_manifest").iterdir() if p.name.startswith(".") and p.is_dir()]


def test_a_later_stage_makes_what_is_pending(spark, tmp_path):
    folder, raw = tmp_path / "in", loads.Loads(spark, str(tmp_path / "raw"), parse)
    typed = loads.Derived(raw, str(tmp_path / "typed"), lambda rows: rows.withColumn("twice", F.col("n") * 2).filter("n <> 3"))
    assert typed.run() == {"files": 0, "rows": 0}
    put(folder, a="k1,1\nk2,2\n", b="k3,3\n")
    raw.run(str(folder))
    assert sorted(r["file"] for r in typed.pending().collect()) == ["a.txt", "b.txt"]
    assert typed.run() == {"files": 2, "rows": 2} and typed.run() == {"files": 0, "rows": 0}
    put(folder, b="k3,4\n", c="k7,7\n")
    (folder / "a.txt").unlink()
    raw.run(str(folder))
    assert typed.run() == {"files": 2, "rows": 2}
    assert sorted((r["internal_uid"], r["twice"]) for r in typed.rows().collect()) == [("k3", 8), ("k7", 14)]


def test_two_loads_at_once_cannot_both_become_final(spark, tmp_path):
    folder, table = tmp_path / "in", loads.Loads(spark, str(tmp_path / "t"), parse)
    put(folder, a="k1,1\n")
    table.run(str(folder))
    with pytest.raises(FileExistsError):
        table.commit(table.manifest(), 1, 1)
    assert len(told(table)) == 1


def test_records_without_a_key_are_all_kept(spark, tmp_path):
    folder = tmp_path / "in"
    table = loads.Loads(spark, str(tmp_path / "t"), lambda r: parse(r).withColumn("internal_uid", F.nullif("internal_uid", F.lit("-"))))
    put(folder, a="-,1\n-,1\nk,2\n")
    assert table.run(str(folder))["added"] == 3
    put(folder, b="-,1\nk,3\n")
    assert table.run(str(folder)) == {"files": 1, "added": 1, "ignored": 1, "removed": 0}
    assert fixed_width.read_records(spark, str(folder)).count() == 5
