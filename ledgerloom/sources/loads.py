"""Loads that can stop anywhere and be run again.

A table of this kind is a folder: ``data/load=N`` holds the rows of load N, and ``_manifest/gN``
says, for each file, which load holds its rows now.  A load writes its rows first and its
manifest last, under another name that one rename makes final.  Rows that no manifest names
aren't there for readers, so a load that fails before the rename has had no effect, and the
next one writes over what it left; after the rename it is done.  Running it again finds nothing
to do.

Files are told apart by size and hash: new and changed ones are read, rows of changed and
deleted ones go with the manifest; files without a byte aren't seen.  A key that files which stay have, or that comes again in the
same load, is ignored; the first by file and number counts.  Of the rows that are there only
the keys are read, and only those that the new rows may have go further (the engine's
runtime Bloom filter of the join).  Row numbers go on from the last one ever given.

``Derived`` is the next stage: it makes rows of what its source has loaded since, file by file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import cut, names, remove, rename
from ..operators.ordering import numbered
from . import fixed_width
from .manifest import changes, scan_files

MANIFEST = "file string, size long, modified timestamp, hash string, load long, n_read long, n_rows long, id_start long, id_end long"


class Committed:
    """The rows and the manifest of a folder, as of its last finished load."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")

    def generations(self) -> list[int]:
        return sorted(int(n[1:]) for n in names(self.spark, f"{self.target}/_manifest") if n.startswith("g"))

    def _manifest(self, generation: int | None = None) -> DataFrame:
        done = self.generations()
        generation = generation if generation is not None else (done[-1] if done else None)
        if generation is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.target}/_manifest/g{generation:08d}")

    def manifest(self, generation: int | None = None) -> DataFrame:
        """file, size, modified, hash, load, n_read, n_rows and first and last number of each file that is loaded."""
        return self._manifest(generation).filter("file IS NOT NULL")

    def last_id(self) -> int:
        """The last number ever given, be its row there or not."""
        return self._manifest().agg(F.max("id_end")).first()[0] or 0

    def rows(self) -> DataFrame:
        """The rows of the files that the manifest names, from the loads that it names."""
        return self._of(self.manifest())

    def _of(self, manifest: DataFrame) -> DataFrame:
        held = manifest.filter("n_rows > 0").select(F.col("file").alias("_file"), F.col("load").alias("_load"))
        data = self.spark.read.parquet(f"{self.target}/data")
        return data.join(held, (F.col("file") == F.col("_file")) & (F.col("load") == F.col("_load")), "left_semi").drop("load")

    def staged(self, rows: DataFrame, load: int) -> DataFrame:
        """Writes the rows of a load, over what an earlier try has left; file, n_rows and first and last number."""
        path = f"{self.target}/data/load={load}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).groupBy("file").agg(F.count("*").alias("n_rows"), F.min("db_id").alias("id_start"), F.max("db_id").alias("id_end"))

    def commit(self, manifest: DataFrame, load: int, last_id: int) -> None:
        """Makes the load final.  A row without a file keeps the last number given."""
        path = f"{self.target}/_manifest/.{uuid.uuid4()}"
        kept = self.spark.createDataFrame([(last_id,)], "id_end long")
        fields = [f.name for f in self.spark.createDataFrame([], MANIFEST).schema]
        manifest.select(*fields).unionByName(kept, allowMissingColumns=True).write.parquet(path)
        rename(self.spark, path, f"{self.target}/_manifest/g{load:08d}")

    def vacuum(self, keep: int = 2) -> list[int]:
        """Removes manifests but the last ``keep``, what failed loads have left, and loads that none of these names; their numbers."""
        kept = self.generations()[-keep:]
        named = {r[0] for g in kept for r in self.manifest(g).select("load").distinct().collect()}
        gone = [n for n in (int(x.removeprefix("load=")) for x in names(self.spark, f"{self.target}/data") if x.startswith("load=")) if n not in named]
        for n in gone:
            remove(self.spark, f"{self.target}/data/load={n}")
        for x in names(self.spark, f"{self.target}/_manifest"):
            if x.startswith(".") or int(x[1:]) not in kept:
                remove(self.spark, f"{self.target}/_manifest/{x}")
        return gone


class Loads(Committed):
    """Files of a folder as rows.  parse: a table of file, recno and record to one that has file, recno and the key."""

    def __init__(self, spark: SparkSession, target: str, parse: Callable[[DataFrame], DataFrame], key: str = "internal_uid", pattern: str = "*"):
        super().__init__(spark, target)
        self.parse, self.key, self.pattern = parse, key, pattern

    def run(self, folder: str) -> dict[str, int]:
        """Loads what is new or changed and forgets what is gone: numbers of files, and of rows added, ignored and removed."""
        found, known = cut(scan_files(self.spark, folder, self.pattern)), cut(self.manifest())
        state = cut(changes(found, known))
        read = [r[0] for r in state.filter("state IN ('new', 'changed')").select("file").collect()]
        dropped = cut(state.filter("state IN ('changed', 'deleted')").select("file"))
        removed = known.join(dropped, "file").agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        result = {"files": len(read), "added": 0, "ignored": 0, "removed": removed}
        if not state.filter("state <> 'same'").count():
            return result
        load, last_id = (self.generations() or [0])[-1] + 1, self.last_id()
        times = found.select("file", F.col("modified").alias("_modified"))
        stay = cut(known.join(dropped, "file", "left_anti").join(times, "file").withColumn("modified", F.col("_modified")).drop("_modified"))
        manifest = stay
        if read:
            parsed = self.parse(fixed_width.read_records(self.spark, [f"{folder.rstrip('/')}/{name}" for name in read]))
            fresh = numbered(self.fresh(parsed, stay), ["file", "recno"], "_nth")
            counted = cut(self.staged(fresh.withColumn("db_id", F.col("_nth") + F.lit(last_id)).drop("_nth"), load))
            n_read = parsed.groupBy("file").agg(F.count("*").alias("n_read"))
            loaded = found.join(state.filter("state IN ('new', 'changed')").select("file"), "file").join(n_read, "file", "left").join(counted, "file", "left")
            loaded = cut(loaded.withColumn("load", F.lit(load).cast("long")).fillna(0, ["n_read", "n_rows"]))
            sums = loaded.agg(F.sum("n_rows"), F.sum("n_read") - F.sum("n_rows"), F.max("id_end")).first()
            result |= {"added": sums[0], "ignored": sums[1]}
            last_id = max(last_id, sums[2] or 0)
            manifest = stay.unionByName(loaded)
        self.commit(manifest, load, last_id)
        return result

    def fresh(self, parsed: DataFrame, stay: DataFrame) -> DataFrame:
        """Each key's first row, unless a file that stays has the key; rows without a key are all new."""
        place = F.struct("file", "recno")
        first = parsed.filter(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_key")).agg(F.min(place).alias("_first"))
        once = parsed.join(first, F.col(self.key) == F.col("_key")).filter(place == F.col("_first")).drop("_key", "_first")
        if not stay.filter("n_rows > 0").isEmpty():
            there = self._of(stay).select(self.key).join(once.select(self.key), self.key, "left_semi").distinct()
            once = once.join(there, self.key, "left_anti").select(*once.columns)
        return once.unionByName(parsed.filter(F.col(self.key).isNull()))


class Derived(Committed):
    """A stage made of another's rows, file by file: make gets rows with file and db_id and must keep both."""

    def __init__(self, source: Committed, target: str, make: Callable[[DataFrame], DataFrame]):
        super().__init__(source.spark, target)
        self.source, self.make = source, make

    def pending(self) -> DataFrame:
        """The source's files whose present rows this stage hasn't made; ``hash`` here is the source's load."""
        done = self.manifest().select(F.col("file").alias("_file"), F.col("hash").cast("long").alias("_made"))
        return self.source.manifest().join(done, (F.col("file") == F.col("_file")) & (F.col("load") == F.col("_made")), "left_anti")

    def run(self) -> dict[str, int]:
        """Makes what is pending and forgets what the source no longer has: numbers of files and rows."""
        theirs, todo, known = cut(self.source.manifest()), cut(self.pending()), cut(self.manifest())
        n_files = todo.count()
        stay = known.join(theirs, "file", "left_semi").join(todo.select("file"), "file", "left_anti")
        result = {"files": n_files, "rows": 0}
        if not n_files and stay.count() == known.count():
            return result
        load = (self.generations() or [0])[-1] + 1
        manifest = stay = cut(stay)
        if n_files:
            made = self.make(self.source._of(todo)) if todo.filter("n_rows > 0").count() else None
            empty = self.spark.createDataFrame([], "file string, n_rows long, id_start long, id_end long")
            counted = cut(self.staged(made, load)) if made is not None else empty
            new = todo.select("file", "size", "modified", F.col("load").cast("string").alias("hash"), F.lit(load).cast("long").alias("load"), F.col("n_rows").alias("n_read"))
            new = cut(new.join(counted, "file", "left").fillna(0, ["n_rows"]))
            result["rows"] = new.agg(F.sum("n_rows")).first()[0]
            manifest = stay.unionByName(new)
        self.commit(manifest, load, self.last_id())
        return result


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a folder that was loaded, or a plain Parquet table."""
    table = Committed(spark, path)
    return table.rows() if table.generations() else spark.read.parquet(path)
