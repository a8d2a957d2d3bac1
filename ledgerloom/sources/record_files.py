"""Fixed-width and Stata files as Spark data sources.

All records of a fixed-width file take the same number of bytes, so byte ranges of a file are tasks
of their own and a record's number follows from its place: no pass that counts lines, no shuffle.
Writers put each task's rows under a name of its own and the driver gives them their final names
when all tasks are done, so that a task that is lost or run twice leaves nothing behind.
"""

from __future__ import annotations

import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions import parsing

RECORDS = "file string, recno long, record string"
#: Records of a task and of a batch; rows of one Stata file.
SPLIT, BATCH, STATA_ROWS = 1_000_000, 10_000, 200_000


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if not re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


@dataclass
class Range(InputPartition):
    """Records ``first`` to ``first + n - 1`` (from 0) of a file."""

    path: str
    first: int
    n: int


@dataclass
class Written(WriterCommitMessage):
    """The files of one task, under their names for the time being, and its rows."""

    files: list[str]
    rows: int


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.length = options["path"], int(options["length"])
        self.encoding, self.split = options.get("encoding", "ISO-8859-1"), int(options.get("splitrecords", SPLIT))
        self.end = {"none": b"", "lf": b"\n", "crlf": b"\r\n"}[options.get("lineend", "lf").lower()]
        if self.length + len(self.end) < 1 or self.split < 1:
            raise ValueError("records and splits must hold something")

    def partitions(self) -> list[Range]:
        where, path = located(self.path)
        found = where.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        inside = where.get_file_info(fs.FileSelector(path)) if found.type == fs.FileType.Directory else [found]
        stride = self.length + len(self.end)
        ranges = []
        for info in sorted(inside, key=lambda i: i.path):
            if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
                # The last record may lack its end of line.
                total, rest = divmod(info.size, stride)
                if rest not in (0, self.length):
                    raise ValueError(f"{info.base_name}: {info.size} bytes aren't records of {self.length}")
                total += rest > 0
                ranges += [Range(info.path, first, min(self.split, total - first)) for first in range(0, total, self.split)]
        return ranges or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.n:
            return
        where, _ = located(self.path)
        stride, name = self.length + len(self.end), posixpath.basename(partition.path)
        with where.open_input_file(partition.path) as source:
            source.seek(partition.first * stride)
            for at in range(0, partition.n, BATCH):
                n, first = min(BATCH, partition.n - at), partition.first + at
                data = source.read(n * stride)
                records = []
                for i in range(n):
                    record, end = data[i * stride : i * stride + self.length], data[i * stride + self.length : (i + 1) * stride]
                    if end not in (self.end, b"") or self.end and self.end[-1:] in record:
                        raise ValueError(f"{name}: record {first + i + 1} hasn't {self.length} bytes")
                    records.append(record.decode(self.encoding))
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(first + 1, first + n + 1), pa.int64()), pa.array(records, pa.string())], names=["file", "recno", "record"])


class TwoPhase(DataSourceWriter):
    """Files of tasks, made final together."""

    suffix = ""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.load = options["path"], overwrite, uuid.uuid4().hex
        self.options = options

    def files(self, rows: Iterator, where: fs.FileSystem, stem: str) -> Iterator[tuple[str, int]]:
        """Writes rows to files whose names start with ``stem``; each file with its rows."""
        raise NotImplementedError

    def write(self, iterator: Iterator) -> Written:
        where, path = located(self.path)
        folder = f"{path}/_writing-{self.load}"
        where.create_dir(folder, recursive=True)
        task = TaskContext.get()
        stem = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        made = list(self.files(iterator, where, stem))
        return Written([name for name, _ in made], sum(n for _, n in made))

    def commit(self, messages: list[Written | None]) -> None:
        where, path = located(self.path)
        where.create_dir(path, recursive=True)
        old = [i.path for i in where.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.File] if self.overwrite else []
        for message in messages:
            for name in message.files if message else []:
                part, _, nth = re.fullmatch(r"(part-\d+)-(\d+)-(\d+)\..*", posixpath.basename(name)).groups()
                where.move(name, f"{path}/{part}-{nth}-{self.load}{self.suffix}")
        for name in old:
            where.delete_file(name)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        where, path = located(self.path)
        if where.get_file_info(f"{path}/_writing-{self.load}").type == fs.FileType.Directory:
            where.delete_dir(f"{path}/_writing-{self.load}")


class RecordWriter(TwoPhase):
    suffix = ".txt"

    def files(self, rows: Iterator, where: fs.FileSystem, stem: str) -> Iterator[tuple[str, int]]:
        length, encoding = int(self.options["length"]), self.options.get("encoding", "ISO-8859-1")
        end = {"none": b"", "lf": b"\n", "crlf": b"\r\n"}[self.options.get("lineend", "lf").lower()]
        name, n = f"{stem}-0{self.suffix}", 0
        with where.open_output_stream(name) as out:
            for row in rows:
                record = (row["record"] or "").encode(encoding)
                if len(record) > length or end and end[-1:] in record:
                    raise ValueError(f"a record of {len(record)} bytes doesn't fit {length}")
                out.write(record.ljust(length) + end)
                n += 1
        yield name, n


class StataWriter(TwoPhase):
    suffix = ".dta"

    def __init__(self, options: dict, overwrite: bool, schema: StructType):
        super().__init__(options, overwrite)
        self.types = {f.name: f.dataType.typeName() for f in schema}

    def files(self, rows: Iterator, where: fs.FileSystem, stem: str) -> Iterator[tuple[str, int]]:
        size, nth = int(self.options.get("rowsperfile", STATA_ROWS)), 0
        while (lot := list(islice(rows, size))) or nth == 0:
            table = pd.DataFrame({c: self._column([r[c] for r in lot], kind) for c, kind in self.types.items()})
            name = f"{stem}-{nth}{self.suffix}"
            held = io.BytesIO()
            table.to_stata(held, write_index=False, version=118)
            with where.open_output_stream(name) as out:
                out.write(held.getbuffer())
            yield name, len(lot)
            nth += 1

    @staticmethod
    def _column(values: list, kind: str) -> pd.Series:
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return pd.Series(pd.to_datetime(values), dtype="datetime64[ns]")
        if kind == "string":
            return pd.Series(["" if v is None else v for v in values], dtype=object)
        return pd.Series([None if v is None else float(v) for v in values], dtype="float64")


class FixedWidth(DataSource):
    """``format("fixed_width")``: file, recno (from 1, within the file) and record.

    Options: ``length`` (bytes of a record), ``lineEnd`` (lf, crlf or none), ``encoding`` (one byte a character),
    ``splitRecords`` (records of a task).  Files of a folder are read but those that start with ``_`` or ``.``; an
    empty file has no record.  A record of another length is an error that names it.  Writing needs a column
    ``record``, pads it with blanks and refuses one that is too long; a null record is blank.
    """

    @classmethod
    def name(cls) -> str:
        return "fixed_width"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options, overwrite)


class Stata(DataSource):
    """``format("stata")`` writes ``.dta`` files of up to ``rowsPerFile`` rows each.

    Numbers and booleans become doubles (whole numbers are exact up to 2^53), missing where null; a null
    string is empty, as the format has no missing string.
    """

    @classmethod
    def name(cls) -> str:
        return "stata"

    def writer(self, schema: StructType, overwrite: bool) -> StataWriter:
        return StataWriter(self.options, overwrite, schema)


def register(spark: SparkSession) -> None:
    """Makes both formats known to the session."""
    spark.dataSource.register(FixedWidth)
    spark.dataSource.register(Stata)


def read_fixed(spark: SparkSession, path: str, length: int, **options: str) -> DataFrame:
    """file, recno and record, with odd bytes as blanks, as ``fixed_width.read_records`` gives them."""
    register(spark)
    rows = spark.read.format("fixed_width").options(length=length, **options).load(path)
    return rows.withColumn("record", parsing.printable(F.col("record")))


def write_fixed(rows: DataFrame, path: str, length: int, mode: str = "overwrite", **options: str) -> None:
    register(rows.sparkSession)
    rows.select("record").write.format("fixed_width").options(length=length, **options).mode(mode).save(path)


def write_stata(rows: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    register(rows.sparkSession)
    rows.write.format("stata").options(**options).mode(mode).save(path)
