"""Table definitions kept as data: where fields stand in a record, and what they hold."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, parsing


def parse_labels(spec: str) -> tuple[dict[str, str], str | None]:
    """``'F' = felony; 'J' = juvenile`` as codes with labels; the label of an empty code is the one for all others."""
    labels: dict[str, str] = {}
    for part in filter(None, (p.strip() for p in spec.split(";"))):
        m = re.fullmatch(r"'([^']*)'\s*=\s*(.+)", part)
        if not m:
            raise ValueError(f"not a code with a label: {part!r}")
        labels[m[1]] = m[2].strip()
    return labels, labels.pop("", None)


@dataclass(frozen=True)
class Field:
    """start counts from 1; kind: a type name, ``date``, or a list of codes with labels."""

    name: str
    start: int
    length: int
    kind: str
    abbreviation: str = ""

    @property
    def is_labels(self) -> bool:
        return "=" in self.kind and "'" in self.kind

    @property
    def is_serial(self) -> bool:
        return "serial" in self.kind

    @property
    def is_whole(self) -> bool:
        return self.kind.endswith("int")

    def text(self, record: Column) -> Column:
        """The field's characters, as they stand."""
        return F.substring(record, self.start, self.length).alias(self.name)

    def typed(self, c: Column, mode: str = "lenient") -> Column:
        """mode: lenient (bad text is null), strict (bad text raises) or prefix (leading digits count)."""
        if self.is_labels:
            labels, otherwise = parse_labels(self.kind)
            out = parsing.coded(c, labels, otherwise)
        elif self.is_whole:
            read = {"lenient": parsing.lenient_int, "strict": parsing.strict_number, "prefix": parsing.prefix_int}[mode]
            out = read(c).cast({"bigint": "long", "smallint": "short"}.get(self.kind, "int"))
        elif self.kind == "date":
            out = dates.compact_date(c)
        elif self.kind in ("float", "double"):
            out = parsing.strict_number(c, "double") if mode == "strict" else parsing.quiet_number(c)
        elif self.kind == "boolean":
            out = F.trim(c).try_cast("boolean")
        else:
            out = parsing.trimmed(c) if mode == "prefix" else c
        return out.alias(self.name)


@dataclass(frozen=True)
class TableDef:
    name: str
    fields: tuple[Field, ...]
    length: int

    @staticmethod
    def of(name: str, fields: list[tuple], length: int | None = None) -> TableDef:
        made = tuple(Field(*f) for f in fields)
        return TableDef(name, made, length or max(f.start + f.length - 1 for f in made))

    @staticmethod
    def from_rows(name: str, rows: list[dict], length: int | None = None) -> TableDef:
        """From rows with full_name, abbreviation, start, length, type; rows without a start are made, not read."""
        read = [(r["full_name"], int(r["start"]), int(r["length"]), r["type"], r.get("abbreviation") or "") for r in rows if str(r["start"] or "NA") != "NA"]
        return TableDef.of(name, read, length)

    def split(self, raw: DataFrame, keep: tuple[str, ...] = ("file", "recno"), record: str = "record") -> DataFrame:
        """Every field as text."""
        return raw.select(*keep, *(f.text(F.col(record)) for f in self.fields))

    def typed(self, text: DataFrame, mode: str = "lenient", keep: tuple[str, ...] = ("file", "recno")) -> DataFrame:
        """Every text field as its type."""
        return text.select(*keep, *(f.typed(F.col(f.name), mode) for f in self.fields))

    def format(self, rows: DataFrame) -> Column:
        """The record of typed rows: numbers right-aligned with zeros, texts left-aligned with blanks."""
        parts, at = [], 1
        for f in sorted(self.fields, key=lambda f: f.start):
            if f.start > at:
                parts.append(F.lit(" " * (f.start - at)))
            c = F.col(f.name).cast("string")
            padded = F.lpad(c, f.length, "0") if f.is_whole else F.rpad(c, f.length, " ")
            parts.append(F.coalesce(padded, F.lit(" " * f.length)))
            at = f.start + f.length
        if at <= self.length:
            parts.append(F.lit(" " * (self.length - at + 1)))
        return F.concat(*parts)


def by_length(raw: DataFrame, layouts: dict[int, TableDef], mode: str = "lenient", record: str = "record") -> DataFrame:
    """Each record typed by the layout of its length; any other length raises."""
    known = F.length(record).isin(list(layouts))
    checked = raw.withColumn(record, F.when(known, F.col(record)).otherwise(F.raise_error(F.concat(F.lit("no layout for a record of length "), F.length(record).cast("string")))))
    parts = [t.typed(t.split(checked.filter(F.length(record) == n), record=record), mode).withColumn("layout", F.lit(t.name)) for n, t in layouts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
