"""Text fields to typed values, in the three ways that the loaders need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_number(c: Column, kind: str = "int") -> Column:
    """Blank to null; text that isn't a number raises (needs ANSI mode)."""
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(F.trim(c).cast(kind))


def lenient_int(c: Column) -> Column:
    """All digits once trimmed, or null."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("int"))


def prefix_int(c: Column) -> Column:
    """The leading number: null if the field starts blank, 0 where no digit leads (``1A`` is 1, ``A`` is 0)."""
    number = F.regexp_extract(c, r"^[+-]?[0-9]+", 0)
    return F.when(c.isNull() | c.rlike(r"^[ \t]") | (c == ""), F.lit(None)).otherwise(F.when(number == "", F.lit(0)).otherwise(number.try_cast("int")))


def quiet_number(c: Column) -> Column:
    """A double, or null where the text isn't one."""
    return F.trim(c).try_cast("double")


def trimmed(c: Column) -> Column:
    """Without blanks and tabs at either end; empty is null."""
    t = F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")
    return F.when(t != "", t)


def valid_text(c: Column, instead: str = "NA_unicode") -> Column:
    """Bytes as text, or ``instead`` where they aren't UTF-8."""
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).when(c.isNotNull(), F.lit(instead))


def printable(c: Column) -> Column:
    """NUL and 0xFF characters as blanks, so that positions stay."""
    return F.translate(c, "\u0000ÿ", "  ")


def coded(c: Column, labels: dict[str, str], otherwise: str | None = None) -> Column:
    """The label of a one-code field; other codes give ``otherwise`` (null by default, and null stays null)."""
    out = F.lit(otherwise) if otherwise is not None else F.lit(None).cast("string")
    for code, label in labels.items():
        out = F.when(c == code, F.lit(label)).otherwise(out)
    return F.when(c.isNotNull(), out)


def packed_codes(c: Column, width: int = 2, count: int = 7) -> Column:
    """The non-blank codes of a field of ``count`` codes of ``width`` characters, as an array."""
    codes = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.trim(F.substring(c, i * width + 1, F.lit(width))))
    return F.when(c.isNotNull(), F.filter(codes, lambda x: x != ""))


def between_quotes(c: Column) -> Column:
    """What stands after the first single quote, up to the next."""
    return F.get(F.split(c, "'"), F.lit(1))
