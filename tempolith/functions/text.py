"""String functions of the extraction step, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


SPACES = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once: keeps nested expressions from doubling in size."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def find(text: Column, part: Column | str) -> Column:
    """Offset of the first occurrence from 0, or -1."""
    return F.locate(part, text) - 1 if isinstance(part, str) else F.position(part, text) - 1


def find_last(text: Column, char: str) -> Column:
    """Offset of the last occurrence of one character from 0, or -1."""
    at = F.instr(F.reverse(text), char)
    return F.when(at > 0, F.length(text) - at).otherwise(-1)


def strip(text: Column) -> Column:
    """Without any leading and trailing white space."""
    return F.btrim(text, F.lit(SPACES))


def strip_think(out: Column) -> Column:
    """What follows a model's first closing think tag, stripped; the whole text without one."""
    at = F.instr(out, "</think>")
    return F.when(at > 0, strip(F.substring(out, at + 8, F.length(out)))).otherwise(out)


def bracketed(out: Column, opening: str = "[", closing: str = "]") -> Column:
    """From the first opening to the last closing bracket; null where there is no such stretch."""
    first, last = F.instr(out, opening), find_last(out, closing) + 1
    return F.when((first > 0) & (last >= first), F.substring(out, first, last - first + 1))


def batch(position: Column, size: int = 4) -> Column:
    """Number of the batch of ``size`` in which a position falls."""
    return F.floor(position / size).cast("int")


def snippet(text: Column, begin1: Column, end1: Column, begin2: Column, end2: Column) -> Column:
    """Text from the earlier begin to the later end of two spans."""
    begin = F.least(begin1, begin2)
    return F.substring(text, begin + 1, F.greatest(end1, end2) - begin)


def parse_int(text: Column, sentinel: int) -> Column:
    """Integer of a text, the sentinel for what is none."""
    return F.coalesce(F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int")), F.lit(sentinel))
