"""Fill-in-the-middle transformation of training texts.

A block of texts is decoded to one array of code points (UTF-32).  Neighbouring code points
of different classes bound a unit; ``flatnonzero`` gives the bounds of all units, chosen
ranks index them, and the pieces between are cut out and encoded again.  The choices are
drawn from a hash of the document's id, so they don't depend on how the table is dealt out
and are the same whenever a task is run again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .storage import mapped

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: of 100 texts so many are cut; of 100 that are cut so many have the suffix first
CUT, SUFFIX_FIRST = 90, 20
SALT = "1"
NAMES = ("output", "form", "n", "prefix_chars", "middle_chars")
UNITS = ("char", "word", "line")
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], dtype=np.uint32)


def classes(points: np.ndarray, unit: str) -> np.ndarray:
    """A class for each code point; a unit is a run of one class.

    ``char``: every code point is a unit.  ``word``: words and the whitespace between them
    are units.  ``line``: a line with its break is one.
    """
    if unit == "char":
        return np.arange(len(points), dtype=np.int64)
    if unit == "word":
        return np.isin(points, _SPACES).astype(np.int64)
    ends = points == 0x0A
    return np.cumsum(ends) - ends


def boundaries(points: np.ndarray, unit: str) -> np.ndarray:
    """Where units end: 0, then the end of each unit in code points."""
    if not len(points):
        return np.zeros(1, np.int64)
    kind = classes(points, unit)
    return np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(points)]])


def draws(doc_id: object, salt: str = SALT) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document; a null id draws as the empty word."""
    found = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(found[i : i + 4], "big") for i in (0, 4, 8, 12))


def arrange(prefix: str, middle: str, suffix: str, form: str) -> str:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def restored(output: Column, form: Column) -> Column:
    """The text that was cut; no text that is cut holds a marker, so the first of each kind is the one put in."""

    def between(low: Column, high: Column) -> Column:
        return F.substring(output, low, high - low)

    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))
    middle = F.substring(output, m + 3, F.length(output))
    psm, spm = (between(p + 3, s), between(s + 3, m)), (between(p + 3, m), between(s + 3, p))
    return F.when(form == "psm", F.concat(psm[0], middle, psm[1])).when(form == "spm", F.concat(spm[0], middle, spm[1])).otherwise(output)


def cut(points: np.ndarray, doc_id: object, unit: str = "char", salt: str = SALT) -> tuple[str, str, int, int | None, int | None]:
    """NAMES of one text, given as its code points."""
    h, text = draws(doc_id, salt), points.tobytes().decode("utf-32-le")
    if not len(points) or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= CUT:
        return text, "plain", len(points), None, None
    bounds = boundaries(points, unit)
    low, high = sorted((h[0] % len(bounds), h[1] % len(bounds)))  # ranks from 0 to the number of units
    i, j = int(bounds[low]), int(bounds[high])
    form = "spm" if h[3] % 100 < SUFFIX_FIRST else "psm"
    pieces = (points[a:b].tobytes().decode("utf-32-le") for a, b in ((0, i), (i, j), (j, len(points))))
    return arrange(*pieces, form), form, len(points), i, j - i


def transform(docs: DataFrame, unit: str = "char", salt: str = SALT, names: tuple[str, ...] = NAMES) -> DataFrame:
    """``docs`` (doc_id, text and any others), with the columns NAMES, under ``names``, in place of text.

    output is the text as a model is to see it, n the text's code points, form ``plain``,
    ``psm`` or ``spm``; ``restored`` gives the text back.  A text is cut at two units drawn
    from its doc_id; a null text counts as empty.  Empty texts, texts that hold a marker, and
    one of ten of the rest by lot stay plain and have null for the lengths of the pieces.  A
    null doc_id draws like an empty one; repeated rows are cut alike.  Texts of any length are
    cut whole, a block of some of them at a time.  An empty table gives an empty one.  A
    column of ``docs`` under one of the names is refused.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    keep = [c for c in docs.columns if c != "text"]
    at = keep.index("doc_id")

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column(batch.num_columns - 1)):
                same = [c.slice(block.first, block.size) for c in batch.columns[:-1]]
                points = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
                heads = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])[block.bounds]
                ids = same[at].to_pylist()
                found = zip(*(cut(points[a:b], i, unit, salt) for a, b, i in zip(heads[:-1], heads[1:], ids, strict=True)), strict=True)
                added = [pa.array(column, kind) for column, kind in zip(found, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*same, *added], names=[*batch.schema.names[:-1], *names])

    return mapped(docs, keep, F.col("text"), run, dict(zip(names, ("string", "string", "bigint", "bigint", "bigint"), strict=True)))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns: the lengths, and digests of the output and of the text rebuilt from it."""
    found = transform(docs.select("doc_id", "text"))
    sums = [F.sha2(text.cast("binary"), 256).alias(name) for text, name in ((F.col("output"), "output_sha256"), (restored(F.col("output"), F.col("form")), "restored_sha256"))]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sums)
