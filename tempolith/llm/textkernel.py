"""Vectorised word scanning over Arrow string batches.

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR.  All
kernels work on blocks of whole documents of about ``BLOCK_BYTES``, so memory is
bounded by that and by the longest single document, not by the Arrow batch.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U = np.uint64
_MULT = U(0x9E3779B97F4A7C15)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64-bit integers."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, giving freed memory back to the system at its end: Python workers outlive their tasks."""

    @functools.wraps(run)
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps its memory
                ctypes.CDLL(None).malloc_trim(0)

    return tidy


@dataclass
class Block:
    """Bytes of some whole documents, back to back; document i is data[bounds[i]:bounds[i + 1]]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def size(self) -> int:
        return len(self.bounds) - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column (null counts as empty) into blocks of whole documents."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(n, max(at + 1, end))
        yield Block(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    #: first word of each document, and one past the last of the block
    first: np.ndarray


def coded(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes of spans, equal exactly where their bytes are, and the distinct spans the codes stand for.

    Spans are in order and don't overlap.
    """
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    mark = np.zeros(len(data) + 1, dtype=np.int8)
    mark[start] += 1
    mark[end] -= 1
    raw = data[np.cumsum(mark[:-1], dtype=np.int8).view(bool)]
    found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def hashes(values: pa.Array) -> np.ndarray:
    """SipHash of each value, the same in every process; its structure makes no collisions that a text could aim at by its form."""
    return pd.util.hash_array(np.array(values.to_pylist(), dtype=object), categorize=False)


def runs(inner: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true values that crosses none of ``bounds``."""
    n = len(inner)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    np.logical_or(~inner[:-1], edge[1:n], out=before[1:])
    start = np.flatnonzero(inner & before)
    after = np.empty(n, dtype=bool)
    after[-1] = True
    np.logical_or(~inner[1:], edge[1:n], out=after[:-1])
    return start, np.flatnonzero(inner & after) + 1


def words(block: Block) -> Words:
    """Positions, documents and 64-bit hashes of all words of a block."""
    data, n = block.data, len(block.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, U), np.zeros(block.size + 1, np.int64))
    start, end = runs(~IS_SPACE[data], block.bounds)
    code, distinct_words = coded(data, start, end)
    hashed = hashes(distinct_words)[code]
    first = np.searchsorted(start, block.bounds, "left")
    doc = np.repeat(np.arange(block.size), np.diff(first))
    return Words(start, end, doc, hashed, first)


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``k`` words inside one document."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = np.zeros(n - k + 1, dtype=U)
    for i in range(k):
        h += w.hash[i : n - k + 1 + i] * mix(np.array([i + 1], dtype=U) * _MULT)[0]
        h = mix(h) if i == k - 1 else h
    at = np.flatnonzero(w.doc[: n - k + 1] == w.doc[k - 1 :])
    return h[at], at


def shingles(w: Words, k: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all word shingles, repeats included.

    A document of fewer than ``k`` words, but at least one, has one shingle: all its words.
    """
    h, at = windows(w, k)
    doc = w.doc[at]
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        place = np.arange(len(w.hash)) - w.first[w.doc]
        keep = count[w.doc] < k
        part = w.hash[keep] * mix((place[keep] + 101).astype(U) * _MULT)
        sums = np.zeros(docs, dtype=U)
        np.add.at(sums, w.doc[keep], part)
        h = np.concatenate([h, mix(sums[short] + count[short].astype(U))])
        doc = np.concatenate([doc, short])
    return doc, h


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash) with counts, ordered by document, then hash."""
    if not len(h):
        return doc[:0], h[:0], np.zeros(0, np.int64)
    order = np.argsort(h)
    order = order[np.argsort(doc[order], kind="stable")]
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
    return doc[new], h[new], np.diff(np.append(new, len(h)))
