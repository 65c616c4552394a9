"""SentencePiece encoding and decoding through a distinct-chunk table.

Where no piece of the model holds a whitespace marker after another character, no
merge can cross the border before a marker, so the text falls into independent
*marked words*.  Each distinct marked word is segmented once and its ids are joined
back by position.  A line break is a border as well where no piece contains one.

The table lives in the Python worker (and outlives a task there).  It holds the
``MAX_ENTRIES`` words of most use at most; a word that had to go is segmented again when
it comes back, which changes nothing in the result.  Texts are worked on in blocks, and of
a longer text ``SLICE`` marked words at a time, so the memory is bounded by those and by
the longest single text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import mapped
from .textkernel import tidied

MARK = "▁"
MAX_ENTRIES = 250_000
#: a worker takes some 70 MB over its start for this, and 180 MB for four times as much
BLOCK_BYTES = 1 << 20
SLICE = 1 << 21


class ChunkTable:
    """ids and decoded text of marked words, each segmented once while it stands in the table."""

    def __init__(self, model: str, max_entries: int = MAX_ENTRIES):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("this model has pieces that cross a whitespace marker; marked words are not independent")
        if any("\n" in p for p in pieces):
            raise ValueError("this model has pieces with line breaks")
        # "\n" + word shields the word from the marker that the library puts before a text.
        self.shield = self.sp.encode("\n")
        if self.sp.encode("\n\n") != [*self.shield, *self.shield[1:]] or self.sp.decode(self.shield) != "\n":
            raise ValueError("this model rewrites line breaks")
        # a word behind one space is the text "word", whose marker the library adds and drops again
        marked, plain = self.sp.encode(["\n x", "x"])
        if marked != [*self.shield, *plain] or self.sp.decode(plain) != "x":
            raise ValueError("this model has no marker before a text")
        self.ends = [pa.scalar(np.array([i], "<u4").tobytes(), pa.large_binary()) for i in (self.sp.bos_id(), self.sp.eos_id())]
        self.max_entries = max_entries
        self._clear(False)

    def _clear(self, decoded: bool) -> None:
        self.decoded = decoded
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.text = pa.array([], pa.large_string())
        self.uses = np.zeros(0)

    def _segment(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """ids and decoded text (empty where the table holds none) of distinct marked words."""
        n = len(words)
        if not n:
            return self.ids[:0], self.text[:0]
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + n + 1]
        data, ends = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]
        # one string, cut at line breaks: a marked word holds one only if it is one
        plain = np.insert(data, ends[1:-1], 0x0A).tobytes().decode().split("\n")
        if len(plain) > n:
            at = pc.index(words, "\n").as_py()
            plain[at : at + 2] = ["\n"]
        shielded = (data[ends[:-1]] != 0x20) | (np.diff(ends) == 1)
        found = self.sp.encode(["\n" + w if s else w[1:] for w, s in zip(plain, shielded.tolist(), strict=True)], num_threads=1)
        size = np.fromiter(map(len, found), np.int64, n)
        flat = np.fromiter(chain.from_iterable(found), "<u4", int(size.sum()))
        first = (np.cumsum(size) - size)[shielded]
        cut = len(self.shield)
        flat = np.delete(flat, (first[:, None] + np.arange(cut)).ravel())
        bounds = np.concatenate([[0], np.cumsum(size - cut * shielded)]) * 4
        ids = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat)])
        if not self.decoded:
            return ids, self.text[:0]
        text = self.sp.decode(found, num_threads=1)
        return ids, pa.array([t[1:] if s else " " + t for t, s in zip(text, shielded.tolist(), strict=True)], pa.large_string())

    def _look_up(self, chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
        """ids and decoded text of every one of ``chunks``; distinct ones are segmented once."""
        chunks = chunks.dictionary_encode()
        words = chunks.dictionary
        known = pc.index_in(words, value_set=self.words)
        at = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = at < 0
        at[new] = len(self.words) + np.arange(int(new.sum()))
        added = words.filter(pa.array(new))
        ids, text = self._segment(added)
        every = [pa.concat_arrays([self.words, added]), pa.concat_arrays([self.ids, ids]), pa.concat_arrays([self.text, text])]
        index = chunks.indices.to_numpy(zero_copy_only=False)
        uses = np.zeros(len(every[0]))
        uses[: len(self.uses)] = self.uses / 2  # what isn't used any more goes in time
        uses[at] += np.bincount(index, minlength=len(words))
        place = pa.array(at[index])
        out = every[1].take(place), every[2].take(place) if self.decoded else self.text[:0]
        if len(uses) > self.max_entries:
            most = pa.array(np.sort(np.argpartition(uses, len(uses) - self.max_entries)[len(uses) - self.max_entries :]))
            every, uses = [x.take(most) if len(x) else x for x in every], uses[most]
        self.words, self.ids, self.text, self.uses = *every, uses
        return out

    def encode(self, texts: pa.Array, decoded: bool = True) -> tuple[pa.Array, pa.Array | None]:
        """For each text its ids (begin and end ids included, little-endian u32) and, if asked for, their decoded text."""
        if decoded != self.decoded:
            self._clear(decoded)
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
        # the marker that the library puts before every text but an empty one
        lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
        texts = pc.binary_join_element_wise(lead, texts, pa.scalar("", pa.large_string()))
        n = len(texts)
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        start = np.zeros(len(data) + 1, dtype=bool)
        if len(data):
            space, line = data == 0x20, data == 0x0A
            start[:-1] = line
            start[1:] |= line
            start[1:-1] |= space[1:] & ~space[:-1]
            start[bounds] = True
        start[-1] = True
        offsets = np.flatnonzero(start)
        at = np.searchsorted(offsets, bounds)
        chunks = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
        # of a very long text so many marked words at a time
        found = [self._look_up(chunks.slice(i, SLICE)) for i in range(0, len(chunks), SLICE)]

        def joined(parts: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
            """Bytes of all texts, back to back, and the bounds between them."""
            if not parts:
                return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
            whole = pa.concat_arrays(parts)
            ends = np.frombuffer(whole.buffers()[1], np.int64)[: len(whole) + 1]
            return np.frombuffer(whole.buffers()[2] or b"", np.uint8)[: ends[-1]], ends[at]

        raw, cut = joined([x for x, _ in found])
        ids = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cut.copy()), pa.py_buffer(raw)])
        ids = pc.binary_join_element_wise(self.ends[0], ids, self.ends[1], pa.scalar(b"", pa.large_binary()))
        if not decoded:
            return ids, None
        raw, cut = joined([x for _, x in found])
        led = cut[1:] > cut[:-1]  # texts with a leading marker, which decoding drops
        raw = np.delete(raw, cut[:-1][led])
        cut = cut - np.concatenate([[0], np.cumsum(led)])
        return ids, pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(cut), pa.py_buffer(raw)])


_tables: dict[str, ChunkTable] = {}


def chunk_table(model: str) -> ChunkTable:
    if model not in _tables:
        _tables[model] = ChunkTable(model)
    return _tables[model]


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Blocks of whole texts of about ``limit`` bytes, a longer text by itself."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right"))
        yield column.slice(at, max(1, end - at))
        at = max(at + 1, end)


def encode(docs: DataFrame, model: str, text: str | Column = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("ids", "decoded")) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns the ``keep`` columns and, under ``names``, ids (binary, little-endian u32,
    begin and end ids included) and decoded (string).  Other columns are left out, whatever
    their names.  A null text counts as empty: it has the begin and end ids only.  Repeated
    rows are encoded one by one, a text of any length as a whole.
    """

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in batches:
            at = 0
            for texts in text_blocks(batch.column(batch.num_columns - 1)):
                ids, decoded = table.encode(texts)
                same = [c.slice(at, len(texts)) for c in batch.columns[:-1]]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*same, ids.cast(pa.binary()), decoded.cast(pa.string())], names=[*batch.schema.names[:-1], *names])

    return mapped(docs, keep, (F.col(text) if isinstance(text, str) else text).cast("string"), run, {names[0]: "binary", names[1]: "string"})


def decode(rows: DataFrame, model: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Text of id sequences (binary, little-endian u32), as the library's decode gives it; null stays null."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = chunk_table(model).sp
        for batch in batches:
            text = [None if (v := x.as_py()) is None else sp.decode(np.frombuffer(v, "<u4").tolist()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string())], names=[*batch.schema.names[:-1], "decoded"])

    return mapped(rows, keep, F.col(ids), run, {"decoded": "string"})


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of ids and of the decoded text, one row per row of ``docs``."""
    return encode(docs, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
