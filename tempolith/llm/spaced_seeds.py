"""Benchmark decontamination by spaced-seed hashing.

A mask is a pattern of used and ignored token positions.  The used words below each
placement of each mask are hashed, on the benchmark's side and on the documents'; equal
hashes are hits even where words under ignored positions were replaced.  Every hit names
a diagonal of (document, item), along which the whole item is then compared word by word.

Items of fewer than ``SHORT`` words have masks of their length besides, under which no
overlap of the whole item is missed.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .storage import materialise, without

#: used positions of a mask are 1; each uses six words.  Chosen one after the other, each the one that
#: fits most of the stretches of 16 words with four replaced that none before it fits; together they
#: fit 97 % of those, and all shorter or longer stretches of 12 words at 75 % more often
MASKS = ("11010111", "11100010011", "11101101", "10100001111")
#: an item is found where so many of its words match along one diagonal ...
MIN_MATCHED = 12
#: ... and they are at least this share of the stretch they span; a shorter item must match as a whole by this share
MIN_IDENTITY = 0.75
#: items of fewer words are short
SHORT = 2 * MIN_MATCHED
#: bytes of the index of one block of the benchmark, in the driver, in the broadcast and in a Python worker
MAX_BROADCAST_BYTES = 64 << 20
#: hits, and words along their diagonals, that are looked at together
CHUNK = 1 << 20
U = np.uint64
_MISS = 1.5


def seeds(h: np.ndarray, owner: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all placements of a mask inside one text, and the first word of each."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    out = np.full(n, int(mask, 2) * 2654435761 + len(mask), dtype=U)
    for i, c in enumerate(mask):
        if c == "1":
            out += h[i : i + n] * tk.mix(np.array([i + 1], dtype=U) * U(0x9E3779B97F4A7C15))[0]
    at = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    return tk.mix(out[at]), at


def short_masks(n: int) -> list[tuple[str, int]]:
    """Masks and their first words in an item of ``n`` words, one of which fits wherever enough of the item matches.

    So many words as may be replaced can't touch more pieces of the item than their
    number; the masks are all choices of as many pieces as are left.
    """
    misses = n - math.ceil(MIN_IDENTITY * n - 1e-9)
    if not misses:
        return [("1" * n, 0)]
    # pieces of two words: the masks are few and the same for most lengths
    pieces = misses + 2
    bounds = list(range(n + 1)) if n < 5 else [min(2 * i, n) for i in range(pieces + 1)]
    out = []
    for chosen in itertools.combinations(range(len(bounds) - 1), len(bounds) - 1 - misses):
        at = [k for i in chosen for k in range(bounds[i], bounds[i + 1])]
        out.append(("".join("01"[k in at] for k in range(at[0], at[-1] + 1)), at[0]))
    return out


@dataclass
class Index:
    """Seeds of one block of the benchmark, sorted, and its items' word hashes."""

    masks: list[str]
    key: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    ids: list
    #: hashes of all words, item after item, and where each item's begin
    words: np.ndarray
    first: np.ndarray
    filter: np.ndarray
    shift: int

    @classmethod
    def build(cls, items: list[tuple[object, str]], masks: tuple[str, ...] = MASKS) -> Index:
        block = next(tk.blocks(pa.array([t for _, t in items], pa.large_string()), 1 << 62))
        w = tk.words(block)
        size = np.diff(w.first)
        # where a mask of short items stands in an item of each length; the others stand everywhere
        places: dict[str, np.ndarray | None] = dict.fromkeys(masks)
        for n in sorted({int(n) for n in size if 0 < n < SHORT}):
            for mask, at in short_masks(n):
                if places.setdefault(mask, np.zeros((SHORT, SHORT), dtype=bool)) is not None:
                    places[mask][n, at] = True
        keys, owners, offsets = [], [], []
        for mask, there in places.items():
            h, at = seeds(w.hash, w.doc, mask)
            owner = w.doc[at]
            offset = at - w.first[owner]
            if there is not None:
                fits = size[owner] < SHORT
                fits[fits] = there[size[owner[fits]], offset[fits]]
                h, owner, offset = h[fits], owner[fits], offset[fits]
            keys.append(h)
            owners.append(owner.astype(np.int32))
            offsets.append(offset.astype(np.int32))
        key, item, offset = map(np.concatenate, (keys, owners, offsets))
        order = np.argsort(key, kind="stable")
        bits = max(16, min(26, int(len(key)).bit_length() + 5))
        there = np.zeros(1 << bits, dtype=bool)
        there[key >> U(64 - bits)] = True
        return cls(list(places), key[order], item[order], offset[order], [i for i, _ in items], w.hash, w.first, there, 64 - bits)

    def hits(self, w: tk.Words) -> Iterator[list[tuple[int, int, int]]]:
        """(document, item, diagonal) of equal seeds, distinct in each list; the diagonal is the item's first word in the document.

        A seed that many items and many places share is expanded a bounded number of hits at
        a time.  Hits along whose diagonal too few words match for any overlap are left out.
        """
        places, lows, counts = [], [], []
        for mask in self.masks:
            h, at = seeds(w.hash, w.doc, mask)
            some = self.filter[h >> U(self.shift)]
            h, at = h[some], at[some]
            low = np.searchsorted(self.key, h, "left")
            n = np.searchsorted(self.key, h, "right") - low
            places.append(at[n > 0])
            lows.append(low[n > 0])
            counts.append(n[n > 0])
        if not places:
            return
        # in the order of the text, so that the hits of one diagonal stand together
        word, low, n = map(np.concatenate, (places, lows, counts))
        order = np.argsort(word, kind="stable")
        word, low, n = word[order], low[order], n[order]
        total = np.cumsum(n)
        at = 0
        while at < len(n):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, "right")))
            k = n[at:end]
            entry = np.repeat(low[at:end] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            of = np.repeat(word[at:end], k)
            doc = w.doc[of]
            found = np.unique(np.stack([doc, self.item[entry].astype(np.int64), of - w.first[doc] - self.offset[entry]]), axis=1)
            yield found[:, self._matched(w, found) >= np.minimum(MIN_MATCHED, MIN_IDENTITY * np.diff(self.first)[found[1]])].T.tolist()
            at = end

    def _matched(self, w: tk.Words, found: np.ndarray) -> np.ndarray:
        """Words that match along each diagonal."""
        doc, item, diagonal = found
        low = np.maximum(0, -diagonal)
        many = np.minimum(self.first[item + 1] - self.first[item], w.first[doc + 1] - w.first[doc] - diagonal) - low
        own, other = self.first[item] + low, w.first[doc] + diagonal + low
        out, total, at = np.zeros(len(doc), np.int64), np.cumsum(many), 0
        while at < len(doc):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK, "right")))
            k = many[at:end]
            step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            same = self.words[np.repeat(own[at:end], k) + step] == w.hash[np.repeat(other[at:end], k) + step]
            out[at:end] = np.add.reduceat(same, np.cumsum(k) - k, dtype=np.int64)
            at = end
        return out

    def overlap(self, text: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int] | None:
        """Best stretch along a diagonal: (matched words, first and last word in the text), if it is long enough."""
        own = self.words[self.first[item] : self.first[item + 1]]
        low, high = max(0, -diagonal), min(len(own), len(text) - diagonal)
        same = own[low:high] == text[low + diagonal : high + diagonal]
        if len(own) < SHORT and same.sum() >= MIN_IDENTITY * len(own):
            at = np.flatnonzero(same)
            return len(at), low + diagonal + int(at[0]), low + diagonal + int(at[-1])
        score = np.concatenate([[0.0], np.cumsum(np.where(same, 1.0, -_MISS))])
        floor = np.minimum.accumulate(score)
        end = int(np.argmax(score - floor))
        if end == 0:
            return None
        start = int(np.flatnonzero(score[: end + 1] == floor[end])[-1])
        matched = int(same[start:end].sum())
        if matched < MIN_MATCHED or matched < MIN_IDENTITY * (end - start):
            # the best score may lie in too thin a stretch; of all that qualify, take the one with most matches
            total = np.concatenate([[0], np.cumsum(same)])
            surplus = total - MIN_IDENTITY * np.arange(len(total))
            starts = np.searchsorted(-np.minimum.accumulate(surplus), -surplus, "left")
            end = int(np.argmax(total - total[starts]))
            matched = int(total[end] - total[starts[end]])
            if matched < MIN_MATCHED:
                return None
            at = int(starts[end]) + np.flatnonzero(same[starts[end] : end])
            start, end = int(at[0]), int(at[-1]) + 1
        return matched, low + diagonal + start, low + diagonal + end - 1


def _scan(docs: DataFrame, index: Index, item_type: str, keyed: bool) -> tuple[DataFrame, Broadcast]:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for block in tk.blocks(batch.column(1)):
                w = tk.words(block)
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for doc, item, diagonal in itertools.chain.from_iterable(index.hits(w)):
                    found = index.overlap(w.hash[w.first[doc] : w.first[doc + 1]], item, diagonal)
                    if found and found > best.get((doc, item), (0, 0, 0)):
                        best[doc, item] = found
                if best:
                    doc_ids = batch.column(0).take(pa.array([block.first + d for d, _ in best]))
                    rows = list(zip(*best.values(), strict=True))
                    columns = [doc_ids, pa.array([index.ids[i] for _, i in best]), pa.array([int(index.first[i + 1] - index.first[i]) for _, i in best]), *(pa.array(list(r), pa.int64()) for r in rows)]
                    if keyed:
                        keys = {d: hashlib.sha256(block.data[block.bounds[d] : block.bounds[d + 1]]).digest() for d in {d for d, _ in best}}
                        columns.append(pa.array([keys[d] for d, _ in best], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, item_id {item_type}, item_words bigint, matched_words bigint, first_word bigint, last_word bigint" + (", text_key binary" if keyed else "")
    names = ["doc_id", "item_id", "item_words", "matched_words", "first_word", "last_word", *(["text_key"] if keyed else [])]
    return docs.select("doc_id", "text").mapInArrow(run, out), shared


def _index_bytes(text: Column) -> Column:
    """Bytes of an item in an index: its words' hashes and, for each of their seeds, key, item and place."""
    n = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    short = F.element_at(F.array(*(F.lit(len(short_masks(k)) if k else 0) for k in range(SHORT))), F.least(n, F.lit(SHORT - 1)) + 1)
    return F.octet_length(text) + n * (8 + 16 * len(MASKS)) + F.when(n < SHORT, 16 * short).otherwise(0)


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, max_broadcast: int = MAX_BROADCAST_BYTES, keyed: bool = False) -> DataFrame:
    """One row for each (document, item) whose texts overlap, substitutions allowed.

    Columns: doc_id, item_id, item_words, matched_words, first_word and last_word (the
    best stretch, in words of the document from 0: the one with most matched words, of
    such the last), and, if ``keyed``, text_key, the SHA-256 of the document's text.  Items of equal text stand under their least item_id.  Null and empty
    texts overlap with nothing; texts of any length are searched whole.  A repeated row of
    ``docs`` has rows of its own; columns besides doc_id, text and item_id are not read.

    The benchmark goes to the executors in blocks whose index has at most about
    ``max_broadcast`` bytes, an item that is larger by itself.  Each is searched in one pass
    over the documents, whose result is written where there are several, so neither the
    driver nor an executor holds more than one.
    """
    items = benchmark.where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = items.agg(F.sum(_index_bytes(F.col("text")))).first()[0] or 0
    blocks = max(1, math.ceil(size / max_broadcast))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    if blocks > 1:
        items = materialise(items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks))), "items")
    parts = []
    for i in range(blocks):
        part = (items.where(F.col("block") == i) if blocks > 1 else items).orderBy("item_id").collect()
        if part:
            found, shared = _scan(docs, Index.build([(r["item_id"], r["text"]) for r in part], masks), kind, keyed)
            if blocks > 1:
                found = materialise(found, "overlaps")
                shared.destroy()
            parts.append(found)
    if not parts:
        return _scan(docs.limit(0), Index.build([(0, "")], masks), kind, keyed)[0]
    return functools.reduce(DataFrame.union, parts)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that overlap with an item, all columns as they are.

    A document is told by its doc_id and text together: where a doc_id stands for several
    texts, those that overlap go and the others stay.  A row without doc_id can't be named
    and stays.
    """
    return without(docs, overlaps(docs, benchmark, keyed=True).select(F.col("doc_id").alias("of"), "text_key").distinct())
