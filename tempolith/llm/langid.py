"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (1 to 3 letters,
``_`` standing for a word border), learned from labelled rows.  A text is compared to
each profile by out-of-place distance: the sum, over the text's own most frequent
n-grams, of how far each stands from its rank in the profile, an absent one costing the
profile's full length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import mapped, materialise
from .textkernel import tidied

PROFILE = 300
FOLDS = 5
UNDETERMINED = "und"
MAX_LANGUAGES = 500
BLOCK_BYTES = 1 << 19
_BITS = 21  # of a code point; three of them fill a bigint
_BORDER = 1  # stands for a word border in an n-gram; 0 stands for nothing
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    return _letters


def _pieces(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
        yield at, column.slice(at, end - at)
        at = end


@dataclass
class Grams:
    """n-grams of a block in the order of (document, n-gram): counts of each."""

    doc: np.ndarray
    gram: np.ndarray
    count: np.ndarray


def grams(texts: pa.Array) -> Grams:
    """Counts of the 1- to 3-grams of each text's letters; null counts as empty.

    A gram is three code points of 21 bits, the border as 1, a missing place as 0, and
    so sorts alike whatever else is in the block.
    """
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    sizes = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "\n" + "\n".join(lower.to_pylist())
    code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    letter = _is_letter()[code]
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    keep = letter.copy()  # letters, and the first of each run of others
    keep[0] = True
    keep[1:] |= letter[:-1]
    code, letter, doc = np.where(letter, code, _BORDER)[keep], letter[keep], doc[keep]
    if not letter.any():
        none = np.zeros(0, np.int64)
        return Grams(none, none, none)
    if letter[-1]:
        code, letter, doc = np.append(code, _BORDER), np.append(letter, False), np.append(doc, doc[-1])
    seen = np.zeros(0x110000, dtype=bool)
    seen[code] = True
    alphabet = np.flatnonzero(seen)
    place = np.zeros(0x110000, dtype=np.int64)
    place[alphabet] = np.arange(1, len(alphabet) + 1)
    bits = int(len(alphabet)).bit_length()
    if 3 * bits + max(1, len(sizes) - 1).bit_length() > 62:  # very many scripts: fewer texts at once
        if len(sizes) == 1:
            raise ValueError("a text of over two million different letters")
        half = len(sizes) // 2
        a, b = grams(texts.slice(0, half)), grams(texts.slice(half))
        return Grams(*(np.concatenate(x) for x in ((a.doc, b.doc + half), (a.gram, b.gram), (a.count, b.count))))
    c = place[code]
    base = doc << (3 * bits)
    one = (base + (c << (2 * bits)))[letter]
    pair = c[:-1] << (2 * bits) | c[1:] << bits
    pair = (np.where(letter[:-1], base[:-1], base[1:]) + pair)[letter[:-1] | letter[1:]]
    triple = (base[1:-1] + (c[:-2] << (2 * bits) | c[1:-1] << bits | c[2:]))[letter[1:-1]]
    keys = np.concatenate([one, pair, triple])
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count, keys = np.diff(np.append(new, len(keys))), keys[new]
    wide, mask = np.concatenate([[0], alphabet]).astype(np.int64), (1 << bits) - 1
    gram = wide[keys >> (2 * bits) & mask] << (2 * _BITS) | wide[keys >> bits & mask] << _BITS | wide[keys & mask]
    return Grams(keys >> (3 * bits), gram, count)


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """The fold of a document; fold 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """Profiles: (lang, rank from 0, gram), ``size`` ranks at most for each language.

    Counts cover every row with a language, repeated rows each time, and whole texts; rows
    without text add nothing.  Ties in count are broken by the n-gram itself.
    """
    source = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, gram: np.ndarray, n: np.ndarray) -> None:
            if lang in held:
                gram, n = np.concatenate([held[lang][0], gram]), np.concatenate([held[lang][1], n])
            gram, at = np.unique(gram, return_inverse=True)
            held[lang] = gram, np.bincount(at, weights=n, minlength=len(gram)).astype(np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (gram, n) in held.items():
                for i in range(0, len(gram), 50_000):
                    part = gram[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part), pa.array(n[i : i + 50_000])], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                for _, texts in _pieces(batch.column(1).filter(pa.array(langs == lang))):
                    found = grams(texts)
                    add(lang, found.gram, found.count)
                    del found
            if sum(len(g) for g, _ in held.values()) > 1_000_000:  # bounded memory, whatever the scripts
                yield from rows()
        yield from rows()

    total = source.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # so written each task passes on its own first ranks of a language only
    ranked = total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return ranked.select("lang", (F.col("place") - 1).alias("rank"), "gram")


class Profiles:
    """Profiles as one table: n-gram by language, the rank or the penalty of absence."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        at = {x: i for i, x in enumerate(self.langs)}
        self.grams = np.unique(np.array([r[2] for r in rows], dtype=np.int64))
        self.ranks = np.full((len(self.grams), len(self.langs)), -1, dtype=np.int16)
        for lang, rank, gram in rows:
            self.ranks[np.searchsorted(self.grams, gram), at[lang]] = rank

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Nearest language of each text and how near it is: 1 less the share of the largest possible distance."""
        docs, found = len(texts), grams(texts)
        lang, score = [UNDETERMINED] * docs, np.zeros(docs)
        if not len(found.doc) or not self.langs:
            return lang, score
        # rank within each text: by falling count, then by n-gram
        most = int(found.count.max())
        order = np.argsort(found.doc * (most + 1) + (most - found.count), kind="stable")
        doc = found.doc[order]
        first = np.searchsorted(doc, np.arange(docs))
        rank = np.arange(len(doc)) - first[doc]
        top = rank < self.size
        doc, rank, gram = doc[top], rank[top], found.gram[order][top]
        used = np.bincount(doc, minlength=docs)
        at = np.searchsorted(self.grams, gram)
        at[at == len(self.grams)] = 0
        hit = self.grams[at] == gram
        doc_hit, rank_hit, ranks = doc[hit], rank[hit], self.ranks[at[hit]]
        distance = np.empty((docs, len(self.langs)))
        for i in range(len(self.langs)):
            known = ranks[:, i] >= 0
            saved = np.where(known, self.size - np.abs(rank_hit - ranks[:, i]), 0)
            distance[:, i] = used * self.size - np.bincount(doc_hit, weights=saved, minlength=docs)
        best = distance.argmin(axis=1)
        for i in np.flatnonzero(used):
            lang[i] = self.langs[best[i]]
            score[i] = 1 - distance[i, best[i]] / (used[i] * self.size)
        return lang, score


def predict(docs: DataFrame, profiles: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns, lang_pred and score (under ``names``) for every row of ``docs``.

    ``und`` with score 0 where the text is null or has no letter, or where no language
    was learned.  Ties go to the language first in order.  Repeated rows and doc_ids are
    told one by one, and a text is told as a whole.  Only the profiles reach the driver and
    the workers: at most PROFILE rows for each language, of MAX_LANGUAGES languages; more
    are refused, as such a column holds something else.
    """
    profiles = materialise(profiles, "profiles")
    if profiles.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"profiles of over {MAX_LANGUAGES} languages")
    learned = Profiles([(r["lang"], r["rank"], r["gram"]) for r in profiles.collect()])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _pieces(batch.column(batch.num_columns - 1)):
                lang, score = learned.predict(texts)
                same = [c.slice(at, len(texts)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*same, pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names[:-1], *names])

    return mapped(docs, keep, F.col(text), run, {names[0]: "string", names[1]: "double"})


def identify(docs: DataFrame, folds: int = FOLDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred and score: learned outside fold 0, predicted for every row.

    A null doc_id has no fold: it is not learned from and not held out.
    """
    learned = learn(docs.where(fold(F.col("doc_id"), folds) != 0))
    held = F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out")
    return predict(docs, learned, keep=("doc_id", *keep)).select("doc_id", held, "lang_pred", "score", *keep)
