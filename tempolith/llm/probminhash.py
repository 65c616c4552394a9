"""Near-duplicate classes by ProbMinHash, banding and exact verification.

1. *Signatures.*  Each distinct word shingle of a document sends a Poisson process of
   arrivals whose rate is its weight; every arrival falls into one of ``registers``
   registers, and a register keeps the shingle that came first.  Two documents agree in
   a register with probability equal to their probability Jaccard similarity.  Arrivals
   come in order of time, so a document stops as soon as all registers are final.
   The weights are a choice: 1 for each shingle, when that probability is the Jaccard
   similarity of the sets, or (``weighted``) how often it occurs.  Signatures, verification
   and the search for leftovers all take the same measure.
2. *Banding.*  Equal texts are one class from the start and go on as one row.  Rows
   that agree in all ``rows`` registers of a band share a bucket, and each is compared to
   the bucket's least id, never all to all.
3. *Verification.*  Candidates whose signatures are far apart are dropped, the rest are
   compared on all their shingles.  Connected components of the links are the classes.
4. *Leftovers.*  In a bucket that still holds several classes, members outside the largest
   one may resemble a member that is not the pivot.  They are joined to the members of such
   buckets by an exact prefix filter: with shingles ordered from the rarest on, two similar
   texts share one among the first fifth of each one's weight, in the smaller of two sets
   among the first ninth, and the places where it stands there bound their similarity.
   Sketches of one bit for each register keep apart, within the join, what shares shingles
   without being alike (of pairs at the least similarity one in a million is lost by this).
   A version of a text that differs too much starts with shingles of its own and so meets
   nobody.  What passes is verified as well.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textkernel as tk
from .components import connected_components
from .storage import materialise, quoted, release, text_key, unused, without

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 96
ROWS = 4
U = np.uint64


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (docs x registers, uint32) of weighted sets.

    ``doc``, ``element`` and ``weight`` list each distinct element of each document.  A
    document without elements has a row of zeros.
    """
    total = np.bincount(doc, weights=weight, minlength=docs)
    time = np.full(docs * registers, np.inf)
    owner = np.zeros(docs * registers, dtype=U)
    todo = total > 0
    slack = 2.5
    while todo.any():
        with np.errstate(divide="ignore"):
            limit = np.where(todo, registers / total * (math.log(registers) + slack), 0.0)
        at = np.flatnonzero(todo[doc])
        clock = np.zeros(len(at))
        step = 0
        while len(at):
            # a few arrivals at a time; more for the few elements that go on
            many = 1 if step == 0 else 4 if len(at) > 20_000 else 32
            serial = np.arange(step + 1, step + 1 + many).astype(U)
            bits = tk.mix(element[at][:, None] + serial[None, :] * U(0x9E3779B97F4A7C15))
            when = clock[:, None] + np.cumsum(-np.log(_uniform(bits)), axis=1) / weight[at][:, None]
            live = when < limit[doc[at]][:, None]
            i, j = np.nonzero(live)
            slot = doc[at[i]] * registers + (tk.mix(bits[i, j] ^ U(0xD1B54A32D192ED03)) % U(registers)).astype(np.int64)
            came = when[i, j]
            np.minimum.at(time, slot, came)
            won = time[slot] == came
            owner[slot[won]] = element[at[i[won]]]
            clock, going = when[:, -1], live[:, -1]
            at, clock = at[going], clock[going]
            step += many
        # done where the last register was filled before the limit
        todo &= ~np.isfinite(time.reshape(docs, registers)).all(axis=1)
        slack += 6
    return (owner >> U(32)).astype(np.uint32).reshape(docs, registers)


def sketches(sig: np.ndarray) -> np.ndarray:
    """One bit of each of the first 128 registers, as two signed longs for each row; unequal registers give equal bits half the time."""
    places = np.arange(1, sig.shape[1] + 1).astype(U) * U(0x9E3779B97F4A7C15)
    bits = np.zeros((len(sig), 128), np.uint8)
    some = (tk.mix(sig.astype(U) + places) & U(1))[:, :128]
    bits[:, : some.shape[1]] = some
    return np.packbits(bits, axis=1).view("<i8")


def reach(bits: int, similarity: float, miss: float = 1e-6) -> int:
    """So many of ``bits`` differ at most between two sketches at ``similarity``, save for a share ``miss``."""
    p, total, k = (1 - similarity) / 2, 0.0, -1
    while total < 1 - miss:
        k += 1
        total += math.comb(bits, k) * p**k * (1 - p) ** (bits - k)
    return k


def sign(docs: DataFrame, shingle: int = SHINGLE, registers: int = REGISTERS, weighted: bool = False) -> DataFrame:
    """(doc_id, n, sig, s0, s1, text_key): distinct shingles, the signature as little-endian u32, empty where a text has no word, its sketch, and the text's SHA-256."""

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column(1)):
                doc, h, count = tk.distinct(*tk.shingles(tk.words(block), shingle, block.size))
                sig = signatures(doc, h, count.astype(float) if weighted else np.ones(len(h)), block.size, registers)
                some = np.bincount(doc, minlength=block.size)
                rows = [s.tobytes() if x else b"" for s, x in zip(sig.astype("<u4"), some, strict=True)]
                raw, cuts = memoryview(block.data.tobytes()), block.bounds.tolist()
                keys = [hashlib.sha256(raw[i:j]).digest() for i, j in itertools.pairwise(cuts)]
                s0, s1 = sketches(sig).T
                columns = [pa.array(some), pa.array(rows, pa.binary()), pa.array(s0), pa.array(s1), pa.array(keys, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.size), *columns], names=["doc_id", "n", "sig", "s0", "s1", "text_key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, sig binary, s0 bigint, s1 bigint, text_key binary")


def _agree(pairs: DataFrame, least: float, registers: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in at least the share ``least``."""

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), "<u4").reshape(-1, registers) for i in (2, 3))
                yield part.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, f"a {kind}, b {kind}")


def probability_jaccard(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray) -> float:
    """Probability Jaccard similarity of elements ``x`` with weights ``a`` and ``y`` with ``b``, each distinct.

    The sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i).  In the order of
    a / b the first term is the greater one from i on, the second before it.
    """
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    own_a, own_b = a[i].astype(float), b[j].astype(float)
    order = np.argsort(own_a / own_b, kind="stable")
    own_a, own_b = own_a[order], own_b[order]
    after, before = own_a.sum() - np.cumsum(own_a) + own_a, np.cumsum(own_b) - own_b
    return float((1 / ((after + a.sum() - own_a.sum()) / own_a + (before + b.sum() - own_b.sum()) / own_b)).sum())


def verify(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """Pairs (a, b) whose whole texts (id, text) have, by their word shingles, a Jaccard similarity of at least ``similarity``.

    Of the sets, or ``weighted`` the probability Jaccard similarity of how often each occurs.
    """
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    whole = with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for block in tk.blocks(column):
            doc, h, count = tk.distinct(*tk.shingles(tk.words(block), shingle, block.size))
            cut = np.searchsorted(doc, np.arange(1, block.size))
            yield from zip(np.split(h, cut), np.split(count, cut), strict=True)

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                same = []
                for (x, p), (y, q) in zip(sets(part.column(2)), sets(part.column(3)), strict=True):
                    if weighted:
                        same.append(probability_jaccard(x, p, y, q) >= similarity - 1e-9)
                    else:
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        same.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
                yield part.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return whole.mapInArrow(run, f"a {kind}, b {kind}")


def _tokens(texts: DataFrame, shingle: int, weighted: bool) -> DataFrame:
    """(id, h, w): the distinct shingles of each text and their weights."""

    @tk.tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tk.blocks(batch.column(1)):
                doc, h, count = tk.distinct(*tk.shingles(tk.words(block), shingle, block.size))
                ids, weight = batch.column(0).slice(block.first, block.size), count if weighted else np.ones(len(h), np.int64)
                for i in range(0, len(h), 100_000):
                    here = slice(i, i + 100_000)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc[here])), pa.array(h[here].view(np.int64)), pa.array(weight[here])], names=["id", "h", "w"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "text").mapInArrow(run, f"id {kind}, h bigint, w bigint")


def _leftovers(buckets: DataFrame, part: DataFrame, reps: DataFrame, texts: DataFrame, shingle: int, similarity: float, registers: int, weighted: bool) -> DataFrame:
    """Pairs (id, pivot) of different classes that may be similar, one outside the largest class of a bucket they may share."""
    of = buckets.select("bucket", "id").join(part.select(F.col("node").alias("id"), "component"), "id", "left")
    of = materialise(of.select("bucket", "id", F.coalesce("component", "id").alias("component")), "of")
    sizes = of.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    split = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("classes")).where("classes > 1")
    open_ = of.join(materialise(split.select("bucket", F.col("main.component").alias("main")), "split"), "bucket")
    open_ = materialise(open_.groupBy("id", "component").agg(F.max(F.col("component") != F.col("main")).alias("outside")), "open")
    release(of)
    tokens = materialise(_tokens(texts.join(open_.select("id"), "id", "left_semi"), shingle, weighted), "tokens")
    often = materialise(tokens.groupBy("h").agg(F.count("*").alias("df")), "often")
    own = Window.partitionBy("id")
    upto = own.orderBy("df", "h").rowsBetween(Window.unboundedPreceding, -1)
    # the weight of a shingle and of all rarer ones before it is what a text that shares none of these has lost
    ranked = tokens.join(often, "h").select("id", "h", F.sum("w").over(own).alias("n"), F.coalesce(F.sum("w").over(upto), F.lit(0)).alias("before"))
    ranked = ranked.select("id", "h", "n", (F.col("n") - F.col("before")).alias("left"))
    first = ranked.where(F.col("left") >= similarity * F.col("n") - 1e-6)
    sketch = reps.join(open_.select("id"), "id", "left_semi").select("id", "s0", "s1")
    first = materialise(first.join(open_.join(sketch, "id"), "id"), "prefixes")
    release(tokens, often, open_)
    x, y = F.col("x.n"), F.col("y.n")
    fits = (F.col("x.h") == F.col("y.h")) & (F.col("x.component") != F.col("y.component"))
    apart = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in ("s0", "s1")), F.lit(0))
    fits &= apart <= reach(min(registers, 128), similarity)
    fits &= F.col("x.outside") | F.col("y.outside")
    if weighted:
        # With P and Q the shares of both texts' weights that lie on common shingles, probability Jaccard is at
        # most 1 / (1 / P + 1 / Q - 1): its terms are at most 1 / (a / p_i + b / q_i) with a = 1 - (1 - c) P and
        # b = 1 - c Q for any c of 0 to 1, a concave function of p_i and q_i.  At the first common shingle what is left
        # bounds P and Q, and one of them must be as near to 1 as half the sum demands.
        sums = 1 + 1 / similarity + 1e-6
        small = first.where(F.col("n") <= sums / 2 * F.col("left"))
        fits &= x / F.col("x.left") + y / F.col("y.left") <= sums
        fits &= (y > sums / 2 * F.col("y.left")) | (F.col("x.id") < F.col("y.id"))
    else:
        # of sets, at least this many of both are common: the shared shingle must stand early enough in the
        # smaller text for a partner of its own size, so a shingle that is early in none meets nobody
        common = similarity / (1 + similarity)
        small = first.where(F.col("left") >= 2 * common * F.col("n") - 1e-6)
        fits &= x <= y
        fits &= F.least(F.col("x.left"), F.col("y.left")) >= common * (x + y) - 1e-6
    met = small.alias("x").join(first.alias("y"), fits)
    return met.select(F.col("x.id").alias("id"), F.col("y.id").alias("pivot"))


def classes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, registers: int = REGISTERS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """(doc_id, text_key, class_id, n_links, place) for every row of ``docs`` (doc_id, text).

    text_key is the text's SHA-256, so a row is named by its id and its text: where a
    doc_id stands for several texts, each has its own class.  place is ``first`` for one row
    of each class, that of the least doc_id, ``repeat`` for rows with that row's id and text,
    and ``other`` for the rest.  See ``near_duplicates`` for everything else.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # a table, so that the number of a row is the same wherever it is read
    signed = materialise(sign(docs, shingle, registers, weighted).withColumn("row", F.monotonically_increasing_id()), "signed")
    keys = signed.select("doc_id", "row", "text_key")
    # a text's node is its first row: the least doc_id, null last
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    first = materialise(keys.groupBy("text_key").agg(least_row.alias("f")).select("text_key", F.col("f.row").alias("node"), F.col("f.doc_id").alias("rep_id")), "first")
    member = materialise(keys.join(first, "text_key").select("doc_id", "text_key", "row", "node", "rep_id"), "member")
    reps = signed.where("n > 0").select(F.col("row").alias("id"), "doc_id", "text_key", "n", "sig", "s0", "s1").join(member.where("row = node").select(F.col("row").alias("id")), "id", "left_semi")
    reps = materialise(reps, "reps")
    release(signed)
    width = 4 * rows
    bands = reps.select("id", "doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(registers // rows - 1)), lambda i: F.substring("sig", (i * width + 1).cast("int"), F.lit(width)))).alias("band", "part"))
    bands = bands.select("id", "doc_id", F.xxhash64("band", "part").alias("bucket"))
    # the pivot is the text of the least doc_id, which in a collection that grows is the oldest version
    ends = bands.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("low"), F.count("*").alias("many")).where("many > 1")
    ends = materialise(ends.select("bucket", F.col("low.id").alias("low")), "ends")
    buckets = materialise(bands.select("id", "bucket").join(ends, "bucket"), "buckets")
    release(ends)
    # only texts in some bucket go on, a small part of all, so they are gathered in fewer files than they come from
    wanted = materialise(reps.join(buckets.select("id").distinct(), "id", "left_semi").select("id", F.col("doc_id").alias("of"), "text_key").hint("rebalance"), "wanted")
    # by id first, a column that is small to send; the few rows left are then told apart by their texts
    named = docs.join(wanted.select("of").distinct(), docs["doc_id"].eqNullSafe(F.col("of")), "left_semi")
    keyed = named.withColumn("text_key", text_key(F.col("text")))
    texts = keyed.join(wanted, (keyed["text_key"] == wanted["text_key"]) & keyed["doc_id"].eqNullSafe(wanted["of"])).select("id", "text")
    again = member.where(F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("row") != F.col("node")))
    repeated = not again.isEmpty()
    if repeated:  # rows of the same id and text: one of them is enough
        texts = texts.dropDuplicates(["id"])
    texts = materialise(texts.hint("rebalance"), "texts")
    # signatures may be off by five standard deviations
    least = similarity - 5 * math.sqrt(similarity * (1 - similarity) / registers)
    sig_a, sig_b = (reps.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = materialise(pairs.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct(), "pairs")
        close = _agree(pairs.join(sig_b, "b").join(sig_a, "a"), least, registers)
        found = materialise(verify(close, texts, shingle, similarity, weighted), "found")
        release(pairs)
        return found

    def components(links: DataFrame) -> DataFrame:
        return materialise(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "part")

    links = checked(buckets.where("id <> low").select("id", F.col("low").alias("pivot")))
    part = components(links)
    more = checked(_leftovers(buckets, part, reps, texts, shingle, similarity, registers, weighted))
    release(texts, buckets, reps, wanted)
    if not more.isEmpty():
        links = links.union(more).distinct()
        part = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    of = part.join(first.select("node", "rep_id"), "node")
    # a class bears the least doc_id of its texts, and its first row is that text's
    head = of.groupBy("component").agg(F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "node")).alias("h"))
    found = part.join(head, "component").join(degree, "node", "left").select("node", F.col("h.node").alias("head"), F.col("h.rep_id").alias("class_id"), "n_links")
    joined = member.join(materialise(found, "classes"), "node", "left")
    joined = joined.select("doc_id", "text_key", "row", F.coalesce("head", "node").alias("head"), "node", F.when(F.col("head").isNull(), F.col("rep_id")).otherwise(F.col("class_id")).alias("class_id"), "n_links")
    same = (F.col("node") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    place = F.when(F.col("row") == F.col("head"), "first").when(same, "repeat").otherwise("other")
    return joined.select("doc_id", "text_key", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), place.alias("place"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, registers: int = REGISTERS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """(doc_id, class_id, n_links) for every row of ``docs`` (doc_id, text).

    A class is a connected component of texts that are equal or similar; it bears its
    least doc_id.  n_links counts the verified links of a text's row in the search, equal
    texts apart.  A null text counts as empty; texts without words are alike only if equal.
    Rows with the same doc_id are documents like any others, each in the class of its text.
    ``weighted`` takes probability Jaccard similarity of how often shingles occur.
    Texts are compared whole, however long.  A row without doc_id has the class of its text,
    null if no document of that class has a doc_id.
    Nothing in ``docs`` but doc_id and text is read.
    """
    return classes(docs, shingle, similarity, registers, rows, weighted).select("doc_id", "class_id", "n_links")


def thinned(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """``docs`` with one row of each class of near duplicates, all columns as they are.

    The row with the least doc_id stays, and one of its repeats.  Rows are told apart by
    doc_id and text together, so of a doc_id that stands for several texts only those go whose
    own class has another row.  A row without doc_id can't be named and stays.
    """
    found = materialise(classes(docs, weighted=weighted).select(F.col("doc_id").alias("of"), "text_key", "place").where("place <> 'first'").hint("rebalance"), "places")
    kept = without(docs, found.where("place = 'other'").select("of", "text_key").distinct())
    often = materialise(found.where("place = 'repeat'").select("of", "text_key").distinct(), "repeated")
    if often.isEmpty():
        return kept
    name = unused("__key", docs.columns)
    keyed = kept.withColumn(name, text_key(F.col("text")))
    same = (keyed[name] == often["text_key"]) & (keyed["doc_id"] == often["of"])
    columns = quoted(docs.columns)
    once = keyed.join(often, same, "left_semi").dropDuplicates(["doc_id", name])
    return keyed.join(often, same, "left_anti").select(columns).union(once.select(columns))
