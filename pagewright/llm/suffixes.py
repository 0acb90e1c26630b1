"""Repeated passages by a sparse suffix array (dealt operator 10).

A passage is ``LENGTH`` words or more (non-space runs, ASCII lower-cased). Of all suffixes of the
corpus only those are retained that start at a *minimiser*: in each stretch of ``LENGTH`` words the
``SEED``-word gram of least hash. Equal passages retain the same suffixes, so no repeated passage
is without one; about 2 in 36 positions are kept. Every retained suffix carries its *reach*, the
words of all stretches that chose it.

1. one map-only pass emits the retained suffixes: hash of the seed (the sort key), hash of the
   whole reach, place;
2. suffixes of equal reach are classes: later members repeat the class's first one throughout
   (pre-aggregated; copies meet here, whatever their number);
3. the classes are range-partitioned and sorted by seed, and neighbours are compared: a class
   whose seed has no equal neighbour holds no further repeat;
4. the others are extended left and right over their reach: each stretch in it is compared by its
   hash with the first equal stretch of the corpus. (Comparing with the sorted neighbour alone
   would lose matches that agree with a third suffix to the left.)

What comes out is exactly: word positions of a document that lie in a stretch of ``LENGTH`` words
which an earlier document (by doc_id) holds, too.

Defined cases: NULL, empty and shorter texts have no passages; repeated rows of a doc_id add
nothing; rows without doc_id are left out; repeats within one document alone are no cross-document
repeats (``within=True`` counts them); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import NON_SPACE, hash_words, mix, ngrams, regrouped, signed
from pagewright.session import materialize

LENGTH, SEED = 50, 16

_U = np.uint64
_R = 0xA24BAED4963EE407
_R_INV = pow(_R, -1, 1 << 64)
_LOW = _U((1 << 24) - 1)


class Rolling:
    """Hashes of any range of a word-hash array from one prefix sum (modulo 2^64)."""

    def __init__(self, words: np.ndarray):
        p = np.full(len(words) + 1, _R, _U)
        q = np.full(len(words) + 1, _R_INV, _U)
        p[0] = q[0] = 1
        np.cumprod(p, out=p)
        self.inverse = np.cumprod(q, dtype=_U)
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(words * p[:-1], dtype=_U)])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.inverse[a])


def retained(words: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(doc, lo, hi, at)``: each minimiser place ``at`` and the stretch starts lo..hi choosing it."""
    n = len(words)
    e = np.zeros(0, np.int64)
    if n < LENGTH:
        return e, e, e, e
    g = ngrams(words, SEED)
    # least (hash, rightmost place) of LENGTH - SEED + 1 neighbours, by doubling
    v = (g & ~_LOW) | (_LOW - (np.arange(len(g), dtype=_U) & _LOW))
    width, want = 1, LENGTH - SEED + 1
    while 2 * width <= want:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    rest = want - width
    if rest:
        v = np.minimum(v[:-rest], v[rest:])
    s = np.arange(len(v))
    at = s + ((_LOW - (v & _LOW)).astype(np.int64) - s) % (1 << 24)
    doc = np.searchsorted(off, s, side="right") - 1
    ok = np.flatnonzero(s + LENGTH <= off[doc + 1])
    if not len(ok):
        return e, e, e, e
    s, at, doc = s[ok], at[ok], doc[ok]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(s)]]) - 1
    return doc[first], s[first], s[last], at[first]


def suffix_rows(docs: DataFrame) -> DataFrame:
    """``seed, reach, doc_id, lo, n`` of every retained suffix (n stretches from word lo on)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches):
            w = hash_words(t.column("text"), NON_SPACE)
            doc, lo, hi, at = retained(w.hashes, w.offsets)
            if not len(doc):
                continue
            roll = Rolling(w.hashes)
            reach = roll(lo, hi + LENGTH) ^ mix(((at - lo) * 64 + (hi - lo)).astype(_U))
            ids = t.column("doc_id").to_numpy()[doc]
            yield pa.RecordBatch.from_arrays([
                pa.array(signed(roll(at, at + SEED))), pa.array(signed(reach)), pa.array(ids),
                pa.array((lo - w.offsets[doc]).astype(np.int32)), pa.array((hi - lo + 1).astype(np.int32))],
                names=["seed", "reach", "doc_id", "lo", "n"])

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "seed long, reach long, doc_id long, lo int, n int")


def with_equal_neighbour(classes: DataFrame) -> DataFrame:
    """Sorted classes whose seed equals a neighbour's; the ends of a partition count as equal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far
        open_ = True
        for b in batches:
            if not b.num_rows:
                continue
            seed = b.column("seed").to_numpy()
            same = seed[1:] == seed[:-1]
            keep = np.zeros(len(seed), dtype=bool)
            keep[1:] |= same
            keep[:-1] |= same
            if held is None:
                keep[0] = True
            else:
                equal = held.column("seed")[0].as_py() == seed[0]
                keep[0] |= equal
                if equal or open_:
                    yield held
            head = b.slice(0, len(seed) - 1).filter(pa.array(keep[:-1]))
            if head.num_rows:
                yield head
            held, open_ = b.slice(len(seed) - 1, 1), bool(keep[-1])
        if held is not None:
            yield held

    ordered = classes.repartitionByRange("seed", "reach").sortWithinPartitions("seed", "reach")
    return ordered.mapInArrow(run, ordered.schema)


def stretches(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``h, doc_id, s`` of the stretches that start in the given places (``doc_id, lo, n``)."""
    per = places.groupBy("doc_id").agg(F.collect_set(F.struct("lo", "n")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches):
            w = hash_words(t.column("text"), NON_SPACE)
            roll = Rolling(w.hashes)
            ids = t.column("doc_id").to_numpy()
            hs, ds, ss = [], [], []
            for i, at in enumerate(t.column("at").to_pylist()):
                s = np.unique(np.concatenate([np.arange(p["lo"], p["lo"] + p["n"]) for p in at]))
                g = s + w.offsets[i]
                hs.append(roll(g, g + LENGTH))
                ds.append(np.full(len(s), ids[i]))
                ss.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(hs))), pa.array(np.concatenate(ds)),
                                              pa.array(np.concatenate(ss).astype(np.int32))], names=["h", "doc_id", "s"])

    one = docs.select("doc_id", "text").join(per, "doc_id")
    return one.mapInArrow(run, "h long, doc_id long, s int")


def covered(docs: DataFrame, within: bool = False) -> DataFrame:
    """``doc_id, a, b, first_doc_id``: word ranges that an earlier place holds, too."""
    rows = materialize(suffix_rows(docs), "suffixes")
    classes = rows.groupBy("seed", "reach").agg(F.min(F.struct("doc_id", "lo", "n")).alias("r"), F.count(F.lit(1)).alias("size"))
    classes = materialize(classes, "classes")
    shared = classes.where("size > 1").select("seed", "reach", F.col("r.doc_id").alias("first"), F.col("r.lo").alias("first_lo"))
    members = materialize(rows.join(shared, ["seed", "reach"]), "members")
    earlier = "first < doc_id" + (" OR (first = doc_id AND first_lo < lo)" if within else "")
    copies = members.where(earlier).select("doc_id", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + LENGTH - 1).alias("b"),
                                           F.col("first").alias("first_doc_id"))
    lone = with_equal_neighbour(classes.select("seed", "reach", "r.doc_id", "r.lo", "r.n")).select("doc_id", "lo", "n")
    own = members.where("first = doc_id AND lo <> first_lo").select("doc_id", "lo", "n")
    found = materialize(stretches(docs, materialize(lone.unionByName(own), "places")), "stretches")
    first = found.groupBy("h").agg(F.min(F.struct("doc_id", "s")).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1")
    later = found.join(first.select("h", F.col("f.doc_id").alias("first"), F.col("f.s").alias("first_lo")), "h")
    later = later.withColumnRenamed("s", "lo").where(earlier)
    return copies.unionByName(later.select("doc_id", F.col("lo").alias("a"), (F.col("lo") + LENGTH).alias("b"),
                                           F.col("first").alias("first_doc_id")))


def repeats(docs: DataFrame, within: bool = False) -> DataFrame:
    """One row per document with repeated passages.

    ``doc_id, n_repeated`` (words), ``spans`` (start, stop, start, stop ... in words),
    ``first_doc_ids`` (sorted documents that hold the passages first).
    """
    c = materialize(covered(docs, within), "covered")
    per = c.groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("ab"), F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            spans, total = [], []
            for ab in t.column("ab").to_pylist():
                out: list[int] = []
                for a, b in sorted((x["a"], x["b"]) for x in ab):
                    if out and a <= out[-1]:
                        out[-1] = max(out[-1], b)
                    else:
                        out += [a, b]
                spans.append(out)
                total.append(sum(out[1::2]) - sum(out[::2]))
            yield pa.RecordBatch.from_arrays([t.column("doc_id"), pa.array(total, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                                              t.column("first_doc_ids")], names=["doc_id", "n_repeated", "spans", "first_doc_ids"])

    return per.mapInArrow(run, "doc_id long, n_repeated long, spans array<long>, first_doc_ids array<long>")
