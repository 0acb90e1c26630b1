"""MinHash near-duplicate detection (dealt operator 8).

1. *Signatures* (one map-only pass): the set of 5-word shingles of each document, 128 minima of
   universal hashes ``a*x + b``, 32 bands of 4 rows (a pair of similarity 0.75 shares no band with
   probability ``(1 - 0.75^4)^32`` = 5e-6), 8 bits of each minimum for signature verification.
2. *Classes*: documents with equal shingle sets collapse to their least doc_id by one
   pre-aggregated group-by; copies need no links of their own.
3. *Stars*: in every band bucket the members are compared with the bucket's least member, not with
   each other. Candidates pass the signature check and are confirmed on their full shingle sets.
4. *Components* by large-star / small-star.
5. *The rest, exactly*: a bucket whose members then lie in more than one component is compared
   across components, in blocks of bounded size (signatures first, then full sets), so no link
   that a bucket holds is lost and no bucket's pairs are written out.

Defined cases: NULL, empty and blank texts have an empty set (n_shingles 0) and link with nothing;
fewer words than five are one shingle; rows that repeat a doc_id share its node; a NULL doc_id
links with nothing (component_id NULL, kept true); empty tables give empty results; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import (NON_SPACE, hash_words, list_column, mix, regrouped, segment_sum, shingles,
                                      signed, sort_unique)
from pagewright.llm.components import connected_components
from pagewright.session import materialize

SHINGLE = 5
HASHES, BANDS = 128, 32
PERCENT = 75
#: matching 8-bit minima that a pair must show: 4.9 standard deviations below the mean at 0.75
MIN_AGREE = 72
BLOCK_ROWS = 512
#: bytes of text that a worker holds at once, and of the blocks it hashes: several workers share an
#: executor's memory with its JVM
GROUP_BYTES = 1 << 20
HASH_BYTES = 256 << 10

_U = np.uint64
_rng = np.random.RandomState(20240607)
_A = (_rng.randint(0, 1 << 62, HASHES).astype(_U) << _U(1)) | _U(1)
_B = _rng.randint(0, 1 << 62, HASHES).astype(_U)


def shingle_sets(col) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return sort_unique(*shingles(hash_words(col, NON_SPACE, block=HASH_BYTES), SHINGLE))


def minima(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """``(texts, HASHES)`` minima of universal hashes over each (non-empty) segment."""
    n = len(off) - 1
    out = np.zeros((n, HASHES), np.uint32)
    x = sets >> _U(32)
    a = 0
    while a < n:  # as many texts as fit into the cache
        b = max(a + 1, int(np.searchsorted(off, off[a] + 32_768, side="right")) - 1)
        part, begin = x[off[a]:off[b]], off[a:b] - off[a]
        buf = np.empty_like(part)
        for i in range(HASHES):
            np.multiply(part, _A[i], out=buf)
            buf += _B[i]
            out[a:b, i] = np.minimum.reduceat(buf, begin) >> _U(32)
        a = b
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = HASHES // BANDS
    s = sig.reshape(len(sig), BANDS, rows).astype(_U)
    key = np.tile(np.arange(1, BANDS + 1, dtype=_U), (len(sig), 1))
    for r in range(rows):
        key = key * _U(0x9E3779B97F4A7C15) + s[:, :, r]
    return mix(key.ravel())


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, h1, h2, bands, sig`` per row (h1, h2: order-free hash of the set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, GROUP_BYTES):
            sets, off = shingle_sets(t.column("text"))
            size = np.diff(off)
            some = np.flatnonzero(size)
            off_some = np.concatenate([off[:-1][some], off[-1:]])
            sig = minima(sets, off_some)
            n_bands = np.zeros(len(size), np.int64)
            n_bands[some] = BANDS
            packed = np.zeros((len(size), HASHES), np.uint8)
            packed[some] = sig.astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                t.column("doc_id").combine_chunks(), pa.array(size),
                pa.array(signed(segment_sum(mix(sets ^ _U(0x5BD1E995)), off))), pa.array(signed(segment_sum(mix(sets ^ _U(0xC2B2AE35)), off))),
                list_column(signed(band_keys(sig)), np.concatenate([[0], np.cumsum(n_bands)])),
                pa.Array.from_buffers(pa.binary(HASHES), len(packed), [None, pa.py_buffer(packed)]).cast(pa.binary())],
                names=["doc_id", "n_shingles", "h1", "h2", "bands", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, sig binary")


def _similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(p) + len(q) - both)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(u, v)`` whose full shingle sets are similar enough."""
    a = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    b = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, GROUP_BYTES):
            x, xo = shingle_sets(t.column("text_u"))
            y, yo = shingle_sets(t.column("text_v"))
            keep = np.zeros(t.num_rows, dtype=bool)
            for i in range(t.num_rows):
                keep[i] = _similar(x[xo[i]:xo[i + 1]], y[yo[i]:yo[i + 1]], percent)
            t = t.select(["u", "v"]).filter(pa.array(keep))
            yield from t.combine_chunks().to_batches()

    return pairs.select("u", "v").join(a, "u").join(b, "v").select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1)


def likely(pairs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Candidate pairs that set sizes and signatures allow."""
    r = reps.select("doc_id", "n_shingles", "sig")
    p = (pairs.join(r.select(F.col("doc_id").alias("u"), F.col("n_shingles").alias("nu"), F.col("sig").alias("su")), "u")
         .join(r.select(F.col("doc_id").alias("v"), F.col("n_shingles").alias("nv"), F.col("sig").alias("sv")), "v")
         .where(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            u = np.frombuffer(b"".join(b.column("su").to_pylist()), np.uint8).reshape(b.num_rows, HASHES)
            v = np.frombuffer(b"".join(b.column("sv").to_pylist()), np.uint8).reshape(b.num_rows, HASHES)
            yield b.select(["u", "v"]).filter(pa.array(_agree(u, v) >= MIN_AGREE))

    return p.select("u", "v", "su", "sv").mapInArrow(run, "u long, v long")


def across(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``(u, v)`` between different components of a bucket, found block by block.

    ``members``: ``key, doc_id, component, n_shingles, sig, text``. A bucket of n members is cut
    into ceil(n / BLOCK_ROWS) blocks; a task holds two of them, compares signatures, confirms on
    the full sets, and passes over pairs that its own links have joined already. Only links leave
    the task, so at most one per member.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("g"))
    m = members.join(sizes, "key").withColumn("i", F.pmod(F.xxhash64("doc_id"), F.col("g")).cast("int"))
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    m = m.select("key", F.least("i", "o").alias("x"), F.greatest("i", "o").alias("y"), "i",
                 "doc_id", "component", "n_shingles", "sig", "text")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, n, block = (pdf[c].to_numpy() for c in ("doc_id", "n_shingles", "i"))
        label = np.unique(pdf["component"].to_numpy(), return_inverse=True)[1]
        one_block = pdf["x"].iat[0] == pdf["y"].iat[0]
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), HASHES)
        sets, off = shingle_sets(pa.array(pdf["text"], pa.string()))
        links = []
        for k in range(len(pdf) - 1):
            fit = (label[k + 1:] != label[k]) & (100 * np.minimum(n[k + 1:], n[k]) >= percent * np.maximum(n[k + 1:], n[k]))
            if not one_block:
                fit &= block[k + 1:] != block[k]
            rest = np.flatnonzero(fit) + k + 1
            same = _agree(sig[rest], sig[k])
            for j in rest[np.argsort(-same, kind="stable")][:int((same >= MIN_AGREE).sum())].tolist():
                if label[j] != label[k] and _similar(sets[off[k]:off[k + 1]], sets[off[j]:off[j + 1]], percent):
                    links.append((min(ids[k], ids[j]), max(ids[k], ids[j])))
                    label[label == label[j]] = label[k]
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return m.groupBy("key", "x", "y").applyInPandas(compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    sigs = materialize(signatures(docs), "signatures")
    real = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = materialize(real.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "bands", "sig")).alias("m"))
                       .select("h1", "h2", "n_shingles", "m.*"), "classes")
    rows = reps.select(F.explode("bands").alias("key"), "doc_id")
    # a doc_id that repeats with other texts stands for several classes: they share its node
    least = rows.groupBy("key").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("other")).where("u <> other").select("key", "u")
    stars = materialize(rows.join(least, "key").where("doc_id <> u").select("key", "u", F.col("doc_id").alias("v")).distinct(), "stars")
    candidates = materialize(likely(stars.select("u", "v").distinct(), reps, percent).distinct(), "candidates")
    involved = stars.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    texts = materialize(docs.select("doc_id", "text").join(involved, "doc_id", "left_semi"), "texts")
    links = materialize(confirm(candidates, texts, percent), "links")
    comp = materialize(connected_components(links), "components")

    def component(df: DataFrame, col: str, out: str) -> DataFrame:
        c = comp.select(F.col("node").alias(col), F.col("component").alias("_c"))
        return df.join(c, col, "left").withColumn(out, F.coalesce("_c", col)).drop("_c")

    open_keys = component(component(stars, "u", "cu"), "v", "cv").where("cu <> cv").select("key").distinct()
    rest = stars.join(open_keys, "key", "left_semi")
    rest = materialize(rest.select("key", F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "open")
    if not rest.isEmpty():
        members = (component(rest, "doc_id", "component").join(reps.select("doc_id", "n_shingles", "sig"), "doc_id")
                   .join(texts, "doc_id"))
        links = links.union(materialize(across(members, percent), "links"))
        comp = materialize(connected_components(links), "components")
    return _labelled(sigs, reps, comp)


def _labelled(sigs: DataFrame, reps: DataFrame, comp: DataFrame) -> DataFrame:
    named = (reps.select("h1", "h2", "n_shingles", F.col("doc_id").alias("node")).join(comp, "node", "left")
             .select("h1", "h2", "n_shingles", F.coalesce("component", "node").alias("c")))
    out = sigs.select("doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2", "n_shingles"], "left")
    comp_id = F.when(F.col("n_shingles") > 0, F.coalesce("c", "doc_id")).otherwise(F.col("doc_id"))
    comp_id = F.when(F.col("doc_id").isNotNull(), comp_id)
    return out.select("doc_id", "n_shingles", comp_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp_id, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that stay: one (the least doc_id) of each group, all columns kept."""
    gone = near_duplicates(docs, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
