"""Benchmark decontamination by Wu-Manber multi-pattern search over words (dealt operator 7).

Patterns are windows of ``window`` consecutive words of the benchmark items (an item of fewer
words is one window). Symbols are words. For patterns of one length m, blocks of B words are
hashed: the *shift table* tells for each block how far the search window may jump, because no
pattern holds that block nearer to its end; a jump of 0 leads to the bucket of patterns with that
*suffix* block, and the words of the pattern are then compared one by one.

All positions that are due in a batch of documents are advanced together (numpy): a cursor per
stretch of text, each jumping by its own shifts. Shorter items are searched per length with the
same routine. Benchmark items are taken in blocks of ``block_items`` rows, one after the other: a
block's tables are built, broadcast (bounded by that parameter and by ``ITEM_WORDS``), searched in
all documents and released when its hits are written to the shared folder. The hits of all blocks
are merged by row, so the benchmark may be of any size.

Defined cases: NULL texts have no words; items without words are skipped; repeated items each
count; a document word inside any occurrence counts once; empty tables give no hits; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import ALNUM, hash_words, mix, regrouped
from pagewright.llm.names import free_names
from pagewright.session import materialize

WINDOW = 10
BLOCK = 2
STRETCH = 256
TABLE_BITS = 18
#: items to a broadcast block; an item longer than ITEM_WORDS words is cut into overlapping parts
BLOCK_ITEMS = 20_000
ITEM_WORDS = 2_000
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class WuManber:
    """Search tables for patterns (rows of word hashes) of one length ``m``."""

    def __init__(self, patterns: np.ndarray, owners: list[np.ndarray], bits: int = TABLE_BITS):
        self.patterns, self.owners = patterns, owners
        self.m = patterns.shape[1]
        self.b = min(BLOCK, self.m)
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, self.m - self.b + 1, dtype=np.int32)
        for end in range(self.b, self.m + 1):  # nearer to the end overwrites
            self.shift[self.block(patterns[:, end - self.b:end])] = self.m - end
        last = self.block(patterns[:, self.m - self.b:])
        self.order = np.argsort(last, kind="stable")
        self.first = np.searchsorted(last[self.order], np.arange((1 << bits) + 1))

    def block(self, words: np.ndarray) -> np.ndarray:
        h = words[:, 0].copy()
        for j in range(1, words.shape[1]):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[:, j]
        return (mix(h) & self.mask).astype(np.int64)

    def search(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, pattern)`` of all occurrences inside the segments ``begin:end`` of ``text``."""
        n = end - begin
        pieces = np.where(n >= self.m, -(-(n - self.m + 1) // STRETCH), 0)
        seg = np.repeat(np.arange(len(n)), pieces)
        k = np.arange(len(seg)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cur = begin[seg] + k * STRETCH + self.m - 1  # last word of the search window
        stop = np.minimum(begin[seg] + (k + 1) * STRETCH + self.m - 1, end[seg])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(cur):
            ends = text[cur[:, None] + np.arange(1 - self.b, 1)]
            blk = self.block(ends)
            jump = self.shift[blk]
            zero = np.flatnonzero(jump == 0)
            if len(zero):
                lo, hi = self.first[blk[zero]], self.first[blk[zero] + 1]
                at = np.repeat(cur[zero], hi - lo)
                idx = np.arange(len(at)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
                pat = self.order[idx]
                for j in range(self.m):  # direct comparison, word by word
                    ok = text[at - (self.m - 1) + j] == self.patterns[pat, j]
                    at, pat = at[ok], pat[ok]
                if len(at):
                    found.append((at - (self.m - 1), pat))
                jump = np.maximum(jump, 1)
            cur = cur + jump
            live = cur < stop
            cur, stop = cur[live], stop[live]
        if not found:
            e = np.zeros(0, np.int64)
            return e, e
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def windows_of(items: list[tuple[int, str]], window: int = WINDOW) -> list[WuManber]:
    """Search tables, one per pattern length, for ``(item_id, text)`` rows."""
    words = hash_words(pa.array([t for _, t in items], pa.string()), ALNUM)
    by: dict[int, dict[bytes, set[int]]] = {}
    for (item, _), a, b in zip(items, words.offsets[:-1], words.offsets[1:], strict=True):
        h = words.hashes[a:b]
        m = min(window, len(h))
        for s in range(len(h) - m + 1 if m else 0):
            by.setdefault(m, {}).setdefault(h[s:s + m].tobytes(), set()).add(item)
    return [WuManber(np.frombuffer(b"".join(p), np.uint64).reshape(len(p), m), [np.array(sorted(x)) for x in p.values()])
            for m, p in sorted(by.items())]


def item_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in blocks of bounded size, long items cut with overlap."""
    parts = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORDS), F.lit(0))
    step = ITEM_WORDS - WINDOW + 1
    rows = (benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", parts.alias("w")).where(F.size("w") > 0)
            .select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)), F.lit(step))).alias("at"))
            .select("item_id", F.array_join(F.slice("w", F.col("at") + 1, ITEM_WORDS), " ").alias("text")))
    rows = materialize(rows, "items")
    n_blocks = max(1, -(-rows.count() // block_items))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for k in range(n_blocks):
        got = [(r["item_id"], r["text"]) for r in rows.where(part == k).collect()]
        if got:
            yield got


def keyed(docs: DataFrame, k: str = "_k", k2: str = "_k2") -> DataFrame:
    """``docs`` with ``k`` and ``k2``: equal for rows of equal doc_id and text only (but for hash collisions)."""
    return docs.withColumn(k, F.xxhash64("doc_id", "text")).withColumn(k2, F.hash("doc_id", "text"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``_k, _k2, items, hits`` (hit word positions) of the rows of ``keyed(docs)`` with a hit.

    One search per item block, its hits written before the next block is built; hits are merged by row.
    """
    spark = docs.sparkSession
    schema = "_k long, _k2 int, items array<long>, spans array<struct<a:long,b:long>>"
    hits = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, block_items):
        shared = spark.sparkContext.broadcast(windows_of(block, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for t in regrouped(batches):
                w = hash_words(t.column("text"), ALNUM)
                begin, end = w.offsets[:-1], w.offsets[1:]
                delta = np.zeros(len(w.hashes) + 1, np.int32)
                items: dict[int, set[int]] = {}
                for table in shared.value:
                    at, pat = table.search(w.hashes, begin, end)
                    if not len(at):
                        continue
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + table.m, -1)
                    doc = np.searchsorted(begin, at, side="right") - 1
                    for d, p in set(zip(doc.tolist(), pat.tolist(), strict=True)):
                        items.setdefault(d, set()).update(table.owners[p].tolist())
                hit = np.cumsum(delta[:-1]) > 0
                rows = sorted(items)
                spans = []
                for d in rows:  # [a, b) word ranges
                    x = np.diff(np.concatenate([[0], hit[begin[d]:end[d]].astype(np.int8), [0]]))
                    spans.append([{"a": i, "b": j} for i, j in zip(np.flatnonzero(x == 1).tolist(), np.flatnonzero(x == -1).tolist(), strict=True)])
                keys = t.select(["_k", "_k2"]).take(pa.array(rows, pa.int64())).combine_chunks()
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.column("_k").to_pylist(), pa.int64()), pa.array(keys.column("_k2").to_pylist(), pa.int32()),
                    pa.array([sorted(items[d]) for d in rows], pa.list_(pa.int64())),
                    pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["_k", "_k2", "items", "spans"])

        found = keyed(docs.select("doc_id", "text")).select("_k", "_k2", "text").mapInArrow(run, schema)
        hits = hits.unionByName(materialize(found, "block-hits"))
        shared.destroy()
    places = F.flatten(F.transform("spans", lambda x: F.sequence(x["a"], x["b"] - 1)))
    return hits.groupBy("_k", "_k2").agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
                                         F.array_distinct(F.flatten(F.collect_set(places))).alias("hits"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    hits = find_hits(docs, benchmark, window, block_items).select(
        "_k", "_k2", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("sha"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches):
            n = np.diff(hash_words(t.column("text"), ALNUM).offsets)
            yield from t.drop_columns("text").append_column("n_words", pa.array(n, pa.int64())).combine_chunks().to_batches()

    rows = keyed(docs.select("doc_id", "text")).select("doc_id", "_k", "_k2", "text").mapInArrow(count, "doc_id long, _k long, _k2 int, n_words long")
    return rows.join(hits, ["_k", "_k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("sha", F.lit(empty_digest())).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def empty_digest() -> str:
    return hashlib.sha256(b"").hexdigest()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents without any occurrence of a benchmark window, all columns kept.

    Rows are kept or dropped by their own text, so repeated and NULL ids stay right.
    """
    k, k2 = free_names(docs, "_k", "_k2")
    hits = find_hits(docs, benchmark, window, block_items).select(F.col("_k").alias(k), F.col("_k2").alias(k2))
    return keyed(docs, k, k2).join(hits, [k, k2], "left_anti").select(*[f"`{c}`" for c in docs.columns])
