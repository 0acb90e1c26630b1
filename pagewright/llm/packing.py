"""Best-fit decreasing packing of tokenised documents (dealt operator 5).

Method. Every piece length is between 1 and ``capacity``, and pieces of one length are
interchangeable, as are open bins of one remaining capacity. Best-fit decreasing over the whole
corpus is therefore settled by the *histogram* of lengths (at most ``capacity`` entries): the
lengths are taken in decreasing order, and a segment tree over the remaining capacities finds the
tightest open bin in O(log capacity). A run of equal pieces is placed at once: once a bin of
remaining room ``r`` is the tightest for length ``l``, it stays the tightest until it holds
``r // l`` of them. The result is the same packing as placing one document after the other.

What Spark does: tokenising and cutting (one map-only pass), the rank of each piece among those
of its length (per-chunk ranks plus summed offsets, no global sort), and the lookup of each
piece's place. The driver sees the histogram and returns the placement runs, both bounded by
``capacity`` alone, not by the corpus.

Defined cases: NULL and empty texts are the single id 0; a document of more than ``capacity`` ids
is cut into full pieces behind a first one that may be shorter; repeated rows are packed as often
as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.llm.arrowtext import text_buffers
from pagewright.session import materialize

CAPACITY = 2048
END_ID = 0
# The vocabulary's special token, which a text may spell out, and its id.
MARKER, MARKER_ID = "<|endoftext|>", 50256


class CapacityTree:
    """Segment tree over capacities 0..n: how many open bins have that much room left."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, r: int, present: bool) -> None:
        i = r + self.size
        self.any[i] = present
        i //= 2
        while i:
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]
            i //= 2

    def tightest(self, need: int) -> int | None:
        """Smallest room >= ``need`` that some open bin has."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Returns runs ``(length, first_rank, n, first_bin, per_bin, offset)``: the pieces of ``length``
    with ranks ``first_rank .. first_rank + n - 1`` go, ``per_bin`` to a bin, into consecutive bins
    from ``first_bin``, from ``offset`` on.
    """
    tree = CapacityTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}
    runs, bins = [], 0

    def give(room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            open_.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, bins
                per = room // length
                n = -(-left // per)
                bins += n
            else:
                first, n = open_[room].pop()
                if not open_[room]:
                    tree.set(room, False)
                per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, full * per, first, per, capacity - room))
                rank, left = rank + full * per, left - full * per
                give(room - per * length, first, full)
                first, n = first + full, n - full
            if n and left:  # fewer than a bin takes
                runs.append((length, rank, left, first, per, capacity - room))
                give(room - left * length, first, 1)
                rank, first, n, left = rank + left, first + 1, n - 1, 0
            give(room, first, n)
    return runs


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids; only the first may be short."""
    k = -(-n // capacity)
    head = n - (k - 1) * capacity
    return [(0, head)] + [(head + i * capacity, capacity) for i in range(k - 1)]


def _tokenizer(ranks_path: str, pattern: str):
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("pagewright", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokenized_pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, with its rank among the equally long pieces of its chunk (map-only).

    ``vocabulary`` names a public vocabulary file present on every executor.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, chunk long, rank long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        enc = _tokenizer(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
        seen = np.zeros(capacity + 1, np.int64)
        ctx = TaskContext.get()
        chunk = ctx.partitionId() if ctx else 0
        for b in batches:
            raw, off = text_buffers(b.column("text"))
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "chunk", "rank")}
            for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
                text = raw[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace")
                ids = []
                for k, part in enumerate(text.split(MARKER)):
                    if k:
                        ids.append(MARKER_ID)
                    ids += enc.encode_ordinary(part)
                ids.append(END_ID)
                ids = np.array(ids, dtype="<u4")
                for p, (s, n) in enumerate(cut(len(ids), capacity)):
                    for c, v in zip(out, (doc_id, p, s, n, zlib.crc32(ids[s:s + n].tobytes()), chunk, int(seen[n])), strict=True):
                        out[c].append(v)
                    seen[n] += 1
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [(c, pa.int32() if c == "piece" else pa.int64()) for c in out]))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Pack all documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    pieces = materialize(tokenized_pieces(docs, vocabulary, capacity), "pieces")
    # rows per (chunk, length): at most `capacity` per chunk
    counts = pieces.groupBy("chunk", "length").agg((F.max("rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "bases")
    # bounded by the capacity: one entry per length
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_runs(histogram, capacity)
    # runs by (length, first rank): keys ascend within a length; the table depends on the capacity only
    runs.sort()
    table = spark.sparkContext.broadcast(tuple(np.array([r[k] for r in runs], dtype=np.int64) for k in range(6)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, _, first_bin, per, offset = table.value
        lo = np.searchsorted(length, np.arange(capacity + 2))
        for b in batches:
            n = b.column("length").to_numpy()
            k = b.column("rank").to_numpy() + b.column("base").to_numpy()
            at = np.empty(len(n), np.int64)
            for v in np.unique(n):
                here = n == v
                at[here] = lo[v] + np.searchsorted(first_rank[lo[v]:lo[v + 1]], k[here], side="right") - 1
            q = k - first_rank[at]
            seq = first_bin[at] + q // per[at]
            place_ = offset[at] + (q % per[at]) * n
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(place_)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    joined = pieces.join(bases.select("chunk", "length", "base"), ["chunk", "length"])
    return joined.select("doc_id", "piece", "start", "length", "ids_crc32", "rank", "base").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
