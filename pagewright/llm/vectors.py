"""Embedding near-duplicates by cross-polytope hashing (dealt operator 9).

A vector is turned by three rounds of random signs and a fast Walsh-Hadamard transform; its hash is
the axis of largest absolute value, with its sign. ``TABLES`` tables are kept, each of two turns: the
first names the *cell* a vector is sent to, the second its bucket inside the cell. *Multiprobe*:
besides its own bucket a vector visits those of its runner-up axes, ``VISITS`` in all; since they lie
in the same cell, a probe costs no copy of the vector in the shuffle. Candidates that meet in a
bucket are verified by their cosine in double precision.

Vectors equal in label and components are one class; only its least vec_id is hashed, copies count
by the class's multiplicity. The classes of two and more are found from narrow rows of hashes and
broadcast up to ``BROADCAST_CLASSES`` rows (a shuffle join beyond), so vectors need no shuffle for
it; likewise the table of cells. A cell of more than ``CELL_ROWS`` rows is dealt by bucket,
and a bucket of more is cut into blocks whose pairs are compared by a task each (the same candidates,
so the layout changes no result). A pair that meets in several buckets counts in the first one only
(found from the two codes), so tasks return one count per vector and edges of the components, not
the pairs.

Defined cases: NULL labels, NULL or zero vectors, NULL, NaN or infinite components link with nothing
(n_links 0, own component); vectors of different lengths are compared only with their equals;
repeated rows of a vec_id count as vectors of
their own (with other components they share their links); a NULL vec_id has component NULL and
stays; labels may have any type; components of any finite magnitude are compared (each vector is
scaled by a power of two first); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import regrouped
from pagewright.llm.components import connected_components
from pagewright.session import materialize

THRESHOLD = 0.93
TABLES, VISITS = 4, 4
CELL_ROWS, TILE = 65_536, 2_048
BROADCAST_CLASSES = 500_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), orthonormal."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def turned(x: np.ndarray, turn: int) -> np.ndarray:
    rng = np.random.RandomState(7919 * turn + 13)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], size=x.shape[1]))
    return x


def codes(x: np.ndarray) -> np.ndarray:
    """``(rows, TABLES, 1 + VISITS)`` axes: the cell of each table, then the buckets visited inside it, nearest first."""
    dim = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    out = np.full((len(x), TABLES, 1 + VISITS), -1, np.int32)
    for t in range(TABLES):
        for part, n in ((0, 1), (1, VISITS)):
            y = turned(x, 2 * t + part)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :n]
            out[:, t, part:part + top.shape[1]] = top * 2 + (np.take_along_axis(y, top, 1) < 0)
    return out


def _usable(v: str):
    """Column test: a vector whose components are all finite, and not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(v).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _vectors(column, dtype) -> np.ndarray:
    """Vectors of one length, kept as bytes, as rows of doubles of which none is very large or small."""
    rows = column.to_pylist()
    return _scaled(np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1).astype(np.float64))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times the power of two that takes its largest component to [0.5, 1): no square of it
    overflows or vanishes, and ordinary rows lose no digit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))[1])


def hashed(classes: DataFrame) -> DataFrame:
    """One row per class: the vector as bytes of its own precision, and its axes in all tables."""
    dtype = np.float32 if classes.schema["v"].dataType.elementType.typeName() == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == dim))
                v = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(part.num_rows, dim)
                x = _scaled(v.astype(np.float64))
                c = codes(x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(len(v), -1)
                axes = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1) * c.shape[1], pa.int32()), pa.array(c.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), part.column("dim"), part.column("copies"),
                                                  pa.array([r.tobytes() for r in v], pa.binary()), axes],
                                                 names=["vec_id", "label", "dim", "copies", "v", "codes"])

    return classes.mapInArrow(run, "vec_id long, label long, dim int, copies long, v binary, codes array<int>")


def _stars(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple]:
    """``(vec_id, 0, vec_id)`` edges that join what the links of a tile join, by breadth-first search."""
    out = []
    todo = link.any(1)
    for seed in np.flatnonzero(todo).tolist():
        if not todo[seed]:
            continue
        rows, cols = np.zeros(len(left), bool), np.zeros(len(right), bool)
        new = np.array([seed])
        while len(new):
            rows[new] = True
            reached = link[new].any(0) & ~cols
            cols |= reached
            new = np.flatnonzero(link[:, reached].any(1) & ~rows)
        todo &= ~rows
        members = np.unique(np.concatenate([left[rows], right[cols]]))
        out += [(int(members[0]), 0, int(m)) for m in members[1:]]
    return out


def _first(c: np.ndarray, a: np.ndarray, b: np.ndarray, t: int, sub: int) -> np.ndarray:
    """Which of the pairs ``a, b`` meet in no earlier table, nor in a smaller bucket of table ``t``."""
    first = np.ones(len(a), dtype=bool)
    for u in range(t + 1):
        same = c[a, u, 0] == c[b, u, 0]
        for i in range(1, 1 + VISITS):
            x = c[a, u, i]
            for j in range(1, 1 + VISITS):
                meets = same & (x == c[b, u, j]) & (x >= 0)
                first &= ~(meets & (x < sub) if u == t else meets)
    return first


def _compare(t: int, sub: int, one_block: bool, ids, copies, block, v, c) -> list[tuple]:
    """Links inside one bucket, tile by tile: counts per vector and edges of the components."""
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    total = np.zeros(len(ids), np.int64)
    out = []
    for i in range(0, len(ids), TILE):
        for j in range(i, len(ids), TILE):
            link = v[i:i + TILE] @ v[j:j + TILE].T >= THRESHOLD
            if not one_block:
                link &= block[i:i + TILE, None] != block[None, j:j + TILE]
            if i == j:
                link = np.triu(link, 1)
            a, b = np.nonzero(link)
            if not len(a):
                continue
            out += _stars(link, ids[i:i + TILE], ids[j:j + TILE])
            keep = _first(c, a + i, b + j, t, sub)
            a, b = a[keep] + i, b[keep] + j
            total += np.bincount(a, weights=copies[b], minlength=len(ids)).astype(np.int64)
            total += np.bincount(b, weights=copies[a], minlength=len(ids)).astype(np.int64)
    return out + [(int(ids[i]), int(total[i]), None) for i in np.flatnonzero(total).tolist()]


GROUP = ("label", "dim", "t", "cell", "sub", "x", "y")


def compared(members: DataFrame, dtype) -> DataFrame:
    """``vec_id, n, other`` of all cells and block pairs: rows sorted by group, many groups to a batch."""
    def links(g: pa.Table, t: int, sub: int, one_block: bool) -> list[tuple]:
        ids, copies, block = (g.column(k).to_numpy() for k in ("vec_id", "copies", "block"))
        v = _vectors(g.column("v"), dtype)
        c = g.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), TABLES, 1 + VISITS)
        if sub >= 0:
            return _compare(t, sub, one_block, ids, copies, block, v, c)
        out = []
        visits = c[:, t, 1:]
        row = np.repeat(np.arange(len(ids)), VISITS)
        order = np.argsort(visits.ravel(), kind="stable")
        bucket, starts = np.unique(visits.ravel()[order], return_index=True)
        for s, a, b in zip(bucket.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
            if s >= 0 and b - a > 1:
                at = row[order[a:b]]
                out += _compare(t, s, True, ids[at], copies[at], block[at], v[at], c[at])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # rows of the group that is still open
        open_key = None

        def closed() -> pa.RecordBatch:
            out = []
            if sum(h.num_rows for h in held) > 1:
                _, _, t, _, sub, x, y = open_key
                out = links(pa.concat_tables(held), t, sub, x == y)
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["vec_id", "n", "other"])

        for t in regrouped(batches):
            key = np.stack([t.column(k).to_numpy().astype(np.int64) for k in GROUP], 1)
            cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b > a:
                    mine = tuple(key[a].tolist())
                    if mine != open_key and held:
                        yield closed()
                        held.clear()
                    open_key = mine
                    held.append(t.slice(a, b - a))
        if held:
            yield closed()

    ordered = members.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return ordered.mapInArrow(run, "vec_id long, n long, other long")


def laid_out(rows: DataFrame) -> DataFrame:
    """The members of every cell; cells above ``CELL_ROWS`` are dealt by bucket, then cut into blocks."""
    width = 1 + VISITS
    cell = ["label", "dim", "t", "cell"]
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))))
    rows = rows.withColumn("cell", F.element_at("codes", F.col("t") * width + 1).cast("int")).withColumn("visits", F.slice("codes", F.col("t") * width + 2, VISITS).cast("array<int>"))
    sizes = rows.select(*cell, F.posexplode("visits").alias("k", "sub"))
    sizes = sizes.groupBy(*cell, "sub").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("k") == 0).cast("long")).alias("own"))
    cut = F.map_from_entries(F.collect_list(F.struct("sub", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("g"))))
    sizes = sizes.groupBy(*cell).agg(F.sum("own").alias("rows"), cut.alias("cuts")).where("rows > 1")
    sizes = materialize(sizes.withColumn("cuts", F.when(F.col("rows") > CELL_ROWS, F.col("cuts"))), "cells")
    if sizes.count() <= BROADCAST_CLASSES:  # 40 bytes a cell; only large cells have cuts, of at most 2 * dim entries
        sizes = F.broadcast(sizes)
    piece = F.when(F.col("cuts").isNull(), F.array(F.struct(F.lit(-1).alias("sub"), F.lit(1).alias("g")))).otherwise(
        F.transform(F.filter("visits", lambda s: s >= 0), lambda s: F.struct(s.alias("sub"), F.col("cuts")[s].alias("g"))))
    m = rows.join(sizes, cell).withColumn("piece", F.explode(piece)).select("*", "piece.sub", "piece.g")
    m = m.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("g")).cast("int"))
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return m.select(*cell, "sub", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"), "block", "vec_id", "copies", "v", "codes")


def _label(vectors: DataFrame) -> Column:
    """Integers as they are; labels of any other type by a hash of 64 bits."""
    label = F.col("label")
    if vectors.schema["label"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return label.cast("long")
    return F.when(label.isNotNull(), F.xxhash64(label))


def near_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row (``vec_id, embedding, label``)."""
    kind = vectors.schema["embedding"].dataType
    v = F.col("embedding") if kind.simpleString() == "array<float>" else F.col("embedding").cast("array<double>")
    d = vectors.select("vec_id", _label(vectors).alias("label"), v.alias("v"))
    d = d.withColumn("usable", F.col("label").isNotNull() & F.coalesce(_usable("v"), F.lit(False)) & F.col("vec_id").isNotNull())
    d = d.withColumn("h", F.when(F.col("usable"), F.xxhash64("v"))).withColumn("h2", F.when(F.col("usable"), F.hash("v")))
    key = ["label", "h", "h2"]
    seen = d.where("usable").groupBy(*key, "vec_id").agg(F.count(F.lit(1)).alias("n"))
    multi = seen.groupBy(*key).agg(F.min(F.struct("vec_id", "n")).alias("m"), F.sum("n").alias("copies")).where("copies > 1")
    multi = materialize(multi.select(*key, F.col("m.vec_id").alias("rep"), (F.col("m.n") > 1).alias("again"), "copies"), "copies")
    if multi.count() <= BROADCAST_CLASSES:  # 40 bytes a class
        multi = F.broadcast(multi)
    d = d.join(multi, key, "left")
    rep = d.where("usable AND (rep IS NULL OR rep = vec_id)").withColumn("copies", F.coalesce("copies", F.lit(1)).cast("long"))
    again = rep.where("again").groupBy(*key).agg(F.min("vec_id").alias("vec_id"), F.min("v").alias("v"), F.min("copies").alias("copies"))
    cols = ["vec_id", "label", F.size("v").alias("dim"), "copies", "v"]
    rows = hashed(rep.where("again IS NULL OR NOT again").select(*cols).unionAll(again.select(*cols)))
    dtype = np.float32 if kind.simpleString() == "array<float>" else np.float64
    found = materialize(compared(laid_out(rows), dtype), "found")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    comp = materialize(connected_components(found.where("other IS NOT NULL").select(F.col("vec_id").alias("u"), F.col("other").alias("v"))), "components")
    named = comp.join(counts, comp["node"] == counts["vec_id"], "left").select(F.col("node").alias("at"), F.col("component").alias("c"), "n")
    out = d.select("vec_id", "rep", "copies", F.when(F.col("usable"), F.coalesce("rep", "vec_id")).alias("at")).join(named, "at", "left")
    out = out.select("vec_id", F.coalesce("c", "at").alias("c"), (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("n", F.lit(0))).alias("links"))
    comp_id = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp_id, F.lit(True)).alias("kept"))
