"""Toxicity: a convolutional text classifier (dealt operator 1).

A word has two hashes: of all of it and of its first four bytes. A word's embedding is the sum of the two
rows they name in tables of ``WORD_ROWS`` and ``HEAD_ROWS``; rows that fewer than two training texts name
are zero. Filters of widths 1, 2 and 3 slide over the whole text, each filter keeps its maximum, and a
logistic layer weighs the maxima. The score is calibrated *by language*: a word-count model, counted on
the same rows, tells the language from the text, and each language's logits are shifted and scaled so
that the threshold with the best F1 on a held-back fifth of the rows lands on 0.7.

All labelled rows and their whole texts are learned from, as Spark jobs; the driver sees sums only:

* the rows are dealt by a hash into parts of about ``PART_ROWS`` and written once, sorted by part;
* one pass counts the rows of the tables by language;
* in each of ``EPOCHS`` passes every part goes on from the common parameters with its own steps
  (numpy, Adam; the gradient of a maximum reaches its window only), and the changes are averaged
  (McMahan et al. 2017): by rows, and of an embedding row by the steps that touched it;
* logits of the held-back rows are counted in steps of ``1 / BINS`` to find the thresholds.

A task holds a few MB of text and the model; the model is bounded by its tables, whatever the corpus.
Scoring is map-only with the model broadcast; it travels as embeddings and filters, and each process makes the
tables of responses (three times as large) for itself. Scores see the text alone.

Defined cases: NULL and empty texts get the score of a text without known words; NULL labels and
labels of unknown documents are not learned from; without both classes among the rows every score
is the share of toxic rows (0 without rows); repeated rows are scored alike; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import ALNUM, Words, hash_words, mix, regrouped
from pagewright.session import materialize

SAMPLE_CHARS = 20_000
WORD_ROWS, HEAD_ROWS = 1 << 18, 1 << 16
PART_ROWS, GROUP_BYTES = 4096, 2 << 20
#: texts that one task holds against their labels
TASK_ROWS = 8 * PART_ROWS
BINS = 256
WIDTHS, FILTERS, DIM = (1, 2, 3), 8, 16
EPOCHS, BATCH, RATE = 6, 32, 0.02
CUT = 0.7


def held_out(doc_id: str = "doc_id", mod: int = 3) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == 1, F.lit(False))


@dataclass
class Model:
    places: list[np.ndarray]        # of words and of word beginnings: the embedding row of each table row, 0 if unknown
    embeddings: np.ndarray          # (rows, DIM)
    filters: list[np.ndarray]       # per width: (width, DIM, FILTERS)
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: float
    languages: np.ndarray           # (rows, languages) log odds
    prior: np.ndarray
    shift: np.ndarray               # per language: logit at the threshold
    scale: np.ndarray
    constant: float | None = None

    @cached_property
    def tables(self) -> list[list[np.ndarray]]:
        """Per width and place in it: (rows, FILTERS) responses."""
        return [[np.ascontiguousarray(self.embeddings @ w[j]) for j in range(len(w))] for w in self.filters]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "tables"}

    def logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Raw logit and language of each text."""
        rows, off = _rows(self.places, words)
        n = len(off) - 1
        pooled = []
        for tables, bias in zip(self.tables, self.bias, strict=True):
            r = tables[0][rows[0]] + tables[0][rows[1]]
            for j, t in enumerate(tables[1:], 1):
                for kind in rows:
                    r[:len(r) - j] += t[kind[j:]]
            ends = np.stack([off[:-1], np.maximum(off[1:] - 2, off[:-1] + 1)], 1).ravel()
            pooled.append(np.maximum.reduceat(r, ends, axis=0)[::2] + bias)
        h = np.maximum(np.concatenate(pooled, 1), 0)
        lang = np.zeros((n, len(self.prior)), np.float32)
        for k in range(len(self.prior)):
            column = self.languages[:, k]
            lang[:, k] = np.add.reduceat(column[rows[0]] + column[rows[1]], off[:-1]) + self.prior[k]
        return h @ self.weight + self.offset, lang.argmax(1)

    def score(self, words: Words) -> np.ndarray:
        n = len(words.offsets) - 1
        if self.constant is not None or not n:
            return np.full(n, self.constant or 0.0)
        z, lang = self.logits(words)
        z = (z - self.shift[lang]) * self.scale[lang] + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _slots(words: Words) -> list[np.ndarray]:
    """The table rows of all words, and of their beginnings."""
    return [(mix(keys) & np.uint64(n - 1)).astype(np.int64) for keys, n in ((words.hashes, WORD_ROWS), (words.heads, HEAD_ROWS))]


def _rows(places: list[np.ndarray], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows ``(2, places)`` of all texts, two empty places behind each, and offsets."""
    n = np.diff(words.offsets)
    off = words.offsets + 2 * np.arange(len(words.offsets))
    out = np.zeros((2, off[-1]), np.int64)
    at = np.arange(len(words.hashes)) + 2 * np.repeat(np.arange(len(n)), n)
    for k, slots in enumerate(_slots(words)):
        out[k, at] = places[k][slots]
    return out, off


def _new(size: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.RandomState(seed)
    params = {"E": rng.randn(size, DIM).astype(np.float32) * np.float32(0.1)}
    params["E"][0] = 0
    for w in WIDTHS:
        params[f"W{w}"] = rng.randn(w, DIM, FILTERS).astype(np.float32) * np.float32(0.3 / np.sqrt(w))
        params[f"b{w}"] = np.full(FILTERS, 0.05, np.float32)
    params["v"] = rng.randn(FILTERS * len(WIDTHS)).astype(np.float32) * np.float32(0.3)
    params["c"] = np.zeros(1, np.float32)
    return params


def _dense(params: dict[str, np.ndarray]) -> np.ndarray:
    """All parameters but the embeddings, in rows of ``DIM``."""
    flat = np.concatenate([p.ravel() for k, p in params.items() if k != "E"]).astype(np.float64)
    return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)


def _part_steps(start: dict[str, np.ndarray], seed: int, rate: float, weights: tuple[float, float]):
    """Own copies of the parameters and a function that goes one step per ``BATCH`` rows of a group."""
    params = {k: p.copy() for k, p in start.items()}
    moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in params.items()}
    touches, rng, step = np.zeros(len(params["E"]), np.int32), np.random.RandomState(seed), 0

    def go(rows: np.ndarray, off: np.ndarray, y: np.ndarray) -> None:
        nonlocal step
        weight = np.where(y > 0, *weights).astype(np.float32)
        order = rng.permutation(len(y))
        for a in range(0, len(order), BATCH):
            step += 1
            grads, touched = _gradients(params, rows, off, order[a:a + BATCH], y, weight)
            touches[touched] += 1
            for k, g in grads.items():
                m1, m2 = moments[k]
                at = touched if k == "E" else slice(None)
                m1[at] = 0.9 * m1[at] + 0.1 * g
                m2[at] = 0.99 * m2[at] + 0.01 * g * g
                params[k][at] -= rate * (m1[at] / (1 - 0.9 ** step)) / (np.sqrt(m2[at] / (1 - 0.99 ** step)) + 1e-6)
            params["E"][0] = 0

    return params, touches, go


_CHANGES = [f"v{j}" for j in range(DIM)]


def _pieces(at: np.ndarray, size: int = 1 << 14) -> Iterator[np.ndarray]:
    return (at[a:a + size] for a in range(0, len(at), size))


def _epoch(train: DataFrame, places: list[np.ndarray], params: dict[str, np.ndarray], epoch: int, weights: tuple[float, float]) -> dict[str, np.ndarray]:
    """The parameters after one pass: each part's changes, averaged. The embeddings are changed in place."""
    shared = train.sparkSession.sparkContext.broadcast((places, params))
    rate = RATE * (1 - 0.8 * epoch / EPOCHS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, start = shared.value
        size, dense = len(start["E"]), _dense(start)
        sums, counts = np.zeros((size + len(dense), DIM)), np.zeros(size + len(dense))
        part, seen, state = None, 0, None

        def flush() -> None:
            params, touches, _ = state
            for at in _pieces(np.flatnonzero(touches)):
                sums[at] += touches[at, None] * (params["E"][at] - start["E"][at]).astype(np.float64)
                counts[at] += touches[at]
            sums[size:] += seen * (_dense(params) - dense)
            counts[size:] += seen

        for t in regrouped(batches, GROUP_BYTES):
            parts = t.column("part").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if parts[a] != part:
                    if state:
                        flush()
                    part, seen, state = parts[a], 0, _part_steps(start, int(parts[a]) * EPOCHS + epoch, rate, weights)
                mine = t.slice(a, b - a)
                state[2](*_rows(places, hash_words(mine.column("text"), ALNUM, heads=True)), mine.column("toxic").to_numpy().astype(np.float32))
                seen += b - a
        if state:
            flush()
        for mine in _pieces(np.flatnonzero(counts)):
            yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(counts[mine]), *(pa.array(sums[mine, j].astype(np.float32)) for j in range(DIM))],
                                             names=["row", "weight", *_CHANGES])

    kinds = ", ".join(f"{c} float" for c in _CHANGES)
    changes = train.where("NOT held").select("part", "text", "toxic").mapInArrow(run, f"row long, weight double, {kinds}")
    got = changes.groupBy("row").agg(F.sum("weight").alias("weight"), *[F.sum(c).alias(c) for c in _CHANGES]).toArrow()
    shared.destroy()
    row, weight = got.column("row").to_numpy(), got.column("weight").to_numpy()
    out, size, dense = {"E": params["E"]}, len(params["E"]), _dense(params)
    for j, c in enumerate(_CHANGES):  # a column at a time: the driver holds little besides the sums
        change = np.zeros(size + len(dense))
        change[row] = got.column(c).to_numpy() / weight
        out["E"][:, j] = out["E"][:, j] + change[:size]
        dense[:, j] += change[size:]
    flat = dense.ravel()
    for k, p in params.items():
        if k != "E":
            out[k], flat = flat[:p.size].reshape(p.shape).astype(np.float32), flat[p.size:]
    return out


def _count_words(train: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per table row (those of the beginnings behind those of the words): texts that name it, and words by language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, GROUP_BYTES):
            words = hash_words(t.column("text"), ALNUM, heads=True)
            doc = np.repeat(np.arange(t.num_rows), np.diff(words.offsets))
            code = np.array([names.index(x) if x in names else -1 for x in t.column("lang").to_pylist()], np.int64)
            for first, slots in zip((0, WORD_ROWS), _slots(words), strict=True):
                pair, n = np.unique((slots + first) * t.num_rows + doc, return_counts=True)
                named = (pair // t.num_rows) * (len(names) + 1) + code[pair % t.num_rows] + 1
                key, inverse = np.unique(named, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(key // (len(names) + 1)), pa.array(key % (len(names) + 1) - 1), pa.array(np.bincount(inverse)),
                                                  pa.array(np.bincount(inverse, weights=n).astype(np.int64))], names=["slot", "lang", "texts", "n"])

    got = train.select("text", "lang").mapInArrow(run, "slot long, lang long, texts long, n long").groupBy("slot", "lang").agg(
        F.sum("texts").alias("texts"), F.sum("n").alias("n")).toArrow()
    slot, lang = got.column("slot").to_numpy(), got.column("lang").to_numpy()
    texts = np.bincount(slot, weights=got.column("texts").to_numpy(), minlength=WORD_ROWS + HEAD_ROWS)
    counts = np.zeros((WORD_ROWS + HEAD_ROWS, len(names)))
    counts[slot[lang >= 0], lang[lang >= 0]] = got.column("n").to_numpy()[lang >= 0]
    return texts, counts


def _gradients(params, rows, off, batch, y, weight):
    pooled, places = np.empty((len(batch), FILTERS * len(WIDTHS)), np.float32), []
    for i, d in enumerate(batch):
        ids = rows[:, off[d]:off[d + 1]]
        x = params["E"][ids[0]] + params["E"][ids[1]]
        n = max(1, ids.shape[1] - 2)
        for q, w in enumerate(WIDTHS):
            r = sum(x[j:j + n] @ params[f"W{w}"][j] for j in range(w)) + params[f"b{w}"]
            best = r.argmax(0)
            pooled[i, q * FILTERS:(q + 1) * FILTERS] = r[best, np.arange(FILTERS)]
            places.append(ids[:, best[:, None] + np.arange(w)])
    h = np.maximum(pooled, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ params["v"] + params["c"][0], -30, 30)))
    err = (p - y[batch]) * weight[batch] / len(batch)
    grads = {"v": h.T @ err, "c": np.array([err.sum()], np.float32)}
    back = err[:, None] * params["v"] * (pooled > 0)
    rows_, deltas = [], []
    for q, w in enumerate(WIDTHS):
        g = back[:, q * FILTERS:(q + 1) * FILTERS]
        ids = np.stack(places[q::len(WIDTHS)])  # (batch, 2, FILTERS, w)
        grads[f"b{w}"] = g.sum(0)
        gw = np.empty_like(params[f"W{w}"])
        for j in range(w):
            x = params["E"][ids[:, 0, :, j]] + params["E"][ids[:, 1, :, j]]
            gw[j] = np.einsum("bfd,bf->df", x, g)
            delta = (g[:, :, None] * params[f"W{w}"][j].T[None]).reshape(-1, DIM)
            for kind in range(2):
                rows_.append(ids[:, kind, :, j].ravel())
                deltas.append(delta)
        grads[f"W{w}"] = gw
    touched, inverse = np.unique(np.concatenate(rows_), return_inverse=True)
    ge = np.zeros((len(touched), DIM), np.float32)
    np.add.at(ge, inverse, np.concatenate(deltas))
    grads["E"] = ge
    return grads, touched


def _best_cut(z: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Threshold between two logits (ascending, with their rows) with the best F1 (the middle one of equals), and a scale."""
    z, hits, rows = z[::-1], np.cumsum(toxic[::-1]), np.cumsum(n[::-1])
    f1 = 2 * hits / (rows + hits[-1])
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    k = int(best[len(best) // 2])
    upper = z[k]
    lower = z[k + 1] if k + 1 < len(z) else upper - 1
    return float((upper + lower) / 2), float(np.clip(2 / max(upper - lower, 0.25), 0.5, 4))


def _calibrate(model: Model, held: DataFrame, n_langs: int) -> None:
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, GROUP_BYTES):
            z, lang = shared.value.logits(hash_words(t.column("text"), ALNUM, heads=True))
            bins = np.round(np.clip(z, -60, 60) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int64)), pa.array(bins), t.column("toxic").combine_chunks().cast(pa.int64())],
                                             names=["lang", "bin", "toxic"])

    rows = held.select("text", "toxic").mapInArrow(run, "lang long, bin long, toxic long")
    got = sorted(rows.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("toxic")).collect())
    shared.destroy()
    lang, bins, n, toxic = np.array(got, np.int64).reshape(-1, 4).T

    def cut(mine: np.ndarray) -> tuple[float, float]:
        z, at = np.unique(bins[mine], return_inverse=True)
        return _best_cut(z / BINS, np.bincount(at, weights=n[mine]), np.bincount(at, weights=toxic[mine]))

    common = cut(lang >= 0) if 0 < toxic.sum() < n.sum() else (0.0, 1.0)
    model.shift, model.scale = np.full(n_langs, common[0]), np.full(n_langs, common[1])
    for k in range(n_langs):
        mine = lang == k
        if toxic[mine].sum() >= 10 and (n - toxic)[mine].sum() >= 10:  # fewer: the common threshold
            model.shift[k], model.scale[k] = cut(mine)


def excerpt(text: str, chars: int = SAMPLE_CHARS) -> Column:
    """A training text; of one longer than ``chars`` its first words of so many characters."""
    head = F.substring(text, 1, chars)
    words = F.regexp_extract(head, r"(?s)^.*\s", 0)
    return F.when(F.length(text) <= chars, F.col(text)).otherwise(F.when(words != "", words).otherwise(head))


def labelled(docs: DataFrame, lab: DataFrame, parts: int) -> DataFrame:
    """``text, toxic, lang, part, held``, sorted by part: the rows of ``docs`` that ``lab`` (one row a doc_id) names.

    Labels travel with the texts to the task of their part, so a text moves once, at any size, and no label is broadcast;
    if few texts are labelled, a part is labelled by several tasks and its rows move once more.
    """
    d = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").where(~held_out())  # no other has a label to learn from
    tasks = parts * (d.count() // (parts * TASK_ROWS) + 1)
    d = d.select("doc_id", "text", "lang", F.lit(None).cast("int").alias("toxic"))
    d = d.unionByName(lab.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), "toxic"))
    d = d.withColumn("draw", F.xxhash64("doc_id", F.lit("part"))).withColumn("task", F.pmod("draw", F.lit(tasks)))
    d = d.repartition(tasks, "task").withColumn("toxic", F.max("toxic").over(Window.partitionBy("task", "doc_id")))
    rows = d.where("text IS NOT NULL AND toxic IS NOT NULL").select(
        "text", "toxic", F.when(F.col("lang") != "", F.col("lang")).alias("lang"), F.pmod("draw", F.lit(parts)).alias("part"),
        (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0).alias("held"), "draw")
    if tasks > parts:
        rows = rows.repartition(parts, "part")
    return rows.sortWithinPartitions("part", "draw", "text").drop("draw")


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, lang, part, held``: every labelled row with its whole text, written in parts; a fifth is held back."""
    lab = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
           .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    lab = materialize(lab, "toxicity_labels")  # counted, then read with the texts
    return materialize(labelled(docs, lab, lab.count() // PART_ROWS + 1), "toxicity_rows")


def trained(docs: DataFrame, labels: DataFrame, seed: int = 11) -> Model:
    """The model of all labelled rows."""
    train = training_rows(docs, labels)
    sizes = train.groupBy("held", "toxic", "lang").agg(F.count(F.lit(1)).alias("n")).collect()  # classes and languages
    n, toxic = sum(r["n"] for r in sizes), sum(r["n"] for r in sizes if r["toxic"] > 0)
    none = np.zeros(0)
    if toxic in (0, n):
        return Model([], none, [], [], none, 0.0, none, none, none, none, toxic / n if n else 0.0)
    names = sorted({r["lang"] for r in sizes if r["lang"] is not None}) or ["und"]
    texts, counts = _count_words(train, names)
    known = texts > 1
    places = np.where(known, np.cumsum(known), 0).astype(np.int32)
    counts = np.concatenate([np.ones((1, len(names))), counts[known] + 0.5])
    model = Model([places[:WORD_ROWS], places[WORD_ROWS:]], none, [], [], none, 0.0, none, none, none, none)
    model.languages = np.log(counts / counts.sum(0)).astype(np.float32)
    model.languages -= model.languages.mean(1, keepdims=True)
    model.languages[0] = 0
    of = {k: sum(r["n"] for r in sizes if r["lang"] == k) / n for k in names}
    model.prior = np.log(np.maximum([of[k] for k in names], 1e-6)).astype(np.float32)

    learned = sum(r["n"] for r in sizes if not r["held"])
    share = sum(r["n"] for r in sizes if r["toxic"] > 0 and not r["held"]) / max(learned, 1)
    params = _new(len(counts), seed)
    for epoch in range(EPOCHS):
        params = _epoch(train, model.places, params, epoch, (0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3)))
    model.embeddings, model.filters = params["E"], [params[f"W{w}"] for w in WIDTHS]
    model.bias = [params[f"b{w}"] for w in WIDTHS]
    model.weight, model.offset = params["v"], float(params["c"][0])
    _calibrate(model, train.where("held"), len(names))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, 2 << 20):
            s = shared.value.score(hash_words(t.column("text"), ALNUM, heads=True))
            yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array(s.astype(np.float64))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, all columns kept (decided row by row)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, 2 << 20):
            s = shared.value.score(hash_words(t.column("text"), ALNUM, heads=True))
            yield from t.filter(pa.array(s < CUT)).combine_chunks().to_batches()

    return docs.mapInArrow(run, docs.schema)
