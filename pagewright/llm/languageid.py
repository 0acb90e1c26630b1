"""Language identification by Kneser-Ney character models (dealt operator 4).

Per language an interpolated Kneser-Ney model of character 4-grams: absolute discounts per order,
continuation counts below the highest order, a uniform floor. Characters are lower-cased letters
(16 bits; those beyond the basic plane share one), everything else is a space; a 4-gram is one
64-bit key and a model is a few sorted key arrays with their counts. For scoring, the log
probabilities of all 4-grams that any language has seen are laid out in one sorted table (a column
per language); the few others are computed from the lower orders. The language of least
cross-entropy per character wins. ``score`` is the posterior over the languages, tempered to
``EVIDENCE`` characters, and lowered when the cross-entropy exceeds what 99 % of held-back sample
texts of that language show; below ``REJECT`` the answer counts as ``rejected`` (an extra column).

The models are fitted on a bounded sample (``SAMPLE`` rows per language in expectation, of a
longer text the first words of ``SAMPLE_CHARS`` characters); whole texts are scored in one map-only pass with the broadcast
tables (bounded by the sample). ``lang``, ``source`` and ``doc_id`` are no inputs of a prediction.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; NULL languages are
not learned from; without a learned language every answer is ``und``; ties go to the
alphabetically first language; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import regrouped
from pagewright.llm.toxicity import excerpt, held_out

SAMPLE, SAMPLE_CHARS = 600, 20_000
EVIDENCE, REJECT = 60, 0.5
SPACE = 0x20

_U = np.uint64
_chars: np.ndarray | None = None


def char_table() -> np.ndarray:
    """16-bit code of every character of the basic plane: its lower case if a letter, else a space."""
    global _chars
    if _chars is None:
        table = np.full(1 << 16, SPACE, np.uint16)
        for c in range(1 << 16):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _chars = table
    return _chars


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, starts, ends)``: three spaces before each text, codes of all texts."""
    texts = [t or "" for t in texts]
    raw = np.frombuffer(("   " + "   ".join(texts)).encode("utf-32-le", "replace"), dtype=np.uint32)
    table = char_table()
    wide = raw >= 1 << 16
    codes = table[np.where(wide, SPACE, raw)]
    if wide.any():
        letters = [c for c in np.unique(raw[wide]).tolist() if chr(c).isalpha()]
        codes[np.isin(raw, letters)] = 0xFFFF
    n = np.array([len(t) for t in texts])
    starts = np.cumsum(n + 3) - n
    return codes, starts, starts + n


def grams(codes: np.ndarray) -> np.ndarray:
    """Key of the four symbols that end at each place from the fourth on."""
    c = codes.astype(_U)
    return (c[:-3] << _U(48)) | (c[1:-2] << _U(32)) | (c[2:-1] << _U(16)) | c[3:]


def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, q), max(len(keys) - 1, 0))
    return at, (keys[at] == q) if len(keys) else np.zeros(len(q), bool)


class KneserNey:
    """Interpolated Kneser-Ney over sorted arrays; order k keys hold k symbols of 16 bits."""

    def __init__(self, keys: np.ndarray):
        level, count = np.unique(keys, return_counts=True)
        self.orders = []
        for k in (4, 3, 2, 1):
            ones, twos = int((count == 1).sum()), int((count == 2).sum())
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            context, inverse = np.unique(level >> _U(16), return_inverse=True)
            total = np.bincount(inverse, weights=count)
            kinds = np.bincount(inverse)
            self.orders.append((level, np.maximum(count - d, 0) / total[inverse], context, d * kinds / total))
            if k > 1:  # continuation counts: how many symbols precede the shorter gram
                level, count = np.unique(level & _U((1 << (16 * (k - 1))) - 1), return_counts=True)
        self.floor = 1.0 / (len(self.orders[-1][0]) + 1)

    def log_prob(self, q: np.ndarray) -> np.ndarray:
        p = np.full(len(q), self.floor)
        for k, (level, own, context, back) in zip((1, 2, 3, 4), reversed(self.orders), strict=True):
            key = q & _U((1 << (16 * k)) - 1) if k < 4 else q
            at, hit = _find(level, key)
            ctx, known = _find(context, key >> _U(16))
            p = np.where(hit, own[at], 0.0) + np.where(known, back[ctx], 1.0) * p
        return np.log(p)


class Model:
    def __init__(self, names: list[str], parts: list[KneserNey]):
        self.names, self.parts = names, parts
        self.keys = np.unique(np.concatenate([np.zeros(0, _U), *(p.orders[0][0] for p in parts)]))
        self.table = np.stack([p.log_prob(self.keys) for p in parts], 1).astype(np.float32) if parts else np.zeros((0, 0), np.float32)
        self.limit = np.full(len(names), np.inf)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(cross-entropy per language, symbols, has a letter)`` of each text."""
        codes, starts, ends = symbols(texts)
        q = grams(codes)  # q[i] ends at place i + 3
        n = ends - starts
        at, hit = _find(self.keys, q)
        live = codes[3:] != SPACE
        live |= codes[2:-1] != SPACE  # the end of a word counts
        miss = np.flatnonzero(~hit & live)
        unseen, inverse = np.unique(q[miss], return_inverse=True)
        sums = np.zeros((len(n), len(self.names)))
        bounds = np.stack([starts - 3, ends - 3], 1)
        some = np.flatnonzero(n)
        idx = bounds[some].ravel()
        tail = len(some) and idx[-1] >= len(q)
        cut = idx[:-1] if tail else idx
        per = lambda v: np.add.reduceat(v, cut)[::2] if len(some) else np.zeros(0)
        for k, part in enumerate(self.parts):
            v = self.table[:, k][at] if len(self.keys) else np.zeros(len(q), np.float32)
            v = np.where(live, v, np.float32(0)).astype(np.float64)
            v[miss] = part.log_prob(unseen)[inverse]
            sums[some, k] = per(v)
        count, letters = np.zeros(len(n)), np.zeros(len(n))
        count[some] = per(live.astype(np.float64))
        letters[some] = per((codes[3:] != SPACE).astype(np.float64))
        return -sums / np.maximum(count, 1)[:, None], count, letters > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the answer is rejected, per text."""
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n, letters = self.entropies(texts)
        best = h.argmin(1)
        least = h[np.arange(len(h)), best]
        score = 1 / np.exp(-(h - least[:, None]) * np.minimum(n, EVIDENCE)[:, None]).sum(1)
        score = score * np.exp(-np.maximum(least - self.limit[best], 0))
        score[~letters] = 0.0
        return [self.names[b] if x else "und" for b, x in zip(best.tolist(), letters.tolist(), strict=True)], score, score < REJECT


def fit(texts: list[str], langs: list[str]) -> Model:
    """Kneser-Ney models per language; every tenth text is held back for the rejection limits."""
    names = sorted(set(langs))
    parts, held = [], []
    for name in names:
        mine = [t for t, x in zip(texts, langs, strict=True) if x == name]
        held.append(mine[::10] if len(mine) > 10 else mine)
        kept = [t for i, t in enumerate(mine) if i % 10 or len(mine) <= 10]
        codes, _, _ = symbols(kept)
        q = grams(codes)
        parts.append(KneserNey(q[(codes[3:] != SPACE) | (codes[2:-1] != SPACE)]))
    keep = [i for i, p in enumerate(parts) if len(p.orders[0][0])]
    model = Model([names[i] for i in keep], [parts[i] for i in keep])
    for k, i in enumerate(keep):
        h, _, letters = model.entropies(held[i])
        if letters.any():
            model.limit[k] = np.quantile(h[letters, k], 0.99)
    return model


def training_sample(docs: DataFrame, rows: int = SAMPLE) -> list:
    """At most about ``rows`` texts of each language, spread over all of them by a hash."""
    d = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    d = d.select(excerpt("text", SAMPLE_CHARS).alias("text"), "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)).alias("draw"))
    totals = F.broadcast(d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))  # one row per language
    return d.join(totals, "lang").where(F.col("draw") < 1_000_000.0 * rows / F.col("n")).select("text", "lang").collect()


def trained(docs: DataFrame, rows: int = SAMPLE) -> Model:
    got = sorted((r["lang"], r["text"]) for r in training_sample(docs, rows))
    return fit([t for _, t in got], [x for x, _ in got])


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in regrouped(batches, 1 << 20):
            lang, score, rejected = shared.value.predict(t.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([t.column("doc_id").combine_chunks(), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                             names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
