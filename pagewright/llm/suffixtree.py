"""Language-model scoring with a probabilistic suffix tree (dealt operator 2).

Tokens are the non-space runs of a text (ASCII lower-cased) and one end. The tree's states are
contexts of 0 to ``DEPTH`` preceding tokens:

* *candidates* are contexts that some next symbol follows ``MIN_COUNT`` times or more, over all
  training documents and whatever the size of the corpus (below that, smoothing leaves nothing);
* *divergence test*: a candidate is retained if its next-symbol distribution differs from that of
  its suffix: ``2 n KL`` beyond ``df + Z sqrt(2 df)``, and KL at least ``MIN_KL``;
* *smoothing*: a state's distribution is its discounted counts, and the mass that is left goes to
  the distribution of its longest retained suffix, down to the unigram distribution of the contract
  (which is the root): ``P(x|s) = max(n(s,x) - D, 0) / n(s) + rest(s) P(x|suffix(s))``; it sums to 1;
* *scoring*: each token is predicted by the longest retained suffix of what precedes it.

Unigram counts, states and entries grow with the corpus; they are never collected or broadcast.
Documents are dealt into chunks of about ``CHUNK_BYTES`` of text, which are coded once. A chunk names
its distinct tokens to the buckets of their hashes and is told their counts and short ids. It then
sends each distinct run ``t3 t2 t1 x`` of its places once, sorted and packed, to the bucket of ``t1``.
There all contexts that end in ``t1`` are whole: they are counted, tested and smoothed, and the counts
that hold for a chunk's runs go back in the order in which the chunk sent them.

A context of more than ``HOT`` training places would make its bucket too large. Its runs are counted by
the hash of the whole run first (``_tally``, longest contexts last), its sums are added up by Spark, and
what follows is dealt out by the next word to the left. There are at most N / ``HOT`` such contexts a
length; only these are collected.

Defined cases: NULL texts are empty (the end is their one token); a NULL doc_id is not held out;
repeated rows count as often as they occur; without training rows N = V = 0 and scores are 0;
empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import NON_SPACE, hash_words, mix, regrouped, signed
from pagewright.llm.toxicity import held_out
from pagewright.session import BucketedTable

DEPTH = 3
MIN_COUNT = 2
Z, MIN_KL, DISCOUNT = 6.0, 0.02, 0.5
CHUNK_BYTES = 10_000_000
#: Places of a bucket, and training places beyond which a context is hot.
BUCKET, HOT = 1_000_000, 1_000_000
CODED, ANSWER = -1, 9

_TOLD = "chunk long, kind int, bucket int, parts array<binary>"
_CODED = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("parts", pa.list_(pa.binary())), ("doc_id", pa.list_(pa.int64())),
                    ("train", pa.list_(pa.bool_())), ("n", pa.list_(pa.int32())), ("places", pa.int64()), ("learned", pa.int64())])
_OVER = pa.list_(pa.struct([("name", pa.int64()), ("n", pa.int64())]))
_FIRST = {"kinds": pa.int64(), "over": _OVER, "sums": pa.list_(pa.struct(
    [("state", pa.int32()), ("many", pa.int64()), ("entries", pa.int64()), ("kinds", pa.int64()), ("nkl", pa.float64())]))}

_U = np.uint64
_Q = _U(0x9FB21C651E98DF25)
_LOW = _U(0xFFFFFFFF)
START, END = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)


def sequences(col) -> tuple[np.ndarray, np.ndarray]:
    """START, the tokens and END of every text: ``(tokens, offsets)``."""
    w = hash_words(col, NON_SPACE)
    n = np.diff(w.offsets)
    off = w.offsets + 2 * np.arange(len(w.offsets))
    out = np.full(off[-1], END, _U)
    out[off[:-1]] = START
    out[np.arange(len(w.hashes)) + 2 * np.repeat(np.arange(len(n)), n) + 1] = w.hashes
    return out, off


def contexts(tokens: np.ndarray, off: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length k: hash of the k tokens before each place, and whether the text has so many."""
    at = np.arange(len(tokens)) - np.repeat(off[:-1], np.diff(off))
    out, h, power = [], np.zeros(len(tokens), _U), np.ones(1, _U)
    for k in range(1, depth + 1):
        h = h.copy()
        h[k:] += tokens[:len(tokens) - k] * power
        out.append((h, at >= k))
        power = power * _Q
    return out


def _entry(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hash of the run ``context, token``: what ``contexts`` gives for it at the next place."""
    return context * _Q + token


def _lookup(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(q), np.int64), np.zeros(len(q), bool)
    at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    return at, keys[at] == q


def _pack(a: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes, no wider than the largest."""
    a = np.ascontiguousarray(a, dtype="<u8")
    width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
    planes = a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return struct.pack("<QB", len(a), width) + (pa.compress(planes, codec="zstd", asbytes=True) if width else b"")


def _unpack(b: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", b)
    out = np.zeros((n, 8), np.uint8)
    if width:
        out[:, :width] = np.frombuffer(pa.decompress(b[9:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers; ``np.cumsum`` undoes it."""
    return np.diff(a, prepend=_U(0)) if len(a) else a


def _pack_runs(hi: np.ndarray, lo: np.ndarray) -> list[bytes]:
    """Ascending runs; each token as its difference from the one above, where all before it are equal."""
    out, new = [], np.zeros(len(hi), bool)
    new[:1] = True
    for t in (hi >> _U(32), hi & _LOW, lo >> _U(32), lo & _LOW):
        d = np.where(new, t, _steps(t))
        out.append(_pack(d))
        new = new | (d != 0)
    return out


def _unpack_runs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    cols, new = [], None
    for b in parts:
        d = _unpack(b)
        if new is None:
            new = np.zeros(len(d), bool)
            new[:1] = True
        c = np.cumsum(d, dtype=_U)
        start = np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))
        cols.append(c - c[start] + d[start])
        new = new | (d != 0)
    return cols[0] << _U(32) | cols[1], cols[2] << _U(32) | cols[3]


def _heads(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    """Per length: which of the ascending runs are the first of their context."""
    new = np.ones((3, len(hi)), bool)
    if len(hi):
        new[0, 1:] = (hi[1:] >> _U(32)) != (hi[:-1] >> _U(32))
        new[1, 1:] = hi[1:] != hi[:-1]
        new[2, 1:] = new[1, 1:] | ((lo[1:] >> _U(32)) != (lo[:-1] >> _U(32)))
    return list(new)


def _distinct(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of every run the number of its kind, ascending, one place of every kind, and how many there are."""
    _, g = np.unique(hi, return_inverse=True)
    _, g = np.unique(g.astype(_U) << _U(32) | lo >> _U(32), return_inverse=True)
    kinds, g = np.unique(g.astype(_U) << _U(32) | lo & _LOW, return_inverse=True)
    one = np.empty(len(kinds), np.int64)
    one[g] = np.arange(len(g))
    return g, one, len(kinds)


def _range(names: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each name: ranges, so that the names of a bucket lie close and pack well."""
    return ((names >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _dealt(route: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of every bucket, in order."""
    order = np.argsort(route.astype(np.uint16) if len(route) and route.max() < 1 << 16 else route, kind="stable")
    r = route[order]
    cuts = np.append(np.flatnonzero(np.diff(r, prepend=r[:1] + 1)), len(r)) if len(r) else np.zeros(1, int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(r[a]), order[a:b]


def _rows(chunk: int, kind: int, parts: dict[int, list[bytes]]) -> pa.Table:
    n = len(parts)
    return pa.table({"chunk": pa.array([chunk] * n, pa.int64()), "kind": pa.array([kind] * n, pa.int32()),
                     "bucket": pa.array(list(parts), pa.int32()), "parts": pa.array(list(parts.values()), pa.list_(pa.binary()))})


def coded(docs: DataFrame) -> DataFrame:
    """One row per chunk: its documents, its distinct tokens and its texts in numbers of these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, t in enumerate(regrouped(batches, CHUNK_BYTES)):
            tokens, off = sequences(t.column("text"))
            kinds, at, n = np.unique(tokens, return_inverse=True, return_counts=True)
            rank = np.empty(len(kinds), np.int64)
            rank[np.argsort(-n, kind="stable")] = np.arange(len(kinds))
            train = ~t.column("held").to_numpy()
            yield pa.RecordBatch.from_pylist([{
                "chunk": (TaskContext.get().partitionId() << 32) + i, "kind": CODED, "parts": [_pack(_steps(kinds)), _pack(n), _pack(rank[at])], "doc_id": t.column("doc_id").to_pylist(), "train": train.tolist(),
                "n": np.diff(off).tolist(), "places": int(np.diff(off)[train].sum()), "learned": int(train.sum())}], schema=_CODED)

    return docs.select("doc_id", "text", held_out(mod=5).alias("held")).mapInArrow(
        run, "chunk long, kind int, parts array<binary>, doc_id array<long>, train array<boolean>, n array<int>, places long, learned long")


class Chunk:
    """A chunk's tokens, and what it has been told of them."""

    def __init__(self, t: pa.Table, model: Model, answers: pa.Table | None = None):
        own = t.column("kind").to_pylist().index(CODED)
        self.id = t.column("chunk")[0].as_py()
        self.doc_id, train, n = (t.column(c)[own].values for c in ("doc_id", "train", "n"))
        n = n.to_numpy()
        self.off = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        self.train = np.repeat(train.to_numpy(zero_copy_only=False), n)
        steps, sizes, seq = (_unpack(x) for x in t.column("parts")[own].as_py())
        self.kinds = np.cumsum(steps, dtype=_U)
        self.at = np.argsort(-sizes.astype(np.int64), kind="stable")[seq.astype(np.int64)]
        self.model = model
        self.told = {(r["kind"], r["bucket"]): r["parts"] for x in (t, answers) if x is not None
                     for r in x.select(["kind", "bucket", "parts"]).to_pylist() if r["kind"] != CODED}
        if not self.told:
            return
        c, ids = np.zeros(len(self.kinds), np.int64), np.zeros(len(self.kinds), _U)
        for b, some in self.by_token():
            c[some], ids[some] = (_unpack(x) for x in self.told[0, b])
        self.c, self.ids = c[self.at], ids[self.at]
        del self.at
        place = np.arange(len(self.ids)) - np.repeat(self.off[:-1], n)
        self.here = np.flatnonzero(place >= 1)
        self.before = np.minimum(place[self.here], DEPTH).astype(np.int8)
        del place
        self.hot()

    def by_token(self) -> Iterator[tuple[int, np.ndarray]]:
        return _dealt(_range(self.kinds, self.model.buckets))

    def token(self, back: int) -> np.ndarray:
        """Of every place the token so many places before, 0 if there is none."""
        return np.where(self.before >= back, self.ids[np.maximum(self.here - back, 0)], _U(0))

    def hot(self) -> None:
        """How many of a place's contexts are hot, shortest first, and what was counted of these runs."""
        self.depth = np.zeros(len(self.here), np.int8)
        self.seen, self.states = [], []  # per length: counts of the runs, places in the hot list
        self.asked = []                  # per length: names of the runs and the places that have hot contexts
        name = np.zeros(len(self.here), _U)
        names = []
        if self.model.hot:
            run = _name(np.zeros(len(self.here), _U), self.ids[self.here])
        for k, level in enumerate(self.model.hot, 1):
            name = _name(name, self.token(k))
            run = _name(run, self.token(k))
            state, hot = _lookup(level.names, name)
            hot &= (self.depth == k - 1) & (self.before >= k)
            self.depth[hot] = k
            at = np.flatnonzero(hot)
            names, inv = np.unique(run[at], return_inverse=True)
            self.asked.append((names, inv, at))
            self.states.append(np.where(hot, state, 0).astype(np.int32))
            seen = np.zeros(len(self.here), np.int64)
            if level.done:
                n = np.zeros(len(names), np.int64)
                for b, some in _dealt(_range(names, self.model.buckets)):
                    n[some] = _unpack(self.told[k, b][0])
                seen[at] = n[inv]
            self.seen.append(seen)

    def below(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every place with k - 1 hot contexts or more: count and total of its run with k - 1 of them."""
        if k == 1:
            return self.c[self.here], np.full(len(self.here), self.model.total)
        return self.seen[k - 2], self.model.hot[k - 2].total[self.states[k - 2]]

    def runs(self) -> None:
        """The distinct runs of the places, ascending, and those of every bucket; ``inv``: that of every place."""
        hi = self.token(1) << _U(32) | self.token(2)
        lo = self.token(3) << _U(32) | self.ids[self.here]
        self.inv, self.first, size = _distinct(hi, lo)
        self.n = np.bincount(self.inv, weights=self.train[self.here], minlength=size).astype(np.int64)
        hi, lo, depth = hi[self.first], lo[self.first], self.depth[self.first]
        route = np.where(depth == 0, mix(hi >> _U(32)), mix(hi))
        route = np.where(depth == 2, mix(route + (lo >> _U(32))), route) % _U(self.model.buckets)
        route = np.where(depth < self.before[self.first], route.astype(np.int64), self.model.buckets)  # nothing left to ask
        self.hi, self.lo = hi, lo
        self.buckets = [(b, some) for b, some in _dealt(route) if b < self.model.buckets]


@dataclass
class Hot:
    """Contexts of one length with more than ``HOT`` places: ascending names, totals, and what was counted."""
    names: np.ndarray
    total: np.ndarray
    done: bool = False
    many: np.ndarray | None = None    # sum of the counts of its entries
    entries: np.ndarray | None = None
    kept: np.ndarray | None = None


@dataclass
class Model:
    buckets: int
    total: int = 0
    kinds: int = 0
    hot: list[Hot] = field(default_factory=list)


def _name(name: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Name of a run with one more token to the left."""
    return mix(name * _Q + token)


def _kept(entries: np.ndarray, kinds: np.ndarray, nkl: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The divergence test."""
    df = np.maximum(kinds - 1, 1)
    return (entries > 0) & (2 * nkl >= df + Z * np.sqrt(2 * df)) & (nkl >= MIN_KL * total)


def _sums(group: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per context, of its distinct runs: count of all entries, number of entries, number of seen runs."""
    big = n >= MIN_COUNT
    return (np.bincount(group[big], weights=n[big], minlength=size).astype(np.int64), np.bincount(group[big], minlength=size),
            np.bincount(group[n > 0], minlength=size))


def _answers(t: pa.Table, kind: int, parts: list[list[bytes]], **first) -> pa.Table:
    """What a bucket tells each chunk; ``first`` goes with the first row."""
    n = t.num_rows
    return pa.table({"chunk": t.column("chunk"), "kind": pa.array([kind] * n, pa.int32()), "bucket": t.column("bucket"),
                     "parts": pa.array(parts, pa.list_(pa.binary())),
                     **{k: pa.array([v] + [None] * (n - 1), _FIRST[k]) for k, v in first.items()}})


def count_tokens(chunks: DataFrame, model: Model, hot: int) -> DataFrame:
    """Counts and ids of the tokens of every chunk; ``kinds``: learned ones; ``over``: tokens with more than ``hot`` places."""
    def ask(t: pa.Table) -> pa.Table:
        c = Chunk(t, model)
        n = np.bincount(c.at[c.train], minlength=len(c.kinds))
        n[c.kinds == START] = 0
        return _rows(c.id, 0, {b: [_pack(_steps(c.kinds[some])), _pack(n[some])] for b, some in c.by_token()})

    def add(t: pa.Table) -> pa.Table:
        parts = t.column("parts").to_pylist()
        keys, ns = [np.cumsum(_unpack(x[0]), dtype=_U) for x in parts], [_unpack(x[1]) for x in parts]
        key, inv = np.unique(np.concatenate(keys), return_inverse=True)
        c = np.bincount(inv, weights=np.concatenate(ns)).astype(np.int64)
        ids = np.empty(len(key), _U)  # about by frequency, so that common tokens have short ones
        ids[np.argsort(-c, kind="stable")] = np.arange(len(key), dtype=_U) * _U(model.buckets) + _U(1 + t.column("bucket")[0].as_py())
        if len(ids) and ids.max() > _LOW:
            raise ValueError("more than 2^32 different tokens")
        at = np.cumsum([len(k) for k in keys])[:-1]
        over = np.flatnonzero((c > hot) | (key == START))
        names = signed(_name(np.zeros(len(over), _U), ids[over]))
        return _answers(t, 0, [[_pack(c[i]), _pack(ids[i])] for i in np.split(inv, at)], kinds=int((c > 0).sum()),
                        over=[{"name": int(a), "n": int(n)} for a, n in zip(names, c[over], strict=True)])

    asked = chunks.groupBy("chunk").applyInArrow(ask, _TOLD)
    return asked.groupBy("bucket").applyInArrow(add, _TOLD + ", kinds long, over array<struct<name: long, n: long>>")


def _tally(chunks: DataFrame, model: Model, k: int, hot: int) -> DataFrame:
    """Counts of the runs of hot contexts of length k, dealt by whole runs; ``sums`` per context."""
    def ask(t: pa.Table) -> pa.Table:
        c = Chunk(t, model)
        names, inv, at = c.asked[k - 1]
        first = np.empty(len(names), np.int64)
        first[inv] = at
        n = np.bincount(inv, weights=c.train[c.here][at], minlength=len(names)).astype(np.int64)
        below, total = c.below(k)
        cols = (c.states[k - 1][first], n, below[first], total[first])
        return _rows(c.id, k, {b: [_pack(_steps(names[some])), *(_pack(x[some]) for x in cols)]
                               for b, some in _dealt(_range(names, model.buckets))})

    def add(t: pa.Table) -> pa.Table:
        parts = t.column("parts").to_pylist()
        keys = [np.cumsum(_unpack(x[0]), dtype=_U) for x in parts]
        state, n, below, total = (np.concatenate([_unpack(x[i]) for x in parts]).astype(np.int64) for i in range(1, 5))
        key, first, inv = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        n = np.bincount(inv, weights=n).astype(np.int64)
        at, state = np.unique(state[first], return_inverse=True)
        many, entries, kinds = _sums(state, n, len(at))
        seen = np.flatnonzero(n)
        q = below[first][seen] / total[first][seen]
        nkl = np.bincount(state[seen], weights=n[seen] * np.log(n[seen] / model.hot[k - 1].total[at][state[seen]] / q), minlength=len(at))
        over = np.flatnonzero(n > hot)
        sums = [dict(zip(("state", "many", "entries", "kinds", "nkl"), x, strict=True))
                for x in zip(at.tolist(), many.tolist(), entries.tolist(), kinds.tolist(), nkl.tolist(), strict=True)]
        cuts = np.cumsum([len(x) for x in keys])[:-1]
        return _answers(t, k, [[_pack(n[i])] for i in np.split(inv, cuts)], sums=sums,
                        over=[{"name": a, "n": x} for a, x in zip(signed(key[over]).tolist(), n[over].tolist(), strict=True)])

    asked = chunks.groupBy("chunk").applyInArrow(ask, _TOLD)
    return asked.groupBy("bucket").applyInArrow(add, _TOLD + (
        ", sums array<struct<state: int, many: long, entries: long, kinds: long, nkl: double>>, over array<struct<name: long, n: long>>"))


def _hot(over: list[tuple[int, int]]) -> Hot:
    names, total = np.array([n for n, _ in over], np.int64).view(_U), np.array([x for _, x in over], np.int64)
    order = np.argsort(names)
    return Hot(names[order], total[order])


def _tested(told: DataFrame, level: Hot) -> Hot:
    sums = told.select(F.inline("sums")).groupBy("state").agg(*(F.sum(c).alias(c) for c in ("many", "entries", "kinds", "nkl")))
    got = np.zeros((4, len(level.names)))
    for r in sums.collect():
        got[:, r["state"]] = r["many"], r["entries"], r["kinds"], r["nkl"]
    many, entries, kinds, nkl = got
    return Hot(level.names, level.total, True, many, entries, _kept(entries, kinds, nkl, level.total))


def ask_runs(t: pa.Table, model: Model) -> pa.Table:
    """A chunk's distinct runs: tokens, training places, counts of x, and what is known of hot contexts."""
    c = Chunk(t, model)
    c.runs()
    count, depth = c.c[c.here][c.first], c.depth[c.first]
    below, total = np.zeros(len(c.first), np.int64), np.zeros(len(c.first), np.int64)
    for k in range(1, min(len(model.hot), DEPTH - 1) + 1):
        some = depth == k
        below[some], total[some] = (x[c.first[some]] for x in c.below(k + 1))
    out = {}
    for b, s in c.buckets:
        _, x = np.unique(c.lo[s] & _LOW, return_index=True)
        known = depth[s] > 0
        out[b] = [*_pack_runs(c.hi[s], c.lo[s]), _pack(c.n[s]), _pack(count[s][x]), _pack(depth[s]), _pack(below[s][known]), _pack(total[s][known])]
    return _rows(c.id, ANSWER, out)


def smooth(t: pa.Table, total: int) -> pa.Table:
    """All contexts of a bucket: per chunk the counts of its runs, and of the states the counts of all entries, what else was seen, and the entries but one."""
    cols = [[] for _ in range(7)]
    for p in t.column("parts").to_pylist():
        hi, lo = _unpack_runs(p[:4])
        n, cx, depth, known_n, known_total = (_unpack(x).astype(np.int64) for x in p[4:])
        _, x = np.unique(lo & _LOW, return_inverse=True)
        below, of = np.zeros((2, len(hi)), np.int64)
        below[depth > 0], of[depth > 0] = known_n, known_total
        for to, a in zip(cols, (hi, lo, n, cx[x], depth, below, of), strict=True):
            to.append(a)
    cuts = np.cumsum([len(x) for x in cols[0]])[:-1]
    hi, lo, n, cx, depth, below, of = (np.concatenate(x) for x in cols)
    del cols
    inv, first, size = _distinct(hi, lo)
    n = np.bincount(inv, weights=n, minlength=size).astype(np.int64)
    own_hi, own_lo = hi[first], lo[first]
    cx, depth, below, of = cx[first], depth[first], below[first], of[first]
    x = own_lo & _LOW
    last_n, last_total = cx, np.full(len(first), max(total, 1))
    out = []
    for k, (there, head) in enumerate(zip((own_hi >> _U(32), own_hi & _LOW, own_lo >> _U(32)), _heads(own_hi, own_lo), strict=True), 1):
        some = np.flatnonzero((there != 0) & (depth < k))
        last_n, last_total = (np.where((depth == k - 1) & (depth > 0), a, b) for a, b in ((below, last_n), (of, last_total)))
        group = (np.cumsum(head) - 1)[some]
        size = int(head.sum())
        if k == DEPTH:
            run, of_run = np.arange(len(some)), group
        else:
            runs, run = np.unique(group.astype(_U) << _U(32) | x[some], return_inverse=True)
            of_run = (runs >> _U(32)).astype(np.int64)
        count = np.bincount(run, weights=n[some], minlength=len(of_run)).astype(np.int64)
        sums = np.bincount(group, weights=n[some], minlength=size).astype(np.int64)
        many, entries, kinds = _sums(of_run, count, size)
        seen = np.flatnonzero(n[some])
        rows, g = some[seen], group[seen]
        nkl = np.bincount(g, weights=n[rows] * np.log(count[run[seen]] / sums[g] / (last_n[rows] / last_total[rows])), minlength=size)
        kept = _kept(entries, kinds, nkl, sums)
        entry = np.zeros(len(first), np.int64)
        entry[some] = np.where(kept[group] & (count[run] >= MIN_COUNT), count[run], 0)
        # what is left of total and entries is mostly 0: contexts with one entry and nothing else
        out.append((entry, np.cumsum(head) - 1, *(np.where(kept, v, 0) for v in (many, sums - many, entries - 1))))
        last_n, last_total = last_n.copy(), last_total.copy()
        last_n[some], last_total[some] = count[run], sums[group]
    parts = []
    for i, h, w in zip(np.split(inv, cuts), np.split(hi, cuts), np.split(lo, cuts), strict=True):
        heads = _heads(h, w)
        parts.append([_pack(v) for (entry, group, *state), head in zip(out, heads, strict=True) for v in (entry[i], *(c[group[i[head]]] for c in state))])
    return _answers(t, ANSWER, parts)


def _smoothed(p: np.ndarray, n: np.ndarray, total: np.ndarray, many: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Probability by a state from that of its suffix; a total of 0: not retained."""
    of = np.maximum(total, 1)
    return np.where(total > 0, (1 - (many - DISCOUNT * entries) / of) * p + np.where(n >= MIN_COUNT, n - DISCOUNT, 0) / of, p)


def score(t: pa.Table, answers: pa.Table, model: Model, depth: int) -> pa.Table:
    c = Chunk(t, model, answers)
    c.runs()
    tree = Tree(model.total, model.kinds, [])
    p = tree.root(c.c[c.here][c.first])
    for k, level in enumerate(model.hot[:depth]):
        some = np.flatnonzero(c.depth[c.first] > k)
        at = c.states[k][c.first[some]]
        p[some] = _smoothed(p[some], c.seen[k][c.first[some]], np.where(level.kept, level.total, 0)[at], level.many[at], level.entries[at])
    for b, s in c.buckets:
        parts = iter([_unpack(x).astype(np.int64) for x in c.told.pop((ANSWER, b))])
        for k, head in enumerate(_heads(c.hi[s], c.lo[s])):
            group = np.cumsum(head) - 1
            n, many, others, more = (next(parts) for _ in range(4))
            if k < depth:
                p[s] = _smoothed(p[s], n, (many + others)[group], many[group], (more + 1)[group])
    full = np.zeros(len(c.c))  # the start is given
    full[c.here] = np.log10(p)[c.inv]
    base = np.log10(tree.root(c.c))
    real = np.zeros(len(c.c), bool)
    real[c.here] = True
    start = c.off[:-1]
    return pa.table({"doc_id": c.doc_id, "n_tokens": np.diff(c.off) - 1, "n_known": np.add.reduceat((c.c > 0) & real, start, dtype=np.int64),
                     "base_score": np.add.reduceat(base * real, start), "score": np.add.reduceat(full, start)})


@dataclass
class Level:
    states: np.ndarray   # sorted contexts
    rest: np.ndarray     # mass left for the suffix
    entries: np.ndarray  # sorted hashes of (context, next)
    share: np.ndarray    # discounted probability


@dataclass
class Tree:
    total: int
    kinds: int
    levels: list[Level]

    def root(self, c: np.ndarray) -> np.ndarray:
        return (c + 0.5) / (self.total + 0.5 * (self.kinds + 1))

    def smoothed(self, tokens: np.ndarray, off: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Probability of every place from its longest retained context; ``p``: root probabilities."""
        if not self.levels:
            return p
        for level, (h, ok) in zip(self.levels, contexts(tokens, off, len(self.levels)), strict=True):
            here = np.flatnonzero(ok)
            state, known = _lookup(level.states, h[here])
            here, state = here[known], state[known]
            entry, hit = _lookup(level.entries, _entry(h[here], tokens[here]))
            p[here] = level.rest[state] * p[here] + (np.where(hit, level.share[entry], 0.0) if len(level.entries) else 0.0)
        return p


def _unsigned(rows, name: str) -> np.ndarray:
    return np.array([r[name] for r in rows], dtype=np.int64).view(_U)


def _level(states, entries) -> Level:
    ctx = _unsigned(states, "context")
    order = np.argsort(ctx)
    ctx, total = ctx[order], np.array([r["total"] for r in states], dtype=np.float64)[order]
    own, nxt = _unsigned(entries, "context"), _unsigned(entries, "next")
    at, _ = _lookup(ctx, own)
    share = (np.array([r["n"] for r in entries], dtype=np.float64) - DISCOUNT) / (total[at] if len(ctx) else 1.0)
    rest = 1.0 - np.bincount(at, weights=share, minlength=len(ctx))[:len(ctx)] if len(own) else np.ones(len(ctx))
    key = _entry(own, nxt)
    order = np.argsort(key)
    return Level(ctx, rest, key[order], share[order])


def _add(table: BucketedTable, rows: DataFrame) -> DataFrame:
    """What chunks are told, written to them; the table with it."""
    table.append(rows.repartition(table.buckets, "chunk"))
    return table.rows()


def learned(docs: DataFrame, hot: int = HOT, bucket: int = BUCKET) -> tuple[DataFrame, Model]:
    """The chunks with what they are told of their tokens and hot contexts, and the model's totals."""
    table = BucketedTable(docs.sparkSession, "chunks", "chunk")  # later steps read a chunk's rows as they lie
    none = {"bucket": "int", "kinds": "long", "over": "array<struct<name: long, n: long>>",
            "sums": "array<struct<state: int, many: long, entries: long, kinds: long, nkl: double>>"}
    rows = coded(docs)
    rows = rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    filled = lambda df: df.select(*(c if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes))
    table.append(rows)
    chunks = table.rows()
    sizes = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    places, ends, size = (x or 0 for x in chunks.agg(F.sum("places"), F.sum("learned"), F.sum(sizes)).first())
    model = Model(int(size // bucket + 1), places - ends)
    chunks = _add(table, filled(count_tokens(chunks, model, hot)))
    model.kinds = chunks.agg(F.sum("kinds")).first()[0] or 0
    # START is followed as often as END comes
    over = [(r["name"], r["n"] or ends) for r in chunks.where(F.col("kind") == 0).select(F.inline("over")).collect()]
    for k in range(1, DEPTH + 1):
        over = [x for x in over if x[1] > hot]
        if not over:
            break
        model.hot.append(_hot(over))
        chunks = _add(table, filled(_tally(chunks, model, k, hot)))
        counted = chunks.where(F.col("kind") == k)
        model.hot[-1] = _tested(counted, model.hot[-1])
        over = [(r["name"], r["n"]) for r in counted.select(F.inline("over")).collect()]
    return chunks.select("chunk", "kind", "bucket", "parts", "doc_id", "train", "n"), model


def asked_runs(chunks: DataFrame, model: Model) -> DataFrame:
    return chunks.groupBy("chunk").applyInArrow(lambda t: ask_runs(t, model), _TOLD)


def scored(docs: DataFrame, depth: int = DEPTH, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    chunks, model = learned(docs, hot, bucket)
    total = model.total
    answers = asked_runs(chunks, model).groupBy("bucket").applyInArrow(lambda t: smooth(t, total), _TOLD)
    got = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda t, answers: score(t, answers, model, depth), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return got.select("doc_id", held_out(mod=5).alias("held_out"), "n_tokens", "n_known",
                      F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
