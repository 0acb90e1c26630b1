"""Alignment of two tokenizers' tokens (dealt operator 13).

Tokenizer A is a byte-level BPE, tokenizer B a piece BPE with byte fallback; both read a space and
the text. The ends of their tokens, as byte offsets, cut a text into groups where both end; a
link is a pair of an A and a B token that end together.

Method. Each text is tokenised once and its ids are written as a table. Three passes align the
stored ids again: the first finds the distinct pairs of linked ids, the second counts, the third
looks counts up. The distinct pairs get a minimal perfect hash (levels of bit arrays: a pair that
is alone in its slot of a level is settled there, the rank of its bit is its index; the others go
to the next level), so counts are dense vectors with one entry per pair. A task adds its documents
up in one vector; the vectors, cut into segments, are summed as a tree, ``FAN`` to a node. A lookup
compares the pair stored at the index, so a foreign pair is never taken for a known one.

Bound of what is broadcast: two linked tokens end at the same byte, so the bytes of one are a
suffix of the other's. The number of distinct pairs is therefore bounded by the two vocabularies
alone (324,300 for the default ones, ``Vocabularies.pair_bound``), however large the corpus is.

Tokenising. Neither tokenizer joins characters across a single space between two characters that
are not white space (``Vocabularies`` tests that no piece of B spans one), so a text is cut there
and parts already seen by a task are taken from a bounded memo; the result is that of the whole text.

Defined cases: NULL and empty texts, and texts whose joined token bytes differ from space and text
(such as those that hold U+2581), have no tokens: zeros and an empty digest. Repeated rows count as
often as they occur; NULL ids are kept; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.arrowtext import mix, regrouped
from pagewright.session import materialize

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FAN = 16
SEGMENT = 1 << 13
MEMO_PARTS = 1 << 17
MEMO_BYTES = 64
JOINED = 64
BLOCK = 2 << 20

_PART = re.compile(r"(?<=\S) (?=\S)")


# -- vocabularies ---------------------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers and the bytes of every token, by id."""

    def __init__(self, a_file: str = A_FILE, b_file: str = B_FILE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(a_file))
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_file))
        letters = _byte_letters()
        with open(public_tokenizers.path(a_file), encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        # special tokens are never emitted: no bytes
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry if c in letters)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            hex_ = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes([int(hex_[1], 16)]) if hex_ else piece.replace("▁", " ").encode())
        #: whether a text may be cut before a single space
        self.cuts = not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return (np.array([len(x) for x in self.a_bytes], np.int64), np.array([len(x) for x in self.b_bytes], np.int64))

    def pair_bound(self) -> int:
        """How many id pairs have one token's bytes as a suffix of the other's."""
        from collections import Counter
        a, b = Counter(filter(None, self.a_bytes)), Counter(filter(None, self.b_bytes))
        inside = sum(n * b[x[j:]] for x, n in a.items() for j in range(len(x)) if x[j:] in b)
        return inside + sum(n * a[x[j:]] for x, n in b.items() for j in range(1, len(x)) if x[j:] in a)


class Encoder:
    """Ids of texts by both tokenizers, as bytes of unsigned numbers; parts of texts are memoised."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.width = "<u2" if max(len(self.v.a_bytes), len(self.v.b_bytes)) <= 1 << 16 else "<u4"
        self.a_len, self.b_len = self.v.lengths()
        self._forget()

    def _forget(self) -> None:
        self.a_memo: dict[str, bytes] = {}
        self.b_memo: dict[str, bytes] = {}
        self.odd: set[str] = set()  # memoised parts whose token bytes differ from space and part

    def _agrees(self, a_ids, b_ids, text: str) -> bool:
        want = b" " + text.encode()
        return b"".join([self.v.a_bytes[i] for i in a_ids]) == want and b"".join([self.v.b_bytes[i] for i in b_ids]) == want

    def _learn(self, parts: list[str]) -> None:
        """Memoise the ids of parts; those without outer white space go to A in rows of many."""
        rows = [p for p in parts if self.v.cuts and not (p[:1].isspace() or p[-1:].isspace())]
        alone = list(set(parts).difference(rows))
        parts = rows + alone
        told = [" " + " ".join(rows[i:i + JOINED]) for i in range(0, len(rows), JOINED)] + [" " + p for p in alone]
        spelt = [b" " + p.encode() for p in parts]
        ends = np.cumsum([len(x) for x in spelt])
        a_ids = list(itertools.chain.from_iterable([e.ids for e in self.v.a.encode_batch(told, add_special_tokens=False)]))
        b_lists = self.v.b.encode(parts, num_threads=1)
        b_ids = list(itertools.chain.from_iterable(b_lists))
        a, b = np.array(a_ids, self.width), np.array(b_ids, self.width)
        a_end = np.cumsum(self.a_len[a])
        a_cut = np.searchsorted(a_end, ends) + 1
        b_cut = np.cumsum([len(x) for x in b_lists])
        if b"".join([self.v.a_bytes[i] for i in a_ids]) != b"".join(spelt) or not np.array_equal(a_end[a_cut - 1], ends):
            raise ValueError("the first tokenizer does not keep bytes, or joins characters across a space")
        # equal bytes in all and equal ends of every part: every part agrees
        if b"".join([self.v.b_bytes[i] for i in b_ids]) != b"".join(spelt) or not np.array_equal(
                np.concatenate([[0], np.cumsum(self.b_len[b])])[b_cut], ends):
            self.odd.update(p for p, x, ids in zip(parts, spelt, b_lists, strict=True) if b"".join([self.v.b_bytes[i] for i in ids]) != x)
        size = int(self.width[-1])
        for memo, ids, cut in ((self.a_memo, a, a_cut), (self.b_memo, b, b_cut)):
            raw, cut = ids.tobytes(), (cut * size).tolist()
            memo.update(zip(parts, [raw[x:y] for x, y in zip([0, *cut[:-1]], cut, strict=True)], strict=True))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        split = _PART.split if self.v.cuts else lambda t: [t]
        cut = [split(t) if t else [] for t in texts]
        if len(self.a_memo) > MEMO_PARTS:
            self._forget()
        unseen = list(set().union(*cut).difference(self.a_memo))
        for i in range(0, len(unseen), 1 << 14):
            self._learn(unseen[i:i + (1 << 14)])
        out = []
        for text, parts in zip(texts, cut, strict=True):
            a, b = b"".join(map(self.a_memo.__getitem__, parts)), b"".join(map(self.b_memo.__getitem__, parts))
            if self.odd and not self.odd.isdisjoint(parts) and not self._agrees(
                    np.frombuffer(a, self.width), np.frombuffer(b, self.width), text):
                a = b = b""
            out.append((a, b))
        for p in unseen:  # very long parts are not kept
            if len(p) > MEMO_BYTES:
                del self.a_memo[p], self.b_memo[p]
                self.odd.discard(p)
        return out


def encoded(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``doc_id, a, b``: the ids of every text by both tokenizers (map-only), packed as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(Vocabularies(a_file, b_file))
        for b in regrouped(batches, BLOCK):
            ids = enc.encode(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").combine_chunks().cast(pa.int64()), pa.array([x for x, _ in ids], pa.binary()),
                 pa.array([x for _, x in ids], pa.binary())], ["doc_id", "a", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, a binary, b binary")


# -- alignment ------------------------------------------------------------------------------------

@dataclass
class Aligned:
    """A block of documents on one byte axis; document ``i`` owns ``a[a_off[i]:a_off[i + 1]]``."""

    a: np.ndarray
    b: np.ndarray
    a_off: np.ndarray
    b_off: np.ndarray
    a_last: np.ndarray   # index in a of each link's A token, ascending: the last of its group
    b_last: np.ndarray


def align(block: pa.Table, a_len: np.ndarray, b_len: np.ndarray, width: str) -> Aligned:
    """Both tokenizers read the same bytes, so the documents of a block stay on one axis."""
    def flat(name):
        col = block.column(name)
        lens = np.array([len(x.as_buffer()) for chunk in col.chunks for x in chunk], np.int64) // int(width[-1])
        raw = b"".join([x.as_buffer() for chunk in col.chunks for x in chunk])
        return np.frombuffer(raw, width), np.concatenate([[0], np.cumsum(lens)])

    a, a_off = flat("a")
    b, b_off = flat("b")
    a_end, b_end = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    shared = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, bool)
    shared[b_end] = True
    a_last = np.flatnonzero(shared[a_end])
    return Aligned(a, b, a_off, b_off, a_last, np.searchsorted(b_end, a_end[a_last]))


def pair_codes(al: Aligned) -> np.ndarray:
    return (al.a[al.a_last].astype(np.int64) << 32) | al.b[al.b_last].astype(np.int64)


# -- minimal perfect hash -------------------------------------------------------------------------

class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, which are kept to verify lookups."""

    def __init__(self, keys: np.ndarray, room: float = 2.0):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.keys = np.zeros(len(keys), np.int64)
        left, base, level = np.asarray(keys, np.int64), 0, 0
        while len(left):
            size = max(1, int(room * len(left)))
            slot = self._slots(left, level, size)
            alone = np.bincount(slot, minlength=size) == 1
            rank = base + np.cumsum(alone, dtype=np.int64) - 1
            settled = alone[slot]
            self.keys[rank[slot[settled]]] = left[settled]
            self.levels.append((size, alone, rank.astype(np.int32)))
            base += int(settled.sum())
            left, level = left[~settled], level + 1

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        return (mix(keys.view(np.uint64) ^ seed) % np.uint64(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for keys that were not hashed."""
        out = np.full(len(keys), -1, np.int64)
        at = np.arange(len(keys))
        for level, (size, alone, rank) in enumerate(self.levels):
            if not len(at):
                break
            slot = self._slots(keys[at], level, size)
            hit = alone[slot]
            out[at[hit]] = rank[slot[hit]]
            at = at[~hit]
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        out[~known] = -1
        return out


# -- the three passes -----------------------------------------------------------------------------

def distinct_pairs(ids: DataFrame, lens, width: str) -> DataFrame:
    """First pass: the distinct linked id pairs, deduplicated per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for block in regrouped(batches, BLOCK):
            seen = np.union1d(seen, pair_codes(align(block, *lens, width)))
        for i in range(0, len(seen), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(seen[i:i + (1 << 16)])], ["pair"])

    return ids.select("a", "b").mapInArrow(run, "pair long").distinct()


def count_vectors(ids: DataFrame, hashed, lens, width: str) -> DataFrame:
    """Second pass: one dense vector per task, in segments ``(segment, node, counts)``; node = task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: PerfectHash = hashed.value
        total = np.zeros(len(pairs.keys), np.int64)
        for block in regrouped(batches, BLOCK):
            total += np.bincount(pairs.index(pair_codes(align(block, *lens, width))), minlength=len(total))
        ctx = TaskContext.get()
        node = ctx.partitionId() if ctx else 0
        for s in range(0, len(total), SEGMENT):
            part = total[s:s + SEGMENT]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s // SEGMENT]), pa.array([node]), pa.array([part.tobytes()], pa.binary())],
                    ["segment", "node", "counts"])

    return ids.select("a", "b").mapInArrow(run, "segment long, node long, counts binary")


def tree_sum(vectors: DataFrame, nodes: int) -> DataFrame:
    """One vector per segment: ``FAN`` nodes at a time are added into one, until one is left."""
    def add(group: pa.Table) -> pa.Table:
        total = None
        for x in group.column("counts"):
            v = np.frombuffer(x.as_buffer(), np.int64)
            total = v.copy() if total is None else total + v
        return pa.table({"segment": group.column("segment")[:1], "node": group.column("node")[:1],
                         "counts": pa.array([total.tobytes()], pa.binary())})

    while nodes > 1:
        vectors = vectors.withColumn("node", F.floor(F.col("node") / FAN)).groupBy("segment", "node").applyInArrow(
            add, "segment long, node long, counts binary")
        nodes = -(-nodes // FAN)
    return vectors


def _texts(n: int, ending: str) -> np.ndarray:
    return np.array([f"{i}{ending}" for i in range(n)], dtype=object)


def looked_up(ids: DataFrame, table, lens, width: str) -> DataFrame:
    """Third pass: per document its groups, links, and the corpus-wide counts of its links."""
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = table.value
        best_of = np.zeros(len(lens[1]), np.int64)
        np.maximum.at(best_of, pairs.keys & 0xFFFFFFFF, counts)
        best = counts == best_of[pairs.keys & 0xFFFFFFFF]
        a_texts, b_texts = [_texts(len(lens[0]), e) for e in ",|"], [_texts(len(lens[1]), e) for e in ",;"]
        for block in regrouped(batches, BLOCK):
            al = align(block, *lens, width)
            at = pairs.index(pair_codes(al))
            n_groups = np.diff(np.searchsorted(al.a_last, al.a_off))
            edge = np.concatenate([[0], np.cumsum(n_groups)])
            sums = np.concatenate([[0], np.cumsum(counts[at])])
            bests = np.concatenate([[0], np.cumsum(best[at])])
            line = _group_line(al, a_texts, b_texts)
            size = np.diff(al.a_off) + np.diff(al.b_off)
            spot = np.concatenate([[0], np.cumsum(size)]).tolist()
            digests = [hashlib.sha256("".join(line[x:y])[:-1].encode()).hexdigest() if y > x else ""
                       for x, y in zip(spot[:-1], spot[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), *[pa.array(v, pa.int64()) for v in (
                    np.diff(al.a_off), np.diff(al.b_off), n_groups, n_groups, np.diff(bests[edge]), np.diff(sums[edge]))],
                 pa.array(digests, pa.string())],
                [f.split()[0] for f in schema.split(", ")])

    return ids.mapInArrow(run, schema)


def _group_line(al: Aligned, a_texts, b_texts) -> list[str]:
    """All ids of a block as text, group by group, A's before B's, each with its separator."""
    group = lambda last, n: np.cumsum(np.bincount(last + 1, minlength=n + 1)[:n])
    a_group, b_group = group(al.a_last, len(al.a)), group(al.b_last, len(al.b))
    line = np.empty(len(al.a) + len(al.b), dtype=object)
    # before a token: the tokens of its own kind, and the other kind's up to the group's start or end
    b_before = np.concatenate([[0], al.b_last + 1])
    a_at = np.arange(len(al.a)) + b_before[a_group]
    b_at = np.arange(len(al.b)) + (al.a_last + 1)[b_group]
    a_text, b_text = a_texts[0][al.a], b_texts[0][al.b]
    a_text[al.a_last] = a_texts[1][al.a[al.a_last]]
    b_text[al.b_last] = b_texts[1][al.b[al.b_last]]
    line[a_at] = a_text
    line[b_at] = b_text
    return line.tolist()


def pair_counts(ids: DataFrame, vocabularies: Vocabularies, width: str):
    """``(PerfectHash, counts)`` of all linked pairs: bounded by the vocabularies, see above."""
    spark, lens = ids.sparkSession, vocabularies.lengths()
    found = distinct_pairs(ids, lens, width).toArrow().column("pair").to_numpy()
    pairs = PerfectHash(np.sort(found))
    hashed = spark.sparkContext.broadcast(pairs)
    vectors = materialize(count_vectors(ids, hashed, lens, width), "pair_vectors")
    nodes = vectors.agg(F.max("node")).first()[0]
    counts = np.zeros(len(found), np.int64)
    for row in tree_sum(vectors, 0 if nodes is None else nodes + 1).toLocalIterator():
        part = np.frombuffer(row["counts"], np.int64)
        counts[row["segment"] * SEGMENT:row["segment"] * SEGMENT + len(part)] = part
    hashed.unpersist()
    return pairs, counts


def aligned_counts(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Per document: tokens, groups, links, links that are their B id's most frequent, their counts."""
    vocabularies = Vocabularies(a_file, b_file)
    width = Encoder(vocabularies).width
    ids = materialize(encoded(docs, a_file, b_file), "token_ids", compression="zstd")
    table = docs.sparkSession.sparkContext.broadcast(pair_counts(ids, vocabularies, width))
    return looked_up(ids, table, vocabularies.lengths(), width)
