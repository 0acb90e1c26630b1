"""Alignment of two tokenizers against whole-text encoding and plain dictionaries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pagewright.llm import crosstoken
from pagewright.llm.crosstoken import Encoder, PerfectHash, Vocabularies


@pytest.fixture(scope="module")
def vocabularies():
    return Vocabularies()


def _texts():
    rnd = random.Random(13)
    words = ["the", "tokenizers", "don't", "café", "中文", "it's", "1234", "_x", "...", "<|endoftext|>", "</s>", "<unk>", "\U0001f600", "naïve"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", " \n ", " ", "\x1c", "\x85", "", " '"]
    out = ["".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    return out + [None, "", " ", "  ", "a", " a ", "▁", "x ▁ y", "a <|endoftext|> b", "word " * 30_000, "y" * 50_000, "\x00 \x01", "café", "café"]


def plain(v, text):
    """Ids and token ends of a whole text, or None where the bytes differ."""
    if not text:
        return None
    a, b = v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text)
    want = b" " + text.encode()
    if b"".join(v.a_bytes[i] for i in a) != want or b"".join(v.b_bytes[i] for i in b) != want:
        return None
    ends = lambda ids, table: np.cumsum([len(table[i]) for i in ids]).tolist()
    return a, b, ends(a, v.a_bytes), ends(b, v.b_bytes)


def brute(v, texts):
    rows, counts = [], Counter()
    for t in texts:
        p = plain(v, t)
        if p is None:
            rows.append(None)
            continue
        a, b, ea, eb = p
        both, groups, i, j, links = sorted(set(ea) & set(eb)), [], 0, 0, []
        for e in both:
            ga, gb = [], []
            while i < len(a) and ea[i] <= e:
                ga.append(a[i])
                i += 1
            while j < len(b) and eb[j] <= e:
                gb.append(b[j])
                j += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            links.append((ga[-1], gb[-1]))
        counts.update(links)
        rows.append((len(a), len(b), links, ";".join(groups)))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, links, text = r
        out.append((na, nb, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_memoised_ids_are_those_of_the_whole_text(vocabularies):
    assert vocabularies.cuts
    texts = _texts()
    enc = Encoder(vocabularies)
    got = enc.encode(texts[:100]) + enc.encode(texts[100:])
    for t, (a, b) in zip(texts, got, strict=True):
        p = plain(vocabularies, t)
        want = ([], []) if p is None else p[:2]
        assert (np.frombuffer(a, enc.width).tolist(), np.frombuffer(b, enc.width).tolist()) == want, t


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 50_000))
    h = PerfectHash(keys)
    assert sorted(h.index(keys).tolist()) == list(range(len(keys)))
    assert (h.index(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()
    assert PerfectHash(keys[:0]).index(keys[:3]).tolist() == [-1, -1, -1]


def test_aligned_counts(spark, vocabularies, monkeypatch):
    monkeypatch.setattr(crosstoken, "FAN", 2)  # several levels of the tree
    texts = _texts()
    texts.append(texts[3])
    rows = [(i if i else None, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, a string, node string").repartition(5)
    got = crosstoken.aligned_counts(docs).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {(i if i else None): w for i, w in enumerate(brute(vocabularies, texts))}
    assert len(got) == len(rows)
    assert crosstoken.aligned_counts(docs.limit(0)).collect() == []


def test_pairs_are_bounded_by_the_vocabularies(spark, vocabularies):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    width = Encoder(vocabularies).width
    ids = crosstoken.encoded(docs)
    n = crosstoken.distinct_pairs(ids, vocabularies.lengths(), width).count()
    assert 0 < n <= vocabularies.pair_bound() == 324_300
