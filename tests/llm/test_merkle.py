"""Merkle manifest against a plain recursive construction that keeps every level."""

import hashlib
import random
import zlib

import pytest

from pagewright.llm import merkle


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, cut=False):
    doc_id, source, lang, n_chars, text = row
    text = text.replace("\n", "") if cut and text is not None else text
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def steps(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 3 * 3:at // 3 * 3 + 3]
        out.append(("".join(run[:at % 3]), "".join(run[at % 3 + 1:])))
        at //= 3
    return out


def brute(rows):
    null_first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (null_first(r[0]), leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in per[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for at, r in enumerate(per[s]):
            path = steps(trees[s], at) + steps(top, k)
            node = leaf(r, cut=r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0)
            for a, b in path:
                node = H(a + node + b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return out


def rows_of(sizes):
    rnd, rows, doc_id = random.Random(12), [], 0
    for source, n in sizes.items():
        for _ in range(n):
            doc_id += rnd.randint(1, 3)
            text = rnd.choice([None, "", "a\nb", "é中\n\n", "plain", "x" * 50 + "\n"])
            rows.append((doc_id, source, rnd.choice([None, "en"]), rnd.choice([None, 5, -7]), text))
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long"


@pytest.mark.parametrize("sizes", [{None: 5, "": 1, "a": 95, "Z": 28, "é": 27, "b": 2, "c": 82, "=": 3}, {"only": 1}, {"only": 30},
                                   {f"s{k:03}": 1 + k % 2 for k in range(31)}])
def test_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    if None in sizes:
        rows += [rows[7], rows[7], (rows[8][0], "a", "other", None, "same id"), (None, "a", None, None, "t\n"), (None, "a", None, None, None)]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA).repartition(3)
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_only_changed_texts_fail(spark):
    rows = rows_of({"a": 40, "b": 40})
    got = merkle.manifest(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()
    bad = {r.doc_id for r in got if not r.verified}
    assert bad == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[4] or "")} and bad


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_stored_levels(spark):
    """Only every third level is stored; what lies between is hashed anew for the proofs."""
    nodes = [H(str(i)) for i in range(100)]
    rows = spark.createDataFrame([("t", 5, i, n) for i, n in enumerate(nodes)], "tree string, up int, pos long, node string")
    forest = merkle.build(rows, 5)
    full = tree(nodes)
    assert [sorted((r.pos, r.node) for r in level.collect()) for level in forest.stored] == [
        list(enumerate(full[k])) for k in (0, 3, 5)]
    got = {r.pos: [tuple(s) for s in r.path] for r in merkle.proofs(forest).collect()}
    assert got == {i: steps(full, i) for i in range(100)}
