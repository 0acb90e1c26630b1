"""Merkle manifest of a table with checkpoint-and-recompute proofs (dealt operator 12).

Method. Each source's rows, ordered by id, are the leaves of a tree of arity 3; the sources' roots,
ordered by name, are the leaves of another one. Only every ``EVERY``-th level of a tree is stored: a
stored node and the ``ARITY ** EVERY`` stored descendants below it form an aligned subtree. Building
reads one stored level, groups it by subtree and folds each subtree inside its row, so the levels in
between exist only there. Proof extraction goes from the top down: the stored nodes of a subtree come
together again in one row, the missing interior nodes are hashed anew from them, each member's siblings
are emitted behind those of its subtree's own proof, and the interior nodes are discarded with the
row. A proof is never shuffled for each leaf: it travels once per subtree.

Scale. Leaves shuffle as digests (not texts): once for their positions (``prefix.row_number``, so a
source with a third of all rows is cut), once for building and once for the proofs. A subtree has at most 27 members whatever the data. The driver sees the greatest number of leaves of a
source and of sources (two numbers) and the root. Nothing is broadcast but what Spark's own size
check lets pass.

Defined cases: a row's leaf covers all five columns, NULL or not; rows with the same id are ordered
by their leaf, equal rows keep as many leaves (any of them first: the digests are the same); NULL ids come first, and
count as not tampered with; the NULL source comes first; a source of one row has its leaf as
subroot, a table of one source its subroot as root; a proof without siblings is the digest of the empty text; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators import prefix
from pagewright.session import materialize

ARITY = 3
EVERY = 3
PATH = "array<struct<left:string,right:string>>"
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(columns: dict[str, Column] | None = None) -> Column:
    """Digest of a row: each value as ``-`` (NULL) or its byte count, ``:`` and itself."""
    parts = []
    for name in LEAF_COLUMNS:
        v = (columns or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return digest(F.concat(*parts))


def tampered() -> Column:
    """Whether the row's text loses its line breaks before its proof is folded again."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, altered``: the leaf, and the row's leaf as tampered with, where it differs."""
    bare = leaf_digest({"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    changed = tampered() & F.col("text").contains("\n")
    return docs.select("doc_id", "source", leaf_digest().alias("leaf"), F.when(changed, bare).alias("altered"))


# -- one tree per group ----------------------------------------------------------------------------

def folds(nodes: Column) -> Column:
    """How many levels stand above that many nodes: least h with ARITY ** h >= nodes."""
    powers = [ARITY ** h for h in range(1, 40)]
    return F.size(F.filter(F.array(F.lit(1).cast("long"), *[F.lit(p) for p in powers]), lambda p: p < nodes))


def level_above(level: Column) -> Column:
    """The digests of every ARITY consecutive nodes of an array."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda r: digest(F.array_join(F.slice(level, r * ARITY + 1, ARITY), "")))


def _subtrees(stored: DataFrame, carried: list[str] = ()) -> DataFrame:
    """One row per aligned subtree: its stored nodes in order, and how many levels it spans."""
    d = stored.groupBy("tree", "up", F.floor(F.col("pos") / ARITY ** EVERY).alias("sub")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", *carried))).alias("members"))
    return d.select("tree", "up", "sub", "members", F.transform("members", lambda m: m["node"]).alias("level0"),
                    F.least(F.lit(EVERY), F.col("up")).alias("span"))


def _interior(subtrees: DataFrame) -> DataFrame:
    """The levels of a subtree, hashed anew from its stored nodes (columns ``level0 ..``)."""
    for k in range(EVERY):
        here = F.col(f"level{k}")
        subtrees = subtrees.withColumn(f"level{k + 1}", F.when(F.col("span") > k, level_above(here)).otherwise(here))
    return subtrees


@dataclass
class Forest:
    """Trees by ``tree``; ``stored[t]`` holds ``tree, up, pos, node`` of level ``t * EVERY``.

    ``up`` is the number of levels above the stored one; a tree is in every level it reaches, the
    last of which holds its root (``up`` 0).
    """

    stored: list[DataFrame]

    def roots(self) -> DataFrame:
        ended = [level.filter("up = 0").select("tree", F.col("node").alias("root")) for level in self.stored]
        return functools.reduce(DataFrame.unionByName, ended)


def build(nodes: DataFrame, height: int) -> Forest:
    """Stored levels over ``tree, up, pos, node`` rows; ``height``: the greatest ``up``."""
    stored = [nodes]
    for _ in range(-(-height // EVERY)):
        done = _interior(_subtrees(stored[-1].filter("up > 0")))
        nxt = done.select("tree", (F.col("up") - F.col("span")).alias("up"), F.col("sub").alias("pos"),
                          F.col(f"level{EVERY}")[0].alias("node"))
        stored.append(materialize(nxt, "merkle_level"))
    return Forest(stored)


def _steps(k_max: int) -> Column:
    """A member's siblings in its subtree, level by level: ``left`` and ``right`` of its own node."""
    steps = []
    for k in range(k_max):
        at = F.floor(F.col("at") / ARITY ** k).cast("int")
        first = (F.floor(at / ARITY) * ARITY).cast("int")
        level = F.col(f"level{k}")
        steps.append(F.struct(F.array_join(F.slice(level, first + 1, at - first), "").alias("left"),
                              F.array_join(F.slice(level, at + 2, F.lit(ARITY - 1) - (at - first)), "").alias("right")))
    return F.slice(F.array(*steps), F.lit(1), F.col("span"))


def proofs(forest: Forest, carried: list[str] = (), onward: DataFrame | None = None) -> DataFrame:
    """``tree, pos, node, root, path array<struct<left, right>>`` of every leaf, from the top down.

    ``carried`` columns of the leaves come along. ``onward`` (``tree, onward, top``) continues the
    proofs above the trees' roots: it joins one row per tree, not one per leaf.
    """
    above = None
    for t, stored in reversed(list(enumerate(forest.stored))):
        extra = list(carried) if t == 0 else []
        here = ["tree", "pos", "node", *extra]
        ended = stored.filter("up = 0").select(*here, F.col("node").alias("root"))
        if onward is None:
            ended = ended.select("*", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("top"))
        else:
            ended = ended.join(onward, "tree").select(*here, "root", F.col("onward").alias("path"), "top")
        if above is not None:
            # the subtree's own proof comes once per subtree; interior nodes are hashed anew
            subs = _interior(_subtrees(stored.filter("up > 0"), extra))
            subs = subs.join(above.select("tree", F.col("pos").alias("sub"), "root", "path", "top"), ["tree", "sub"])
            members = subs.select("*", F.explode(F.sequence(F.lit(0), F.size("members") - 1)).alias("at"))
            members = members.withColumn("mine", F.get("members", F.col("at")))
            ended = ended.unionByName(members.select(
                "tree", *[F.col("mine")[c].alias(c) for c in here[1:]], "root",
                F.concat(_steps(EVERY), F.col("path")).alias("path"), "top"))
        above = ended
    return above


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


# -- the manifest -----------------------------------------------------------------------------------

def manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and the root that its (tampered) row leads to."""
    # '' stands for the NULL source, '=' precedes a name: the same order, and no NULL in a join
    named = leaves(docs).withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    rows = prefix.running_count(named.drop("source"), ["tree"], ["doc_id", "leaf"], out="pos", total="n")
    rows = materialize(rows.select("tree", folds(F.col("n")).alias("up"), (F.col("pos") - 1).alias("pos"),
                                   F.col("leaf").alias("node"), "doc_id", "altered"), "merkle_leaves")
    by_source = build(rows, rows.agg(F.max("up")).first()[0] or 0)

    subroots = prefix.row_number(by_source.roots().withColumn("one", F.lit("")), ["one"], ["tree"], out="pos")
    subroots = materialize(subroots.select(F.col("tree").alias("name"), (F.col("pos") - 1).alias("pos"),
                                           F.col("root").alias("node")), "merkle_subroots")
    n_sources = subroots.count()
    up = next(h for h in range(64) if ARITY ** h >= n_sources)
    top = build(subroots.select(F.lit("").alias("tree"), F.lit(up).alias("up"), "pos", "node", "name"), up)
    onward = proofs(top, ["name"]).select(F.col("name").alias("tree"), F.col("path").alias("onward"), F.col("root").alias("top"))

    found = proofs(by_source, ["doc_id", "altered"], onward)
    path = F.col("path")
    out = found.select("doc_id", F.col("node").alias("leaf"), F.col("root").alias("subroot"), F.col("top").alias("root"),
                       digest(siblings(path)).alias("proof_sha256"),
                       fold(F.coalesce("altered", "node"), path).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
