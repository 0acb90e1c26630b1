"""Repeated-run removal over lines by winnowing (dealt operator 3, DataFrame functions only).

A document's lines are hashed; in every window of ``run`` consecutive lines the least hash (the
rightmost of equals) is selected as a *fingerprint*. Two equal runs of at least ``run`` lines select
the same fingerprints, wherever they stand (the winnowing guarantee). So:

1. per document (one projection, no shuffle): line hashes, window minima and their places;
2. the places are joined on the fingerprint: windows whose fingerprint has one place only are left out;
3. matches are extended both ways: each window around a repeated fingerprint is keyed by all its
   lines, and its first occurrence (by doc_id, then position) is found by a pre-aggregated minimum;
   windows that match an earlier one overlap into runs that reach as far left and right as the texts
   agree;
4. the lines of later runs are deleted; the first occurrence stays.

Every occurrence is compared with the first one only, so a group of n copies costs n rows.

With ``words`` given, a run of fewer lines that holds so many words is a window, too, and its own
fingerprint; so long passages on one or two lines go as well (the query and the pipeline's stage).

Defined cases: NULL text stays NULL (0 lines); the empty text is one empty line; a text of fewer
than ``run`` lines is changed by such shorter windows only; lines are compared byte for byte; repeated rows of one doc_id
with equal text share their decisions; rows without doc_id stay as they are; an empty table
gives an empty result; extra columns are kept, whatever their names, but for ``n_lines`` and
``n_deleted``, which ``dedup_lines`` replaces (``clean`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.names import free_names
from pagewright.session import materialize

RUN = 3
#: words of a shorter run that count as much as ``RUN`` lines
LONG_WORDS = 50


def windows(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """``doc_id, s, m, fp, p, h, h2``: each window's start, lines, fingerprint, its place, and the window's key."""
    lines = F.split("text", "\n", -1)
    d = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.transform(lines, lambda x: F.xxhash64(x)).alias("l"), *(
        [F.transform(lines, lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")] if words else []))
    if not words:
        d = d.where(F.size("l") >= run)
    at = lambda s: F.slice("l", s + 1, run)
    each = F.transform(F.sequence(F.lit(0), F.size("l") - run), lambda s: F.struct(
        s.alias("s"), F.lit(run).alias("m"), F.array_min(at(s)).alias("fp"),
        (s + run - F.array_position(F.reverse(at(s)), F.array_min(at(s)))).cast("int").alias("p"),
        F.xxhash64(at(s)).alias("h"), F.hash(at(s)).alias("h2")))
    if words:
        none = F.array().cast("array<struct<s:int,m:int,fp:bigint,p:int,h:bigint,h2:int>>")
        each = F.concat(F.when(F.size("l") >= run, each).otherwise(none), *(
            F.when(F.size("l") >= m, _short(m, words)).otherwise(none) for m in range(1, run)))
    return d.select("doc_id", F.explode(each).alias("w")).select("doc_id", "w.*")


def _short(m: int, words: int):
    """The windows of ``m`` lines of at least ``words`` words."""
    at = lambda s: F.slice("l", s + 1, m)
    enough = lambda s: sum((F.get("n", s + i) for i in range(1, m)), F.get("n", s)) >= words
    return F.transform(F.filter(F.sequence(F.lit(0), F.size("l") - m), enough), lambda s: F.struct(
        s.alias("s"), F.lit(m).alias("m"), F.xxhash64(at(s), F.lit(m)).alias("fp"), s.alias("p"),
        F.xxhash64(at(s)).alias("h"), F.hash(at(s)).alias("h2")))


def repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """``doc_id, gone array<int>``: 0-based places of the lines that later runs cover."""
    all_ = materialize(windows(docs, run, words), "windows")
    place = F.xxhash64("doc_id", "p")
    often = all_.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("fp")
    near = all_.join(often, "fp", "left_semi")
    first = near.groupBy("fp", "m", "h", "h2").agg(F.min(F.struct("doc_id", "s")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").drop("n")
    later = near.join(first, ["fp", "m", "h", "h2"]).where("struct(doc_id, s) > first").select("doc_id", "s", "m")
    cover = later.select("doc_id", F.sequence("s", F.col("s") + F.col("m") - 1).alias("c"))
    return cover.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_set("c"))).alias("gone"))


def _counted(docs: DataFrame, run: int, words: int | None) -> tuple[DataFrame, str, str]:
    """``docs`` rid of later runs, and the names of two columns added: lines before, lines deleted."""
    id_, gone_, lines_, n_lines, n_deleted = free_names(docs, "_id", "_gone", "_lines", "_n_lines", "_n_deleted")
    gone = repeated_lines(docs, run, words).select(F.col("doc_id").alias(id_), F.col("gone").alias(gone_))
    d = docs.join(gone, F.col("doc_id") == F.col(id_), "left").withColumn(lines_, F.split("text", "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines_) - 1), F.col(gone_))
    text = F.array_join(F.transform(left, lambda i: F.get(lines_, i)), "\n")
    none = F.col("text").isNull()
    return d.select(*[f"`{c}`" for c in docs.columns if c != "text"],
                    F.when(F.col(gone_).isNotNull(), text).otherwise(F.col("text")).alias("text"),
                    F.when(none, 0).otherwise(F.size(lines_)).cast("long").alias(n_lines),
                    F.when(none, 0).otherwise(F.coalesce(F.size(gone_), F.lit(0))).cast("long").alias(n_deleted)), n_lines, n_deleted


def dedup_lines(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` rid of later runs, ``n_lines`` and ``n_deleted``."""
    out, n_lines, n_deleted = _counted(docs, run, words)
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in ("text", "n_lines", "n_deleted")]
    return out.select(*kept, "text", F.col(n_lines).alias("n_lines"), F.col(n_deleted).alias("n_deleted"))


def clean(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """The documents with later runs deleted; one whose every line was deleted goes."""
    out, n_lines, n_deleted = _counted(docs, run, words)
    return out.where((F.col(n_deleted) == 0) | (F.col(n_deleted) < F.col(n_lines))).select(*[f"`{c}`" for c in docs.columns])
