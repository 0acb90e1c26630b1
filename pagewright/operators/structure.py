"""Structural joins over the node table: which nodes enclose which, without ancestor arrays.

A node's subtree is the interval ``pre .. last`` of its page, with ``last = post + depth`` (Grust
2002), and two intervals are nested or disjoint. The stack-tree join (Al-Khalifa et al. 2002) merges
the ancestors and descendants of a page in document order and keeps a stack of the open ancestors.
Here the stack is two window passes over the merged rows, one shuffle by page:

* every ancestor is a start (+1 at ``pre``) and an end (-1 behind ``last``), and the running sum is the
  height of the stack, at a start and at each descendant;
* the j-th entry of the stack is the last start of height j, so a descendant below ``n`` open
  ancestors takes one row for each height up to ``n`` and reads the last start of that height.

The work is linear in the rows and the result; a page's rows are sorted in one task, as everywhere.
Equal ancestors (one node for several contexts) are entries of their own. Columns of the caller's
rows travel in structs, so their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = "page_id"


def last() -> Column:
    """``pre`` of the last node in a node's subtree."""
    return F.col("post") + F.col("depth")


def _heights(rows: DataFrame, tests: int, or_self: bool) -> DataFrame:
    """Starts and inner rows of every page (``_at, _kind``) with the open outer rows per test.

    ``rows``: ``page_id, pre, last, _out, _in`` (a row is outer, inner or both; the other struct is
    NULL) and ``_t0 ..``, whether an outer row belongs to each family. One scan, one shuffle by page.
    """
    out, in_ = F.col("_out"), F.col("_in")
    mine = [F.when(out.isNotNull() & F.col(f"_t{i}"), 1).otherwise(0) for i in range(tests)]

    def event(at: Column, kind: int, sign: int, with_out: bool, with_in: bool) -> Column:
        return F.struct(at.cast("long").alias("_at"), F.lit(kind).alias("_kind"), F.lit(with_out).alias("o"), F.lit(with_in).alias("i"),
                        *[(d * sign).alias(f"_d{i}") for i, d in enumerate(mine)])

    # a node that is outer itself comes before its own start, or behind it; ends come last
    events = F.filter(F.array(
        F.when(out.isNotNull(), event(F.col("pre"), 1, 1, True, False)),
        F.when(out.isNotNull(), event(F.col("last"), 3, -1, False, False)),
        F.when(in_.isNotNull(), event(F.col("pre"), 2 if or_self else 0, 0, False, True))), lambda e: e.isNotNull())
    m = rows.select(PAGE, "_out", "_in", F.explode(events).alias("e"))
    m = m.select(PAGE, "e._at", "e._kind", F.when(F.col("e.o"), out).alias("_out"), F.when(F.col("e.i"), in_).alias("_in"),
                 *[F.col(f"e._d{i}") for i in range(tests)])
    sofar = Window.partitionBy(PAGE).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return m.select("*", *[F.sum(f"_d{i}").over(sofar).alias(f"_open{i}") for i in range(tests)]).filter("_kind <> 3")


def _of_height() -> Window:
    return Window.partitionBy(PAGE, "_height").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)


def pairs(outer: DataFrame, inner: DataFrame, or_self: bool = False) -> DataFrame:
    """``_out, _in``: the rows of ``outer`` (``page_id, pre, last, ..``) and ``inner`` (``page_id, pre, ..``)
    as structs, one row for each pair with the inner node in the outer node's subtree."""
    outs, ins = F.struct(*outer.columns), F.struct(*inner.columns)
    kind = lambda df, c: df.select(c.alias("s")).schema["s"].dataType
    rows = outer.select(PAGE, "pre", "last", outs.alias("_out"), F.lit(None).cast(kind(inner, ins)).alias("_in"), F.lit(True).alias("_t0"))
    rows = rows.unionByName(inner.select(PAGE, "pre", F.col("pre").alias("last"), F.lit(None).cast(kind(outer, outs)).alias("_out"),
                                         ins.alias("_in"), F.lit(False).alias("_t0")))
    m = _heights(rows, 1, or_self)
    heights = F.when(F.col("_kind") == 1, F.array("_open0")).when(F.col("_open0") > 0, F.sequence(F.lit(1).cast("long"), "_open0"))
    m = m.select(PAGE, "_at", "_kind", "_out", "_in", F.explode(heights).alias("_height"))
    return m.withColumn("_out", F.last("_out", ignorenulls=True).over(_of_height())).filter("_kind <> 1").select("_out", "_in")


def enclosing(rows: DataFrame, wanted: Column, inside: dict[str, Column] | None = None,
              nearest: dict[str, tuple[Column, Column]] | None = None, or_self: bool = False) -> DataFrame:
    """The ``wanted`` rows with, per name in ``inside``, whether a row that passes the test encloses
    the node, and, per name in ``nearest``, the value of the innermost such row (NULL if there is none).

    ``rows`` needs ``page_id, pre, last`` and is read once; tests and values are its columns. Linear
    in the rows: nothing is repeated per ancestor.
    """
    inside, nearest = inside or {}, nearest or {}
    tests = [*inside.values(), *[test for test, _ in nearest.values()]]
    passed = [F.coalesce(t, F.lit(False)).alias(f"_t{i}") for i, t in enumerate(tests)]
    some = F.lit(False)
    for t in tests:
        some = some | F.coalesce(t, F.lit(False))
    values = F.struct(F.lit(0).alias("z"), *[v.alias(f"v{i}") for i, (_, v) in enumerate(nearest.values())])
    d = rows.select(PAGE, "pre", "last", F.when(some, values).alias("_out"),
                    F.when(F.coalesce(wanted, F.lit(False)), F.struct(*rows.columns)).alias("_in"), *passed)
    m = _heights(d.filter("_out IS NOT NULL OR _in IS NOT NULL"), len(tests), or_self)
    for i in range(len(nearest)):
        k = len(inside) + i
        starts = (F.col("_kind") == 1) & (F.col(f"_d{k}") == 1)
        # an outer row of another family has no height in this one
        m = m.withColumn("_height", F.when((F.col("_kind") != 1) | starts, F.col(f"_open{k}")).otherwise(-1))
        found = F.last(F.when(starts, F.struct(F.col("_out")[f"v{i}"].alias("v"))), ignorenulls=True).over(_of_height())
        m = m.withColumn(f"_near{i}", F.when(F.col("_height") > 0, found["v"]))
    return m.filter("_in IS NOT NULL").select(
        "_in.*", *[(F.col(f"_open{i}") > 0).alias(k) for i, k in enumerate(inside)], *[F.col(f"_near{i}").alias(k) for i, k in enumerate(nearest)])
