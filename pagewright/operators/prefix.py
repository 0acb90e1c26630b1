"""Distributed prefix scan: exact per-key sequence computations without one task per key.

``f() OVER (PARTITION BY keys ORDER BY order)`` sorts all rows of a key in one task. Here a key with
more than ``rows / (PIECES_PER_TASK * tasks)`` rows is cut along its order into pieces of about that
many rows, at split points taken from a sample of its own rows: dense, sparse, hashed or bursty
orders are cut alike. A piece is a window partition of its own (one shuffle by key and piece);
an associative summary of each piece of the cut keys is aggregated with map-side combine, one scan
over the pieces turns the summaries into what each piece receives from those before it, and
the rows of the piece are finished with that. Keys below the limit are one piece and need no summary.

Sizes: keys above the limit, their split points and their piece summaries number at most a small
multiple of ``PIECES_PER_TASK * tasks``, whatever the data; these tables alone are broadcast.

``order`` must be unique within a key (add an id): rows equal in it stay in one piece, in any order.
NULLs in keys and order are values like others, the least ones in the order. The split points come
from a hash of the order, not from a random number, so a repeated task cuts at the same places;
``written=False`` reads the input several times and is for inputs that are cheap and deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import cut_lineage

PIECES_PER_TASK = 32
SAMPLES_PER_PIECE = 20
LEAST_PIECE = 64
_HASHES = 1 << 20


def piece_rows(df: DataFrame, tasks: int) -> int:
    """Rows that a piece should hold: a small share of what each task gets."""
    return max(LEAST_PIECE, df.count() // (PIECES_PER_TASK * tasks))


def split_points(d: DataFrame, limit: int) -> DataFrame:
    """``_key, _cuts``: ascending split points of every key with more than ``limit`` rows."""
    hot = d.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("_key")
    share = min(1.0, SAMPLES_PER_PIECE / limit)
    sample = d.select("_key", "_ord").filter(F.pmod(F.xxhash64("_ord"), F.lit(_HASHES)) < int(share * _HASHES) + 1)
    sample = sample.join(F.broadcast(hot), "_key")  # at most PIECES_PER_TASK keys per task
    w = Window.partitionBy("_key").orderBy("_ord")
    cuts = sample.withColumn("_i", F.row_number().over(w)).filter(F.col("_i") % SAMPLES_PER_PIECE == 0)
    cuts = cuts.groupBy("_key").agg(F.array_sort(F.collect_set("_ord")).alias("_cuts"))
    # written: read by every later step, and its plan must not be evaluated with other rows
    return cut_lineage(hot.join(cuts, "_key", "left").select(
        "_key", F.coalesce("_cuts", F.array().cast(cuts.schema["_cuts"].dataType)).alias("_cuts")), "split_points")


def _at_or_below(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are <= ``value``: binary search inside the row."""
    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        open_, right = acc["lo"] < acc["hi"], F.get(cuts, mid) <= value
        return F.struct(F.when(open_ & right, mid + 1).otherwise(acc["lo"]).cast("int").alias("lo"),
                        F.when(open_ & ~right, mid).otherwise(acc["hi"]).cast("int").alias("hi"))

    start = F.struct(F.lit(0).cast("int").alias("lo"), F.size(cuts).cast("int").alias("hi"))
    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(cuts).cast("long"))))
    return F.aggregate(rounds, start, halve)["lo"]


class Pieces:
    """Rows of ``df`` with their piece; ``local`` is the window over one piece."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str | Column], written: bool = True):
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order = [F.col(c) if isinstance(c, str) else c for c in order]
        # the caller's columns travel in a struct, so none can clash with those of the scan
        d = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                      F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("_key"),
                      F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_ord"))
        if written:
            d = cut_lineage(d, "scanned")
        cuts = split_points(d, piece_rows(d, tasks))
        d = d.join(F.broadcast(cuts), "_key", "left")  # bounded, see above
        hot = F.col("_cuts").isNotNull()
        d = d.withColumn("_piece", F.when(hot, _at_or_below(F.col("_cuts"), F.col("_ord"))).otherwise(F.lit(0)))
        self.columns = df.columns
        self.rows = d.withColumn("_hot", hot).drop("_cuts")
        self.local = Window.partitionBy("_key", "_piece").orderBy("_ord")
        self.whole = Window.partitionBy("_key", "_piece")
        self.between = Window.partitionBy("_key").orderBy("_piece")

    def summaries(self, *aggregates: Column, rows: DataFrame | None = None) -> DataFrame:
        """One row per piece of the cut keys (aggregated before the shuffle)."""
        return (self.rows if rows is None else rows).filter("_hot").groupBy("_key", "_piece").agg(*aggregates)

    def receive(self, rows: DataFrame, per_piece: DataFrame) -> DataFrame:
        """``rows`` with the columns of ``per_piece``: NULL for keys of one piece."""
        return rows.join(F.broadcast(per_piece), ["_key", "_piece"], "left")  # bounded, see above

    def finish(self, rows: DataFrame, **out: Column) -> DataFrame:
        return rows.select(*[F.col("_row")[c].alias(c) for c in self.columns if c not in out], *[v.alias(k) for k, v in out.items()])

    def before(self, column: str, kind=F.sum) -> Column:
        """Of all earlier pieces of the key: the sum (or another aggregate) of a summary column."""
        return kind(column).over(self.between.rowsBetween(Window.unboundedPreceding, -1))


def row_number(df: DataFrame, keys: list[str], order: list[str | Column], out: str = "rn", written: bool = True) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)``."""
    p = Pieces(df, keys, order, written)
    sizes = p.summaries(F.count(F.lit(1)).alias("_n"))
    d = p.receive(p.rows.withColumn("_rn", F.row_number().over(p.local)),
                  sizes.select("_key", "_piece", p.before("_n").alias("_off")))
    return p.finish(d, **{out: (F.coalesce("_off", F.lit(0)) + F.col("_rn")).cast("long")})


def running_count(df: DataFrame, keys: list[str], order: list[str | Column], out: str = "done", total: str | None = "total",
                  written: bool = True) -> DataFrame:
    """Rows of the key so far, and of the whole key."""
    p = Pieces(df, keys, order, written)
    sizes = p.summaries(F.count(F.lit(1)).alias("_n"))
    per = sizes.select("_key", "_piece", p.before("_n").alias("_off"), F.sum("_n").over(Window.partitionBy("_key")).alias("_all"))
    d = p.rows.withColumn("_rn", F.row_number().over(p.local)).withColumn("_here", F.count(F.lit(1)).over(p.whole))
    values = {out: (F.coalesce("_off", F.lit(0)) + F.col("_rn")).cast("long")}
    if total:
        values[total] = F.coalesce("_all", "_here").cast("long")
    return p.finish(p.receive(d, per), **values)


def running_sum(df: DataFrame, keys: list[str], order: list[str | Column], value: str, out: str, written: bool = True) -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``."""
    p = Pieces(df, keys, order, written)
    value = F.col("_row")[value]
    per = p.summaries(F.sum(value).alias("_t")).select("_key", "_piece", p.before("_t").alias("_off"))
    d = p.receive(p.rows.withColumn("_s", F.sum(value).over(p.local.rowsBetween(Window.unboundedPreceding, 0))), per)
    both = F.col("_s").isNotNull() & F.col("_off").isNotNull()
    return p.finish(d, **{out: F.when(both, F.col("_s") + F.col("_off")).otherwise(F.coalesce("_s", "_off"))})


def lag(df: DataFrame, keys: list[str], order: list[str | Column], value: str, out: str, written: bool = True) -> DataFrame:
    """``lag(value) OVER (PARTITION BY keys ORDER BY order)``."""
    p = Pieces(df, keys, order, written)
    value = F.col("_row")[value]
    last = p.summaries(F.max_by(F.struct(value.alias("v")), "_ord").alias("_last"))
    per = last.select("_key", "_piece", F.lag("_last").over(p.between)["v"].alias("_prev"))
    d = p.rows.withColumn("_lag", F.lag(value).over(p.local)).withColumn("_first", F.row_number().over(p.local) == 1)
    return p.finish(p.receive(d, per), **{out: F.when(F.col("_first"), F.col("_prev")).otherwise(F.col("_lag"))})


def sessions(df: DataFrame, keys: list[str], order: list[str | Column], time: str, gap: int, out: str = "session_no",
             written: bool = True) -> DataFrame:
    """Number of the run of rows whose ``time`` steps are below ``gap``, from 1, per key.

    One scan carries both summaries of a piece: its first and last time (whether its first row
    starts a session is known only from the piece before) and the starts at its other rows.
    """
    p = Pieces(df, keys, order, written)
    started = lambda here, before: (before.isNull() | (here - before >= F.lit(gap))).cast("long")
    # starts at the rows of a piece behind its first one
    inner = F.when(F.row_number().over(p.local) > 1, started(F.col("_t"), F.lag("_t").over(p.local))).otherwise(F.lit(0))
    rows = p.rows.withColumn("_t", F.col("_row")[time])
    hot = rows.filter("_hot").select("_key", "_piece", "_ord", "_hot", "_t").withColumn("_in", inner)
    per = p.summaries(F.sum("_in").alias("_in"), F.min_by(F.struct("_t"), "_ord").alias("_a"),
                      F.max_by(F.struct("_t"), "_ord").alias("_z"), rows=hot)
    per = per.withColumn("_head", started(F.col("_a")["_t"], F.lag("_z").over(p.between)["_t"]))
    per = per.select("_key", "_piece", "_head", (F.col("_in") + F.col("_head")).alias("_starts"))
    per = per.select("_key", "_piece", (F.coalesce(p.before("_starts"), F.lit(0)) + F.col("_head")).alias("_off"))
    d = rows.withColumn("_in", inner)
    d = d.withColumn("_run", F.sum("_in").over(p.local.rowsBetween(Window.unboundedPreceding, 0)))
    # a key of one piece starts its first session at its first row
    return p.finish(p.receive(d, per), **{out: (F.coalesce("_off", F.lit(1)) + F.col("_run")).cast("long")})


def extremes_before(df: DataFrame, keys: list[str], order: list[str | Column], written: bool = True, **out: tuple) -> DataFrame:
    """Per column of ``out``, given as ``(value, F.max or F.min)``: that of the key's rows before this one.

    ``max(value) OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)``
    """
    p = Pieces(df, keys, order, written)
    made = [(name, kind(F.col("_row")[value]), kind) for name, (value, kind) in out.items()]
    per = p.summaries(*[agg.alias(f"_t{i}") for i, (_, agg, _) in enumerate(made)])
    per = per.select("_key", "_piece", *[p.before(f"_t{i}", kind).alias(f"_off{i}") for i, (_, _, kind) in enumerate(made)])
    before = p.local.rowsBetween(Window.unboundedPreceding, -1)
    d = p.receive(p.rows.select("*", *[agg.over(before).alias(f"_m{i}") for i, (_, agg, _) in enumerate(made)]), per)
    # greatest and least pass over NULLs
    return p.finish(d, **{name: (F.greatest if kind is F.max else F.least)(f"_m{i}", f"_off{i}") for i, (name, _, kind) in enumerate(made)})
