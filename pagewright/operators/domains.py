"""Registrable domains by a public suffix *table* (SC2, PRJ10, TRV4).

A rule names a public suffix: ``com.sg``; ``*.ck``, any label below ``ck``; ``!www.ck``, an exception
to it. Of the rules that a host ends with the longest one holds, an exception beats all and stands for
its own parent, and a host without a rule has its last label as suffix. The registrable domain
is the suffix and one label more; a host that is itself a suffix has none.

The lookup goes label by label from the right: the last n labels of a host, for n up to the longest
rule, are joined with the table, so there is one equi-join per length and no row grows. A table
below ``BROADCAST_BYTES`` (measured, not assumed) is broadcast, so the hosts do not move; a larger one
is joined as Spark sees fit.

Defined cases: case and a trailing dot do not matter; addresses (IPv4, or in brackets) are their own
domain; NULL, empty and malformed hosts (empty labels) have none; repeated rules count once; other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.session import materialize

BROADCAST_BYTES = 8 << 20


def suffix_table(rules: DataFrame, rule: str = "rule") -> DataFrame:
    """``key, exact, below, exception``: one row per name that rules speak of."""
    r = F.lower(F.trim(F.col(rule)))
    name = F.regexp_replace(r, r"^(!|\*\.)", "")
    rows = rules.select(name.alias("key"), (~r.rlike(r"^(!|\*\.)")).alias("exact"), r.startswith("*.").alias("below"),
                        r.startswith("!").alias("exception")).filter(F.col("key") != "")
    return rows.groupBy("key").agg(*[F.max(c).alias(c) for c in ("exact", "below", "exception")])


def with_registrable(df: DataFrame, host: Column, rules: DataFrame, suffix: str = "public_suffix",
                     domain: str = "registrable") -> DataFrame:
    """``df`` with the public suffix and the registrable domain of ``host`` (NULL where there is none)."""
    table = materialize(suffix_table(rules), "suffixes")
    size = table.agg(F.sum(F.octet_length("key") + 16).alias("bytes"), F.max(F.size(F.split("key", r"\."))).alias("labels")).first()
    side = F.broadcast(table) if (size["bytes"] or 0) <= BROADCAST_BYTES else table

    h = F.regexp_replace(F.lower(host), r"\.$", "")
    address = h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") | h.startswith("[")
    usable = h.rlike(r"^[^.]+(\.[^.]+)*$") & ~address
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), h.alias("_host"), address.alias("_address"),
                  F.when(usable, F.split(h, r"\.")).alias("_labels"))
    count = F.size("_labels")
    tail = lambda n: F.array_join(F.slice("_labels", count - n + 1, n), ".")
    found = []
    for n in range(1, (size["labels"] or 0) + 1):
        hit = side.select(F.col("key").alias(f"_k{n}"), F.struct("exact", "below", "exception").alias(f"_r{n}"))
        d = d.withColumn(f"_t{n}", F.when(count >= n, tail(F.lit(n)))).join(hit, F.col(f"_t{n}") == F.col(f"_k{n}"), "left").drop(f"_t{n}", f"_k{n}")
        found += [(F.col(f"_r{n}")["exception"], n - 1, True), (F.col(f"_r{n}")["exact"], n, False),
                  (F.col(f"_r{n}")["below"] & (count > n), n + 1, False)]
    longest = lambda rules_: F.greatest(F.lit(0), F.lit(0), *[F.when(F.coalesce(test, F.lit(False)), n).otherwise(0) for test, n in rules_])
    # an exception stands for its parent's labels, and two of one host nest: the longest holds
    excepted = longest([(test, n) for test, n, exception in found if exception])
    ruled = longest([(test, n) for test, n, exception in found if not exception])
    n = F.when(excepted > 0, excepted).when(ruled > 0, ruled).otherwise(1)
    d = d.withColumn("_n", F.when(F.col("_labels").isNotNull(), n))
    return d.select(*[F.col("_row")[c].alias(c) for c in df.columns if c not in (suffix, domain)],
                    F.when(F.col("_n").isNotNull(), tail(F.col("_n"))).alias(suffix),
                    F.when(F.coalesce("_address", F.lit(False)), F.col("_host"))
                    .when(count > F.col("_n"), tail(F.col("_n") + 1)).alias(domain))
