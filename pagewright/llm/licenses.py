"""License scan with a positional rare-token index (dealt operator 6, DataFrame functions only).

The templates below are cut into words; their *postings* say in which template and at which place
each word stands. Over the corpus:

1. document frequencies of the template words give their IDF (over all documents);
2. the file's occurrences of each template's highest-IDF key word (its rare token) are looked up;
   each proposes a start = place in the text minus place in the template;
3. the postings of all template words are intersected at those starts by relative position: the
   mandatory key phrase must stand there word for word, and a longer template needs at least
   ``MIN_SHARE`` of its words, weighted by IDF, in place. Base phrases are key phrases throughout.

Every occurrence of a key phrase holds its rare token, so no place is lost.

Only template words ever leave the scan: each document's distinct ones for the document frequencies,
and those of documents with an anchor with their places; the postings are a
constant-size table. Votes are grouped per document and start, never per template over documents.

Defined cases: NULL text is empty (0 words); empty tables give empty results; overlapping or
repeated phrases count each place; repeated rows of one doc_id are told apart by their text; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.session import materialize

# Base phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# The method's own templates: (label, text, mandatory key phrase). Words of public licence notices.
TEMPLATES = (
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "hereby granted free of charge"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0-notice", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-grant", "you can redistribute it and or modify it under the terms of the gnu general public license",
     "redistribute it and or modify it"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms"),
    ("cc-by-nc-notice", "licensed under cc by nc", "cc by nc"),
    ("cc-by-grant", "licensed under a creative commons attribution", "creative commons attribution"),
    ("mpl-2.0-notice", "subject to the terms of the mozilla public license", "mozilla public license"),
)
MIN_SHARE = 0.75

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _templates():
    """``(id, label, base, words, key start, key length)``."""
    out = [(i, label, True, p.split(), 0, len(p.split())) for i, (p, label) in enumerate(BASE.items())]
    for label, text, key in TEMPLATES:
        w, k = text.split(), key.split()
        at = next(j for j in range(len(w)) if w[j:j + len(k)] == k)
        out.append((len(out), label, False, w, at, len(k)))
    return out


def postings(spark: SparkSession) -> DataFrame:
    """Constant-size table: ``word, template, place, is_key`` of every template word."""
    rows = [(w, t, j, at <= j < at + k) for t, _, _, words, at, k in _templates() for j, w in enumerate(words)]
    return spark.createDataFrame(rows, "word string, template int, place int, is_key boolean")


def template_table(spark: SparkSession) -> DataFrame:
    rows = [(t, label, base, len(words), k) for t, label, base, words, _, k in _templates()]
    return spark.createDataFrame(rows, "template int, label string, base boolean, n_template int, n_key int")


def word_hits(docs: DataFrame) -> DataFrame:
    """Per document: ``row_id, doc_id, n_words, known, hits array<struct<place, word>>``.

    ``known`` are the distinct template words of any document; ``hits`` are those of documents with an
    anchor: the longest word of some mandatory key phrase, so a document without one has no candidate.
    """
    vocabulary = sorted({w for t in _templates() for w in t[3]})
    anchors = sorted({max(words[at:at + k], key=len) for _, _, _, words, at, k in _templates()})
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    # splitting leaves an empty entry before a leading and behind a trailing separator
    words = F.filter(F.split("low", SEPARATOR), lambda x: x != "")
    d = docs.select("doc_id", low.alias("low")).select("doc_id", words.alias("w"))
    d = d.withColumn("known", F.array_intersect("w", F.array(*map(F.lit, vocabulary))))
    inside = F.transform("w", lambda x, i: F.when(x.isin(vocabulary), F.struct(i.alias("place"), x.alias("word"))))
    none = F.array().cast("array<struct<place:int,word:string>>")
    return d.select(F.expr("uuid()").alias("row_id"), "doc_id", F.size("w").cast("long").alias("n_words"),
                    "known", F.when(F.arrays_overlap("known", F.array(*map(F.lit, anchors))), F.filter(inside, lambda x: x.isNotNull())).otherwise(none).alias("hits"))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row."""
    spark = docs.sparkSession
    rows = materialize(word_hits(docs), "hits")
    n_docs = rows.count()
    hits = rows.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("h")).select("row_id", "h.place", "h.word")
    seen = rows.select(F.explode("known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    # every broadcast below is bounded by the templates: at most one row per template word
    post = postings(spark).join(seen, "word").withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)) + 1)
    post = materialize(post.withColumnRenamed("place", "at"), "postings")
    rare = (post.where("is_key").groupBy("template").agg(F.max_by(F.struct("word", "at"), F.struct("idf", "at")).alias("r"))
            .select("template", "r.word", "r.at"))
    starts = (hits.join(F.broadcast(rare), "word")
              .select("row_id", "template", (F.col("place") - F.col("at")).alias("start")).distinct())
    votes = (hits.join(F.broadcast(post), "word")
             .select("row_id", "template", (F.col("place") - F.col("at")).alias("start"), "is_key", "idf"))
    met = votes.join(starts, ["row_id", "template", "start"], "left_semi").groupBy("row_id", "template", "start").agg(
        F.count(F.lit(1)).alias("n_met"), F.sum(F.col("is_key").cast("int")).alias("n_key_met"), F.sum("idf").alias("weight"))
    # a template word that no document holds weighs as one of document frequency 0
    idf = post.select("word", "idf").distinct()
    weights = (postings(spark).join(idf, "word", "left")
               .groupBy("template").agg(F.sum(F.coalesce("idf", F.log(F.lit(n_docs + 1.0)) + 1)).alias("all_weight")))
    met = met.join(F.broadcast(template_table(spark).join(weights, "template")), "template")
    found = met.where("n_key_met = n_key").withColumn("share", F.least(F.col("weight") / F.col("all_weight"), F.lit(1.0)))
    base = F.col("base")
    found = found.where(base | (F.col("share") >= MIN_SHARE))
    per = found.groupBy("row_id").agg(
        F.sum(base.cast("long")).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    return rows.select("row_id", "doc_id", "n_words").join(per, "row_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
