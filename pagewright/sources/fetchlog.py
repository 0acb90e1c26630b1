"""Fetch results as data.

The test tables hold no real crawl outcomes, so two tables are *derived* from them with fixed
rules (the oracle SQL derives the same rows independently):

``fetch_log`` - one fetch attempt per ``events`` row: error events are failures; status code,
error message, redirect, response headers and crawl statistics follow from ``props.k``.

``batch_requests`` - the URL list of a batch crawl: one request per ``view`` event, batch =
user; the URL is the corpus page whose page_id equals ``props.k`` when such a page exists, else
a URL that no snapshot holds (so the left join yields a failure row, never a dropped row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import urls as U
from pagewright.sources.tables import table

# Fixed values of the derivation rules.
ERROR_MESSAGES = ("Connection timeout", "DNS resolution failed", "SSL handshake error",
                  "Blocked by anti-bot protection:\n  status 403\n  see call log")
BLOCK_REASONS = ("HTTP 429 Too Many Requests", "Challenge page\n  detected after load ", "")
MISSING_URL_PREFIX = "https://missing.example.org/page/"


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def fetch_url():
    """URL of the fetch attempt an ``events`` row stands for (works on streams too)."""
    return F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example.org/item/"),
                    _k().cast("string"))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = _k()
    err = F.col("event_type") == "error"
    url = fetch_url()
    status = (F.when(err, F.when(k % 3 == 1, F.lit(429)).when(k % 3 == 2, F.lit(503)))
              .when((F.col("event_type") == "click") & (F.col("value") >= 100), F.lit(404))
              .otherwise(F.lit(200)))
    msg = F.when(err, F.element_at(F.array(*[F.lit(m) for m in ERROR_MESSAGES]), (k % 4 + 1).cast("int")))
    redirected = F.when(k % 5 == 0, F.concat(url, F.lit("/login"))).when(k % 5 == 1, url)
    redirected_code = F.when((k % 5 == 0) & (k % 2 == 0), F.lit(302))
    headers = (F.when(k % 7 == 0, F.create_map(F.lit("Retry-After"), (k * 10).cast("string"),
                                               F.lit("Content-Type"), F.lit("text/html")))
               .when(k % 7 == 1, F.create_map(F.lit("retry-after"), F.lit(" 60\n seconds ")))
               .otherwise(F.create_map(F.lit("Content-Type"), F.lit("text/html"))))
    reasons = F.array(*[F.lit(r) for r in BLOCK_REASONS])
    attempts_log = F.transform(
        F.sequence(F.lit(1), k % 3 + 1),
        lambda i: F.struct(
            F.concat(F.lit("proxy"), i.cast("string")).alias("proxy"),
            F.lit(429).alias("status_code"),
            ((k + i) % 2 == 0).alias("blocked"),
            F.when((k + i) % 3 == 1, F.concat(F.element_at(reasons, 2), F.repeat(F.lit("x"), k * 3)))
            .otherwise(F.element_at(reasons, ((k + i) % 3 + 1).cast("int"))).alias("reason")))
    stats = F.when(k % 6 != 5, F.struct(
        F.when(k % 10 != 9, k % 3 + 1).alias("attempts"),
        F.when(k % 4 == 3, k % 3).otherwise(F.lit(0)).alias("retries"),
        attempts_log.alias("proxies_used"),
        (k % 8 < 2).alias("fallback_fetch_used"),
        F.when(k % 8 == 0, F.lit("fallback_fetch")).alias("resolved_by")))
    out = ev.select(
        "event_id", F.col("user_id").alias("batch_id"), url.alias("url"), (~err).alias("success"),
        status.alias("status_code"), msg.alias("error_message"), redirected.alias("redirected_url"),
        redirected_code.alias("redirected_status_code"), headers.alias("response_headers"),
        stats.alias("crawl_stats"), F.col("ts").alias("fetched_at"))
    return out.withColumn("host", U.host("url"))


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = (table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
          .select("event_id", "user_id", _k().alias("k")))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("k"), F.col("url").alias("page_url"))
    req = ev.join(pages, "k", "left")
    return req.select(
        F.col("user_id").alias("batch_id"), F.col("event_id").alias("seq"),
        F.coalesce("page_url", F.concat(F.lit(MISSING_URL_PREFIX), F.col("k").cast("string"))).alias("url"))
