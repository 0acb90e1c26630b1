"""Driver queries for sinks (SNK1-SNK5, RES11) and structured-output operators (EXT6-EXT15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions.text import safe_filename
from pagewright.operators.blocks import density_prune, fit_or_raw, page_blocks, page_markdown_fit_raw
from pagewright.operators.extract import NO_MATCH_FMT
from pagewright.operators.parse import html_nodes
from pagewright.operators.results import success_first_rank
from pagewright.operators.sinks import manifest, persist, read_pages, sink_dir, with_file_names
from pagewright.operators.structured import (GENERIC_PROVIDER_ERROR, MALFORMED_FMT, NOT_RECORDS_FMT, chunk_text,
                                             conversation_calls, empty_structured, extraction_error,
                                             normalize_payload, token_usage)
from pagewright.plans.catalog import register
from pagewright.session import materialize
from pagewright.plans.content_plans import BLOCKS_CTE
from pagewright.plans.fetch_results import REQUESTS_SQL, _batch_results
from pagewright.sources.tables import table

FILE_SQL = ("coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), "
            "'[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 180), ''), 'page') || '_' || left(sha256(url), 8) || '.md'")


@register("filenames", f"SELECT page_id, url, {FILE_SQL} AS file FROM pages")
def filenames(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", safe_filename(F.col("url")).alias("file"))


@register("manifest", f"""
WITH {REQUESTS_SQL.strip()},
ranked AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY NOT success, seq) AS rn FROM res)
SELECT batch_id, CAST(rn AS BIGINT) AS entry_no,
       CASE WHEN success THEN json_object('url', url, 'file', {FILE_SQL}, 'success', true)::VARCHAR
            ELSE json_object('url', url, 'success', false, 'error', error)::VARCHAR END AS entry
FROM ranked
""")
def manifest_q(spark, sf_dir):
    res = success_first_rank(_batch_results(spark, sf_dir), "batch_id", "seq")
    res = with_file_names(res.withColumnRenamed("error", "error_message"))
    return manifest(res, "rank", keys=("batch_id",)).select(
        "batch_id", F.col("entry_no").cast("long").alias("entry_no"), "entry")


@register("sink_roundtrip", f"""
WITH {BLOCKS_CTE.strip()},
md AS (
  SELECT page_id, string_agg(md, chr(10) || chr(10) ORDER BY grp, ord) AS raw,
         coalesce(string_agg(md, chr(10) || chr(10) ORDER BY grp, ord) FILTER (WHERE kept), '') AS fit
  FROM blocks_k GROUP BY page_id
)
SELECT {FILE_SQL} AS file, p.url, CAST(length(coalesce(nullif(md.fit, ''), md.raw, '')) AS BIGINT) AS chars
FROM pages p LEFT JOIN md ON md.page_id = p.page_id
""")
def sink_roundtrip(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    blocks = density_prune(page_blocks(html_nodes(pages, container_text=False)))
    res = pages.select("page_id", "url", F.col("html").isNotNull().alias("success"),
                       F.lit(None).cast("string").alias("error_message")) \
        .join(page_markdown_fit_raw(blocks), "page_id", "left") \
        .withColumn("content", fit_or_raw(F.coalesce("fit", F.lit("")), F.col("raw"))) \
        .withColumn("rank", F.col("page_id"))
    out_dir = sink_dir(spark)
    res = materialize(res, "crawl")
    # two different crawls into one folder that share a third of their pages (SNK5: additive)
    for part in (res.where("page_id % 3 < 2"), res.where("page_id % 3 > 0")):
        _, note = persist(part, out_dir)
        if note:
            raise RuntimeError(note)
    back = read_pages(spark, out_dir)
    return back.select("file", "url", F.length("content").cast("long").alias("chars"))


PAYLOAD_SQL = """
p AS (
  SELECT doc_id,
    CASE doc_id % 6
      WHEN 0 THEN '[{"doc":' || doc_id || ',"grade":' || quality || '},{"flag":' || toxic || ',"doc":null}]'
      WHEN 1 THEN '{"doc":' || doc_id || ',"grade":{"of":5,"is":' || quality || '}}'
      WHEN 2 THEN '[]'
      WHEN 3 THEN '[{"doc":' || doc_id || ','
      WHEN 4 THEN CASE doc_id % 5 WHEN 0 THEN doc_id || '.5' WHEN 2 THEN 'true' ELSE '"row ' || doc_id || '"' END
      ELSE '[null,{"doc":' || doc_id || '},[7],"row"]' END AS payload,
    CASE WHEN toxic = 1 THEN '[{"part":1,"error":true,"content":" quota used up at row ' || doc_id || ' "},{"error":true}]'
         WHEN quality = 0 THEN '[{"error":false,"content":"12 rows read"}]'
         WHEN quality = 1 THEN '{"error":true,"content":"  "}'
         ELSE '[{"error":' || quality || ',"content":"a grade, no flag"}]' END AS llm
  FROM labels
)"""


def _payloads(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    d = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 6
    grade, flag = F.col("quality").cast("string"), F.col("toxic").cast("string")
    scalar = (F.when(F.col("doc_id") % 5 == 0, F.concat(d, F.lit(".5"))).when(F.col("doc_id") % 5 == 2, F.lit("true"))
              .otherwise(F.concat(F.lit('"row '), d, F.lit('"'))))
    payload = (F.when(kind == 0, F.concat(F.lit('[{"doc":'), d, F.lit(',"grade":'), grade, F.lit('},{"flag":'), flag,
                                          F.lit(',"doc":null}]')))
               .when(kind == 1, F.concat(F.lit('{"doc":'), d, F.lit(',"grade":{"of":5,"is":'), grade, F.lit("}}")))
               .when(kind == 2, F.lit("[]")).when(kind == 3, F.concat(F.lit('[{"doc":'), d, F.lit(",")))
               .when(kind == 4, scalar)
               .otherwise(F.concat(F.lit('[null,{"doc":'), d, F.lit('},[7],"row"]'))))
    llm = (F.when(F.col("toxic") == 1, F.concat(F.lit('[{"part":1,"error":true,"content":" quota used up at row '), d,
                                                F.lit(' "},{"error":true}]')))
           .when(F.col("quality") == 0, F.lit('[{"error":false,"content":"12 rows read"}]'))
           .when(F.col("quality") == 1, F.lit('{"error":true,"content":"  "}'))
           .otherwise(F.concat(F.lit('[{"error":'), grade, F.lit(',"content":"a grade, no flag"}]'))))
    return lab.select("doc_id", payload.alias("payload"), llm.alias("llm"))


_NO_MATCH_CSS = NO_MATCH_FMT.format(kind="css").replace("'", "''")


@register("extraction_payloads", f"""
WITH {PAYLOAD_SQL.strip()},
j AS (
  SELECT doc_id, payload, llm, json_valid(payload) AS ok,
         CASE WHEN json_valid(payload) THEN json_type(payload) END AS t,
         CASE WHEN json_valid(llm) AND json_type(llm) = 'ARRAY' THEN json_extract(llm, '$[*]')
              WHEN json_valid(llm) THEN [CAST(llm AS JSON)] END AS blocks
  FROM p
),
k AS (
  SELECT *, list_filter(blocks, lambda b: coalesce(json_type(b, '$.error') = 'BOOLEAN' AND CAST(json_extract(b, '$.error') AS BOOLEAN), false)) AS flagged
  FROM j
)
SELECT doc_id,
       CAST(CASE WHEN payload = '[]' OR NOT ok THEN 0 WHEN t = 'ARRAY' THEN json_array_length(payload)
                 WHEN t = 'OBJECT' THEN 1 ELSE 0 END AS BIGINT) AS count,
       CAST(CASE WHEN payload = '[]' OR NOT ok THEN NULL
                 WHEN t = 'ARRAY' THEN len(list_filter(json_extract(payload, '$[*]'), lambda x: json_type(x) = 'OBJECT'))
                 WHEN t = 'OBJECT' THEN 1 END AS BIGINT) AS n_items,
       CASE WHEN payload = '[]' THEN '{_NO_MATCH_CSS}'
            WHEN NOT ok THEN '{MALFORMED_FMT}'
            WHEN t NOT IN ('ARRAY', 'OBJECT') THEN replace('{NOT_RECORDS_FMT.format("?")}', '?',
                 CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END) END AS error,
       CASE WHEN len(flagged) = 0 THEN NULL
            ELSE coalesce(nullif(array_to_string(list_filter(list_transform(flagged,
                   lambda b: regexp_replace(coalesce(json_extract_string(b, '$.content'), ''), '^\\s+|\\s+$', '', 'g')),
                   lambda m: m <> ''), ' | '), ''), '{GENERIC_PROVIDER_ERROR}') END AS llm_error,
       trim(payload) IN ('[]', '{{}}', '') AS empty_structured
FROM k
""")
def extraction_payloads(spark, sf_dir):
    p = _payloads(spark, sf_dir)
    out = normalize_payload(p, "payload", NO_MATCH_FMT.format(kind="css"))
    return out.select("doc_id", "count",
                      F.when(F.col("error").isNull(), F.size("items")).cast("long").alias("n_items"),
                      "error", extraction_error("llm").alias("llm_error"),
                      empty_structured("payload").alias("empty_structured"))


CHUNK = 2048


@register("chunk_documents", f"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '') AS words
           FROM documents),
c AS (SELECT doc_id, words, unnest(range(greatest(CAST(ceil(len(words) / {CHUNK}) AS BIGINT), 1))) AS i FROM w)
SELECT doc_id, CAST(i + 1 AS BIGINT) AS chunk_no,
       CAST(len(list_slice(words, i * {CHUNK} + 1, (i + 1) * {CHUNK})) AS BIGINT) AS n_tokens,
       array_to_string(list_slice(words, i * {CHUNK} + 1, (i + 1) * {CHUNK}), ' ') AS chunk
FROM c
""")
def chunk_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"[ \t\n\r\f\x0B]+", " ")
                                                     .alias("text"))
    return chunk_text(docs, "text", ["doc_id"], CHUNK)


@register("token_usage", """
WITH t AS (
  SELECT conv_id, turn, role, len(list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\x0B]+'), lambda x: x <> '')) AS words
  FROM conversations
),
calls AS (
  SELECT conv_id, role, words AS completion_tokens,
         coalesce(sum(words) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS prompt_tokens
  FROM t
)
SELECT 'provider-' || (conv_id % 3) AS provider, CAST(count(*) AS BIGINT) AS n_calls,
       CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
       CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens
FROM calls WHERE role = 'assistant' GROUP BY 1
""")
def token_usage_q(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.regexp_replace("text", r"[ \t\n\r\f\x0B]+", " ").alias("text"))
    calls = conversation_calls(conv).withColumn(
        "provider", F.concat(F.lit("provider-"), (F.col("conv_id") % 3).cast("string")))
    return token_usage(calls)
