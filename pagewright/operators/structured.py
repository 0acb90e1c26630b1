"""Structured-output operators (EXT6, EXT7, EXT12-EXT15): payload normalisation, in-band
provider error detection, chunking and token accounting. The model call itself is not part of
this engine; these operators work on the tables of payloads/responses it produces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import strip

DEFAULT_CHUNK_TOKENS = 2048
GENERIC_PROVIDER_ERROR = "a block is flagged as an error without a message"
MALFORMED_FMT = "The payload cannot be parsed as JSON"
NOT_RECORDS_FMT = "The payload is JSON of type {}, not a record or an array of records"

_BLOCKS = "array<struct<error:boolean,content:string>>"


def extraction_error(payload) -> Column:
    """EXT12: messages of blocks whose ``error`` is JSON ``true``, trimmed, joined ' | '.

    NULL when the payload is empty, not JSON, or flags nothing; a flagged block without a
    message yields a generic text. Only a JSON ``true`` counts (``"true"`` and ``1`` do not).
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    v = F.try_parse_json(p)
    arr = F.when(F.schema_of_variant(v).startswith("ARRAY"), v) \
        .otherwise(F.when(v.isNotNull(), F.parse_json(F.concat(F.lit("["), F.to_json(v), F.lit("]")))))
    items = F.try_variant_get(arr, "$", "array<variant>")
    flagged = F.filter(items, lambda it: F.coalesce(
        (F.schema_of_variant(F.try_variant_get(it, "$.error", "variant")) == "BOOLEAN")
        & F.try_variant_get(it, "$.error", "boolean"), F.lit(False)))
    msgs = F.transform(flagged, lambda it: strip(F.coalesce(F.try_variant_get(it, "$.content", "string"), F.lit(""))))
    joined = F.array_join(F.filter(msgs, lambda m: m != ""), " | ")
    return (F.when(p.isNull() | (p == ""), F.lit(None))
            .when(F.size(flagged) > 0, F.when(joined != "", joined).otherwise(F.lit(GENERIC_PROVIDER_ERROR))))


def empty_structured(payload) -> Column:
    """EXT13: '[]', '{}' (after trim) or empty is a reported failure."""
    p = F.col(payload) if isinstance(payload, str) else payload
    t = strip(F.coalesce(p, F.lit("")))
    return (t == "") | t.isin("[]", "{}")


def _json_type(schema: Column) -> Column:
    """JSON type of a parsed scalar."""
    return (F.when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean")
            .when(schema == "VOID", "null").otherwise("number"))


def normalize_payload(df: DataFrame, payload_col: str, no_match_error: str, count_before_filter: bool = True
                      ) -> DataFrame:
    """EXT6/EXT7/EXT8: adds ``items array<variant>`` (objects only), ``count`` and ``error``.

    JSON string -> list; object -> one-item list; other JSON -> error; malformed -> error;
    empty or '[]' -> the no-match error. ``count_before_filter`` selects the CSS counting rule
    (items before non-objects are removed) vs the pattern rule (after).
    """
    p = F.col(payload_col)
    v = F.try_parse_json(p)
    sch = F.schema_of_variant(v)
    is_arr = sch.startswith("ARRAY")
    is_obj = sch.startswith("OBJECT")
    raw_items = F.when(is_arr, F.try_variant_get(v, "$", "array<variant>")) \
        .when(is_obj, F.array(v))
    objs = F.filter(raw_items, lambda it: F.schema_of_variant(it).startswith("OBJECT"))
    empty = p.isNull() | (p == "") | (p == "[]")
    error = (F.when(empty, F.lit(no_match_error))
             .when(v.isNull(), F.lit(MALFORMED_FMT))
             .when(~(is_arr | is_obj), F.format_string(NOT_RECORDS_FMT.format("%s"), _json_type(sch))))
    count = F.when(error.isNotNull(), F.lit(0)).otherwise(F.size(raw_items if count_before_filter else objs))
    return df.withColumn("items", F.when(error.isNull(), objs)) \
        .withColumn("count", count.cast("long")).withColumn("error", error)


def chunk_text(df: DataFrame, text_col: str, key_cols: list[str], chunk_tokens: int = DEFAULT_CHUNK_TOKENS,
               apply_chunking: bool = True) -> DataFrame:
    """EXT14: whitespace-token chunks ``(key..., chunk_no, n_tokens, chunk)``; off -> one chunk."""
    if chunk_tokens < 1:
        raise ValueError("chunk_token_threshold must be >= 1")
    words = F.filter(F.split(F.col(text_col), r"\s+"), lambda w: w != "")
    d = df.select(*key_cols, words.alias("_w"))
    if not apply_chunking:
        return d.select(*key_cols, F.lit(1).cast("long").alias("chunk_no"),
                        F.size("_w").cast("long").alias("n_tokens"), F.array_join("_w", " ").alias("chunk"))
    n = F.greatest(F.ceil(F.size("_w") / F.lit(chunk_tokens)), F.lit(1)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), n - 1),
                         lambda i: F.slice("_w", i * chunk_tokens + 1, chunk_tokens))
    return d.select(*key_cols, F.posexplode(chunks).alias("_i", "_c")).select(
        *key_cols, (F.col("_i") + 1).cast("long").alias("chunk_no"), F.size("_c").cast("long").alias("n_tokens"),
        F.array_join("_c", " ").alias("chunk"))


def token_usage(calls: DataFrame, provider_col: str = "provider") -> DataFrame:
    """EXT15: totals per provider over a table of calls with prompt/completion token counts."""
    return calls.groupBy(provider_col).agg(
        F.count(F.lit(1)).cast("long").alias("n_calls"),
        F.sum("prompt_tokens").cast("long").alias("prompt_tokens"),
        F.sum("completion_tokens").cast("long").alias("completion_tokens"),
        F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).cast("long").alias("total_tokens"))


def conversation_calls(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One call per assistant turn: prompt = words of all earlier turns, completion = its words."""
    words = F.size(F.filter(F.split(F.col("text"), r"\s+"), lambda w: w != ""))
    t = turns.withColumn("_words", words)
    w = Window.partitionBy(conv_col).orderBy(turn_col).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("prompt_tokens", F.coalesce(F.sum("_words").over(w), F.lit(0)))
    return t.filter(F.col("role") == "assistant").select(
        conv_col, turn_col, "prompt_tokens", F.col("_words").alias("completion_tokens"))
