"""Driver queries of the dealt operators: one per operator, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Plan = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.toxicity import scored, trained
    docs = read(spark, sf_dir, "documents")
    return scored(docs, trained(docs, read(spark, sf_dir, "labels")))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.suffixtree import scored
    return scored(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.linededup import LONG_WORDS, dedup_lines
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), words=LONG_WORDS)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.languageid import predicted, trained
    docs = read(spark, sf_dir, "documents")
    return predicted(docs, trained(docs))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.packing import pack
    return pack(read(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.licenses import scan
    return scan(read(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.decontam import report
    return report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.minhash import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.vectors import near_vectors
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.suffixes import repeats
    return repeats(read(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.secretscan import report
    return report(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.merkle import manifest
    return manifest(read(spark, sf_dir, "documents"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pagewright.llm.crosstoken import aligned_counts
    return aligned_counts(read(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    """Matches and the gaps between them give the positions; one branch per rule."""
    from pagewright.llm.secretscan import BASE, RULES
    branches = []
    for k, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        branches.append(
            f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, m[i] AS x, regexp_extract(m[i], '{p}', {r.group}) AS g, "
            "list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS s "
            f"FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, "
            f"string_split_regex(t, '{p}') AS g FROM d)) WHERE length(regexp_extract(m[i], '{p}', {r.group})) >= {r.least}")
    names = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    spelt = "kind || ':' || s || ':' || (s + length(x))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hit AS (SELECT doc_id, k, kind, x, CAST(s AS BIGINT) AS s FROM ({" UNION ALL ".join(branches)})),
per AS (SELECT doc_id, {counts}, string_agg({spelt}, ',' ORDER BY s, k) FILTER (WHERE kind IN ({names})) AS base,
  string_agg({spelt}, ',' ORDER BY s, k) AS spans FROM hit GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""


_WORDS7 = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: a byte is added, then eight shifts (-1) follow, over one list."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: list_prepend(CAST(ascii(c) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1])))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) "
            "ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")


SQL: dict[str, str] = {
    "op3_line_dedup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
win AS (SELECT doc_id, s, m, array_to_string(l[s:s + m - 1], chr(10)) AS k
  FROM (SELECT doc_id, l, m, unnest(range(1, len(l) - m + 2)) AS s FROM d, (SELECT unnest([1, 2, 3]) AS m) WHERE len(l) >= m)),
enough AS (SELECT * FROM win WHERE m = 3 OR len(regexp_extract_all(k, '[^\\x20\\x09-\\x0D]+')) >= 50),
later AS (SELECT doc_id, s, m FROM (SELECT *, row_number() OVER (PARTITION BY m, k ORDER BY doc_id, s) AS r FROM enough) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS i FROM later),
line AS (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM d),
kept AS (SELECT line.doc_id, string_agg(x, chr(10) ORDER BY line.i) AS t FROM line
  LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.i = line.i WHERE gone.i IS NULL GROUP BY line.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN text IS NOT NULL THEN coalesce(t, '') END AS text,
  CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_deleted
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    # levels from the leaves up, then each row's own fold along its path; `t` 0: source trees, 1: their roots
    "op12_merkle_manifest": f"""
WITH RECURSIVE part AS (SELECT *, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents),
row_ AS (SELECT doc_id, coalesce('=' || source, '') AS src, a.h || coalesce(strlen(text) || ':' || text, '-') AS whole, a.h || coalesce(strlen(cut) || ':' || cut, '-') AS bare
  FROM part, LATERAL (SELECT coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS h) a),
leaf AS (SELECT doc_id, src, sha256(whole) AS leaf, sha256(bare) AS bare, count(*) OVER (PARTITION BY src) AS n,
  row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, sha256(whole)) - 1 AS pos FROM row_),
low(src, k, idx, h, n) AS (SELECT src, 0, pos, leaf, n FROM leaf UNION ALL
  SELECT src, k + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM low WHERE n > 1 GROUP BY src, k, idx // 3, n),
sub AS (SELECT src, h, row_number() OVER (ORDER BY src) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(k, idx, h, n) AS (SELECT 0, pos, h, n FROM sub UNION ALL
  SELECT k + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY k, idx // 3, n),
lv AS (SELECT src, 0 AS t, k, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM low WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT '', 1, k, idx // 3, list(h ORDER BY idx) FROM high WHERE n > 1 GROUP BY ALL),
top AS (SELECT src, 0 AS t, max(k) AS ks FROM low GROUP BY src UNION ALL SELECT '', 1, max(k) FROM high),
step AS (SELECT leaf.doc_id, leaf.src, leaf.pos AS leaf_pos, lv.t * 1000 + lv.k AS o, lv.hs,
    CAST((floor(s.pos / power(3, lv.k))) % 3 AS BIGINT) AS own
  FROM leaf JOIN sub ON sub.src = leaf.src, LATERAL (SELECT 0 AS t, leaf.src AS src, leaf.pos AS pos UNION ALL SELECT 1, '', sub.pos) s
  JOIN lv ON lv.t = s.t AND lv.src = s.src AND lv.run = floor(s.pos / power(3, lv.k + 1))),
path AS (SELECT src, leaf_pos, list({{'l': array_to_string(list_slice(hs, 1, own), ''), 'r': array_to_string(list_slice(hs, own + 2, 3), '')}} ORDER BY o) AS p FROM step GROUP BY src, leaf_pos),
walk(src, pos, i, h, p) AS (SELECT leaf.src, leaf.pos, 0, leaf.bare, coalesce(p, []) FROM leaf LEFT JOIN path ON path.src = leaf.src AND path.leaf_pos = leaf.pos UNION ALL
  SELECT src, pos, i + 1, sha256(p[i + 1].l || h || p[i + 1].r), p FROM walk WHERE i < len(p)),
root AS (SELECT h FROM high WHERE n = 1)
SELECT leaf.doc_id, leaf.leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(list_reduce(list_prepend('', list_transform(w.p, lambda x: x.l || x.r)), lambda x, y: x || y), '')) AS proof_sha256,
  w.h AS folded_root, w.h = root.h AS verified
FROM leaf JOIN sub ON sub.src = leaf.src JOIN walk w ON w.src = leaf.src AND w.pos = leaf.pos AND w.i = len(w.p), root""",
    "op7_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS7}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS7} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT item_id, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s, w FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS p FROM win),
lens AS (SELECT DISTINCT m FROM pat),
pos AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS s, w FROM d, lens WHERE len(w) >= m),
occ AS (SELECT doc_id, pos.m, s, item_id FROM pos JOIN pat ON pat.m = pos.m AND pat.p = array_to_string(w[s:s + pos.m - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS k FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
}


def queries() -> dict[str, Plan]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit() and callable(v)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return SQL | {"op11_secret_scan": _secrets_sql()}
