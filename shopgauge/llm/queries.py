"""Registered queries of this subpackage, and SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    language,
    licenses,
    mixing,
    near_text,
    packing,
    quality,
    repeats,
    search,
    token_counts,
    token_files,
    vectors,
    warc,
)
from .common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op2_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_documents(table(spark, sf_dir, "documents"), size=2, least=0.8)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
        scratch(spark, "tokens"))
    return token_files.read_token_files(spark, manifest)


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.write_warcs(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    read = warc.read_warcs(made, payload=False).filter("kind = 'record'")
    return read.select(
        F.col("headers")["Page-ID"].cast("long").alias("page_id"), "payload_bytes",
        F.col("payload_sha256").alias("payload_digest"), F.col("warc_type").alias("record_type"),
        F.col("headers")["Refers-To-Page-ID"].cast("long").alias("refers_to"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     tokenizer_path("piece_bpe_32k.model"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = alignment.align_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("piece_bpe_32k.model"))
    return found


QUERIES: dict[str, Query] = {
    "op1_licenses": op1_licenses,
    "op2_near_documents": op2_near_documents,
    "op3_language": op3_language,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_token_files": op5_token_files,
    "op6_near_vectors": op6_near_vectors,
    "op7_warc": op7_warc,
    "op8_mix_sources": op8_mix_sources,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_search": op11_search,
    "op12_repeats": op12_repeats,
    "op13_alignment": op13_alignment,
}

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"

_OP8 = f"""
WITH sizes AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS h
  FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS cap FROM named
), visited AS (
  SELECT *,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(cap) OVER visit, 0)::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER visit, 0))::DOUBLE AS rate
  FROM weighed
  WINDOW visit AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rank
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max(rate) FILTER (WHERE cap > rate * weight) AS level FROM visited
), targets AS (
  SELECT source, source_size,
         CASE WHEN cap <= rate * weight THEN cap::DOUBLE ELSE weight * level END AS target
  FROM visited, level
), budgets AS (
  SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS copies FROM targets
), walked AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.copies,
         floor(b.target - b.copies * b.source_size)::BIGINT AS budget,
         sum(s.size) OVER up AS upto,
         count(*) OVER (PARTITION BY s.source, s.h) AS twins
  FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
  WINDOW up AS (PARTITION BY s.source ORDER BY s.h)
)
SELECT doc_id, size, source_size, target,
       (size * (copies + (upto <= budget
         OR (twins = 1 AND upto - size <= budget AND 2 * (budget - upto + size) >= size))::INT)
       )::BIGINT AS taken
FROM walked
"""

_STOCK = " + ".join(
    f"{k} * len(regexp_extract_all(lower(line), '" + p.replace("'", "''") + "'))"
    for k, p in quality.phrases_by_words().items())
_OP10 = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
  FROM documents
), win AS (
  SELECT k, i, list_aggregate(w[i:i+4], 'string_agg', ' ') AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1
), spans AS (
  SELECT k, least(5, coalesce(lead(i) OVER (PARTITION BY k ORDER BY i) - i, 5)) AS n FROM twice
), rep AS (SELECT k, sum(n)::BIGINT AS n FROM spans GROUP BY k
), line AS (
  SELECT k, unnest(lines) AS line, unnest(range(len(lines))) AS at FROM d
), judged AS (
  SELECT k, line, len(list_filter(string_split_regex(line, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS n,
         len(regexp_extract_all(line, '([!?.]{{2,}}|[#*$%&|<>]{{2,}})([ \\t\\n\\x0B\\f\\r]|$)')) AS piled,
         len(list_filter(string_split_regex(line, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x IN ('|', '»', '•', '>'))) AS bars,
         regexp_matches(line, '[.!?:;…"'')”»。！？][ \\t\\n\\x0B\\f\\r]*$') AS closed,
         {_STOCK} AS stock
  FROM line
), cut AS (
  SELECT k, count(*) AS n_lines, sum(bad::INT) AS n_removed, sum(CASE WHEN bad THEN 0 ELSE n END) AS n_left
  FROM (SELECT k, n, (piled * 3 > n OR bars * 4 > n OR (n <= 3 AND NOT closed) OR stock * 4 > n) AS bad
        FROM judged)
  GROUP BY k
), base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(cut.n_lines, 0)::BIGINT AS n_lines,
         coalesce(cut.n_removed, 0)::BIGINT AS n_lines_removed,
         coalesce(cut.n_left, 0)::BIGINT AS n_words_left
  FROM d LEFT JOIN rep USING (k) LEFT JOIN cut USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words_left >= n_words * 0.5 AS kept,
       n_lines, n_lines_removed, n_words_left
FROM (SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed FROM base)
"""

_OP7 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
         strlen(coalesce(html, ''))::BIGINT AS payload_bytes
  FROM pages
), g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM g
"""

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

_OP11 = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k, {_TERMS} AS t FROM documents
), sizes AS (
  SELECT k, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0
), total AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), asked AS (
  SELECT q, item_id, unnest(list_distinct(t)) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark)
), tfs AS (
  SELECT k, term, count(*)::BIGINT AS tf
  FROM (SELECT k, unnest(t) AS term FROM d) SEMI JOIN asked USING (term)
  GROUP BY k, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term), total
), shares AS (
  SELECT k, doc_id, term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS s
  FROM tfs JOIN sizes USING (k) JOIN weights USING (term), total
), scored AS (
  SELECT q, item_id, k, doc_id, sum(s)::BIGINT AS score
  FROM asked JOIN shares USING (term) GROUP BY q, item_id, k, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 10
"""

_OP12 = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k, encode(coalesce(text, '')) AS x,
         strlen(coalesce(text, ''))::BIGINT AS n_bytes
  FROM documents
), w AS (
  SELECT k, i, md5_number(x[i+1:i+400]) AS g
  FROM (SELECT k, x, unnest(range(0, n_bytes - 399)) AS i FROM d WHERE n_bytes >= 400)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1
), runs AS (
  SELECT k, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS run
        FROM (SELECT k, i, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new
              FROM twice))
  GROUP BY k, run
), kept AS (
  SELECT k, count(*)::BIGINT AS n_spans, sum(b - a)::BIGINT AS n_removed,
         list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
  FROM runs GROUP BY k
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       CASE WHEN kept.k IS NULL THEN sha256(x)
            ELSE sha256(unhex(array_to_string(list_transform(range(0, len(starts) + 1),
              lambda j: hex(x[CASE WHEN j = 0 THEN 1 ELSE ends[j] + 1 END:
                          CASE WHEN j = len(starts) THEN n_bytes ELSE starts[j + 1] END])), '')))
       END AS kept_sha256
FROM d LEFT JOIN kept USING (k)
"""

ORACLE_SQL: dict[str, str] = {
    "op7_warc": _OP7,
    "op8_mix_sources": _OP8,
    "op10_quality_rules": _OP10,
    "op11_search": _OP11,
    "op12_repeats": _OP12,
}
