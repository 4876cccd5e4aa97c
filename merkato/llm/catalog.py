"""The operators as registered queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merkato.llm import (
    chat_format, exact_dedup, fill_middle, importance, language_id, mixing, packing, quality, secret_scan, simhash, suffix_dedup,
    token_counts, toxicity)
from merkato.llm.common import read
from merkato.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
best AS (
  SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-size, doc_id)) AS keep_id FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN best USING (text_sha256)
""")
def _exact_dedup(spark, folder):
    return exact_dedup.exact_dedup(read(spark, folder, "documents"))


@query("op2_simhash_near_dedup")
def _simhash(spark, folder):
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query("op3_sequence_packing")
def _packing(spark, folder):
    return packing.pack_documents(read(spark, folder, "documents"))


@query("op4_suffix_dedup")
def _suffixes(spark, folder):
    return suffix_dedup.remove_repeats(read(spark, folder, "documents")).drop("kept")


@query("op5_secret_scan")
def _secrets(spark, folder):
    return secret_scan.scan_documents(read(spark, folder, "documents"))


@query("op6_chat_format")
def _chat(spark, folder):
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    lines = chat_format.transcript_lines(chat_format.with_markers(turns))
    return chat_format.format_lines(lines).select(
        "conv_id", "turn", "line", "role", "recovered", "begins", "opens", "canonical")


@query("op7_quality_rules")
def _quality(spark, folder):
    return quality.judge(read(spark, folder, "documents"))


@query("op8_toxicity")
def _toxicity(spark, folder):
    docs = read(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read(spark, folder, "labels")))


@query("op9_token_counts")
def _token_counts(spark, folder):
    return token_counts.count_tokens(read(spark, folder, "documents"))


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source),
s2 AS (SELECT *, CAST(source_size AS DOUBLE) * 2 AS clamp, CAST(weight AS DOUBLE) AS w FROM s),
total AS (SELECT 1.5 * CAST(sum(source_size) AS DOUBLE) AS t FROM s2),
rounds AS (
  SELECT 0 AS r, (SELECT t FROM total) / (SELECT sum(w) FROM s2) AS level
  UNION ALL
  SELECT r + 1, ((SELECT t FROM total) - (SELECT sum(clamp) FROM s2 WHERE w * level > clamp))
                / (SELECT sum(w) FROM s2 WHERE NOT w * level > clamp)
  FROM rounds WHERE r < 1000 AND EXISTS (SELECT 1 FROM s2 WHERE w * level > clamp)
    AND EXISTS (SELECT 1 FROM s2 WHERE NOT w * level > clamp)),
goal AS (
  SELECT source, source_size, least(clamp, w * (SELECT max(level) FROM rounds)) AS target,
         CAST(CASE WHEN source_size > 0 THEN floor(least(clamp, w * (SELECT max(level) FROM rounds)) / source_size) ELSE 0 END
              AS BIGINT) AS whole
  FROM s2),
placed AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
      PARTITION BY source ORDER BY md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN size > 0 AND CAST(before AS DOUBLE) + size / 2.0 <= target - whole * source_size
                            THEN 1 ELSE 0 END) AS taken
FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
"""


@query("op10_source_mix", MIX_SQL)
def _mix(spark, folder):
    return mixing.mix(read(spark, folder, "documents"))


@query("op11_language_id")
def _language(spark, folder):
    docs = read(spark, folder, "documents")
    return language_id.identify(docs, language_id.train(docs))


@query("op12_importance_resampling")
def _importance(spark, folder):
    return importance.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


FILL_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


@query("op13_fill_in_middle", FILL_SQL)
def _fill(spark, folder):
    made = fill_middle.fill_in_middle(read(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
