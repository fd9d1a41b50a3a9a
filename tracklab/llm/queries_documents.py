"""Queries of the map-only document operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklab.llm import bpe_codec, conv_repair, decontam, mixing, quality, tokens, warc
from tracklab.llm.common import query, table
from tracklab.session import scratch_dir
from tracklab.sources.staging import stage

_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
_W = r"[^\x20\x09-\x0D]+"


@query(rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '{_W}') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS ls
  FROM d
), g AS (
  SELECT rid, i, concat_ws(' ', ws[i], ws[i+1], ws[i+2]) AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), r AS (
  SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) >= 2
), c AS (
  SELECT rid, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) AS offs(o) GROUP BY rid
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS n_capitals,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
         len(ls) AS n_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis
  FROM w LEFT JOIN c USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND 100 * word_chars >= 200 * n_words AND 100 * word_chars <= 1200 * n_words
       AND 100 * n_symbols <= 10 * n_words AND 100 * n_capitals <= 30 * word_chars
       AND n_stop_words >= 2 AND 100 * n_dup_lines <= 50 * n_lines
       AND 100 * n_bullet <= 90 * n_lines AND 100 * n_ellipsis <= 30 * n_lines AS kept
FROM b
""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokens.load(public_tokenizers.path("byte_bpe_50k.json"))).drop("text")


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([5, 2, 1], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT)::BIGINT AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * sum(source_size) OVER () - coalesce(4 * sum(source_size) OVER before, 0) AS left_num,
         2 * (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS left_den,
         row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS pos
  FROM s
  WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT arg_min(left_num, pos) AS num, arg_min(left_den, pos) AS den
  FROM o WHERE left_num * w <= 2 * source_size * left_den
), t AS (
  SELECT source, source_size,
         CASE WHEN num * w > 2 * source_size * den THEN (2 * source_size)::DOUBLE
              ELSE num::DOUBLE * w / den::DOUBLE END AS target
  FROM s, f
), c AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS copies FROM t
), r AS (
  SELECT d.doc_id, d.size, c.source_size, c.target, c.copies,
         floor(target)::BIGINT - copies * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, size, source_size, target,
       (copies * size + greatest(least(rest - before, size), 0))::BIGINT AS taken
FROM r
""")
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = mixing.sized(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "order_key")
    return mixing.mix(stage(docs, "mix-sizes")).drop("source", "order_key")


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query(f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), q AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{_ALPHABET}', 1 + ((
         ('0x' || substr(x, 1 + 5 * (i // 4), 5))::INT >> ((3 - i % 4) * 5)::INT) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM q
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as monolithic archives, normalised, and read back by the offset index."""
    folder = scratch_dir(spark, "warc")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    warc.write_monolithic(warc.records(warc.linked(pages, "page_id", "html")), f"{folder}/whole")
    index = warc.normalise(spark, f"{folder}/whole", f"{folder}/split")
    rows = warc.read_members(index, f"{folder}/split", with_payload=False)

    def page(urn: str):
        return F.regexp_extract(urn, r"<urn:page:(-?\d+)>", 1).try_cast("long")

    return rows.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to_id").alias("refers_to"),
    )


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of benchmark items: one row per document and item found in it."""
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token numbers of every document and the bytes that they decode to, as digests."""
    tables = bpe_codec.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_codec.encode(docs, tables, decoded="decoded").select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a hash of its turns, with the cheapest repair as digests."""
    rows = table(spark, sf_dir, "conversations")
    text, blank = F.coalesce("text", F.lit(" ")), F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    harm = F.crc32(key.cast("binary")) % 20
    damaged = rows.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).alias("copies"))
    return conv_repair.digests(conv_repair.repair(damaged, copies=F.col("copies")))
