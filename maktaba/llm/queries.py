"""The queries opN_<name> over the tables of a folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, knn_quality, ngram_join, packing, quality_rules, suffix_dedup, token_io, url_rules, warc, winnow


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, quality_rules.learn(docs, _read(spark, sf_dir, "labels")))


#: Fixed values of the query's contract.
URL_RULES = (
    url_rules.Rule("allow", "com", "/"), url_rules.Rule("block", "example.com", "/en/"), url_rules.Rule("allow", "www.example.com", "/en/"),
    url_rules.Rule("block", "net", "/es/"), url_rules.Rule("block", "net", "/fr/"),
)


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_with_next(_read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.write_and_read(_read(spark, sf_dir, "pages"))
    return captures.select(
        F.col("metadata")[0]["fields"]["page_id"].cast("long").alias("page_id"), "response.payload_bytes", "response.payload_digest", "response.record_type",
        F.regexp_extract("response.refers_to", r"^<urn:capture:(\d+):response>$", 1).try_cast("long").alias("refers_to"),
    )


def op7_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return knn_quality.classify(docs, knn_quality.learn(docs, _read(spark, sf_dir, "labels")))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_io.store_and_read(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    file, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    found = bpe.encode(_read(spark, sf_dir, "documents"), file, pattern, decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_rules": op3_url_rules,
    "op4_winnowing": op4_winnowing,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_knn_quality": op7_knn_quality,
    "op8_token_files": op8_token_files,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_join": op10_ngram_join,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": r"""
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), s AS (
  SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS INT), 100) AS g FROM d, unnest(range(greatest(0, length(h) // 2 - 49))) AS u(i)
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM s) WHERE least < doc_id
), edges AS (
  SELECT doc_id, i, lag(i) OVER w AS before, lead(i) OVER w AS after FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), firsts AS (
  SELECT doc_id, i AS a, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edges WHERE before IS NULL OR i > before + 50
), lasts AS (
  SELECT doc_id, i + 50 AS b, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edges WHERE after IS NULL OR after > i + 50
), spans AS (
  SELECT doc_id, a, b, k, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY k) AS last FROM firsts JOIN lasts USING (doc_id, k)
), parts AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS done,
         string_agg(substr(h, CAST(2 * last + 1 AS INT), CAST(2 * (a - last) AS INT)), '' ORDER BY k) AS head
  FROM spans JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(done, 0) + 1 AS INT)))) AS kept_sha256
FROM d LEFT JOIN parts USING (doc_id)
""",
    "op10_ngram_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, sha256(array_to_string(w[CAST(i AS INT):CAST(i AS INT) + 4], ' ')) AS s
  FROM words, unnest(range(1, greatest(2, len(w) - 3))) AS u(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
""",
    # Base32 of a SHA-1: 160 bits in 32 groups of five, each taken from the hex digits around it.
    "op6_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, html, hex, max(page_id) OVER (PARTITION BY html) AS last,
         list_transform(range(40), lambda i: strpos('0123456789abcdef', substr(hex, CAST(i AS INT) + 1, 1)) - 1) AS nibbles
  FROM p
), b AS (
  SELECT *, list_transform(range(160), lambda i: (nibbles[CAST(i // 4 AS INT) + 1] >> CAST(3 - i % 4 AS INT)) & 1) AS bits FROM d
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(16 * bits[5*g+1] + 8 * bits[5*g+2] + 4 * bits[5*g+3] + 2 * bits[5*g+4] + bits[5*g+5] AS INT) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM b
""",
    "op3_url_rules": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(action, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT page_id, action, rhost || rpath AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS nth
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT split.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM split LEFT JOIN fits ON split.page_id = fits.page_id AND nth = 1
""",
}
