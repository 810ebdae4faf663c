"""Line dedup, mixing, URL filters, license scans and personal data over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.book import query
from lakeload.llm.common import table
from lakeload.llm.license_scan import scan_licenses
from lakeload.llm.line_dedup import drop_repeated_lines
from lakeload.llm.mixing import mix_sources
from lakeload.llm.pii import SECRET, find_pii, fit_tagger
from lakeload.llm.url_filter import SOFT_TERMS, STRICT_TERMS, UrlRule, filter_urls

ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, {ASCII_LOWER.format(f"trim(line, {BLANKS_SQL})")} AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.last AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op6_line_dedup", LINE_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, length(text) AS chars,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE)
           / 281474976710656.0::DOUBLE AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln(u) / coalesce(1.0::DOUBLE / (1.0::DOUBLE + abs(chars::DOUBLE / greatest(size, 1) - 6.0::DOUBLE) / 6.0::DOUBLE), 1.0::DOUBLE) AS key
  FROM sized),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
chosen AS (SELECT max(level) AS level FROM levels WHERE 3 * source_size >= level * weight),
targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, c.level * weight) AS target
  FROM levels, chosen c),
quotas AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         round(target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size)::BIGINT AS quota
  FROM targets),
placed AS (
  SELECT k.*, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k)
SELECT p.doc_id, p.size, q.source_size, q.target, q.epochs,
       (p.size * q.epochs + greatest(0, least(p.size, q.quota - (p.upto - p.size))))::BIGINT AS taken
FROM placed p JOIN quotas q ON p.source IS NOT DISTINCT FROM q.source
"""


@query("op3_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken", "epochs")


URL_RULES = (
    UrlRule("allow", "com"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def _hits_sql(terms) -> str:
    lower = ASCII_LOWER.format("coalesce(url, '')")
    return " + ".join(f"regexp_matches({lower}, '(^|[^0-9a-z]){t}([^0-9a-z]|$)')::BIGINT" for t in sorted(terms))


def _weights_sql() -> str:
    lower = ASCII_LOWER.format("coalesce(url, '')")
    return " + ".join(f"CASE WHEN regexp_matches({lower}, '(^|[^0-9a-z]){t}([^0-9a-z]|$)') THEN {w}::DOUBLE ELSE 0::DOUBLE END"
                      for t, w in sorted(SOFT_TERMS.items()))


URL_SQL = f"""
WITH parts AS (
  SELECT page_id, {ASCII_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         {_hits_sql(STRICT_TERMS)} AS n_strict, {_hits_sql(SOFT_TERMS)} AS n_soft, {_weights_sql()} AS soft_weight
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, n_strict, n_soft, soft_weight,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op8_url_filter", URL_SQL)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


@query("op9_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op10_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.filter(F.split("spans", ","), lambda s: s != "")
    return find_pii(docs, fit_tagger(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans",
        F.size(F.filter(spans, lambda s: s.startswith(f"{SECRET}:"))).cast("long").alias("n_secret"),
        F.size(spans).cast("long").alias("n_spans"))
