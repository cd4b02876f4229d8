"""The operators of this package as registered queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stakeline.llm import (
    conversations,
    decontamination,
    hilbert,
    packing,
    page_text,
    phrases,
    quality_model,
    quality_rules,
    secret_scan,
    simhash,
    substrings,
    url_rules,
    warc,
)
from stakeline.llm.common import read

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        _queries[name] = build
        if sql is not None:
            _oracles[name] = sql
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


@query("op7_secret_scan")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


@query("op9_quality_rules")
def _(spark: SparkSession, folder: str) -> DataFrame:
    good = read(spark, folder, "labels").where("quality = 1")
    return quality_rules.judge(read(spark, folder, "documents"), good)


_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op8_winnow_decontamination",
    f"""WITH texts AS (
 SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
 SELECT DISTINCT item, n, array_to_string(w[i + 1 : i + n], ' ') AS shingle
 FROM (SELECT *, unnest(range(len(w) - n + 1)) AS i
  FROM (SELECT *, least(len(w), 10) AS n FROM items) WHERE n > 0)),
text_windows AS (
 SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS shingle
 FROM (SELECT *, unnest(range(len(w) - n + 1)) AS i
  FROM texts CROSS JOIN (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
found AS (SELECT r, i, n, item FROM text_windows JOIN item_windows USING (n, shingle)),
hit AS (
 SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found)
 GROUP BY r),
named AS (
 SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
 FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
 CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_contamination(
        read(spark, folder, "documents"), read(spark, folder, "benchmark")
    )


@query("op1_quality_classifier")
def _(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return quality_model.score(docs, quality_model.train(docs, read(spark, folder, "labels")))


@query("op4_simhash_near_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query("op6_best_fit_packing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


@query(
    "op10_chunked_warc",
    """WITH records AS (
 SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
  sha1(coalesce(html, '')) AS payload_digest FROM pages),
held AS (
 SELECT *, CASE WHEN payload_bytes >= 1000
  THEN max(page_id) OVER (PARTITION BY payload_digest) END AS holder FROM records)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN holder IS NULL OR holder IS NOT DISTINCT FROM page_id
  THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN holder IS DISTINCT FROM page_id THEN holder END AS refers_to
FROM held""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = warc.fresh_path(spark)
    warc.write_archives(warc.chunk_table(read(spark, folder, "pages")), path)
    return warc.read_records(spark, path)


_RULES = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in url_rules.RULES)


@query(
    "op2_url_filter",
    f"""WITH urls AS (
 SELECT row_number() OVER () AS r, page_id,
  translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
best AS (
 SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
  arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
 FROM urls JOIN (VALUES {_RULES}) AS rules(rule_verdict, rule_host, rule_path)
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
 GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN best USING (r)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    return url_rules.judge_urls(read(spark, folder, "pages"), rules)


@query("op5_hilbert_sharding")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert.shard(read(spark, folder, "documents"), ["lang", "source", "size"])


@query("op3_html_extraction")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract_text(read(spark, folder, "pages"))


@query("op11_substring_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, folder, "documents"))


@query("op12_phrase_mining")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


@query("op13_conversation_repair")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(read(spark, folder, "conversations"))
