"""Registered queries opN_<name> of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    conversations, decontaminate, packing, pii, quality, secrets_scan, sharding, simhash, suffix_dedup, topk, urlfilter, warc, whitening,
)
from .common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.digest(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), ["doc_id"]))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.digest(secrets_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"]))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.digest(quality.score(docs, labels, ["doc_id"]))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"]))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = urlfilter.filter_urls(table(spark, sf_dir, "pages"), ["page_id"])
    return r.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(table(spark, sf_dir, "documents"), ["doc_id"]))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents"), ["doc_id"]))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.digest(warc.read(warc.write(pages)), pages.schema["page_id"].dataType)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.digest(conversations.repair(rows, present_col="present"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, sf_dir, "embeddings"), ["vec_id"]))


QUERIES = {f.__name__: f for f in (
    op1_topk, op2_decontaminate, op3_secrets, op4_quality, op5_simhash, op6_url_filter, op7_suffix_dedup, op8_pii, op9_packing, op10_sharding,
    op11_warc, op12_conversation_repair, op13_whitening)}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _topk_sql(every: int = 100, k: int = 10) -> str:
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, [floor({topk.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {every} = 0))
WHERE rank <= {k}"""


def _decontaminate_sql(n: int = 10) -> str:
    return f"""
WITH items AS (SELECT DISTINCT item_id::VARCHAR AS item, {_words('text')} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
pats AS (SELECT DISTINCT item, least(len(w), {n}) AS n, array_to_string(w[i : i + {n - 1}], ' ') AS pat
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) AS i) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
wins AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS pat
  FROM docs, (SELECT DISTINCT n FROM pats) ns, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
hits AS (SELECT r, item, i, n FROM wins JOIN pats USING (n, pat)),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def _urls_sql() -> str:
    rules = sorted(urlfilter.RULES, key=lambda x: -len(x[1] + x[2]))
    case = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p} {v}'" for v, h, p in rules)
    weight = " + ".join(
        f"if(regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])'), {w}, 0)" for t, w in urlfilter.WEIGHTS.items())
    return f"""
SELECT page_id, host, path, split_part(fit, ' ', 1) AS rule,
  coalesce(split_part(fit, ' ', 2), if({weight} >= {urlfilter.REJECT}, 'block', 'allow')) AS verdict
FROM (SELECT *, CASE {case} END AS fit FROM (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT *, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages)))"""


def _warc_sql() -> str:
    letter = f"substr('{_UPPER}234567', ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)"
    return f"""
WITH told AS (SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
ranked AS (SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS best FROM told
  WINDOW w AS (PARTITION BY hex, payload_bytes ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST))
SELECT page_id, payload_bytes, array_to_string([{letter} FOR i IN range(32)], '') AS payload_digest,
  if(place = 1, 'response', 'revisit') AS record_type, if(place = 1, NULL, best) AS refers_to
FROM ranked"""


#: The others have no SQL: models, hashes, a tokenizer or byte-wise matching. tests/llm compares them with brute force.
ORACLE_SQL: dict[str, str] = {"op1_topk": _topk_sql(), "op2_decontaminate": _decontaminate_sql(), "op6_url_filter": _urls_sql(),
                              "op11_warc": _warc_sql()}
