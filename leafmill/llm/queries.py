"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import audit, bpe, clicks, media, packing, pfor, quality, simhash, suffix_dedup, token_counts, toxicity, url_rules, warc
from leafmill.llm.shared import documents, labels


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(documents(spark, sf_dir))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.read_ids(pfor.write_ids(documents(spark, sf_dir)))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.write_media(documents(spark, sf_dir)))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_ids(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.read(warc.write(pages), payload=False).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(documents(spark, sf_dir).select("doc_id", "text"), labels(spark, sf_dir))
    return scored.select("doc_id", *quality.RESULT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(documents(spark, sf_dir), labels(spark, sf_dir))


def op12_click_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.deduplicate(spark.read.parquet(f"{sf_dir}/clicks.parquet"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).drop("url")


#: SQL of the queries that SQL can express.
ORACLES = {
    "op11_filter_audit": r"""WITH RECURSIVE t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
 marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
 f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CAST(len(l) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(l)) < 50 * len(l) AS INT) + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
   + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(least < w.doc_id, false) AS INT) AS fails FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id),
 g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
 orders AS (SELECT '' AS o UNION ALL SELECT o || x FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x) WHERE NOT contains(o, x)),
 steps AS (SELECT o, CAST(s AS INT) AS step, CAST(1 << (strpos('ABCDE', o[s]) - 1) AS INT) AS own, CAST(list_sum(list_transform(range(1, s), lambda i: 1 << (strpos('ABCDE', o[i]) - 1))) AS INT) AS sofar FROM orders, range(1, 6) r(s) WHERE length(o) = 5),
 made AS (SELECT g.part, o AS filter_order, step, own, sum(CASE WHEN fails & (coalesce(sofar, 0) | own) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails & own <> 0 AND fails & coalesce(sofar, 0) = 0 THEN n ELSE 0 END) AS removed,
   sum(CASE WHEN fails & own <> 0 AND fails & coalesce(sofar, 0) <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
   sum(CASE WHEN fails & own <> 0 AND fails & coalesce(sofar, 0) = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails & own <> 0 AND fails & coalesce(sofar, 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost FROM g, steps GROUP BY g.part, o, step, own)
 SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
   CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM made""",
    "op13_url_rules": r"""WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
 p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(rest, ''), '^[^/]*(.*)$', 1, 's') AS path FROM r),
 m AS (SELECT *, '.' || host AS h FROM p),
 v AS (SELECT *, CASE WHEN ends_with(h, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/' WHEN ends_with(h, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1' WHEN ends_with(h, '.org') AND starts_with(path, '/') THEN 'org/'
   WHEN ends_with(h, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN ends_with(h, '.com') AND starts_with(path, '/de/') THEN 'com/de/' END AS rule FROM m)
 SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM v""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    """The others hold XXH64, token ids, files or state, which SQL can't express; tests hold them against brute force."""
    return dict(ORACLES)
