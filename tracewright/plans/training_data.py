"""The training-data queries of the core: repeated deliveries (p5) and nested records (p2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.shared import table
from tracewright.operators import delivery_dedup, nested_tables


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_dedup.identified(table(spark, sf_dir, "envelope"), table(spark, sf_dir, "delivery"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_tables.links(table(spark, sf_dir, "raw_capture"))


def p2_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_tables.objects(nested_tables.occurrences(table(spark, sf_dir, "raw_capture")))


def p2_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many containers, objects in arrays and records the bridge holds."""
    bridge = nested_tables.occurrences(table(spark, sf_dir, "raw_capture"))
    return bridge.agg(F.count("*").alias("places"), F.count_if("element").alias("elements"), F.count_if(F.col("parent_no").isNull()).alias("roots"))


def p2_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_tables.occurrences(table(spark, sf_dir, "raw_capture")).drop("form")


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record put together again from the bridge and the stored objects."""
    bridge = nested_tables.occurrences(table(spark, sf_dir, "raw_capture"))
    return nested_tables.records(bridge, nested_tables.objects(bridge))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_dedup.copies(_messages(spark, sf_dir))


def p5_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = delivery_dedup.exactly_once(table(spark, sf_dir, "envelope"), table(spark, sf_dir, "delivery"))
    return kept.select("seq_no", "record_id", F.lower("content_sha256").alias("content_sha256"))


def p5_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_dedup.seen_ranges(_messages(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p2_found, p2_objects, p2_bridge, p2_places, p2_records, p5_found, p5_kept, p5_ranges)}

_KEYED = """keyed AS (SELECT seq_no, record_id, lower(content_sha256) AS content FROM envelope WHERE record_id <> '' AND content_sha256 <> ''),
ranked AS (SELECT seq_no, min(seq_no) OVER (PARTITION BY record_id, content) AS first_seq_no FROM keyed)"""

_BODIES = """l AS (SELECT DISTINCT rel_path, byte_offset, raw::JSON AS j FROM raw_capture WHERE json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw END) = 'OBJECT'),
s AS (SELECT rel_path, byte_offset, j->'$.requestBody' AS b, CASE WHEN json_type(j, '$.requestBody') = 'VARCHAR' THEN j->>'$.requestBody' END AS t FROM l),
b AS (SELECT rel_path, byte_offset, CASE WHEN t IS NULL THEN b WHEN json_valid(t) THEN CASE WHEN json_type(CASE WHEN json_valid(t) THEN t END) = 'OBJECT' THEN t::JSON END END AS b FROM s),
i AS (SELECT *, CASE WHEN json_type(b) = 'OBJECT' AND json_type(b, '$.value') = 'VARCHAR' THEN b->>'$.value' END AS t FROM b),
v AS (SELECT rel_path, byte_offset, CASE WHEN json_valid(t) AND json_type(CASE WHEN json_valid(t) THEN t END) = 'OBJECT' THEN json_merge_patch(b, json_object('value', t::JSON)) ELSE b END AS b FROM i),
n AS (SELECT rel_path, byte_offset, e.type AS kind, replace(substr(e.fullkey, CASE WHEN e.fullkey LIKE '$.%' THEN 3 ELSE 2 END), '"', '') AS node_path FROM v, json_tree(v.b) e WHERE v.b IS NOT NULL AND e.type IN ('OBJECT', 'ARRAY'))"""

ORACLES = {
    "p2_found": f"""WITH {_BODIES} SELECT DISTINCT rel_path, byte_offset, node_path, regexp_replace(regexp_replace(regexp_replace(node_path, '(\\[\\d+\\])+$', ''), '^[^\\[\\]]*$', ''), '(\\.?[^.\\[\\]]+)+$', '') AS parent_path FROM n WHERE kind = 'OBJECT' AND node_path LIKE '%]'""",
    "p2_places": f"""WITH {_BODIES} SELECT count(*) AS places, count(*) FILTER (kind = 'OBJECT' AND node_path LIKE '%]') AS elements, count(*) FILTER (node_path = '') AS roots FROM n""",
    "p5_found": f"WITH {_KEYED} SELECT first_seq_no AS kept_seq_no, seq_no AS dup_seq_no FROM ranked WHERE seq_no <> first_seq_no",
    "p5_kept": f"WITH {_KEYED} SELECT e.seq_no, e.record_id, lower(e.content_sha256) AS content_sha256 FROM envelope e LEFT JOIN ranked r ON e.seq_no = r.seq_no WHERE r.seq_no IS NULL OR r.seq_no = r.first_seq_no",
    "p5_ranges": r"""WITH m AS (SELECT DISTINCT regexp_extract(source_ref.uri, '^[A-Za-z][A-Za-z0-9+.\-]*://(.+)#([0-9]{1,18})$', 1) AS producer, regexp_extract(source_ref.uri, '^[A-Za-z][A-Za-z0-9+.\-]*://(.+)#([0-9]{1,18})$', 2)::BIGINT AS lo, greatest(coalesce(d.raw_bytes, 1), 1) AS width
FROM envelope e LEFT JOIN delivery d USING (seq_no) WHERE record_id <> '' AND content_sha256 <> '' AND regexp_matches(source_ref.uri, '^[A-Za-z][A-Za-z0-9+.\-]*://(.+)#([0-9]{1,18})$')),
r AS (SELECT *, max(lo + width) OVER (PARTITION BY producer ORDER BY lo, width ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m),
i AS (SELECT *, sum(CASE WHEN lo <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY producer ORDER BY lo, width) AS island FROM r)
SELECT producer, min(lo) AS range_lo, max(lo + width)::BIGINT AS range_hi FROM i GROUP BY producer, island""",
}
