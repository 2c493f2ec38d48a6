"""Queries that write with a sink or stage files for a source and give back what is read, and queries over small graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.shared import shared_dir, table
from tracewright.operators import envelopes, promotion, readside, routing
from tracewright.plans.registry import query
from tracewright.sources import captures, documents, sinks, spool

Spark, Frame = SparkSession, DataFrame


def _folder(spark: Spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_LINES = "l AS (SELECT DISTINCT sha256(rel_path)[1:12] AS file, byte_offset, raw FROM raw_capture WHERE rel_path IS NOT NULL AND byte_offset IS NOT NULL AND trim(raw, ' ' || chr(9) || chr(10) || chr(13)) <> '' AND NOT contains(raw, chr(10)) AND NOT contains(raw, chr(13)))"


def _staged(spark: Spark, d: str) -> str:
    """The captured lines as NDJSON files, one for each of their files, in their order."""
    root = _folder(spark, "spool")
    raw = F.col("raw")
    lines = table(spark, d, "raw_capture").where("rel_path is not null and byte_offset is not null").where((F.trim(F.regexp_replace(raw, "[\t\n\r]", " ")) != "") & ~F.contains(raw, F.lit("\n")) & ~F.contains(raw, F.lit("\r")))
    rows = lines.select(F.substring(F.sha2("rel_path", 256), 1, 12).alias("file"), "byte_offset", "raw").distinct()
    rows.repartition("file").sortWithinPartitions("file", "byte_offset", "raw").select("file", F.col("raw").alias("value")).write.partitionBy("file").text(root)
    return root


def _local(root: str) -> str:
    return root.removeprefix("file://")


_OFFSETS = f"WITH {_LINES} SELECT file, coalesce(sum(octet_length(encode(raw)) + 1) OVER (PARTITION BY file ORDER BY byte_offset, raw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_offset, raw FROM l"


@query(_OFFSETS)
def s6_spool_tail(spark: Spark, d: str) -> Frame:
    """Files read as a stream until all is taken in, with byte offsets of their own."""
    spool.register(spark)
    root, out = _staged(spark, d), _folder(spark, "spooled")
    rows = spark.readStream.format("spool").option("path", _local(root)).option("patterns", "*.txt").load()
    rows.writeStream.format("parquet").option("path", f"{out}/t").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start().awaitTermination()
    read = spark.read.schema(rows.schema).parquet(f"{out}/t")
    return read.select(F.regexp_extract("rel_path", "file=([0-9a-f]+)", 1).alias("file"), "byte_offset", "raw")


@query(_OFFSETS)
def s17_raw_scan(spark: Spark, d: str) -> Frame:
    """The same files scanned at once, split into ranges far smaller than they are."""
    spool.register(spark)
    read = spark.read.format("spool").option("path", _local(_staged(spark, d))).option("patterns", "*.txt").option("excluded", "_private").option("split_bytes", "50000").load()
    return read.select(F.regexp_extract("rel_path", "file=([0-9a-f]+)", 1).alias("file"), "byte_offset", "raw")


@query("SELECT row_id, input FROM stage0_distilled WHERE input IS NOT NULL AND row_id IS NOT NULL")
def k1_json_lines(spark: Spark, d: str) -> Frame:
    """Appended as JSON lines and read again; nulls are written as such."""
    path = _folder(spark, "lines")
    rows = table(spark, d, "stage0_distilled").where("input is not null and row_id is not null").select("row_id", "input", F.lit(None).cast("string").alias("nothing"))
    half = F.col("row_id") % 2 == 0
    sinks.json_lines(rows.where(half), path)
    sinks.json_lines(rows.where(~half), path)
    return spark.read.schema("row_id bigint, input string").json(path)


@query("SELECT DISTINCT ON (record_id) record_id, 1 AS batch FROM envelope WHERE record_id <> ''")
def k1_accepted(spark: Spark, d: str) -> Frame:
    """Accepted keys, the batch written twice: the second run changes nothing."""
    path = _folder(spark, "accepted")
    keys = table(spark, d, "envelope").where("record_id <> ''").select("record_id").distinct().withColumn("batch", F.lit(1))
    for _ in range(2):
        sinks.accepted(keys, path, "record_id", "batch")
    return spark.read.schema("record_id string, batch int").parquet(path)


@query("SELECT value FROM envelope WHERE value IS NOT NULL AND NOT contains(value, chr(10)) AND NOT contains(value, chr(13))")
def k10_spooled(spark: Spark, d: str) -> Frame:
    path = _folder(spark, "envelopes")
    rows = table(spark, d, "envelope").where("instr(value, chr(10)) = 0 and instr(value, chr(13)) = 0")
    sinks.spool(rows, path)
    return spark.read.text(path)


@query("SELECT seq_no, 'missing_record_id' AS reason FROM envelope WHERE coalesce(record_id, '') = ''")
def k12_review(spark: Spark, d: str) -> Frame:
    """Dead letters of one reason, exported for review and read again."""
    path = _folder(spark, "review")
    bad = F.when(F.coalesce("record_id", F.lit("")) == "", "missing_record_id").when(F.coalesce("content_sha256", F.lit("")) == "", "missing_hash")
    sinks.review(table(spark, d, "envelope").select("seq_no", bad.alias("reason")), path, "missing_record_id")
    return spark.read.schema("seq_no bigint, reason string").json(path)


@query("SELECT text FROM stage0_corpus WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''")
def s2_json_documents(spark: Spark, d: str) -> Frame:
    """Documents from JSON lines, through the list of sources; a source that is turned off gives nothing."""
    path = _folder(spark, "documents")
    texts = table(spark, d, "stage0_corpus").select("text").where(F.trim(F.regexp_replace("text", "[\t\n\r]", " ")) != "")
    texts.coalesce(1).write.json(path)
    sources = [documents.SourceConfig("corpus", "jsonl", path, max_documents=1 << 30), documents.SourceConfig("off", "text", path, enabled=False)]
    return documents.documents(spark, sources).select("text")


@query("SELECT coalesce(source_ref.uri, '') AS uri, count(*) AS n FROM envelope WHERE seq_no >= (SELECT min(seq_no) FROM delivery WHERE delivered_at >= TIMESTAMPTZ '2026-08-03 06:00:00+00') AND seq_no IN (SELECT seq_no FROM delivery WHERE delivered_at >= TIMESTAMPTZ '2026-08-03 06:00:00+00') GROUP BY 1")
def s16_from_time(spark: Spark, d: str) -> Frame:
    import datetime

    late = captures.started_at(table(spark, d, "delivery"), "by_timestamp", time=datetime.datetime(2026, 8, 3, 6, tzinfo=datetime.UTC)).select("seq_no")
    return table(spark, d, "envelope").join(late.distinct(), "seq_no", "left_semi").groupBy(F.coalesce("source_ref.uri", F.lit("")).alias("uri")).agg(F.count("*").alias("n"))


@query("SELECT max(seq_no) AS seq_no FROM delivery")
def s16_last(spark: Spark, d: str) -> Frame:
    return captures.started_at(table(spark, d, "delivery"), "last", place="seq_no").select("seq_no").distinct()


@query("SELECT count(*) FILTER (trained) AS trained, count(*) FILTER (NOT trained) AS rejected FROM (SELECT json_valid(value) AND coalesce((json_type(j, '$.example') = 'OBJECT' AND coalesce(j->>'$.example.input', '') <> '') OR (json_type(j, '$.labels') = 'OBJECT' AND coalesce(nullif(j->>'$.text', ''), nullif(j->>'$.source.uri', '')) IS NOT NULL AND json_type(j, '$.example') IS DISTINCT FROM 'OBJECT'), false) AS trained FROM (SELECT value, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM envelope))")
def proj14_labelled(spark: Spark, d: str) -> Frame:
    return envelopes.labelled_counts(table(spark, d, "envelope"))


@query("SELECT row_id, CASE row_id % 4 WHEN 0 THEN c.true_label[1] WHEN 1 THEN c.true_label[1] WHEN 2 THEN 'plain' END AS label FROM (SELECT row_id, output.classifications[1] AS c FROM stage0_distilled)")
def proj27_classification(spark: Spark, d: str) -> Frame:
    """A head's label as a struct, as a list, or plain."""
    c = F.try_element_at("output.classifications", F.lit(1))["true_label"]
    k = F.col("row_id") % 4
    label = routing.classification(F.when(k == 0, F.try_element_at(c, F.lit(1))), F.when(k == 1, c), F.when(k == 2, "plain"))
    return table(spark, d, "stage0_distilled").select("row_id", label.alias("label"))


_GRAPH = "t AS (SELECT p_partkey AS task, CASE WHEN p_size % 3 = 0 THEN 'accepted' ELSE 'open' END AS state FROM part), n AS (SELECT p_partkey AS task, floor((p_partkey - 1) / 2.0)::BIGINT AS needs FROM part)"


def _graph(spark: Spark, d: str) -> tuple[Frame, Frame]:
    p = table(spark, d, "part")
    tasks = p.select(F.col("p_partkey").cast("string").alias("task"), F.when(F.col("p_size") % 3 == 0, "accepted").otherwise("open").alias("state"))
    return tasks, p.select(F.col("p_partkey").cast("string").alias("task"), F.floor((F.col("p_partkey") - 1) / 2).cast("string").alias("needs"))


@query(f"WITH {_GRAPH} SELECT n.task::VARCHAR AS task, 'unknown_dependency:' || n.needs AS error FROM n WHERE n.needs NOT IN (SELECT task FROM t) UNION ALL SELECT n.task::VARCHAR, 'accepted_before:' || n.needs FROM n JOIN t a ON a.task = n.task JOIN t b ON b.task = n.needs WHERE a.state = 'accepted' AND b.state <> 'accepted'")
def j11_graph_errors(spark: Spark, d: str) -> Frame:
    return readside.graph_errors(*_graph(spark, d))


@query(f"WITH {_GRAPH} SELECT t.task::VARCHAR AS task FROM t JOIN n USING (task) JOIN t b ON b.task = n.needs WHERE t.state <> 'accepted' AND b.state = 'accepted'")
def j11_frontier(spark: Spark, d: str) -> Frame:
    return readside.frontier(*_graph(spark, d))


@query("SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 11 WHEN event_id % 7 = 0 THEN 12 WHEN value * 60 >= 3600 THEN 13 ELSE 0 END AS code FROM events")
def t15_watchdog(spark: Spark, d: str) -> Frame:
    n = F.col("event_id")
    return table(spark, d, "events").select("event_id", readside.watchdog(n % 11 != 0, n % 7 != 0, F.col("value") * 60).alias("code"))


_WORDS = "".join(f", ('{name}', [{', '.join(repr(w) for w in words.split())}])" for name, words in sorted(promotion.STOP_WORDS.items()))[2:]


@query(f"WITH w(name, words) AS (VALUES {_WORDS}), t AS (SELECT row_id, list_filter(regexp_split_to_array(lower(text), '[^\\pL]+'), lambda x: x <> '') AS x FROM stage0_corpus), h AS (SELECT row_id, name, len(list_filter(x, lambda y: list_contains(words, y))) AS n FROM t, w WHERE x IS NOT NULL) SELECT t.row_id, b.name AS language FROM t LEFT JOIN (SELECT row_id, arg_min(name, struct_pack(k := -n, m := name)) AS name, max(n) AS n FROM h GROUP BY row_id) b ON b.row_id = t.row_id AND b.n >= 2")
def n11_languages(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_corpus").select("row_id", promotion.language(F.col("text")).alias("language"))
