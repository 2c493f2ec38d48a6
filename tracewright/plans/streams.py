"""Streaming queries: each runs a stream over a table until it is done and returns what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.shared import shared_dir, table
from tracewright.operators.ordered import DriftPolicy
from tracewright.plans.analytics import drift_sql, rounded_drift
from tracewright.plans.registry import query
from tracewright.streaming import ingest, stateful

Spark, Frame = SparkSession, DataFrame


def _stream(spark: Spark, d: str, name: str, columns: list[str]) -> Frame:
    """A table as a stream: one file or a folder of them."""
    batch = table(spark, d, name)
    source = spark.readStream.schema(batch.schema).option("pathGlobFilter", "*.parquet")
    parts = batch.inputFiles()
    single = len(parts) == 1 and parts[0].rsplit("/", 1)[-1] == f"{name}.parquet"
    frame = source.option("pathGlobFilter", f"{name}.parquet").parquet(d) if single else source.parquet(f"{d}/{name}.parquet")
    return frame.select(*columns)


def _done(frame: Frame, mode: str = "append") -> Frame:
    spark = frame.sparkSession
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = frame.writeStream.outputMode(mode).format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{root}/out")


@query("SELECT seq_no, id FROM (SELECT seq_no, id, row_number() OVER (PARTITION BY id ORDER BY seq_no) AS nth FROM delivery WHERE rel_path IS NOT NULL) WHERE nth = 1")
def t3_stream_dedup(spark: Spark, d: str) -> Frame:
    # Every key is remembered, each in the group of its hash.
    rows = stateful.spread_by_key(_stream(spark, d, "delivery", ["rel_path", "seq_no", "id"]).where("rel_path is not null"), "id", 32)
    return _done(stateful.bounded_dedup(rows, "_group", "seq_no", "id", None)).select("seq_no", "id")


@query(drift_sql("SELECT user_id::VARCHAR AS lineage, event_id AS ord, value AS loss FROM events"))
def t12_stream_drift(spark: Spark, d: str) -> Frame:
    rows = _stream(spark, d, "events", ["user_id", "event_id", "value"]).select(F.col("user_id").alias("lineage"), F.col("event_id").alias("ord"), F.col("value").alias("loss"), F.lit(1.0).alias("ema_norm"))
    return rounded_drift(_done(stateful.drift(rows, DriftPolicy(eval_window=5, min_windows=2, loss_ratio=1.2, reset_cooldown_steps=10))))


@query("SELECT DISTINCT j->>'$.record_id' AS record_id, lower(j->>'$.content_sha256') AS content_sha256 FROM (SELECT value::JSON AS j FROM envelope WHERE json_valid(value))")
def t1_ingested_once(spark: Spark, d: str) -> Frame:
    """What a run over the stream accepts: every valid message once."""
    root = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    rows = _stream(spark, d, "envelope", ["source_ref", "seq_no", "value"]).select(F.col("source_ref.uri").alias("rel_path"), F.col("seq_no").alias("byte_offset"), F.col("value").alias("raw"))
    ingest.start(rows, root, f"{root}/checkpoint").awaitTermination()
    return ingest.read_accepted(spark, root).select("record_id", F.lower("content_sha256").alias("content_sha256"))


@query("""WITH e AS (SELECT value, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM envelope), k AS (SELECT *, json_valid(value) AND json_type(CASE WHEN json_valid(value) THEN value END) = 'OBJECT' AS object FROM e)
SELECT count(*) AS n, count(*) FILTER (NOT coalesce(object, false)) AS unreadable FROM k""")
def t2_ingest_routes_everything(spark: Spark, d: str) -> Frame:
    """Accepted, duplicate, dead-letter and quarantine rows of a run add up to what came in; what can't be read is dead."""
    root = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    rows = _stream(spark, d, "envelope", ["source_ref", "seq_no", "value"]).select(F.col("source_ref.uri").alias("rel_path"), F.col("seq_no").alias("byte_offset"), F.col("value").alias("raw"))
    ingest.start(rows, root, f"{root}/checkpoint").awaitTermination()
    tables = [spark.read.schema("reason string, batch_id bigint").parquet(f"{root}/{t}") for t in ("accepted", "dlq", "quarantine", "duplicates")]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("reason").isin("envelope_not_json", "envelope_not_object")).alias("unreadable"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n FROM events WHERE ts < time_bucket(INTERVAL 1 hour, (SELECT max(ts) - INTERVAL 10 minutes FROM events)) GROUP BY ALL")
def x5_stream_windows(spark: Spark, d: str) -> Frame:
    """Windows that are over by the watermark at the end of the stream."""
    rows = _stream(spark, d, "events", ["ts", "event_type"]).withColumn("ts", F.col("ts").cast("timestamp"))
    return _done(ingest.windowed_counts(rows, "ts", "10 minutes", "1 hour", "event_type")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
