"""Ingestion of a stream of captured messages: accepted, dead-letter and quarantine tables, written idempotently.

Delivery is at least once; a batch that is run again overwrites its own partition of each table, and keys accepted in
earlier batches are anti-joined, so the tables hold every message once.  Accepted keys are kept apart as 16-byte digests
(``keys``), so a batch reads these alone, all or those of the last ``remember`` batches.  A batch that fails is run again
by the stream; each run is noted, and from the one after ``max_deliver`` on what has no answer yet goes to the dead
letters, so a batch that can't be digested doesn't hold up the stream for ever.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewright.functions.shared import materialise
from tracewright.operators import envelopes

ACCEPTED = "key string, record_id string, content_sha256 string, value string, rel_path string, byte_offset bigint, batch_id bigint"


def _key_digest() -> Column:
    return F.substring(F.unhex(F.sha2("key", 256)), 1, 16)


def accepted_before(spark: SparkSession, root: str, batch_id: int, remember: int | None = None) -> DataFrame:
    """(digest): of the keys accepted in earlier batches, all or those of the last ``remember``."""
    try:
        kept = spark.read.schema("digest binary, batch_id bigint").parquet(f"{root}/keys").where(F.col("batch_id") < batch_id)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "digest binary")
    return (kept if remember is None else kept.where(F.col("batch_id") >= batch_id - remember)).select("digest")


def runs_of(spark: SparkSession, root: str, batch_id: int) -> int:
    """Notes one more run of a batch, in the folder the tables are in, and gives how many there are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/_runs/{batch_id}")
    files = folder.getFileSystem(conf)
    files.mkdirs(folder)
    files.create(jvm.org.apache.hadoop.fs.Path(folder, uuid.uuid4().hex)).close()
    return len(files.listStatus(folder))


def read_accepted(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(ACCEPTED).parquet(f"{root}/accepted")


def handle(lines: DataFrame, batch_id: int, root: str, schema: tuple[str, int, str] | None = None, allowed_models: set[str] | None = None, max_bytes: int = 1 << 20, max_deliver: int = 5, remember: int | None = None) -> None:
    """Routes one batch of (rel_path, byte_offset, raw, ...) and writes its tables.

    Lines are numbered in the order they came in; ``attempts``, if the lines have it, counts their deliveries, otherwise
    the runs of the batch do."""
    spark = lines.sparkSession
    runs = F.lit(runs_of(spark, root, batch_id))
    attempts = F.greatest(F.col("attempts").cast("int"), F.lit(1)) if "attempts" in lines.columns else runs
    # Written first: numbers given by place must not change if an executor is lost.
    rows = materialise(
        lines.select(F.monotonically_increasing_id().alias("seq_no"), "rel_path", "byte_offset", F.col("raw").alias("value"), F.get_json_object("raw", "$.record_id").alias("record_id"), F.get_json_object("raw", "$.content_sha256").alias("content_sha256"), attempts.alias("attempts")),
        "ingest-lines",
    )
    verdicts = envelopes.validated(rows.drop("attempts"), schema, allowed_models, max_bytes)
    keyed = rows.withColumn("key", envelopes.idempotency_key(F.col("record_id"), F.lower("content_sha256")))
    digests = keyed.where("key is not null").select("key", _key_digest().alias("digest")).distinct()
    seen = digests.join(accepted_before(spark, root, batch_id, remember), "digest", "left_semi").select("key")
    routes = envelopes.routed(keyed.select("seq_no", "key", "attempts"), verdicts, seen, max_deliver)
    out = materialise(keyed.join(routes, "seq_no").withColumn("batch_id", F.lit(batch_id)), "ingest-routes")
    hashed = [F.sha2("value", 256).alias("raw_sha256"), F.octet_length("value").alias("raw_bytes")]
    tables = {
        "accepted": out.where("route = 'accepted'").select(*[c.split(" ")[0] for c in ACCEPTED.split(", ")]),
        "dlq": out.where("route = 'dlq'").select("reason", "attempts", "rel_path", "byte_offset", *hashed, F.substring("value", 1, 256).alias("raw_preview"), "batch_id"),
        "duplicates": out.where("route = 'duplicate'").select("key", "rel_path", "byte_offset", "batch_id"),
        "quarantine": out.where("route = 'quarantine'").select("reason", "rel_path", "byte_offset", *hashed, "batch_id"),
        # Last, as what is in it counts as accepted.
        "keys": out.where("route = 'accepted' and key is not null").select(_key_digest().alias("digest"), "batch_id"),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/{name}")


def start(lines: DataFrame, root: str, checkpoint: str, once: bool = True, every: str = "5 seconds", each: Callable[[DataFrame, int], None] | None = None, **rules) -> StreamingQuery:
    """Runs ingestion until all that is there is done (``once``) or for ever."""

    def batch(df: DataFrame, batch_id: int) -> None:
        handle(df, batch_id, root, **rules)
        if each is not None:
            each(df, batch_id)

    writer = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Waits so long at most, then stops the query; whether it ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)


def run_until(query: StreamingQuery, max_records: int = 0, idle_seconds: float = 0, seconds: float = 0, every: float = 0.5) -> str:
    """Runs a query until a bound is met, and says which: ``records`` taken in, ``idle`` without new ones for so long,
    ``duration``, or ``ended``. Bounds of 0 are none. What has been taken in is finished before the query stops."""
    began = last_news = time.monotonic()
    seen: dict[int, int] = {}
    while query.isActive:
        query.awaitTermination(every)
        now = time.monotonic()
        for p in query.recentProgress:
            if p["numInputRows"] and p["batchId"] not in seen:
                seen[p["batchId"]], last_news = p["numInputRows"], now
        reason = "records" if max_records and sum(seen.values()) >= max_records else "idle" if idle_seconds and now - last_news >= idle_seconds else "duration" if seconds and now - began >= seconds else None
        if reason:
            if query.isActive and reason != "idle":
                settled = time.monotonic() + 30
                while query.status["isTriggerActive"] and time.monotonic() < settled:
                    time.sleep(0.1)
            query.stop()
            return reason
    return "ended"


def lag(query: StreamingQuery) -> dict:
    """What the last batch says of a query: batch, rows taken in, rows a second, the offset it reached."""
    p = query.lastProgress
    if not p:
        return {"batch": None, "rows": 0, "rows_per_second": 0.0, "offset": None}
    return {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p.get("processedRowsPerSecond") or 0.0, "offset": p["sources"][0].get("endOffset") if p["sources"] else None}


def windowed_counts(events: DataFrame, time: str, late: str, width: str, *keys: str) -> DataFrame:
    """Counts in event-time windows with a bound on lateness; the same plan over a table or a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")
