"""Where results go: JSON lines, tables, and review exports."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(frame: DataFrame, path: str, append: bool = True) -> None:
    """One JSON object a line; nulls are kept, as an absent key and a null differ."""
    frame.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def spool(values: DataFrame, path: str, column: str = "value") -> None:
    """Envelopes as they are, a line each."""
    values.where(F.col(column).isNotNull()).select(column).write.mode("append").text(path)


def accepted(frame: DataFrame, path: str, key: str, batch: str) -> None:
    """An append that can be repeated: a batch overwrites its own partition, keys of other batches are left out."""
    spark = frame.sparkSession
    try:
        known = spark.read.parquet(path).join(frame.select(batch).distinct(), batch, "left_anti").select(key)
        frame = frame.join(known, key, "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)


def review(frame: DataFrame, path: str, reason: str | None = None) -> None:
    """Dead letters or quarantined rows for review, all or of one reason."""
    rows = frame if reason is None else frame.where(F.col("reason") == reason)
    json_lines(rows, path, append=False)


def broker(frame: DataFrame, servers: str, topic: str) -> None:
    """Dead letters to a topic, with reason and attempts as headers; needs the broker's connector on the class path."""
    headers = F.array(F.struct(F.lit("Dlq-Reason").alias("key"), F.encode("reason", "UTF-8").alias("value")), F.struct(F.lit("Dlq-Attempts").alias("key"), F.encode(F.col("attempts").cast("string"), "UTF-8").alias("value")))
    frame.select(F.col("raw_sha256").alias("key"), F.to_json(F.struct(*frame.columns)).alias("value"), headers.alias("headers")).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("includeHeaders", "true").save()


def rotate(path: str, most_bytes: int, keep_lines: int | None = None) -> bool:
    """Bounds a log of one writer: over ``most_bytes`` its last ``keep_lines`` lines stay, or it is renamed to ``.1`` without
    such a number; whether it was. Only the end of the file is read."""
    if not os.path.exists(path) or os.path.getsize(path) <= most_bytes:
        return False
    if keep_lines is None:
        os.replace(path, f"{path}.1")
        return True
    with open(path, "rb") as f:
        at, tail = f.seek(0, os.SEEK_END), b""
        while at > 0 and tail.count(b"\n") <= keep_lines:
            step = min(1 << 16, at)
            at -= step
            f.seek(at)
            tail = f.read(step) + tail
    with open(f"{path}.new", "wb") as f:
        f.write(b"".join(tail.splitlines(keepends=True)[-keep_lines:] if keep_lines else []))
        f.flush()
        os.fsync(f.fileno())
    os.replace(f"{path}.new", path)
    return True
