"""Batch document sources: text files, JSON lines, web pages, feeds; and the configuration they come from."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "source_name string, uri string, text string, license_note string"


@dataclass(frozen=True)
class SourceConfig:
    name: str
    kind: str
    location: str
    enabled: bool = True
    license_note: str = ""
    max_documents: int = 1000


def _shaped(frame: DataFrame, c: SourceConfig) -> DataFrame:
    return frame.where("text is not null and trim(text) <> ''").select(F.lit(c.name).alias("source_name"), "uri", "text", F.lit(c.license_note).alias("license_note"))


def text_files(spark: SparkSession, c: SourceConfig) -> DataFrame:
    """Each file is one document."""
    return _shaped(spark.read.text(c.location, wholetext=True).select(F.col("_metadata.file_path").alias("uri"), F.col("value").alias("text")), c)


def json_lines(spark: SparkSession, c: SourceConfig) -> DataFrame:
    """One document a line, from ``text``, else ``input``, else the record itself; blank lines count but give none.

    Line numbers come from positions in the file: lines are ranked per file, so files are read in parallel."""
    lines = spark.read.text(c.location, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    lines = lines.withColumn("n", F.col("n") + 1).where(F.col("n") <= c.max_documents).where("trim(line) <> ''")
    own = F.coalesce(F.get_json_object("line", "$.text"), F.get_json_object("line", "$.input"), F.col("line"))
    return _shaped(lines.select(F.concat(F.lit(f"{c.location}#L"), F.col("n").cast("string")).alias("uri"), own.alias("text")), c)


def feed_items(spark: SparkSession, c: SourceConfig) -> DataFrame:
    """Items of an RSS file: title and description; the link is the uri."""
    items = spark.read.format("xml").option("rowTag", "item").schema("title string, description string, link string").load(c.location)
    text = F.concat_ws("\n", F.nullif(F.trim(F.coalesce("title", F.lit(""))), F.lit("")), F.nullif(F.trim(F.coalesce("description", F.lit(""))), F.lit("")))
    return _shaped(items.limit(c.max_documents).select(F.coalesce("link", F.lit(c.location)).alias("uri"), text.alias("text")), c)


def web_page(spark: SparkSession, c: SourceConfig) -> DataFrame:
    """One page, fetched on an executor with a time limit; bad bytes are replaced."""

    def fetch(batches):
        import urllib.request

        import pyarrow as pa

        for batch in batches:
            bodies = []
            for url in batch.column(0).to_pylist():
                with urllib.request.urlopen(url, timeout=30) as answer:  # noqa: S310
                    bodies.append(answer.read().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies)], names=["uri", "text"])

    return _shaped(spark.createDataFrame([(c.location,)], "uri string").mapInArrow(fetch, "uri string, text string"), c)


READERS = {"text": text_files, "jsonl": json_lines, "rss": feed_items, "url": web_page}


def documents(spark: SparkSession, configs: list[SourceConfig]) -> DataFrame:
    """All enabled sources, in the order of the configuration (``source_no``)."""
    out = None
    for i, c in enumerate(configs):
        if c.kind not in READERS:
            raise ValueError(f"unknown source kind: {c.kind}")
        if c.enabled:
            part = READERS[c.kind](spark, c).withColumn("source_no", F.lit(i))
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], DOCUMENT + ", source_no int")


def load_config(path: str) -> dict:
    """A JSON or, where a parser is installed, YAML document whose root is an object."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        value = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path} is no JSON, and no YAML parser is installed") from e
        value = yaml.safe_load(text)
    if not isinstance(value, dict):
        raise ValueError(f"the root of {path} must be an object")
    return value


def config_digest(value: dict) -> str:
    """SHA-256 over the sorted JSON with the default separators."""
    import hashlib

    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def check_sources(configs: list[SourceConfig]) -> list[str]:
    """What is wrong with a list of sources."""
    names = [c.name for c in configs]
    found = [f"duplicate source: {n}" for n in sorted({n for n in names if names.count(n) > 1})]
    for c in configs:
        if not c.name or not c.location:
            found.append(f"source without name or location: {c.name!r}")
        if c.kind not in READERS:
            found.append(f"unknown kind of {c.name}: {c.kind}")
        if c.max_documents < 1:
            found.append(f"max_documents of {c.name} must be positive")
    return found


def read_state(path: str, default: dict) -> dict:
    """A JSON state file, or the default where it is missing or broken."""
    try:
        return load_config(path)
    except (OSError, ValueError):
        return default


def write_state(path: str, value: dict) -> None:
    """Written beside, synced, then renamed: readers see the old state or the new one."""
    import os

    temporary = f"{path}.new"
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump(value, f, sort_keys=True)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)
