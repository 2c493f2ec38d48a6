"""Audits of texts, files and runs: secrets by line, licences, checklists, gates, status documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a line is reported for.
_KEY = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_BEARER = r"(?i)bearer\s+[A-Za-z0-9._\-]{20,}"
_ASSIGNED = r"(?i)(api[_-]?key|token|secret|password)[A-Za-z0-9_]*\"?\s*[:=]\s*[\"'][^\"']{12,}[\"']"
_REFERENCE = r"(\$\{|\$\(|<[^>]*>|env:|file:|os\.environ|[\"'][A-Z][A-Z0-9_]+[\"'])"
_PLACEHOLDER = r"(?i)(example|placeholder|changeme|redacted|dummy|x{6,})"


def secret_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, finding, severity): lines with private keys, bearer tokens or quoted assignments.

    References to the environment are left out, placeholders reported as low. Texts are split in place, so a long text
    is many short rows, and nothing is shuffled."""
    lines = texts.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("_n", "line"))
    finding = F.when(F.col("line").rlike(_KEY), "private_key").when(F.col("line").rlike(_BEARER), "bearer_token").when(F.col("line").rlike(_ASSIGNED) & ~F.col("line").rlike(_REFERENCE), "assignment")
    found = lines.withColumn("finding", finding).where("finding is not null")
    return found.select(key, (F.col("_n") + 1).alias("line_no"), "finding", F.when((F.col("finding") == "assignment") & F.col("line").rlike(_PLACEHOLDER), "low").otherwise("high").alias("severity"))


def licences(sources: DataFrame, allowed: list[str]) -> DataFrame:
    """(source, n, problem): sources whose licence note is missing or not allowed, or whose uri is missing."""
    note = F.lower(F.trim(F.coalesce("license_note", F.lit(""))))
    problem = F.when(F.coalesce("uri", F.lit("")) == "", "missing_uri").when(note == "", "missing_licence").when(~note.isin(allowed), "licence_not_allowed")
    return sources.withColumn("problem", problem).where("problem is not null").groupBy("source_name", "problem").agg(F.count("*").alias("n"))


def checklist(lines: Column) -> Column:
    """The mark of a checklist line: x, blank, ~ or !; null for other lines."""
    return F.nullif(F.regexp_extract(lines, r"^\s*[-*] \[([xX ~!])\]", 1), F.lit(""))


def gate(checks: DataFrame) -> DataFrame:
    """(passed, failed): whether all named checks hold, and those that don't. A check without result fails."""
    ok = F.coalesce("ok", F.lit(False))
    return checks.agg(F.bool_and(ok).alias("passed"), F.array_join(F.array_sort(F.collect_set(F.when(~ok, F.col("name")))), ",").alias("failed"))


def status_document(text: Column) -> Column:
    """A status document of version 1, null for any other text; unknown fields are tolerated."""
    schema = "schema_version int, updated_at_unix_ms bigint, phase string, generation bigint, loss double"
    parsed = F.from_json(text, schema)
    return F.when((parsed["schema_version"] == 1) & parsed["updated_at_unix_ms"].isNotNull(), parsed)


def provenance(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, canonical_sha256, bytes) of JSON records: hashes and lengths, no text."""
    from tracewright.functions.text import canonical_json

    return records.select(key, F.sha2(canonical_json(text), 256).alias("canonical_sha256"), F.octet_length(text).alias("bytes"))


def manifest(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_sha256, chars): what a subset holds, by hashes and lengths; no text."""
    return records.select(key, F.sha2(text, 256).alias("text_sha256"), F.length(text).alias("chars"))


def training_output(entities: Column, classifications: Column, provenance_: Column) -> Column:
    """A teacher's output in the form training reads: true labels always a list, empty parts as empty, provenance kept."""
    none = F.array().cast("array<string>")
    lists = F.transform(classifications, lambda c: F.struct(c["task"].alias("task"), F.coalesce(c["labels"], none).alias("labels"), F.coalesce(c["true_label"], none).alias("true_label")))
    return F.struct(F.coalesce(entities, F.map_from_entries(F.array().cast("array<struct<key:string,value:array<string>>>"))).alias("entities"), lists.alias("classifications"), provenance_.alias("provenance"))
