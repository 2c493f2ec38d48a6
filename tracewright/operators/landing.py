"""Landing records: pairing of sections, admission and redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import is_sha256, redact


def paired(sections: DataFrame) -> DataFrame:
    """(request_id, request, response, first_no): sections of a request brought together, in first-seen order.

    ``sections`` has request_id, no (arrival), section (request, response or null for a whole row), request and response
    texts. The later row of a section wins. Aggregation is partial, so a request with many rows is no hot group."""
    last = lambda side: F.max_by(side, F.when(F.col("section").isNull() | (F.col("section") == side), F.when(F.col(side).isNotNull(), F.col("no"))))
    return sections.groupBy("request_id").agg(last("request").alias("request"), last("response").alias("response"), F.min("no").alias("first_no"))


def complete(pairs: DataFrame, mode: str = "keep") -> DataFrame:
    """Pairs with both sides. ``fail`` raises on the first incomplete one, ``keep`` drops them."""
    whole = F.col("request").isNotNull() & F.col("response").isNotNull()
    if mode == "fail":
        return pairs.withColumn("request_id", F.when(whole, F.col("request_id")).otherwise(F.raise_error(F.concat(F.lit("incomplete pair: "), "request_id"))))
    return pairs.where(whole)


def landing_reason(allowed_models: list[str]) -> Column:
    """Why a landing record is refused: columns schema_version, request_id, uri, content_sha256, retrieved_at, model, request, response."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return (
        F.when(~F.col("schema_version").eqNullSafe(1), "unsupported_schema_version")
        .when(empty("request_id"), "missing_request_id")
        .when(empty("uri") | empty("content_sha256") | empty("retrieved_at"), "incomplete_source")
        .when(~is_sha256(F.col("content_sha256")), "invalid_source_hash")
        .when(~F.coalesce(F.col("model").isin(allowed_models), F.lit(False)), "model_not_allowlisted")
        .when(empty("request") | empty("response"), "missing_text")
    )


def admitted(records: DataFrame, schema_digest: str, policy_digest: str) -> DataFrame:
    """Redacted texts with the digests that bind a record to schema and policy."""
    return records.select(
        "request_id",
        redact("request").alias("request"),
        redact("response").alias("response"),
        F.lit(schema_digest).alias("schema_digest"),
        F.lit(policy_digest).alias("policy_digest"),
        F.sha2(F.concat_ws("\x1f", "request_id", "request", "response"), 256).alias("record_digest"),
    )


def allowed(frame: DataFrame, allowlist: DataFrame, column: str = "model") -> DataFrame:
    """Semi-join against ids and aliases: ``allowlist`` (model_id, aliases array). Spark broadcasts it if it is small."""
    names = allowlist.select(F.explode(F.array_union(F.array("model_id"), F.coalesce("aliases", F.array().cast("array<string>")))).alias(column)).distinct()
    return frame.join(names, column, "left_semi")
