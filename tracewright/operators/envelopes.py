"""Envelopes: validation with one ordered reason, routing, idempotency keys, training examples."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import blank_to_null, canonical_text, is_json, is_sha256

KINDS = ("labelled_example", "tool_task_pair", "raw_document")
#: Reasons that quarantine a message; every other one sends it to the dead letters.
QUARANTINED = ("schema_digest_mismatch", "schema_digest_not_sha256")


def idempotency_key(record_id: Column, content: Column) -> Column:
    """``record_id|content``; null unless both are there."""
    return F.when(record_id.isNotNull() & content.isNotNull(), F.concat(record_id, F.lit("|"), content))


def _text(value, key: str) -> str | None:
    v = value.get(key) if isinstance(value, dict) else None
    return v if isinstance(v, str) else None


_HEX = set("0123456789abcdefABCDEF")


def _hex64(v: str | None) -> bool:
    return v is not None and len(v) == 64 and _HEX.issuperset(v)


def reason(value: str | None, schema: tuple[str, int, str] | None, allowed_models: set[str], max_bytes: int, check_hash: bool = True) -> str | None:
    """The first rule an envelope breaks, or None. Cheap rules come first; the order is part of the contract."""
    import hashlib

    if value is None:
        return "envelope_not_json"
    if len(value.encode("utf-8", "surrogatepass")) > max_bytes:
        return "oversized_message"
    try:
        e = json.loads(value)
    except (ValueError, RecursionError):
        return "envelope_not_json"
    if not isinstance(e, dict):
        return "envelope_not_object"
    version = e.get("envelope_version")
    if not isinstance(version, int) or isinstance(version, bool) or version < 0:
        return "missing_envelope_version"
    if version != 1:
        return "unsupported_envelope_version"
    for key in ("record_id", "content_sha256"):
        if _text(e, key) is None:
            return f"missing_{key}"
        if not e[key]:
            return f"empty_{key}"
    if not _hex64(e["content_sha256"]):
        return "invalid_content_sha256"
    if check_hash and hashlib.sha256(canonical_text(value, "content_sha256").encode("utf-8", "surrogatepass")).hexdigest() != e["content_sha256"]:
        return "content_hash_mismatch"
    block = e.get("schema")
    if "schema" not in e:
        return "missing_schema"
    if not isinstance(block, dict) or _text(block, "id") is None or not isinstance(block.get("version"), int) or _text(block, "digest") is None:
        return "invalid_schema_block"
    if schema is not None and (block["id"], block["version"], block["digest"]) != schema:
        return "schema_digest_mismatch"
    if not _hex64(block["digest"]):
        return "schema_digest_not_sha256"
    kind = _text(e, "kind")
    if kind is None:
        return "missing_kind"
    if not kind:
        return "empty_kind"
    if kind not in KINDS:
        return "unknown_kind"
    source = e.get("source")
    if "source" not in e:
        return "missing_source"
    if not isinstance(source, dict) or any(_text(source, k) is None for k in ("uri", "content_sha256", "retrieved_at")):
        return "invalid_source_block"
    if not source["uri"] or not source["retrieved_at"]:
        return "source_requires_uri_and_retrieved_at"
    if not _hex64(source["content_sha256"]):
        return "invalid_source_content_sha256"
    if kind == "labelled_example" and "labels" not in e and "example" not in e:
        return "labelled_example_requires_labels"
    if kind == "raw_document" and "document" not in e and "example" not in e:
        return "raw_document_requires_document"
    if kind == "tool_task_pair":
        for section in ("request", "response"):
            if section not in e:
                return f"tool_task_pair_requires_{section}"
            text = _text(e[section], "text")
            if text is None:
                return f"{section}_requires_text"
            if not text:
                return f"{section}_text_is_empty"
    model = e.get("observed_model")
    if model is not None:
        name = _text(model, "model_id") if isinstance(model, dict) and "model_id" in model else _text(model, "model")
        if name is None:
            return "invalid_observed_model"
        if not name:
            return "observed_model_requires_model_id"
        if allowed_models and name not in allowed_models:
            return "observed_model_not_allowlisted"
    return None


#: The client's wording of the same rules.
CLIENT_WORDS = {
    "missing_envelope_version": "unsupported_envelope_version",
    "empty_record_id": "missing_record_id",
    "empty_content_sha256": "missing_content_sha256",
    "source_requires_uri_and_retrieved_at": "source_missing_uri",
    "tool_task_pair_requires_request": "request_requires_text",
    "tool_task_pair_requires_response": "response_requires_text",
    "request_text_is_empty": "request_requires_text",
    "response_text_is_empty": "response_requires_text",
}


def validated(envelope: DataFrame, schema: tuple[str, int, str] | None = None, allowed_models: set[str] | None = None, max_bytes: int = 1 << 20, dialect: str = "bridge", check_hash: bool = True) -> DataFrame:
    """The rows with ``reason`` (null: valid) and ``route_class`` (accepted, dlq or quarantine).

    Only the key and the value travel to Python; the verdict is joined back by position in the same batch."""
    words = CLIENT_WORDS if dialect == "client" else {}
    allowed = set(allowed_models or ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [reason(v, schema, allowed, max_bytes, check_hash) for v in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([words.get(r, r) for r in found], pa.string())], names=[*batch.schema.names[:-1], "reason"])

    keys = envelope.select("seq_no", "record_id", "content_sha256", "value")
    out = keys.mapInArrow(run, "seq_no bigint, record_id string, content_sha256 string, reason string")
    return out.withColumn("route_class", F.when(F.col("reason").isNull(), "accepted").when(F.col("reason").isin(*QUARANTINED), "quarantine").otherwise("dlq"))


def routed(messages: DataFrame, verdicts: DataFrame, seen: DataFrame | None = None, max_deliver: int = 5) -> DataFrame:
    """(seq_no, route, reason): one route a delivery, in this order: duplicate, retry ceiling, validation.

    ``messages`` (seq_no, key, attempts) of a batch; ``seen`` has the keys accepted before. The first delivery of a key
    that is valid is accepted, later ones in the batch and those of seen keys are duplicates."""
    rows = messages.join(verdicts.select("seq_no", "reason", "route_class"), "seq_no")
    if seen is not None:
        rows = rows.join(seen.select("key", F.lit(True).alias("_seen")).distinct(), "key", "left")
    else:
        rows = rows.withColumn("_seen", F.lit(None).cast("boolean"))
    # A delivery is a duplicate if its key was seen, or if a fit one came before it: one minimum a key, aggregated before
    # its shuffle, tells that.
    fit = (F.col("route_class") == "accepted") & (F.col("attempts") <= max_deliver)
    firsts = rows.where(fit & F.col("key").isNotNull()).groupBy("key").agg(F.min("seq_no").alias("_first"))
    rows = rows.join(firsts, "key", "left")
    duplicate = F.col("key").isNotNull() & (F.coalesce("_seen", F.lit(False)) | F.coalesce(F.col("_first") < F.col("seq_no"), F.lit(False)))
    return rows.select(
        "seq_no",
        F.when(duplicate, "duplicate").when(F.col("attempts") > max_deliver, "dlq").otherwise(F.col("route_class")).alias("route"),
        F.when(duplicate, F.lit(None)).when(F.col("attempts") > max_deliver, "retry_ceiling").otherwise(F.col("reason")).alias("reason"),
    )


def dead_letters(deliveries: DataFrame, reasons: DataFrame) -> DataFrame:
    """Dead-letter rows: class, reason, adapter, attempts, hash, size and a preview of at most 256 bytes."""
    preview = F.expr("decode(substring(encode(raw, 'UTF-8'), 1, 256), 'UTF-8')")
    return deliveries.join(reasons, "seq_no").where("route in ('dlq', 'quarantine')").select(
        "seq_no", F.col("route").alias("class"), "reason", "adapter", "attempts",
        F.sha2("raw", 256).alias("raw_sha256"), F.octet_length("raw").alias("raw_bytes"), F.when(F.col("route") == "dlq", preview).alias("raw_preview"),
    )


def loop_example(value: Column) -> Column:
    """struct(input, output) as the loop reads labelled envelopes: their example, else their labels with the text or, where
    there is none, the source's uri; null (a reject) without an input."""
    j = lambda p: blank_to_null(F.get_json_object(value, p))
    own = F.when(j("$.example").startswith("{"), F.struct(j("$.example.input").alias("input"), j("$.example.output").alias("output")))
    labelled = F.when(j("$.labels").startswith("{"), F.struct(F.coalesce(j("$.text"), j("$.source.uri")).alias("input"), j("$.labels").alias("output")))
    chosen = F.coalesce(own, labelled)
    return F.when(chosen["input"].isNotNull() & is_json(value), chosen)  # paths are read out of broken JSON too


def labelled_counts(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """(trained, rejected): how many envelopes give the loop an example, and how many none."""
    n = F.count("*")
    given = F.count_if(loop_example(F.col(value)).isNotNull())
    return envelopes.agg(given.alias("trained"), (n - given).alias("rejected"))


def training_example(value: Column) -> Column:
    """struct(input, output) of an envelope: its example, else its labels with a text; null without both."""
    j = lambda p: F.get_json_object(value, p)
    own = F.when(F.coalesce(j("$.example.input"), j("$.example.text")).isNotNull() & j("$.example.output").isNotNull(), F.struct(F.coalesce(j("$.example.input"), j("$.example.text")).alias("input"), j("$.example.output").alias("output")))
    labelled = F.when(j("$.labels").isNotNull() & F.coalesce(j("$.text"), j("$.document.text")).isNotNull(), F.struct(F.coalesce(j("$.text"), j("$.document.text")).alias("input"), j("$.labels").alias("output")))
    return F.when(is_json(value), F.coalesce(own, labelled))  # paths are read out of broken JSON too


def well_formed(c: Column) -> Column:
    return is_sha256(c)
