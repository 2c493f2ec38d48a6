"""Queries over captured lines, deliveries and envelopes: sources, identifiers, admission, routing, dead letters."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.shared import table
from tracewright.functions.text import redact
from tracewright.operators import audit, capture, envelopes, landing, ordered, promotion, readside, reporting
from tracewright.plans.registry import query
from tracewright.sources import captures

Spark, Frame = SparkSession, DataFrame
_LINES = "lines AS (SELECT DISTINCT rel_path, byte_offset, raw, bytes FROM raw_capture)"


def _lines(spark: Spark, d: str) -> Frame:
    return table(spark, d, "raw_capture").distinct()


def _files(spark: Spark, d: str) -> Frame:
    """Files with their size and a committed offset: the last line that begins at an even byte."""
    rows = _lines(spark, d).groupBy("rel_path").agg(F.max(F.col("byte_offset") + F.col("bytes")).alias("size"), F.max(F.when(F.col("byte_offset") % 2 == 0, F.col("byte_offset"))).alias("committed"))
    return rows.fillna(0, ["committed"])


_FILES = f"{_LINES}, files AS (SELECT rel_path, max(byte_offset + bytes) AS size, coalesce(max(CASE WHEN byte_offset % 2 = 0 THEN byte_offset END), 0) AS committed FROM lines GROUP BY rel_path)"


@query("SELECT seq_no, 'dirspool-' || substr(sha256(rel_path), 1, 12) || '-' || byte_offset AS delivery_id, id = 'dirspool-' || substr(sha256(rel_path), 1, 12) || '-' || byte_offset AS same FROM delivery")
def s7_delivery_id(spark: Spark, d: str) -> Frame:
    made = capture.delivery_id(F.col("rel_path"), F.col("byte_offset"))
    return table(spark, d, "delivery").select("seq_no", made.alias("delivery_id"), (F.col("id") == made).alias("same"))


@query("SELECT DISTINCT rel_path FROM raw_capture WHERE (rel_path LIKE '%main.ndjson' OR regexp_extract(rel_path, '[^/]*$') = 'node00-vesh.ndjson') AND NOT list_contains(string_split(rel_path, '/'), 'private')")
def s8_selected_files(spark: Spark, d: str) -> Frame:
    return captures.selected_files(table(spark, d, "raw_capture"), ["*main.ndjson", "node00-vesh.ndjson"], "private")


@query("SELECT CASE WHEN bytes > 1500 THEN 'oversize' WHEN raw IS NULL THEN 'partial' WHEN bytes <= 1 THEN 'blank' ELSE 'complete' END AS line_state, count(*) AS n FROM raw_capture GROUP BY 1")
def s9_line_states(spark: Spark, d: str) -> Frame:
    return table(spark, d, "raw_capture").groupBy(captures.line_state(F.col("bytes"), F.col("raw").isNotNull(), 1500).alias("line_state")).agg(F.count("*").alias("n"))


@query("SELECT rel_path, count(*) AS n, min(byte_offset) AS first_offset FROM raw_capture WHERE byte_offset >= 2000 GROUP BY rel_path")
def s16_start_position(spark: Spark, d: str) -> Frame:
    return captures.started(table(spark, d, "raw_capture"), offset=2000).groupBy("rel_path").agg(F.count("*").alias("n"), F.min("byte_offset").alias("first_offset"))


@query(f"WITH {_FILES} SELECT count(*) AS files_total, count(*) FILTER (committed >= size) AS files_finished, sum(least(committed, size))::BIGINT AS bytes_done, sum(size)::BIGINT AS bytes_total, min(rel_path) FILTER (committed < size) AS current, arg_min(committed, rel_path) FILTER (committed < size) AS current_offset FROM files")
def s18_cursor(spark: Spark, d: str) -> Frame:
    return reporting.cursor(_files(spark, d))


@query("SELECT DISTINCT rel_path FROM raw_capture WHERE concat('0x', substr(sha256(rel_path), 1, 16))::UBIGINT % 100000 < 25000")
def s19_hash_sample(spark: Spark, d: str) -> Frame:
    return table(spark, d, "raw_capture").select("rel_path").distinct().where(captures.sampled(F.col("rel_path"), 0.25))


@query(f"WITH {_LINES}, n AS (SELECT *, row_number() OVER (PARTITION BY rel_path ORDER BY byte_offset) AS line_no FROM lines), u AS (SELECT *, row_number() OVER (PARTITION BY rel_path ORDER BY byte_offset) AS pick FROM n WHERE line_no <= 30 AND raw LIKE '{{%') SELECT rel_path, byte_offset, line_no, pick FROM u WHERE pick <= 2 ORDER BY rel_path, byte_offset LIMIT 100")
def s20_bounded_subset(spark: Spark, d: str) -> Frame:
    rows = _lines(spark, d).withColumn("usable", F.coalesce(F.col("raw").like("{%"), F.lit(False)))
    return captures.first_lines(rows, 2, 30, 100).select("rel_path", "byte_offset", F.col("line_no").cast("bigint").alias("line_no"), F.col("pick").cast("bigint").alias("pick"))


@query(f"WITH {_LINES}, t AS (SELECT * FROM lines WHERE rel_path IS NOT NULL ORDER BY rel_path DESC, byte_offset DESC LIMIT 200) SELECT rel_path, byte_offset FROM t WHERE json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw END) = 'OBJECT'")
def s21_tail(spark: Spark, d: str) -> Frame:
    rows = captures.tail(_lines(spark, d).where("rel_path is not null"), ["rel_path", "byte_offset"], 200)
    return rows.where("try_parse_json(raw) is not null").select("rel_path", "byte_offset")


@query("SELECT seq_no, c AS cycle, CASE WHEN json_valid(value) AND json_type(CASE WHEN json_valid(value) THEN value END) = 'OBJECT' THEN c END AS loop_cycle, CASE WHEN json_valid(value) AND json_type(CASE WHEN json_valid(value) THEN value END) = 'OBJECT' THEN (value::JSON)->>'$.record_id' END AS record_id FROM envelope, (VALUES (1), (2)) t(c)")
def s11_replay(spark: Spark, d: str) -> Frame:
    """Every line in two more cycles; objects say which, and what can't be marked comes as it is."""
    rows = captures.looped(table(spark, d, "envelope").select("seq_no", "value"), 3).where("cycle > 0")
    marked = F.get_json_object("value", "$.loop_cycle").cast("int")
    return rows.select("seq_no", "cycle", marked.alias("loop_cycle"), F.when(marked.isNotNull(), F.get_json_object("value", "$.record_id")).alias("record_id"))


@query(f"""WITH {_LINES}, n AS (SELECT rel_path, byte_offset, raw, row_number() OVER (PARTITION BY rel_path ORDER BY byte_offset) AS n FROM lines),
f AS (SELECT rel_path, byte_offset, n, CASE WHEN n % 7 = 0 THEN substr(rpad(raw, 4096, 'x'), 1, 4096) WHEN n % 5 = 0 THEN '{{"envelope_version": 1, "record_id":' ELSE raw END AS raw FROM n)
SELECT rel_path, byte_offset, raw, unnest(CASE WHEN n % 3 = 0 THEN [1, 2] ELSE [1] END)::INT AS copy_no FROM f""")
def s12_faults(spark: Spark, d: str) -> Frame:
    return captures.disturbed(_lines(spark, d).select("rel_path", "byte_offset", "raw"), ["byte_offset"], 3, 5, 7, 4096)


@query()
def s24_generated(spark: Spark, d: str) -> Frame:
    return captures.generated(spark, 1000)


@query("SELECT seq_no, delivered_at::TIMESTAMP AS delivered_at FROM delivery WHERE delivered_at >= TIMESTAMPTZ '2026-08-03 06:00:00+00' ORDER BY seq_no")
def t8_replay_from_time(spark: Spark, d: str) -> Frame:
    rows = readside.replayed_from(table(spark, d, "delivery"), "delivered_at", datetime.datetime(2026, 8, 3, 6, tzinfo=datetime.UTC))
    return rows.select("seq_no", F.col("delivered_at").cast("timestamp_ntz").alias("delivered_at"))


@query(f"WITH {_LINES} SELECT rel_path, byte_offset, floor((row_number() OVER (PARTITION BY rel_path ORDER BY byte_offset) - 1) / 16)::BIGINT AS round FROM lines")
def l12_interleaved(spark: Spark, d: str) -> Frame:
    return captures.interleaved(_lines(spark, d), 16).select("rel_path", "byte_offset", "round")


@query("SELECT rel_path, row_number() OVER (ORDER BY rel_path) AS place FROM (SELECT DISTINCT rel_path FROM raw_capture WHERE rel_path IS NOT NULL)")
def l4_path_order(spark: Spark, d: str) -> Frame:
    files = table(spark, d, "raw_capture").where("rel_path is not null").select("rel_path").distinct()
    return captures.path_order(files)


@query("SELECT rel_path, byte_offset, 'raw-' || substr(sha256(rel_path || '#' || byte_offset), 1, 32) AS record_id, sha256(raw || chr(10)) AS line_sha256 FROM raw_capture")
def proj9_record_ids(spark: Spark, d: str) -> Frame:
    return table(spark, d, "raw_capture").select("rel_path", "byte_offset", capture.record_id(F.col("rel_path"), F.col("byte_offset")).alias("record_id"), F.sha2(F.concat("raw", F.lit("\n")), 256).alias("line_sha256"))


@query()
def proj1_normalized_texts(spark: Spark, d: str) -> Frame:
    return capture.normalized(_lines(spark, d)).select("rel_path", "byte_offset", "shape", "request", "response")


@query("""WITH v AS (SELECT rel_path, byte_offset, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM raw_capture WHERE json_valid(raw) AND json_type(raw) = 'OBJECT')
SELECT rel_path, byte_offset, coalesce(nullif(j->>'$.model', ''), nullif(j->>'$.upstream_model', ''), nullif(j->>'$.requested_model', ''), nullif(j->>'$.requestBody.value.model', '')) AS model,
coalesce(nullif(j->>'$.created_at', ''), nullif(j->>'$.receivedAt', ''), nullif(j->>'$.startedAt', ''), nullif(j->>'$.finishedAt', '')) AS retrieved_at FROM v""")
def proj7_observed(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "raw_capture").where("try_parse_json(raw) is not null and raw like '{%'")
    return rows.select("rel_path", "byte_offset", capture.observed_model("raw").alias("model"), capture.retrieved_at("raw").alias("retrieved_at"))


@query()
def f1_admission(spark: Spark, d: str) -> Frame:
    rows = capture.normalized(_lines(spark, d)).withColumn("reason", capture.admission_reason(["orin-7b-chat", "orin-7b", "tern-code-3", "halden-mini"]))
    return rows.groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count("*").alias("n"))


_SIDES = """sides AS (SELECT row_id, input AS request, CASE WHEN row_id % 11 = 0 THEN '[omitted: body]' WHEN row_id % 13 = 0 THEN 'short' WHEN row_id % 17 = 0 THEN '' ELSE input END AS response,
CASE WHEN row_id % 19 = 0 THEN 'broken' WHEN row_id % 23 = 0 THEN 'other' ELSE 'object' END AS parsed, row_id % 29 = 0 AS capture_error, CASE WHEN row_id % 7 = 5 THEN 413 ELSE 200 END AS status,
CASE row_id % 4 WHEN 0 THEN 'm-alpha' WHEN 1 THEN 'm-beta' WHEN 2 THEN 'm-unlisted' END AS model FROM stage0_distilled)"""


def _sides(spark: Spark, d: str) -> Frame:
    every = lambda n, r=0: F.col("row_id") % n == r
    return table(spark, d, "stage0_distilled").select(
        "row_id",
        F.col("input").alias("request"),
        F.when(every(11), "[omitted: body]").when(every(13), "short").when(every(17), "").otherwise(F.col("input")).alias("response"),
        F.when(every(19), "broken").when(every(23), "other").otherwise("object").alias("parsed"),
        every(29).alias("capture_error"),
        F.when(every(7, 5), 413).otherwise(200).alias("status"),
        F.when(every(4), "m-alpha").when(every(4, 1), "m-beta").when(every(4, 2), "m-unlisted").alias("model"),
    )


@query(f"""WITH {_SIDES} SELECT row_id, CASE WHEN parsed = 'broken' THEN 'not_json' WHEN parsed <> 'object' THEN 'not_object' WHEN coalesce(request, '') = '' OR coalesce(response, '') = '' THEN 'missing_text'
WHEN capture_error THEN 'capture_error' WHEN status <> 200 THEN 'non_200_response:' || status WHEN model IS NULL THEN 'missing_model' WHEN model NOT IN ('m-alpha', 'm-beta') THEN 'model_not_allowlisted:' || model
WHEN length(request) < 16 OR length(response) < 16 THEN 'too_short' WHEN regexp_matches(request, '(?i)\\[omitted:[^\\]]*\\]|body_too_large|\\[redacted[^\\]]*\\]') OR regexp_matches(response, '(?i)\\[omitted:[^\\]]*\\]|body_too_large|\\[redacted[^\\]]*\\]') THEN 'omitted_body' END AS reason FROM sides""")
def f1_reasons(spark: Spark, d: str) -> Frame:
    return _sides(spark, d).select("row_id", capture.admission_reason(["m-alpha", "m-beta"]).alias("reason"))


@query(f"WITH {_SIDES} SELECT row_id, CASE WHEN capture_error THEN 'capture_error' WHEN status <> 200 THEN 'non_200_response' WHEN coalesce(request, '') = '' THEN 'missing_request' END AS reason FROM sides")
def f10_prefilter(spark: Spark, d: str) -> Frame:
    from tracewright.operators import routing

    return _sides(spark, d).select("row_id", routing.prefiltered(F.col("capture_error"), F.col("status"), F.col("request")).alias("reason"))


@query("SELECT row_id FROM stage0_distilled WHERE regexp_matches(input, '(?i)\\[omitted:[^\\]]*\\]|body_too_large|\\[redacted[^\\]]*\\]')")
def f2_omitted(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_distilled").where(F.col("input").rlike(capture.OMITTED)).select("row_id")


@query("SELECT seq_no, CASE WHEN record_id IS NOT NULL AND content_sha256 IS NOT NULL THEN record_id || '|' || content_sha256 END AS idempotency_key FROM envelope")
def proj12_idempotency_key(spark: Spark, d: str) -> Frame:
    return table(spark, d, "envelope").select("seq_no", envelopes.idempotency_key(F.col("record_id"), F.col("content_sha256")).alias("idempotency_key"))


@query("SELECT regexp_matches(content_sha256, '^[0-9a-fA-F]{64}$') AS well_formed, count(*) AS n FROM envelope GROUP BY 1")
def f5_hash_form(spark: Spark, d: str) -> Frame:
    return table(spark, d, "envelope").groupBy(envelopes.well_formed(F.col("content_sha256")).alias("well_formed")).agg(F.count("*").alias("n"))


@query()
def f3_validation(spark: Spark, d: str) -> Frame:
    return envelopes.validated(table(spark, d, "envelope")).groupBy("route_class", "reason").agg(F.count("*").alias("n"))


@query()
def f4_validation_client(spark: Spark, d: str) -> Frame:
    return envelopes.validated(table(spark, d, "envelope"), dialect="client").groupBy("route_class", "reason").agg(F.count("*").alias("n"))


@query()
def proj10_canonical(spark: Spark, d: str) -> Frame:
    from tracewright.functions.text import canonical_json, content_hash

    return table(spark, d, "envelope").select("seq_no", canonical_json("value").alias("canonical"), content_hash("value").alias("computed"))


@query()
def proj8_built_envelopes(spark: Spark, d: str) -> Frame:
    rows = capture.normalized(_lines(spark, d)).withColumn("reason", capture.admission_reason(["orin-7b-chat", "orin-7b", "tern-code-3", "halden-mini"]))
    return capture.envelopes(rows.where("reason is null"), "task_trace", 2, "0" * 64)


@query("""WITH v AS (SELECT seq_no, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM envelope)
SELECT seq_no, coalesce(j->>'$.text', j->>'$.document.text') AS input, coalesce(json_keys(j, '$.labels')::VARCHAR, '') AS output_keys FROM v WHERE (j->'$.labels') IS NOT NULL AND json_type(j, '$.labels') <> 'NULL' AND coalesce(j->>'$.text', j->>'$.document.text') IS NOT NULL""")
def proj13_training_examples(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "envelope").select("seq_no", envelopes.training_example(F.col("value")).alias("e"))
    keys = F.json_object_keys("e.output")
    return rows.where("e is not null").select("seq_no", "e.input", F.concat(F.lit("["), F.array_join(keys, ", "), F.lit("]")).alias("output_keys"))


@query("SELECT seq_no, CASE WHEN attempts > 5 THEN 'retry_ceiling' END AS reason, count(*) OVER (PARTITION BY id ORDER BY seq_no) AS nth FROM delivery")
def w20_retry_ceiling(spark: Spark, d: str) -> Frame:
    return ordered.delivery_attempts(table(spark, d, "delivery").select("id", "seq_no", "attempts"), "id", "seq_no").select("seq_no", "reason", "nth")


_ROUTES = """v AS (SELECT seq_no, CASE WHEN record_id IS NULL OR record_id = '' THEN 'missing_record_id' WHEN content_sha256 IS NULL OR NOT regexp_matches(content_sha256, '^[0-9a-fA-F]{64}$') THEN 'invalid_content_sha256' END AS reason, CASE WHEN record_id <> '' AND content_sha256 <> '' THEN record_id || '|' || lower(content_sha256) END AS key FROM envelope),
m AS (SELECT v.*, d.attempts, reason IS NULL AND d.attempts <= 5 AND key IS NOT NULL AS fit FROM v JOIN delivery d USING (seq_no)),
b AS (SELECT *, coalesce(max(fit::INT) OVER (PARTITION BY key ORDER BY seq_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AND key IS NOT NULL AS dup FROM m),
r AS (SELECT seq_no, CASE WHEN dup THEN 'duplicate' WHEN attempts > 5 THEN 'dlq' WHEN reason IS NOT NULL THEN 'dlq' ELSE 'accepted' END AS route, CASE WHEN dup THEN NULL WHEN attempts > 5 THEN 'retry_ceiling' ELSE reason END AS reason FROM b)"""


def _routes(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "envelope")
    bad = F.when(F.coalesce("record_id", F.lit("")) == "", "missing_record_id").when(~F.coalesce(envelopes.well_formed(F.col("content_sha256")), F.lit(False)), "invalid_content_sha256")
    verdicts = e.select("seq_no", bad.alias("reason")).withColumn("route_class", F.when(F.col("reason").isNull(), "accepted").otherwise("dlq"))
    key = F.when((F.col("record_id") != "") & (F.col("content_sha256") != ""), envelopes.idempotency_key(F.col("record_id"), F.lower("content_sha256")))
    messages = e.select("seq_no", key.alias("key")).join(table(spark, d, "delivery").select("seq_no", "attempts"), "seq_no")
    return envelopes.routed(messages, verdicts)


@query(f"WITH {_ROUTES} SELECT * FROM r")
def t2_routes(spark: Spark, d: str) -> Frame:
    return _routes(spark, d)


@query(f"WITH {_ROUTES} SELECT count(*) AS received, count(*) FILTER (route = 'accepted') AS accepted, count(*) FILTER (route = 'duplicate') AS duplicates, count(*) FILTER (route = 'dlq') AS dlq, count(*) FILTER (route = 'quarantine') AS quarantined FROM r")
def a3_ingest_counters(spark: Spark, d: str) -> Frame:
    return reporting.ingest_counters(_routes(spark, d))


@query(f"WITH {_ROUTES} SELECT count(*) = count(*) FILTER (route = 'accepted') + count(*) FILTER (route = 'duplicate') + count(*) FILTER (route = 'dlq') + count(*) FILTER (route = 'quarantine') AS holds FROM r")
def a26_counts_add_up(spark: Spark, d: str) -> Frame:
    return reporting.ingest_counters(_routes(spark, d)).select((F.col("received") == F.col("accepted") + F.col("duplicates") + F.col("dlq") + F.col("quarantined")).alias("holds"))


@query(f"WITH {_ROUTES} SELECT kind, count(*) AS received, count(*) FILTER (route = 'accepted') AS accepted, count(*) FILTER (route = 'duplicate') AS duplicates FROM r JOIN envelope USING (seq_no) GROUP BY kind")
def a4_counters_by_kind(spark: Spark, d: str) -> Frame:
    rows = _routes(spark, d).join(table(spark, d, "envelope").select("seq_no", "kind"), "seq_no")
    return rows.groupBy("kind").agg(F.count("*").alias("received"), F.count_if(F.col("route") == "accepted").alias("accepted"), F.count_if(F.col("route") == "duplicate").alias("duplicates"))


@query(f"WITH {_ROUTES} SELECT coalesce(reason, 'unknown') AS reason, count(*) AS n FROM r GROUP BY 1")
def a1_by_reason(spark: Spark, d: str) -> Frame:
    return reporting.by_reason(_routes(spark, d))


_SKIP = f"{_SIDES}, skip AS (SELECT CASE WHEN capture_error THEN 'capture_error' WHEN status <> 200 THEN 'status' WHEN model IS NULL THEN 'model' END AS reason FROM sides)"


@query(f"WITH {_SKIP} SELECT coalesce(reason, 'unknown') AS reason, count(*) AS n FROM skip GROUP BY 1")
def a2_skip_reasons(spark: Spark, d: str) -> Frame:
    rows = _sides(spark, d).select(F.when(F.col("capture_error"), "capture_error").when(F.col("status") != 200, "status").when(F.col("model").isNull(), "model").alias("reason"))
    return reporting.by_reason(rows)


@query(f"WITH {_ROUTES} SELECT seq_no, route AS class, r.reason, adapter, attempts, sha256(value) AS raw_sha256, octet_length(encode(value))::INT AS raw_bytes FROM r JOIN delivery USING (seq_no) JOIN envelope USING (seq_no) WHERE route IN ('dlq', 'quarantine')")
def k2_dead_letters(spark: Spark, d: str) -> Frame:
    raw = table(spark, d, "delivery").select("seq_no", "adapter", "attempts").join(table(spark, d, "envelope").select("seq_no", F.col("value").alias("raw")), "seq_no")
    return envelopes.dead_letters(raw, _routes(spark, d)).drop("raw_preview")


@query("SELECT seq_no, sha256(value) AS text_sha256, length(value)::INT AS chars FROM envelope")
def k8_manifest(spark: Spark, d: str) -> Frame:
    return audit.manifest(table(spark, d, "envelope"), "seq_no", "value")


@query(f"WITH {_FILES} SELECT sum(committed)::BIGINT AS committed, sum(greatest(0, size - committed))::BIGINT AS backlog FROM files")
def a19_backlog(spark: Spark, d: str) -> Frame:
    return reporting.backlog(_files(spark, d))


@query(f"WITH {_FILES}, saved AS (SELECT rel_path, committed FROM files WHERE committed > 0 AND committed % 3 = 0) SELECT files.rel_path, files.size, coalesce(saved.committed, 0) AS committed FROM files LEFT JOIN saved USING (rel_path)")
def j5_files_with_cursors(spark: Spark, d: str) -> Frame:
    files = _files(spark, d)
    saved = files.where("committed > 0 and committed % 3 = 0").select("rel_path", "committed")
    return files.drop("committed").join(saved, "rel_path", "left").fillna(0, ["committed"])


@query("""WITH k AS (SELECT e.*, d.batch_id, max(d.batch_id) OVER () AS newest FROM envelope e JOIN delivery d USING (seq_no))
SELECT seq_no FROM k WHERE batch_id = newest AND NOT EXISTS (SELECT 1 FROM k s WHERE s.batch_id < s.newest AND s.record_id = k.record_id AND s.content_sha256 = k.content_sha256)""")
def j2_not_seen(spark: Spark, d: str) -> Frame:
    """What the newest batch brings that no earlier one had."""
    delivered = table(spark, d, "delivery").select("seq_no", "batch_id")
    rows = table(spark, d, "envelope").select("seq_no", "record_id", "content_sha256").join(delivered, "seq_no").join(F.broadcast(table(spark, d, "envelope").select("seq_no").join(delivered, "seq_no").agg(F.max("batch_id").alias("newest"))))  # one row
    return readside.not_seen(rows.where("batch_id = newest"), rows.where("batch_id < newest"), ["record_id", "content_sha256"]).select("seq_no")


@query("SELECT seq_no FROM envelope WHERE observed_model.model_id IN ('orin-7b', 'orin-7b-chat', 'tern-code-3')")
def j3_allowlisted(spark: Spark, d: str) -> Frame:
    allow = spark.createDataFrame([("orin-7b", ["orin-7b-chat"]), ("tern-code-3", None)], "model_id string, aliases array<string>")
    return landing.allowed(table(spark, d, "envelope").select("seq_no", F.col("observed_model.model_id").alias("model")), allow).select("seq_no")


@query("SELECT record_id AS request_id, arg_max(kind, seq_no) FILTER (seq_no % 2 = 0 AND kind IS NOT NULL) AS request, arg_max(created_at, seq_no) FILTER (seq_no % 2 = 1 AND created_at IS NOT NULL) AS response, min(seq_no) AS first_no FROM envelope GROUP BY record_id")
def j1_paired_sections(spark: Spark, d: str) -> Frame:
    odd = F.col("seq_no") % 2 == 1
    rows = table(spark, d, "envelope").select(F.col("record_id").alias("request_id"), F.col("seq_no").alias("no"), F.when(odd, "response").otherwise("request").alias("section"), F.when(~odd, F.col("kind")).alias("request"), F.when(odd, F.col("created_at")).alias("response"))
    return landing.paired(rows)


@query("""SELECT seq_no, CASE WHEN schema_ref.version IS DISTINCT FROM 2 THEN 'unsupported_schema_version' WHEN coalesce(record_id, '') = '' THEN 'missing_request_id'
WHEN coalesce(source_ref.uri, '') = '' OR coalesce(source_ref.content_sha256, '') = '' OR coalesce(source_ref.retrieved_at, '') = '' THEN 'incomplete_source' WHEN NOT regexp_matches(source_ref.content_sha256, '^[0-9a-fA-F]{64}$') THEN 'invalid_source_hash'
WHEN NOT coalesce(observed_model.model_id IN ('orin-7b', 'halden-mini'), false) THEN 'model_not_allowlisted' WHEN coalesce(kind, '') = '' THEN 'missing_text' END AS reason FROM envelope""")
def f6_landing_reason(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "envelope").select("seq_no", (F.col("schema_ref.version") - 1).alias("schema_version"), F.col("record_id").alias("request_id"), "source_ref.uri", "source_ref.content_sha256", "source_ref.retrieved_at", F.col("observed_model.model_id").alias("model"), F.col("kind").alias("request"), F.col("kind").alias("response"))
    return rows.select("seq_no", landing.landing_reason(["orin-7b", "halden-mini"]).alias("reason"))


@query(r"""SELECT row_id, regexp_replace(regexp_replace(regexp_replace(input, '(?i)(api[_-]?key|token|password|secret|passwd)\s*[:=]\s*\S+', '\1: [REDACTED]', 'g'), '(?i)bearer\s+[A-Za-z0-9._\-]+', '[REDACTED]', 'g'), '\bsk-[A-Za-z0-9]{10,}\b', '[REDACTED]', 'g') AS redacted FROM stage0_distilled""")
def proj15_redacted(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_distilled").select("row_id", redact("input", unicode_space=False).alias("redacted"))


@query("SELECT row_id AS request_id, sha256(concat_ws(chr(31), row_id::VARCHAR, input, source_name)) AS record_digest FROM (SELECT row_id, input, source.name AS source_name FROM stage0_distilled WHERE input IS NOT NULL AND source.name IS NOT NULL)")
def proj16_admitted(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").select(F.col("row_id").alias("request_id"), F.col("input").alias("request"), F.col("source.name").alias("response")).where("request is not null and response is not null")
    return landing.admitted(rows, "s", "p").select("request_id", "record_digest")


@query("SELECT row_id, substr(concat_ws(chr(10) || chr(10), 'Extract all entities.', input), 1, 200) AS framed FROM stage0_distilled")
def proj22_framed(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_distilled").select("row_id", capture.framed("Extract all entities.", F.col("input"), 200).alias("framed"))


@query("WITH s AS (SELECT DISTINCT ON (seq_no) seq_no, rel_path, id FROM delivery) SELECT id, min(seq_no) AS first_seq_no FROM s GROUP BY id")
def w18_first_of_key(spark: Spark, d: str) -> Frame:
    return ordered.first_of_key(table(spark, d, "delivery").select("id", F.col("seq_no").alias("first_seq_no")), "id", "first_seq_no")


@query("SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY source.name, sha256(input) ORDER BY row_id) AS nth FROM stage0_distilled WHERE input IS NOT NULL) WHERE nth = 1")
def w18_pair_window(spark: Spark, d: str) -> Frame:
    """Pair inputs new to their source's window of the last 200,000; the SQL is right for sources of no more inputs."""
    rows = table(spark, d, "stage0_distilled").where("input is not null").select(F.coalesce("source.name", F.lit("")).alias("source"), "row_id", F.sha2("input", 256).alias("digest"))
    return ordered.fifo_deduplicated(rows, "source", "row_id", "digest", 200_000).select("row_id")


@query(
    """WITH RECURSIVE d AS (SELECT rel_path, seq_no, id, row_number() OVER (PARTITION BY rel_path ORDER BY seq_no) AS n FROM delivery WHERE rel_path IS NOT NULL),
f AS (SELECT rel_path, n, seq_no, true AS fresh, [id] AS seen FROM d WHERE n = 1 UNION ALL
SELECT d.rel_path, d.n, d.seq_no, NOT list_contains(f.seen, d.id), CASE WHEN list_contains(f.seen, d.id) THEN f.seen ELSE list_append(f.seen, d.id)[-100:] END FROM f JOIN d ON d.rel_path = f.rel_path AND d.n = f.n + 1)
SELECT d.rel_path, d.seq_no, d.id FROM f JOIN d USING (rel_path, n) WHERE f.fresh"""
)
def w17_fifo_dedup(spark: Spark, d: str) -> Frame:
    return ordered.fifo_deduplicated(table(spark, d, "delivery").select("rel_path", "seq_no", "id").where("rel_path is not null"), "rel_path", "seq_no", "id", 100)


@query("SELECT rel_path, seq_no, batch_id, row_number() OVER (PARTITION BY rel_path ORDER BY seq_no DESC) AS back FROM delivery QUALIFY back <= 3")
def k6_retained(spark: Spark, d: str) -> Frame:
    return promotion.newest(table(spark, d, "delivery").select("rel_path", "seq_no", "batch_id"), "rel_path", ["seq_no"], 3)


@query("SELECT 'envelope' AS origin, count(*) AS n FROM envelope UNION ALL SELECT 'delivery', count(*) FROM delivery")
def l11_union(spark: Spark, d: str) -> Frame:
    both = captures.merged(**{t: table(spark, d, t).select("seq_no") for t in ("envelope", "delivery")})
    return both.groupBy("origin").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN request = '' AND response = '' THEN 'both_missing' WHEN request = '' THEN 'req_missing' WHEN response = '' THEN 'resp_missing' ELSE 'full' END AS side, count(*) AS n FROM (SELECT coalesce(record_id, '') AS request, coalesce(content_sha256, '') AS response FROM envelope) GROUP BY 1")
def n6_missing_sides(spark: Spark, d: str) -> Frame:
    return table(spark, d, "envelope").groupBy(capture.missing_side(F.col("record_id"), F.col("content_sha256")).alias("side")).agg(F.count("*").alias("n"))


@query("WITH n AS (SELECT seq_no, length(value) * 30 AS a, length(value) * 45 AS b FROM envelope), p AS (SELECT seq_no, a, b, least(b, 60356 - least(a, 16384)) AS p FROM n) SELECT seq_no, least(a, 60356 - p) AS request_chars, p AS response_chars FROM p")
def n4_budget(spark: Spark, d: str) -> Frame:
    size = F.length("value").cast("bigint")
    r, p = capture.two_sided_budget(size * 30, size * 45)
    return table(spark, d, "envelope").select("seq_no", r.alias("request_chars"), p.alias("response_chars"))


@query("SELECT row_id, CASE WHEN length(input) <= 200 THEN input ELSE substr(input, 1, 70) || chr(10) || '[...]' || chr(10) || right(input, 130) END AS cut FROM stage0_distilled")
def n5_head_and_tail(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_distilled").select("row_id", capture.head_and_tail(F.col("input"), 200).alias("cut"))
