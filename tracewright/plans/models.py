"""Queries over labelling, promotion and the lineages of models."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import scorer
from tracewright.functions.shared import shared_dir, table
from tracewright.operators import capture, lineage, promotion, shaping
from tracewright.plans.registry import query
from tracewright.sources import captures

Spark, Frame = SparkSession, DataFrame


@dataclass(frozen=True)
class Labels:
    """A schema for the queries here."""

    entities: tuple[str, ...] = ("technology", "tool")
    classifications: dict = field(default_factory=lambda: {"confidence": ["high", "low"]})
    fields: dict = field(default_factory=dict)
    relations: tuple[str, ...] = ()


# --- classification ----------------------------------------------------------------------------------------------------
_P = "list_transform(range(1, 11), lambda i: struct_pack(label := 'L' || (i - 1), p := round(abs(embedding[i])::DOUBLE, 6)))"
_RANKED = f"j AS (SELECT vec_id, unnest({_P}) AS e FROM embeddings), r AS (SELECT vec_id, e.label AS label, e.p AS p FROM j)"


def _maps(spark: Spark, d: str) -> Frame:
    entries = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.struct(F.concat(F.lit("L"), (i - 1).cast("string")).alias("key"), F.round(F.abs(F.element_at("embedding", i)).cast("double"), 6).alias("value")))
    return table(spark, d, "embeddings").select("vec_id", F.map_from_entries(entries).alias("probabilities"))


_MULTI = f"WITH {_RANKED}, k AS (SELECT vec_id, string_agg(label, ',' ORDER BY p DESC, label) AS labels, max(p) AS confidence FROM r WHERE label IN ('L0', 'L1', 'L2', 'L3', 'L4', 'L5') AND p >= 0.3 GROUP BY vec_id)"


@query(f"{_MULTI} SELECT e.vec_id, coalesce(labels, '') AS labels, confidence FROM embeddings e LEFT JOIN k USING (vec_id)")
def m3_multi_label(spark: Spark, d: str) -> Frame:
    out = scorer.multi_label(F.col("probabilities"), [f"L{i}" for i in range(6)], 0.3)
    return _maps(spark, d).select("vec_id", out.alias("o")).select("vec_id", F.array_join("o.value", ",").alias("labels"), "o.confidence")


@query(f"{_MULTI}, t AS (SELECT vec_id, arg_min(label, struct_pack(n := -p, l := label)) AS task, max(p) AS p FROM r WHERE label IN ('L6', 'L7', 'L8') GROUP BY vec_id) SELECT t.vec_id, CASE WHEN p >= 0.3 THEN task END AS task, coalesce(labels, '') AS labels FROM t LEFT JOIN k USING (vec_id)")
def m4_tool_task(spark: Spark, d: str) -> Frame:
    out = scorer.tool_task(F.col("probabilities"), ["L6", "L7", "L8"], [f"L{i}" for i in range(6)], 0.3)
    return _maps(spark, d).select("vec_id", out.alias("o")).select("vec_id", F.col("o.task_type.value").alias("task"), F.array_join("o.decision_choice.value", ",").alias("labels"))


class BatchScorer(scorer.DictionaryScorer):
    """A scorer that is given several texts at once."""

    def batch(self, texts: list[str]) -> list[tuple[list[dict], dict[str, float]]]:
        return [(self.spans(t), self.probabilities(t)) for t in texts]


@query("SELECT row_id, 1 + (length(lower(text)) - length(replace(lower(text), 'restart', ''))) // 7 AS hits FROM stage0_heldout WHERE text IS NOT NULL")
def m5_batched(spark: Spark, d: str) -> Frame:
    """Texts judged 16 at a time; hits come back from the two shares."""
    texts = table(spark, d, "stage0_heldout").where("text is not null").select("row_id", "text")
    p = scorer.scored(texts, "text", BatchScorer({}, {"a": ["restart"], "b": []}), 16)
    return p.select("row_id", F.round(F.col("probabilities")["a"] / F.col("probabilities")["b"]).cast("bigint").alias("hits"))


# --- shaping -------------------------------------------------------------------------------------------------------------
def _extracted(spark: Spark, d: str) -> Frame:
    """An extraction made of the examples: entities with their places, one label, no fields."""
    rows = table(spark, d, "stage0_distilled").where("input is not null and output.entities is not null")
    spans = F.transform_values("output.entities", lambda k, v: F.transform(v, lambda t: F.struct(t.alias("text"), F.when(F.instr(F.col("input"), t) > 0, F.instr(F.col("input"), t) - 1).alias("start"), F.when(F.instr(F.col("input"), t) > 0, F.instr(F.col("input"), t) - 1 + F.length(t)).alias("end"))))
    label = F.try_element_at(F.try_element_at("output.classifications", F.lit(1))["true_label"], F.lit(1))
    task = F.try_element_at("output.classifications", F.lit(1))["task"]
    labels = F.when(task.isNotNull() & label.isNotNull(), F.create_map(task, label)).otherwise(F.create_map().cast("map<string,string>"))
    none, pairs = F.create_map().cast("map<string,string>"), F.create_map().cast("map<string,array<struct<head:struct<text:string,start:int,end:int>,tail:struct<text:string,start:int,end:int>>>>")
    return rows.select("row_id", shaping.teacher_output(spans, labels, none, pairs, Labels()).alias("o"))


_EXTRACTED = """x AS (SELECT row_id, input, output.classifications[1] AS c, unnest(map_entries(output.entities)) AS e FROM stage0_distilled WHERE input IS NOT NULL AND output.entities IS NOT NULL),
v AS (SELECT row_id, input, e.key AS label, list_filter(e.value, lambda t: t <> '') AS texts FROM x WHERE e.key IN ('technology', 'tool'))"""


@query(f"WITH {_EXTRACTED} SELECT row_id, label, array_to_string(texts, '|') AS texts, len(list_filter(texts, lambda t: instr(input, t) > 0))::INT AS n_evidence, coalesce(list_sum(list_transform(list_filter(texts, lambda t: instr(input, t) > 0), lambda t: instr(input, t) - 1)), 0)::BIGINT AS starts FROM v WHERE len(texts) > 0")
def proj19_teacher_output(spark: Spark, d: str) -> Frame:
    rows = _extracted(spark, d).select("row_id", F.explode("o.entities").alias("label", "texts"), F.col("o.evidence").alias("evidence"))
    own = F.filter(F.element_at("evidence", F.col("label")), lambda s: s["text"] != "")
    return rows.select("row_id", "label", F.array_join("texts", "|").alias("texts"), F.size(own).alias("n_evidence"), F.aggregate(own, F.lit(0).cast("bigint"), lambda a, s: a + s["start"]).alias("starts"))


@query("SELECT row_id, c.task AS task, 'high,low' AS labels, c.true_label[1] AS true_label FROM (SELECT row_id, output.classifications[1] AS c FROM stage0_distilled WHERE input IS NOT NULL AND output.entities IS NOT NULL) WHERE c.task = 'confidence' AND c.true_label[1] IN ('high', 'low')")
def proj18_training_form(spark: Spark, d: str) -> Frame:
    rows = _extracted(spark, d).select("row_id", F.explode(shaping.training_form(F.col("o"), Labels(), "0" * 64)["classifications"]).alias("c"))
    return rows.select("row_id", "c.task", F.array_join("c.labels", ",").alias("labels"), F.array_join("c.true_label", ",").alias("true_label"))


@query("""WITH v AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '"' || event_id || '"' WHEN 1 THEN event_id || '.7' WHEN 2 THEN 'true' WHEN 3 THEN '"n/a"' ELSE '[]' END AS raw FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_id::VARCHAR END AS as_int, CASE event_id % 5 WHEN 0 THEN '"' || event_id || '"' WHEN 1 THEN '"' || event_id || '.7"' WHEN 2 THEN '"True"' WHEN 3 THEN '"n/a"' END AS as_str, CASE WHEN event_id % 5 < 4 THEN '[' || raw || ']' END AS as_list,
CASE event_id % 5 WHEN 0 THEN event_id::VARCHAR ELSE raw END AS kept_int, CASE WHEN event_id % 5 < 4 THEN 'true' END AS as_bool FROM v""")
def proj20_typed_fields(spark: Spark, d: str) -> Frame:
    n = F.col("event_id").cast("string")
    k = F.col("event_id") % 5
    raw = F.when(k == 0, F.concat(F.lit('"'), n, F.lit('"'))).when(k == 1, F.concat(n, F.lit(".7"))).when(k == 2, "true").when(k == 3, '"n/a"').otherwise("[]")
    rows = table(spark, d, "events").where("event_id is not null").select("event_id", raw.alias("raw"))
    typed = {f"as_{t}": shaping.coerced_field(F.col("raw"), t) for t in ("int", "str", "list", "bool")}
    return rows.select("event_id", *[c.alias(name) for name, c in typed.items()], shaping.normalized_field(F.col("raw"), "int").alias("kept_int"))


@query("SELECT row_id, coalesce(cardinality(output.entities), 0)::INT AS n_entities FROM stage0_distilled WHERE output IS NOT NULL")
def proj21_without_provenance(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").where("output is not null").select("row_id", F.col("output").withField("provenance", F.col("source.uri")).withField("_evidence", F.lit(1)).alias("o"))
    kept = rows.select("row_id", shaping.without_training_only(F.col("o"), ["entities", "classifications", "provenance", "_evidence"]).alias("o"))
    assert kept.schema["o"].dataType.fieldNames() == ["entities", "classifications"]
    return kept.select("row_id", F.coalesce(F.size("o.entities"), F.lit(0)).alias("n_entities"))


@query("WITH e AS (SELECT row_id, text, unnest(map_entries(labels)) AS e FROM stage0_heldout WHERE text IS NOT NULL AND labels IS NOT NULL) SELECT row_id, max((len(list_filter(e.value, lambda t: instr(text, t) > 0)) > 0)::INT)::BOOLEAN AS evident, sum(len(e.value))::BIGINT AS n_values FROM e GROUP BY row_id")
def proj29_entity_values(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_heldout").where("text is not null and size(labels) > 0")
    spans = F.transform_values("labels", lambda k, v: F.transform(v, lambda t: F.struct(t.alias("text"), F.when(F.instr(F.col("text"), t) > 0, F.instr(F.col("text"), t) - 1).alias("start"), F.when(F.instr(F.col("text"), t) > 0, F.instr(F.col("text"), t)).alias("end"))))
    rows = rows.withColumn("spans", spans)
    n = F.aggregate(F.map_values("spans"), F.lit(0).cast("bigint"), lambda a, v: a + F.size(shaping.entity_values(F.array().cast("array<string>"), v)))
    return rows.select("row_id", shaping.has_evidence(F.create_map().cast("map<string,array<string>>"), F.col("spans")).alias("evident"), n.alias("n_values"))


@query("""WITH v AS (SELECT rel_path, byte_offset, raw::JSON AS j FROM (SELECT DISTINCT rel_path, byte_offset, raw FROM raw_capture) WHERE json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw END) = 'OBJECT')
SELECT rel_path, byte_offset, coalesce(nullif(j->>'$.input_body', ''), nullif(j->>'$.request_json', '')) IS NOT NULL AS has_request, coalesce(nullif(j->>'$.output_body', ''), nullif(j->>'$.response_json', '')) IS NOT NULL AS has_response FROM v""")
def n2_capture_bodies(spark: Spark, d: str) -> Frame:
    """Which sides a capture has by the names of the second and third shape."""
    rows = table(spark, d, "raw_capture").select("rel_path", "byte_offset", "raw").distinct().where("raw like '%{%' and try_parse_json(raw) is not null and schema_of_variant(try_parse_json(raw)) like 'OBJECT%'")
    request, response = capture.named_bodies("raw")
    return rows.select("rel_path", "byte_offset", request.isNotNull().alias("has_request"), response.isNotNull().alias("has_response"))


@query("SELECT event_id, 'USER:' || chr(10) || event_type || chr(10) || chr(10) || 'TOOL_CALL f' || user_id || ':' || chr(10) || '{}' || chr(10) || chr(10) || 'TOOL_RESULT:' || chr(10) || event_type || CASE WHEN event_id % 2 = 0 THEN chr(10) || chr(10) || 'REASONING:' || chr(10) || 'r' ELSE '' END AS rendered FROM events")
def n3_rendered_request(spark: Spark, d: str) -> Frame:
    item = lambda role, text, name=None: F.struct(F.lit(role).alias("role"), (F.lit(None).cast("string") if name is None else name).alias("name"), text.alias("text"))
    items = F.array(item("user", F.col("event_type")), item("other", F.lit("no")), item("tool_call", F.lit("{}"), F.concat(F.lit("f"), F.col("user_id").cast("string"))), item("tool_result", F.col("event_type")), item("system", F.lit("")), item("reasoning", F.when(F.col("event_id") % 2 == 0, F.lit("r"))))
    return table(spark, d, "events").select("event_id", shaping.rendered_request(items).alias("rendered"))


# --- from labels to a promoted model -------------------------------------------------------------------------------------------
@query("""WITH r AS (SELECT row_id, source.name AS s, teacher.model AS m, row_number() OVER (PARTITION BY source.name, teacher.model ORDER BY sha256('42:' || row_id), row_id) AS k, count(*) OVER (PARTITION BY source.name, teacher.model) AS n FROM stage0_distilled)
SELECT row_id, CASE WHEN k <= floor(n * 0.02) THEN 'val' WHEN k <= floor(n * 0.02) * 2 THEN 'test' ELSE 'train' END AS split FROM r""")
def n8_stratified_split(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").select("row_id", F.col("source.name").alias("source"), F.col("teacher.model").alias("model"))
    return promotion.stratified_split(rows, "row_id", ["source", "model"], {"train": 0.96, "val": 0.02, "test": 0.02}).select("row_id", "split")


_CHILDREN = {"click": ["g0", "g1"], "view": ["g1", "g2"], "purchase": ["g0"]}
_LABELLED = "l AS (SELECT event_id, event_type AS gold_task, CASE WHEN event_id % 7 = 0 THEN 'view' ELSE event_type END AS pred_task, 'g' || user_id % 3 AS gold_group, 'g' || (user_id + (event_id % 11 = 0)::INT) % 3 AS pred_group, 1 + event_id % 3 AS attempts FROM events)"
_FITS = "coalesce((pred_task = 'click' AND pred_group IN ('g0', 'g1')) OR (pred_task = 'view' AND pred_group IN ('g1', 'g2')) OR (pred_task = 'purchase' AND pred_group = 'g0'), false)"


def _labelled(spark: Spark, d: str) -> Frame:
    e, g = table(spark, d, "events"), lambda c: F.concat(F.lit("g"), (c % 3).cast("string"))
    n = F.col("event_id")
    return e.select(n, F.col("event_type").alias("gold_task"), F.when(n % 7 == 0, "view").otherwise(F.col("event_type")).alias("pred_task"), g(F.col("user_id")).alias("gold_group"), g(F.col("user_id") + (n % 11 == 0).cast("int")).alias("pred_group"), (1 + n % 3).alias("attempts"))


@query(f"WITH {_LABELLED}, a AS (SELECT *, gold_task = pred_task AS t, gold_group = pred_group AS g, {_FITS} AS fits FROM l) SELECT count(*) AS n, round(avg((t AND g)::INT), 6) AS exact_match, round(avg((t AND g AND attempts = 1)::INT), 6) AS first_shot_exact, round(avg(fits::INT), 6) AS pairing_rate, round(avg(t::INT), 6) AS acc_task, round(avg(g::INT), 6) AS acc_group FROM a")
def n9_field_accuracy(spark: Spark, d: str) -> Frame:
    fits = promotion.child_fits(F.col("pred_task"), F.col("pred_group"), _CHILDREN)
    out = promotion.field_accuracy(_labelled(spark, d), ["task", "group"], paired=fits)
    return out.select("n", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(f"WITH {_LABELLED} SELECT attempts, count(*) AS n FROM l GROUP BY attempts")
def n9_attempts(spark: Spark, d: str) -> Frame:
    return promotion.attempts_histogram(_labelled(spark, d))


@query(f"WITH {_LABELLED} SELECT event_id, {_FITS} AS fits FROM l")
def n10_parent_child(spark: Spark, d: str) -> Frame:
    return _labelled(spark, d).select("event_id", promotion.child_fits(F.col("pred_task"), F.col("pred_group"), _CHILDREN).alias("fits"))


@query("""WITH u AS (SELECT row_id, text, lower(regexp_extract(regexp_replace(uri, '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?]*)', 1)) || substr(regexp_replace(regexp_replace(uri, '#.*$', ''), '/+$', ''), length(regexp_extract(regexp_replace(uri, '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?]*)', 1)) + 1) AS url FROM stage0_corpus),
a AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY row_id) AS k FROM u), b AS (SELECT * FROM a WHERE k = 1 OR url IS NULL), c AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY row_id) AS t FROM b) SELECT row_id FROM c WHERE t = 1 OR text IS NULL""")
def n11_distinct_documents(spark: Spark, d: str) -> Frame:
    return promotion.distinct_documents(table(spark, d, "stage0_corpus"), "uri", "text", "row_id").select("row_id")


@query("WITH c AS (SELECT row_id, uri, text, unnest(range(0, greatest(1, ceil((length(text) - 40) / 160.0)::BIGINT))) AS k FROM stage0_corpus WHERE length(text) > 0) SELECT row_id, k::INT AS chunk_no, (k * 160)::INT AS start_char, sha256(substr(text, k * 160 + 1, 200)) AS digest, CASE WHEN concat('0x', substr(sha256('42:' || uri), 1, 12))::UBIGINT % 10000 < 9600 THEN 'train' WHEN concat('0x', substr(sha256('42:' || uri), 1, 12))::UBIGINT % 10000 < 9800 THEN 'val' ELSE 'test' END AS split FROM c WHERE uri IS NOT NULL")
def n11_chunks(spark: Spark, d: str) -> Frame:
    """Overlapping pieces with their places; all pieces of a document fall into one split."""
    rows = table(spark, d, "stage0_corpus").where("uri is not null").select("row_id", "text", promotion.split_by_document(F.col("uri"), {"train": 0.96, "val": 0.02, "test": 0.02}).alias("split"))
    return promotion.chunks(rows, "text", 200, 40).select("row_id", "chunk_no", "start_char", F.sha2("chunk", 256).alias("digest"), "split")


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'canary' WHEN event_id % 3 = 0 THEN 'stable' ELSE 'recent' END AS tier FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY event_id) - 1 AS k, CASE tier WHEN 'stable' THEN 4 ELSE 12 END AS q FROM t WHERE tier <> 'canary'), b AS (SELECT min(c) AS batches FROM (SELECT floor(count(*) / any_value(q))::BIGINT AS c FROM n GROUP BY tier))
SELECT event_id, tier, floor(k / q)::BIGINT AS batch_no, (k % q)::BIGINT AS slot FROM n, b WHERE floor(k / q) < batches""")
def n12_replay_batches(spark: Spark, d: str) -> Frame:
    n = F.col("event_id")
    rows = table(spark, d, "events").select(n, F.when(n % 10 == 0, "canary").when(n % 3 == 0, "stable").otherwise("recent").alias("tier"))
    return promotion.replay_batches(rows, "tier", "event_id", {"stable": 4, "recent": 12})


_CAL = "c AS (SELECT least(1.0, value / 150) AS p, event_id % 4 <> 0 AS ok FROM events), b AS (SELECT least(9, floor(p * 10)) AS b, count(*) AS n, avg(p) AS p, avg(ok::INT) AS a FROM c GROUP BY 1), ece AS (SELECT sum(n * abs(p - a)) / sum(n) AS ece FROM b)"
_PSI = "k AS (SELECT event_type AS c, count(*) FILTER (event_id % 2 = 0) AS e, count(*) FILTER (event_id % 2 = 1 AND value < 60) AS a FROM events GROUP BY event_type), s AS (SELECT greatest(a / sum(a) OVER (), 1e-4) AS pa, greatest(e / sum(e) OVER (), 1e-4) AS pe FROM k), psi AS (SELECT sum((pa - pe) * ln(pa / pe)) AS psi FROM s)"


@query(f"WITH {_CAL}, {_PSI} SELECT round(ece, 6) AS ece, round(psi, 6) AS psi, concat_ws(',', CASE WHEN ece > 0.12 THEN 'ece' END, CASE WHEN psi > 0.25 THEN 'psi' END) AS failed FROM ece, psi")
def n13_promotion_gates(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    ece = promotion.calibration_error(e.select(F.least(F.lit(1.0), F.col("value") / 150).alias("p"), (F.col("event_id") % 4 != 0).alias("ok")), "p", "ok").select("ece")
    psi = promotion.stability_index(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1 and value < 60"), "event_type")
    figures = promotion.promotion_gates(ece.join(F.broadcast(psi)))  # one row each
    return figures.select(F.round("ece", 6).alias("ece"), F.round("psi", 6).alias("psi"), F.array_join("failed", ",").alias("failed"))


# --- lineages ------------------------------------------------------------------------------------------------------------------
_CHECKPOINTS = "p AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'full' ELSE 'adapter-only' END AS kind, CASE WHEN event_id % 3 = 0 THEN 'd0' ELSE 'd1' END AS digest, event_id % 5 = 0 AS lacks, user_id FROM events)"


def _checkpoints(spark: Spark, d: str) -> Frame:
    n = F.col("event_id")
    keys = F.when(n % 5 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("a")))
    return table(spark, d, "events").select(n.cast("string").alias("checkpoint"), F.when(n % 17 == 0, "full").otherwise("adapter-only").alias("kind"), F.when(n % 3 == 0, "d0").otherwise("d1").alias("config_digest"), keys.alias("adapter_keys"), n.alias("training_steps"), F.col("user_id").alias("ema_updates"), F.lit(1).alias("reset_id"), (n % 2 == 0).alias("has_optimizer"))


@query(f"WITH {_CHECKPOINTS} SELECT event_id::VARCHAR AS checkpoint, CASE WHEN kind = 'full' THEN 'unsupported_checkpoint' WHEN digest <> 'd1' THEN 'config_digest_mismatch' WHEN lacks THEN 'adapter_keys_mismatch' END AS error, CASE WHEN kind <> 'full' AND digest = 'd1' AND NOT lacks THEN event_id END AS training_steps FROM p")
def t14_resumed(spark: Spark, d: str) -> Frame:
    return lineage.resumed(_checkpoints(spark, d), "d1", ["a", "b"]).select("checkpoint", "error", "training_steps")


@query(f"WITH {_CHECKPOINTS} SELECT event_id::VARCHAR AS checkpoint, digest AS checkpoint_config_digest, 'd1' AS current_config_digest, event_id AS training_steps, user_id AS ema_updates FROM p WHERE kind <> 'full' AND digest = 'd0' AND NOT lacks")
def t14_warm_starts(spark: Spark, d: str) -> Frame:
    return lineage.warm_starts(_checkpoints(spark, d), "d1", ["b", "a"]).select("checkpoint", "checkpoint_config_digest", "current_config_digest", "training_steps", "ema_updates")


@query("SELECT user_id::VARCHAR AS lineage, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS reset_id, event_id AS step, 'runs/' || user_id || '/reset-' || lpad((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::VARCHAR, 4, '0') || '-step-' || event_id AS archive FROM events WHERE event_type = 'error'")
def t13_resets(spark: Spark, d: str) -> Frame:
    from tracewright.operators.ordered import resumed_numbers

    rows = resumed_numbers(table(spark, d, "events").where("event_type = 'error'").select("user_id", "event_id"), "user_id", ["event_id"], 0, "resets")
    verdicts = rows.select(F.col("user_id").cast("string").alias("lineage"), F.col("event_id").alias("step"), "resets", F.lit(True).alias("reset_required"), F.lit("x").alias("reason"))
    return lineage.reset_events(verdicts, "runs", 20).select("lineage", "reset_id", "step", "archive")


@query(
    """WITH RECURSIVE e AS (SELECT user_id AS l, event_id, event_type = 'error' AS reset, value < 60 AS fine, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
w AS (SELECT l, n, event_id, CASE WHEN reset THEN 4 ELSE 0 END AS remaining, false AS published FROM e WHERE n = 1
UNION ALL SELECT e.l, e.n, e.event_id, CASE WHEN e.reset THEN 4 WHEN w.remaining > 1 THEN w.remaining - 1 WHEN w.remaining = 1 AND NOT e.fine THEN 4 ELSE 0 END, NOT e.reset AND w.remaining = 1 AND e.fine FROM w JOIN e ON e.l = w.l AND e.n = w.n + 1)
SELECT l::VARCHAR AS lineage, event_id AS ord, remaining::BIGINT AS remaining, published FROM w"""
)
def w14_warmups(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "events").select(F.col("user_id").alias("lineage"), F.col("event_id").alias("ord"), (F.col("event_type") == "error").alias("reset"), (F.col("value") < 60).alias("fine"))
    return lineage.warmups(rows, 4).drop("phase")


@query("SELECT user_id, max(value) AS top FROM events GROUP BY user_id")
def t11_served(spark: Spark, d: str) -> Frame:
    """What readers get after two publications: the second one."""
    root = f"{shared_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    e = table(spark, d, "events").groupBy("user_id")
    lineage.publish(e.agg(F.min("value").alias("top")), root)
    lineage.publish(e.agg(F.max("value").alias("top")), root)
    return lineage.served(spark, root)


@query("SELECT seq_no AS \"offset\", 0 AS cycle FROM envelope WHERE seq_no >= 100 AND seq_no < 1100 UNION ALL SELECT 0, 0 WHERE false")
def s10_resumed_replay(spark: Spark, d: str) -> Frame:
    """A replay that goes on from a saved place takes the next thousand lines: a bounded batch by definition."""
    lines = table(spark, d, "envelope").select(F.col("seq_no").alias("place"), "value")
    point = captures.resume_point({"committed": 100}, 1_000_000_000)
    return captures.mock_batch(lines, 1_000_000_000, point, 1000)[0].select("offset", "cycle")
