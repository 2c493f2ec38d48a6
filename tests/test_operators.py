"""Column builders and folds against worked cases."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tracewright.functions import statistics as st
from tracewright.functions.scorer import DictionaryScorer, scored
from tracewright.functions.text import canonical_text, content_hash, redact
from tracewright.operators import capture, envelopes, landing, ordered, readside, routing, shaping


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in ((k, {str: "string", int: "bigint", float: "double", bool: "boolean"}[type(v)]) for k, v in values.items()))) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_canonical_json_and_hash(spark):
    assert canonical_text('{"b":1,"a":{"d":[2,1],"c":"x"}}') == '{"a":{"c":"x","d":[2,1]},"b":1}'
    assert canonical_text('{"é":"\\u001f","k":1,"k":2}') == '{"k":2,"é":"\\u001f"}'
    assert canonical_text('{"a":1} x') is None and canonical_text(None) is None
    expected = hashlib.sha256(b'{"kind":"raw_document","record_id":"r1"}').hexdigest()
    assert one(spark, content_hash("v"), v='{"record_id":"r1","content_sha256":"aa","kind":"raw_document"}') == expected


@pytest.mark.parametrize("text,kept", [("token: abc123", "token: [REDACTED]"), ("Authorization: Bearer xyz.123", "Authorization: [REDACTED]"), ("key sk-abcdefghijklmnop", "key [REDACTED]"), ("TOKEN : zü", "TOKEN: [REDACTED]")])
def test_redaction(spark, text, kept):
    assert one(spark, redact("v"), v=text) == kept


def line(**kw):
    return json.dumps(kw)


A = dict(requestBody={"kind": "json", "value": {"model": "m1", "input": [{"role": "user", "content": [{"text": "please write a parser"}]}]}}, responseBody={"value": {"output": [{"content": [{"text": "here is the parser you want"}]}]}}, responseStatus=200)
B = dict(model="m1", input_body=json.dumps({"input": [{"role": "user", "content": "please write a parser"}]}), output_body='data: {"type": "response.output_text.delta", "delta": "here is the "}\n\ndata: {"type": "x.delta", "delta": "whole parser"}\n\ndata: [DONE]\n')
CASES = [
    (line(**A), None), (line(**B), None), ("{", "not_json"), ("[1]", "not_object"), (None, "not_json"),
    (line(**{**A, "responseBody": {}}), "missing_text"), (line(**{**A, "captureError": "x"}), "capture_error"), (line(**{**A, "responseStatus": 413}), "non_200_response:413"),
    (line(**{**B, "model": ""}), "missing_model"), (line(**{**B, "model": "m9"}), "model_not_allowlisted:m9"),
    (line(**{**A, "responseBody": {"value": "fifteen letters"}}), "too_short"), (line(**{**A, "responseBody": {"value": "here [omitted: x] the rest of it"}}), "omitted_body"),
]


def test_admission(spark):
    df = spark.createDataFrame([("f", i, raw) for i, (raw, _) in enumerate(CASES)], "rel_path string, byte_offset bigint, raw string")
    rows = capture.normalized(df).withColumn("reason", capture.admission_reason(["m1"])).orderBy("byte_offset").collect()
    assert [r.reason for r in rows] == [reason for _, reason in CASES]
    assert rows[1].response == "here is the whole parser" and rows[0].request == "please write a parser"
    built = capture.envelopes(capture.normalized(df).withColumn("reason", capture.admission_reason(["m1"])).where("reason is null"), "s", 1, "a" * 64).withColumn("seq_no", F.monotonically_increasing_id())
    assert {r.reason for r in envelopes.validated(built, ("s", 1, "a" * 64), {"m1"}).collect()} == {None}


def test_other_readings():
    done = {"type": "response.completed", "response": {"output": [{"content": [{"text": "a"}]}, {"arguments": "{}"}]}}
    assert capture.completed_text({"output_body": f"data: {json.dumps(done)}\n"}) == "a\n{}"
    assert capture.user_prompt({"requestBody": {"value": {"input": [{"role": "system", "content": "no"}, {"role": "user", "content": "yes"}]}}}) == "yes"
    assert capture.walk({"value": [{"text": "a"}, {"content": ["b", {"delta": "c"}]}], "other": "x"}) == "a\nb\nc"


H = "a" * 64
GOOD = {"envelope_version": 1, "record_id": "r", "schema": {"id": "s", "version": 1, "digest": H}, "kind": "tool_task_pair", "source": {"uri": "u", "content_sha256": H, "retrieved_at": "t"}, "request": {"text": "a"}, "response": {"text": "b"}}


def bound(**changes):
    e = {k: v for k, v in {**GOOD, **changes}.items() if v is not ...}
    e.setdefault("content_sha256", hashlib.sha256(canonical_text(json.dumps(e), "content_sha256").encode()).hexdigest())
    return json.dumps({k: v for k, v in e.items() if v is not ...})


@pytest.mark.parametrize(
    "value,expected",
    [
        (bound(), None), ("not json", "envelope_not_json"), ("[]", "envelope_not_object"), (bound(envelope_version=...), "missing_envelope_version"), (bound(envelope_version=2), "unsupported_envelope_version"),
        (bound(record_id=...), "missing_record_id"), (bound(record_id=""), "empty_record_id"), (bound(content_sha256="zz"), "invalid_content_sha256"), (bound(content_sha256=H), "content_hash_mismatch"),
        (bound(schema=...), "missing_schema"), (bound(schema=3), "invalid_schema_block"), (bound(schema={"id": "s", "version": 2, "digest": H}), "schema_digest_mismatch"), (bound(kind=...), "missing_kind"), (bound(kind="x"), "unknown_kind"),
        (bound(source=...), "missing_source"), (bound(source={}), "invalid_source_block"), (bound(source={"uri": "", "content_sha256": H, "retrieved_at": "t"}), "source_requires_uri_and_retrieved_at"), (bound(source={"uri": "u", "content_sha256": "x", "retrieved_at": "t"}), "invalid_source_content_sha256"),
        (bound(kind="labelled_example"), "labelled_example_requires_labels"), (bound(kind="raw_document"), "raw_document_requires_document"), (bound(request=...), "tool_task_pair_requires_request"), (bound(response={}), "response_requires_text"), (bound(response={"text": ""}), "response_text_is_empty"),
        (bound(observed_model=3), "invalid_observed_model"), (bound(observed_model={"model_id": ""}), "observed_model_requires_model_id"), (bound(observed_model={"model_id": "m2"}), "observed_model_not_allowlisted"), ("x" * 5000, "oversized_message"),
    ],
)
def test_envelope_reasons(value, expected):
    assert envelopes.reason(value, ("s", 1, H), {"m1"}, 4096) == expected


def test_training_examples(spark):
    v = F.col("v")
    got = lambda e: one(spark, envelopes.training_example(v), v=json.dumps(e))
    assert got({"example": {"input": "a", "output": 1}}).input == "a" and got({"text": "b", "labels": {}}).input == "b" and got({"document": {"text": "c"}, "labels": {}}).input == "c"
    assert got({"labels": {}}) is None and got({"example": {"output": 1}}) is None


POLICY = routing.Policy("p", 1, ("m",), {"coding": "allow", "chat": "review"}, 0.75, allowed={"tool": ("Python",)})


@pytest.mark.parametrize(
    "model,task,score,tool,action,reasons",
    [("m", "coding", 0.92, "python", "allow", []), ("x", "coding", 0.92, "python", "reject", ["model_not_allowlisted"]), ("m", "coding", 0.4, "python", "review", ["confidence_below_threshold"]), ("m", "other", 0.9, "python", "reject", ["task_type_unknown"]), ("m", "coding", 0.9, "Zig", "review", ["tool_not_allowlisted:Zig"])],
)
def test_router(spark, model, task, score, tool, action, reasons):
    df = spark.createDataFrame([(model, task, score, [tool])], "m string, t string, s double, e array<string>")
    found = routing.reasons(POLICY, F.col("m"), F.col("t"), F.col("s"), F.lit(True), {"tool": F.col("e")}, F.lit(None).cast("double"))
    r = df.withColumn("r", found).select("r", routing.action(POLICY, F.col("t"), F.col("r")).alias("a")).first()
    assert (r.a, r.r) == (action, reasons)


def test_choices_and_top_labels(spark):
    m = F.create_map(F.lit("PyTorch"), F.lit(0.91), F.lit("SQL"), F.lit(0.11), F.lit("Python"), F.lit(1.82))
    assert [c.choice for c in one(spark, routing.choices(m))] == ["Python", "PyTorch", "SQL"]
    assert [c.choice for c in one(spark, routing.choices(F.lit(None).cast("map<string,double>"), entities=F.create_map(F.lit("e"), F.lit(0.5))))] == ["e"]
    p = F.array(*[F.struct(F.lit(x).alias("label"), F.lit(v).alias("p")) for x, v in (("b", 0.2), ("a", 0.2), ("c", 0.1))])
    assert one(spark, st.top_labels(p, 3, 0.25)) == ["a"] and one(spark, st.top_labels(p, 2, 0.1)) == ["a", "b"]


def test_percentiles(spark):
    df = spark.createDataFrame([("k", v) for v in (10.0, 20.0, 30.0, 40.0, float("nan"))] + [("n", float("inf")), ("t", 1.0), ("t", 1.0)], "k string, v double")
    read = lambda f: {r.k: r.v for r in f.collect()}
    assert read(st.percentile_linear(df, "k", "v", 0.95)) == {"k": pytest.approx(38.5), "t": 1.0}
    assert read(st.percentile_nearest(df, "k", "v", 0.5)) == {"k": 30.0, "t": 1.0}
    assert read(st.percentile_floor(df, "k", "v", 0.95))["k"] == 30.0 and read(st.percentile_soak(df, "k", "v", 0.5))["k"] == 30.0
    assert read(st.percentile_soak(df.where("false"), "k", "v", 0.95)) == {}


def test_drift_cases():
    run = lambda policy, losses: [ordered_step for s in [ordered.DriftState(policy)] for ordered_step in [s.step({"loss": x, "ema_norm": 1.0}) for x in losses]]
    p = ordered.DriftPolicy(eval_window=2, min_windows=3, loss_ratio=2.0, reset_cooldown_steps=1)
    out = run(p, [1, 1] + [3] * 6)
    assert out[-1]["reset_required"] and out[-1]["reason"] == "loss_window_exceeded" and out[-1]["resets"] == 1 and not any(o["reset_required"] for o in out[:-1])
    assert run(ordered.DriftPolicy(eval_window=2, min_windows=1, reset_cooldown_steps=1), [float("nan")])[0]["reason"] == "non_finite_loss"
    s = ordered.DriftState(p)
    s.step({"loss": 1.0, "ema_norm": 1.0})
    assert ordered.DriftState(p, json.loads(json.dumps(s.saved()))).saved() == s.saved()


def test_fifo_window_and_warmup():
    fresh, window = ordered.fifo_dedup(["a", "b", "c", "a", "c"], 2)
    assert fresh == [True, True, True, True, False] and window == ["c", "a"]
    assert ordered.warmup([True, True, False, True], 3) == [2, 1, 3, 2]


def test_moving_average_is_the_fold(spark):
    values = [float(i * 7 % 11) for i in range(50)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i int, v double")
    old = values[0]
    for v in values[1:]:
        old = old * 0.9 + v * 0.1
    assert ordered.moving_average(df, "k", ["i"], "v", 0.9).first().ema == pytest.approx(old)


def test_streamed_folds_cross_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(f"s{k}", i, f"{i % 13}") for k in range(3) for i in range(60)] + [(None, i, "x") for i in range(9)]
        got = ordered.fifo_deduplicated(spark.createDataFrame(rows, "s string, n int, id string"), "s", "n", "id", 5).collect()
        expected = []
        for s in ("s0", "s1", "s2", None):
            own = [r for r in rows if r[0] == s]
            expected += [r for r, fresh in zip(own, ordered.fifo_dedup([r[2] for r in own], 5)[0]) if fresh]
        assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)


def test_pairing_and_failure(spark):
    df = spark.createDataFrame([("a", 1, "request", "q", None), ("a", 2, "response", None, "r1"), ("a", 3, "response", None, "r2"), ("b", 4, None, "q", "r"), ("c", 5, "request", "q", None)], "request_id string, no int, section string, request string, response string")
    rows = {r.request_id: (r.request, r.response) for r in landing.complete(landing.paired(df)).collect()}
    assert rows == {"a": ("q", "r2"), "b": ("q", "r")}
    with pytest.raises(Exception, match="incomplete pair"):
        landing.complete(landing.paired(df), "fail").collect()


def test_graph(spark):
    tasks = spark.createDataFrame([("a", "accepted"), ("b", "open"), ("c", "open"), ("d", "open"), ("e", "accepted")], "task string, state string")
    needs = spark.createDataFrame([("b", "a"), ("c", "d"), ("d", "c"), ("b", "zz"), ("e", "b")], "task string, needs string")
    errors = {tuple(r) for r in readside.graph_errors(tasks, needs).collect()}
    assert errors == {("b", "unknown_dependency:zz"), ("e", "accepted_before:b"), ("c", "cycle"), ("d", "cycle")}
    assert readside.frontier(tasks, needs.where("needs <> 'zz'")).collect() == [("b",)]


def test_shaping(spark):
    ent = F.map_from_arrays(F.array(F.lit("tool"), F.lit("x")), F.array(F.array(F.lit(" Docker "), F.lit("")), F.array(F.lit("y"))))
    assert one(spark, shaping.shaped_entities(ent, ["tool"])) == {"tool": ["Docker"]}
    assert one(spark, shaping.coerced(F.lit("12"), "int")) == 12 and one(spark, shaping.coerced(F.lit("x"), "int")) is None
    assert one(spark, shaping.rendered_blocks(F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("text"))))) == "USER:\nhi"


def test_scorer(spark):
    s = DictionaryScorer({"tool": ["git", "make"]}, {"coding": ["code"], "chat": ["hello"]})
    r = scored(spark.createDataFrame([("use git, not gitlab code", 1), (None, 2)], "t string, n int"), "t", s).orderBy("n").collect()
    assert [(x.text, x.start) for x in r[0].spans] == [("git", 4)] and r[0].probabilities["coding"] == pytest.approx(2 / 3) and r[1].spans is None
