import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracewright.functions import scorer
from tracewright.functions.ordering import numbered, previous, running_sum
from tracewright.functions.shared import read_text, write_text
from tracewright.operators import lineage, ordered, promotion, shaping
from tracewright.plans.models import BatchScorer, Labels


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_running_sums_within_keys_that_span_partitions(spark, partitions):
    rows = [("hot", i, i % 4) for i in range(200)] + [(k, i, 1) for k in ("a", "b", None, "z") for i in range(7)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k string, o int, w int")
        got = {(r.k, r.o): (r.s, r.n) for r in running_sum(numbered(df, ["k"], ["o"], "n"), ["k"], ["o"], "s", "w").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total = Counter()
    for k, o, w in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        total[k] += w
        assert got[k, o] == (total[k], o + 1)
    assert numbered(df.where("false"), ["k"], ["o"], "n").count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_previous_rows_within_keys_that_span_partitions(spark, partitions):
    rows = [("hot", i, str(i) if i % 3 else None) for i in range(120)] + [(k, i, k) for k in ("a", "b", None) for i in range(3)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k string, o int, v string")
        got = {(r.k, r.o): (r.previous_v, r.previous_o, r.previous_exists) for r in previous(df, ["k"], ["o"], ["v", "o"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    values = {(k, o): v for k, o, v in rows}
    assert got == {(k, o): (values[k, o - 1], o - 1, True) if o else (None, None, False) for k, o, _ in rows}
    assert previous(df.where("false"), ["k"], ["o"], ["v"]).count() == 0


def test_drift_is_the_same_however_rows_are_cut(spark):
    import random

    import pandas as pd

    for seed in range(40):
        rng = random.Random(seed)
        policy = ordered.DriftPolicy(eval_window=rng.randrange(1, 5), min_windows=2, loss_ratio=1.1, max_non_finite=rng.randrange(3), reset_cooldown_steps=rng.randrange(1, 20))
        rows = pd.DataFrame([{"loss": rng.choice([rng.random() * 3, 1.0, float("nan")]), "ema_norm": 1.0} for _ in range(60)])
        whole = ordered.DriftState(policy).run(rows)
        state, parts = ordered.DriftState(policy), []
        for i in range(0, 60, 7):
            state = ordered.DriftState(policy, json.loads(json.dumps(state.saved())))
            parts.append(state.run(rows.iloc[i : i + 7]))
        one = ordered.DriftState(policy)
        assert pd.concat(parts, ignore_index=True).to_json() == whole.to_json() == pd.DataFrame([one.step(r) for r in rows.to_dict("records")]).to_json()


def test_multi_label_bounds(spark):
    p = F.create_map(F.lit("a"), F.lit(0.9), F.lit("b"), F.lit(0.9), F.lit("c"), F.lit(0.1), F.lit("x"), F.lit(1.0))
    one = lambda c: spark.range(1).select(c.alias("o")).first().o
    assert (r := one(scorer.multi_label(p, ["a", "b", "c"], 0.5))).value == ["a", "b"] and r.confidence == 0.9 and set(r.probabilities) == {"a", "b", "c"}
    assert one(scorer.multi_label(p, ["a", "b", "c"], 0.95)).value == [] and one(scorer.multi_label(p, ["a", "b", "c"], 0.95)).confidence is None
    assert one(scorer.multi_label(p, ["a", "b", "c"], 0.95, least=1)).value == ["a"] and one(scorer.multi_label(p, ["a", "b", "c"], 0.0, most=1)).value == ["a"]
    assert one(scorer.multi_label(p, [], 0.5)).value == []
    both = one(scorer.tool_task(p, ["c"], ["a"], 0.5))
    assert both.task_type.value is None and both.decision_choice.value == ["a"]


def test_batches_of_a_scorer(spark):
    df = spark.createDataFrame([(i, None if i == 3 else f"restart {i}") for i in range(40)], "i int, text string")
    class Counting(BatchScorer):
        def batch(self, texts):
            assert len(texts) <= 5 and None not in texts
            return super().batch(texts)

    out = scorer.scored(df, "text", Counting({}, {"a": ["restart"], "b": []}), 5).orderBy("i").collect()
    assert out[3].probabilities is None and out[4].probabilities["a"] == pytest.approx(2 / 3)


def test_fields_in_their_types(spark):
    cases = [('"12"', "int", "12"), ("12.9", "int", "12"), ("-3.2", "int", "-3"), ("true", "int", None), ('"x"', "int", None), ('" 7 "', "float", "7.0"), ("[1, 2]", "str", '"1, 2"'), ('["a", true]', "str", '"a, True"'), ("null", "str", None), ('""', "str", None), ("[]", "list", None), ("0", "bool", "false"), ('"no"', "bool", "true"), ('"a"', "list", '["a"]'), ('["a"]', "list", '["a"]'), ('"say \\"hi\\""', "str", '"say \\"hi\\""')]
    for raw, kind, wanted in cases:
        assert spark.range(1).select(shaping.coerced_field(F.lit(raw), kind).alias("o")).first().o == wanted, (raw, kind)
    kept = [('"12"', "int", "12"), ('"x"', "int", '"x"'), ("3", "int", "3"), ('"TRUE"', "bool", "true"), ('"maybe"', "bool", '"maybe"'), ('"a"', "list", '["a"]'), ("null", "list", "null")]
    for raw, kind, wanted in kept:
        assert spark.range(1).select(shaping.normalized_field(F.lit(raw), kind).alias("o")).first().o == wanted, (raw, kind)


def test_extraction_to_training(spark):
    schema = Labels(fields={"count": "int", "tags": "list", "note": "str"}, relations=("uses",))
    span = "struct<text:string,start:int,end:int>"
    row = ({"technology": [("Rust", 0, 4), ("", 1, 1), ("Go", None, None)], "other": [("x", 0, 1)], "tool": []}, {"confidence": "high", "unknown": "y"}, {"count": '"5"', "tags": '"t"', "note": "true", "more": "1"}, {"uses": [(("a", 0, 1), ("b", 2, 3)), (("", 0, 0), ("c", 1, 2))], "knows": [(("a", 0, 1), ("b", 2, 3))]})
    df = spark.createDataFrame([row], f"e map<string,array<{span}>>, l map<string,string>, f map<string,string>, r map<string,array<struct<head:{span},tail:{span}>>>")
    out = df.select(shaping.teacher_output(df.e, df.l, df.f, df.r, schema).alias("o"))
    o = out.first().o
    assert o.entities == {"technology": ["Rust", "Go"]} and o.classifications == {"confidence": "high"} and o.fields == {"count": "5", "tags": '["t"]', "note": '"True"'}
    assert [tuple(p) for p in o.relations["uses"]] == [("a", "b")] and set(o.relations) == {"uses"}
    assert [tuple(e) for e in o.evidence["technology"]] == [("Rust", 0, 4), ("", 1, 1)] and len(o.evidence["uses"]) == 2
    t = out.select(shaping.training_form(F.col("o"), schema, "d").alias("t")).first().t
    assert [(c.task, c.labels, c.true_label) for c in t.classifications] == [("confidence", ["high", "low"], ["high"])]
    assert t.json_structures == {"count": ["5"], "tags": ["t"], "note": ["True"]} and [tuple(x) for x in t.relations] == [("uses", "a", "b")]
    none = spark.createDataFrame([(None, None, None, None)], df.schema).select(shaping.teacher_output(F.col("e"), F.col("l"), F.col("f"), F.col("r"), schema).alias("o")).first().o
    assert none.entities == {} and none.fields == {}


def test_splits_are_exact_in_each_stratum(spark):
    rows = [(i, "big" if i % 3 else None, i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, s string, t int")
    out = promotion.stratified_split(df, "id", ["s", "t"], {"train": 0.9, "val": 0.05, "test": 0.05}).collect()
    assert len(out) == 600
    for key in {(r.s, r.t) for r in out}:
        n = Counter(r.split for r in out if (r.s, r.t) == key)
        size = sum(n.values())
        assert n["val"] == n["test"] == int(size * 0.05)
    again = promotion.stratified_split(df.repartition(7), "id", ["s", "t"], {"train": 0.9, "val": 0.05, "test": 0.05}).collect()
    assert {(r.id, r.split) for r in again} == {(r.id, r.split) for r in out}


def test_urls_chunks_and_documents(spark):
    urls = ["HTTP://A.example:80/X/?utm_source=q&b=1#f", "http://a.example/X/?b=1", "https://a.example/?fbclid=1", "https://a.example", "not a url/", None]
    got = [r.u for r in spark.createDataFrame([(u,) for u in urls], "u string").select(promotion.canonical_url(F.col("u")).alias("u")).collect()]
    assert got == ["http://a.example/X/?b=1", "http://a.example/X/?b=1", "https://a.example", "https://a.example", "not a url", None]
    docs = spark.createDataFrame([(1, urls[0], "t1"), (2, urls[1], "t2"), (3, "http://c", "t1"), (4, None, "t9"), (5, None, None), (6, "http://d", None)], "n int, u string, t string")
    assert sorted(r.n for r in promotion.distinct_documents(docs, "u", "t", "n").collect()) == [1, 4, 5, 6]
    text = "".join(chr(97 + i % 26) for i in range(95))
    rows = promotion.chunks(spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "ab")], "n int, t string"), "t", 30, 10).orderBy("n", "chunk_no").collect()
    own = [r for r in rows if r.n == 1]
    assert all(text[r.start_char : r.start_char + 30] == r.chunk for r in own) and own[-1].start_char + len(own[-1].chunk) == 95 and len(own) == 5
    assert [(r.n, r.chunk) for r in rows if r.n > 1] == [(4, "ab")]


def test_replay_gates_and_figures(spark):
    rows = spark.createDataFrame([(i, "stable" if i % 2 else "recent") for i in range(20)] + [(100 + i, "canary") for i in range(9)], "o int, tier string")
    out = promotion.replay_batches(rows, "tier", "o", {"stable": 2, "recent": 3}).collect()
    assert Counter((r.batch_no, r.tier) for r in out) == {(b, t): q for b in range(3) for t, q in (("stable", 2), ("recent", 3))}
    assert promotion.replay_batches(rows.where("tier <> 'stable'"), "tier", "o", {"stable": 2, "recent": 3}).count() == 0
    p = spark.createDataFrame([(0.95, True), (0.95, True), (0.15, False), (1.0, False), (None, True)], "p double, ok boolean")
    r = promotion.calibration_error(p, "p", "ok").first()
    assert r.n == 4 and r.ece == pytest.approx((3 * abs((0.95 * 2 + 1) / 3 - 2 / 3) + 0.15) / 4)
    same = spark.createDataFrame([("a",), ("b",)], "c string")
    assert promotion.stability_index(same, same, "c").first().psi == pytest.approx(0) and promotion.stability_index(same, same.where("false"), "c").first().psi > 1
    gates = promotion.promotion_gates(spark.createDataFrame([(0.1, 0.2, 0.95), (0.13, None, 0.5)], "ece double, psi double, evidence_grounding double")).collect()
    assert gates[0].promoted and gates[1].failed == ["evidence_grounding", "ece", "psi"]


def test_resuming_and_resets(spark):
    rows = [("a", "adapter-only", "d1", ["y", "x", "x"], 5, None, 2, True), ("b", "adapter-only", "d0", ["x", "y"], 6, 1, 0, True), ("c", None, "d1", ["x", "y"], 7, 1, 0, True), ("d", "adapter-only", "d1", None, 8, 1, 0, True)]
    df = spark.createDataFrame(rows, "checkpoint string, kind string, config_digest string, adapter_keys array<string>, training_steps bigint, ema_updates bigint, reset_id bigint, has_optimizer boolean")
    strict = {r.checkpoint: r for r in lineage.resumed(df, "d1", ["x", "y"]).collect()}
    assert [strict[k].error for k in "abcd"] == [None, "config_digest_mismatch", "unsupported_checkpoint", "adapter_keys_mismatch"]
    assert strict["a"].ema_updates == 0 and strict["a"].optimizer_restored and strict["b"].training_steps is None
    loose = {r.checkpoint: r for r in lineage.resumed(df, "d1", ["x", "y"], allow_drift=True).collect()}
    assert loose["b"].config_drift and not loose["b"].optimizer_restored and loose["b"].training_steps == 6
    [w] = lineage.warm_starts(df, "d1", ["x", "y"]).collect()
    assert (w.checkpoint, w.checkpoint_config_digest, w.adapter_keys) == ("b", "d0", 2)
    samples = spark.createDataFrame([("l", i, loss, 1.0) for i, loss in enumerate([1.0, 1.0, 9.0, 9.0, 9.0, 9.0])], "lineage string, ord bigint, loss double, ema_norm double")
    verdicts = ordered.drift(samples, ordered.DriftPolicy(eval_window=2, min_windows=1, loss_ratio=2.0, reset_cooldown_steps=1))
    [event] = lineage.reset_events(verdicts, "runs", 3).collect()
    assert (event.reset_id, event.step, event.archive) == (1, 4, "runs/l/reset-0000-step-4")
    steps = spark.createDataFrame([("l", i, i == 1, i != 4) for i in range(9)], "lineage string, ord bigint, reset boolean, fine boolean")
    out = lineage.warmups(steps, 3).orderBy("ord").collect()
    assert [r.phase for r in out] == ["serving", "reset", "warmup", "warmup", "warmup", "warmup", "warmup", "published", "serving"]
    assert [r.remaining for r in out] == [0, 3, 2, 1, 3, 2, 1, 0, 0]
    assert [r.generation for r in lineage.serving(lineage.warmups(steps, 3)).orderBy("ord").collect()] == [0] * 7 + [1, 1]
    assert [r.phase for r in lineage.warmups(steps, 0).orderBy("ord").collect()][:2] == ["serving", "reset"]


def test_snapshots(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    assert lineage.served(spark, root) is None
    assert lineage.publish(spark.range(3), root) == 1
    old = lineage.served(spark, root)
    assert lineage.publish(spark.range(5), root) == 2
    assert old.count() == 3 and lineage.served(spark, root).count() == 5 and lineage.served(spark, root, 1).count() == 3
    write_text(spark, f"{root}/t", "é1")
    write_text(spark, f"{root}/t", "é2")
    assert read_text(spark, f"{root}/t") == "é2" and read_text(spark, f"{root}/none") is None


def test_small_decisions(spark):
    from tracewright.operators import envelopes, readside

    rows = spark.createDataFrame([(True, True, 10.0), (False, False, 0.0), (True, False, 9999.0), (True, True, 3600.0), (None, None, None)], "b boolean, t boolean, i double")
    assert [r.c for r in rows.select(readside.watchdog(F.col("b"), F.col("t"), F.col("i")).alias("c")).collect()] == [0, 11, 12, 13, 13]
    texts = [("the cat and the dog is in the house",), ("der Hund und die Katze ist nicht da",), ("el perro y la casa de los gatos",), ("xyzzy",), ("",), (None,)]
    assert [r.l for r in spark.createDataFrame(texts, "t string").select(promotion.language(F.col("t")).alias("l")).collect()] == ["en", "de", "es", None, None, None]
    values = ['{"example": {"input": "a", "output": {"x": 1}}}', '{"labels": {"y": 2}, "source": {"uri": "u://v"}}', '{"labels": {"y": 2}, "text": "t", "source": {"uri": "u"}}', '{"labels": {"y": 2}}', '{"example": {"output": 1}}', "broken", None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = [r.e and r.e.input for r in df.select(envelopes.loop_example(F.col("value")).alias("e")).collect()]
    assert got == ["a", "u://v", "t", None, None, None, None]
    assert tuple(envelopes.labelled_counts(df).first()) == (3, 4)
    from tracewright.functions.text import is_json

    texts = [('{"a": [1, 2]}', True), ("[1]", True), ('{"a": 1},', False), ('{"a": 1}\n{}', False), ("{", False), ("1, 2", False), ("", False), ('"x"', True)]
    assert [r.j for r in spark.createDataFrame([(t,) for t, _ in texts], "t string").select(is_json(F.col("t")).alias("j")).collect()] == [j for _, j in texts]
