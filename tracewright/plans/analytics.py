"""Queries over labels, decisions, runs and time series: shaping, metrics, ordered windows, read side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions import statistics as st
from tracewright.functions.shared import table
from tracewright.functions.text import human_bytes, human_seconds
from tracewright.operators import ordered, readside, reporting, routing, shaping
from tracewright.plans.registry import query

Spark, Frame = SparkSession, DataFrame

# --- labels ----------------------------------------------------------------------------------------------------------
_P = "list_transform(range(1, 11), lambda i: struct_pack(label := 'L' || (i - 1), p := round(abs(embedding[i])::DOUBLE, 6)))"


def _judged(spark: Spark, d: str) -> Frame:
    p = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.struct(F.concat(F.lit("L"), (i - 1).cast("string")).alias("label"), F.round(F.abs(F.element_at("embedding", i)).cast("double"), 6).alias("p")))
    return table(spark, d, "embeddings").select("vec_id", p.alias("judged"))


_RANKED = f"j AS (SELECT vec_id, unnest({_P}) AS e FROM embeddings), r AS (SELECT vec_id, e.label AS label, e.p AS p, row_number() OVER (PARTITION BY vec_id ORDER BY e.p DESC, e.label) AS rank FROM j)"


@query(f"WITH {_RANKED}, k AS (SELECT vec_id, label, rank FROM r WHERE rank <= 3 AND p >= 0.25), f AS (SELECT vec_id, label, rank FROM r WHERE rank = 1 AND vec_id NOT IN (SELECT vec_id FROM k) UNION ALL SELECT * FROM k) SELECT vec_id, string_agg(label, ',' ORDER BY rank) AS labels FROM f GROUP BY vec_id")
def proj23_top_labels(spark: Spark, d: str) -> Frame:
    return _judged(spark, d).select("vec_id", F.array_join(st.top_labels(F.col("judged"), 3, 0.25), ",").alias("labels"))


@query(f"WITH {_RANKED} SELECT vec_id, max(label) FILTER (rank = 1) AS task_type, string_agg(label, ',' ORDER BY rank) FILTER (rank <= 3 AND (p >= 0.25 OR rank = 1)) AS decision_choice FROM r GROUP BY vec_id")
def proj25_synthesized(spark: Spark, d: str) -> Frame:
    pick = lambda t: F.array_join(shaping.shaped_labels(F.col("judged"), t), ",")
    return _judged(spark, d).select("vec_id", pick("task_type").alias("task_type"), pick("decision_choice").alias("decision_choice"))


@query(f"WITH {_RANKED} SELECT vec_id, string_agg(label || ':' || (round(least(1.0, p * 3) * 1000)::INT), ',' ORDER BY least(1.0, p * 3) DESC, label) AS choices FROM r GROUP BY vec_id")
def proj28_choices(spark: Spark, d: str) -> Frame:
    maps = F.map_from_entries(F.transform("judged", lambda e: F.struct(e["label"].alias("key"), (e["p"] * 3).alias("value"))))
    shown = F.transform(routing.choices(maps), lambda c: F.concat(c["choice"], F.lit(":"), F.round(c["probability"] * 1000).cast("int").cast("string")))
    return _judged(spark, d).select("vec_id", F.array_join(shown, ",").alias("choices"))


@query(f"WITH j AS (SELECT vec_id, list_transform({_P}, lambda e: e.p) AS p FROM embeddings) SELECT vec_id, round(-list_sum(list_transform(list_filter(p, lambda x: x > 0), lambda x: x / list_sum(p) * ln(x / list_sum(p)))), 6) AS entropy FROM j")
def a13_entropy(spark: Spark, d: str) -> Frame:
    return _judged(spark, d).select("vec_id", F.round(st.entropy(F.transform("judged", lambda e: e["p"])), 6).alias("entropy"))


@query(f"WITH j AS (SELECT list_transform({_P}, lambda e: e.p) AS p FROM embeddings) SELECT count(*) AS n, round(avg(list_max(p)), 6) AS mean_top, round(avg(-list_sum(list_transform(list_filter(p, lambda x: x > 0), lambda x: x / list_sum(p) * ln(x / list_sum(p))))), 6) AS mean_entropy FROM j")
def a12_distribution(spark: Spark, d: str) -> Frame:
    return reporting.distribution(_judged(spark, d).select(F.transform("judged", lambda e: e["p"]).alias("p")), "p").select("n", F.round("mean_top", 6).alias("mean_top"), F.round("mean_entropy", 6).alias("mean_entropy"))


_HELD = "h AS (SELECT row_id, text, unnest(map_entries(labels)) AS e FROM stage0_heldout WHERE text IS NOT NULL), v AS (SELECT row_id, text, e.key AS label, unnest(e.value) AS value FROM h)"


@query(f"WITH {_HELD} SELECT row_id, label, value, (instr(text, value) - 1)::INT AS start, (instr(text, value) - 1 + length(value))::INT AS \"end\" FROM v WHERE instr(text, value) > 0")
def proj17_evidence(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_heldout").where("text is not null").select("row_id", "text", F.explode("labels").alias("label", "values"))
    return rows.select("row_id", "label", F.explode(shaping.evidence(F.col("text"), F.col("values"))).alias("s")).select("row_id", "label", F.col("s.text").alias("value"), "s.start", "s.end")


@query(f"WITH {_HELD} SELECT row_id, label, bool_and(instr(text, value) > 0) AS holds FROM v GROUP BY row_id, label")
def f8_evidence_holds(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_heldout").where("text is not null").select("row_id", "text", F.explode("labels").alias("label", "values")).where("size(values) > 0")
    spans = F.transform("values", lambda v: F.struct(v.alias("text"), (F.instr(F.col("text"), v) - 1).cast("int").alias("start"), (F.instr(F.col("text"), v) - 1 + F.length(v)).cast("int").alias("end")))
    return rows.groupBy("row_id", "label").agg(F.bool_and(shaping.evidence_holds(F.col("text"), spans)).alias("holds"))


@query("SELECT row_id, len(list_distinct(list_filter(list_transform(flatten(map_values(labels)), lambda x: trim(x)), lambda x: x <> '')))::INT AS n_spans FROM stage0_heldout WHERE labels IS NOT NULL")
def proj26_span_sets(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_heldout").where("labels is not null").select("row_id", F.size(shaping.span_set(F.flatten(F.map_values("labels")))).alias("n_spans"))


_PRED = "p AS (SELECT row_id, coalesce(labels['technology'], []) AS gold, list_filter(coalesce(labels['technology'], []), lambda x: instr(text, x) % 3 <> 0) AS pred, coalesce(labels['tool'], []) AS other FROM stage0_heldout WHERE text IS NOT NULL), q AS (SELECT row_id, list_distinct(gold) AS gold, list_distinct(list_concat(pred, other[1:1])) AS pred FROM p)"


def _predicted(spark: Spark, d: str) -> Frame:
    none = F.array().cast("array<string>")
    gold = F.coalesce(F.try_element_at("labels", F.lit("technology")), none)
    seen = F.filter(gold, lambda x: F.instr(F.col("text"), x) % 3 != 0)
    other = F.slice(F.coalesce(F.try_element_at("labels", F.lit("tool")), none), 1, 1)
    return table(spark, d, "stage0_heldout").where("text is not null").select("row_id", "split", F.array_distinct(gold).alias("gold"), F.array_distinct(F.concat(seen, other)).alias("pred"))


_TP = "len(list_intersect(gold, pred)) AS tp, len(list_filter(pred, lambda x: NOT list_contains(gold, x))) AS fp, len(list_filter(gold, lambda x: NOT list_contains(pred, x))) AS fn"


@query(f"WITH {_PRED} SELECT row_id, {_TP.replace(' AS tp', '::INT AS tp').replace(' AS fp', '::INT AS fp').replace(' AS fn', '::INT AS fn')} FROM q")
def j6_confusion(spark: Spark, d: str) -> Frame:
    tp, fp, fn = shaping.confusion(F.col("gold"), F.col("pred"))
    return _predicted(spark, d).select("row_id", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))


@query(f"WITH {_PRED}, c AS (SELECT {_TP} FROM q), s AS (SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM c), x AS (SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall FROM s) SELECT tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(2 * precision * recall / (precision + recall), 6) AS f1 FROM x")
def a9_precision_recall(spark: Spark, d: str) -> Frame:
    out = reporting.precision_recall(j6_confusion(spark, d), None)
    return out.select("tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {_PRED} SELECT count(*) AS n, round(avg((len(list_intersect(gold, pred)) > 0)::INT), 4) AS overlap, round(avg((list_sort(gold) = list_sort(pred))::INT), 4) AS exact FROM q WHERE len(gold) > 0")
def a10_agreement(spark: Spark, d: str) -> Frame:
    return reporting.agreement(_predicted(spark, d), "gold", "pred")


@query(f"WITH {_PRED} SELECT row_id, len(list_intersect(gold, pred)) > 0 AS meets, list_sort(gold) = list_sort(pred) AS same FROM q")
def j7_stored_and_fresh(spark: Spark, d: str) -> Frame:
    return _predicted(spark, d).select("row_id", F.arrays_overlap("gold", "pred").alias("meets"), (F.array_sort("gold") == F.array_sort("pred")).alias("same"))


@query(f"WITH {_PRED} SELECT row_id, array_to_string(list_sort(list_intersect(gold, pred)), ',') AS both, array_to_string(list_sort(list_filter(gold, lambda x: NOT list_contains(pred, x))), ',') AS missed FROM q")
def l9_set_operations(spark: Spark, d: str) -> Frame:
    return _predicted(spark, d).select("row_id", F.array_join(F.array_sort(F.array_intersect("gold", "pred")), ",").alias("both"), F.array_join(F.array_sort(F.array_except("gold", "pred")), ",").alias("missed"))


@query(f"WITH {_PRED} SELECT row_id, list_sort(gold) = list_sort(pred) AS equal_sets, len(list_distinct(list_concat(gold, pred)))::INT AS n_union FROM q")
def l10_set_equality(spark: Spark, d: str) -> Frame:
    return _predicted(spark, d).select("row_id", (F.array_sort("gold") == F.array_sort("pred")).alias("equal_sets"), F.size(F.array_union("gold", "pred")).alias("n_union"))


_CLS = "c AS (SELECT row_id, unnest(output.classifications) AS x FROM stage0_distilled), l AS (SELECT row_id, x.task AS task, unnest(x.true_label) AS label FROM c)"


@query(f"WITH {_CLS}, n AS (SELECT task, label, count(*) AS n FROM l GROUP BY ALL) SELECT task, label, n, row_number() OVER (PARTITION BY task ORDER BY n DESC, label) AS rank FROM n QUALIFY rank <= 6")
def l3_label_histogram(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").select(F.explode("output.classifications").alias("c")).select("c.task", F.explode("c.true_label").alias("label"))
    return reporting.label_histogram(rows, "task", "label").select("task", "label", "n", F.col("rank").cast("bigint").alias("rank"))


@query("SELECT sum(c)::BIGINT AS n_rows, count(*) AS n_distinct, sum(c - 1)::BIGINT AS surplus FROM (SELECT count(*) AS c FROM stage0_distilled WHERE input IS NOT NULL GROUP BY sha256(input))")
def a11_duplicate_inputs(spark: Spark, d: str) -> Frame:
    return reporting.duplicate_inputs(table(spark, d, "stage0_distilled"), "input")


@query("WITH e AS (SELECT row_id, input, flatten(map_values(output.entities)) AS v FROM stage0_distilled WHERE input IS NOT NULL AND output.entities IS NOT NULL) SELECT row_id, len(v)::INT AS n_values, len(list_filter(v, lambda x: contains(input, x)))::INT AS n_grounded FROM e")
def a11_grounding(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").where("input is not null and output.entities is not null").select("row_id", "input", F.flatten(F.map_values("output.entities")).alias("v"))
    return rows.select("row_id", F.size("v").alias("n_values"), shaping.grounded(F.col("input"), F.col("v")).alias("n_grounded"))


@query("""WITH c AS (SELECT row_id, output.entities AS e, output.classifications AS cl FROM stage0_distilled WHERE output.entities IS NOT NULL AND output.classifications IS NOT NULL)
SELECT row_id, CASE WHEN len(list_filter(map_keys(e), lambda k: k NOT IN ('technology', 'tool'))) > 0 THEN 'unknown_entity:' || array_to_string(list_sort(list_filter(map_keys(e), lambda k: k NOT IN ('technology', 'tool'))), ',') WHEN len(list_filter(cl, lambda x: x.task NOT IN ('confidence'))) > 0 THEN 'unknown_task'
WHEN len(list_filter(cl, lambda x: x.task = 'confidence' AND len(list_filter(x.true_label, lambda y: y NOT IN ('high', 'low'))) > 0)) > 0 THEN 'label_outside_set' END AS reason FROM c""")
def f7_output_reason(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").where("output.entities is not null and output.classifications is not null")
    return rows.select("row_id", shaping.output_reason(F.col("output.entities"), F.col("output.classifications"), ["technology", "tool"], {"confidence": ["high", "low"]}).alias("reason"))


@query("WITH e AS (SELECT row_id, unnest(map_entries(output.entities)) AS x FROM stage0_distilled), s AS (SELECT row_id, x.key AS label, list_distinct(list_filter(list_transform(x.value, lambda v: trim(v)), lambda v: v <> ''))[1:12] AS v FROM e) SELECT row_id, label, len(v)::INT AS n, array_to_string(list_sort(v), '|') AS texts FROM s WHERE label IN ('technology', 'tool') AND len(v) > 0")
def proj24_shaped_entities(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "stage0_distilled").where("output.entities is not null")
    return rows.select("row_id", F.explode(shaping.shaped_entities(F.col("output.entities"), ["technology", "tool"])).alias("label", "v")).select("row_id", "label", F.size("v").alias("n"), F.array_join(F.array_sort("v"), "|").alias("texts"))


@query("SELECT row_id, coalesce(len(list_filter(flatten(map_values(output.entities)), lambda x: x <> '')), 0) = 0 AND coalesce(len(output.classifications), 0) = 0 AS empty_target FROM stage0_distilled")
def f12_empty_targets(spark: Spark, d: str) -> Frame:
    ent = shaping.shaped_entities(F.col("output.entities"), ["technology", "tool", "date"])
    return table(spark, d, "stage0_distilled").select("row_id", shaping.empty_target(ent, F.col("output.classifications")).alias("empty_target"))


# --- decisions -------------------------------------------------------------------------------------------------------
_POLICY = routing.Policy("demo", 1, ("m0", "m1", "m2", "m3"), {"click": "allow", "view": "allow", "purchase": "review"}, 0.25, allowed={"tool": ("click", "view", "signup", "purchase")})
_DEC = """x AS (SELECT event_id, ts, user_id, event_type, value, 'm' || (user_id % 5) AS model, least(1.0, value / 100) AS score FROM events),
w AS (SELECT *, list_filter([CASE WHEN model NOT IN ('m0', 'm1', 'm2', 'm3') THEN 'model_not_allowlisted' END, CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'task_type_unknown' END, CASE WHEN score < 0.25 THEN 'confidence_below_threshold' END,
CASE WHEN event_type NOT IN ('click', 'view', 'signup', 'purchase') THEN 'tool_not_allowlisted:' || event_type END, CASE WHEN score < 0.25 THEN 'decision_confidence_below_threshold' END], lambda r: r IS NOT NULL) AS reasons,
CASE event_type WHEN 'click' THEN 'allow' WHEN 'view' THEN 'allow' WHEN 'purchase' THEN 'review' ELSE 'review' END AS base FROM x),
d AS (SELECT *, CASE WHEN list_has_any(reasons, ['model_not_allowlisted', 'task_type_unknown']) THEN 'reject' WHEN len(reasons) > 0 AND base <> 'reject' THEN 'review' ELSE base END AS action FROM w)"""


def _decided(spark: Spark, d: str) -> Frame:
    model, score = F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")), F.least(F.lit(1.0), F.col("value") / 100)
    found = routing.reasons(_POLICY, model, F.col("event_type"), score, F.lit(True), {"tool": F.array("event_type")}, score)
    rows = table(spark, d, "events").withColumn("reasons", found)
    return rows.withColumn("action", routing.action(_POLICY, F.col("event_type"), F.col("reasons"))).withColumn("synthetic", F.col("event_id") % 5 == 0)


@query(f"WITH {_DEC} SELECT event_id, array_to_string(reasons, '|') AS reasons, action, len(reasons) = 0 AND action = 'allow' AS allowed FROM d")
def f9_router(spark: Spark, d: str) -> Frame:
    rows = _decided(spark, d)
    return rows.select("event_id", F.array_join("reasons", "|").alias("reasons"), "action", routing.allowed(F.col("reasons"), F.col("action")).alias("allowed"))


@query(f"WITH {_DEC} SELECT count(*) AS total, round_even(100.0 * count(*) FILTER (action = 'allow') / count(*), 1) AS allow, round_even(100.0 * count(*) FILTER (action = 'review') / count(*), 1) AS review, round_even(100.0 * count(*) FILTER (action = 'reject') / count(*), 1) AS reject FROM d")
def a6_decision_mix(spark: Spark, d: str) -> Frame:
    return reporting.decision_mix(_decided(spark, d))


@query(f"WITH {_DEC}, t AS (SELECT * FROM d ORDER BY event_id DESC LIMIT 100) SELECT count(*) AS total, round_even(100.0 * count(*) FILTER (action = 'allow') / count(*), 1) AS allow, round_even(100.0 * count(*) FILTER (action = 'review') / count(*), 1) AS review, round_even(100.0 * count(*) FILTER (action = 'reject') / count(*), 1) AS reject FROM t")
def a7_recent_mix(spark: Spark, d: str) -> Frame:
    return reporting.decision_mix(reporting.latest(_decided(spark, d), "event_id", 100))


@query(f"WITH {_DEC} SELECT event_type, count(*) FILTER (action = 'allow') AS decision_allow, count(*) FILTER (action = 'review') AS decision_review, count(*) FILTER (action = 'reject') AS decision_reject FROM d GROUP BY event_type")
def a5_decision_counters(spark: Spark, d: str) -> Frame:
    return _decided(spark, d).groupBy("event_type").agg(*[F.count_if(F.col("action") == a).alias(f"decision_{a}") for a in ("allow", "review", "reject")])


@query(f"WITH {_DEC} SELECT event_id FROM d WHERE event_id % 5 <> 0 AND action = 'review'")
def f20_feed_filter(spark: Spark, d: str) -> Frame:
    return readside.feed(readside.feed(_decided(spark, d), "real"), "review").select("event_id")


@query("SELECT event_id, NOT coalesce(event_id % 5 = 0, false) OR coalesce(CASE WHEN event_id % 10 = 0 THEN 'training_admitted' END, '') = 'training_admitted' AS trainable FROM events")
def f11_trainable(spark: Spark, d: str) -> Frame:
    admission = F.when(F.col("event_id") % 10 == 0, "training_admitted")
    return table(spark, d, "events").select("event_id", routing.trainable(F.col("event_id") % 5 == 0, admission).alias("trainable"))


@query("WITH t AS (SELECT event_id AS seq FROM events ORDER BY event_id DESC LIMIT 400) SELECT seq FROM t WHERE seq > (SELECT max(event_id) FROM events WHERE event_type = 'error') - 300 ORDER BY seq")
def f21_since_cursor(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    cursor = e.where("event_type = 'error'").agg(F.max("event_id").alias("m")).first().m - 300  # where a reader left off
    return readside.since(e.select(F.col("event_id").alias("seq")), cursor)


@query(f"WITH {_DEC} SELECT event_id, event_type = CASE WHEN value > 40 THEN 'click' ELSE 'view' END AS hit FROM d")
def j10_expected(spark: Spark, d: str) -> Frame:
    return table(spark, d, "events").select("event_id", (F.col("event_type") == F.when(F.col("value") > 40, "click").otherwise("view")).alias("hit"))


# --- runs and series ---------------------------------------------------------------------------------------------------
_LOSS = "loss AS (SELECT user_id AS lineage, event_id, ts, CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS loss FROM events)"
_WIN = f"{_LOSS}, n AS (SELECT lineage, event_id, loss, floor((row_number() OVER (PARTITION BY lineage ORDER BY ts, event_id) - 1) / 5)::BIGINT AS window_no FROM loss WHERE NOT isnan(loss)), win AS (SELECT lineage, window_no, avg(loss) AS rolling FROM n GROUP BY ALL HAVING count(*) = 5)"


def _losses(spark: Spark, d: str) -> Frame:
    return table(spark, d, "events").select(F.col("user_id").alias("lineage"), "event_id", "ts", F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("loss"))


def _windows(spark: Spark, d: str) -> Frame:
    return ordered.count_windows(_losses(spark, d), "lineage", ["ts", "event_id"], "loss", 5).drop("closing")


@query(f"WITH {_WIN} SELECT lineage, window_no, round(rolling, 6) AS rolling FROM win")
def w1_count_windows(spark: Spark, d: str) -> Frame:
    return _windows(spark, d).withColumn("rolling", F.round("rolling", 6))


_SIG = f"{_WIN}, b AS (SELECT *, first(rolling) OVER (PARTITION BY lineage ORDER BY window_no) AS baseline FROM win), s AS (SELECT *, window_no > 0 AND rolling > baseline * 1.2 + 1 AS bad FROM b)"


@query(f"WITH {_SIG} SELECT lineage, window_no, round(baseline, 6) AS baseline, bad FROM s")
def w3_window_signals(spark: Spark, d: str) -> Frame:
    return ordered.window_signals(_windows(spark, d), "lineage", 1.2, 1.0).select("lineage", "window_no", F.round("baseline", 6).alias("baseline"), "bad")


@query(f"WITH {_SIG}, i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY lineage ORDER BY window_no) AS island FROM s) SELECT lineage, window_no, sum(bad::INT) OVER (PARTITION BY lineage, island ORDER BY window_no)::BIGINT AS streak FROM i")
def w4_streaks(spark: Spark, d: str) -> Frame:
    return ordered.streaks(ordered.window_signals(_windows(spark, d), "lineage", 1.2, 1.0), "lineage", "window_no").select("lineage", "window_no", "streak")


@query(f"WITH {_LOSS}, i AS (SELECT *, sum(CASE WHEN isnan(loss) THEN 0 ELSE 1 END) OVER (PARTITION BY lineage ORDER BY ts, event_id) AS island FROM loss) SELECT event_id, sum(isnan(loss)::INT) OVER (PARTITION BY lineage, island ORDER BY ts, event_id)::BIGINT AS non_finite FROM i")
def w5_non_finite(spark: Spark, d: str) -> Frame:
    return ordered.non_finite_streaks(_losses(spark, d), "lineage", ["ts", "event_id"], "loss").select("event_id", "non_finite")


def drift_sql(samples: str) -> str:
    """The drift monitor of the two drift queries as a recursion over samples (lineage, ord, loss)."""
    return f"""WITH RECURSIVE s AS ({samples}), e AS (SELECT *, row_number() OVER (PARTITION BY lineage ORDER BY ord) AS n FROM s),
m AS (SELECT DISTINCT lineage, 0::BIGINT AS n, NULL::BIGINT AS ord, 0::DOUBLE AS total, 0 AS cnt, NULL::DOUBLE AS base, 0 AS bad, 0 AS resets, -10::BIGINT AS last, 0 AS streak, false AS hit, NULL::VARCHAR AS why FROM e
UNION ALL SELECT lineage, n, ord, CASE WHEN hit OR closes THEN 0 ELSE t END, CASE WHEN hit OR closes THEN 0 ELSE c END, CASE WHEN NOT hit THEN b END, CASE WHEN hit THEN 0 ELSE d END, resets + hit::INT, CASE WHEN hit THEN n ELSE last END, CASE WHEN hit THEN 0 ELSE k END, hit, why
FROM (SELECT *, why IS NOT NULL AND n - last >= 10 AS hit FROM (SELECT *, CASE WHEN closes AND base IS NULL THEN t / 5 ELSE base END AS b, CASE WHEN k > 1 THEN 'non_finite_loss' WHEN closes AND signal AND d >= 2 THEN 'loss_window_exceeded' END AS why
FROM (SELECT *, CASE WHEN closes THEN CASE WHEN signal THEN bad + 1 ELSE 0 END ELSE bad END AS d FROM (SELECT *, closes AND base IS NOT NULL AND t / 5 > base * 1.2 AS signal FROM (SELECT *, fine AND c = 5 AS closes
FROM (SELECT e.lineage, e.n, e.ord, NOT isnan(e.loss) AS fine, m.total + CASE WHEN isnan(e.loss) THEN 0 ELSE e.loss END AS t, m.cnt + (NOT isnan(e.loss))::INT AS c, CASE WHEN isnan(e.loss) THEN m.streak + 1 ELSE 0 END AS k, m.base, m.bad, m.resets, m.last FROM m JOIN e ON e.lineage = m.lineage AND e.n = m.n + 1))))))
)
SELECT lineage, ord, n AS step, round(base, 6) AS baseline_loss, CASE WHEN cnt > 0 THEN round(total / cnt, 6) END AS rolling_loss, bad::BIGINT AS bad_windows, resets::BIGINT AS resets, hit AS reset_required, why AS reason FROM m WHERE n > 0"""


def rounded_drift(verdicts: Frame) -> Frame:
    return verdicts.withColumn("baseline_loss", F.round("baseline_loss", 6)).withColumn("rolling_loss", F.round("rolling_loss", 6))


@query(drift_sql("SELECT user_id::VARCHAR AS lineage, event_id AS ord, CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS loss FROM events"))
def w6_drift_with_resets(spark: Spark, d: str) -> Frame:
    rows = _losses(spark, d).select("lineage", F.col("event_id").alias("ord"), "loss", F.lit(1.0).alias("ema_norm"))
    return rounded_drift(ordered.drift(rows, ordered.DriftPolicy(eval_window=5, min_windows=2, loss_ratio=1.2, max_non_finite=1, reset_cooldown_steps=10)))


_EMA = "e AS (SELECT user_id AS lineage, list(value ORDER BY ts, event_id) AS v FROM events GROUP BY user_id)"


@query(f"WITH {_EMA} SELECT lineage, round(list_reduce(v, lambda a, x: a * 0.95 + x * 0.05), 6) AS ema FROM e")
def w8_loss_average(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "events").withColumnRenamed("user_id", "lineage")
    return ordered.moving_average(rows, "lineage", ["ts", "event_id"], "value", 0.95).withColumn("ema", F.round("ema", 6))


@query(f"WITH {_EMA} SELECT lineage, round(list_reduce(v, lambda a, x: a * 0.9 + x * 0.1), 5) AS ema FROM e")
def w7_weighted_average(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "events").withColumnRenamed("user_id", "lineage")
    return ordered.moving_average(rows, "lineage", ["ts", "event_id"], "value", 0.9).withColumn("ema", F.round("ema", 5))


@query("WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS ch FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sn FROM c) SELECT user_id, sn::BIGINT AS session_no, event_type, count(*) AS n FROM s GROUP BY ALL")
def w9_sessions(spark: Spark, d: str) -> Frame:
    return ordered.sessions(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").drop("first")


@query("SELECT event_id, sha256(event_id || ':' || event_type) AS digest, lag(sha256(event_id || ':' || event_type)) OVER (PARTITION BY user_id ORDER BY event_id) AS parent FROM events")
def w10_hash_chain(spark: Spark, d: str) -> Frame:
    digest = F.sha2(F.concat(F.col("event_id").cast("string"), F.lit(":"), "event_type"), 256)
    return ordered.hash_chain(table(spark, d, "events"), "user_id", ["event_id"], digest).select("event_id", "digest", "parent")


@query("SELECT event_id, 500 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events")
def w11_resumed_numbers(spark: Spark, d: str) -> Frame:
    return ordered.resumed_numbers(table(spark, d, "events").select("user_id", "event_id"), "user_id", ["event_id"], 500).select("event_id", "seq")


@query("WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM events) SELECT user_id, event_id, step FROM n WHERE step % 10 = 0")
def w12_cadence(spark: Spark, d: str) -> Frame:
    return ordered.cadence(table(spark, d, "events").select("user_id", "event_id"), "user_id", ["event_id"], 10)


@query("WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS consumed FROM events) SELECT user_id, floor(consumed / 20)::BIGINT AS publish_no, min(event_id) AS event_id FROM n WHERE consumed >= 20 GROUP BY ALL")
def w13_publishes(spark: Spark, d: str) -> Frame:
    return ordered.publishes(table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id", 20)


@query("WITH n AS (SELECT user_id, event_id, floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 4)::BIGINT AS batch_no FROM events) SELECT user_id, batch_no, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM n GROUP BY ALL HAVING count(*) = 4")
def w19_full_batches(spark: Spark, d: str) -> Frame:
    return ordered.batches(table(spark, d, "events"), "user_id", ["event_id"], 4).select("user_id", "batch_no", "n", F.col("first.event_id").alias("first_id"), F.col("last.event_id").alias("last_id"))


_CPU = "c AS (SELECT user_id, event_id, event_id * 10 AS total, (event_id * 10 - value)::DOUBLE AS idle FROM events), l AS (SELECT *, total - lag(total) OVER w AS dt, idle - lag(idle) OVER w AS di FROM c WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"


@query(f"WITH {_CPU} SELECT event_id, round(CASE WHEN dt > 0 AND di >= 0 AND di <= dt THEN 100.0 * (dt - di) / dt END, 6) AS busy FROM l")
def w15_busy_share(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "events").select("user_id", "event_id", (F.col("event_id") * 10).alias("total"), (F.col("event_id") * 10 - F.col("value")).alias("idle"))
    return ordered.busy_share(rows, "user_id", "event_id").select("event_id", F.round("busy", 6).alias("busy"))


@query("SELECT user_id, round(greatest(0, epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) / 1e6, 6) AS age FROM events GROUP BY user_id")
def w16_heartbeat_age(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    now = e.agg(F.max("ts").alias("now"))
    return e.groupBy("user_id").agg(F.max("ts").alias("ts")).join(F.broadcast(now)).select("user_id", F.round(readside.age_seconds(F.col("ts"), F.col("now")), 6).alias("age"))


_BEATS = "s AS (SELECT 's' || i AS service FROM range(1, 161) t(i)), b AS (SELECT 's' || user_id AS service, max(ts) AS ts, CASE WHEN arg_max(event_type, ts) = 'error' THEN 'failed' ELSE 'running' END AS state FROM events GROUP BY user_id), n AS (SELECT max(ts) AS now FROM events), a AS (SELECT service, state, CASE WHEN ts IS NOT NULL THEN greatest(0, epoch_us(now) - epoch_us(ts)) / 1e6 END AS age FROM s LEFT JOIN b USING (service), n)"


@query(f"WITH {_BEATS} SELECT service, CASE WHEN age IS NULL THEN 'missing' WHEN state = 'running' AND age > 3600 THEN 'stale' ELSE state END AS state FROM a")
def j8_heartbeats(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    services = spark.range(1, 161).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("service"))
    beats = e.select(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("service"), F.col("ts").alias("written_at"), F.when(F.col("event_type") == "error", "failed").otherwise("running").alias("state"))
    now = e.agg(F.max("ts").alias("now"))
    rows = services.join(F.broadcast(now))
    newest = beats.groupBy("service").agg(F.max("written_at").alias("written_at"), F.max_by("state", "written_at").alias("state"))
    rows = rows.join(newest, "service", "left").withColumn("age", F.when(F.col("written_at").isNotNull(), readside.age_seconds(F.col("written_at"), F.col("now"))))
    return rows.select("service", readside.freshness(F.col("state"), F.col("age"), 3600).alias("state"))


@query(f"WITH {_BEATS} SELECT CASE WHEN age IS NULL THEN 'missing' WHEN state = 'running' AND age > 3600 THEN 'stale' ELSE state END AS state, count(*) AS n FROM a GROUP BY 1")
def f16_freshness(spark: Spark, d: str) -> Frame:
    return j8_heartbeats(spark, d).groupBy("state").agg(F.count("*").alias("n"))


@query("WITH g AS (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap, event_id FROM events) SELECT event_id, gap / 1e6 AS gap_seconds FROM g WHERE gap > 36000 * 1e6")
def t15_gaps(spark: Spark, d: str) -> Frame:
    return reporting.gaps(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"], "ts", 36000).select("event_id", "gap_seconds")


@query("WITH s AS (SELECT date_trunc('second', ts)::TIMESTAMP AS second, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT second, event_type, n, sum(n) OVER (PARTITION BY event_type ORDER BY second)::BIGINT AS total FROM s")
def t16_deltas(spark: Spark, d: str) -> Frame:
    rows = readside.deltas(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type")
    return rows.withColumn("second", F.col("second").cast("timestamp_ntz"))


# --- statistics --------------------------------------------------------------------------------------------------------
_LIST = "SELECT event_type, list_sort(list(value)) AS v FROM events WHERE NOT isnan(value) GROUP BY event_type"


@query(f"SELECT event_type, round(v[round_even(0.95 * (len(v) - 1), 0)::INT + 1], 3) AS v FROM ({_LIST})")
def a14_percentile_nearest(spark: Spark, d: str) -> Frame:
    return st.percentile_nearest(table(spark, d, "events"), "event_type", "value", 0.95)


@query("SELECT event_type, round(quantile_cont(value, 0.95), 6) AS v FROM events GROUP BY event_type")
def a15_percentile_linear(spark: Spark, d: str) -> Frame:
    return st.percentile_linear(table(spark, d, "events"), "event_type", "value", 0.95).withColumn("v", F.round("v", 6))


@query(f"SELECT event_type, v[floor((len(v) - 1) * 0.95)::INT + 1] AS v FROM ({_LIST})")
def a16_percentile_floor(spark: Spark, d: str) -> Frame:
    return st.percentile_floor(table(spark, d, "events"), "event_type", "value", 0.95)


@query(f"SELECT event_type, v[greatest(floor(len(v) * 0.95)::INT - 1, 0) + 1] AS v FROM ({_LIST})")
def a17_percentile_soak(spark: Spark, d: str) -> Frame:
    return st.percentile_soak(table(spark, d, "events"), "event_type", "value", 0.95)


@query("WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events) SELECT user_id, round(avg(value), 6) AS mean_recent FROM r WHERE back <= 50 GROUP BY user_id")
def a18_recent_mean(spark: Spark, d: str) -> Frame:
    return ordered.recent_mean(table(spark, d, "events"), "user_id", "event_id", "value")


@query("SELECT max(event_id) AS event_id, max(user_id) AS user_id, max(value) AS value FROM events")
def a20_maxima(spark: Spark, d: str) -> Frame:
    return reporting.maxima(table(spark, d, "events"), ["event_id", "user_id", "value"])


@query("SELECT event_id, floor(event_id / 1000)::BIGINT AS base, (floor(event_id / 1000) * 1000)::BIGINT AS aligned, ((floor(event_id / 1000) + 1) * 1000)::BIGINT AS next_publish FROM events")
def a21_alignment(spark: Spark, d: str) -> Frame:
    base, aligned, after = reporting.alignment(F.col("event_id"), 1000)
    return table(spark, d, "events").select("event_id", base.alias("base"), aligned.alias("aligned"), after.alias("next_publish"))


@query("SELECT count(id) - count(DISTINCT id) AS repeated FROM delivery")
def a22_repeated(spark: Spark, d: str) -> Frame:
    return reporting.repeated(table(spark, d, "delivery"), "id")


@query("SELECT min(value) AS least, round(avg(value), 6) AS mean, max(value) AS most, count(*) AS n FROM events")
def a23_rollup_figures(spark: Spark, d: str) -> Frame:
    return reporting.rollup_figures(table(spark, d, "events"), "value").withColumn("mean", F.round("mean", 6))


@query("WITH l AS (SELECT user_id, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS us, event_id - lag(event_id) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT event_id, round(n * 60e6 / nullif(us, 0), 4) AS per_minute FROM l")
def a25_rate(spark: Spark, d: str) -> Frame:
    return reporting.rate_per_minute(table(spark, d, "events"), "user_id", "ts", "event_id").select("event_id", F.round("per_minute", 4).alias("per_minute"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings")
def a27_norm(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "embeddings").select("vec_id", F.explode("embedding").alias("x")).withColumn("x", F.col("x").cast("double"))
    return reporting.norm(rows, "vec_id", "x").withColumn("norm", F.round("norm", 6))


@query("SELECT round(count(*) FILTER (event_id % 5 <> 0) / greatest(1, max(user_id)), 6) AS records_per_generation FROM events")
def a8_records_per_generation(spark: Spark, d: str) -> Frame:
    return table(spark, d, "events").agg(readside.records_per_generation(F.count_if(F.col("event_id") % 5 != 0), F.max("user_id")).alias("records_per_generation"))


# --- read side ---------------------------------------------------------------------------------------------------------
@query("SELECT event_id, event_id - user_id * 50 >= 1000 AS due FROM events")
def f13_publish_due(spark: Spark, d: str) -> Frame:
    return table(spark, d, "events").select("event_id", readside.publish_due(F.col("event_id"), F.col("user_id") * 50, 1000).alias("due"))


@query("SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'no_checkpoint_generation' WHEN user_id <= 40 AND event_type = 'view' THEN 'up_to_date' WHEN value < 10 THEN 'waiting_for_stable_checkpoint' WHEN value * 3 < 60 THEN 'cooldown' WHEN event_id % 100 < 20 THEN 'waiting_records' ELSE 'deploy' END AS decision FROM events")
def f14_deploy_gate(spark: Spark, d: str) -> Frame:
    target = F.when(F.col("event_id") % 13 != 0, F.col("user_id"))
    decision = readside.deploy_decision(target, F.lit(40), F.col("event_type") == "view", F.col("value"), F.col("value") * 3, F.col("event_id") % 100, 10, 60, 20)
    return table(spark, d, "events").select("event_id", decision.alias("decision"))


@query("SELECT event_id AS generation, sha256(event_id::VARCHAR) AS digest FROM events WHERE event_type = 'signup' ORDER BY event_id DESC LIMIT 1")
def f15_newest_deployable(spark: Spark, d: str) -> Frame:
    ledger = table(spark, d, "events").select(F.col("event_id").alias("generation"), F.when(F.col("event_type") == "signup", F.sha2(F.col("event_id").cast("string"), 256)).alias("digest"))
    return readside.newest_deployable(ledger.where("false"), ledger)


@query("SELECT event_id AS generation, sha256('m' || event_id) AS digest FROM events WHERE event_type = 'purchase' ORDER BY event_id DESC LIMIT 1")
def f15_manifest_first(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    ledger = e.select(F.col("event_id").alias("generation"), F.sha2(F.col("event_id").cast("string"), 256).alias("digest"))
    manifests = e.select(F.col("event_id").alias("generation"), F.when(F.col("event_type") == "purchase", F.sha2(F.concat(F.lit("m"), F.col("event_id").cast("string")), 256)).alias("digest"))
    return readside.newest_deployable(manifests, ledger)


@query("WITH l AS (SELECT event_id AS generation, sha256(user_id::VARCHAR) AS digest FROM events) SELECT user_id, max(generation) AS generation FROM (SELECT DISTINCT user_id, substr(sha256(user_id::VARCHAR), 1, 12) AS prefix FROM events) u JOIN l ON starts_with(l.digest, u.prefix) GROUP BY user_id")
def j4_prefix_lookup(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    sha = F.sha2(F.col("user_id").cast("string"), 256)
    wanted = e.select("user_id", F.substring(sha, 1, 12).alias("prefix")).distinct()
    return readside.prefix_lookup(wanted, e.select(F.col("event_id").alias("generation"), sha.alias("digest"))).select("user_id", "generation")


@query("SELECT a.user_id, coalesce(b.top, a.n::DOUBLE) AS figure FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) a LEFT JOIN (SELECT user_id, max(value) AS top FROM events WHERE value > 100 GROUP BY user_id) b USING (user_id)")
def j9_overlaid(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events")
    base = e.groupBy("user_id").agg(F.count("*").cast("double").alias("figure"))
    return readside.overlaid(base, e.where("value > 100").groupBy("user_id").agg(F.max("value").alias("figure")), "user_id", ["figure"])


@query("SELECT user_id, max(event_id) AS newest FROM events GROUP BY user_id ORDER BY newest DESC LIMIT 24")
def l5_latest(spark: Spark, d: str) -> Frame:
    return reporting.latest(table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("newest")), "newest", 24)


@query("SELECT vec_id FROM embeddings ORDER BY vec_id DESC LIMIT 5")
def l6_retained(spark: Spark, d: str) -> Frame:
    return readside.retained(table(spark, d, "embeddings").select("vec_id"), "vec_id", 5)


@query("WITH g AS (SELECT user_id, list_sort(list(DISTINCT event_type) FILTER (event_type NOT IN ('click'))) AS v FROM events WHERE value > 200 GROUP BY user_id) SELECT user_id, array_to_string(v[1:3], ',') AS offending FROM g WHERE len(v) > 0")
def l7_offending(spark: Spark, d: str) -> Frame:
    rows = table(spark, d, "events").where("value > 200").groupBy("user_id").agg(F.collect_set("event_type").alias("v"))
    return rows.select("user_id", routing.offending(F.col("v"), ("click",)).alias("offending")).where("offending is not null")


@query("SELECT user_id FROM events WHERE event_type = 'click' AND value > 250 UNION SELECT user_id FROM events WHERE event_type = 'error' AND value > 250")
def l8_union(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events").where("value > 250")
    return e.where("event_type = 'click'").select("user_id").union(e.where("event_type = 'error'").select("user_id")).distinct()


@query("SELECT event_id, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f KiB', n / 1024.0) ELSE printf('%.1f MiB', n / 1048576.0) END AS shown, printf('%dd %dh %dm', n // 86400, n % 86400 // 3600, n % 3600 // 60) AS lasted FROM (SELECT event_id, event_id * 1000 + 3 AS n FROM events)")
def k11_formatted(spark: Spark, d: str) -> Frame:
    n = F.col("event_id") * 1000 + 3
    return table(spark, d, "events").select("event_id", human_bytes(n).alias("shown"), human_seconds(n).alias("lasted"))


# --- surfaces beyond the reference: Spark's own operators over the same tables --------------------------------------------
@query("SELECT event_type, user_id % 3 AS part, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY CUBE (event_type, user_id % 3)")
def x1_cube(spark: Spark, d: str) -> Frame:
    e = table(spark, d, "events").withColumn("part", F.col("user_id") % 3)
    return e.cube("event_type", "part").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def x2_event_time_windows(spark: Spark, d: str) -> Frame:
    from tracewright.streaming.ingest import windowed_counts

    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed_counts(e, "ts", "10 minutes", "1 hour", "event_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL")
def x3_pricing_groups(spark: Spark, d: str) -> Frame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"))


@query("SELECT a.event_id, (SELECT max(b.event_id) FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'click' AND b.event_id <= a.event_id) AS last_click FROM events a WHERE a.event_type = 'purchase'")
def x4_as_of(spark: Spark, d: str) -> Frame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, d, "events").withColumn("last_click", F.max(F.when(F.col("event_type") == "click", F.col("event_id"))).over(w))
    return e.where("event_type = 'purchase'").select("event_id", "last_click")
