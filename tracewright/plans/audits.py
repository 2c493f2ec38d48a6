"""Queries over texts and runs that audits ask."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.scorer import DictionaryScorer, scored
from tracewright.functions.shared import table
from tracewright.operators import audit, capture, routing
from tracewright.plans.registry import query
from tracewright.sources import captures, contract

Spark, Frame = SparkSession, DataFrame


@query(r"""WITH l AS (SELECT row_id, unnest(string_split(input, chr(10))) AS line, generate_subscripts(string_split(input, chr(10)), 1) AS n FROM stage0_distilled WHERE input IS NOT NULL),
f AS (SELECT row_id, n::INT AS line_no, line, CASE WHEN regexp_matches(line, '-----BEGIN [A-Z ]*PRIVATE KEY-----') THEN 'private_key' WHEN regexp_matches(line, '(?i)bearer\s+[A-Za-z0-9._\-]{20,}') THEN 'bearer_token'
WHEN regexp_matches(line, '(?i)(api[_-]?key|token|secret|password)[A-Za-z0-9_]*"?\s*[:=]\s*["''][^"'']{12,}["'']') AND NOT regexp_matches(line, '(\$\{|\$\(|<[^>]*>|env:|file:|os\.environ|["''][A-Z][A-Z0-9_]+["''])') THEN 'assignment' END AS finding FROM l)
SELECT row_id, line_no, finding, CASE WHEN finding = 'assignment' AND regexp_matches(line, '(?i)(example|placeholder|changeme|redacted|dummy|x{6,})') THEN 'low' ELSE 'high' END AS severity FROM f WHERE finding IS NOT NULL""")
def f18_secret_lines(spark: Spark, d: str) -> Frame:
    return audit.secret_lines(table(spark, d, "stage0_distilled"), "row_id", "input")


@query("""WITH p AS (SELECT source_name, CASE WHEN coalesce(uri, '') = '' THEN 'missing_uri' WHEN lower(trim(coalesce(license_note, ''))) = '' THEN 'missing_licence' WHEN lower(trim(license_note)) NOT IN ('operator-owned', 'cc-by-4.0') THEN 'licence_not_allowed' END AS problem FROM stage0_corpus)
SELECT source_name, problem, count(*) AS n FROM p WHERE problem IS NOT NULL GROUP BY ALL""")
def f19_licences(spark: Spark, d: str) -> Frame:
    return audit.licences(table(spark, d, "stage0_corpus"), ["operator-owned", "cc-by-4.0"])


@query("WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) SELECT regexp_extract(line, '^\\s*[-*] \\[([xX ~!])\\]', 1) AS mark, count(*) AS n FROM l WHERE regexp_matches(line, '^\\s*[-*] \\[([xX ~!])\\]') GROUP BY 1")
def a24_checklist(spark: Spark, d: str) -> Frame:
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(audit.checklist(F.col("line")).alias("mark")).where("mark is not null").groupBy("mark").agg(F.count("*").alias("n"))


@query("SELECT bool_and(ok) AS passed, coalesce(string_agg(name, ',' ORDER BY name) FILTER (NOT ok), '') AS failed FROM (SELECT event_type AS name, coalesce(avg(value) < 50, false) AS ok FROM events GROUP BY event_type)")
def f22_gate(spark: Spark, d: str) -> Frame:
    return audit.gate(table(spark, d, "events").groupBy(F.col("event_type").alias("name")).agg((F.avg("value") < 50).alias("ok")))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id END AS updated FROM events")
def f23_status(spark: Spark, d: str) -> Frame:
    text = F.concat(F.lit('{"schema_version": '), F.when(F.col("event_id") % 3 == 0, "1").otherwise("2"), F.lit(', "updated_at_unix_ms": '), F.col("event_id").cast("string"), F.lit(', "later": {}}'))
    return table(spark, d, "events").select("event_id", audit.status_document(text)["updated_at_unix_ms"].alias("updated"))


@query()
def k9_provenance(spark: Spark, d: str) -> Frame:
    return audit.provenance(table(spark, d, "envelope"), "seq_no", "value")


@query("SELECT row_id, coalesce(cardinality(output.entities), 0)::INT AS n_entities, len(output.classifications)::INT AS n_tasks, array_to_string(list_transform(output.classifications, lambda c: c.task || '=' || array_to_string(c.true_label, '+')), ';') AS labels, teacher.source_uri AS provenance FROM stage0_distilled")
def proj18_training_output(spark: Spark, d: str) -> Frame:
    out = audit.training_output(F.col("output.entities"), F.col("output.classifications"), F.col("teacher.source_uri"))
    rows = table(spark, d, "stage0_distilled").select("row_id", out.alias("o"))
    return rows.select("row_id", F.size("o.entities").alias("n_entities"), F.size("o.classifications").alias("n_tasks"), F.array_join(F.transform("o.classifications", lambda c: F.concat(c["task"], F.lit("="), F.array_join(c["true_label"], "+"))), ";").alias("labels"), "o.provenance")


_WORDS = {"technology": ["Rust", "Go", "Python", "Kafka", "Redis"], "tool": ["git", "docker", "kubectl"]}


def _scored(spark: Spark, d: str) -> Frame:
    texts = table(spark, d, "stage0_heldout").where("text is not null").select("row_id", "text")
    return scored(texts, "text", DictionaryScorer(_WORDS, {"coding": ["release", "commit"], "operations": ["restart", "drill"]}))


@query(r"""WITH w AS (SELECT unnest([('Rust', 'technology'), ('Go', 'technology'), ('Python', 'technology'), ('Kafka', 'technology'), ('Redis', 'technology'), ('git', 'tool'), ('docker', 'tool'), ('kubectl', 'tool')]) AS w),
p AS (SELECT row_id, text, w[1] AS word, w[2] AS label, unnest(range(1, length(text) + 1)) AS i FROM stage0_heldout, w WHERE contains(text, w[1]))
SELECT row_id, label, word AS text, (i - 1)::INT AS start, (i - 1 + length(word))::INT AS "end" FROM p WHERE substr(text, i, length(word)) = word AND NOT regexp_matches(CASE WHEN i > 1 THEN substr(text, i - 1, 1) ELSE ' ' END, '[\pL\pN_]') AND NOT regexp_matches(substr(text || ' ', i + length(word), 1), '[\pL\pN_]')""")
def m1_extraction(spark: Spark, d: str) -> Frame:
    return _scored(spark, d).select("row_id", F.explode("spans").alias("s")).select("row_id", "s.label", "s.text", "s.start", "s.end")


@query("WITH c AS (SELECT row_id, 1 + (len(lower(text)) - len(replace(lower(text), 'release', ''))) / 7 + (len(lower(text)) - len(replace(lower(text), 'commit', ''))) / 6 AS a, 1 + (len(lower(text)) - len(replace(lower(text), 'restart', ''))) / 7 + (len(lower(text)) - len(replace(lower(text), 'drill', ''))) / 5 AS b FROM stage0_heldout WHERE text IS NOT NULL) SELECT row_id, round(a / (a + b), 6) AS coding, round(b / (a + b), 6) AS operations FROM c")
def m2_classification(spark: Spark, d: str) -> Frame:
    p = F.col("probabilities")
    return _scored(spark, d).select("row_id", F.round(p["coding"], 6).alias("coding"), F.round(p["operations"], 6).alias("operations"))


@query("""WITH c AS (SELECT row_id, 1 + (len(lower(text)) - len(replace(lower(text), 'release', ''))) / 7 + (len(lower(text)) - len(replace(lower(text), 'commit', ''))) / 6 AS a, 1 + (len(lower(text)) - len(replace(lower(text), 'restart', ''))) / 7 + (len(lower(text)) - len(replace(lower(text), 'drill', ''))) / 5 AS b FROM stage0_heldout WHERE text IS NOT NULL),
t AS (SELECT row_id, CASE WHEN a >= b THEN 'coding' ELSE 'operations' END AS task, greatest(a, b) / (a + b) AS score FROM c)
SELECT row_id, task, round(score, 6) AS score, CASE WHEN score < 0.6 OR task = 'operations' THEN 'review' ELSE 'allow' END AS action FROM t""")
def m6_analyzed(spark: Spark, d: str) -> Frame:
    """Scored, then routed on the best label: extraction to decision in one plan."""
    policy = routing.Policy("demo", 1, ("m",), {"coding": "allow", "operations": "review"}, 0.6)
    rows = _scored(spark, d).withColumn("choices", routing.choices(F.col("probabilities")))
    rows = rows.withColumn("task", F.element_at("choices", 1)["choice"]).withColumn("score", F.element_at("choices", 1)["probability"])
    found = routing.reasons(policy, F.lit("m"), F.col("task"), F.col("score"), F.lit(True), {}, F.col("score"))
    rows = rows.withColumn("reasons", found)
    return rows.select("row_id", "task", F.round("score", 6).alias("score"), routing.action(policy, F.col("task"), F.col("reasons")).alias("action"))


@query("SELECT row_id FROM stage0_corpus WHERE NOT (coalesce(trim(text), '') = '' AND coalesce(trim(license_note), '') = '') ORDER BY row_id")
def n7_both_empty_dropped(spark: Spark, d: str) -> Frame:
    return table(spark, d, "stage0_corpus").where(~captures.both_empty(F.col("text"), F.col("license_note"))).select("row_id")


@query("WITH r AS (SELECT rel_path, byte_offset, row_number() OVER (PARTITION BY rel_path ORDER BY sha256(rel_path || '#' || byte_offset)) AS k, count(*) OVER (PARTITION BY rel_path) AS n FROM (SELECT DISTINCT rel_path, byte_offset FROM raw_capture WHERE rel_path IS NOT NULL AND byte_offset IS NOT NULL)) SELECT rel_path, byte_offset FROM r WHERE k <= ceil(n * 0.02)")
def n1_sample_per_folder(spark: Spark, d: str) -> Frame:
    """A deterministic share of each file by the rank of a hash: a sampling operator."""
    rows = table(spark, d, "raw_capture").where("rel_path is not null and byte_offset is not null")
    return captures.sampled_lines(rows, 0.02)


@query("SELECT row_id, 'USER:' || chr(10) || input || chr(10) || chr(10) || 'SOURCE:' || chr(10) || source.name AS rendered FROM stage0_distilled WHERE input IS NOT NULL AND source.name IS NOT NULL")
def n3_rendered(spark: Spark, d: str) -> Frame:
    from tracewright.operators.shaping import rendered_blocks

    block = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("text"))
    rows = table(spark, d, "stage0_distilled").where("input is not null and source.name is not null")
    return rows.select("row_id", rendered_blocks(F.array(block("user", "input"), block("source", "source.name"))).alias("rendered"))


@query("SELECT row_id, length(input)::INT AS chars, octet_length(encode(input))::INT AS bytes, try_cast(regexp_extract(input, '([0-9]+)', 1) AS BIGINT) AS first_number FROM stage0_distilled WHERE input IS NOT NULL")
def proj20_coerced(spark: Spark, d: str) -> Frame:
    from tracewright.operators.shaping import coerced

    number = coerced(F.regexp_extract("input", "([0-9]+)", 1), "int")
    return table(spark, d, "stage0_distilled").where("input is not null").select("row_id", F.length("input").alias("chars"), F.octet_length("input").alias("bytes"), number.alias("first_number"))


@query()
def proj5_completed_responses(spark: Spark, d: str) -> Frame:
    """The other reading of both sides of a capture, for lines that parse."""
    import json

    @F.pandas_udf("prompt string, answer string")
    def read(raw: pd.Series) -> pd.DataFrame:
        out = []
        for r in raw:
            try:
                record = json.loads(r) if r is not None else None
            except (ValueError, RecursionError):
                record = None
            out.append((capture.user_prompt(record), capture.completed_text(record)) if isinstance(record, dict) else (None, None))
        return pd.DataFrame(out, columns=["prompt", "answer"])

    return table(spark, d, "raw_capture").distinct().select("rel_path", "byte_offset", read("raw").alias("r")).select("rel_path", "byte_offset", "r.prompt", "r.answer")


@query("WITH c AS (SELECT sha256('v1' || chr(10) || input) AS h, min(row_id)::VARCHAR AS output FROM stage0_distilled WHERE input IS NOT NULL AND row_id % 2 = 0 GROUP BY 1) SELECT d.row_id, c.output FROM stage0_distilled d LEFT JOIN c ON c.h = sha256('v1' || chr(10) || d.input) WHERE d.input IS NOT NULL")
def m7_cached_labels(spark: Spark, d: str) -> Frame:
    docs = table(spark, d, "stage0_distilled").where("input is not null").select("row_id", "input")
    cache = docs.where("row_id % 2 = 0").select(F.sha2(F.concat_ws("\n", F.lit("v1"), "input"), 256).alias("request_sha256"), F.col("row_id").cast("string").alias("output"))
    return contract.cached_labels(docs, cache, "v1", "input").select("row_id", "output")
