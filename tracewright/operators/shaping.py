"""Training pairs: evidence, checks against the schema, shaping of targets, span sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewright.functions.statistics import top_labels
from tracewright.functions.text import strip


def evidence(text: Column, values: Column) -> Column:
    """array<struct<text, start, end>>: the first place of each value in the text; values without one are left out."""
    spans = F.transform(values, lambda v: F.struct(v.alias("text"), (F.instr(text, v) - 1).cast("int").alias("start"), (F.instr(text, v) - 1 + F.length(v)).cast("int").alias("end")))
    return F.filter(spans, lambda s: s["start"] >= 0)


def evidence_holds(text: Column, spans: Column) -> Column:
    """Whether every span lies in the text and reads as it says."""
    return F.forall(F.coalesce(spans, F.array().cast("array<struct<text:string,start:int,end:int>>")), lambda s: (s["start"] >= 0) & (s["end"] >= s["start"]) & (F.substring(text, s["start"] + 1, s["end"] - s["start"]) == s["text"]))


def output_reason(entities: Column, classifications: Column, entity_names: list[str], labels: dict[str, list[str]]) -> Column:
    """Why a teacher's output doesn't fit the schema: unknown entity, unknown task, label outside its set; null if it does."""
    unknown = F.array_join(F.array_sort(F.array_except(F.map_keys(entities), F.array(*map(F.lit, entity_names)))), ",")
    tasks = F.array(*map(F.lit, labels))
    odd_task = F.exists(classifications, lambda c: ~F.array_contains(tasks, c["task"]))
    bad = F.lit(False)
    for task, allowed in labels.items():
        bad = bad | _outside(classifications, task, allowed)
    return F.when(unknown != "", F.concat(F.lit("unknown_entity:"), unknown)).when(odd_task, "unknown_task").when(bad, "label_outside_set")


def _outside(classifications: Column, task: str, allowed: list[str]) -> Column:
    known = F.array(*map(F.lit, allowed))
    return F.exists(classifications, lambda c: (c["task"] == task) & (F.size(F.array_except(c["true_label"], known)) > 0))


def coerced(value: Column, dtype: str) -> Column:
    """A decoder's string as the field's type; null where it can't be read as that."""
    return {"int": lambda c: c.try_cast("bigint"), "float": lambda c: c.try_cast("double"), "bool": lambda c: F.lower(strip(c)).try_cast("boolean"), "list": lambda c: F.transform(F.split(c, ","), strip), "str": lambda c: c}[dtype](value)


def span_set(values: Column) -> Column:
    """Stripped, without empty ones, each once."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), strip), lambda v: v != ""))


def shaped_entities(entities: Column, names: list[str], most: int = 12) -> Column:
    """Entities of the schema with at most ``most`` texts each; empty ones dropped."""
    known = F.map_filter(entities, lambda k, v: k.isin(names))
    return F.map_filter(F.transform_values(known, lambda k, v: F.slice(span_set(v), 1, most)), lambda k, v: F.size(v) > 0)


def shaped_labels(probabilities: Column, task: str) -> Column:
    """The labels a task trains on: the best for ``task_type``, up to three at 0.25 or more for the others."""
    return top_labels(probabilities, 1, 0.0) if task == "task_type" else top_labels(probabilities, 3, 0.25)


def empty_target(entities: Column, classifications: Column) -> Column:
    return (F.coalesce(F.size(entities), F.lit(0)) <= 0) & (F.coalesce(F.size(classifications), F.lit(0)) <= 0)


def grounded(text: Column, values: Column) -> Column:
    """How many of the values stand in the text."""
    return F.size(F.filter(values, lambda v: F.contains(text, v)))


def confusion(gold: Column, predicted: Column) -> tuple[Column, Column, Column]:
    """(true positives, false positives, false negatives) of two span sets."""
    return F.size(F.array_intersect(gold, predicted)), F.size(F.array_except(predicted, gold)), F.size(F.array_except(gold, predicted))


def rendered_blocks(blocks: Column) -> Column:
    """array<struct<role, text>> as named blocks divided by empty lines."""
    return F.array_join(F.transform(blocks, lambda b: F.concat(F.upper(b["role"]), F.lit(":\n"), b["text"])), "\n\n")


#: Keys of an output that training doesn't read.
TRAINING_ONLY = ("provenance", "_evidence", "entity_descriptions", "json_descriptions")
_SPANS = "array<struct<text:string,start:int,end:int>>"


def without_training_only(output: Column, present: list[str]) -> Column:
    """A struct without the keys that only say where it came from; ``present`` are the fields it has."""
    gone = [k for k in TRAINING_ONLY if k in present]
    return output.dropFields(*gone) if gone else output


def python_text(value: Column) -> Column:
    """A JSON value (text) as Python prints it: strings bare, True, False, None, numbers as they stand."""
    bare = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    return F.when(value.startswith('"'), bare).when(value == "true", "True").when(value == "false", "False").when(value == "null", "None").otherwise(value)


def listed(value: Column) -> Column:
    """The elements of a JSON array (text), each as JSON text; null for anything else."""
    return F.when(value.startswith("["), F.transform(F.from_json(value, "array<variant>"), lambda v: F.to_json(v)))


def coerced_field(value: Column, dtype: str) -> Column:
    """An extracted field (JSON text) as JSON text of its type; null where it can't be read as that, or is empty.

    str: lists are joined by commas, others printed. int, float: not of booleans; fractions are cut. bool: whether there
    is anything. list: what is no list becomes one."""
    value = F.trim(value)
    empty = value.isNull() | value.isin("null", '""', "[]")
    text, boolean = python_text(value), value.isin("true", "false")
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    if dtype == "str":
        out = quoted(F.coalesce(F.array_join(F.transform(listed(value), python_text), ", "), text))
    elif dtype == "int":
        whole = F.when(value.startswith('"'), strip(text).try_cast("bigint")).otherwise(F.when(F.abs(value.try_cast("double")) < 9e18, value.try_cast("double").try_cast("bigint")))
        out = F.when(~boolean, whole.cast("string"))
    elif dtype == "float":
        out = F.when(~boolean, strip(text).try_cast("double").cast("string"))
    elif dtype == "bool":
        out = F.when(boolean, value).when(value.try_cast("double") == 0, "false").when(value == "{}", "false").otherwise("true")
    else:
        out = F.when(value.startswith("["), value).otherwise(F.concat(F.lit("["), value, F.lit("]")))
    return F.when(~empty, out)


def normalized_field(value: Column, dtype: str) -> Column:
    """A decoder's field (JSON text) in its type; only strings are read anew, and what can't be read stays as it is."""
    text = F.when(value.startswith('"'), python_text(value))
    read = {"int": strip(text).try_cast("bigint").cast("string"), "float": strip(text).try_cast("double").cast("string"), "bool": F.when(F.lower(text).isin("true", "false"), F.lower(text)), "list": F.when(~value.startswith("[") & (value != "null"), F.concat(F.lit("["), value, F.lit("]")))}
    return F.coalesce(read.get(dtype, F.lit(None).cast("string")), value)


def located(spans: Column) -> Column:
    """The spans that say where they stand, as evidence."""
    return F.transform(F.filter(spans, lambda s: s["start"].isNotNull() & s["end"].isNotNull()), lambda s: F.struct(s["text"].alias("text"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))


def teacher_output(entities: Column, labels: Column, fields: Column, relations: Column, schema) -> Column:
    """An extraction as the teacher's output: struct<entities, classifications, fields, relations, evidence>.

    ``entities`` map<string, array<struct<text, start, end>>>, ``labels`` map<string, string>, ``fields`` map<string, JSON
    text>, ``relations`` map<string, array<struct<head, tail>>> of such spans; ``schema`` has entities, classifications (task
    to its labels), fields (name to type) and relations.  Names and labels outside it are left out, as are empty texts,
    fields that can't be read, and pairs without both texts."""
    none = F.map_from_entries(F.array().cast(f"array<struct<key:string,value:{_SPANS}>>"))
    known = F.map_filter(F.coalesce(entities, none), lambda k, v: k.isin(list(schema.entities)))
    texts = F.map_filter(F.transform_values(known, lambda k, v: F.filter(F.transform(v, lambda s: s["text"]), lambda t: F.coalesce(t, F.lit("")) != "")), lambda k, v: F.size(v) > 0)
    proof = F.transform_values(F.map_filter(known, lambda k, v: F.map_contains_key(texts, k)), lambda k, v: located(F.filter(v, lambda s: s["text"].isNotNull())))
    chosen = lambda k, v: _either([(k == t) & v.isin(list(names)) for t, names in schema.classifications.items()])
    classes = F.map_filter(labels, chosen)
    values = F.array_compact(F.array(*[F.when(coerced_field(F.try_element_at(fields, F.lit(n)), t).isNotNull(), F.struct(F.lit(n).alias("key"), coerced_field(F.try_element_at(fields, F.lit(n)), t).alias("value"))) for n, t in schema.fields.items()])) if schema.fields else F.array().cast("array<struct<key:string,value:string>>")
    full = lambda p: (F.coalesce(p["head"]["text"], F.lit("")) != "") & (F.coalesce(p["tail"]["text"], F.lit("")) != "")
    pairs = F.map_filter(F.transform_values(F.map_filter(relations, lambda k, v: k.isin(list(schema.relations))), lambda k, v: F.filter(v, full)), lambda k, v: F.size(v) > 0)
    related = F.transform_values(pairs, lambda k, v: F.flatten(F.transform(v, lambda p: located(F.array(p["head"], p["tail"])))))
    return F.struct(
        texts.alias("entities"), classes.alias("classifications"), F.map_from_entries(values).alias("fields"),
        F.transform_values(pairs, lambda k, v: F.transform(v, lambda p: F.struct(p["head"]["text"].alias("head"), p["tail"]["text"].alias("tail")))).alias("relations"),
        F.map_concat(proof, related).alias("evidence"),
    )


def _either(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def training_form(output: Column, schema, schema_digest: str) -> Column:
    """A teacher's output in the form training reads: struct<entities, classifications, json_structures, relations, provenance>.

    True labels are always lists and come with their task's labels, field values are strings (lists of strings), relations
    are one entry a pair."""
    tasks = F.array_compact(F.array(*[F.when(F.map_contains_key(output["classifications"], t), F.struct(F.lit(t).alias("task"), F.array(*map(F.lit, names)).alias("labels"), F.array(F.try_element_at(output["classifications"], F.lit(t))).alias("true_label"))) for t, names in schema.classifications.items()]))
    shown = F.transform_values(output["fields"], lambda k, v: F.coalesce(F.transform(listed(v), python_text), F.array(python_text(v))))
    flat = F.flatten(F.transform(F.map_entries(output["relations"]), lambda e: F.transform(e["value"], lambda p: F.struct(e["key"].alias("name"), p["head"].alias("head"), p["tail"].alias("tail")))))
    return F.struct(output["entities"].alias("entities"), tasks.alias("classifications"), shown.alias("json_structures"), flat.alias("relations"), F.struct(F.lit(schema_digest).alias("schema_digest"), output["evidence"].alias("evidence")).alias("provenance"))


def entity_values(strings: Column, spans: Column) -> Column:
    """The values of an entity, given as plain strings, as spans, or both."""
    none = F.array().cast("array<string>")
    return F.filter(F.concat(F.coalesce(strings, none), F.coalesce(F.transform(spans, lambda s: s["text"]), none)), lambda v: v.isNotNull())


def has_evidence(evidence_map: Column, entities: Column) -> Column:
    """Whether an output says where anything stands: evidence of its own, or an entity with both its places."""
    placed = F.exists(F.flatten(F.map_values(entities)), lambda s: s["start"].isNotNull() & s["end"].isNotNull())
    return F.coalesce(F.size(evidence_map) > 0, F.lit(False)) | F.coalesce(placed, F.lit(False))


#: Roles of blocks that are rendered, and how each is headed.
ROLES = {"system": "SYSTEM:", "user": "USER:", "assistant": "ASSISTANT:", "developer": "DEVELOPER:", "tool_call": "TOOL_CALL", "tool_result": "TOOL_RESULT:", "reasoning": "REASONING:"}


def rendered_request(items: Column) -> Column:
    """array<struct<role, name, text>> as headed blocks divided by empty lines: messages by their role, tool calls with
    their name, tool results and reasoning. Items of other roles and without text are left out."""
    heading = F.create_map(*[x for k, v in ROLES.items() for x in (F.lit(k), F.lit(v))])
    kept = F.filter(items, lambda i: i["role"].isin(list(ROLES)) & (F.coalesce(i["text"], F.lit("")) != ""))
    block = lambda i: F.concat(heading[i["role"]], F.when(i["role"] == "tool_call", F.concat(F.lit(" "), F.coalesce(i["name"], F.lit("")), F.lit(":"))).otherwise(""), F.lit("\n"), i["text"])
    return F.array_join(F.transform(kept, block), "\n\n")
