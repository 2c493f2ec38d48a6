"""Decision routing on extracted labels: choices, reasons and actions, as columns over a policy of literals."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    allowed_models: tuple[str, ...]
    task_actions: dict[str, str]
    min_confidence: float = 0.75
    require_evidence: bool = False
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    unknown_policy: str = "unmapped"


def choices(*maps: Column, selected: Column | None = None, confidence: Column | None = None, entities: Column | None = None) -> Column:
    """array<struct<choice, probability>> by (-probability, choice).

    Probability maps are merged in order, later ones win, values are clamped to [0, 1]; a selected choice that no map has
    comes with its confidence; scored entities stand in only where nothing else gave a choice."""
    empty = F.create_map().cast("map<string,double>")
    merged = F.map_from_entries(F.array().cast("array<struct<key:string,value:double>>"))
    for m in maps:
        m = F.coalesce(m, empty)
        merged = F.map_concat(_lacking(merged, m), m)
    if selected is not None and confidence is not None:
        extra = F.when(selected.isNotNull() & confidence.isNotNull() & ~F.map_contains_key(merged, selected), F.create_map(selected, confidence.cast("double")))
        merged = F.map_concat(merged, F.coalesce(extra, empty))
    if entities is not None:
        merged = F.when(F.size(merged) > 0, merged).otherwise(F.coalesce(entities, empty))
    entries = F.transform(F.map_entries(merged), lambda e: F.struct(e["key"].alias("choice"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), e["value"])).alias("probability")))
    return F.array_sort(
        entries,
        lambda a, b: F.when(a["probability"] > b["probability"], -1).when(a["probability"] < b["probability"], 1).when(a["choice"] < b["choice"], -1).when(a["choice"] > b["choice"], 1).otherwise(0),
    )


def _lacking(old: Column, new: Column) -> Column:
    return F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))


def offending(values: Column, allowed: tuple[str, ...]) -> Column:
    """At most three of the values outside the allowlist, sorted, joined by commas; null if there are none."""
    folded = F.array(*[F.lit(a.casefold()) for a in allowed])
    bad = F.array_sort(F.array_distinct(F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: ~F.array_contains(folded, F.lower(v)))))
    return F.when(F.size(bad) > 0, F.array_join(F.slice(bad, 1, 3), ","))


def reasons(policy: Policy, model: Column, task: Column, score: Column, evidence: Column, entities: dict[str, Column], top_choice: Column) -> Column:
    """All reasons against a record, in their fixed order."""
    found = [
        F.when(~F.coalesce(model.isin(list(policy.allowed_models)), F.lit(False)), F.lit("model_not_allowlisted")),
        F.when(~F.coalesce(task.isin(list(policy.task_actions)), F.lit(False)), F.lit("task_type_unknown")),
        F.when(score < policy.min_confidence, F.lit("confidence_below_threshold")),
    ]
    if policy.require_evidence:
        found.append(F.when(~F.coalesce(evidence, F.lit(False)), F.lit("evidence_missing")))
    for name, names in policy.allowed.items():
        if names and name in entities:
            found.append(F.concat(F.lit(f"{name}_not_allowlisted:"), offending(entities[name], names)))
    found.append(F.when(top_choice < policy.min_confidence, F.lit("decision_confidence_below_threshold")))
    return F.array_compact(F.array(*found))


def action(policy: Policy, task: Column, found: Column) -> Column:
    """The task's action, turned into reject by a hard reason and into review by any other."""
    base = F.lit("review" if policy.unknown_policy == "unmapped" else "reject")
    for name, act in policy.task_actions.items():
        base = F.when(task == name, F.lit(act)).otherwise(base)
    hard = F.arrays_overlap(found, F.array(F.lit("model_not_allowlisted"), F.lit("task_type_unknown")))
    return F.when(hard, F.lit("reject")).when((F.size(found) > 0) & (base != "reject"), F.lit("review")).otherwise(base)


def allowed(found: Column, act: Column) -> Column:
    return (F.size(found) == 0) & (act == "allow")


def classification(struct_label: Column, list_label: Column, plain: Column) -> Column:
    """One label out of the forms a head may have: a struct's label, the first of a list, a plain string."""
    return F.coalesce(struct_label, F.try_element_at(list_label, F.lit(1)), plain)


def prefiltered(capture_error: Column, status: Column, request: Column) -> Column:
    """Why the loop leaves a record out before scoring; null if it scores it."""
    return F.when(capture_error, "capture_error").when(status != 200, "non_200_response").when(F.coalesce(request, F.lit("")) == "", "missing_request")


def trainable(synthetic: Column, admission: Column) -> Column:
    """Whether a pair may be built: records of our own making only if admitted for training."""
    return ~F.coalesce(synthetic, F.lit(False)) | (F.coalesce(admission, F.lit("")) == "training_admitted")
