"""Scoring behind an interface: any model can stand in; the dictionary scorer is exact and needs none."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTRACTED = "spans array<struct<label:string,text:string,start:int,end:int,confidence:double>>, probabilities map<string,double>"
_TYPE = pa.list_(pa.struct([("label", pa.string()), ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64())]))


class Scorer(Protocol):
    def spans(self, text: str) -> list[dict]: ...

    def probabilities(self, text: str) -> dict[str, float]: ...


class DictionaryScorer:
    """Spans of known words by label, and label probabilities by the share of their cue words (add-one over all labels)."""

    def __init__(self, words: dict[str, list[str]], cues: dict[str, list[str]]):
        self.cues = {k: [c.lower() for c in v] for k, v in cues.items()}
        self.label = {w: k for k, v in words.items() for w in v}
        self.pattern = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, self.label), key=len, reverse=True)) + r")(?!\w)") if words else None

    def spans(self, text: str) -> list[dict]:
        found = self.pattern.finditer(text) if self.pattern else ()
        return [{"label": self.label[m.group()], "text": m.group(), "start": m.start(), "end": m.end(), "confidence": 1.0} for m in found]

    def probabilities(self, text: str) -> dict[str, float]:
        low = text.lower()
        hits = {k: 1 + sum(low.count(c) for c in v) for k, v in self.cues.items()}
        return {k: n / sum(hits.values()) for k, n in hits.items()}


#: Texts a scorer is given at once.
CHUNK = 16


def scored(frame: DataFrame, text: str, scorer: Scorer, chunk: int = CHUNK) -> DataFrame:
    """The frame with ``spans`` and ``probabilities``; the scorer is built once a worker and fed Arrow batches. Null texts
    have neither. A scorer that has ``batch(texts)`` gets ``chunk`` texts at once and gives (spans, probabilities) of each."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    at = frame.columns.index(text)

    def judged(texts: list[str]) -> list[tuple[list[dict], dict[str, float]]]:
        if not hasattr(scorer, "batch"):
            return [(scorer.spans(t), scorer.probabilities(t)) for t in texts]
        return [r for i in range(0, len(texts), chunk) for r in scorer.batch(texts[i : i + chunk])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            results = iter(judged([t for t in texts if t is not None]))
            both = [next(results) if t is not None else (None, None) for t in texts]
            spans = pa.array([s for s, _ in both], _TYPE)
            maps = pa.array([list(p.items()) if p is not None else None for _, p in both], pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, spans, maps], names=[*batch.schema.names, "spans", "probabilities"])

    return frame.mapInArrow(run, f"{schema}, {EXTRACTED}")


def _over(probabilities: Column, labels: list[str]) -> Column:
    return F.map_filter(probabilities, lambda k, v: k.isin(labels))


def single_label(probabilities: Column, labels: list[str], threshold: float) -> Column:
    """struct<value, confidence, probabilities>: the best of the labels, null where it is under the threshold; ties by name."""
    own = _over(probabilities, labels)
    best = F.element_at(_ranked(own), 1)
    holds = F.coalesce(best["p"] >= threshold, F.lit(False))
    return F.struct(F.when(holds, best["label"]).alias("value"), F.when(holds, best["p"]).alias("confidence"), own.alias("probabilities"))


def multi_label(probabilities: Column, labels: list[str], threshold: float, least: int = 0, most: int | None = None) -> Column:
    """struct<value, confidence, probabilities>: all labels at or above the threshold, from the best, at least ``least`` and
    at most ``most`` of them; the confidence is that of the best chosen, null if none is. Without labels all is empty."""
    own = _over(probabilities, labels)
    ranked = _ranked(own)
    n = F.greatest(F.size(F.filter(ranked, lambda x: x["p"] >= threshold)), F.lit(least))
    chosen = F.slice(ranked, F.lit(1), F.least(n, F.lit(len(labels) if most is None else most)))
    return F.struct(F.transform(chosen, lambda x: x["label"]).alias("value"), F.try_element_at(chosen, F.lit(1))["p"].alias("confidence"), own.alias("probabilities"))


def tool_task(probabilities: Column, tasks: list[str], choices: list[str], threshold: float) -> Column:
    """struct<task_type, decision_choice>: one task and any number of choices, each with the probabilities it came from."""
    return F.struct(single_label(probabilities, tasks, threshold).alias("task_type"), multi_label(probabilities, choices, threshold).alias("decision_choice"))


def _ranked(probabilities: Column) -> Column:
    entries = F.transform(F.map_entries(probabilities), lambda e: F.struct((-e["value"]).alias("_n"), e["key"].alias("label"), e["value"].alias("p")))
    return F.array_sort(entries)
