"""The percentile definitions in use, entropy, rates and rankings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.ordering import running_sum


def finite(c: Column) -> Column:
    """The value where it is finite, else null: NaN and infinities never enter an aggregate."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def at_ranks(frame: DataFrame, key: str, value: str, ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """(key, v0, v1, ...): the finite values of a key at given ranks (from 0) of their order, computed from its number n.

    Equal values are counted before anything is shuffled; running counts over range partitions find the ranks, so no task
    sorts or holds a key, however many rows and distinct values it has."""
    counts = frame.select(key, finite(F.col(value)).alias("_v")).where("_v is not null").groupBy(key, "_v").agg(F.count("*").alias("_c"))
    sizes = counts.groupBy(key).agg(F.sum("_c").alias("_n"))
    placed = running_sum(counts, [key], ["_v"], "_to", "_c").join(sizes, key)
    found = [F.min(F.when(F.col("_to") > r, F.col("_v"))).alias(f"v{i}") for i, r in enumerate(ranks(F.col("_n")))]
    return placed.groupBy(key).agg(F.max("_n").alias("_n"), *found)


def percentile_nearest(frame: DataFrame, key: str, value: str, q: float, digits: int | None = 3) -> DataFrame:
    """(key, v): the value of rank round(q (n - 1)), half to even. A key without finite values has no row."""
    out = at_ranks(frame, key, value, lambda n: [F.bround(F.lit(q) * (n - 1))])
    return out.select(key, (F.col("v0") if digits is None else F.round("v0", digits)).alias("v"))


def percentile_linear(frame: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """(key, v): linear interpolation between ranks."""
    out = at_ranks(frame, key, value, lambda n: [F.floor(F.lit(q) * (n - 1)), F.ceil(F.lit(q) * (n - 1))])
    place = F.lit(q) * (F.col("_n") - 1)
    return out.select(key, (F.col("v0") + (F.col("v1") - F.col("v0")) * (place - F.floor(place))).alias("v"))


def percentile_floor(frame: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """(key, v): the value of rank floor((n - 1) q)."""
    return at_ranks(frame, key, value, lambda n: [F.floor((n - 1) * F.lit(q))]).select(key, F.col("v0").alias("v"))


def percentile_soak(frame: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """(key, v). Median: rank n div 2; others: rank int(n q) - 1, at least the first."""
    rank = lambda n: F.floor(n / 2) if q == 0.5 else F.greatest(F.floor(n * F.lit(q)) - 1, F.lit(0))
    return at_ranks(frame, key, value, lambda n: [rank(n)]).select(key, F.col("v0").alias("v"))


def entropy(probabilities: Column) -> Column:
    """Shannon entropy in nats of an array of weights, normalised; 0 where they sum to nothing."""
    total = F.aggregate(probabilities, F.lit(0.0), lambda a, x: a + x)
    return F.when(
        total > 0,
        -F.aggregate(probabilities, F.lit(0.0), lambda a, x: a + F.when(x > 0, x / total * F.log(x / total)).otherwise(0.0)),
    ).otherwise(0.0)


def share(part: Column, whole: Column) -> Column:
    """A rate that is 0 on an empty whole."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def top_labels(probabilities: Column, k: int, least: float) -> Column:
    """Labels of an array of (label, p) ranked by (-p, label): the first k at or above ``least``, else the very first."""
    ranked = F.array_sort(
        probabilities,
        lambda a, b: F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1).when(a["label"] < b["label"], -1).when(a["label"] > b["label"], 1).otherwise(0),
    )
    kept = F.filter(F.slice(ranked, 1, k), lambda x: x["p"] >= least)
    return F.transform(F.when(F.size(kept) > 0, kept).otherwise(F.slice(ranked, 1, 1)), lambda x: x["label"])
