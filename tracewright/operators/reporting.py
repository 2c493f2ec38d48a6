"""Counts, rates and quality figures over records, decisions, labels and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.ordering import previous
from tracewright.functions.statistics import entropy, finite, share
from tracewright.functions.text import micros


def by_reason(frame: DataFrame, reason: str = "reason") -> DataFrame:
    return frame.groupBy(F.coalesce(reason, F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


def ingest_counters(routes: DataFrame) -> DataFrame:
    """(received, accepted, duplicates, dlq, quarantined) of rows with a route; received is always their sum."""
    n = lambda r: F.count_if(F.col("route") == r)
    return routes.agg(F.count("*").alias("received"), n("accepted").alias("accepted"), n("duplicate").alias("duplicates"), n("dlq").alias("dlq"), n("quarantine").alias("quarantined"))


def decision_mix(frame: DataFrame, action: str = "action") -> DataFrame:
    """(total, allow, review, reject) in percent to one place; zeros over nothing."""
    total = F.count("*")
    pct = lambda a: F.bround(100.0 * share(F.count_if(F.col(action) == a), total), 1).alias(a)
    return frame.agg(total.alias("total"), pct("allow"), pct("review"), pct("reject"))


def latest(frame: DataFrame, order: str, n: int) -> DataFrame:
    """The last ``n`` rows by order; a bounded report, so it is the one place where rows are limited."""
    return frame.orderBy(F.col(order).desc()).limit(n)


def precision_recall(counts: DataFrame, label: str | None) -> DataFrame:
    """Precision, recall and F1 of rows with tp, fp and fn, per label or over all; 0 on empty denominators."""
    agg = [F.sum(c).alias(c) for c in ("tp", "fp", "fn")]
    out = counts.groupBy(label).agg(*agg) if label else counts.agg(*agg)
    p, r = share(F.col("tp"), F.col("tp") + F.col("fp")), share(F.col("tp"), F.col("tp") + F.col("fn"))
    return out.withColumn("precision", p).withColumn("recall", r).withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def agreement(frame: DataFrame, want: str = "want", got: str = "got") -> DataFrame:
    """(n, overlap, exact): how often fresh labels meet stored ones, where there are any stored."""
    rows = frame.where(F.size(want) > 0)
    same = F.array_sort(F.col(want)) == F.array_sort(F.col(got))
    return rows.agg(F.count("*").alias("n"), F.round(F.avg(F.arrays_overlap(want, got).cast("double")), 4).alias("overlap"), F.round(F.avg(same.cast("double")), 4).alias("exact"))


def label_histogram(frame: DataFrame, task: str, label: str, most: int = 6) -> DataFrame:
    """The ``most`` commonest labels of each task; ties by label. Counted before they are ranked."""
    counts = frame.groupBy(task, label).agg(F.count("*").alias("n"))
    w = Window.partitionBy(task).orderBy(F.col("n").desc(), label)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def duplicate_inputs(frame: DataFrame, text: str) -> DataFrame:
    """(rows, distinct, surplus) of texts by their hash; nulls are left out."""
    per = frame.where(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("h")).agg(F.count("*").alias("c"))
    return per.agg(F.sum("c").alias("n_rows"), F.count("*").alias("n_distinct"), F.sum(F.col("c") - 1).alias("surplus"))


def distribution(frame: DataFrame, probabilities: str) -> DataFrame:
    """(n, mean_top, mean_entropy) of arrays of probabilities."""
    return frame.agg(F.count("*").alias("n"), F.avg(F.array_max(probabilities)).alias("mean_top"), F.avg(entropy(F.col(probabilities))).alias("mean_entropy"))


def backlog(files: DataFrame) -> DataFrame:
    """(committed, backlog) in bytes of files with ``size`` and ``committed``."""
    return files.agg(F.sum("committed").alias("committed"), F.sum(F.greatest(F.lit(0), F.col("size") - F.col("committed"))).alias("backlog"))


def cursor(files: DataFrame) -> DataFrame:
    """How far a corpus was read: (files_total, files_finished, bytes_done, bytes_total, current, current_offset)."""
    open_ = F.col("committed") < F.col("size")
    return files.agg(
        F.count("*").alias("files_total"),
        F.count_if(~open_).alias("files_finished"),
        F.sum(F.least("committed", "size")).alias("bytes_done"),
        F.sum("size").alias("bytes_total"),
        F.min(F.when(open_, F.col("rel_path"))).alias("current"),
        F.min_by("committed", F.when(open_, F.col("rel_path"))).alias("current_offset"),
    )


def maxima(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.agg(*[F.max(c).alias(c) for c in columns])


def alignment(records: Column, interval: int) -> tuple[Column, Column, Column]:
    """(whole intervals, records they cover, record at which the next begins)."""
    base = F.floor(records / interval).cast("bigint")
    return base, base * interval, (base + 1) * interval


def repeated(frame: DataFrame, column: str) -> DataFrame:
    return frame.agg((F.count(column) - F.count_distinct(column)).alias("repeated"))


def rollup_figures(frame: DataFrame, column: str) -> DataFrame:
    v = finite(F.col(column))
    return frame.agg(F.min(v).alias("least"), F.avg(v).alias("mean"), F.max(v).alias("most"), F.count(v).alias("n"))


def rate_per_minute(frame: DataFrame, key: str, time: str, counter: str) -> DataFrame:
    """A counter's growth a minute between samples; null for the first and where no time passed."""
    rows = previous(frame, [key], [time], [time, counter], "_before_")
    seconds = micros(time) - micros(f"_before_{time}")
    grown = F.try_divide((F.col(counter) - F.col(f"_before_{counter}")) * 60e6, F.nullif(seconds, F.lit(0)))
    return rows.withColumn("per_minute", grown).select(*frame.columns, "per_minute")


def gaps(frame: DataFrame, key: str, order: list[str], time: str, longest: float) -> DataFrame:
    """Rows that come more than ``longest`` seconds after the one before them of their key, with ``gap_seconds``."""
    rows = previous(frame, [key], order, [time], "_before_")
    gap = (micros(time) - micros(f"_before_{time}")) / 1e6
    return rows.withColumn("gap_seconds", gap).where(F.col("gap_seconds") > longest).select(*frame.columns, "gap_seconds")


def norm(frame: DataFrame, key: str, value: str) -> DataFrame:
    return frame.groupBy(key).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))


def top_combined(*rates: Column) -> Column:
    """The mean of the rates that are there; null if none is."""
    there = F.array_compact(F.array(*rates))
    return F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda a, x: a + x) / F.size(there))
