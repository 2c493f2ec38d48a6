"""Mixing sources to target weights, with a cap on repeats.

Efraimidis-Spirakis sampling: a document's key is an exponential variate divided by its quality weight, so sorting by
key draws without replacement with those weights.  A source's token budget is filled by complete epochs first; what is
left of it goes to the documents of smallest keys, by prefix sums of their tokens; where a document doesn't fit any more,
the next smaller ones go on filling what is left.

A source may hold any share of all rows, so no source is sorted as a whole.  Keys fall into ``BINS`` bins of equal numbers
of documents for any one weight; bin totals (at most sources x BINS rows, whatever the data) are prefix-summed, bins
below the budget are taken whole, and the bin in which a budget ends is cut into ``BINS`` again, until what is left of it
is at most ``EDGE`` documents or has a single key.  Only these are sorted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.shared import materialise
from tracewright.llm.tokens import TOKENIZERS, token_counts

BINS = 512
#: Documents that one task sorts at most, a source.
EDGE = 20_000
#: The largest number of targets; what is broadcast here has at most TARGETS x BINS rows of a few numbers.
TARGETS = 1000
#: Characters a token of clean prose has with such vocabularies; the quality weight is a text's own figure against it.
PROSE = 4.0
LEAST_WEIGHT = 0.05


def bounded(targets: DataFrame) -> DataFrame:
    """The targets, which are refused if there are more than are broadcast."""
    n = targets.count()
    if n > TARGETS:
        raise ValueError(f"{n} targets; at most {TARGETS}")
    return targets


def weighed(documents: DataFrame, targets: DataFrame, seed: int = 7, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens, sort_key) of the documents of targeted sources, each row once.

    The quality weight is the number of characters a token covers, relative to clean prose and kept within
    [0.05, 1]: dumps of numbers, images and traces compress badly and are drawn late.
    """
    aimed = documents.join(F.broadcast(bounded(targets).select("source").distinct()), "source", "left_semi")
    counted = token_counts(aimed, ["doc_id", "source"], tokenizers)
    weight = F.least(F.lit(1.0), F.greatest(F.lit(LEAST_WEIGHT), F.col("n_text_chars") / F.greatest(F.col("n_tokens"), F.lit(1)) / PROSE))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    key = -F.log(uniform) / weight
    return counted.select("doc_id", "source", "n_tokens", key.alias("sort_key"))


def budgets(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(source, share, max_repeats, tokens, budget, epochs, rest): what each source is to give.

    The total is the largest at which every source can reach its share within its repeats, or ``total`` if that is
    smaller.  Sources without tokens, with a null or non-positive share, or with no repeats can give nothing; the shares
    of the others are scaled to sum to 1.
    """
    given = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    known = sizes.join(F.broadcast(given), "source").where("tokens > 0 and target_share > 0 and max_repeats > 0")
    whole = Window.partitionBy(F.lit(1))  # as many rows as there are targets
    scaled = known.withColumn("share", F.col("target_share") / F.sum("target_share").over(whole))
    reach = F.floor(F.min(F.col("max_repeats") * F.col("tokens") / F.col("share")).over(whole) * (1 - 1e-12))
    scaled = scaled.withColumn("total", reach if total is None else F.least(reach, F.lit(int(total))))
    scaled = scaled.withColumn("budget", F.floor(F.col("total") * F.col("share")).cast("bigint"))
    scaled = scaled.withColumn("epochs", F.least(F.floor(F.col("budget") / F.col("tokens")), F.col("max_repeats")).cast("int"))
    rest = F.when(F.col("epochs") < F.col("max_repeats"), F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0)
    return scaled.withColumn("rest", rest.cast("bigint")).select("source", "share", "max_repeats", "tokens", "budget", "epochs", "rest")


def mixed(documents: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 7, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens, repeats): each chosen document and how often it is used.

    Null and untargeted sources give nothing; documents without tokens follow the complete epochs only; an empty table
    or empty targets give no row; repeated rows of a document are drawn on their own.
    """
    # Tokens are counted once and read several times, so they are written to the shared folder.
    rows = materialise(weighed(documents, targets, seed, tokenizers), "mixing-tokens")
    sizes = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    plan = materialise(budgets(sizes, targets, total).join(sizes.select("source", "n"), "source"), "mixing-plan")
    # One row a target: the range of keys in which its budget ends, the tokens before it, and the documents in it.
    span = plan.select("source", "epochs", "rest", F.lit(0.0).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(0).cast("bigint").alias("before"), "n")
    for _ in range(LEVELS):
        if not span.where(F.col("n") > EDGE).limit(1).count():
            break
        span = materialise(_narrowed(rows, span.where(F.col("n") > EDGE)).unionByName(span.where(F.col("n") <= EDGE)), "mixing-range")
    placed = rows.join(F.broadcast(span.drop("n")), "source")  # one row a target
    within = (F.col("sort_key") >= F.col("lo")) & (F.col("sort_key") < F.col("hi")) & (F.col("n_tokens") > 0) & (F.col("rest") > F.col("before"))
    columns = ["doc_id", "source", "n_tokens", "epochs", "extra"]
    whole = placed.where(~within).withColumn("extra", F.when((F.col("sort_key") < F.col("lo")) & (F.col("n_tokens") > 0), 1).otherwise(0)).select(*columns)
    # Repeated rows are one row with their number here, so a document repeated without end is no long group.
    edge = placed.where(within).groupBy("source", "doc_id", "sort_key", "n_tokens", "epochs", (F.col("rest") - F.col("before")).alias("room")).agg(F.count("*").alias("m"))
    filled = edge.groupBy("source").applyInPandas(_fill, "doc_id bigint, source string, n_tokens bigint, epochs int, m bigint, taken bigint")
    filled = filled.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("m")))).withColumn("extra", (F.col("_i") <= F.col("taken")).cast("int")).select(*columns)
    return whole.unionByName(filled).withColumn("repeats", (F.col("epochs") + F.col("extra")).cast("int")).where("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")


#: How often a range of keys is cut into BINS at most; 512 to the fifth power is finer than the keys themselves.
LEVELS = 5


def _narrowed(rows: DataFrame, span: DataFrame) -> DataFrame:
    """Each target's range cut down to the bin of keys in which its budget ends, or to the last one if all of it fits."""
    known = rows.join(F.broadcast(span.drop("n")), "source").where("sort_key >= lo and sort_key < hi")
    scaled = lambda c: c / (1 + c)
    top = F.when(F.col("hi") == float("inf"), 1.0).otherwise(scaled(F.col("hi")))
    share = (scaled(F.col("sort_key")) - scaled(F.col("lo"))) / (top - scaled(F.col("lo")))
    binned = known.withColumn("bin", F.greatest(F.lit(0), F.least(F.floor(share * BINS), F.lit(BINS - 1))).cast("int"))
    bins = binned.groupBy("source", "epochs", "rest", "before", "bin").agg(F.sum("n_tokens").alias("bin_tokens"), F.count("*").alias("n"), F.min("sort_key").alias("first"), F.max("sort_key").alias("last"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # at most BINS rows a target
    ended = bins.withColumn("end", F.col("before") + F.sum("bin_tokens").over(upto))
    bin_of = F.min(F.struct(F.col("end") <= F.col("rest"), F.when(F.col("end") > F.col("rest"), F.col("bin")).otherwise(-F.col("bin")), "bin")).over(Window.partitionBy("source"))
    found = ended.withColumn("_chosen", bin_of["bin"]).where("bin = _chosen")
    after = F.col("last") + F.greatest(F.col("last") * 1e-15, F.lit(1e-300))  # the next number that is larger, or nearly
    return found.select("source", "epochs", "rest", F.col("first").alias("lo"), after.alias("hi"), (F.col("end") - F.col("bin_tokens")).alias("before"), F.when(F.col("first") < F.col("last"), F.col("n")).otherwise(0).alias("n"))


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of a target's last range of keys, drawn in order as long as they fit."""
    rows = rows.sort_values(["sort_key", "doc_id"])
    left = int(rows["room"].iloc[0])
    sizes, copies = rows["n_tokens"].to_numpy(), rows["m"].to_numpy()
    taken = np.zeros(len(sizes), np.int64)
    for i, (n, m) in enumerate(zip(sizes.tolist(), copies.tolist())):
        if n <= left:
            taken[i] = min(m, left // n)
            left -= taken[i] * n
    # Of those left out the one that goes least beyond the budget is taken unless leaving it out comes closer.
    over = np.flatnonzero((taken < copies) & (sizes <= 2 * left))
    if len(over):
        taken[over[np.argmin(sizes[over])]] += 1
    return rows.assign(taken=taken)[["doc_id", "source", "n_tokens", "epochs", "m", "taken"]]


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, used_tokens, documents, most_repeats) of every target, reached or not."""
    used = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("used_tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    whole = Window.partitionBy(F.lit(1))  # as many rows as there are targets
    out = targets.groupBy("source").agg(F.sum("target_share").alias("target_share")).join(used, "source", "left").fillna(0, ["used_tokens", "documents", "most_repeats"])
    return out.withColumn("actual_share", F.coalesce(F.try_divide(F.col("used_tokens"), F.sum("used_tokens").over(whole)), F.lit(0.0)))
