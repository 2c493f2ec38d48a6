"""Lineages of a model in training, as rows: resuming checkpoints, resets with warm-up, published snapshots."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions.shared import read_text, write_text
from tracewright.operators.ordered import streamed


def resumed(checkpoints: DataFrame, config_digest: str, adapter_keys: list[str], allow_drift: bool = False) -> DataFrame:
    """(checkpoint, error, config_drift, optimizer_restored, training_steps, ema_updates, reset_id) of each checkpoint
    (checkpoint, kind, config_digest, adapter_keys, ema_updates, training_steps, reset_id, has_optimizer).

    The first thing that stands against resuming is the error: another kind of checkpoint, another configuration (unless
    drift is allowed), other adapter keys.  With drift counters go on and the optimizer starts anew.  Counters that a
    checkpoint lacks are 0; nothing of one that can't be resumed is taken over."""
    drift = ~F.coalesce(F.col("config_digest") == config_digest, F.lit(False))
    wanted = F.array(*map(F.lit, sorted(adapter_keys))).cast("array<string>")
    same_keys = F.coalesce(F.array_sort(F.array_distinct("adapter_keys")) == wanted, F.lit(False))
    error = F.when(~F.coalesce(F.col("kind") == "adapter-only", F.lit(False)), "unsupported_checkpoint").when(drift & F.lit(not allow_drift), "config_digest_mismatch").when(~same_keys, "adapter_keys_mismatch")
    rows = checkpoints.withColumn("error", error).withColumn("config_drift", drift)
    fine = F.col("error").isNull()
    taken = [F.when(fine, F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("training_steps", "ema_updates", "reset_id")]
    return rows.select("checkpoint", "error", "config_drift", F.when(fine, F.coalesce(F.col("has_optimizer"), F.lit(False)) & ~F.col("config_drift")).alias("optimizer_restored"), *taken)


def warm_starts(checkpoints: DataFrame, config_digest: str, adapter_keys: list[str]) -> DataFrame:
    """The audit rows of checkpoints that are resumed although the configuration drifted."""
    done = resumed(checkpoints, config_digest, adapter_keys, allow_drift=True).where("error is null and config_drift")
    before = checkpoints.select("checkpoint", F.col("config_digest").alias("checkpoint_config_digest"))
    return done.join(before, "checkpoint").select("checkpoint", "checkpoint_config_digest", F.lit(config_digest).alias("current_config_digest"), "training_steps", "ema_updates", "reset_id", F.lit(len(set(adapter_keys))).alias("adapter_keys"))


def reset_events(verdicts: DataFrame, archive_root: str, warmup_steps: int) -> DataFrame:
    """(lineage, reset_id, reason, step, archive, warmup_steps): the audit row of each reset among a monitor's verdicts
    (lineage, step, resets, reset_required, reason). The failed lineage is archived under its old number."""
    rows = verdicts.where("reset_required")
    archive = F.concat_ws("/", F.lit(archive_root), "lineage", F.concat(F.lit("reset-"), F.lpad((F.col("resets") - 1).cast("string"), 4, "0"), F.lit("-step-"), F.col("step").cast("string")))
    return rows.select("lineage", F.col("resets").alias("reset_id"), "reason", "step", archive.alias("archive"), F.lit(warmup_steps).alias("warmup_steps"))


WARMUP = "lineage string, ord bigint, phase string, remaining bigint, published boolean"


def warmups(steps: DataFrame, length: int) -> DataFrame:
    """(lineage, ord, phase, remaining, published) of each step (lineage, ord, reset, fine).

    A reset begins a warm-up of ``length`` steps, during which the old snapshot goes on serving.  When it is over an
    evaluator that is content (``fine``) has the new one published; its veto begins the countdown again.  Without
    warm-up steps a reset publishes at once; null flags are false."""

    def start() -> Callable:
        left = [0]

        def fold(rows: pd.DataFrame) -> pd.DataFrame:
            reset, fine = (rows[c].fillna(False).to_numpy(bool) for c in ("reset", "fine"))
            remaining, published, warming = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool), np.zeros(len(rows), bool)
            for i in range(len(rows)):
                if reset[i]:
                    left[0] = length
                    published[i], warming[i] = length == 0, length > 0
                elif left[0]:
                    warming[i] = True
                    left[0] -= 1
                    if not left[0]:
                        published[i] = fine[i]
                        left[0] = 0 if fine[i] else max(1, length)
                remaining[i] = left[0]
            phase = np.where(reset, "reset", np.where(published, "published", np.where(warming, "warmup", "serving")))
            return pd.DataFrame({"lineage": rows["lineage"].to_numpy(), "ord": rows["ord"].to_numpy(), "phase": phase, "remaining": remaining, "published": published})

        return fold

    return streamed(steps.select(F.col("lineage").cast("string").alias("lineage"), "ord", "reset", "fine"), "lineage", "ord", start, WARMUP)


def serving(warmup: DataFrame) -> DataFrame:
    """(lineage, ord, generation): what each step is served by: the number of snapshots published up to it."""
    w = Window.partitionBy("lineage").orderBy("ord")
    return warmup.select("lineage", "ord", F.sum(F.col("published").cast("bigint")).over(w).alias("generation"))


def _live(spark: SparkSession, root: str) -> int | None:
    text = read_text(spark, f"{root}/current.json")
    return json.loads(text)["generation"] if text else None


def publish(rows: DataFrame, root: str) -> int:
    """Writes an immutable snapshot as the next generation and then points readers at it; gives its number.

    Readers that hold an older generation keep it; a writer that dies before the pointer moves leaves the old one live."""
    spark = rows.sparkSession
    generation = (_live(spark, root) or 0) + 1
    rows.write.mode("overwrite").parquet(f"{root}/generation={generation}")
    write_text(spark, f"{root}/current.json", json.dumps({"generation": generation}))
    return generation


def served(spark: SparkSession, root: str, generation: int | None = None) -> DataFrame | None:
    """The live snapshot, or a given one; None before anything is published."""
    number = generation or _live(spark, root)
    return spark.read.parquet(f"{root}/generation={number}") if number else None
