"""What dashboards and gates read: freshness, feeds, newest checkpoints, ledgers, dependency graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.ordering import running_sum
from tracewright.functions.shared import materialise
from tracewright.functions.text import micros


def age_seconds(written: Column, now: Column) -> Column:
    """Never negative: a time in the future is as fresh as can be."""
    return F.greatest(F.lit(0.0), (micros(now) - micros(written)) / 1e6)


def freshness(state: Column, age: Column, limit: float) -> Column:
    """running turned stale by age; missing where there is no heartbeat."""
    return F.when(age.isNull(), "missing").when((state == "running") & (age > limit), "stale").otherwise(state)


def heartbeats(services: DataFrame, beats: DataFrame, now: Column, limit: float) -> DataFrame:
    """(service, state, age): every service of the list, with its latest heartbeat if it has one."""
    newest = beats.groupBy("service").agg(F.max("written_at").alias("written_at"), F.max_by("state", "written_at").alias("state"))
    joined = services.join(newest, "service", "left").withColumn("age", F.when(F.col("written_at").isNotNull(), age_seconds(F.col("written_at"), now)))
    return joined.select("service", freshness(F.col("state"), F.col("age"), limit).alias("state"), "age")


def watchdog(bridge_alive: Column, trainer_alive: Column, idle_seconds: Column, limit: float = 3600) -> Column:
    """The code with which a supervised loop ends: 11 without bridge, 12 without trainer, 13 without records for too long;
    0 as long as it goes on. What isn't known of a part counts as alive, of the records as none since ever."""
    return F.when(~F.coalesce(bridge_alive, F.lit(True)), 11).when(~F.coalesce(trainer_alive, F.lit(True)), 12).when(F.coalesce(idle_seconds, F.lit(float("inf"))) >= limit, 13).otherwise(0)


def feed(frame: DataFrame, view: str) -> DataFrame:
    """all, real, synthetic, or the rows of one action."""
    if view == "all":
        return frame
    if view in ("real", "synthetic"):
        return frame.where(F.col("synthetic") if view == "synthetic" else ~F.col("synthetic"))
    return frame.where(F.col("action") == view)


def since(frame: DataFrame, seq: int, most: int = 400) -> DataFrame:
    """Rows after a cursor among the last ``most`` of a feed."""
    return frame.orderBy(F.col("seq").desc()).limit(most).where(F.col("seq") > seq).orderBy("seq")


def not_seen(frame: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys a ledger doesn't have; rows with a null key are never in it. The ledger is made distinct first."""
    return frame.join(seen.select(*keys).distinct(), keys, "left_anti")


def deltas(frame: DataFrame, time: str, *keys: str) -> DataFrame:
    """(second, keys, n, total): what came in each second and how much that makes, for a feed of a snapshot and its changes."""
    per = frame.groupBy(F.date_trunc("second", time).alias("second"), *keys).agg(F.count("*").alias("n"))
    return running_sum(per, list(keys), ["second"], "total", "n")


def replayed_from(frame: DataFrame, time: str, start) -> DataFrame:
    """Deliveries from a time on, in the order they came; the filter reaches the scan."""
    return frame.where(F.col(time) >= F.lit(start))


def records_per_generation(real: Column, generation: Column) -> Column:
    return F.round(real / F.greatest(F.lit(1), generation), 6)


def prefix_lookup(digests: DataFrame, ledger: DataFrame, width: int = 12) -> DataFrame:
    """The newest generation whose digest begins with each given prefix: an equi-join on the shared width, not a theta-join."""
    short = ledger.withColumn("_p", F.substring("digest", 1, width)).groupBy("_p").agg(F.max("generation").alias("generation"), F.max_by("digest", "generation").alias("digest"))
    return digests.withColumn("_p", F.substring("prefix", 1, width)).join(short, "_p", "left").drop("_p")


def newest_deployable(manifests: DataFrame, ledger: DataFrame) -> DataFrame:
    """(generation, digest): of the manifest if it has a digest, else the last ledger row that has one."""
    m = manifests.where("digest is not null").select(F.lit(0).alias("_o"), "generation", "digest")
    last = ledger.where("digest is not null").agg(F.max("generation").alias("generation"), F.max_by("digest", "generation").alias("digest")).select(F.lit(1).alias("_o"), "generation", "digest")
    return m.unionByName(last).where("digest is not null").orderBy("_o", F.col("generation").desc()).limit(1).drop("_o")


def deploy_decision(target: Column, loaded: Column, same: Column, age: Column, since_last: Column, gained: Column, quiet: float, pause: float, needed: int, force: bool = False) -> Column:
    """What a gate says about a checkpoint: the first obstacle, else deploy. Forcing passes over the last three."""
    out = F.when(target.isNull(), "no_checkpoint_generation").when((target <= loaded) & same, "up_to_date")
    if not force:
        out = out.when(age < quiet, "waiting_for_stable_checkpoint").when(since_last < pause, "cooldown").when(gained < needed, "waiting_records")
    return out.otherwise("deploy")


def publish_due(consumed: Column, last: Column, interval: int) -> Column:
    return (consumed - last >= interval) if interval > 0 else F.lit(False)


def overlaid(base: DataFrame, live: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Base values with live ones over them where those are not null."""
    over = live.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return base.join(over, key, "left").select(key, *[F.coalesce(f"_{c}", c).alias(c) for c in columns])


def retained(frame: DataFrame, order: str, keep: int) -> DataFrame:
    return frame.orderBy(F.col(order).desc()).limit(keep)


def graph_errors(tasks: DataFrame, dependencies: DataFrame) -> DataFrame:
    """(task, error): unknown dependencies, tasks accepted before what they depend on, and tasks on or behind a cycle.

    Tasks are peeled off in rounds once everything they depend on is gone; what remains depends on a cycle. Each round
    is written to the shared folder, so lineage stays short however deep the graph is."""
    known = tasks.select("task").distinct()
    edges = dependencies.select("task", "needs").distinct()
    unknown = edges.join(known, edges["needs"] == known["task"], "left_anti").select("task", F.concat(F.lit("unknown_dependency:"), "needs").alias("error"))
    early = (
        edges.join(tasks.select(F.col("task"), F.col("state").alias("s")), "task").where("s = 'accepted'")
        .join(tasks.select(F.col("task").alias("needs"), F.col("state").alias("n")), "needs").where("n <> 'accepted'")
        .select("task", F.concat(F.lit("accepted_before:"), "needs").alias("error"))
    )
    left = edges.join(known.withColumnRenamed("task", "needs"), "needs", "left_semi")
    count = left.count()
    while count:
        held = left.select(F.col("task").alias("needs")).distinct()
        left = materialise(left.join(held, "needs", "left_semi").select("task", "needs"), "graph")
        fewer = left.count()
        if fewer == count:
            break
        count = fewer
    cycles = left.select("task", F.lit("cycle").alias("error")).distinct()
    return unknown.unionByName(early).unionByName(cycles)


def frontier(tasks: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Tasks that are not accepted and whose dependencies all are."""
    open_ = dependencies.join(tasks.select(F.col("task").alias("needs"), "state"), "needs", "left").where("state is null or state <> 'accepted'").select("task").distinct()
    return tasks.where("state <> 'accepted'").join(open_, "task", "left_anti").select("task")
