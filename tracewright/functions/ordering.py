"""Running counts and sums within keys that no task has to hold: however large a key is, its rows stay spread."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.shared import materialise


def _changes(column: pa.Array, last) -> np.ndarray:
    """Whether each value differs from the one before it, nulls being equal; ``last`` (a scalar) stands before the first."""
    before = pa.concat_arrays([pa.array([last.as_py()], column.type), column.slice(0, len(column) - 1)])
    unlike = pc.fill_null(pc.not_equal(column, before), False).to_numpy(zero_copy_only=False)
    return unlike | (column.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))


def running_sum(frame: DataFrame, keys: list[str], order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """``frame`` with the sum of ``weight`` (or the number of rows) of each key up to and including each row, as ``name``.

    Rows are range-partitioned by (keys, order), summed within each partition in one pass, and written to the shared folder
    with the partition's number.  Only a partition's first key may have begun in earlier ones; what these hold of it is
    taken from two values a partition.  ``order`` must not leave ties whose order matters; weights are whole numbers.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema) + f", `{name}` bigint, _part int, _first boolean"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, total, first = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k) for k in keys]
            fresh = np.zeros(n, bool)
            for column, before in zip(columns, last or [c[0] for c in columns]):
                fresh |= _changes(column, before)
            amounts = np.ones(n, np.int64) if weight is None else pc.fill_null(batch.column(weight), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(amounts)
            at = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            sums = np.where(at < 0, upto + total, upto - np.where(at > 0, upto[at - 1], 0))
            in_first = (at < 0) & first
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums), pa.array(np.full(n, part, np.int32)), pa.array(in_first)], names=[*batch.schema.names, name, "_part", "_first"])
            last, total, first = [c[n - 1] for c in columns], int(sums[-1]), first and not fresh.any()

    sort = [F.col(c) for c in [*keys, *order]]
    rows = materialise(frame.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(summed, schema), "running")
    key = F.struct(*keys)
    edges = rows.groupBy("_part").agg(F.min(key).alias("first_key"), F.max(F.struct(key.alias("key"), F.col(name).alias("n"))).alias("last"))
    # One row a partition, so these windows are bounded by the number of partitions.
    ends = edges.select("_part", F.col("last.key").alias("key"), F.lit(1).alias("_last"), F.col("last.n").alias("n"))
    begins = edges.select("_part", F.col("first_key").alias("key"), F.lit(0).alias("_last"), F.lit(None).cast("bigint").alias("n"))
    earlier = Window.partitionBy("key").orderBy("_part", "_last").rowsBetween(Window.unboundedPreceding, -1)
    carried = begins.unionByName(ends).withColumn("_carried", F.sum("n").over(earlier)).where("_last = 0 and _carried is not null").select("_part", "_carried")
    whole = rows.join(F.broadcast(carried), "_part", "left")  # two numbers a partition
    return whole.withColumn(name, F.col(name) + F.when(F.col("_first"), F.coalesce("_carried", F.lit(0))).otherwise(0)).drop("_part", "_first", "_carried")


def numbered(frame: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``frame`` with each row's place within its key, from 1."""
    return running_sum(frame, keys, order, name)


def previous(frame: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str = "previous_") -> DataFrame:
    """``frame`` with what the row before each one of its key has in ``columns``, and ``<prefix>exists``, whether there is one.

    As ``running_sum``: one pass over range partitions; what stands before a partition's first row is the last row of the
    partition before it, so one row a partition is looked up."""
    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    added = [f"{prefix}{c}" for c in columns]
    schema = ", ".join(f"`{n}` {t}" for n, t in types.items()) + "".join(f", `{a}` {types[c]}" for a, c in zip(added, columns)) + f", `{prefix}exists` boolean, _part int, _begins boolean, _ends boolean"

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            # The last row of what has come so far is held back, as only the end shows which one ends the partition.
            fresh = np.zeros(n, bool)
            for k in keys:
                fresh |= _changes(batch.column(k), last[batch.schema.get_field_index(k)][0] if last else batch.column(k)[0])
            fresh[0] |= last is None
            keep = pa.array(~fresh)
            values = []
            for c in columns:
                own = batch.column(c)
                before = pa.concat_arrays([last[batch.schema.get_field_index(c)] if last else pa.nulls(1, own.type), own.slice(0, n - 1)])
                values.append(pc.if_else(keep, before, pa.scalar(None, own.type)))
            begins = np.zeros(n, bool)
            begins[0] = last is None
            out = pa.RecordBatch.from_arrays([*batch.columns, *values, keep, pa.array(np.full(n, part, np.int32)), pa.array(begins)], names=[*batch.schema.names, *added, f"{prefix}exists", "_part", "_begins"])
            if held is not None:
                yield _ending(held, False)
            if n > 1:
                yield _ending(out.slice(0, n - 1), False)
            held = out.slice(n - 1)
            last = [column.slice(n - 1) for column in batch.columns]
        if held is not None:
            yield _ending(held, True)

    sort = [F.col(c) for c in [*keys, *order]]
    rows = materialise(frame.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(shifted, schema), "previous")
    edge = F.struct(F.struct(*keys).alias("key"), F.struct(*columns).alias("values"))
    ends = rows.where("_begins or _ends").groupBy("_part").agg(F.max(F.when(F.col("_begins"), edge)).alias("first"), F.max(F.when(F.col("_ends"), edge)).alias("last"))
    # One row a partition.
    before = ends.withColumn("_before", F.lag("last").over(Window.orderBy("_part"))).where(F.col("_before.key").eqNullSafe(F.col("first.key")) & F.col("_before").isNotNull()).select("_part", F.lit(True).alias("_begins"), "_before")
    joined = rows.drop("_ends").join(F.broadcast(before), ["_part", "_begins"], "left")  # one row a partition
    found = F.col("_before").isNotNull()
    return joined.select(*types, *[F.when(found, F.col("_before")["values"][c]).otherwise(F.col(a)).alias(a) for a, c in zip(added, columns)], (F.col(f"{prefix}exists") | found).alias(f"{prefix}exists"))


def _ending(batch: pa.RecordBatch, ends: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, ends))], names=[*batch.schema.names, "_ends"])
