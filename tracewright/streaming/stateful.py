"""Stateful operators of streams: bounded dedup by the last N keys, and drift monitoring, per key of the stream."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tracewright.operators.ordered import DRIFT, DriftPolicy, DriftState, fifo_dedup


def bounded_dedup(stream: DataFrame, by: str, order: str, key: str, size: int | None) -> DataFrame:
    """Rows whose key is not among the last ``size`` accepted ones of their group; at most ``size`` keys are kept a group.

    Without a size every key is remembered: exact, with a state that grows with the keys. Then only the hash of the key
    need be the group (``spread_by_key``), so no group is hot and each holds its share of the keys."""
    schema = stream.schema

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        window = json.loads(state.get[0]) if state.exists else []
        rows = pd.concat(list(frames)).sort_values(order)
        fresh, window = fifo_dedup(rows[key].tolist(), size if size is not None else 1 << 62, window)
        state.update((json.dumps(window),))
        yield rows[fresh]

    return stream.groupBy(by).applyInPandasWithState(step, schema, "window string", "append", GroupStateTimeout.NoTimeout)


def spread_by_key(stream: DataFrame, key: str, groups: int = 256) -> DataFrame:
    """The stream with ``_group``, a share of the keys; all rows of a key have the same."""
    return stream.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)))


def drift(stream: DataFrame, policy: DriftPolicy) -> DataFrame:
    """The drift monitor over a stream of samples; equal to the batch fold over the same rows."""

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        monitor = DriftState(policy, json.loads(state.get[0]) if state.exists else None)
        rows = pd.concat(list(frames)).sort_values("ord")
        out = monitor.run(rows)
        out.insert(0, "lineage", str(group[0]))
        out.insert(1, "ord", rows["ord"].to_numpy())
        state.update((json.dumps(monitor.saved()),))
        yield out

    return stream.groupBy("lineage").applyInPandasWithState(step, DRIFT, "monitor string", "append", GroupStateTimeout.NoTimeout)
