"""Messages delivered more than once: exactly one copy of each is kept.

Identifiers are producer sequences: a message is known by the file it came from (the producer) and its byte offset
(the number); its width is the number of bytes delivered.  A producer's seen numbers are therefore disjoint byte
ranges that merge as neighbouring messages arrive.

1. Ledger (``swept``).  Messages are range-partitioned by (producer, number, record, content, arrival) and swept once in
   that order with numpy.  A number that no seen range covers is accepted at once and its bytes join the ranges.  The
   arrival number is part of the order, so even one message that makes up a third of all rows spreads over partitions.
   A partition sees only its own ranges; how far its first producer had been seen before is taken from the last range
   of each earlier partition (two numbers a partition), and what that covers isn't accepted.  The sweep is written to
   the shared folder, partition numbers included, so every reader sees the same partitions.
2. Lookup (``copies``).  What the ledger doesn't accept - a covered number, or a malformed identifier - is resolved by exact
   lookup of (record id, content hash) among the accepted.  A row that repeats its neighbour in the order has its answer
   beside it, so only the first of each run asks: a hot message asks once a partition.
3. Check.  Two accepted numbers can name one message only if a producer's identifiers contradict its sequence (one
   message under two files, say).  Keys accepted under several numbers are found by counting 8-byte hashes and are
   looked up like the covered ones (``confirm=False`` leaves this out and trusts the sequences).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.shared import materialise

#: Verdicts of the ledger.
ACCEPTED, COVERED, MALFORMED = 0, 1, 2

SWEPT = "kind string, part int, opens boolean, closes boolean, seq_no bigint, head bigint, verdict int, number bigint, record string, content string, producer string, range_lo bigint, range_hi bigint"
_ARROW = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("opens", pa.bool_()), ("closes", pa.bool_()), ("seq_no", pa.int64()), ("head", pa.int64()), ("verdict", pa.int32()), ("number", pa.int64()), ("record", pa.string()), ("content", pa.string()), ("producer", pa.string()), ("range_lo", pa.int64()), ("range_hi", pa.int64())])

#: scheme://path#offset
PRODUCER_SEQUENCE = r"^[A-Za-z][A-Za-z0-9+.\-]*://(.+)#([0-9]{1,18})$"


def identified(envelope: DataFrame, delivery: DataFrame | None = None) -> DataFrame:
    """(seq_no, record, content, producer, number, width) of each row whose identifier is complete.

    Rows with a null or empty ``record_id`` or ``content_sha256`` have no identity: they are no copies of anything
    and left out here (``exactly_once`` keeps them).  A ``source_ref.uri`` that doesn't parse leaves ``producer`` and
    ``number`` null: such malformed identifiers are resolved by keyed lookup alone.  ``delivery`` gives the widths;
    without it every message is one number wide.
    """
    uri = F.col("source_ref.uri")
    keyed = envelope.where("record_id <> '' and content_sha256 <> '' and seq_no is not null").select(
        F.col("seq_no").cast("bigint").alias("seq_no"),
        F.col("record_id").alias("record"),
        F.lower("content_sha256").alias("content"),
        F.when(uri.rlike(PRODUCER_SEQUENCE), F.regexp_extract(uri, PRODUCER_SEQUENCE, 1)).alias("producer"),
        F.when(uri.rlike(PRODUCER_SEQUENCE), F.regexp_extract(uri, PRODUCER_SEQUENCE, 2).cast("bigint")).alias("number"),
    )
    if delivery is None:
        return keyed.withColumn("width", F.lit(1).cast("bigint"))
    widths = delivery.where("seq_no is not null").groupBy(F.col("seq_no").cast("bigint").alias("seq_no")).agg(F.greatest(F.max(F.col("raw_bytes").cast("bigint")), F.lit(1)).alias("_w"))
    return keyed.join(widths, "seq_no", "left").withColumn("width", F.coalesce("_w", F.lit(1))).drop("_w")


def _differs(column: pa.Array, last: str | None) -> np.ndarray:
    """Whether each string differs from the one before it; ``last`` stands before the first, None being like anything."""
    previous = pa.concat_arrays([pa.array([column[0].as_py() if last is None else last], column.type), column.slice(0, len(column) - 1)])
    return pc.not_equal(column, previous).to_numpy(zero_copy_only=False)


class Ledger:
    """Seen ranges of producers whose messages come sorted by (producer, number). Malformed identifiers have the number
    -1 and no range. Between batches the last row and the open range are kept."""

    def __init__(self) -> None:
        self.last: tuple[str | None, int, str | None, str | None] = (None, -1, None, None)
        self.head = self.hi = -1
        self.run = 0
        self.open: list | None = None  # producer, lo, hi, whether the partition's first producer

    def sweep(self, producer: pa.Array, number: np.ndarray, record: pa.Array, content: pa.Array, seq_no: np.ndarray, width: np.ndarray):
        """((verdict, head, is a head, opens) of each row of a batch, ranges that ended before its last)."""
        n, start = len(seq_no), self.last[0] is None
        other = _differs(producer, self.last[0])
        fresh = other | (number != np.append(self.last[1], number[:-1])) | _differs(record, self.last[2]) | _differs(content, self.last[3])
        fresh[0] |= start
        at = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        head = np.where(at >= 0, seq_no[at], self.head)

        # How far the producer had been seen before each row: the greatest end of its earlier rows.
        run = np.cumsum(other) + self.run
        upto = pd.Series(number + width).groupby(run).cummax().to_numpy(copy=True)
        upto[run == self.run] = np.maximum(upto[run == self.run], self.hi)
        reach = np.append(self.hi, upto[:-1])
        reach[other] = -1
        known, opens = number >= 0, (run == 0) & (number >= 0)
        verdict = np.where(~known, MALFORMED, np.where(number < reach, COVERED, ACCEPTED)).astype(np.int32)

        # A range begins at a producer's first row and wherever a gap lies before a number.
        ended: list[list] = []
        starts = np.flatnonzero(known & (number > reach))
        edges = np.append(starts, n)
        if self.open is not None and edges[0] > 0 and not other[: edges[0]].any():
            self.open[2] = int(upto[edges[0] - 1])
        for a, b, name in zip(edges[:-1].tolist(), edges[1:].tolist(), producer.take(pa.array(starts)).to_pylist()):
            if self.open is not None:
                ended.append(self.open)
            self.open = [name, int(number[a]), int(upto[b - 1]), bool(opens[a])]
        self.last = (producer[n - 1].as_py(), int(number[-1]), record[n - 1].as_py(), content[n - 1].as_py())
        self.head, self.hi, self.run = int(head[-1]), int(upto[-1]) if known[-1] else -1, int(run[-1])
        return (verdict, head, fresh, opens), ended


def _messages(part: int, seq_no, head, verdict, opens, number, record, content) -> pa.RecordBatch:
    n = len(seq_no)
    none = lambda t: pa.nulls(n, t)
    columns = [pa.array(["message"] * n), pa.array(np.full(n, part, np.int32)), pa.array(opens), none(pa.bool_()), pa.array(seq_no), pa.array(head), pa.array(verdict), pa.array(number), record, content, none(pa.string()), none(pa.int64()), none(pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _ranges(part: int, ranges: list[list], closes: bool) -> pa.RecordBatch:
    n = len(ranges)
    columns = {"kind": ["range"] * n, "part": [part] * n, "opens": [r[3] for r in ranges], "closes": [closes] * n, "producer": [r[0] for r in ranges], "range_lo": [r[1] for r in ranges], "range_hi": [r[2] for r in ranges]}
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in _ARROW], schema=_ARROW)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ledger, part = Ledger(), TaskContext.get().partitionId()
    for batch in batches:
        if not batch.num_rows:
            continue
        producer, record, content = (batch.column(k) for k in ("producer", "record", "content"))
        number, seq_no, width = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("number", "seq_no", "width"))
        (verdict, head, fresh, opens), ended = ledger.sweep(producer, number, record, content, seq_no, width)
        mask = pa.array(fresh)  # keys are kept of heads only
        yield _messages(part, seq_no, head, verdict, opens, number, *(pc.if_else(mask, c, pa.scalar(None, c.type)) for c in (record, content)))
        if ended:
            yield _ranges(part, ended, False)
    if ledger.open is not None:
        yield _ranges(part, [ledger.open], True)


def swept(messages: DataFrame) -> DataFrame:
    """The ledger, written once: a row a message with its verdict and its run's head, a row a range of a partition."""
    order = ["producer", "number", "record", "content", "seq_no"]
    rows = messages.select(F.coalesce("producer", F.lit("")).alias("producer"), F.when(F.col("producer").isNull(), -1).otherwise(F.coalesce("number", F.lit(-1))).alias("number"), "record", "content", "seq_no", "width")
    return materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep, SWEPT), "delivery-ledger")


def _edges(ledger: DataFrame) -> DataFrame:
    """(part, reach): how far earlier partitions had seen the producer a partition begins with; two numbers a partition."""
    edge = ledger.where("kind = 'range' and (opens or closes)")
    opening = edge.where("opens").groupBy("part", "producer").agg(F.lit(0).alias("last"), F.lit(None).cast("bigint").alias("hi"))
    closing = edge.where("closes").select("part", "producer", F.lit(1).alias("last"), F.col("range_hi").alias("hi"))
    # At most two rows a partition of the ledger, so any window over them is bounded by the number of partitions.
    earlier = Window.partitionBy("producer").orderBy("part", "last").rowsBetween(Window.unboundedPreceding, -1)
    return opening.unionByName(closing).withColumn("reach", F.max("hi").over(earlier)).where("last = 0 and reach is not null").select("part", "reach")


def verdicts(ledger: DataFrame) -> DataFrame:
    """(seq_no, head, verdict, record, content) of each message, partitions having learnt of earlier ones' ranges."""
    reach = F.broadcast(_edges(ledger))  # two numbers a partition
    late = F.col("opens") & (F.col("number") < F.col("reach")) & (F.col("verdict") == ACCEPTED)
    rows = ledger.where("kind = 'message'").join(reach, "part", "left")
    return rows.select("seq_no", "head", F.when(late, COVERED).otherwise(F.col("verdict")).alias("verdict"), "record", "content")


def copies(messages: DataFrame, confirm: bool = True) -> DataFrame:
    """(kept_seq_no, dup_seq_no): each surplus row and the row that is kept for it, the smallest ``seq_no``.

    Nulls and empty identifiers never get here; ties can't occur, as ``seq_no`` orders copies (rows that repeat a
    ``seq_no`` whole give the pair of equal numbers); an empty table gives no row.
    """
    rows = verdicts(swept(messages))
    heads = rows.where("record is not null")
    accepted = heads.where(F.col("verdict") == ACCEPTED).select("record", "content", F.col("seq_no").alias("head"))
    asking = heads.where(F.col("verdict") != ACCEPTED).select("record", "content", F.col("seq_no").alias("head"))
    if confirm:
        digest = F.xxhash64("record", "content")
        twice = accepted.groupBy(digest.alias("_d")).agg(F.count("*").alias("_n")).where("_n > 1").select("_d")
        asking = asking.unionByName(accepted.withColumn("_d", digest).join(twice, "_d", "left_semi").drop("_d"))
    # A hot message asks once a partition, and these are aggregated before their shuffle.
    first_asked = asking.groupBy("record", "content").agg(F.min("head").alias("asked"))
    met = accepted.join(first_asked, ["record", "content"])
    answers = first_asked.join(met.groupBy("record", "content").agg(F.min("head").alias("known")), ["record", "content"], "left").select("record", "content", F.least("asked", "known").alias("kept"))
    # Heads that turned out not to be the first of their message, among those that asked and those they met.
    moved = asking.unionByName(met.select("record", "content", "head")).distinct().join(answers, ["record", "content"]).where("head <> kept").select("head", "kept")
    repeats = rows.where("record is null").select("head", "seq_no")
    return (
        repeats.join(moved, "head", "left")
        .select(F.coalesce("kept", "head").alias("kept_seq_no"), F.col("seq_no").alias("dup_seq_no"))
        .unionAll(moved.select(F.col("kept").alias("kept_seq_no"), F.col("head").alias("dup_seq_no")))
    )


def exactly_once(envelope: DataFrame, delivery: DataFrame | None = None) -> DataFrame:
    """``envelope`` without its surplus rows. Rows without identity are kept, as nothing proves them copies; of rows that
    repeat a ``seq_no`` whole one is kept."""
    surplus = copies(identified(envelope, delivery)).groupBy(F.col("dup_seq_no").alias("_dup")).agg((F.min("kept_seq_no") == F.col("dup_seq_no")).alias("_again"))
    marked = envelope.join(surplus, envelope["seq_no"] == surplus["_dup"], "left")
    once = marked.where("_dup is null").drop("_dup", "_again")
    return once.unionByName(marked.where("_again").dropDuplicates(["_dup"]).drop("_dup", "_again"))


def seen_ranges(messages: DataFrame) -> DataFrame:
    """(producer, range_lo, range_hi): the disjoint ranges seen of each producer.

    Ranges are final but for those at the edges of the ledger's partitions: the last of each, and what begins within the
    reach of an earlier partition. Only these, a few a partition, are merged in a window.
    """
    ledger = swept(messages)
    ranges = ledger.where("kind = 'range'").join(F.broadcast(_edges(ledger)), "part", "left")  # two numbers a partition
    at_edge = F.col("closes") | F.coalesce(F.col("opens") & (F.col("range_lo") <= F.col("reach")), F.lit(False))
    columns = ["producer", "range_lo", "range_hi"]
    order = Window.partitionBy("producer").orderBy("range_lo", "part")
    reach = F.max("range_hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    edge = ranges.where(at_edge).select(*columns, "part").withColumn("_reach", reach)
    island = F.sum(F.when(F.col("range_lo") <= F.col("_reach"), 0).otherwise(1)).over(order)
    joined = edge.withColumn("_island", island).groupBy("producer", "_island").agg(F.min("range_lo").alias("range_lo"), F.max("range_hi").alias("range_hi"))
    return ranges.where(~at_edge).select(*columns).unionByName(joined.select(*columns))
