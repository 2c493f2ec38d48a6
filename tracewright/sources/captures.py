"""Sampling, bounding, replaying and disturbing captured lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tracewright.functions.ordering import numbered
from tracewright.functions.text import canonical_text, matches_suffix


def sampled(path: Column, fraction: float) -> Column:
    """A deterministic sample of files by the hash of their path."""
    return F.conv(F.substring(F.sha2(path, 256), 1, 16), 16, 10).cast("decimal(20,0)") % 100000 < F.lit(round(fraction * 100000))


def selected_files(lines: DataFrame, patterns: list[str], excluded: str | None = None) -> DataFrame:
    """Distinct paths that match a suffix pattern and have no excluded part, in string order."""
    files = lines.select("rel_path").distinct().where(matches_suffix(F.col("rel_path"), patterns))
    if excluded:
        files = files.where(~F.array_contains(F.split("rel_path", "/"), excluded))
    return files.orderBy("rel_path")


def first_lines(lines: DataFrame, per_file: int, scan: int, total: int | None = None) -> DataFrame:
    """At most ``per_file`` usable rows out of the first ``scan`` lines of each file, ``total`` rows overall.

    A sampling operator: the limits are the feature. Ranks within files become group limits ahead of the shuffle."""
    w = Window.partitionBy("rel_path").orderBy("byte_offset")
    head = lines.withColumn("line_no", F.row_number().over(w)).where(F.col("line_no") <= scan)
    chosen = head.where("usable").withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= per_file)
    return chosen if total is None else chosen.orderBy("rel_path", "byte_offset").limit(total)


def tail(lines: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last ``n`` lines, then without those that are no JSON object: the limit comes first."""
    return lines.orderBy(*[F.col(c).desc() for c in order]).limit(n).where("get_json_object(raw, '$') like '{%'")


def line_state(size: Column, complete: Column, cap: int) -> Column:
    """What a bounded reader makes of a line: oversize, partial, blank or complete."""
    return F.when(size > cap, "oversize").when(~complete, "partial").when(size <= 1, "blank").otherwise("complete")


def started(lines: DataFrame, offset: int | None = None, first: bool = False, committed: int = 0) -> DataFrame:
    """Lines from a start position: a given offset, the very first, or what is not committed."""
    at = offset if offset is not None else 0 if first else committed
    return lines.where(F.col("byte_offset") >= at)


def started_at(lines: DataFrame, position: str, offset: int | None = None, time=None, committed: int | None = None, place: str = "byte_offset", at: str = "delivered_at", newest: int | None = None) -> DataFrame:
    """Lines from a named start position.

    ``first``: all, whatever was saved. ``new``: after what is committed, or nothing yet there if nothing is. ``last``: from the
    newest line on. ``by_offset``, ``by_timestamp``: from a given place or time on, which must be given. ``newest`` is the
    largest place, where the caller knows it; otherwise it is looked up."""
    if position == "first":
        return lines
    if position == "by_timestamp":
        if time is None:
            raise ValueError("by_timestamp needs a time")
        return lines.where(F.col(at) >= F.lit(time))
    if position == "by_offset":
        if offset is None:
            raise ValueError("by_offset needs an offset")
        return lines.where(F.col(place) >= offset)
    if position == "new" and committed is not None:
        return lines.where(F.col(place) >= committed)
    if position not in ("new", "last"):
        raise ValueError(f"unknown start position: {position}")
    end = newest if newest is not None else lines.agg(F.max(place).alias("m")).first().m
    return lines.where((F.col(place) >= end) if position == "last" else (F.col(place) > end)) if end is not None else lines


@F.pandas_udf(StringType())
def _marked(value: pd.Series, cycle: pd.Series) -> pd.Series:
    import hashlib
    import json

    out = []
    for v, c in zip(value, cycle):
        try:
            body = json.loads(v) if v is not None and c else None
        except ValueError:
            body = None
        if isinstance(body, dict):
            body["loop_cycle"] = int(c)
            text = json.dumps(body, ensure_ascii=False)
            body["content_sha256"] = hashlib.sha256(canonical_text(text, "content_sha256").encode("utf-8", "surrogatepass")).hexdigest()
            v = canonical_text(json.dumps(body, ensure_ascii=False))
        out.append(v)
    return pd.Series(out)


def resume_point(state: dict, lines: int, start_position: str = "new", start_offset: int | None = None, loop: bool = False) -> dict:
    """{committed, cycle, cursor}: where a replayed file goes on. ``first`` passes over what was saved; a given offset wins over
    the saved one; nothing lies beyond the end. Without a loop the cursor is what was committed."""
    committed, cycle, cursor = 0, 0, None
    if start_position != "first":
        committed = int(state.get("committed", 0))
        if loop:
            cycle, cursor = int(state.get("cycle", 0)), state.get("cursor")
        if start_offset is not None:
            committed, cursor = start_offset, start_offset
    committed = min(committed, lines)
    return {"committed": committed, "cycle": cycle, "cursor": min(committed if cursor is None or not loop else int(cursor), lines)}


def mock_batch(lines: DataFrame, total: int, point: dict, most: int, loop: bool = False, max_cycles: int = 0) -> tuple[DataFrame, dict]:
    """(deliveries, the point after them): the next ``most`` lines (place, value) of a file of ``total`` lines from a point on.

    A loop begins anew at the end, until ``max_cycles`` (0: for ever); from the second cycle on lines carry their cycle.
    Deliveries have (offset, cycle, id, value); ids are made of place and content, so they stay the same on redelivery.
    Commit the point once the batch is durable: until then it is delivered again."""
    cycle, cursor, left, spans = point["cycle"], point["cursor"], most, []
    while left and total:
        if cursor >= total:
            if not loop or max_cycles and cycle + 1 >= max_cycles:
                break
            cycle, cursor = cycle + 1, 0
        n = min(left, total - cursor)
        spans.append((cycle, cursor, cursor + n))
        cursor, left = cursor + n, left - n
    wanted = lines.sparkSession.createDataFrame(spans, "cycle int, lo bigint, hi bigint")  # one row a cycle that is touched
    rows = lines.join(F.broadcast(wanted), (F.col("place") >= F.col("lo")) & (F.col("place") < F.col("hi"))).select("place", "value", "cycle")
    sent = rows.withColumn("value", _marked("value", "cycle"))
    ident = F.concat(F.lit("mock-"), F.col("place").cast("string"), F.lit("-"), F.substring(F.sha2("value", 256), 1, 12))
    return sent.select(F.col("place").alias("offset"), "cycle", ident.alias("id"), "value"), {"committed": point["committed"], "cycle": cycle, "cursor": cursor}


def path_order(files: DataFrame, path: str = "rel_path") -> DataFrame:
    """Paths with their place in string order, counted over range partitions."""
    return numbered(files.withColumn("_all", F.lit(0)), ["_all"], [path], "place").drop("_all")


def sampled_lines(lines: DataFrame, share: float, group: str = "rel_path", place: str = "byte_offset") -> DataFrame:
    """A share of each group's lines, at least one, by the rank of a hash of their place: the same whatever the partitions."""
    h = F.sha2(F.concat(group, F.lit("#"), F.col(place).cast("string")), 256)
    ranked = numbered(lines.select(group, place).distinct().withColumn("_h", h), [group], ["_h"], "_k")
    sizes = lines.select(group, place).distinct().groupBy(group).agg(F.count("*").alias("_n"))
    return ranked.join(sizes, group).where(F.col("_k") <= F.ceil(F.col("_n") * share)).select(group, place)


def both_empty(*sides: Column) -> Column:
    """Whether nothing but white space stands on any side."""
    out = F.lit(True)
    for c in sides:
        out = out & (F.coalesce(F.trim(c), F.lit("")) == "")
    return out


def merged(**streams: DataFrame) -> DataFrame:
    """Several streams of one form as one, each row with its ``origin``."""
    parts = [frame.withColumn("origin", F.lit(name)) for name, frame in streams.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def looped(lines: DataFrame, cycles: int) -> DataFrame:
    """The lines replayed ``cycles`` times; from the second on each carries ``loop_cycle`` and a new content hash, so its
    key differs. Lines are multiplied in place by an array of cycles."""
    rows = lines.withColumn("cycle", F.explode(F.sequence(F.lit(0), F.lit(cycles - 1))))
    return rows.withColumn("value", _marked("value", "cycle"))


def disturbed(lines: DataFrame, order: list[str], duplicate_every: int = 0, poison_every: int = 0, oversize_every: int = 0, size: int = 1 << 20) -> DataFrame:
    """Every n-th line (from 1, by order) doubled, broken or blown up; oversize wins over poison.

    Lines are numbered within their file, so files are disturbed in parallel."""
    n = F.col("_n")
    every = lambda k: (n % k == 0) if k else F.lit(False)
    rows = numbered(lines, ["rel_path"], order, "_n")
    raw = F.when(every(oversize_every), F.rpad("raw", size, "x")).when(every(poison_every), F.lit('{"envelope_version": 1, "record_id":')).otherwise(F.col("raw"))
    rows = rows.withColumn("raw", raw).withColumn("_copies", F.when(every(duplicate_every), 2).otherwise(1))
    return rows.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_n", "_copies")


def interleaved(lines: DataFrame, batch: int) -> DataFrame:
    """The order in which saturated batches take turns over files: round, then file, then place."""
    return numbered(lines, ["rel_path"], ["byte_offset"], "_place").withColumn("round", F.floor((F.col("_place") - 1) / batch)).drop("_place")


def generated(spark, rows: int, seed: int = 1) -> DataFrame:
    """Seeded synthetic pairs from a small grammar, each picked by the hash of its number: any partitioning gives the same rows."""
    pick = lambda words, salt: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(len(words))) + 1).cast("int"))
    task = pick(["coding", "search", "summary", "extraction"], 1)
    stack = pick(["Python", "Rust", "SQL", "Go", "TypeScript"], 2)
    verb = pick(["write", "explain", "repair", "shorten"], 3)
    return spark.range(rows).select(
        "id", task.alias("expected_task"), stack.alias("expected_stack"),
        F.concat(verb, F.lit(" a "), stack, F.lit(" program for "), task).alias("request"),
        F.concat(F.lit("Here is a "), stack, F.lit(" answer to the "), task, F.lit(" request.")).alias("response"),
        F.lit(True).alias("synthetic"),
    )
