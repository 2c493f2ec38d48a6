import random

import pytest

from tracewright.operators import delivery_dedup as op

SCHEMA = "seq_no bigint, record_id string, content_sha256 string, source_ref struct<uri:string>, covered string, head string"


def brute(rows):
    first, out = {}, []
    for seq, record, content, *_ in sorted(r for r in rows if r[0] is not None):
        if record and content:
            key = (record, content.lower())
            if key in first:
                out.append((first[key], seq))
            else:
                first[key] = seq
    return sorted(out)


def got(spark, rows, partitions=None, delivery=None):
    df = spark.createDataFrame([(s, r, c, (u,) if u is not Ellipsis else None, "x", None) for s, r, c, u in rows], SCHEMA)
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return sorted(map(tuple, op.copies(op.identified(df, delivery)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for seq in range(400):
        n = rng.randrange(12)
        uri = rng.choice([f"x://file-{n % 3}#{n * 10}", f"x://file-{n % 3}#{n * 10}", "broken", "x://file#", None, ...])
        rows.append((seq, rng.choice([f"r{n}", f"r{n}", "", None]), rng.choice([f"a{n % 4}", f"A{n % 4}", "", None]), uri))
    rng.shuffle(rows)
    assert got(spark, rows, 7) == brute(rows)


def test_one_message_is_a_third_of_all_rows_and_spans_partitions(spark):
    rows = [(s, "hot", "aa", "x://f#10") for s in range(500)] + [(1000 + s, f"r{s}", "bb", f"x://f#{20 + s}") for s in range(900)]
    assert got(spark, rows, 9) == brute(rows)


def test_same_message_under_several_producers_and_a_malformed_name(spark):
    rows = [(5, "r", "aa", "x://f#1"), (3, "r", "AA", "x://g#9"), (4, "r", "aa", "nonsense"), (6, "r", "bb", "x://f#1")]
    assert got(spark, rows) == [(3, 4), (3, 5)]


def test_empty_table_and_rows_without_identity(spark):
    assert got(spark, []) == []
    rows = [(1, None, "aa", "x://f#1"), (2, "", "aa", "x://f#1"), (3, "r", None, "x://f#1"), (4, "r", "", "x://f#1")]
    assert got(spark, rows) == []
    df = spark.createDataFrame([(s, r, c, (u,), "x", None) for s, r, c, u in rows], SCHEMA)
    assert op.exactly_once(df).count() == 4


def ledger(spark, rows, widths=None, partitions=None):
    """({seq_no: verdict}, ranges) of (seq_no, number) messages of one producer, each with its own key."""
    df = spark.createDataFrame([(s, f"r{n}", "x", "f", n, w) for (s, n), w in zip(rows, widths or [1] * len(rows))], "seq_no bigint, record string, content string, producer string, number bigint, width bigint")
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return {r.seq_no: r.verdict for r in op.verdicts(op.swept(df)).collect()}, sorted((r.range_lo, r.range_hi) for r in op.seen_ranges(df).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed,partitions", [(0, None), (1, 5), (2, 13), (3, 30)])
def test_ledger_against_brute_force(spark, seed, partitions):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(400) * 5) for i in range(300)]
    widths = [rng.choice([1, 5, 5, 5, 12, 300 if seed == 3 else 7]) for _ in rows]
    got, ranges = ledger(spark, rows, widths, partitions)
    reach, expected, merged = -1, {}, []
    for (seq, number), width in sorted(zip(rows, widths), key=lambda r: (r[0][1], r[0][0])):
        expected[seq] = op.COVERED if number < reach else op.ACCEPTED
        if number > reach:
            merged.append([number, number + width])
        reach = max(reach, number + width)
        merged[-1][1] = reach
    assert got == expected and ranges == [tuple(m) for m in merged]


def test_the_ranges_decide(spark):
    """Without the last check the result follows the ledger alone: wrong widths or numbers change what is accepted."""
    rows = [(s, s * 10) for s in range(50)]
    assert set(ledger(spark, rows, [10] * 50)[0].values()) == {op.ACCEPTED}
    wide = ledger(spark, rows, [25] * 50)[0]
    assert sum(v == op.COVERED for v in wide.values()) == 49
    df = spark.createDataFrame([(5, "r", "aa", "f", 1, 1), (7, "r", "aa", "f", 90, 1), (6, "s", "bb", "f", 1, 1)], "seq_no bigint, record string, content string, producer string, number bigint, width bigint")
    assert op.copies(df, confirm=False).collect() == []  # the sequence says that 1 and 90 are two messages
    assert [tuple(r) for r in op.copies(df).collect()] == [(5, 7)]
    covered = df.withColumn("width", df.width * 0 + 100)
    assert [tuple(r) for r in op.copies(covered, confirm=False).collect()] == [(5, 7)]


def test_rows_that_repeat_a_seq_no_whole(spark):
    rows = [(1, "r", "aa", "x://f#1"), (1, "r", "aa", "x://f#1"), (2, "r", "aa", "x://f#1"), (3, "q", "aa", "x://f#2")]
    assert got(spark, rows) == [(1, 1), (1, 2)]
    df = spark.createDataFrame([(s, r, c, (u,), "x", None) for s, r, c, u in rows], SCHEMA)
    assert sorted(r.seq_no for r in op.exactly_once(df).collect()) == [1, 3]


def test_ranges_merge_across_neighbours(spark):
    rows = [(1, "a", "x", "p://f#0"), (2, "b", "x", "p://f#10"), (3, "c", "x", "p://f#30"), (4, "a", "x", "p://f#0")]
    df = spark.createDataFrame([(s, r, c, (u,), "x", None) for s, r, c, u in rows], SCHEMA)
    widths = spark.createDataFrame([(1, 10), (2, 10), (3, 5), (4, 10)], "seq_no bigint, raw_bytes bigint")
    assert sorted(map(tuple, op.seen_ranges(op.identified(df, widths)).select("producer", "range_lo", "range_hi").collect())) == [("f", 0, 20), ("f", 30, 35)]
