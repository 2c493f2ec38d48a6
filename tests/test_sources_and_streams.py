import json
import os

from tracewright.sources import captures, counters, documents
from tracewright.sources.spool import SpoolSource, adapter
from tracewright.streaming import ingest

import pytest


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as f:
        f.write(data)


def run(spark, root, out):
    frame = spark.readStream.format("spool").option("path", root).option("max_bytes", "4096").load()
    q = frame.writeStream.format("parquet").option("path", f"{out}/t").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted((r.rel_path, r.byte_offset, r.raw, r.line_state) for r in spark.read.schema("rel_path string, byte_offset bigint, raw string, bytes bigint, line_state string").parquet(f"{out}/t").collect())


def test_spool_tail(spark, tmp_path):
    spark.dataSource.register(SpoolSource)
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(f"{root}/a.ndjson", b'{"n":1}\n{"n":2}\n')
    write(f"{root}/d/b.ndjson", b'{"n":3}\n\n{"n":')
    write(f"{root}/c.txt", b"no\n")
    first = [("a.ndjson", 0, '{"n":1}', "complete"), ("a.ndjson", 8, '{"n":2}', "complete"), ("d/b.ndjson", 0, '{"n":3}', "complete")]
    assert run(spark, root, out) == first
    write(f"{root}/d/b.ndjson", b'4}\n{"x":"' + b"y" * 9000 + b'"}\n{"n":5}\n')
    second = run(spark, root, out)
    assert second[:3] == first and second[3:] == [("d/b.ndjson", 9, '{"n":4}', "complete"), ("d/b.ndjson", 17, None, "oversize"), ("d/b.ndjson", 17 + 9009, '{"n":5}', "complete")]
    assert spark.read.format("spool").option("path", root).load().count() == 6
    with pytest.raises(ValueError):
        adapter("iggy")


def envelope(n, **more):
    import hashlib

    from tracewright.functions.text import canonical_text

    e = {"envelope_version": 1, "record_id": f"r{n}", "schema": {"id": "s", "version": 1, "digest": "a" * 64}, "kind": "raw_document", "source": {"uri": "u", "content_sha256": "b" * 64, "retrieved_at": "t"}, "document": {"text": "x"}, **more}
    e["content_sha256"] = hashlib.sha256(canonical_text(json.dumps(e)).encode()).hexdigest()
    return json.dumps(e)


def test_ingestion_is_idempotent(spark, tmp_path):
    lines = [envelope(1), '{"envelope_version": 1, "record_id":', envelope(9, schema={"id": "t", "version": 1, "digest": "a" * 64}), envelope(2), envelope(1)]
    df = spark.createDataFrame([("f", i, raw) for i, raw in enumerate(lines)], "rel_path string, byte_offset bigint, raw string")
    root, rules = str(tmp_path), {"schema": ("s", 1, "a" * 64)}
    for _ in range(2):  # a batch that is run again changes nothing
        ingest.handle(df, 0, root, **rules)
    ingest.handle(df, 1, root, **rules)  # delivered again later
    assert sorted(r.record_id for r in ingest.read_accepted(spark, root).collect()) == ["r1", "r2"]
    read = lambda t: spark.read.schema("reason string, batch_id bigint").parquet(f"{root}/{t}").where("batch_id = 0").collect()
    assert [r.reason for r in read("dlq")] == ["envelope_not_json"] and [r.reason for r in read("quarantine")] == ["schema_digest_mismatch"]
    assert spark.read.schema("batch_id bigint").parquet(f"{root}/duplicates").count() == 4


def test_replay_marks_cycles(spark):
    rows = captures.looped(spark.createDataFrame([(1, envelope(1)), (2, "broken")], "n int, value string"), 3).orderBy("n", "cycle").collect()
    bodies = [json.loads(r.value) for r in rows[:3]]
    assert [b.get("loop_cycle") for b in bodies] == [None, 1, 2] and len({b["content_sha256"] for b in bodies}) == 3 and rows[4].value == "broken"


def test_faults(spark):
    df = spark.createDataFrame([("f", i, f"line{i}") for i in range(1, 7)], "rel_path string, byte_offset bigint, raw string")
    rows = [(r.byte_offset, r.raw[:6], r.copy_no) for r in captures.disturbed(df, ["byte_offset"], 3, 2, 4, 50).orderBy("byte_offset", "copy_no").collect()]
    assert rows == [(1, "line1", 1), (2, '{"enve', 1), (3, "line3", 1), (3, "line3", 2), (4, "line4x", 1), (5, "line5", 1), (6, '{"enve', 1), (6, '{"enve', 2)]


def test_document_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one"}\n\n{"input": "two"}\n{"other": 3}\n{"text": "late"}\n')
    (tmp_path / "b.txt").write_text("whole\nfile")
    (tmp_path / "c.xml").write_text("<rss><item><title>T</title><description>D</description><link>http://x</link></item><item><title></title></item></rss>")
    configs = [documents.SourceConfig("j", "jsonl", str(tmp_path / "a.jsonl"), max_documents=4), documents.SourceConfig("t", "text", str(tmp_path / "b.txt")), documents.SourceConfig("r", "rss", str(tmp_path / "c.xml")), documents.SourceConfig("off", "text", "nowhere", enabled=False)]
    rows = [(r.source_no, r.text, r.uri.rsplit("#", 1)[-1]) for r in documents.documents(spark, configs).orderBy("source_no", "uri").collect()]
    assert rows[:3] == [(0, "one", "L1"), (0, "two", "L3"), (0, '{"other": 3}', "L4")] and rows[3][1] == "whole\nfile" and rows[4][1:] == ("T\nD", "http://x") and len(rows) == 5
    assert documents.check_sources([documents.SourceConfig("j", "nope", "x", max_documents=0)] * 2) and not documents.check_sources(configs)
    path = str(tmp_path / "state.json")
    documents.write_state(path, {"a": 1})
    assert documents.read_state(path, {}) == {"a": 1} and documents.read_state(path + "x", {"d": 0}) == {"d": 0}


def test_counters(spark):
    stat = spark.createDataFrame([("cpu  10 0 10 70 10 0\ncpu0 1 1 1 1\nintr 5\n",)], "value string")
    assert [tuple(r) for r in counters.cpu_totals(stat).collect()] == [("cpu", 100, 80), ("cpu0", 4, 1)]
    assert counters.memory_kib(spark.createDataFrame([("MemTotal:  16 kB\nbad\n",)], "value string")).collect() == [("MemTotal", 16)]
    df = spark.createDataFrame([("0.5 1.5 2.5 1/2 3", "42 (a b) c) S 1 2 3 4 5 6 7 8 9 10 11 12 13")], "l string, p string")
    r = df.select(counters.load_average(df.l).alias("l"), counters.process_stat(df.p).alias("p")).first()
    assert r.l.five == 1.5 and (r.p.pid, r.p.name, r.p.state, r.p.utime, r.p.stime) == (42, "a b) c", "S", 11, 12)
    gpu = spark.createDataFrame([("0, RTX, 5 %, 100 MiB, 200 MiB\n1, RTX, [N/A], 1, 2\nshort\n",)], "value string")
    assert [tuple(x) for x in counters.accelerator_rows(gpu).collect()] == [(0, "RTX", 5.0, 100.0, 200.0), (1, "RTX", None, 1.0, 2.0)]


def spool_lines(spark, root, **options):
    reader = spark.read.format("spool").option("path", root)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return sorted((r.rel_path, r.byte_offset, r.raw) for r in reader.load().collect())


@pytest.mark.parametrize("split", [1, 7, 64, 1000])
def test_files_are_split_without_losing_lines(spark, tmp_path, split):
    spark.dataSource.register(SpoolSource)
    data = b"".join(b"x" * n + b"\n" for n in (1, 5, 0, 30, 2, 100, 7, 1)) + b"tail"
    write(f"{tmp_path}/a.ndjson", data)
    write(f"{tmp_path}/_hidden/b.ndjson", b"no\n")
    assert spool_lines(spark, str(tmp_path), split_bytes=split, excluded="_hidden") == spool_lines(spark, str(tmp_path), excluded="_hidden")
    assert len(spool_lines(spark, str(tmp_path), split_bytes=split, excluded="_hidden")) == 7


def test_admission_takes_whole_lines_within_bounds(tmp_path):
    from tracewright.sources.spool import SpoolStreamReader

    write(f"{tmp_path}/in/a.ndjson", b"12345678\n" * 5)
    write(f"{tmp_path}/in/b.ndjson", b"abc\n" * 4)
    reader = SpoolStreamReader({"path": f"{tmp_path}/in", "trigger_bytes": "20", "progress": f"{tmp_path}/progress.json"})
    start, batches = reader.initialOffset(), []
    while (end := reader.latestOffset()) != start:
        lines = [r for p in reader.partitions(start, end) for r in reader.read(p)]
        batches.append((sum(r[3] for r in lines), len(lines)))
        start = end
    assert sum(n for _, n in batches) == 9 and all(size <= 20 for size, _ in batches) and len(batches) >= 4
    # One line that is larger than the bound is still taken, and a reader begun anew goes on from the noted offset.
    write(f"{tmp_path}/in/c.ndjson", b"y" * 100 + b"\n" + b"z\n")
    again = SpoolStreamReader({"path": f"{tmp_path}/in", "trigger_bytes": "20", "progress": f"{tmp_path}/progress.json"})
    end = again.latestOffset()
    assert end["c.ndjson"] == 101 and again.latestOffset()["c.ndjson"] == 103
    by_lines = SpoolStreamReader({"path": f"{tmp_path}/in", "trigger_lines": "3"})
    by_lines.initialOffset()
    assert by_lines.latestOffset() == {"a.ndjson": 27} and by_lines.latestOffset() == {"a.ndjson": 45, "b.ndjson": 4}


def test_replayed_file_resumes(spark):
    lines = spark.createDataFrame([(i, envelope(i)) for i in range(5)], "place bigint, value string")
    point = captures.resume_point({}, 5)
    first, after = captures.mock_batch(lines, 5, point, 3)
    again, _ = captures.mock_batch(lines, 5, point, 3)
    assert sorted(r.id for r in first.collect()) == sorted(r.id for r in again.collect()) and after["cursor"] == 3
    rest, end = captures.mock_batch(lines, 5, captures.resume_point({"committed": 3}, 5), 10)
    assert sorted(r.offset for r in rest.collect()) == [3, 4] and end["cursor"] == 5
    assert captures.mock_batch(lines, 5, end, 10)[0].count() == 0
    looped, p = captures.mock_batch(lines, 5, captures.resume_point({"committed": 4, "cycle": 0, "cursor": 4}, 5, loop=True), 7, loop=True)
    assert sorted((r.cycle, r.offset) for r in looped.collect()) == [(0, 4), *((1, i) for i in range(5)), (2, 0)] and (p["cycle"], p["cursor"]) == (2, 1)
    assert captures.mock_batch(lines, 5, captures.resume_point({}, 5, loop=True), 100, loop=True, max_cycles=2)[0].count() == 10
    assert captures.resume_point({"committed": 4}, 5, "first")["cursor"] == 0 and captures.resume_point({"committed": 1}, 5, start_offset=9)["cursor"] == 5


def test_ingestion_orders_by_arrival_and_has_a_retry_ceiling(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("z", 5, envelope(1)), ("a", 0, envelope(1)), ("b", 0, envelope(2))], "rel_path string, byte_offset bigint, raw string").coalesce(1)
    ingest.handle(df, 0, root)
    kept = {r.record_id: r.rel_path for r in ingest.read_accepted(spark, root).collect()}
    assert kept == {"r1": "z", "r2": "b"}  # the one that came first, not the one whose name sorts first
    late = spark.createDataFrame([("c", 0, envelope(3), 6), ("c", 1, envelope(4), 2), ("c", 2, envelope(1), 9)], "rel_path string, byte_offset bigint, raw string, attempts int")
    ingest.handle(late, 1, root)
    dlq = spark.read.schema("reason string, attempts int, byte_offset bigint, batch_id bigint").parquet(f"{root}/dlq").collect()
    assert [(r.reason, r.attempts, r.byte_offset) for r in dlq] == [("retry_ceiling", 6, 0)]
    for _ in range(6):  # a batch whose runs fail and fail again
        ingest.handle(df.limit(1).selectExpr("rel_path", "byte_offset", "replace(raw, 'r1', 'r7') as raw"), 2, root)
    assert ingest.runs_of(spark, root, 2) == 7
    assert {r.reason for r in spark.read.schema("reason string, batch_id bigint").parquet(f"{root}/dlq").where("batch_id = 2").collect()} == {"retry_ceiling"}
    assert ingest.accepted_before(spark, root, 5).count() == 3 and ingest.accepted_before(spark, root, 5, remember=1).count() == 0


def test_run_bounds(spark, tmp_path):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load()
    query = rate.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="100 milliseconds").start()
    assert ingest.run_until(query, max_records=30, every=0.1) == "records" and not query.isActive
    assert ingest.lag(query)["rows"] == 10
    write(f"{tmp_path}/in/a.ndjson", b"{}\n")
    still = spark.readStream.format("spool").option("path", f"{tmp_path}/in").load().writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/d").trigger(processingTime="100 milliseconds").start()
    assert ingest.run_until(still, idle_seconds=4, every=0.2) == "idle"


def test_journal(spark, tmp_path):
    from tracewright.sources import journal

    j = journal.Journal(f"{tmp_path}/j/one.wal" if os.makedirs(f"{tmp_path}/j") is None else "", bound=100)
    places = [j.append(f"record {i}".encode()) for i in range(5)]
    assert j.room(4) == 0 and j.replay() == [f"record {i}".encode() for i in range(5)]
    j.commit(places[0])
    assert len(j.replay()) == 4 and j.size == places[4]
    j.commit(places[3])
    assert j.replay() == [b"record 4"] and j.size == 12 and j.room(4) == 4
    with pytest.raises(journal.Full):
        j.append(b"x" * 100)
    with open(j.path, "ab") as f:
        f.write(b"\0\0\0\x09torn")
    again = journal.Journal(j.path, bound=100)
    assert again.size == 12 and os.path.getsize(j.path) == 12 and again.replay() == [b"record 4"]
    assert [(r.place, bytes(r.record)) for r in journal.replayed(spark, f"{tmp_path}/j").collect()] == [(0, b"record 4")]
    assert list(journal.frames(b"")) == [] and list(journal.frames(b"\xff\xff\xff\xff")) == []


def test_start_positions(spark):
    import datetime

    day = lambda n: datetime.datetime(2026, 1, n, tzinfo=datetime.UTC)
    lines = spark.createDataFrame([(i * 10, day(i + 1)) for i in range(5)], "byte_offset bigint, delivered_at timestamp")
    at = lambda *a, **k: sorted(r.byte_offset for r in captures.started_at(lines, *a, **k).collect())
    assert at("first", committed=40) == [0, 10, 20, 30, 40] and at("last") == [40] and at("new") == [] and at("new", committed=20) == [20, 30, 40]
    assert at("by_offset", offset=30) == [30, 40] and at("by_timestamp", time=day(4)) == [30, 40]
    assert captures.started_at(lines.where("false"), "last").count() == 0
    for bad in (("by_offset",), ("by_timestamp",), ("middle",)):
        with pytest.raises(ValueError):
            captures.started_at(lines, *bad)


def test_rotation(tmp_path):
    from tracewright.sources import sinks

    path = str(tmp_path / "log")
    assert not sinks.rotate(path, 10)
    write(path, b"".join(b"line %d\n" % i for i in range(20_000)))
    assert not sinks.rotate(path, 1 << 30, 5) and sinks.rotate(path, 1000, 5)
    assert open(path, "rb").read().splitlines() == [b"line %d" % i for i in range(19_995, 20_000)]
    assert sinks.rotate(path, 1) and not os.path.exists(path) and os.path.exists(f"{path}.1")


def test_teacher_is_asked_again_and_must_answer_with_one_object(spark):
    from tracewright.sources import contract

    def ask(text):
        if text == "late" and not os.path.exists(marker):
            open(marker, "w").close()
            raise TimeoutError("busy")
        return {"good": '{"b": 1, "a": "x"}', "late": '{"a": 2}', "list": "[1]", "broken": '{"a": 1} and more', "more": '{"a": 1, "z": 2}'}[text]

    import tempfile

    marker = f"{tempfile.mkdtemp()}/m"
    df = spark.createDataFrame([(t, t) for t in ("good", "late", "list", "broken", "more")], "request_sha256 string, text string")
    rows = {r.request_sha256: r for r in contract.answered(df, ask, wait=0.01, keys=("a", "b")).collect()}
    assert (rows["good"].output, rows["good"].attempts) == ('{"a": "x", "b": 1}', 1) and (rows["late"].output, rows["late"].attempts) == ('{"a": 2}', 2)
    assert all(rows[k].output is None and rows[k].attempts == 3 and rows[k].error for k in ("list", "broken", "more"))
    assert contract.answered(df.where("false"), ask).count() == 0
