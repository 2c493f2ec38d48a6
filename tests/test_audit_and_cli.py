import json

from pyspark.sql import functions as F

from tracewright import __main__ as cli
from tracewright.operators import audit
from tracewright.sources import sinks


def test_secret_lines(spark):
    df = spark.createDataFrame([(1, 'x\napi_key = "abcdefghijklmnop"\ntoken = "${FROM_ENVIRONMENT}"\n'), (2, "Bearer abcdefghijklmnopqrstuvwx"), (3, None), (4, 'password: "changeme-changeme"')], "k int, t string")
    assert sorted(map(tuple, audit.secret_lines(df, "k", "t").collect())) == [(1, 2, "assignment", "high"), (2, 1, "bearer_token", "high"), (4, 1, "assignment", "low")]


def test_gates_checklists_and_status(spark):
    r = audit.gate(spark.createDataFrame([("a", True), ("b", None), ("c", False)], "name string, ok boolean")).first()
    assert (r.passed, r.failed) == (False, "b,c")
    lines = spark.createDataFrame([("- [x] a",), ("* [ ] b",), ("- c",), (None,)], "l string")
    assert [x.m for x in lines.select(audit.checklist(F.col("l")).alias("m")).collect()] == ["x", " ", None, None]
    docs = spark.createDataFrame([('{"schema_version": 1, "updated_at_unix_ms": 5, "new": 1}',), ('{"schema_version": 2, "updated_at_unix_ms": 5}',), ("{",), (None,)], "s string")
    assert [x.u for x in docs.select(audit.status_document(F.col("s"))["updated_at_unix_ms"].alias("u")).collect()] == [5, None, None, None]


def test_sinks(spark, tmp_path):
    out = str(tmp_path)
    df = spark.createDataFrame([(1, "r1", None), (2, "r2", "x")], "batch int, key string, reason string")
    sinks.json_lines(df, f"{out}/j")
    assert '"reason":null' in "".join(r.value for r in spark.read.text(f"{out}/j").collect())
    for _ in range(2):
        sinks.accepted(df, f"{out}/a", "key", "batch")
    sinks.accepted(spark.createDataFrame([(3, "r1", None), (3, "r3", None)], df.schema), f"{out}/a", "key", "batch")
    assert sorted((r.batch, r.key) for r in spark.read.parquet(f"{out}/a").collect()) == [(1, "r1"), (2, "r2"), (3, "r3")]
    sinks.review(df, f"{out}/r", "x")
    assert [json.loads(r.value)["key"] for r in spark.read.text(f"{out}/r").collect()] == ["r2"]
    sinks.spool(df, f"{out}/s", "key")
    assert sorted(r.value for r in spark.read.text(f"{out}/s").collect()) == ["r1", "r2"]


def test_command_line(tmp_path, capsys):
    good, bad = tmp_path / "g.json", tmp_path / "b.json"
    good.write_text('{"sources": [{"name": "a", "kind": "text", "location": "x"}]}')
    bad.write_text("[1]")
    assert cli.main(["validate", str(good)]) == 0 and capsys.readouterr().out.startswith("ok ")
    assert cli.main(["validate", str(bad)]) == 2 and cli.main(["validate", "nowhere"]) == 2 and cli.main(["nonsense"]) == 2
    assert cli.main(["list"]) == 0 and "p5_found" in capsys.readouterr().out


def test_contracts(spark):
    from tracewright.sources.contract import Contract, Field, StreamConfig, cached_labels, unanswered

    good = Contract("c", 1, ("tool",), (Field("n", "int", True),), {"task": ("a", "b")}, ("uses",))
    assert good.problems() == [] and [f.dataType.simpleString() for f in good.struct()] == ["array<struct<text:string,start:int,end:int,confidence:double>>", "bigint", "map<string,double>", "array<struct<head:string,tail:string>>"]
    assert good.digest() == Contract("c", 1, ("tool",), (Field("n", "int", True),), {"task": ("a", "b")}, ("uses",)).digest() != Contract("c", 2).digest()
    assert len(Contract("", 1, ("x", "x"), (Field("f", "date"),), {"t": ()}).problems()) == 4
    stream = StreamConfig("p", models=(("m", ("n", "m")), ("o", ())))
    assert stream.problems() == [] and stream.allowed_models() == ["m", "n", "o"] and stream.options()["patterns"] == "*.ndjson"
    assert len(StreamConfig("", ("a*b",), 1, secrets={"k": "plain"}).problems()) == 4
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, text string")
    asked = cached_labels(docs, spark.createDataFrame([], "request_sha256 string, output string"), good.digest())
    assert unanswered(asked).count() == 2
    cache = unanswered(asked).where("text = 'b'").selectExpr("request_sha256", "'x' as output")
    assert sorted((r.k, r.output) for r in cached_labels(docs, cache, good.digest()).collect()) == [(1, None), (2, "x"), (3, "x")]


def test_written_tables_are_released(spark):
    from tracewright.functions.shared import materialise, release

    release(spark)
    df = materialise(spark.range(5), "released")
    assert df.count() == 5 and release(spark) == 1 and release(spark) == 0
