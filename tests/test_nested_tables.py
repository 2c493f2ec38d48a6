import json
import sys

import pytest

from tracewright.operators import nested_tables as op

SCHEMA = "rel_path string, byte_offset bigint, raw string, bytes bigint, node_path string, parent_path string"


def rows(spark, lines):
    df = spark.createDataFrame([(f, o, r, 1, "clash", None) for f, o, r in lines], SCHEMA)
    return sorted(((r.rel_path, r.byte_offset, r.node_path, r.parent_path) for r in op.links(df).collect()), key=str)


def walk(value, path="", parent=""):
    """A plain recursion to compare with."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from walk(v, f"{path}.{k}" if path else k, parent)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            here = f"{path}[{i}]"
            if isinstance(v, dict):
                yield here, parent
                yield from walk(v, here, here)
            else:
                yield from walk(v, here, parent)


def test_paths_and_parents(spark):
    body = {"value": {"a": [{"b": [[{"c": [{}]}, 3], None]}, "x", [{"d": 1}]], "o": {"p": {"q": [{}]}}}}
    expected = sorted((("f", 0, p, q) for p, q in walk(body)), key=str)
    assert ("f", 0, "value.a[0].b[0][0].c[0]", "value.a[0].b[0][0]") in expected
    assert rows(spark, [("f", 0, json.dumps({"requestBody": body}))]) == expected


def test_strings_that_hold_objects(spark):
    inner = json.dumps({"a": [{"s": json.dumps([{"x": 1}])}]})
    assert rows(spark, [("f", 0, json.dumps({"requestBody": json.dumps({"value": inner})}))]) == [("f", 0, "value.a[0]", "")]
    assert rows(spark, [("f", 0, json.dumps({"requestBody": {"value": inner, "t": inner}}))]) == [("f", 0, "value.a[0]", "")]
    assert rows(spark, [("f", 0, json.dumps({"requestBody": [{}, [{}]]}))]) == [("f", 0, "[0]", ""), ("f", 0, "[1][0]", "")]


def test_lines_that_give_nothing(spark):
    lines = [("f", i, r) for i, r in enumerate([None, "", "{", "null", "[{}]", '"x"', '{"requestBody": null}', '{"requestBody": "{"}', '{"x": [{}]}', '{"requestBody": {"a": {}}} x'])]
    assert rows(spark, lines) == [] and rows(spark, []) == []


def test_repeated_lines_nulls_and_depth(spark):
    deep = '{"requestBody": {"a": ' + '[{"k": ' * 300 + "1" + "}]" * 300 + "}}"
    found = rows(spark, [("f", 0, deep), ("f", 0, deep), (None, None, '{"requestBody": {"a": [{}, {}]}}')])
    assert len(found) == 302 and (None, None, "a[1]", "") in found


def test_identical_objects_are_stored_once(spark):
    df = spark.createDataFrame([("f", 0, '{"requestBody": {"a": [{"x": {"y": [{"z": 1}]}}, {"x": {"y": [{"z": 1}]}}], "tags": ["x", "y"], "meta": {"k": 1}}}', 1, None, None)], SCHEMA)
    bridge = op.occurrences(df)
    rows = {r.node_no: r for r in bridge.collect()}
    assert len(rows) == 12 and sum(r.element for r in rows.values()) == 4 and rows[0].parent_no is None
    stored = {r.object_id: r for r in op.objects(bridge).collect()}
    assert len(stored) == 8 and sorted(r.n for r in stored.values()) == [1, 1, 1, 1, 2, 2, 2, 2]
    assert {'["x","y"]', '{"k":1}', '{"z":1}'} < {r.form for r in stored.values()}
    twins = [r for r in rows.values() if r.element and stored[r.object_id].form != '{"z":1}']
    assert [r.ordinal for r in twins] == [0, 1] and twins[0].object_id == twins[1].object_id and rows[twins[0].parent_no].key == "a"
    [record] = op.records(bridge, op.objects(bridge)).collect()
    assert record.body == '{"a":[{"x":{"y":[{"z":1}]}},{"x":{"y":[{"z":1}]}}],"meta":{"k":1},"tags":["x","y"]}'


def test_records_are_put_together_again(spark, small):
    lines = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/raw_capture.parquet")
    bridge = op.occurrences(lines)
    got = {(r.rel_path, r.byte_offset): r.body for r in op.records(bridge, op.objects(bridge)).collect()}
    expected = {}
    for r in lines.collect():
        try:
            body = op.unwrapped(json.loads(r.raw or "")["requestBody"])
        except (ValueError, TypeError, KeyError):
            continue
        if isinstance(body, (dict, list)):
            expected[r.rel_path, r.byte_offset] = json.dumps(body, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert got == expected and len(got) > 400


def test_depth_is_no_limit(spark):
    def line(n):
        return '{"requestBody": {"a": ' + '[{"k": ' * n + "1" + "}]" * n + "}}"

    def frame(n):
        return spark.createDataFrame([("f", 0, line(n), 1, None, None)], SCHEMA)

    assert len(op.links(frame(3000)).collect()) == 3000
    bridge = op.occurrences(frame(100_000))
    assert bridge.count() == 200_001
    assert op.rebuilt(bridge.first().root_id, {r.object_id: r.form for r in bridge.collect()}) == line(100_000)[16:-1].replace(" ", "")


@pytest.mark.parametrize("text", ['{"a": [1, -2.5e3, "x\\u00e9\\n", true, false, null, {}, []], "b": {"c": [[]]}}', " [ ] ", '"x"', "1", '{"a":1,}', "[1,]", '{"a" 1}', "[1 2]", "{1: 2}", "[", '{"a":', "nul", "[1] x", "", '["\n"]', "[NaN, Infinity, -Infinity]", '{"a": 1, "a": 2}'])
def test_the_parser_of_deep_texts(text):
    def outcome(parse):
        try:
            return repr(parse(text))
        except ValueError:
            return "error"

    assert outcome(op._unnested) == outcome(json.loads)


def test_long_numbers_and_lone_surrogates(spark):
    sys.set_int_max_str_digits(0)
    body = {"n": int("1" * 6000), "s": "\ud800", "a": [{"\ud800": 1}]}
    df = spark.createDataFrame([("f", 0, json.dumps({"requestBody": body}), 1, None, None)], SCHEMA)
    bridge = op.occurrences(df)
    [record] = op.records(bridge, op.objects(bridge)).collect()
    assert json.loads(record.body) == body and op.links(df).count() == 1
