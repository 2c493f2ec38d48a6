"""Deeply nested records as related flat tables, through Merkle subtree identities.

Every container (object or array) of a record is canonicalised and hashed bottom-up: in its canonical form nested
containers stand as their own identities, so equal subtrees have equal identities wherever they are.  Two tables hold
everything: ``objects`` has each distinct container once, ``occurrences`` is the bridge with one row for each place of
a container in a record, its parent's place, and the key or ordinal it has there.  ``records`` goes the way back.
``links`` are the paths of objects that are array elements.

Records are parsed inside Arrow batches, one record at a time; nothing is grouped per file.  Parsing and walking keep
their own stacks, so depth is bounded by the text alone.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.shared import spread

#: node_no counts a record's containers in document order from 0, the root; the root has no parent, key or ordinal.
BRIDGE = "rel_path string, byte_offset bigint, root_id string, node_no int, parent_no int, key string, ordinal int, element boolean, object_id string, form string"
LINKS = "rel_path string, byte_offset bigint, node_path string, parent_path string, object_id string"
#: Rows a batch of output has at most, and characters of paths.
_ROWS, _CHARS = 20_000, 1 << 24

_SPACE = re.compile(r"[ \t\n\r]*")
_WORDS = {"n": ("null", None), "t": ("true", True), "f": ("false", False), "N": ("NaN", float("nan")), "I": ("Infinity", float("inf"))}


def _unnested(text: str):
    """``json.loads`` with a stack of its own, for texts nested more deeply than that can follow."""
    space, number, string = _SPACE.match, json.scanner.NUMBER_RE.match, json.decoder.scanstring
    fail = lambda at: json.JSONDecodeError("Malformed", text, at)
    stack: list[tuple] = []  # containers that are open, each with the key that waits in it
    at, value, done = space(text, 0).end(), None, False
    while True:
        c = text[at : at + 1]
        done = True
        if c == '"':
            value, at = string(text, at + 1, True)
        elif c == "{" or c == "[":
            value, at = ({} if c == "{" else []), space(text, at + 1).end()
            if text[at : at + 1] == ("}" if c == "{" else "]"):
                at += 1
            else:
                stack.append((value, None))
                done = False
        elif c in _WORDS and text.startswith(_WORDS[c][0], at):
            value, at = _WORDS[c][1], at + len(_WORDS[c][0])
        elif text.startswith("-Infinity", at):
            value, at = float("-inf"), at + 9
        elif m := number(text, at):
            value, at = (float(m.group()) if m.group(2) or m.group(3) else int(m.group())), m.end()
        else:
            raise fail(at)
        # Put finished values where they belong, and close what closes, until another value is due.
        while done and stack:
            holder, key = stack[-1]
            if isinstance(holder, list):
                holder.append(value)
            else:
                holder[key] = value
            at = space(text, at).end()
            c = text[at : at + 1]
            if c == ",":
                at, done = space(text, at + 1).end(), False
            elif c == ("]" if isinstance(holder, list) else "}"):
                value, at = stack.pop()[0], at + 1
            else:
                raise fail(at)
        if done:
            if space(text, at).end() != len(text):
                raise fail(at)
            return value
        holder = stack[-1][0]
        if isinstance(holder, dict):
            if text[at : at + 1] != '"':
                raise fail(at)
            key, at = string(text, at + 1, True)
            at = space(text, at).end()
            if text[at : at + 1] != ":":
                raise fail(at)
            stack[-1] = (holder, key)
            at = space(text, at + 1).end()


def parsed_object(text: str | None):
    """The object a text holds; None if it holds none."""
    if not text:
        return None
    try:
        try:
            value = json.loads(text)
        except RecursionError:
            value = _unnested(text)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def unwrapped(body):
    """``requestBody`` with a string that holds an object read as that object, likewise its direct ``value``."""
    if isinstance(body, str):
        body = parsed_object(body)
    if isinstance(body, dict) and isinstance(body.get("value"), str):
        inner = parsed_object(body["value"])
        if inner is not None:
            body = {**body, "value": inner}
    return body


_canonical = json.JSONEncoder(sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode


def _digest(value: str) -> str:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def containers(root) -> list[list]:
    """[parent_no, key, ordinal, object_id, form] of each container of a record in document order.

    ``form`` is the container's canonical JSON, in which nested containers stand as ``{"#": identity}``; as every
    container stands so, nothing else in a form looks like that.  ``object_id`` is the hash of the form.
    """
    order: list[list] = []
    values: list = []
    stack: list[tuple] = [(root, -1, None, None)]
    while stack:
        value, parent, key, ordinal = stack.pop()
        no = len(order)
        order.append([parent, key, ordinal, None, None])
        values.append(value)
        if isinstance(value, dict):
            inner = [(v, no, k, None) for k, v in value.items() if isinstance(v, (dict, list))]
        else:
            inner = [(v, no, None, i) for i, v in enumerate(value) if isinstance(v, (dict, list))]
        inner.reverse()
        stack += inner
    below: list = [None] * len(order)  # identities of a container's children, by key or index
    for no in range(len(order) - 1, -1, -1):  # children come after their parent
        own, value, row = below[no], values[no], order[no]
        if own:
            value = {k: own.get(k, v) for k, v in value.items()} if isinstance(value, dict) else [own.get(i, v) for i, v in enumerate(value)]
        row[4] = form = _canonical(value)
        row[3] = _digest(form)
        below[no] = None
        if row[0] >= 0:
            if below[row[0]] is None:
                below[row[0]] = {}
            below[row[0]][row[1] if row[1] is not None else row[2]] = {"#": row[3]}
    return order


def elements(rows: list[list]) -> Iterator[tuple[str, str, str]]:
    """(node_path, parent_path, object_id) of each object that is an array element."""
    paths: list[str] = []
    owners: list[str] = []  # path of the nearest such object, of what stands inside each container
    for parent, key, ordinal, identity, form in rows:
        if parent < 0:
            paths.append("")
            owners.append("")
            continue
        above = paths[parent]
        path = f"{above}[{ordinal}]" if key is None else f"{above}.{key}" if above else key
        paths.append(path)
        if key is None and form[0] == "{":
            yield path, owners[parent], identity
            owners.append(path)
        else:
            owners.append(owners[parent])


def _bodies(batch: pa.RecordBatch) -> Iterator[tuple[str | None, int | None, list[list]]]:
    sys.set_int_max_str_digits(0)  # numbers of any length are numbers
    for rel, offset, raw in zip(*(c.to_pylist() for c in batch.columns)):
        record = parsed_object(raw)
        body = unwrapped(record.get("requestBody")) if record else None
        if isinstance(body, (dict, list)):
            yield rel, offset, containers(body)


def _safe(text: str | None) -> str | None:
    """Lone surrogates can't be stored; they are kept as the escapes they came from."""
    return None if text is None else text.encode("utf-8", "backslashreplace").decode()


def _batches(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]], texts: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Rows in batches that are bounded in rows and in characters of the given columns."""
    out: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = []
        for values, (_, kind) in zip(zip(*out), fields):
            try:
                columns.append(pa.array(values, kind))
            except UnicodeEncodeError:
                columns.append(pa.array([_safe(v) for v in values], kind))
        return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    for row in rows:
        out.append(row)
        size += sum(len(row[i]) for i in texts)
        if len(out) >= _ROWS or size >= _CHARS:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _bridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for rel, offset, found in _bodies(batch):
                root = found[0][3]
                for no, (parent, key, ordinal, identity, form) in enumerate(found):
                    yield rel, offset, root, no, None if parent < 0 else parent, key, ordinal, ordinal is not None and form[0] == "{", identity, form

    s, i = pa.string(), pa.int32()
    return _batches(rows(), list(zip((c.split(" ")[0] for c in BRIDGE.split(", ")), (s, pa.int64(), s, i, i, s, i, pa.bool_(), s, s))), (9,))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((rel, offset, *row) for batch in batches for rel, offset, found in _bodies(batch) for row in elements(found))
    s = pa.string()
    return _batches(rows, list(zip((c.split(" ")[0] for c in LINKS.split(", ")), (s, pa.int64(), s, s, s))), (2, 3))


def _lines(raw_capture: DataFrame) -> DataFrame:
    return raw_capture.where("raw like '%{%'").select("rel_path", F.col("byte_offset").cast("bigint").alias("byte_offset"), "raw")


def occurrences(raw_capture: DataFrame) -> DataFrame:
    """The bridge: one row for each place of a container inside ``requestBody``, the root among them.

    Lines that are null, empty, broken JSON or no object give no row; repeated lines are read once; a record without
    ``requestBody`` (or with a scalar there) gives no row; duplicate keys keep the last value; lone surrogates are kept as
    escapes.  Extra columns are ignored.  ``form`` is the container's own content and goes to ``objects``.
    """
    return _lines(raw_capture).dropDuplicates().mapInArrow(_bridge, BRIDGE)


def objects(bridge: DataFrame) -> DataFrame:
    """(object_id, form, n): each distinct container once, with the number of its occurrences."""
    return bridge.groupBy("object_id").agg(F.first("form").alias("form"), F.count("*").alias("n"))


_REFERENCE = re.compile(r'\{"#":"([0-9a-f]{32})"\}')


def rebuilt(root: str, forms: dict[str, str]) -> str:
    """A container's canonical JSON from the forms of all that is in it."""
    out: list[str] = []
    stack: list[tuple[bool, str]] = [(True, root)]
    while stack:
        reference, text = stack.pop()
        if reference:
            pieces = _REFERENCE.split(forms[text])  # literals at even places, identities between them
            stack += [(i % 2 == 1, pieces[i]) for i in range(len(pieces) - 1, -1, -1)]
        else:
            out.append(text)
    return "".join(out)


def records(bridge: DataFrame, stored: DataFrame) -> DataFrame:
    """(rel_path, byte_offset, root_id, body): each record's canonical JSON, put together again from the two tables.

    One task holds one record at a time.
    """
    whole = bridge.select("rel_path", "byte_offset", "root_id", "object_id").distinct().join(stored.select("object_id", "form"), "object_id")

    def record(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"rel_path": [key[0]], "byte_offset": [key[1]], "root_id": [key[2]], "body": [rebuilt(key[2], dict(zip(rows["object_id"], rows["form"])))]})

    return whole.groupBy("rel_path", "byte_offset", "root_id").applyInPandas(record, "rel_path string, byte_offset bigint, root_id string, body string")


def links(raw_capture: DataFrame) -> DataFrame:
    """(rel_path, byte_offset, node_path, parent_path), distinct: each object that is an array element, and the nearest
    one around it.

    Repeated lines are read again, which spares a shuffle of the lines themselves, as the result is made distinct anyway.
    """
    return spread(_lines(raw_capture)).mapInArrow(_links, LINKS).select("rel_path", "byte_offset", "node_path", "parent_path").distinct()
