import json
import random

import numpy as np
import pytest

from tracewright.llm import truncation as op

ENVELOPE = "seq_no bigint, value string, source_ref struct<uri:string>, chars string, ending int"
DISTILLED = "row_id bigint, input string, source struct<name:string>, origin string"


def cut(spark, env, dist):
    e = spark.createDataFrame([(i, v, (f"{s}://x",) if s else None, "c", 1) for i, (v, s) in enumerate(env)], ENVELOPE)
    d = spark.createDataFrame([(i, v, (s,) if s else None, "c") for i, (v, s) in enumerate(dist)], DISTILLED)
    return op.judged(e, d), e, d


@pytest.mark.parametrize(
    "text,how",
    [("All is well.", "full"), ("Is it?", "full"), ("He said “go.”", "full"), ("<p>Done.</p>", "full"), ("A.\n\n- take the first\n- take the second", "listed"), ("See\nhttps://a.example/x", "listed"), ("x.\n$ make all", "listed"), ("a.\n# Status: closed", "listed"), ("It ends here. (see parser)", "listed"),
     ("It stops in the mid", "prose"), ("It stops in the ", "prose"), ("It stops…", "marked"), ("It stops in the [truncated]", "marked"), ("It stops (cut)", "marked"), ("It stops in … [more]", "marked"), ("It stops in the w�", "broken"), ("```py\nx = 1", "open"), ("```py\nx = 1\n```", "full"), ("# file: a.py\nx = 1", "prose"), ("", "full"), ("  \n", "full")],
)
def test_endings(text, how):
    assert op.ending(text)[0] == how


def test_blocks_are_learnt_from_the_texts(spark):
    """Headers and footers this corpus doesn't have; where the footer is missing the text was cut."""
    whole = [f"Some words on item {i}.\n%% section: s{i}\nx = {i}\n%% over" for i in range(60)]
    cut_off = [f"Some words on item {i}.\n%% section: s{i}\nx = {i}" for i in range(8)]
    other = [f"Some words.\n%% note {i}\nThat is all of {i}." for i in range(60)]
    judged, *_ = cut(spark, [], [(t, "s") for t in whole + cut_off + other])
    rows = {r.row_key: r for r in judged.collect()}
    assert {rows[i].ending for i in range(60)} == {"full"} and {rows[i].ending for i in range(60, 68)} == {"open"} and {rows[i].ending for i in range(68, 128)} == {"full"}
    assert {r.row_key for r in op.cut_rows(judged).collect()} == set(range(60, 68))


def test_limits_are_matched_exactly_however_long(spark):
    rng = random.Random(4)
    texts = ["word " * (rng.randrange(100, 15_000)) + "end." for _ in range(300)] + [("words " * 20_000)[:90_007] for _ in range(30)] + ["word " * 18_001 + "end."]
    judged, *_ = cut(spark, [], [(t, "s") for t in texts])
    at = [r.row_key for r in judged.where("at_limit").collect()]
    assert sorted(at) == list(range(300, 330))


def test_long_runs_take_linear_time():
    import time

    began = time.perf_counter()
    for text in ("a" + " " * 500_000 + "b", "\n" * 500_000 + "x", "```\n" * 100_001, "a " * 300_000 + "'" * 100_000, "...." * 100_000):
        op.ending(text)
    assert time.perf_counter() - began < 10


def test_the_mark_does_not_count_to_the_length():
    assert op.ending("abc def... ")[1] == 7 and op.ending("abc def [truncated]")[1] == 7


VALUE = json.dumps({"a": {"b": ["x \\ y", 1.5, True, None]}, "text": "é."}, ensure_ascii=False)


def test_every_prefix_of_a_value_is_cut():
    assert op.json_cut(VALUE) is None
    for n in range(1, len(VALUE)):
        assert op.json_cut(VALUE[:n]) is True, VALUE[:n]
    assert op.json_cut(VALUE[:-4] + "�") is True


@pytest.mark.parametrize("value", ["{'a': 1}", "﻿" + VALUE, VALUE + VALUE, VALUE + ",", '{"a" 1, "b": 2}', "not json at all", '{"a": b}', "<html>"])
def test_values_broken_in_other_ways_are_not_cut(value):
    assert op.json_cut(value) is False


def test_censored_fit_recovers_the_distribution():
    x = np.exp(np.random.default_rng(0).normal(5.0, 0.6, 20_000)).round().clip(1)
    limit = 200
    lengths, counts = np.unique(np.minimum(x, limit), return_counts=True)
    mean, deviation = op.censored_fit(lengths, counts, limit)
    assert mean == pytest.approx(5.0, abs=0.03) and deviation == pytest.approx(0.6, abs=0.03)
    naive = np.log(x[x < limit])
    assert abs(naive.mean() - 5.0) > 0.2  # what is gained


def corpus(rng, n, limit, name):
    out, truth = [], []
    for _ in range(n):
        text = " ".join(" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(4, 9))).capitalize() + "." for _ in range(rng.randrange(1, 12)))
        if rng.random() < 0.1:
            text += "\n\n- first point\n- second point"
        short = text if limit is None or len(text) <= limit else text[:limit]
        out.append((short, name))
        truth.append(short != text and not short.rstrip().endswith("."))
    return out, truth


def test_limits_and_sources(spark):
    rng = random.Random(7)
    rows, truth = [], []
    for name, limit in (("tight", 120), ("loose", None), ("wide", 220)):
        r, t = corpus(rng, 500, limit, name)
        rows, truth = rows + r, truth + t
    judged, e, d = cut(spark, [(VALUE, "s"), (VALUE[:20], "s"), (None, None), ("", "s")], rows + [(None, None), ("", "tight")])
    found = op.cut_rows(judged)
    assert {r.row_key for r in found.where("src_table = 'stage0_distilled'").collect()} == {i for i, t in enumerate(truth) if t}
    assert [r.row_key for r in found.where("src_table = 'envelope'").collect()] == [1]
    shares = {(r.src_table, r.origin): (r.n_rows, r.n_cut) for r in op.cut_shares(found, e, d).collect()}
    assert shares["stage0_distilled", "loose"] == (500, 0) and shares["envelope", "s"] == (3, 1) and shares["stage0_distilled", "tight"][1] > 300


def test_empty_and_repeated(spark):
    judged, e, d = cut(spark, [], [])
    assert op.cut_rows(judged).count() == 0
    judged, e, d = cut(spark, [(VALUE[:9], "s")], [("x" * 3_000_000 + ".", "n")])
    twice, _, _ = op.judged(e.union(e), d), e, d
    assert op.cut_rows(twice).count() == 1


def test_each_limit_is_judged_by_its_own_posterior():
    import pandas as pd

    ending = op.ENDINGS[1]
    rows = [("t", "s", "f", True, 0.99, ending, 50), ("t", "s", "f", True, 0.02, ending, 50), ("t", "s", "f", False, 0.0, op.ENDINGS[0], 1000)]
    got = op.latent_classes(pd.DataFrame(rows, columns=["src_table", "origin", "field", "at_limit", "censored", "ending", "n"]))
    by = dict(zip(got["censored"], got["posterior"]))
    assert by[0.99] > 0.5 > by[0.02]
