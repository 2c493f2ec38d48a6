"""Text cut off by field limits or in transfer.

Each text's length is right-censored at its source's field limit, if the source has one.  Candidate limits are lengths
at which far more texts end than at their neighbours and which hardly any text passes.  Per source and candidate a
log-normal length distribution is fitted by maximum likelihood with the texts at the limit taken as censored; a text
at the limit was cut with posterior S(L) / (S(L) + f(L)), before its ending is looked at.  How texts end (full stop,
list or link, open code block, mark, in mid-sentence) is combined with that by latent classes: the ending's
probabilities for cut and for whole texts, and the share of cut texts of each source away from its limits, are
estimated by expectation maximisation over the table of counts (source x at limit x ending).

Which lines open and close a block (headers and footers of files, say) is learnt from the texts: a line that many texts
end with, and that is hardly ever met without a certain other line before it, closes what that one opens.

JSON values that end within a string or structure are cut; values broken in other ways are not.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.shared import materialise, spread

FULL, LISTED, PROSE, MARKED, BROKEN, OPEN = "full", "listed", "prose", "marked", "broken", "open"
ENDINGS = (FULL, LISTED, PROSE, MARKED, BROKEN, OPEN)
#: Share of texts cut in transfer that the estimation starts from, away from limits.
START = 0.02

FEATURES = "src_table string, row_key bigint, origin string, field string, chars bigint, bytes bigint, ending string, signs array<string>, places array<int>, last string"
_ARROW = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.string())

_MARK = re.compile(r"\s*(?:\[(?:truncated|cut|snip|more|continued|\.\.\.|…)\]|\((?:truncated|cut|more|continued|snip)\)|<(?:truncated|cut|snip)>|…\s*(?:\[more\]|\(more\)|read more)?|\.\.\.\s*(?:\[more\]|\(more\)|read more)?)\s*$", re.I)
_CLOSERS = re.compile(r"(?:[\s\"'”’»)\]*_]|</[A-Za-z][A-Za-z0-9]*>)+$")
_STOP = ".!?。！？"
_LISTED = re.compile(r"(?:[-*+•]|\d+[.)]|#{1,6}|\$|>)\s+\S[^\n]*$|(?:.*\s)?https?://\S+$|(?:.*\s)?\(see [^()\n]+\)$|[|].*[|]$")
_FENCE = re.compile(r"^[ \t]*```", re.M)


def ending(text: str) -> tuple[str, int]:
    """(how the text ends, its length without a mark put in place of the rest)."""
    body = text.rstrip()
    if not body:
        return FULL, len(text)
    if body[-1] == "�":
        return BROKEN, len(body.rstrip("�"))
    if body[-1] in ".…])>e" and (m := _MARK.search(body, max(0, len(body) - 64))) and not body[max(0, m.start() - 64) : m.start()].rstrip().endswith(tuple(_STOP)):
        return MARKED, m.start()
    if "```" in text and len(_FENCE.findall(text)) % 2:
        return OPEN, len(text)
    if body.endswith("```"):
        return FULL, len(text)
    last = body[body.rfind("\n") + 1 :][-2000:]
    if body[-1] in _STOP:
        return FULL, len(text)
    bare = _CLOSERS.sub("", last)
    if bare != last and bare and bare[-1] in _STOP:
        return FULL, len(text)
    return (LISTED if text[-1] == body[-1] and _LISTED.match(last) else PROSE), len(text)


#: A line that begins with signs: these and the words after them, up to a colon or anything else.
_SIGN = re.compile(r"^[^\w\s\"'(\[{},;.]{1,5} ?[A-Za-z_]+(?: [A-Za-z_]+){0,3}(?![A-Za-z_]):?", re.M)


def signs(text: str) -> tuple[dict[str, int], str | None]:
    """The signed lines of a text, each with the place where it stands last, and the one that is the last line whole."""
    found = {m.group(): m.start() for m in _SIGN.finditer(text)}
    end = text.rstrip()
    last = end[end.rfind("\n") + 1 :]
    return found, last if last in found else None


def json_cut(value: str) -> bool | None:
    """None: whole JSON. True: it ends inside a string or structure. False: broken in another way."""
    try:
        json.loads(value)
        return None
    except RecursionError:
        return False
    except json.JSONDecodeError as error:
        message, at = error.msg, error.pos
    text = value.rstrip()
    if value[:1] == "﻿":
        inner = json_cut(value[1:])
        return bool(inner)
    if text[:1] not in ("{", "["):
        return False
    if message.startswith("Unterminated string"):
        return True
    rest = text[min(at, len(text)) :].rstrip("�")
    if not rest:
        return True
    if message.startswith("Invalid \\u") or message.startswith("Invalid \\escape"):
        return len(rest) <= 6
    return rest in (".", "e", "E", "e-", "e+", "E-", "E+") or len(rest) <= 5 and any(w.startswith(rest) for w in ("true", "false", "null", "-"))


def _envelope_texts(value: dict) -> Iterator[tuple[str, str]]:
    for name in ("request", "response", "document"):
        part = value.get(name)
        if isinstance(part, dict) and isinstance(part.get("text"), str):
            yield name, part["text"]
    if isinstance(value.get("text"), str):
        yield "text", value["text"]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            out: list[tuple] = []
            for table, key, origin, text in zip(*(c.to_pylist() for c in part.columns)):
                if not text:
                    continue
                if table == "envelope":
                    cut = json_cut(text)
                    if cut is not None:
                        out.append((table, key, origin, "value", len(text), len(text.encode("utf-8", "replace")), OPEN if cut else FULL, [], [], None))
                        continue
                    value = json.loads(text)
                    fields = list(_envelope_texts(value)) if isinstance(value, dict) else []
                else:
                    fields = [("input", text)]
                for field, own in fields:
                    how, chars = ending(own)
                    found, last = signs(own)
                    out.append((table, key, origin, field, chars, len(own[:chars].encode("utf-8", "replace")), how, list(found), list(found.values()), last))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW)], names=[x.split(" ")[0] for x in FEATURES.split(", ")])


def texts(envelope: DataFrame, distilled: DataFrame) -> DataFrame:
    """(src_table, row_key, origin, text) of both tables; the origin is the uri's scheme or the source's name."""
    scheme = F.coalesce(F.regexp_extract("source_ref.uri", r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1), F.lit(""))
    e = envelope.select(F.lit("envelope").alias("src_table"), F.col("seq_no").cast("bigint").alias("row_key"), scheme.alias("origin"), F.col("value").alias("text"))
    d = distilled.select(F.lit("stage0_distilled").alias("src_table"), F.col("row_id").cast("bigint").alias("row_key"), F.coalesce("source.name", F.lit("")).alias("origin"), F.col("input").alias("text"))
    return e.unionByName(d)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def censored_fit(lengths: np.ndarray, counts: np.ndarray, limit: float) -> tuple[float, float]:
    """(mean, deviation) of log lengths by maximum likelihood, lengths at ``limit`` or more being right-censored.

    The likelihood is climbed by expectation maximisation with the moments of the truncated normal distribution.
    """
    x, c = np.log(lengths[lengths < limit]), counts[lengths < limit].astype(float)
    censored, n = float(counts[lengths >= limit].sum()), float(counts.sum())
    if not len(x) or c.sum() < 2:
        return math.log(limit), 1.0
    s1, s2 = float((c * x).sum()), float((c * x * x).sum())
    mean = s1 / c.sum()
    deviation = max(math.sqrt(max(s2 / c.sum() - mean * mean, 0.0)), 1e-3)
    at = math.log(limit)
    for _ in range(200):
        z = (at - mean) / deviation
        hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / max(_normal_tail(z), 1e-300)
        e1 = mean + deviation * hazard
        e2 = deviation * deviation * (1 + z * hazard - hazard * hazard) + e1 * e1
        new = (s1 + censored * e1) / n
        spread = max(math.sqrt(max((s2 + censored * e2) / n - new * new, 0.0)), 1e-3)
        if abs(new - mean) + abs(spread - deviation) < 1e-9:
            break
        mean, deviation = new, spread
    return mean, deviation


def limits_of(histogram: pd.DataFrame) -> pd.DataFrame:
    """Candidate limits of one source's field in one unit, each with its censoring posterior."""
    key = histogram[["src_table", "origin", "field", "unit"]].iloc[0]
    h = histogram.groupby("length", as_index=False)["n"].sum().sort_values("length")
    lengths, counts = h["length"].to_numpy(), h["n"].to_numpy()
    total, above = counts.sum(), counts.sum() - np.cumsum(counts)
    found = []
    upto = np.append(0, np.cumsum(counts))
    near = (upto[:-1] - upto[np.searchsorted(lengths, lengths * 0.9)]) / np.maximum(lengths * 0.1, 1)
    for i in np.flatnonzero((counts >= 5) & (counts >= 8 * np.maximum(near, 0.25)) & (above <= 0.1 * counts)):
        mean, deviation = censored_fit(lengths, counts, lengths[i])
        z = (math.log(lengths[i]) - mean) / deviation
        survive = _normal_tail(z)
        density = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / deviation / lengths[i]
        found.append((*key, int(lengths[i]), float(survive / (survive + density))))
    return pd.DataFrame(found, columns=["src_table", "origin", "field", "unit", "length", "censored"])


def latent_classes(table: pd.DataFrame) -> pd.DataFrame:
    """Posterior of being cut for each (src_table, origin, field, at_limit, censored, ending) of the table of counts.

    A text that ends with a full stop is no case, so cut texts are given none of these endings.
    """
    n, prior = table["n"].to_numpy(float), table["censored"].to_numpy(float)
    at_limit = table["at_limit"].to_numpy(bool)
    kind = table["ending"].map({e: i for i, e in enumerate(ENDINGS)}).to_numpy()
    group = table.groupby(["src_table", "origin", "field"], sort=False).ngroup().to_numpy()
    # Where estimation starts; as pseudo-counts these also steady it where there are few texts.
    cut = first_cut = np.array([1e-6, 0.08, 0.5, 0.1, 0.1, 0.2])
    whole = first_whole = np.array([0.7, 0.28, 0.016, 0.002, 0.001, 0.001])
    odds = np.where(at_limit, prior, START)
    post = np.zeros(len(n))
    for _ in range(60):
        a, b = odds * cut[kind], (1 - odds) * whole[kind]
        post = a / np.maximum(a + b, 1e-300)
        cut = np.bincount(kind, n * post, len(ENDINGS)) + 20 * first_cut
        cut[0] = 1e-6 * cut.sum()
        whole = np.bincount(kind, n * (1 - post), len(ENDINGS)) + 100 * first_whole
        cut, whole = cut / cut.sum(), whole / whole.sum()
        away = ~at_limit
        share = (np.bincount(group[away], (n * post)[away], group.max() + 1) + START) / (np.bincount(group[away], n[away], group.max() + 1) + 1)
        odds = np.where(at_limit, prior, share[group])
    return table.assign(posterior=post)[["src_table", "origin", "field", "at_limit", "censored", "ending", "posterior"]]


#: A closing line ends at least so many texts, and this share of all texts.
LEAST_CLOSED, CLOSING_SHARE = 20, 0.002


def learnt_blocks(rows: DataFrame) -> DataFrame:
    """(opens, closes): the lines that open and close blocks, from the signed lines of all texts; at most 500 rows.

    A closing line is the last of at least a 500th of all texts (so there are at most 500), and of three in ten that have
    it. What opens its block stands before it in 19 of 20 texts that have it, and is closed by it in more than half of
    the texts that have the opening line; of several such lines the one most often closed counts.
    """
    marked = rows.where("size(signs) > 0")
    closing = (
        marked.select(F.explode("signs").alias("closes"), "last")
        .groupBy("closes")
        .agg(F.count("*").alias("n_closes"), F.count_if(F.col("last") == F.col("closes")).alias("n_last"))
        .join(F.broadcast(rows.agg(F.count("*").alias("n_texts"))))  # one row
        .where((F.col("n_last") >= LEAST_CLOSED) & (F.col("n_last") >= F.col("n_texts") * CLOSING_SHARE) & (F.col("n_last") >= 0.3 * F.col("n_closes")))
        .select("closes", "n_closes")
    )
    # Closing lines are at most 1 / CLOSING_SHARE = 500, so a text's lines meet only these.
    own = F.arrays_zip("signs", "places")
    met = marked.select(own.alias("own")).withColumn("c", F.explode("own")).join(F.broadcast(closing), F.col("c.signs") == F.col("closes"))
    before = met.select("closes", "n_closes", F.explode(F.filter("own", lambda o: o["places"] < F.col("c.places"))).alias("o")).groupBy("closes", "n_closes", F.col("o.signs").alias("opens")).agg(F.count("*").alias("n_both"))
    opened = marked.select(F.explode("signs").alias("opens")).groupBy("opens").agg(F.count("*").alias("n_opens"))
    pairs = before.where("n_both >= 0.95 * n_closes").join(opened, "opens").where("n_both > 0.5 * n_opens")
    return pairs.groupBy("closes").agg(F.max_by("opens", F.struct(F.col("n_both") / F.col("n_opens"), "opens")).alias("opens")).select("opens", "closes")


def judged(envelope: DataFrame, distilled: DataFrame) -> DataFrame:
    """(src_table, row_key, origin, field, ending, at_limit, posterior) of each text of both tables.

    Null and empty texts have no row; rows repeated whole are judged alike; either table may be empty.  Tables of counts
    have one row for each source, field, limit and ending, histograms one for each source, field and distinct length: no
    more than the longest text has characters, however many texts there are.
    """
    features = materialise(spread(texts(envelope, distilled)).mapInArrow(_features, FEATURES), "truncation-features")
    # One row of at most 500 pairs.
    blocks = F.broadcast(materialise(learnt_blocks(features).agg(F.collect_list(F.struct("opens", "closes")).alias("blocks")), "truncation-blocks"))
    place = lambda sign: F.element_at(F.concat("places", F.array(F.lit(-1))), F.when(F.array_contains("signs", sign), F.array_position("signs", sign).cast("int")).otherwise(-1))
    is_open = F.exists("blocks", lambda b: F.array_contains("signs", b["opens"]) & (place(b["opens"]) > place(b["closes"])))
    closed = F.col("last").isNotNull() & F.exists("blocks", lambda b: b["closes"] == F.col("last"))
    settled = F.col("ending").isin(MARKED, BROKEN) | (F.size("signs") == 0)
    rows = features.join(blocks).withColumn("ending", F.when(settled, F.col("ending")).when(is_open, OPEN).when(closed & (F.col("ending") != OPEN), FULL).otherwise(F.col("ending"))).drop("signs", "places", "last", "blocks")
    units = rows.where("chars > 0").select("src_table", "origin", "field", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("u")).select("src_table", "origin", "field", "u.unit", "u.length")
    histogram = units.groupBy("src_table", "origin", "field", "unit", "length").count().withColumnRenamed("count", "n")
    limits = histogram.groupBy("src_table", "origin", "field", "unit").applyInPandas(limits_of, "src_table string, origin string, field string, unit string, length bigint, censored double")
    limits = materialise(limits, "truncation-limits")
    at = lambda unit: limits.where(F.col("unit") == unit).select("src_table", "origin", "field", F.col("length").alias(unit), F.col("censored").alias(f"by_{unit}"))
    placed = rows.join(at("chars"), ["src_table", "origin", "field", "chars"], "left").join(at("bytes"), ["src_table", "origin", "field", "bytes"], "left")
    placed = placed.withColumn("censored", F.greatest(F.coalesce("by_chars", F.lit(0.0)), F.coalesce("by_bytes", F.lit(0.0)))).withColumn("at_limit", F.col("censored") > 0)
    # Each limit is judged by its own censoring posterior; there are as many of these as candidate limits.
    counts = placed.groupBy("src_table", "origin", "field", "at_limit", "censored", "ending").agg(F.count("*").alias("n"))
    posterior = counts.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(latent_classes, "src_table string, origin string, field string, at_limit boolean, censored double, ending string, posterior double")
    return placed.join(posterior, ["src_table", "origin", "field", "at_limit", "censored", "ending"]).select("src_table", "row_key", "origin", "field", "ending", "at_limit", "posterior")


def cut_rows(judgements: DataFrame) -> DataFrame:
    """(src_table, row_key) of the rows with a cut text, once each."""
    return judgements.where("posterior > 0.5").select("src_table", "row_key").distinct()


def cut_shares(cut: DataFrame, envelope: DataFrame, distilled: DataFrame) -> DataFrame:
    """(src_table, origin, n_rows, n_cut, share): how often each source truncates, of all its rows."""
    rows = texts(envelope, distilled).select("src_table", "row_key", "origin")
    return (
        rows.join(cut.withColumn("_cut", F.lit(1)), ["src_table", "row_key"], "left")
        .groupBy("src_table", "origin")
        .agg(F.count("*").alias("n_rows"), F.count("_cut").alias("n_cut"))
        .withColumn("share", F.col("n_cut") / F.col("n_rows"))
    )
