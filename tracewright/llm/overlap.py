"""Records of evaluation splits that recur, exactly or almost, in training data.

Records are normalised to words and cut into content-defined chunks: a rolling hash over two words decides where a
chunk ends, so an edit disturbs only the chunks around it.  Every record is cut in two independent ways, so what scattered
edits leave of one cutting and of the other is found either way.  Chunk digests are joined across the splits, lengths of
shared chunks are summed per pair of records, and every pair found is settled exactly: the share of the evaluation
record's words that stand in the training record in the same order (longest common subsequence).

Short records.  Edits may leave no whole chunk of a record of few words.  Records under ``SHORT`` words are therefore looked up by
pairs of neighbouring words as well, by one more pair than a fifth of its words can touch when replaced, removed or pushed
apart; a record of under 5 words, all of which must be there, by its longest word.  So no short record is missed for its
edits.  Pairs carry no length and don't count to the overlap.

Skew.  Texts equal after normalisation form a class and only one of each takes part.  An evaluation record is looked
up by all its chunks, however common they are, so whether a pair is met depends on its two records alone.  Pairs that
meet in a chunk must pass a test that no true case fails: bitmaps of hashed words bound from below how many words are
missing.  Training records give only the chunks that pass a bitmap of the evaluation records' chunks (``FILTER_BITS``, so at
most 8 MB whatever the data; where it fills up, an exact join takes its place before the wider rows are shuffled).  A chunk
that is common on both sides costs the product of the two numbers in comparisons of bitmaps, done as products of matrices;
such chunks are cut into a grid of parts of both sides, so no task has more than ``HOT`` comparisons for one, and only pairs
that pass are written.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.shared import materialise, spread, tidy

#: Words a chunk has at least, and words after these until the cut, on average.
LEAST_CHUNK = 3
MEAN_CHUNK = 3
#: The most words of a chunk, as its length has seven bits.
MOST_CHUNK = 127
#: The least share of the evaluation record's words that must stand in the training record in order.
SAME = 0.8

#: Records of fewer words are looked up by pairs of words too.
SHORT = 40
#: Size of the bitmap of evaluation chunks, and how full it may be to be enough on its own.
FILTER_BITS, FULL = 1 << 26, 0.25

#: Comparisons that one chunk may give a task, and evaluation rows of one chunk that a task holds.
HOT, HELD = 500_000_000, 50_000

#: Odd factors of the two rolling hashes.
_WAYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>|<!--.{0,2000}?-->|\]\([^()\s]*\)", re.S)
_WORD = re.compile(r"[^\W_]+")
_UNSEEN = re.compile("[­​-‏⁠-⁤﻿]")
_MARKS = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]")
_MASK = (1 << 64) - 1


def words_of(text: str | None) -> list[str]:
    """The words of a text, leaving aside case, spacing, punctuation, markup and Unicode form."""
    if not text:
        return []
    if "&" in text and ";" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _UNSEEN.sub("", text)))
    if "<" in text or "](" in text:
        text = _TAG.sub(" ", text)
    return _WORD.findall(text.casefold())


class Chunker:
    """Content-defined chunks of word lists; each is one number: its digest, one bit for the way of cutting, and its length
    in seven bits."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 300_000:
            known.clear()
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            return np.array([known[w] for w in words], np.uint64)

    def batch(self, records: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct chunks of one record after another, number of chunks of each, bitmaps) of evaluation records."""
        chunks, _, counts, bits = self.counted(records)
        return chunks, counts, bits

    def counted(self, records: list[list[str]], wanted_keys: np.ndarray | None = None, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(distinct chunks of one record after another, how often it has each, number of chunks of each record, bitmaps of
        words as 4 numbers a record).

        Evaluation records have the pairs and words by which short ones are looked up among their chunks; training records,
        for which the bitmap of ``wanted_keys`` is given, whatever of their chunks, pairs and words is in it. Without ``short``
        there are no pairs and words.
        """
        sizes = np.fromiter(map(len, records), np.int64, len(records))
        h = self.hashes([w for words in records for w in words])
        owner = np.repeat(np.arange(len(records)), sizes)
        first = np.cumsum(sizes) - sizes
        bits = np.zeros((len(records), 4), np.uint64)
        slot = (h >> np.uint64(40)).astype(np.int64) & 255
        np.bitwise_or.at(bits, (owner, slot >> 6), np.uint64(1) << (slot & 63).astype(np.uint64))
        chunks, of = [], []
        for way, factor in enumerate(_WAYS):
            with np.errstate(over="ignore"):
                rolled = h.copy()
                rolled[1:] += h[:-1] * np.uint64(factor)
                rolled[first] = 0
                rolled ^= rolled >> np.uint64(29)
                rolled *= np.uint64(0xBF58476D1CE4E5B9)
                wanted = np.flatnonzero((rolled >> np.uint64(33)) % np.uint64(MEAN_CHUNK) == 0) + 1
                starts = np.array(_spaced(first.tolist(), (first + sizes).tolist(), wanted.tolist()), np.int64)
                lengths = np.diff(np.append(starts, len(h)))
                # A chunk's digest: its words' hashes weighted by powers of an odd number of their place in the chunk.
                place = np.arange(len(h)) - np.repeat(starts, lengths)
                digest = np.add.reduceat(h * _powers(np.full(len(h), 0xD6E8FEB86659FD93, np.uint64), place), starts)
                digest ^= digest >> np.uint64(31)
                digest *= np.uint64(0x94D049BB133111EB)
                chunks.append(((digest & ~np.uint64(0xFF)) | np.uint64(way << 7) | np.minimum(lengths, 127).astype(np.uint64)).view(np.int64))
            of.append(owner[starts])
        pairs, words = self.short_keys(h, first) if short else (None, None)
        if short and wanted_keys is None:
            at = self.looked_up(records, first)
            chunks.append(np.where(at < 0, words[~at], pairs[at]))
            of.append(owner[np.where(at < 0, ~at, at)])
        elif short:
            chunks += [pairs, words]
            of += [owner, owner]
        chunks, of = np.concatenate(chunks), np.concatenate(of)
        if wanted_keys is not None:
            slot = chunks.view(np.uint64) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)
            passed = (wanted_keys[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            chunks, of = chunks[passed], of[passed]
        order = np.lexsort((chunks, of))
        chunks, of = chunks[order], of[order]
        fresh = np.ones(len(chunks), bool)
        fresh[1:] = (chunks[1:] != chunks[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(fresh)
        return chunks[at], np.diff(np.append(at, len(chunks))), np.bincount(of[at], minlength=len(records)), bits.view(np.int64)

    @staticmethod
    def short_keys(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of each word with the one before it (of a record's first word: of no pair), and of each word; both without
        length. A pair's key ends in 0, a word's in 128."""
        with np.errstate(over="ignore"):
            pairs = h.copy()
            pairs[1:] += h[:-1] * np.uint64(_WAYS[0])
            pairs[first] = 0
            pairs ^= pairs >> np.uint64(32)
            pairs *= np.uint64(0x94D049BB133111EB)
            words = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return (pairs & ~np.uint64(0xFF)).view(np.int64), (words & ~np.uint64(0xFF) | np.uint64(128)).view(np.int64)

    @staticmethod
    def looked_up(records: list[list[str]], first: np.ndarray) -> np.ndarray:
        """Places of the pairs by which short records are looked up; of words as their complement."""
        out: list[int] = []
        for words, at in zip(records, first.tolist()):
            n = len(words)
            if n < 5:
                out.append(~(at + max(range(n), key=lambda i: len(words[i]))))
            elif n < SHORT:
                # Pairs of long words are met least; which pairs are taken doesn't matter otherwise.
                rarest = sorted(range(1, n), key=lambda i: -len(words[i - 1]) - len(words[i]))
                out += [at + i for i in rarest[: 2 * spare_words(n) + 1]]
        return np.array(out, np.int64)


def spare_words(n: int) -> int:
    """How many of ``n`` words may be missing."""
    return int(n * (1 - SAME) + 1e-9)


def _spaced(firsts: list[int], ends: list[int], wanted: list[int]) -> list[int]:
    """Where chunks start: at each record's first word, at wanted cuts that leave no chunk under LEAST_CHUNK, and where a chunk
    would have more words than its length can say."""
    out, k = [], 0
    for first, end in zip(firsts, ends):
        out.append(first)
        at = first
        while k < len(wanted) and wanted[k] < end:
            if wanted[k] - at >= LEAST_CHUNK:
                out += range(at + MOST_CHUNK, wanted[k], MOST_CHUNK)
                at = wanted[k]
                out.append(at)
            k += 1
        out += range(at + MOST_CHUNK, end, MOST_CHUNK)
        while k < len(wanted) and wanted[k] <= end:
            k += 1
    return out


def _powers(base: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    out, base, exponent = np.ones(len(base), np.uint64), base.copy(), exponent + 1
    while exponent.any():
        odd = (exponent & 1).astype(bool)
        out[odd] *= base[odd]
        base *= base
        exponent = exponent >> 1
    return out


CHUNKED = "row_id bigint, class binary, n_words int, chunks array<bigint>, times array<int>, b0 bigint, b1 bigint, b2 bigint, b3 bigint"


def _chunk(batches: Iterator[pa.RecordBatch], wanted_keys: np.ndarray | None = None, short: bool = True) -> Iterator[pa.RecordBatch]:
    chunker = Chunker()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            ids, classes, records = [], [], []
            for row_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = words_of(text)
                if words:
                    ids.append(row_id)
                    classes.append(xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass")))
                    records.append(words)
            if not ids:
                continue
            chunks, times, counts, bits = chunker.counted(records, wanted_keys, short)
            places = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists, repeats = pa.ListArray.from_arrays(places, pa.array(chunks)), pa.ListArray.from_arrays(places, pa.array(times.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(classes, pa.binary()), pa.array([len(w) for w in records], pa.int32()), lists, repeats, *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(4))],
                names=["row_id", "class", "n_words", "chunks", "times", "b0", "b1", "b2", "b3"],
            )


def chunked(records: DataFrame, wanted_keys: bytes | None = None, short: bool = True) -> DataFrame:
    """(row_id, class, n_words, chunks, bitmap in four columns) of each record (row_id, text) that has words."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _chunk(batches, None if wanted_keys is None else np.frombuffer(wanted_keys, np.uint8), short)

    return spread(records.select("row_id", "text").where("row_id is not null and text is not null")).mapInArrow(chunk, CHUNKED)


def key_filter(chunks: DataFrame) -> tuple[bytes, float]:
    """(bitmap of the first bits of all chunks, how full it is); it has FILTER_BITS bits whatever the data."""
    place = F.shiftrightunsigned("chunk", 64 - FILTER_BITS.bit_length() + 1) + 1
    with tidy(chunks.sparkSession):
        rows = chunks.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()  # at most FILTER_BITS / 32768 rows of 4 kB
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return out.tobytes(), float(np.bitwise_count(out).sum()) / FILTER_BITS


def share_in_order(words: list[str], other: list[str]) -> float:
    """The share of ``words`` that stand in ``other`` in the same order: bit-parallel longest common subsequence."""
    if not words:
        return 0.0
    full = (1 << len(words)) - 1
    at: dict[str, int] = {}
    for i, w in enumerate(words):
        at[w] = at.get(w, 0) | (1 << i)
    v = full
    for w in other:
        m = at.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return (len(words) - v.bit_count()) / len(words)


#: Groups of more pairs than this are compared by matrices, of so many evaluation records at a time.
_SMALL, _BLOCK = 2000, 512


def _compared(bits: np.ndarray, spare: np.ndarray, first: np.ndarray, middle: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(evaluation rows, training rows, groups) of pairs that may be true; group i has evaluation rows from first[i] to
    middle[i] and training rows from there to end[i]. A pair passes unless more words are missing than may be."""
    n_e, n_t = middle - first, end - middle
    small = np.flatnonzero((n_e * n_t > 0) & (n_e * n_t <= _SMALL))
    for at in range(0, len(small), 1000):
        g = small[at : at + 1000]
        count = n_e[g] * n_t[g]
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        g = np.repeat(g, count)
        e, t = first[g] + k // n_t[g], middle[g] + k % n_t[g]
        keep = np.bitwise_count(bits[e] & ~bits[t]).sum(axis=1) <= spare[e]
        yield e[keep], t[keep], g[keep]
    for i in np.flatnonzero(n_e * n_t > _SMALL):
        absent = 1 - np.unpackbits(bits[middle[i] : end[i]].view(np.uint8), axis=1).astype(np.float32).T
        for at in range(first[i], middle[i], _BLOCK):
            to = min(at + _BLOCK, middle[i])
            e, t = np.nonzero(np.unpackbits(bits[at:to].view(np.uint8), axis=1).astype(np.float32) @ absent <= spare[at:to, None] + 0.5)
            yield at + e, middle[i] + t, np.full(len(e), i)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs by chunk from rows sorted by chunk, evaluation rows before training rows ; ``spare`` holds how many
    words may be missing and above these, in the upper half, how often a record has the chunk; of training rows that alone,
    below 0. Between batches only the evaluation
    rows of the last chunk are kept."""
    kept = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        chunk, spare, ids, part, *b = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rows = [chunk, spare, ids, part, np.stack(b, axis=1).view(np.uint64)]
        if kept is not None:
            rows = [np.concatenate(x) for x in zip(kept, rows)]
        fresh = np.append(True, np.any([x[1:] != x[:-1] for x in rows[:4]], axis=0))
        fresh[0] = tuple(x[0] for x in rows[:4]) != last or kept is not None
        last = tuple(x[-1] for x in rows[:4])
        if not fresh.all():  # rows repeated whole
            rows = [x[fresh] for x in rows]
            if not len(rows[0]):
                continue
        chunk, spare, ids, part, bits = rows
        first = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (part[1:] != part[:-1])))
        end = np.append(first[1:], len(chunk))
        middle = first + np.add.reduceat(spare >= 0, first, dtype=np.int64)
        times, missing = np.where(spare >= 0, spare >> 32, -spare), spare & 0xFFFFFFFF
        for e, t, g in _compared(np.ascontiguousarray(bits), missing, first, middle, end):
            if len(e):
                both = chunk[first[g]]
                shared = (both & 127) * np.minimum(times[e], times[t])
                yield pa.RecordBatch.from_arrays([pa.array(ids[e]), pa.array(ids[t]), pa.array((both & 128) > 0), pa.array(shared)], names=["e_id", "t_id", "way", "words"])
        kept = [x[first[-1] : middle[-1]] for x in rows]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last_text, last = None, []
    for batch in batches:
        e, t, shared, a, b = (c.to_pylist() for c in batch.columns)
        share = np.zeros(len(e))
        for i, (x, y) in enumerate(zip(a, b)):
            if x != last_text:
                last_text, last = x, words_of(x)
            share[i] = share_in_order(last, words_of(y))
        keep = share >= SAME - 1e-9
        yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()), pa.array(t, pa.int64()), pa.array(shared, pa.int64()), pa.array(share)], names=["e_id", "t_id", "shared_words", "share"]).filter(pa.array(keep))


def _first_of_class(rows: DataFrame) -> DataFrame:
    """The row of the smallest ``row_id`` of each class; aggregated before its shuffle, so copies don't gather."""
    firsts = rows.groupBy("class").agg(F.min("row_id").alias("row_id")).select("row_id")
    return rows.join(firsts.hint("merge"), "row_id", "left_semi")


def _in_parts(ev: DataFrame, tr: DataFrame, ev_chunks: DataFrame, tr_chunks: DataFrame) -> DataFrame:
    """The chunk rows of both sides with the ``part`` of their chunk in which they meet.

    Most chunks have one part. Of those common on both sides, each evaluation row is in one row of a grid and each
    training row in one of its columns, and both are in all cells of these, so every pair meets in one cell."""
    chunk = F.explode("chunks").alias("chunk")
    # Only chunks that so many evaluation records have can be common enough; they alone are counted on the training side.
    least = HOT / max(tr.count(), 1)
    common = materialise(ev.select(chunk).groupBy("chunk").agg(F.count("*").alias("e")).where(F.col("e") > least), "overlap-common")
    rows = F.ceil(F.col("e") / HELD)
    columns = F.greatest(F.lit(1), F.least(F.col("t"), F.ceil(F.col("e") / rows * F.col("t") / HOT)))
    hot = common
    if common.limit(1).count():
        met = tr.select(chunk).join(common.select("chunk"), "chunk", "left_semi").groupBy("chunk").agg(F.count("*").alias("t"))
        hot = materialise(common.join(met, "chunk").where(F.col("e") * F.col("t") > HOT).select("chunk", rows.alias("grid_rows"), columns.alias("grid_columns")), "overlap-hot")
    if not hot.limit(1).count():
        return ev_chunks.unionByName(tr_chunks).select("chunk", "spare", "id", F.lit(0).cast("bigint").alias("part"), "b0", "b1", "b2", "b3")
    one = F.lit(1).cast("bigint")
    n_rows, n_columns = F.coalesce("grid_rows", one), F.coalesce("grid_columns", one)
    own = lambda n: F.pmod(F.xxhash64("id"), n)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    ev = ev_chunks.join(hot, "chunk", "left").withColumn("_column", upto(n_columns)).withColumn("part", own(n_rows) * n_columns + F.col("_column"))
    tr = tr_chunks.join(hot, "chunk", "left").withColumn("_row", upto(n_rows)).withColumn("part", F.col("_row") * n_columns + own(n_columns))
    columns = ["chunk", "spare", "id", "part", "b0", "b1", "b2", "b3"]
    return ev.select(*columns).unionByName(tr.select(*columns))


def same_classes(evaluation: DataFrame, training: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs of classes, members of evaluation classes, members of training classes).

    A class is all rows whose texts are equal after normalisation; it is named by its smallest ``row_id``. Pairs have
    (e_id, t_id, overlap, share): ``overlap`` is the sum of the lengths of all shared chunks over the evaluation record's
    words in the better of the two cuttings, ``share`` that of its words that stand in the training record in order.
    Members have (class_id, row_id). As tables of classes they stay small where copies abound.
    """
    ev = materialise(chunked(evaluation), "overlap-eval")
    ev_firsts = _first_of_class(ev)
    bits = [f"b{i}" for i in range(4)]
    entries = F.explode(F.arrays_zip("chunks", "times")).alias("c")
    missing = F.floor(F.col("n_words") * (1 - SAME) + 1e-9).cast("bigint")
    ev_chunks = ev_firsts.select(entries, missing.alias("m"), F.col("row_id").alias("id"), *bits).select(F.col("c.chunks").alias("chunk"), (F.col("m") + F.shiftleft(F.col("c.times").cast("bigint"), 32)).alias("spare"), "id", *bits)
    wanted_keys, full = key_filter(ev.select(F.explode("chunks").alias("chunk")))
    any_short = ev.where(F.col("n_words") < SHORT).limit(1).count() > 0
    tr = materialise(chunked(training, wanted_keys, any_short), "overlap-train")
    tr_firsts = _first_of_class(tr)
    columns = [F.col("c.chunks").alias("chunk"), (-F.col("c.times").cast("bigint")).alias("spare"), "id"]
    if full <= FULL:
        tr_chunks = tr_firsts.select(F.col("row_id").alias("id"), entries, *bits).select(*columns, *bits)
    else:
        # The bitmap holds too much back no more: chunks are joined alone, and bitmaps of words put to those that are met.
        # Neither side of these joins has a bound, so they are merged at every size.
        met = tr_firsts.select(F.col("row_id").alias("id"), entries).select(*columns).join(ev_chunks.select("chunk").distinct().hint("merge"), "chunk", "left_semi")
        tr_chunks = met.distinct().join(tr.select(F.col("row_id").alias("id"), *bits).dropDuplicates(["id"]).hint("merge"), "id").select("chunk", "spare", "id", *bits)
    pairs = materialise(
        _in_parts(ev, tr, ev_chunks, tr_chunks)
        .repartition("chunk", "part")
        .sortWithinPartitions("chunk", "part", F.col("spare").desc(), "id")
        .mapInArrow(_meet, "e_id bigint, t_id bigint, way boolean, words bigint")
        .groupBy("e_id", "t_id")
        .agg(F.greatest(F.sum(F.when(F.col("way"), F.col("words")).otherwise(0)), F.sum(F.when(F.col("way"), 0).otherwise(F.col("words")))).alias("shared_words")),
        "overlap-candidates",
    )
    texts = lambda df, key, name: df.select(F.col("row_id").alias(key), F.col("text").alias(name)).where(f"{key} is not null")
    settled = (
        pairs.join(texts(training, "t_id", "t_text"), "t_id")
        .join(texts(evaluation, "e_id", "e_text"), "e_id")
        .select("e_id", "t_id", "shared_words", "e_text", "t_text")
        .mapInArrow(_settle, "e_id bigint, t_id bigint, shared_words bigint, share double")
    )
    sizes = ev.select(F.col("row_id").alias("e_id"), "n_words").dropDuplicates(["e_id"])
    found = materialise(settled.join(sizes, "e_id").select("e_id", "t_id", (F.col("shared_words") / F.col("n_words")).alias("overlap"), "share").dropDuplicates(["e_id", "t_id"]), "overlap-pairs")
    members = lambda rows: rows.select("class", "row_id").distinct().join(rows.groupBy("class").agg(F.min("row_id").alias("class_id")), "class").select("class_id", "row_id")
    return found, members(ev), members(tr)


def same_records(evaluation: DataFrame, training: DataFrame) -> DataFrame:
    """(eval_row_id, train_row_id, overlap, share_in_order): every pair of rows that are the same record.

    ``evaluation`` and ``training`` have (row_id, text); other columns are ignored.  Null, empty and wordless texts are
    never cases; rows repeated whole count once; either table may be empty.  Copies on both sides give the product of
    their numbers, as each of these pairs is a case; ``same_classes`` has them once.
    """
    found, ev, tr = same_classes(evaluation, training)
    pairs = found.join(ev.select(F.col("class_id").alias("e_id"), F.col("row_id").alias("eval_row_id")), "e_id").join(tr.select(F.col("class_id").alias("t_id"), F.col("row_id").alias("train_row_id")), "t_id")
    return pairs.select("eval_row_id", "train_row_id", "overlap", F.col("share").alias("share_in_order"))


def by_split_and_source(pairs: DataFrame, evaluation: DataFrame, training: DataFrame) -> DataFrame:
    """(split, train_table, train_source, eval_records, train_records, pairs): the report per split and source."""
    e = evaluation.select(F.col("row_id").alias("eval_row_id"), "split").dropDuplicates(["eval_row_id"])
    t = training.select(F.col("row_id").alias("train_row_id"), "train_table", "train_source").dropDuplicates(["train_row_id"])
    return (
        pairs.join(e, "eval_row_id")
        .join(t, "train_row_id")
        .groupBy("split", "train_table", "train_source")
        .agg(F.countDistinct("eval_row_id").alias("eval_records"), F.countDistinct("train_row_id").alias("train_records"), F.count("*").alias("pairs"))
    )


def fractions(pairs: DataFrame, evaluation: DataFrame) -> DataFrame:
    """(split, eval_records, contaminated, mean_overlap, mean_share): how much of each split recurs, by the greatest overlap
    fraction and the greatest share in order of each evaluation record; records without a pair count with 0."""
    best = pairs.groupBy(F.col("eval_row_id").alias("row_id")).agg(F.max("overlap").alias("overlap"), F.max("share_in_order").alias("share"))
    rows = evaluation.select("row_id", "split").dropDuplicates(["row_id"]).join(best, "row_id", "left")
    return rows.groupBy("split").agg(F.count("*").alias("eval_records"), F.count("share").alias("contaminated"), F.avg(F.coalesce("overlap", F.lit(0.0))).alias("mean_overlap"), F.avg(F.coalesce("share", F.lit(0.0))).alias("mean_share"))
