import random

import numpy as np
import pytest

from tracewright.llm import bpe, mixing, tokens

SCHEMA = "doc_id bigint, text string, source string, ids array<int>, n_tokens int"


@pytest.fixture(scope="module")
def encoder():
    with open(f"{tokens.TOKENIZERS}/byte_bpe_50k.json", "rb") as f:
        return bpe.Encoder(f.read())


@pytest.fixture(scope="module")
def public():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts)]


def noise(rng):
    alphabets = ["ab", "abc  \n\t'", "the aéè中文\U0001f600́", "0123456789 .", "'s't're've'm'll'd ", "   \n\r", "".join(map(chr, range(32, 127)))]
    return "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60)))


def test_equals_the_public_tokenizer_on_noise(encoder, public):
    rng = random.Random(5)
    texts = [noise(rng) for _ in range(4000)] + ["<|endoftext|>", "a" * 5000, " " * 3000, "ab" * 3000, "\n" * 500]
    assert split(*encoder.encode(texts)) == public(texts)
    assert encoder.failed > 0  # exact merging was needed for some


def test_both_ways_of_splitting_agree(encoder):
    text = "".join(chr(i) + chr(j) for i in range(128) for j in range(128)) + " don't we'll I'm ' 's  \n x"
    assert bpe.ASCII_WORDS(text) == encoder.split(text)


def test_every_token_is_its_own_encoding(encoder):
    rng = random.Random(1)
    for word, i in rng.sample(sorted(encoder.ids.items()), 4000):
        assert encoder.exact(word) == [i]


def test_compatibility_is_what_exact_merging_says(encoder):
    rng = np.random.default_rng(2)
    back = {i: w for w, i in encoder.ids.items()}
    a, b = rng.choice(list(back), 6000), rng.choice(list(back), 6000)
    assert encoder.compatible(a, b).tolist() == [encoder.exact(back[x] + back[y]) == [x, y] for x, y in zip(a, b)]


def test_pieces_of_long_texts_change_nothing(encoder, public, monkeypatch):
    rng = random.Random(9)
    text = " ".join(noise(rng) for _ in range(300))
    monkeypatch.setattr(bpe, "PIECE", 50)
    assert "".join(encoder.pieces(text)) == text
    assert split(*encoder.encode([text, None, "", text])) == [*public([text]), [], [], *public([text])]
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    assert split(*encoder.encode([text])) == public([text])


def test_whole_table(spark, small, public):
    import pyarrow.parquet as pq

    docs = pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = dict(zip((r["doc_id"] for r in docs), public([r["text"] or "" for r in docs])))
    assert {r.doc_id: r.ids for r in tokens.token_ids(spark.read.parquet(f"{small}/documents.parquet")).collect()} == expected


def test_null_empty_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "a", None, 5), (2, "", "a", None, 5), (3, "hi there", None, None, 5), (3, "hi there", "b", None, 5)], SCHEMA)
    rows = sorted((r.doc_id, len(r.ids)) for r in tokens.token_ids(df).collect())
    assert rows == [(1, 0), (2, 0), (3, 2), (3, 2)] and tokens.token_ids(df.where("false")).count() == 0


TARGETS = "source string, target_share double, max_repeats int"


def mixture(spark, rows, targets, **kw):
    docs = spark.createDataFrame(rows, SCHEMA)
    return mixing.mixed(docs, spark.createDataFrame(targets, TARGETS), **kw)


def test_shares_are_met_and_repeats_capped(spark):
    rng = random.Random(3)
    sizes = {"big": 300, "mid": 60, "tiny": 12, "off": 50}
    rows = [(i * 10 + k, " ".join(["word"] * rng.randrange(1, 30)), s, None, 0) for k, (s, n) in enumerate(sizes.items()) for i in range(n)] + [(99_999, "word", None, None, 0), (99_998, None, "big", None, 0), (99_997, "", "tiny", None, 0)]
    targets = [("big", 0.6, 2), ("mid", 0.3, 3), ("tiny", 0.1, 4), ("absent", 0.2, 2)]
    m = mixture(spark, rows, targets).cache()
    got = {r.source: r for r in mixing.shares(m, spark.createDataFrame(targets, TARGETS)).collect()}
    for s, share in (("big", 0.6), ("mid", 0.3), ("tiny", 0.1)):
        assert got[s].actual_share == pytest.approx(share, abs=0.02) and got[s].most_repeats <= dict((t[0], t[2]) for t in targets)[s]
    assert got["absent"].used_tokens == 0 and "off" not in got
    for s in sizes:  # complete epochs come first: no document is used two times more than another of its source
        used = [r.repeats for r in m.where(f"source = '{s}'").collect()]
        assert not used or max(used) - min(used) <= 1
    assert sorted(map(tuple, m.collect())) == sorted(map(tuple, mixture(spark, rows, targets).collect()))


@pytest.mark.parametrize("edge", [20_000, 40, 3])
def test_cut_ranges_give_what_sorting_everything_gives(spark, monkeypatch, edge):
    """Against drawing from one sorted list: the same documents before the last range, and budgets met."""
    monkeypatch.setattr(mixing, "EDGE", edge)
    monkeypatch.setattr(mixing, "BINS", 16)
    rng = random.Random(5)
    rows = [(i, " ".join(["word"] * rng.randrange(1, 12)), rng.choice("ab"), None, 0) for i in range(900)] + [(7777, "some words", "a", None, 0)] * 200
    docs = spark.createDataFrame(rows, SCHEMA)
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.7, 2)], TARGETS)
    keyed = mixing.weighed(docs, targets).toPandas().sort_values(["sort_key", "doc_id"])
    m = mixing.mixed(docs, targets, total=3000).toPandas()
    for source, budget in (("a", 900), ("b", 2100)):
        own = keyed[keyed.source == source]
        upto = own.n_tokens.cumsum()
        used = m[m.source == source]
        assert abs((used.n_tokens * used.repeats).sum() - budget) <= (1 if edge > 1000 else 6)  # half a document of the range at most
        certain = own[upto <= budget - (300 if edge > 1000 else 60)]
        assert set(certain.doc_id) <= set(used.doc_id)


def test_more_targets_than_are_broadcast_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TARGETS", 1)
    with pytest.raises(ValueError):
        mixture(spark, [(1, "a", "s", None, 0)], [("s", 0.5, 1), ("t", 0.5, 1)])


def test_weights_are_followed(spark):
    """Dense prose is drawn before dumps that compress badly."""
    rows = [(i, "plain english words stand here " * 4, "s", None, 0) for i in range(200)] + [(1000 + i, "x9Q" + "!#@8" * 30, "s", None, 0) for i in range(200)]
    chosen = [r.doc_id for r in mixture(spark, rows, [("s", 1.0, 1)], total=4000).collect()]
    assert sum(d < 1000 for d in chosen) > 2 * sum(d >= 1000 for d in chosen) > 0


def test_empty_inputs(spark):
    assert mixture(spark, [], [("s", 1.0, 1)]).count() == 0
    assert mixture(spark, [(1, "a", "s", None, 0)], []).count() == 0
    assert mixture(spark, [(1, None, "s", None, 0)], [("s", 1.0, 1)]).count() == 0
    assert [r.repeats for r in mixture(spark, [(1, "a b", "s", None, 0), (1, "a b", "s", None, 0)], [("s", 1.0, 2)]).collect()] == [2, 2]
