import random
import unicodedata

import pytest

from tracewright.llm import overlap as op

SCHEMA = "row_id bigint, text string, chunk string, class string, split string"


def frame(spark, texts, start):
    return spark.createDataFrame([(start + i, t, "x", "y", "test") for i, t in enumerate(texts)], SCHEMA)


def brute(ev, tr, e0=1, t0=1001):
    out = []
    for i, a in enumerate(ev):
        words = op.words_of(a)
        for j, b in enumerate(tr):
            other = op.words_of(b)
            if words and other:
                # a plain table of common subsequences
                last = [0] * (len(other) + 1)
                for w in words:
                    row = [0]
                    for k, v in enumerate(other):
                        row.append(last[k] + 1 if w == v else max(row[-1], last[k + 1]))
                    last = row
                if last[-1] >= 0.8 * len(words) - 1e-9:
                    out.append((e0 + i, t0 + j))
    return sorted(out)


def got(spark, ev, tr):
    pairs = op.same_records(frame(spark, ev, 1), frame(spark, tr, 1001)).collect()
    return sorted((r.eval_row_id, r.train_row_id) for r in pairs)


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    ev = [sentence(rng, rng.randrange(30, 90)) for _ in range(60)]
    tr = [sentence(rng, rng.randrange(20, 90)) for _ in range(150)]
    for e in ev[:30]:
        tr.append(sentence(rng, 20) + " " + edited(rng, e, rng.choice([0.0, 0.02, 0.05, 0.1])) + " " + sentence(rng, 5))
    tr += [ev[0]] * 5 + [" ".join(ev[1].split()[:20])]
    assert got(spark, ev, tr) == brute(ev, tr)


def test_forms_are_left_aside(spark):
    e = "Über the naïve Café: “Restart the Flow” — and wait for node-7, please, before you go on with it"
    forms = [e.upper(), unicodedata.normalize("NFD", e), f"<p><b>{e}</b></p>", e.replace(" ", " \n "), "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in e), e.replace("the", "t​he"), e.replace("“", "&ldquo;")]
    assert got(spark, [e], forms) == [(1, 1001 + i) for i in range(len(forms))]


def test_shared_phrases_are_no_case(spark):
    rng = random.Random(4)
    phrases = [sentence(rng, 8, 50) for _ in range(6)]
    text = lambda: " ".join(rng.choice(phrases) + f" u{rng.randrange(10**6)} u{rng.randrange(10**6)} u{rng.randrange(10**6)}" for _ in range(5))
    ev, tr = [text() for _ in range(20)], [text() for _ in range(200)]
    assert got(spark, ev, tr) == brute(ev, tr)


def test_nothing_but_stock_phrases_and_hot_copies(spark):
    stock = ["we thank you for your message and will answer soon", "the meeting has been moved to the large room upstairs"]
    ev = [stock[0], " ".join(stock), stock[0]]
    tr = [stock[0]] * 60 + [" ".join(stock)] * 30 + [stock[0] + f" regards {i}" for i in range(80)]
    assert got(spark, ev, tr) == brute(ev, tr)


def test_near_copies_are_met_however_many_there_are(spark):
    rng = random.Random(11)
    e = sentence(rng, 42)
    replaced = lambda: " ".join(f"new{rng.randrange(10**6)}" if i in out else w for i, w in enumerate(e.split())) if (out := set(rng.sample(range(42), 8))) else e
    tr = [replaced() for _ in range(300)]
    chunks, counts, _ = op.Chunker().batch([op.words_of(x) for x in [e, *tr]])
    of = [set(chunks[sum(counts[:i]) : sum(counts[: i + 1])].tolist()) for i in range(len(counts))]
    meet = [p for p in brute([e], tr) if of[0] & of[p[1] - 1000]]
    assert len(meet) > 280 and got(spark, [e], tr) == meet
    # each alone in its table gives the same
    assert all(got(spark, [e], [tr[t - 1001]]) for _, t in meet[:3])


def changed(rng, words, n):
    """The words with n edits: replaced, removed, or another put before."""
    out = list(words)
    for i in sorted(rng.sample(range(len(words)), n), reverse=True):
        kind = rng.randrange(3)
        out[i : i + 1] = [f"new{rng.randrange(10**9)}"] if kind == 0 else [] if kind == 1 else [f"new{rng.randrange(10**9)}", out[i]]
    return out


def test_recall_by_length(spark):
    """Records of 1 to 200 words with up to a fifth of them edited at random places: the share of true pairs that is found."""
    rng = random.Random(21)
    ev, tr = [], []
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 25, 30, 39, 45, 60, 100, 200]:
        for _ in range(40):
            words = sentence(rng, n, 10**6).split()
            ev.append(" ".join(words))
            tr.append(" ".join([*sentence(rng, 3, 10**6).split(), *changed(rng, words, rng.randrange(op.spare_words(n) + 1)), *sentence(rng, 3, 10**6).split()]))
    found = set(got(spark, ev, tr))
    true = [(1 + i, 1001 + i) for i, (a, b) in enumerate(zip(ev, tr)) if op.share_in_order(op.words_of(a), op.words_of(b)) >= 0.8 - 1e-9]
    short = [p for p in true if len(ev[p[0] - 1].split()) < op.SHORT]
    assert len(true) > 750 and found >= set(short)
    assert len(found & set(true)) / len(true) > 0.995


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rng = random.Random(8)
    ev = [sentence(rng, rng.randrange(8, 60)) for _ in range(50)]
    tr = [" ".join(changed(rng, e.split(), 1)) for e in ev] + [sentence(rng, 30) for _ in range(50)]
    first = got(spark, ev, tr)
    monkeypatch.setattr(op, "FULL", -1.0)
    assert got(spark, ev, tr) == first == brute(ev, tr)


@pytest.mark.parametrize("hot,held", [(20, 1000), (50, 7), (1, 1)])
def test_common_chunks_are_cut_into_parts(spark, monkeypatch, hot, held):
    rng = random.Random(6)
    stock = sentence(rng, 12)
    ev = [stock + " " + sentence(rng, 30) for _ in range(25)]
    tr = [stock + " " + sentence(rng, 30) for _ in range(60)] + [" ".join(changed(rng, e.split(), 2)) for e in ev]
    whole = [tuple(r) for r in op.same_records(frame(spark, ev, 1), frame(spark, tr, 1001)).orderBy("eval_row_id", "train_row_id").collect()]
    monkeypatch.setattr(op, "HOT", hot)
    monkeypatch.setattr(op, "HELD", held)
    parts = [tuple(r) for r in op.same_records(frame(spark, ev, 1), frame(spark, tr, 1001)).orderBy("eval_row_id", "train_row_id").collect()]
    assert parts == whole and [p[:2] for p in whole] == brute(ev, tr)


def test_runs_of_one_word_count_whole(spark):
    e = "start " + "la " * 900 + "end of it"
    [r] = op.same_records(frame(spark, [e], 1), frame(spark, [e + " more"], 1001)).collect()
    assert r.share_in_order == 1.0 and r.overlap > 0.85


def test_classes_hold_copies_once(spark):
    ev, tr = frame(spark, ["alpha beta gamma delta"] * 3, 1), frame(spark, ["alpha beta gamma delta"] * 20 + ["Alpha, beta gamma delta!", "alpha beta gamma delta more"], 1001)
    found, e, t = op.same_classes(ev, tr)
    assert sorted((r.e_id, r.t_id, r.share) for r in found.collect()) == [(1, 1001, 1.0), (1, 1022, 1.0)]
    assert e.count() == 3 and t.groupBy("class_id").count().orderBy("class_id").collect()[0]["count"] == 21
    assert op.same_records(ev, tr).count() == 66


def test_fractions(spark):
    ev, tr = frame(spark, ["alpha beta gamma delta", "none of this", None], 1), frame(spark, ["alpha beta gamma delta"], 1001)
    assert [tuple(r) for r in op.fractions(op.same_records(ev, tr), ev).collect()] == [("test", 3, 1, pytest.approx(1 / 3), pytest.approx(1 / 3))]


def test_edges(spark):
    assert got(spark, [None, "", "...", "one two three"], [None, "", "!", "one two three"]) == [(4, 1004)]
    assert got(spark, [], ["a"]) == [] and got(spark, ["a"], []) == []
    long = sentence(random.Random(1), 30_000, 10**6)
    assert got(spark, [long], [long + " end", "short"]) == [(1, 1001)]
    one = frame(spark, ["same text here again"], 1)
    other = frame(spark, ["same text here again", "not it"], 1001)
    again = op.same_records(one.union(one), other.union(other)).collect()
    assert [(r.eval_row_id, r.train_row_id, r.overlap) for r in again] == [(1, 1001, 1.0)]


def test_overlap_of_a_pair_is_the_same_in_any_table(spark):
    rng = random.Random(5)
    e = sentence(rng, 60)
    copies = [e + " " + sentence(rng, 4) for _ in range(40)]
    overlap = lambda tr: op.same_records(frame(spark, [e], 1), frame(spark, tr, 1001)).where("train_row_id = 1001").first().overlap
    assert overlap(copies[:1]) == overlap(copies) > 0.8


def test_report(spark):
    ev, tr = frame(spark, ["alpha beta gamma delta"], 1), frame(spark, ["alpha beta gamma delta"] * 2, 1001).selectExpr("row_id", "text", "'t' as train_table", "'s' as train_source")
    r = op.by_split_and_source(op.same_records(ev, tr), ev, tr).collect()
    assert [tuple(x) for x in r] == [("test", "t", "s", 1, 2, 2)]


def test_small_tables(spark, small):
    from tracewright.llm import queries

    ev = queries._evaluation(spark, small).select("row_id", "text").collect()
    tr = queries._training(spark, small).select("row_id", "text").collect()
    ew, tw = [(r.row_id, op.words_of(r.text)) for r in ev], [(r.row_id, op.words_of(r.text)) for r in tr]
    expected = sorted((i, j) for i, a in ew for j, b in tw if a and b and op.share_in_order(a, b) >= 0.8)
    assert sorted(map(tuple, queries.p1_found(spark, small).collect())) == expected
