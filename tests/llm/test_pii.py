import pytest

from tracewright.llm import pii as op
from tracewright.llm import pii_training

F = op.Finder()
CASES = [
    ("Send corrections to joran_marlow@cs.lumenfold.test or text +33 6 39 98 02 07.", [("joran_marlow@cs.lumenfold.test", "email"), ("+33 6 39 98 02 07", "phone")]),
    ("mail saskia+nb1 AT mail.brindlecove DOT example now", [("saskia+nb1 AT mail.brindlecove DOT example", "email")]),
    ("write to lorski15(at)pellworth-uni.test please", [("lorski15(at)pellworth-uni.test", "email")]),
    ("Row 14 belongs to Felix M. Grimmora (phone 642.555.0163, social security number: 991 84 7585).", [("Felix M. Grimmora", "name"), ("642.555.0163", "phone"), ("991 84 7585", "id_number")]),
    ("Ship the sensor back to Luis Zabholt, 35 bis rue des Tilleuls, 99227 Valmont.", [("Luis Zabholt", "name"), ("35 bis rue des Tilleuls, 99227 Valmont", "address")]),
    ('contact = dict(name="Joran Ebbstad", phone="+34 626 741 231", address="1892 Orchard Ave, Kilmory, VT 00674")', [("Joran Ebbstad", "name"), ("+34 626 741 231", "phone"), ("1892 Orchard Ave, Kilmory, VT 00674", "address")]),
    ("Call +1-742-555-0104 before rerunning the export; ask for Ms Osteridis.", [("+1-742-555-0104", "phone"), ("Osteridis", "name")]),
    ("WARN duplicate person Thavinski, Mirela / DNI 28113046P", [("Thavinski, Mirela", "name"), ("28113046P", "id_number")]),
    ("# TODO RONDRICK Freya wants the session split by week", [("RONDRICK Freya", "name")]),
    ("1\t21 Bramble Road, Pellworth QX3 3ZD\t+44 20 7946 0766\tkoronne87@mail.pellworth-uni.test", [("21 Bramble Road, Pellworth QX3 3ZD", "address"), ("+44 20 7946 0766", "phone"), ("koronne87@mail.pellworth-uni.test", "email")]),
    ("Flat 4, 11 Thistle Ave, Sundvik QX3 3ZD", [("Flat 4, 11 Thistle Ave, Sundvik QX3 3ZD", "address")]),
]
NONE = ["Clone git@forge.theapluv.invalid:lofleas/voleal.git and install version 0.17.7.", "We compare a Random Forest with Naive Bayes on the Kestrel Ridge station data.", "The Copper Lantern corpus holds 27 recordings, the Northern Heron set only 29.", "Pressure rose from 1013.50 to 1021.30 hPa over 12 300 456 samples.", "Run 20260914-1132-57 replaced ticket 26-21-0042; the ISBN is 978-0-00-4877-4.", "The server 10.0.36.58 listens on port 858; build 2026029-1123 is enough.", "See Table 2, Row 15; the seed is 38 and the order no. is 47-59-32.", "Main Loop, Step 31: call @cached functions first.", "0  0.5652  36.1301  3939889771", "Monte Carlo error shrinks slowly", "", None]


def spans(text):
    return [(text[a:b], k) for a, b, k in F(text)]


@pytest.mark.parametrize("text,expected", CASES)
def test_found(text, expected):
    assert spans(text) == expected


@pytest.mark.parametrize("text", NONE)
def test_nothing(text):
    assert F(text) == []


def test_offsets_in_stored_notebooks():
    text = '{"cells": [{"source": "# x\\nAuthor: Nadia L. Tovholt\\n"}, {"text": "0\\tZola Veskdal\\t+34 629 446 530\\n"}]}\nAuthor: Rafael Tamaya'
    assert [s for s, _ in spans(text)] == ["Nadia L. Tovholt", "Zola Veskdal", "+34 629 446 530", "Rafael Tamaya"]


def test_placeholders():
    assert op.replaced("Author: Rafael Tamaya (a.b@c.example)", F) == "Author: [NAME] ([EMAIL])"
    assert op.replaced(None, F) is None and op.replaced("", F) == ""


#: One line for each alternative of the generators that the gates once left out.
OPENED = [
    ("maintainer: Ana de Souza", "Ana de Souza"), ("owner = Jan van der Berg", "Jan van der Berg"), ("ask Dr. van Dijk", "van Dijk"), ("by Smith, J.", "Smith, J."), ("reviewer: Zorblax Quillen", "Zorblax Quillen"), ("-Dr. Osteridis", "Osteridis"), ("me{at}cs.lumenfold.test", "me{at}cs.lumenfold.test"), ("me(arroba)cs.lumenfold.test", "me(arroba)cs.lumenfold.test"),
    *((f"at {a}", a) for a in ("12 impasse Valmont", "3 quai Valmont", "8 route Valmont", "5 cours Valmont", "Lindenring 4", "Kaiserdamm 12", "Elbufer 3", "Neumarkt 9", "Bornchaussee 7", "C/ Valmont 3", "Av. Valmont 3", "Camino Valmont 3", "Viale Valmont 3", "Piazza Valmont 3", "Corso Valmont 3", "Travessa Valmont 3", "Praça Valmont 3", "Linden Ring 4")),
    ("passport no. CFGHJK123", "CFGHJK123"), ("+33 6 39 98 02 07", "+33 6 39 98 02 07"), ("0033 639 980 207", "0033 639 980 207"), ("NIR 1 85 05 2A 123 456", "1 85 05 2A 123 456"),
]


@pytest.mark.parametrize("line,mention", OPENED)
def test_gates_let_every_generator_through(line, mention):
    assert mention in {line[a:b] for a, b, *_ in op.candidates(line)}
    assert op.maybe(line)


def test_every_line_with_candidates_passes_the_gate():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    lines = {x.replace("\\t", "  ").replace('\\"', ' "') for t in texts if t for x in op._LINES.split(t)}
    assert [x for x in lines if not op.maybe(x) and op.candidates(x)] == []


def test_names_written_with_particles_and_initials():
    assert spans("maintainer: Ana de Souza") == [("Ana de Souza", "name")]
    assert spans("owner = Jan van der Berg") == [("Jan van der Berg", "name")]
    assert spans("Ana Li") == [("Ana Li", "name")]


def test_long_lines_take_linear_time():
    import time

    began = time.perf_counter()
    for text in ("aB3/x-9+" * 40_000, "1 " * 100_000, "Ab " * 100_000, "a@" * 100_000, "12, Rue " * 20_000, "+1 " * 50_000, "A1" * 100_000):
        F(text)
    assert time.perf_counter() - began < 40


def best(line, weights):
    """The best segmentation by trying all sets of candidates that don't overlap."""
    found = [(a, b, k, op.score(f, weights)) for a, b, k, f in op.candidates(line)]
    top = 0.0
    for bits in range(1 << len(found)):
        chosen = sorted(c for i, c in enumerate(found) if bits >> i & 1)
        if all(x[1] <= y[0] for x, y in zip(chosen, chosen[1:])):
            top = max(top, sum(c[3] for c in chosen))
    return top


@pytest.mark.parametrize("text", [t for t, _ in CASES if t])
def test_dynamic_programming_is_optimal(text):
    weights = op.trained_weights()
    if len(op.candidates(text)) <= 14:
        score: dict = {}
        for a, b, k, f in op.candidates(text):
            score[a, b, k] = max(op.score(f, weights), score.get((a, b, k), -99.0))
        assert sum(score[s] for s in op.segment(text, weights)) == pytest.approx(best(text, weights), abs=0.01)


def test_training_learns_from_labelled_lines():
    lines = [(f"Author: Nadia Tov{c}olt and Kestrel Ridge", {(8, 21, "name")}) for c in "abcdefgh"] + [("# Ruth Forest", set())] * 8
    weights = op.fit(lines, rounds=30)
    assert op.segment("Author: Ruth Veskmann", weights) == [(8, 21, "name")]
    assert op.segment("# Ruth Forest", weights) == []


def test_labels_come_from_structure(small):
    text = "idx | name | email\n0 | Ruth Tovash | r@x.example\n1 | NaN | q@x.example\nend"
    got = dict(pii_training.labelled(text))
    assert {(s[s.index("Ruth") : s.index("Ruth") + 11]) for s in got if "Ruth" in s} == {"Ruth Tovash"}
    assert got["0 | Ruth Tovash | r@x.example"] == {(4, 15, "name"), (18, 29, "email")} and got["1 | NaN | q@x.example"] == {(10, 21, "email")}


def held_out():
    """Labelled lines of documents that training leaves out, which aren't among its lines either."""
    import pyarrow.parquet as pq

    seen, _ = pii_training.sample("/root/testdata/sf0.1")
    documents = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"])
    lines = {line: gold for doc_id, text in zip(*(c.to_pylist() for c in documents.columns)) if doc_id % pii_training.HELD_OUT == 0 for line, gold in pii_training.labelled(text or "") if gold}
    return {line: gold for line, gold in lines.items() if line not in seen}


def test_held_out_accuracy():
    """Table cells under a header, of documents that training never saw, by exact span."""
    right = wanted = found = 0
    for line, gold in held_out().items():
        if line[:1].isdigit():
            got = set(op.segment(line, F.weights))
            right, wanted, found = right + len(got & gold), wanted + len(gold), found + len(got)
    assert wanted > 1000 and right / wanted > 0.97 and right / found > 0.97


def test_names_outside_the_list():
    """Held-out lines whose given names are replaced by names the list lacks."""
    others = ["Zbigniew", "Anneliese", "Ngozi", "Thandiwe", "Xiomara", "Bogdan", "Sunniva", "Oisin"]
    assert not set(others) & op.GIVEN
    right = wanted = 0
    for n, (line, gold) in enumerate(held_out().items()):
        for a, b, kind in gold:
            given = line[a:b].split(" ")[0]
            if kind == "name" and given in op.GIVEN:
                other = others[n % len(others)]
                got = op.segment(line[:a] + other + line[a + len(given) :], F.weights)
                wanted, right = wanted + 1, right + ((a, b + len(other) - len(given), kind) in got)
    print(f"names outside the list: {right} of {wanted} found")
    assert wanted > 500 and right / wanted > 0.8


UNHEARD = [("Ask Zbigniew Brzezinski about it.", "Zbigniew Brzezinski"), ("We met Anneliese Okonkwo yesterday.", "Anneliese Okonkwo"), ("Contact Ngozi Adichie", "Ngozi Adichie"), ("Dr. Li", "Li"), ("Dr. Li is in", "Li")]


@pytest.mark.parametrize("text,name", UNHEARD)
def test_names_by_shape_and_context(text, name):
    assert spans(text) == [(name, "name")]


@pytest.mark.parametrize("text", ["The Amber Falcon corpus holds 27 recordings, the Western Osprey set only 29.", "We compare a Quick Sort with Simple Merge on the Falcon Creek station data.", "Total Sum, Item 7: call @cached first.", "ask the Silver Pine team"])
def test_phrases_in_capitals_are_no_names(text):
    assert F(text) == []


def test_an_address_over_a_line_end():
    assert spans("Ship to 12 Willowmere Terrace,\nKilmory, VT 00674 now") == [("12 Willowmere Terrace,\nKilmory, VT 00674", "address")]
    assert spans("35 bis rue des Tilleuls\\n99227 Valmont\\n") == [("35 bis rue des Tilleuls\\n99227 Valmont", "address")]
    assert [k for _, k in spans("11 Thistle Ave\n+44 20 7946 0766")] == ["address", "phone"] or [k for _, k in spans("11 Thistle Ave\n+44 20 7946 0766")] == ["phone"]


def test_tables(spark):
    schema = "doc_id bigint, text string, start_char int, pii_type string"
    df = spark.createDataFrame([(1, None, 0, "x"), (2, "", 0, "x"), (3, "é" * 50_000 + "\nAuthor: Rafael Tamaya", 0, "x"), (3, "é" * 50_000 + "\nAuthor: Rafael Tamaya", 0, "x")], schema)
    assert [tuple(r) for r in op.mentions(df).collect()] == [(3, 50_009, 50_022, "name")] * 2
    assert op.with_placeholders(df).count() == 4 and op.mentions(df.where("false")).count() == 0
