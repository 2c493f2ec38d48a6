"""Labelled lines for the segment model, and its training.

Labels come from the documents' own structure: cells under a table header that names their type, arguments that are
named after their type, numbers after the name of their kind, and lines without anything that could begin a mention.
Run ``python -m tracewright.llm.pii_training FOLDER`` to write ``pii_weights.py`` anew from at most ``SAMPLE`` lines.
Documents whose id is divisible by ``HELD_OUT`` are left out of training, to measure it on.
"""

from __future__ import annotations

import re
import sys

from tracewright.llm import pii

#: At most so many labelled lines are used.
SAMPLE = 6000
HELD_OUT = 5
_HEADER = {"email": pii.EMAIL, "mail": pii.EMAIL, "phone": pii.PHONE, "address": pii.ADDRESS, "name": pii.NAME}
_ARGUMENT = re.compile(r"""\b(name|phone|address|email|mail|user)["']?\s*[=:]\s*["']([^"']+)["']""")
_NUMBERED = re.compile(r"\b(?:CPF|DNI|NIR|PESEL:?|SSN|NI number|Steuer-ID|passport no\.?|social security number:?) ([A-Z0-9][A-Z0-9.\- ]*[A-Z0-9])(?=[\"'/),;.]|$| (?:liegt|\())")
_QUIET = re.compile(r"\w@\w|[\[({ ][aA][tT][\])} ]|\+\d|\d{3}[).\-] ?\d{3}|" + pii._ID_LABEL.pattern.replace(r")$", ")") + "|" + rf"\b{pii._TITLE}\.? [A-Z]|" + pii._STREETLIKE.pattern, re.I)


def labelled(text: str) -> list[tuple[str, set[tuple[int, int, str]]]]:
    """The labelled lines of one document."""
    out: list[tuple[str, set[tuple[int, int, str]]]] = []
    header: list[str] | None = None
    gap = ""
    for raw in pii._LINES.split(text):
        line = raw.replace("\\t", "  ").replace('\\"', ' "')
        cells = re.split(r" \| |\t|  +", line.strip())
        if cells and cells[0].endswith("idx") and all(c in _HEADER for c in cells[1:]) and len(cells) > 1:
            header, gap = cells, " | " if " | " in line else "\t" if "\t" in line else "  "
            continue
        if header:
            if re.match(r"\d+(?: \||\t|  )", line.strip()) and len(cells) == len(header):
                gold, at = set(), 0
                for name, cell in zip(header, cells):
                    at = line.index(cell, at)
                    if name in _HEADER and cell != "NaN":
                        gold.add((at, at + len(cell), _HEADER[name]))
                    at += len(cell)
                out.append((line, gold))
                continue
            header = None
        named = [(m.start(2), m.end(2), pii.NAME if m.group(1) == "user" else _HEADER[m.group(1)]) for m in _ARGUMENT.finditer(line) if not re.search(r"\.\w{2,4}$", m.group(2)) or "@" in m.group(2)]
        if "dict(" in line and named:
            out.append((line, set(named)))
            continue
        if pii._NAMED.search(line) is None and len(line) < 300:
            numbered = {(m.start(1), m.end(1), pii.ID) for m in _NUMBERED.finditer(line)}
            rest = re.sub(r"\b(?:git|hg|svn|ssh)@\S+", "", _NUMBERED.sub("", line))
            if not _QUIET.search(rest):
                out.append((line, numbered))
        elif len(line) < 300:
            out += _prose(line)
    return out


def _prose(line: str) -> list[tuple[str, set[tuple[int, int, str]]]]:
    """A sentence with a given name: the longest span of each place that has no doubtful feature is its label."""
    gold: set[tuple[int, int, str]] = set()
    doubtful = {"name:common", "name:oddmiddle", "name:unknown", "name:unheard", "name:heading", "name:glued", "name:givenlast", "name:split", "email:login", "email:loose", "phone:idlabel", "address:more", "id:phonelabel", "address:dot"}
    distinct = {"id:cpf", "id:nino", "id:nir", "id:dni"}
    for a, b, kind, f in sorted(pii.candidates(line), key=lambda c: c[0] - c[1]):
        if doubtful & f.keys() or any(a < y and x < b for x, y, _ in gold):
            continue
        if kind == pii.ID and not ("id:label" in f or distinct & f.keys() or "/" in line[max(0, a - 2) : a]) or kind == pii.PHONE and not {"phone:label", "phone:plus", "phone:area", "phone:zeros"} & f.keys():
            continue
        if kind == pii.ADDRESS and not {"address:state", "address:postcode", "address:before1"} & f.keys():
            continue
        gold.add((a, b, kind))
    return [(line, gold)]


def sample(folder: str) -> tuple[dict[str, set[tuple[int, int, str]]], int]:
    """The lines training uses and how many of them have no mention; these are at most a third of ``SAMPLE``."""
    import pyarrow.parquet as pq

    lines: dict[str, set[tuple[int, int, str]]] = {}
    quiet = 0
    documents = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    for doc_id, text in zip(*(c.to_pylist() for c in documents.columns)):
        for line, gold in labelled(text or "") if doc_id % HELD_OUT else ():
            if line in lines or not gold and (quiet > SAMPLE // 3 or not pii.candidates(line)):
                continue
            quiet += not gold
            lines[line] = gold
        if len(lines) >= SAMPLE:
            break
    return dict(list(lines.items())[:SAMPLE]), quiet


def main(folder: str) -> None:
    lines, quiet = sample(folder)
    weights = pii.fit(list(lines.items()), blind=3)
    path = pii.__file__.replace("pii.py", "pii_weights.py")
    with open(path, "w") as f:
        f.write('"""Weights of the segment model, written by pii_training."""\n\n#: Fixed values: what training gave.\nTRAINED: dict[str, float] = {\n')
        f.writelines(f'    "{k}": {v},\n' for k, v in weights.items())
        f.write("}\n")
    print(len(lines), "lines,", quiet, "without mentions;", len(weights), "weights")


if __name__ == "__main__":
    main(sys.argv[1])
