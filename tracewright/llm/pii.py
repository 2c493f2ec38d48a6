"""Personal information in free text: a semi-Markov conditional random field over candidate segments.

A line is segmented jointly: candidate segments (start, end, type) of bounded length come from generators that propose
several boundaries for the same place, every candidate is scored by features of the whole span and of what surrounds
it, and bounded-entity dynamic programming finds the best segmentation; text outside entities scores nothing.  The
weights maximise the conditional likelihood of labelled lines (``fit``, with the forward-backward recursions over the
same lattice); ``pii_weights`` holds what it gave for rows of tables whose header names their columns, sentences with labels,
and lines without any.

Notebooks are stored as JSON in part, so ``\\n`` written as two characters ends a line too and ``\\t`` and ``\\"`` are
read as white space and quote, without changing any offset.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.shared import spread

EMAIL, PHONE, ID, ADDRESS, NAME = "email", "phone", "id_number", "address", "name"
TYPES = (EMAIL, PHONE, ID, ADDRESS, NAME)
#: No segment is longer than this many characters.
LONGEST = 160

#: Common given names of several languages.
GIVEN = set(
    """Aaron Abdul Adam Adriana Agnes Ahmed Aisha Alberto Alejandro Alex Alexander Alice Amina Amir Ana Anders Andrea Andrew
    Angela Anita Anna Anton Antonio Arjun Astrid Beatriz Ben Bram Carl Carlos Carmen Catherine Chen Chiara Chloe Christian
    Claire Claudia Daniel Dario David Deepa Diana Diego Dmitri Elena Elif Elizabeth Emil Emily Emma Eric Eva Fatima Felix
    Fernando Francesca Frank Freya Gabriel George Giulia Greta Hana Hannah Hans Hassan Helen Henrik Hugo Ibrahim Idris Ingrid
    Irina Isabel Ivan Ivo James Jan Jean Jean-Marc Jennifer Jessica Joao João John Jonas Joran Jorge José Juan Julia Karen
    Karim Katarina Kenji Kwame Lars Laura Leila Leo Li Liam Linda Lucas Lucia Lucía Luis Luisa Magnus Marco Maria María Marie
    Mark Marta Martin Mary Mateo Matteo Mei Michael Miguel Mirela Mohammed Nadia Natalia Niklas Nina Noah Noor Odalys Olga
    Olivia Omar Oscar Pablo Patricia Paul Pavel Pedro Peter Petra Pierre Priya Rafael Rajesh Renée Richard Robert Rosa Ruth
    Samuel Sarah Saskia Sofia Søren Stefan Susan Sven Tessa Thomas Tomas Viktor William Yara Yuki Yusuf Zoë Zoe Zola""".split()
)
_UPPER_GIVEN = {g.upper() for g in GIVEN}
_NAMED = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, GIVEN), key=len, reverse=True)) + r")\b")

_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'’]+(?:[A-Z][a-z]+)?"
_PARTICLES = r"(?:(?:de|van|von|der|la|di|da|dos|del|el|al|bin) )*"
_FAMILY = rf"{_PARTICLES}{_CAP}(?:-{_CAP})?"
_ALLCAPS = r"[A-ZÀ-ÖØ-Þ]{3,}(?:-[A-ZÀ-ÖØ-Þ]{3,})?"
_TITLE = r"(?:Dr|Prof|Mr|Mrs|Ms|Miss|Mme|Mlle|Frau|Herr|Sr|Sra|Srta|Dra|Señora|Señor|Sig|Ing|Sir|Professor|Doctor)"

# --- generators ---------------------------------------------------------------------------------------------------
_AT = r"(?:@|\s?[\[({]\s?(?:at|AT|arroba)\s?[\])}]\s?|\s(?:AT|at)\s)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|punkt|punto)\s?[\])}]\s?|\s(?:DOT|dot)\s)"
_ATLIKE = re.compile(r"@|[\[({]\s?(?:at|AT|arroba)\s?[\])}]|\s(?:AT|at)\s")
_EMAIL = re.compile(rf"(?<![\w.+\-@/])[A-Za-z0-9À-ÿ_][A-Za-z0-9À-ÿ._%+\-]{{0,63}}{_AT}(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{{0,62}}){_DOT}){{1,5}}[A-Za-z]{{2,24}}(?![\w\-])")
_PHONES = [
    ("plus", re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .\-/]?\(?\d{1,5}\)?){2,6}(?![\w])")),
    ("zeros", re.compile(r"(?<![\w.\-+])00\d{2}(?:[ \-/]\d{2,6}){2,5}(?![\w])")),
    ("area", re.compile(r"(?<![\w)])\(\d{3}\) ?\d{3}[ \-.]\d{4}(?![\w\-])")),
    ("three", re.compile(r"(?<![\w.\-+/])\d{3}([.\-])\d{3}\1\d{4}(?![\w\-]|\.\d)")),
    ("pairs", re.compile(r"(?<![\w.\-+/])0\d(?:[ .]\d\d){4}(?! ?\d|[\w\-])")),
    ("trunk", re.compile(r"(?<![\w.\-+/])0\d{3,4} \d{3} ?\d{3,4}(?! ?\d|[\w\-])")),
    ("trunk", re.compile(r"(?<![\w.\-+/])0\d{2,4}[ \-/]\d{3,4}[ \-]\d{3,4}(?! ?\d|[\w\-])")),
]
_IDS = [
    ("cpf", re.compile(r"(?<![\w.\-])\d{3}\.\d{3}\.\d{3}-\d{2}(?![\w\-])")),
    ("dni", re.compile(r"(?<![\w.\-])(?:\d{8}-?[A-Z]|[XYZ]-?\d{7}-?[A-Z])(?![\w\-])")),
    ("nino", re.compile(r"(?<![\w.\-])[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D](?![\w\-])")),
    ("ssn", re.compile(r"(?<![\w.\-])\d{3}([ \-])\d\d\1\d{4}(?! ?\d|[\w\-])")),
    ("nir", re.compile(r"(?<![\w.\-])[12] ?\d\d ?\d\d ?(?:\d\d|2[AB]) ?\d{3} ?\d{3}(?: ?\d\d)?(?! ?\d|[\w\-])")),
    ("tax", re.compile(r"(?<![\w.\-])\d\d \d{3} \d{3} \d{3}(?! ?\d|[\w\-])")),
    ("pesel", re.compile(r"(?<![\w.\-])\d{11}(?![\w\-]|\.\d)")),
    ("iban", re.compile(r"(?<![\w.\-])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w\-])")),
    ("pass", re.compile(r"(?<![\w.\-])(?=[A-Z0-9]*\d)[A-Z][A-Z0-9]{7,8}(?![\w\-])")),
    ("digits", re.compile(r"(?<![\w.\-])\d{7,12}(?![\w\-]|\.\d)")),
]
#: Where a phone or identity number may begin, from the beginnings of the forms above.
_NUMBERLIKE = re.compile(
    r"\+\d|\(\d{3}\) ?\d{3}|(?<![\w.\-])(?:00\d\d[ \-/]\d|\d{3}[.\-]\d{3}[.\-]\d|0\d[ .]\d\d[ .]\d\d|0\d{2,4}[ \-/]\d{3}|[A-Z]{2} ?\d\d ?\d\d ?\d\d|\d{3}[ \-]\d\d[ \-]\d{4}"
    r"|[12] ?\d\d ?\d\d ?(?:\d\d|2[AB]) ?\d{3}|\d\d \d{3} \d{3} \d{3}|\d{7}|[XYZ]-?\d{7}|[A-Z]{2}\d\d ?[A-Z0-9]{4}|[A-Z](?=[A-Z]{0,8}\d)[A-Z0-9]{7})"
)
_NUMBER_STARTS = re.compile(f"(?={_NUMBERLIKE.pattern})")
_NUMBER_FORMS = [(n, k, r, kind) for n, (k, r, kind) in enumerate([(*f, PHONE) for f in _PHONES] + [(*f, ID) for f in _IDS])]
_BY_LETTER = [f for f in _NUMBER_FORMS if f[1] in ("dni", "nino", "iban", "pass")]
_BY_DIGIT = [f for f in _NUMBER_FORMS if f[1] not in ("plus", "area", "zeros", "pairs", "trunk", "nino", "iban", "pass")]
_BY_ZERO = [f for f in _NUMBER_FORMS if f[1] not in ("plus", "area", "nino", "iban", "pass")]
#: The forms that may begin with a character.
_BEGINNING = {"+": [f for f in _NUMBER_FORMS if f[1] == "plus"], "(": [f for f in _NUMBER_FORMS if f[1] == "area"], "0": _BY_ZERO}
_LETTERS = re.compile(r"[A-Za-z]{2}")
_DIGIT = re.compile(r"\d")
#: What every name and address has.
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'’]")
_ID_LABEL = re.compile(r"(?:\b(?:SSN|CPF|CNPJ|DNI|NIE|NIF|NIR|NHS|PESEL|BSN|SIN|IBAN|CURP|NINO|NI number|NI no\.?|national insurance(?: number| no\.?)?|social security(?: number| no\.?)?|passport(?: number| no\.?)?|Reisepass(?:nummer)?|pasaporte|passeport|Steuer-?ID|Steuernummer|Steueridentifikationsnummer|tax id|ID(?: card)?(?: number| no\.?)|identity (?:card|number)(?: no\.?)?|Personalausweis(?:nummer)?|personnummer|codice fiscale|numéro de sécurité sociale|driver'?s licen[cs]e(?: no\.?)?)\s*(?:[:#=]|no\.?|nr\.?|is)?\s*[:#]?\s*)$", re.I)
_BESIDE = re.compile(r"[^\W\d_]{2,}\.? [/|] $")
_PHONE_LABEL = re.compile(r"(?:\b(?:phone|tel|tél|telephone|telefon|telefone|teléfono|téléphone|mobile|mobil|cell|fax|call|text|ring|dial|whatsapp|sms|appeler(?: le| au)?|joignable au|erreichbar unter|unter|llamar(?: al)?|ligue(?: para)?|contact|or text)\.?\s*(?:no\.?|nr\.?|number)?\s*[:=]?\s*[\"'(]?\s*)$", re.I)

_SUFFIX = r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Court|Ct|Terrace|Ter|Way|Row|Place|Pl|Square|Sq|Boulevard|Blvd|Close|Crescent|Parkway|Pkwy|Highway|Hwy|Walk|Gardens|Grove|Hill|Mews|Alley|Circle|Cir)\.?"
_UNIT = r"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite|Ste\.?|Room|Rm\.?|#) ?\d*[A-Za-z]?\d*)"
_NUMBER = r"\d{1,5}(?: ?[a-zA-Z](?![\w]))?(?: bis| ter)?"
_FRENCH = r"(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|route|cours)"
_GERMAN = r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm|ufer|markt|chaussee)"
_GERMAN_APART = r"(?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ring|Damm)"
_ROMANCE = r"(?:Calle|C/|Avenida|Av\.|Plaza|Paseo|Camino|Via|Viale|Piazza|Corso|Rua|Travessa|Praça)"
_STREETS = [
    ("english", rf"(?:{_UNIT},? )?{_NUMBER} (?:[NSEW]\.? )?(?:{_CAP} ){{1,3}}{_SUFFIX}(?![a-z])(?:,? {_UNIT})?"),
    ("french", rf"{_NUMBER},? {_FRENCH}(?: (?:de la|de l'|du|des|de|d'))? ?{_CAP}(?:[ \-]{_CAP}){{0,3}}"),
    ("german", rf"(?:{_CAP}[ \-])?[A-ZÄÖÜ][a-zäöüß]+{_GERMAN} \d{{1,4}} ?[a-z]?(?![\w])"),
    ("german", rf"{_CAP} {_GERMAN_APART} \d{{1,4}} ?[a-z]?(?![\w])"),
    ("romance", rf"{_ROMANCE}(?: (?:de la|de las|de los|del|de|da|do|dos|das|di|della))? ?{_CAP}(?: {_CAP}){{0,2}},? (?:n[º°o]\.? ?)?\d{{1,5}} ?[a-z]?(?![\w])"),
    ("box", r"P\.? ?O\.? Box \d{1,6}"),
]
_TOWN = rf"{_CAP}(?:[ \-](?:{_CAP}|am|an|der|sur|en|la|le|de|upon|on)){{0,3}}"
_STATE = r"(?:A[KLRZ]|C[AOT]|D[CE]|FL|GA|HI|I[ADLN]|K[SY]|LA|M[ADEINOST]|N[CDEHJMVY]|O[HKR]|PA|RI|S[CD]|T[NX]|UT|V[AT]|W[AIVY])"
_TAILS = [
    ("state", rf", {_TOWN},? {_STATE},? \d{{5}}(?:-\d{{4}})?(?!\d)"),
    ("postcode", rf",? {_TOWN},? [A-Z]{{1,2}}\d[A-Z\d]? ?\d[A-Z]{{2}}(?![\w])"),
    ("before", rf",? (?:[A-Z]{{1,2}}-)?\d{{4,5}} {_TOWN}"),
    ("before1", rf",? (?:[A-Z]{{1,2}}-)?\d{{4,5}} {_CAP}"),
    ("townstate", rf", {_TOWN},? {_STATE}(?![\w])"),
    ("town", rf", {_CAP}(?![\w])"),
]
_STREET = [(k, re.compile(rf"(?<![\w.\-/]){p}")) for k, p in _STREETS]
_TAIL = [(k, re.compile(p)) for k, p in _TAILS]
#: How a line begins that may end an address begun in the line before.
_NEXT_LINE = re.compile(rf"(?:[A-Z]{{1,2}}-)?\d{{4,5}} {_CAP}|{_CAP}(?: {_CAP})?,? (?:{_STATE},? \d{{5}}|[A-Z]{{1,2}}\d[A-Z\d]? ?\d[A-Z]{{2}})(?!\w)")
#: What every street has, from the same words as the forms above.
_STREETLIKE = re.compile(rf" {_SUFFIX}(?![a-z])|{_GERMAN} \d| {_GERMAN_APART} \d|{_ROMANCE}[ A-ZÀ-ÖØ-Þ]| {_FRENCH}[ A-ZÀ-ÖØ-Þ]|Box \d")

#: Words that take persons, before or after which a name may stand; and words of one kind that say the opposite.
_CUES = set("ask asked met meet contact call email mail write told thank thanks dear hi hello attn cc colleague author owner reviewer maintainer person participant patient student supervisor advisor professor user signed".split())
_AGENTS = set("by from to for per via von par de por".split())
_JOINS = set("with and or of on in at".split())
_ARTICLES = set("the a an this that our their its der die das le la les el los las un une ein eine".split())
_FOLLOWING = set("about and or to for in on at by with from of is was has had will would can could said says wrote writes wants asked asks who whose before after when if as but not yesterday today tomorrow now please via this that".split())
#: Capitalised words at the beginning of sentences and lines that begin no name.
_OPENERS = r"(?:The|This|That|These|Those|An?|In|On|At|For|From|With|And|Or|If|When|While|Run|See|Use|Call|Clone|Send|Ship|Thanks|Ask|Contact|Met|Meet|Email|Mail|Write|Tell|Dear|Hi|Hello|By|To|Please|We|You|They|He|She|It|As|But|Envie|Die|Der|Das|Le|La|Les|El|Los|Las|Um|Uma)"
_OPEN = rf"(?<![\w\-])(?!{_OPENERS} )"
_WORD_BEFORE = re.compile(r"([^\W\d_]+)[\s(:]*$")
_WORD_AFTER = re.compile(r"\s+([^\W\d_]+)")

_NAME_FORMS = [
    ("full", re.compile(rf"{_OPEN}{_CAP}(?:-{_CAP})? {_FAMILY}(?![\w])")),
    ("middle", re.compile(rf"{_OPEN}{_CAP}(?:-{_CAP})? (?:[A-Z]\. ?){{1,2}}{_FAMILY}(?![\w])")),
    ("double", re.compile(rf"{_OPEN}{_CAP}(?:-{_CAP})? {_CAP} {_FAMILY}(?![\w])")),
    ("initials", re.compile(rf"(?<![\w.\-])(?:[A-Z]\. ?){{1,2}}{_FAMILY}(?![\w])")),
    ("comma", re.compile(rf"(?<![\w\-]){_FAMILY}, {_CAP}(?:-{_CAP})?(?: [A-Z]\.| {_CAP})?(?![\w])")),
    ("comma1", re.compile(rf"(?<![\w\-]){_FAMILY}, {_CAP}(?:-{_CAP})?(?![\w])")),
    ("commainitial", re.compile(rf"(?<![\w\-]){_FAMILY}, [A-Z]\.(?: ?[A-Z]\.)?")),
    ("caps", re.compile(rf"(?<![\w\-]){_ALLCAPS},? {_CAP}(?:-{_CAP})?(?: {_CAP})?(?![\w])")),
    ("caps1", re.compile(rf"(?<![\w\-]){_ALLCAPS},? {_CAP}(?:-{_CAP})?(?![\w])")),
    ("capslast", re.compile(rf"(?<![\w\-]){_CAP}(?:-{_CAP})? {_ALLCAPS}(?![\w])")),
]
#: Forms that are candidates without a known given name, label or cell; capitalised words joined by commas are lists mostly.
_UNHEARD_FORMS = ("full", "middle", "double", "initials")
_TITLED = re.compile(rf"(?<![\w]){_TITLE}\.? ({_FAMILY})(?![\w])")
#: What every name has: capitals, particles, initials and commas as the forms above join them.
_NAMELIKE = re.compile(rf"(?<!\w)[A-ZÀ-ÖØ-Þ](?:[\w'’\-]{{0,{LONGEST}}}+[.,]? |\.)(?:[A-Z]\. ?){{0,3}}{_PARTICLES}[A-ZÀ-ÖØ-Þ][\w'’.]")
_IS_TITLE = re.compile(rf"{_TITLE}\.?$")
_NAME_LABELS = r"(?:author|authors|name|user|contact|contacto|owner|reviewer|maintainer|by|from|to|ask for|signed|firmada por|firmado por|responsável|responsable|ansprechpartner(?:in)?(?: ist)?|geprüft von|betreut von|von|von Frau|relu par|par|person|file|belongs to|thanks to|and to|TODO|FIXME|collected by|back to|dear|participant|patient|__author__)"
_NAME_LABEL = re.compile(rf"(?:\b{_NAME_LABELS}\s*(?:[:=(]|is)?\s*\\?[\"']?\s*)$", re.I)
_LABELLIKE = re.compile(rf"\b{_NAME_LABELS}", re.I)
_CELL_BEFORE = re.compile(r"(?:^|[|,;]|\s{2}|\t)\s*$")
_CELL_AFTER = re.compile(r"\s*(?:$|[|,;]|\s{2}|\t)")
_ROW = re.compile(r"^\s*(?:\[?\d+\]?)\s*(?:[|,;\t]|\s{2})")
_COMMON = re.compile(
    # Words that begin or end capitalised phrases that are no names.
    r"\b(?:The|This|That|These|A(?!\.)|An|In|On|At|For|From|With|And|Or|If|When|While|Run|See|Use|Call|Clone|Send|Ship|Thanks|Table|Row|Figure|Step|Traceback|Error|Warning|File|Data|Exercise|Section|Chapter|Lasso|North|South|East|West|New|Street|Road|Lane|Avenue|Drive|Court|Terrace|Way|Row|Flat|Apt|January|February|March|April|May|June|July|August|September|October|November|December|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|Calle|Rua|Via|Data|Set|Model|Network|Gradient|Descent|Support|Vector|Machine|Markov|Chain|Neural|Deep|Learning|Bayesian|Gaussian|Fourier|Transform|University|Institute|Laboratory|Lab|Museum|Project|Group|Team|Station|Corpus|Questions|We|You|They|He|She|It|Our|Call|Contact|Author|Envie|Adresse|Die|Der|Das|Le|La|El|Los|Las|Um|Uma)\b"
)


def _luhnless(kind: str, digits: str, text: str) -> float:
    """1 if the format's check digits hold, -1 if not, 0 where there are none. Only check digits that hold are evidence: wrong
    ones may be misspelt, and say nothing for the number."""
    d = [int(c) for c in digits]
    if kind == "cpf" and len(d) == 11:
        ok = all((sum(x * w for x, w in zip(d[:n], range(n + 1, 1, -1))) * 10 % 11 % 10) == d[n] for n in (9, 10))
        return 1.0 if ok else -1.0
    if kind == "dni" and len(d) == 8:
        return 1.0 if "TRWAGMYFPDXBNJZSQVHLCKE"[int(digits) % 23] == text[-1] else -1.0
    if kind == "pesel" and len(d) == 11:
        return 1.0 if (10 - sum(x * w for x, w in zip(d, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3))) % 10) % 10 == d[10] else -1.0
    if kind == "nir" and len(d) == 15:
        return 1.0 if 97 - int(digits[:13]) % 97 == int(digits[13:]) else -1.0
    return 0.0


Candidate = tuple[int, int, str, dict[str, float]]


def candidates(line: str, blind: int = 0) -> list[Candidate]:
    """(start, end, type, features) of each candidate segment of a line; ``blind`` hides the list of given names (1) and the
    labels before names as well (2)."""
    out: list[Candidate] = []
    row = bool(_ROW.match(line))

    def add(a: int, b: int, kind: str, features: dict[str, float]) -> None:
        if b - a > LONGEST:
            return
        features[f"{kind}:bias"] = 1.0
        if row and _CELL_BEFORE.search(line, max(0, a - 4), a) and _CELL_AFTER.match(line, b):
            features[f"{kind}:cell"] = 1.0
        out.append((a, b, kind, features))

    if _ATLIKE.search(line):
        for m in _EMAIL.finditer(line):
            a, b = m.span()
            text = m.group()
            f = {"email:plain" if "@" in text else "email:evading": 1.0}
            if text.startswith(("git@", "hg@", "svn@", "ssh@")) or line[b : b + 1] == ":" and line[b + 1 : b + 2].strip() and not line[b + 1 : b + 2].isspace():
                f["email:login"] = 1.0
            if line[max(0, a - 3) : a] == "://" or "://" in line[max(0, a - 40) : a].rsplit(" ", 1)[-1]:
                f["email:login"] = 1.0
            if "@" not in text and re.search(r"\sat\s", text) and not re.search(r"dot", text, re.I):
                f["email:loose"] = 1.0
            add(a, b, EMAIL, f)
    digits = _DIGIT.search(line) is not None
    upto: dict[int, int] = {}
    for start in _NUMBER_STARTS.finditer(line) if digits else ():
        at = start.start()
        c = line[at]
        for i, form, pattern, kind in _BEGINNING.get(c) or (_BY_DIGIT if c.isdigit() else _BY_LETTER):
            if at < upto.get(i, 0) or not (m := pattern.match(line, at)):
                continue
            upto[i] = b = m.end()
            text = m.group()
            # Labels have letters, which columns of numbers don't.
            worded = _LETTERS.search(line, max(0, at - 60), at) is not None
            id_label = worded and _ID_LABEL.search(line, max(0, at - 60), at) is not None
            phone_label = worded and _PHONE_LABEL.search(line, max(0, at - 40), at) is not None
            f = {f"{'phone' if kind == PHONE else 'id'}:{form}": 1.0}
            if kind == PHONE:
                if not 8 <= sum(c.isdigit() for c in text) <= 15:
                    continue
                if phone_label:
                    f["phone:label"] = 1.0
                if id_label:
                    f["phone:idlabel"] = 1.0
            else:
                if form == "digits" and len(text) == 11:
                    continue
                if _luhnless(form, "".join(c for c in text if c.isdigit()), text) > 0:
                    f["id:valid"] = 1.0
                if id_label:
                    f["id:label"] = 1.0
                elif _BESIDE.search(line, max(0, at - 24), at):
                    f["id:beside"] = 1.0  # after a name and a dividing sign, as in a record's line
                if phone_label:
                    f["id:phonelabel"] = 1.0
            add(at, b, kind, f)
    if not _CAPITAL.search(line):
        return out
    if digits and _STREETLIKE.search(line):
        for form, pattern in _STREET:
            for m in pattern.finditer(line):
                a, b = m.span()
                ends = {b: {"none"}}
                for tail, after in _TAIL:
                    t = after.match(line, b)
                    if t:
                        ends.setdefault(t.end(), set()).add(tail)
                for end, tails in ends.items():
                    f = {f"address:{form}": 1.0, **{f"address:{tail}": 1.0 for tail in tails}}
                    if line[end - 1] == "." and "none" in tails:
                        f["address:dot"] = 1.0
                    if re.match(r",? (?:\d{4,5}|[A-Z]{2} \d{5}|[A-Z]{1,2}\d[A-Z\d]? ?\d[A-Z]{2})(?!\w)", line[end : end + 14]):
                        f["address:more"] = 1.0
                    add(a, end, ADDRESS, f)
    if not _NAMELIKE.search(line):
        return out
    for form, pattern in _NAME_FORMS:
        for m in pattern.finditer(line):
            a, b = m.span()
            text = m.group()
            words = re.split(r"[ ,]+", text)
            if _IS_TITLE.match(words[0]):
                continue
            listed = [w in GIVEN or w in _UPPER_GIVEN for w in words]
            known = [False] * len(words) if blind else listed
            label = blind < 2 and _NAME_LABEL.search(line, max(0, a - 30), a) is not None
            cell = row and _CELL_BEFORE.search(line, max(0, a - 4), a) and _CELL_AFTER.match(line, b)
            unheard = not (any(known) or label or cell)
            if unheard and form not in _UNHEARD_FORMS:
                continue
            f = {f"name:unheard:{form}" if unheard else f"name:{form}": 1.0}
            where = {"full": 0, "middle": 0, "double": 0, "capslast": 0, "comma": 1, "comma1": 1, "caps": 1, "caps1": 1}.get(form)
            if where is not None:
                f["name:given" if known[min(where, len(known) - 1)] else "name:unknown"] = 1.0
            if form == "double" and not listed[1]:
                f["name:oddmiddle"] = 1.0
            if known[-1] and form in ("full", "middle", "double"):
                f["name:givenlast"] = 1.0
            if form in ("comma", "caps") and len(words) > 2 and not (listed[-1] or re.fullmatch(r"[A-Z]\.", words[-1])):
                f["name:oddmiddle"] = 1.0
            if _COMMON.search(text):
                f["name:common"] = 1.0
            if label:
                f["name:label"] = 1.0
            if unheard:
                # Nothing but its shape and what stands around it speaks for this one.
                f["name:unheard"] = 1.0
                before, after = _WORD_BEFORE.search(line, max(0, a - 30), a), _WORD_AFTER.match(line, b)
                word = before.group(1).lower() if before else ""
                f["name:cue" if word in _CUES else "name:agent" if word in _AGENTS else "name:join" if word in _JOINS else "name:article" if word in _ARTICLES else "name:other"] = 1.0
                if after and after.group(1)[0].islower() and after.group(1) not in _FOLLOWING:
                    f["name:noun"] = 1.0
            if line.lstrip().startswith("#") and not label:
                f["name:heading"] = 1.0
            if form.startswith("comma") and row and not cell:
                f["name:split"] = 1.0
            if line[b : b + 1] == "-" or line[max(0, a - 1) : a] in ("-", "/", "_", "."):
                f["name:glued"] = 1.0
            add(a, b, NAME, f)
    for m in _TITLED.finditer(line):
        a, b = m.span(1)
        f = {"name:titled": 1.0}
        if _COMMON.search(m.group(1)):
            f["name:common"] = 1.0
        add(a, b, NAME, f)
    return out


def trained_weights() -> dict[str, float]:
    from tracewright.llm.pii_weights import TRAINED

    return TRAINED


def score(features: dict[str, float], weights: dict[str, float]) -> float:
    return sum(weights.get(k, 0.0) * v for k, v in features.items())


def segment(line: str, weights: dict[str, float]) -> list[tuple[int, int, str]]:
    """The best segmentation of a line; candidates are the only segments that are not plain text.

    Best-so-far runs over candidates by their ends: a segment extends the best segmentation that ends where it begins
    or before.  Ties go to the longer, then to the earlier candidate.
    """
    found = [(b, a, kind, s) for a, b, kind, f in candidates(line) if (s := score(f, weights)) > 0]
    if not found:
        return []
    found.sort(key=lambda c: (c[0], -c[1]))
    ends = [c[0] for c in found]
    best = [0.0] * (len(found) + 1)
    choice: list[tuple[int, bool]] = [(0, False)] * (len(found) + 1)
    for i, (b, a, kind, s) in enumerate(found, 1):
        j = i - 1
        while j > 0 and ends[j - 1] > a:
            j -= 1
        if best[j] + s + 1e-6 * (b - a) > best[i - 1]:
            best[i], choice[i] = best[j] + s + 1e-6 * (b - a), (j, True)
        else:
            best[i], choice[i] = best[i - 1], (i - 1, False)
    out, i = [], len(found)
    while i > 0:
        j, taken = choice[i]
        if taken:
            b, a, kind, _ = found[i - 1]
            out.append((a, b, kind))
        i = j
    return out[::-1]


def _hidden(line: str, blind: int) -> int:
    number = zlib.crc32(line.encode("utf-8", "replace"))
    return 0 if not blind or number % blind else 1 + number // blind % 2


def fit(lines: list[tuple[str, set[tuple[int, int, str]]]], rounds: int = 60, rate: float = 0.5, decay: float = 1e-3, blind: int = 0) -> dict[str, float]:
    """Weights that maximise the penalised conditional likelihood of labelled lines [(line, {(start, end, type)})].

    Expected feature counts come from the forward-backward recursions over each line's lattice; steps are scaled by
    past gradients.  The number of lines is bounded by the caller's sample.  One line of ``blind`` is learnt from without the
    list of given names, as lines look whose names it lacks, half of these without labels as well.
    """
    lattices = []
    for line, gold in lines:
        found = sorted(candidates(line, _hidden(line, blind)), key=lambda c: (c[1], -c[0]))
        if found:
            lattices.append(([(c[0], c[1]) for c in found], [c[3] for c in found], [c[:3] in gold for c in found]))
    weights: dict[str, float] = {}
    past: dict[str, float] = {}
    for _ in range(rounds):
        gradient: dict[str, float] = {}
        for spans, features, gold in lattices:
            scores = [max(-30.0, min(30.0, score(f, weights))) for f in features]
            n = len(spans)
            ends = [b for _, b in spans]
            forward, before = [0.0] * (n + 1), [0] * (n + 1)
            for i in range(1, n + 1):
                j = i - 1
                while j > 0 and ends[j - 1] > spans[i - 1][0]:
                    j -= 1
                before[i] = j
                forward[i] = np.logaddexp(forward[i - 1], forward[j] + scores[i - 1])
            total, mass = forward[n], [0.0] * (n + 1)
            reach = [-math.inf] * (n + 1)
            reach[n] = 0.0
            for i in range(n, 0, -1):
                if reach[i] == -math.inf:
                    continue
                take = reach[i] + scores[i - 1]
                mass[i] = math.exp(min(0.0, forward[before[i]] + take - total))
                reach[i - 1] = np.logaddexp(reach[i - 1], reach[i])
                reach[before[i]] = np.logaddexp(reach[before[i]], take)
            for f, p, y in zip(features, mass[1:], gold):
                for k, v in f.items():
                    gradient[k] = gradient.get(k, 0.0) + v * ((1.0 if y else 0.0) - p)
        for k, g in gradient.items():
            g -= decay * weights.get(k, 0.0) * len(lattices)
            past[k] = past.get(k, 0.0) + g * g
            weights[k] = weights.get(k, 0.0) + rate * g / (math.sqrt(past[k]) + 1e-9)
    return {k: round(v, 3) for k, v in sorted(weights.items())}


# --- whole texts ----------------------------------------------------------------------------------------------------
_LINES = re.compile(r"\n|\\n")


def maybe(line: str) -> bool:
    """Whether a line can have candidates: each test is met by all that the generators of its types propose."""
    if _NAMELIKE.search(line) or _ATLIKE.search(line):
        return True
    return _DIGIT.search(line) is not None and (_NUMBERLIKE.search(line) is not None or _STREETLIKE.search(line) is not None)


class Finder:
    """Finds mentions; remembers the segmentation of lines met before, as notebooks repeat each other."""

    REMEMBERED = 200_000

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights if weights is not None else trained_weights()
        self.known: dict[str, tuple] = {}

    def line(self, line: str) -> tuple[tuple[int, int, str], ...]:
        plain = line.replace("\\t", "  ").replace('\\"', ' "') if "\\" in line else line
        return tuple(segment(plain, self.weights))

    def __call__(self, text: str | None) -> list[tuple[int, int, str]]:
        if not text:
            return []
        out: list[tuple[int, int, str]] = []
        if len(self.known) > self.REMEMBERED:
            self.known.clear()
        parts = [(part, 2 if last < n else 1) for whole in text.split("\n") for pieces in ((whole.split("\\n"),) if "\\n" in whole else ((whole,),)) for n in (len(pieces),) for last, part in enumerate(pieces, 1)]
        at, taken = 0, 0
        for i, (part, gap) in enumerate(parts):
            if len(part) > 3:
                found = self.remembered(part)
                if i + 1 < len(parts) and _NEXT_LINE.match(parts[i + 1][0]) and _DIGIT.search(part):
                    found = self.over_the_end(part, parts[i + 1][0], gap) or found
                for a, b, kind in found:
                    if at + a >= taken:
                        out.append((at + a, at + b, kind))
                        taken = at + b
            at += len(part) + gap
        return out

    def remembered(self, part: str) -> tuple[tuple[int, int, str], ...]:
        found = self.known.get(part)
        if found is None:
            found = self.line(part)
            if len(part) < 400:
                self.known[part] = found
        return found

    def over_the_end(self, part: str, following: str, gap: int) -> list[tuple[int, int, str]]:
        """A line's mentions where an address goes on in the next line; else none."""
        found, end = self.line(f"{part} {following}"), len(part)
        if not any(a < end < b and kind == ADDRESS for a, b, kind in found):
            return []
        return [(a, b if b <= end else b - 1 + gap, kind) for a, b, kind in found if a < end]


def replaced(text: str | None, finder: Finder) -> str | None:
    """The text with each mention replaced by its type in brackets."""
    if not text:
        return text
    parts, at = [], 0
    for a, b, kind in finder(text):
        parts += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*parts, text[at:]])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    finder = Finder()
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        rows: list[tuple[int, int, int, str]] = []
        for i, doc in enumerate(ids):
            rows += [(doc, a, b, kind) for a, b, kind in finder(texts[i].as_py())]
        if rows:
            d, a, b, k = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k)], names=["doc_id", "start_char", "end_char", "pii_type"])


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    finder = Finder()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([replaced(t, finder) for t in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])


def mentions(documents: DataFrame) -> DataFrame:
    """(doc_id, start_char, end_char, pii_type) of each mention; null and empty texts have none, whole texts are read."""
    return spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text <> ''")).mapInArrow(_find, "doc_id bigint, start_char bigint, end_char bigint, pii_type string")


def with_placeholders(documents: DataFrame) -> DataFrame:
    """(doc_id, text) of every document with typed placeholders for its mentions."""
    return spread(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInArrow(_replace, "doc_id bigint, text string")
