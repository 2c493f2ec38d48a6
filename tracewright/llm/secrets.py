"""Credentials written out in code and configuration: finding them, and masking them without breaking the text.

Texts pass a keyword automaton first; only the rules whose keywords occur are run.  Rules are issuer formats (with
their structure validated and their checksum reported), key-value assignments, places where commands and URLs carry passwords, and
private-key blocks.  What a rule finds must be usable: references to variables or stores, placeholders, masked values,
hashes with their scheme and calls are dismissed.  Every further occurrence of a secret in the same text counts too.

Placeholders have the length of the secret and, character by character, its alphabet, so quotes, JSON escapes,
fixed-width fields and parsers downstream keep working.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.shared import spread

# Quotes as they may stand in source or, escaped once or twice, inside JSON.
_Q = r"""(?:\\{0,3}["'`])"""
_TRIPLE = r"""(?:(?:\\{0,3}["']){3}|\\{0,3}["'`])"""
_SENSITIVE = r"(?:pass(?:word|wd|phrase|code)?|pwd|secret(?:[_\-.]?(?:access[_\-.]?)?key)?|token|api[_\-.]?key|app[_\-.]?key|access[_\-.]?key(?:[_\-.]?id)?|auth[_\-.]?key|private[_\-.]?key|account[_\-.]?key|shared[_\-.]?key|encryption[_\-.]?key|signing[_\-.]?key|client[_\-.]?key|credentials?|client[_\-.]?secret|connection[_\-.]?string)"
_NAME = rf"(?<![A-Za-z0-9])(?:[A-Za-z0-9_\-.$/:@]{{0,64}}[_\-.$/:@a-z])?{_SENSITIVE}(?![A-Za-z0-9_])"
# A backslash belongs to a bare value unless it begins an escape of white space, a quote or another sign that ends one.
_VALUE = r"""(?:[^\s"'`\\,;&<>(){}\[\]]|\\(?![nrtbf"'`\\]|u00(?:0[9aAdD]|2[0267cC]|3[bBcCeE])))+"""

_FIXED = {
    # Published formats of issuers' credentials.
    "akia": r"(?<![A-Za-z0-9])(?:AKIA|ASIA|ABIA|ACCA)[A-Z2-7]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "asia": r"(?<![A-Za-z0-9])ASIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "gh": r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+(?![A-Za-z0-9])|(?<![A-Za-z0-9])github_pat_[A-Za-z0-9_]{50,}+(?![A-Za-z0-9_])",
    "glpat": r"(?<![A-Za-z0-9])glpat-[A-Za-z0-9_\-]{20,}+(?![A-Za-z0-9_\-])",
    "xox": r"(?<![A-Za-z0-9])xox[abeoprs]-[A-Za-z0-9\-]{10,}+(?![A-Za-z0-9\-])",
    "sk-": r"(?<![A-Za-z0-9_\-])sk-(?:proj-|live-|svcacct-|ant-)?[A-Za-z0-9_\-]{20,}+(?![A-Za-z0-9_\-])",
    "_live_": r"(?<![A-Za-z0-9])[srp]k_live_[A-Za-z0-9]{16,}+(?![A-Za-z0-9])",
    "aiza": r"(?<![A-Za-z0-9_\-])AIza[A-Za-z0-9_\-]{35}(?![A-Za-z0-9_\-])",
    "eyj": r"(?<![A-Za-z0-9_\-.])eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{16,}(?![A-Za-z0-9_\-])",
    "npm_": r"(?<![A-Za-z0-9])npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])",
    "hf_": r"(?<![A-Za-z0-9])hf_[A-Za-z0-9]{34}(?![A-Za-z0-9])",
    "pypi-": r"(?<![A-Za-z0-9])pypi-AgE[A-Za-z0-9_\-]{50,}",
    "sg.": r"(?<![A-Za-z0-9])SG\.[A-Za-z0-9_\-]{22}\.[A-Za-z0-9_\-]{43}(?![A-Za-z0-9_\-])",
    "dop_v1": r"(?<![A-Za-z0-9])dop_v1_[a-f0-9]{64}(?![a-f0-9])",
}
#: Issuer formats are matched with case; each is run only if its keyword occurs. The letter of an escape such as \\n may
#: stand before them.
ISSUED = {k: re.compile("(" + re.sub(r"\(\?<!(\[[^\]]*\])\)", r"(?:(?<=\\\\[nrtbf])|(?<!\1))", p) + ")") for k, p in _FIXED.items()}

_KEY_EDGE = re.compile(r"-----(?P<kind>BEGIN|END) (?:(?P<key>(?:[A-Z0-9]+ ){0,8}PRIVATE KEY(?: BLOCK)?-----)|(?=[A-Z]))")
_TO = rf"""{_Q}?\]?\s*(?::\s*&?'?[A-Za-z_][\w<>\[\]&' ]{{0,20}}?\s*=(?!=)|:=|=>|=(?![=>~])|:(?!:))\s*"""
_QUOTED = rf"(?P<open>{_Q})(?P<quoted>(?:(?!(?P=open))[^\n]){{4,512}}?)(?P=open)"
# Longer values have no white space, so a run of them is read once and never given back.
_LENGTHY = rf"(?P<open>{_Q})(?P<quoted>(?:(?!(?P=open))\S){{513,}}+)(?P=open)"
_ASSIGNED = re.compile(rf"(?P<name>{_NAME}){_TO}(?:{_QUOTED}|(?P<bare>{_VALUE}))", re.I)
_CALLED, _CALLED_LONG = (re.compile(rf"\(\s*{_Q}{_NAME}{_Q}\s*,\s*{q}", re.I) for q in (_QUOTED, _LENGTHY))
_ATTRIBUTE, _ATTRIBUTE_LONG = (re.compile(rf"(?:key|name)\s*=\s*{_Q}{_NAME}{_Q}\s+value\s*=\s*{q}", re.I) for q in (_QUOTED, _LENGTHY))
_ASSIGNED_LONG = re.compile(rf"(?P<name>{_NAME}){_TO}{_LENGTHY}", re.I)
_SCHEME = re.compile(rf"authorization{_Q}?\s*[:=,]\s*{_Q}?\s*(?:bearer|token|basic|apikey)\s+(?P<bare>{_VALUE})", re.I)
# Neither part of a login may hold a colon or slash, so each place of a URL is read a bounded number of times.
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]{1,20}://[^\s:/@\"'`<>\\]*+:(?P<bare>[^\s:/@\"'`<>\\]{3,}+)@(?=[A-Za-z0-9\[])")
_LOGIN = re.compile(rf"\.(?:login|auth|authenticate)\(\s*{_Q}[^\n]{{1,80}}?{_Q}\s*,\s*(?P<open>{_Q})(?P<quoted>(?:(?!(?P=open))[^\n]){{4,}}+)(?P=open)", re.I)
_COMMANDS = re.compile(
    rf"(?:sshpass\s+-p\s*(?:(?P<o1>{_Q})(?P<q1>(?:(?!(?P=o1))[^\n]){{3,}}+)(?P=o1)|(?P<b1>{_VALUE}))"
    rf"|(?:mysql|mysqldump|mysqladmin|mariadb)\b[^\n|;]{{0,120}}?\s-p(?:(?P<o2>{_Q})(?P<q2>(?:(?!(?P=o2))[^\n]){{3,}}+)(?P=o2)|(?P<b2>{_VALUE}))"
    rf"|identified\s+by\s+(?:password\s+)?(?P<o3>{_Q})(?P<q3>(?:(?!(?P=o3))[^\n]){{3,}}+)(?P=o3)"
    rf"|curl\b[^\n|;]{{0,120}}?\s(?:-u|--user)\s*{_Q}?[^\s:\"'`]{{1,64}}:(?P<b4>{_VALUE}))",
    re.I,
)
_COOKIE = re.compile(rf"cookie{_Q}?\s*[:=]\s*{_Q}?[^\n\"'`]{{0,120}}?(?:session|sid|auth|jwt)[A-Za-z0-9_\-]*=(?P<bare>[^\s;\"'`\\]{{20,}})", re.I)
_SPOKEN = re.compile(r"(?:credential|password|secret|token|api key|access key)s?\b[^\n:=\"'`]{0,60}:\s+(?P<bare>[A-Za-z0-9_\-./+=!@#%^*?~]{6,})(?=\s|\\n|\\r|\"|$)", re.I)

#: keyword -> the rules it switches on
_RULES: dict[str, tuple[str, ...]] = {
    **{k: (k,) for k in ISSUED},
    "-----begin": ("block",),
    **{k: ("assigned", "called", "attribute", "spoken") for k in ("pass", "pwd", "secret", "token", "apikey", "api_key", "api-key", "api.key", "appkey", "app_key", "app-key", "access_key", "accesskey", "access-key", "access.key", "auth_key", "authkey", "private_key", "privatekey", "private-key", "account_key", "accountkey", "shared_key", "sharedkey", "signing_key", "signingkey", "encryption_key", "encryptionkey", "client_key", "credential", "connection_string", "connectionstring", "api key", "access key")},
    "authorization": ("scheme",),
    "sshpass": ("commands",), "mysql": ("commands",), "mariadb": ("commands",), "identified": ("commands",), "curl": ("commands",),
    ".login(": ("login",), ".auth(": ("login",), ".authenticate(": ("login",),
    "cookie": ("cookie",),
    "://": ("url",),
}
_PLAIN = {"assigned": _ASSIGNED, "called": _CALLED, "attribute": _ATTRIBUTE, "scheme": _SCHEME, "url": _URL, "login": _LOGIN, "commands": _COMMANDS, "cookie": _COOKIE, "spoken": _SPOKEN}
_LONG = {"assigned": _ASSIGNED_LONG, "called": _CALLED_LONG, "attribute": _ATTRIBUTE_LONG}

_REFERENCE = re.compile(r"\$\{|\$\(|\{\{|\}\}|<[^<>]*>|%\(|^%\w+%$|^\$[A-Za-z_]|^(?:env|file|vault|ref|secretref|ssm|arn|op|keyring|aws-sm|gcp-sm|kms)[:/]", re.I)
_PLACEHOLDER = re.compile(
    r"^(?:none|null|nil|true|false|undefined|changeme|change[_\-]?it|change[_\-]?me|example|placeholder|redacted|removed|masked|hidden|secret|password|passw0rd|token|test|dummy|sample|todo|tbd|default|string|str|bytes|self|empty|n/?a|foo|bar|your.*|my[_\-]?(?:password|secret|token|key|api[_\-]?key)|insert.*|replace.*|enter.*|some[_\-].*|[\[<(*.…].*[\]>)*.…])$"
    r"|x{4,}|\*{3,}|•{3,}|#{4,}|\.{3}|…|_{4,}|(?:^|[_\-])(?:example|placeholder|redacted|changeme|dummy)(?:$|[_\-])|your[_\-]",
    re.I,
)
_HASHED = re.compile(r"^(?:\$(?:2[abxy]?|1|5|6|argon2\w*|pbkdf2\S*|scrypt|y)\$|\{(?:ssha|sha|md5|crypt)|(?:sha(?:1|256|384|512)|md5|pbkdf2\S*|bcrypt|argon2\w*)[:\-$])", re.I)
_CODE = re.compile(r"^[A-Za-z_][\w.]*$")


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, rules in _RULES.items():
        automaton.add_word(word, rules)
    automaton.make_automaton()
    return automaton


_GATES = _automaton()


def _varied(value: str) -> bool:
    """Whether a bare value looks drawn rather than named: digits beside letters, or mixed case, or several signs."""
    digits, letters = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
    return digits and letters or bool(re.search(r"[a-z][A-Z]|[A-Z][a-z].*[A-Z]", value)) or sum(not c.isalnum() for c in value) >= 2


def _drawn(value: str) -> bool:
    """Whether letters and digits change as often as in random characters; a capital before small letters is no change."""
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "" for c in value]
    return sum(x != y and (x, y) != ("u", "l") and x != "" and y != "" for x, y in zip(kinds, kinds[1:])) >= max(3, len(value) / 6)


def _path(value: str) -> bool:
    """Whether a value that begins with a slash is a path: it ends in a file extension, most of its parts are words, or nothing
    in it looks drawn. Base64 begins with a slash once in 64 times."""
    parts = [p for p in value.split("/") if p]
    words = sum(re.fullmatch(r"[.@:]?(?:[a-z]+|[A-Z][a-z]+|[A-Z]+)(?:[-_.]?(?:[a-z]+|[A-Z][a-z]+|\d+))*", p) is not None for p in parts)
    return re.search(r"\.[A-Za-z]\w{0,5}$", value) is not None or len(parts) > 1 and 2 * words > len(parts) or not _drawn(value)


def usable(value: str, bare: bool, name: str = "") -> bool:
    """Whether a value found where a credential belongs is one that is written out."""
    if len(value) < 6 or len(set(value)) < 4 or _REFERENCE.search(value) or _PLACEHOLDER.search(value) or _HASHED.match(value):
        return False
    if value.startswith(("-----", "http://", "https://", "./", "~/", ")")) or value.startswith("/") and _path(value) or " " in value or "\\n" in value:
        return False
    if value.isdigit():
        return len(value) >= 8 and not bare
    if bare:
        # What is called a password may also be a long word, or capitals with a sign that names don't have.
        if not _varied(value) and not ("pass" in name.lower() and (len(value) >= 12 and value.isalpha() or re.fullmatch(r"(?=.*[A-Z])[A-Z]*[^\w\s][A-Z\W]*", value))):
            return False
        if _CODE.match(value) and re.match(r"[A-Za-z_]\w*\.[a-z_]\w*$", value) and not any(c.isdigit() for c in value):
            return False
    elif _CODE.match(value) and re.fullmatch(r"[a-z]+(?:[_.][a-z]+)+", value):
        return False
    return not re.fullmatch(r"v?\d+(?:\.\d+)+", value)


def _base62(n: int, width: int) -> str:
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = digits[r] + out
    return out.rjust(width, "0")


def checksum(value: str) -> bool | None:
    """Of formats whose last six characters are a CRC32 in base 62: whether it holds. None: the format has none.

    One that holds proves the credential, whatever it looks like. A wrong one may be a typing error in a credential that
    works elsewhere, so it is reported and doesn't dismiss."""
    if value[:4] in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_") and len(value) == 40:
        return _base62(zlib.crc32(value[4:-6].encode()), 6) == value[-6:]
    return None


def _issued(rule: str, value: str) -> bool:
    """Whether a text of an issuer's format is a credential: its checksum holds, or it is neither a placeholder nor
    badly structured."""
    if checksum(value):
        return True
    if _PLACEHOLDER.search(value) or value.endswith("EXAMPLE") or len(set(value[4:])) < 6:
        return False
    if rule == "eyj":  # the first part must be a JSON object that names an algorithm
        head = value.split(".", 1)[0]
        try:
            header = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
        except ValueError:
            return False
        return isinstance(header, dict) and "alg" in header
    return True


def _matches(pattern: re.Pattern, text: str) -> Iterator[tuple[re.Match, list[str]]]:
    """Matches with a list for the usable values the caller finds in each. Where it finds none the search goes on inside the
    match: a quote that ends a text may have been taken for one that begins a value, up to the next value's quote."""
    at = 0
    while m := pattern.search(text, at):
        found: list[str] = []
        yield m, found
        inner = min(m.start(g) for g, v in m.groupdict().items() if v is not None and g != "name" and g[0] != "o")
        at = m.end() if found else max(inner, m.start() + 1)


def _escaped(text: str, at: int) -> bool:
    """Whether the character there belongs to an escape, as the n of a line break written as backslash and n."""
    n = at
    while n > 0 and text[n - 1] == "\\":
        n -= 1
    return (at - n) % 2 == 1


def _key_blocks(text: str) -> list[tuple[int, int, str]]:
    """Private keys, from the first dash of the opening line to the last of the closing one, whatever their length."""
    out, opened = [], None
    for m in _KEY_EDGE.finditer(text):
        if m["kind"] == "BEGIN":
            opened = m if m["key"] else None
        elif m["key"] and opened is not None:
            if len(re.sub(r"\\+n|\s", "", text[opened.end() : m.start()])) > 16:
                out.append((opened.start(), m.end(), "block"))
            opened = None
    return out


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, rule) of each credential, in order and without overlaps; offsets count code points."""
    if not text:
        return []
    lowered = text.lower()
    if len(lowered) != len(text):  # some letters change length when lowered
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    rules = {r for _, group in _GATES.iter(lowered) for r in group}
    if "url" in rules and "@" not in text:
        rules.discard("url")
    if not rules:
        return []
    spans: list[tuple[int, int, str]] = []
    if "block" in rules:
        spans += _key_blocks(text)
    blocks = list(spans)
    for rule in ISSUED.keys() & rules:
        spans += [(m.start(1), m.end(1), rule) for m in ISSUED[rule].finditer(text) if _issued(rule, m.group(1))]
    lengthy = len(text) > 512 and max(map(len, text.split()), default=0) > 512
    for rule in ("assigned", "called", "attribute", "scheme", "url", "login", "commands", "cookie", "spoken"):
        if rule not in rules:
            continue
        for m, found in chain(_matches(_PLAIN[rule], text), ((m, []) for m in _LONG[rule].finditer(text)) if lengthy and rule in _LONG else ()):
            groups = m.groupdict()
            for g, value in groups.items():
                if value is None or g == "name" or g[0] == "o":
                    continue
                bare = g[0] == "b"
                start, end = m.span(g)
                while not bare and value.endswith("\\"):
                    value, end = value[:-1], end - 1
                if bare:
                    cut = value.rstrip(".:!?") if rule == "spoken" else value
                    value, end = cut, start + len(cut)
                    if rule == "assigned" and text[end : end + 1] in ("(", "[", "{"):
                        continue  # a call or an index
                if usable(value, bare and rule not in ("url", "commands"), groups.get("name") or ""):
                    spans.append((start, end, rule))
                    found.append(value)
    if not spans:
        return []
    # Every further place where one of the secrets stands.
    for value in {text[a:b] for a, b, rule in spans if rule != "block"}:
        at = text.find(value)
        while at >= 0:
            if not _escaped(text, at):
                spans.append((at, at + len(value), "again"))
            at = text.find(value, at + len(value))
    # Blocks hold what is inside them; of others the leftmost, then longest, then the rule before its repeats.
    order = {"block": 0, **{k: 1 for k in ISSUED}, "again": 3}
    out: list[tuple[int, int, str]] = []
    for a, b, rule in sorted(spans, key=lambda s: (s[0], -s[1], order.get(s[2], 2))):
        if rule != "block" and any(x <= a and b <= y for x, y, _ in blocks):
            continue
        if not out or a >= out[-1][1]:
            out.append((a, b, rule))
    return out


#: One character, or an escape as JSON and programming languages write them, with all its backslashes.
_UNIT = re.compile(r"\\+(?:u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2}|[0-7]{1,3}|.)?|.", re.S)
_HEX = re.compile(r"[0-9a-f\-]+")


def placeholder(secret: str) -> str:
    """A text of the same length whose characters have the same alphabets; line breaks, dashes and escapes stay."""
    if secret.startswith("-----"):
        head, tail = secret.index("-----", 5) + 5, secret.rindex("-----END")
        return secret[:head] + placeholder(secret[head:tail]) + secret[tail:]
    seed = hashlib.sha256(secret.encode("utf-8", "surrogatepass")).digest()
    low = _HEX.fullmatch(secret) is not None
    out: list[str] = []
    for m in _UNIT.finditer(secret):
        c = m.group()
        k = seed[m.start() % 32] + m.start()
        if len(c) > 1:  # an escape stays as it stands
            out.append(c)
        elif "0" <= c <= "9":
            out.append(chr(48 + k % 10))
        elif low and "a" <= c <= "f":
            out.append("abcdef"[k % 6])
        elif "a" <= c <= "z":
            out.append(chr(97 + k % 26))
        elif "A" <= c <= "Z":
            out.append(chr(65 + k % 26))
        else:
            out.append(c)
    return "".join(out)


def masked(text: str | None) -> str | None:
    """The text with each credential replaced by its placeholder; everything else as it was."""
    spans = find_secrets(text)
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        out += [text[at:a], placeholder(text[a:b])]
        at = b
    return "".join([*out, text[at:]])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple[str, int, int, int, str, bool | None]] = []
        for table, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = find_secrets(text)
            if found:
                rows += [(table, key, a, b, rule, checksum(text[a:b])) for a, b, rule in found]
        if rows:
            t, k, a, b, r, c = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(k, pa.int64()), pa.array(np.array(a, np.int64)), pa.array(np.array(b, np.int64)), pa.array(r), pa.array(c, pa.bool_())], names=["src_table", "row_key", "start_char", "end_char", "rule", "checksum"])


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([masked(t) for t in texts], pa.string())], names=["src_table", "row_key", "text"])


def located(texts: DataFrame) -> DataFrame:
    """(src_table, row_key, start_char, end_char, rule, checksum) of each credential in (src_table, row_key, text).

    ``checksum`` says whether the credential's own checksum holds, null where its format has none.
    Null and empty texts have none; texts are searched whole; a row repeated whole gives its places once."""
    return spread(texts.select("src_table", "row_key", "text").where("text <> ''")).mapInArrow(_find, "src_table string, row_key bigint, start_char bigint, end_char bigint, rule string, checksum boolean").dropDuplicates()


def redacted(texts: DataFrame) -> DataFrame:
    """(src_table, row_key, text) of all rows with each credential masked."""
    return spread(texts.select("src_table", F.col("row_key").cast("bigint").alias("row_key"), "text")).mapInArrow(_mask, "src_table string, row_key bigint, text string")
