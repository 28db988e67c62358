"""Secret scanning: Aho-Corasick keywords, anchored expressions near their hits, embedded checksums.

Base kinds, leftmost non-overlapping within a kind, in code points with exclusive ends:

* ``assign``: a credential word (ASCII letters in either case), an optional quote, ``:`` or ``=``,
  an optional quote and a value of at least 12 characters;
* ``access``: ``AKIA`` and capitals or digits, at least 18 characters;
* ``hex``: lower-case hexadecimal digits, at least 16. A run of digits has no keyword, so this kind
  is one scan for long runs.

Added kinds, each with a check that is embedded in the secret itself: ``github`` and ``npm`` tokens
(CRC-32 in base 62 in the last six characters), ``jwt`` (header and payload decode to JSON objects,
the header naming an algorithm), ``pem`` (a private key whose DER length agrees with its bytes).

Time grows with the text: no expression gives back what it took, and a hit inside a run of characters that another hit has
already failed on is not tried again.

Defined cases: a null or empty text has no spans; very long texts are scanned whole, one at a time; of spans that overlap within a
kind the leftmost counts, and spans of different kinds are all told, ties by the order of the kinds; repeated rows and ids are
separate rows of the result; an empty table gives an empty result; :func:`redact_secrets` keeps every column, and :func:`scan` reads
only the two that it is given, so other columns may have any name.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import arrow_rows, begin_work

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm", "jwt", "pem")
_ORDER = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}

#: Anchored expressions by kind; they are only tried at a keyword's hit.
_ANCHORED = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"),
    "pem": re.compile(r"-----BEGIN ((?:RSA |EC |DSA )?PRIVATE KEY)-----\s++([A-Za-z0-9+/=\s]++)-----END \1-----"),
}
#: Where a failure at one hit is a failure at every later hit in the same run of characters, that run.
_RUNS = {"jwt": re.compile(r"[A-Za-z0-9_-]++")}
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Keywords as they look in lower case, with their kinds.
_KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "-----begin ": "pem",
}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@cache
def _automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for word, kind in _KEYWORDS.items():
        auto.add_word(word, (len(word), kind))
    auto.make_automaton()
    return auto


def _crc_ok(token: str) -> bool:
    """Whether the last six characters are the CRC-32, in base 62, of what stands between prefix and them."""
    value = zlib.crc32(token[4:-6].encode())
    digits = ""
    while value:
        value, d = divmod(value, 62)
        digits = _BASE62[d] + digits
    return token[-6:] == digits.rjust(6, "0")


def _jwt_ok(token: str) -> bool:
    try:
        head, body = (json.loads(base64.urlsafe_b64decode(x + "=" * (-len(x) % 4))) for x in token.split(".")[:2])
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and "alg" in head


def _pem_ok(match: re.Match) -> bool:
    try:
        der = base64.b64decode("".join(match[2].split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if len(der) < 4 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    n = der[1] & 0x7F
    return len(der) == 2 + n + int.from_bytes(der[2 : 2 + n], "big")


def _accepted(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= 12
    if kind == "access":
        return len(m[0]) >= 18
    if kind in ("github", "npm"):
        return _crc_ok(m[0])
    return _jwt_ok(m[0]) if kind == "jwt" else _pem_ok(m)


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by start and then in the order of the kinds."""
    if not text:
        return []
    # U+0130 is the only character whose lower case is longer; without it offsets agree
    low = text.replace("İ", "ı").lower()
    spans, past = [], {}
    for at, (length, kind) in _automaton().iter(low):
        start = at - length + 1
        if start < past.get(kind, 0):
            continue
        m = _ANCHORED[kind].match(text, start)
        good = m and _accepted(kind, m)
        if good:
            spans.append((kind, start, m.end()))
        if m and (good or kind in BASE_KINDS):
            past[kind] = m.end()  # of the base kinds a match too short still hides what overlaps it
        elif kind in _RUNS and text.startswith("eyJ", start):
            past[kind] = _RUNS[kind].match(text, start).end()
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with every maximal stretch of overlapping spans replaced by ``[SECRET]``."""
    if not spans:
        return text
    out, at, end = [], 0, -1
    for _, a, b in spans:
        if a >= end:
            if end >= 0:
                at = end
            out += [text[at:a], "[SECRET]"]
            at = end = b
        else:
            at = end = max(end, b)
    return "".join(out) + text[end:]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def rows(ids: list, texts: list) -> dict:
        found = [find_secrets(t) for t in texts]
        base = [[s for s in f if s[0] in BASE_KINDS] for f in found]
        return {
            "doc_id": ids,
            **{f"n_{k}": [sum(s[0] == k for s in f) for f in base] for k in BASE_KINDS},
            "base_sha256": [hashlib.sha256(_joined(f).encode()).hexdigest() for f in base],
            "spans": [_joined(f) for f in found],
        }

    kind = dict(df.dtypes)[id_col]
    return arrow_rows(df.select(id_col, text_col), rows, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the secrets in its text column replaced by ``[SECRET]``; every row and column stays."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        begin_work(__name__)
        return pd.Series([redact(t, find_secrets(t)) for t in texts], dtype=object)

    return df.withColumn(text_col, clean(F.col(text_col)))
