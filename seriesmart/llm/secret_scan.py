"""Secrets: keyword prefilter, anchored patterns near its hits, checksums.

One Aho-Corasick pass over the text in lower case finds keywords and token
prefixes.  Only at a hit is a pattern tried, anchored there, from left to right
and beyond the end of the last match of its kind, which gives the same matches
as a scan of the whole text.  Runs of hex digits have no keyword, so they are
found by a scan of their own.  Kinds whose tokens carry a checksum or have an
inner structure must pass it.

Kinds: ``assign``, ``access``, ``hex`` (the base rules), and besides ``github``
and ``npm`` (their last six characters are the CRC-32 of the rest in base 62),
``jwt`` (a header that decodes to JSON with an ``alg``) and ``private_key``
(a PEM block).

Defined results: a null or empty text has no spans; ties start at the same
place and follow the order of the kinds; repeated rows give repeated results;
texts are scanned whole, in time that grows in proportion (nothing is looked
for twice over the same stretch, also where blocks and tokens have no end); a
token whose header is no JSON, or nested too deeply, is none; further columns
pass through, and one named ``spans`` is replaced.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_left
from functools import lru_cache
from zlib import crc32

import ahocorasick
from pyspark.sql import DataFrame

from .common import map_column, named
from .scan import Span, masked, with_spans

BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "github", "npm", "jwt", "private_key"]
LEAST = {"assign": 12, "access": 18, "hex": 16}

_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_GITHUB = re.compile(r"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])")
_NPM = re.compile(r"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])")
_JWT_PART = re.compile(r"[A-Za-z0-9_-]+")
_JWT_REST = re.compile(r"\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
_PEM_END = re.compile(r"(?=-----END ((?:[A-Z0-9]+ )*PRIVATE KEY)-----)")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def base62_crc(body: str) -> str:
    n, out = crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = _BASE62[d] + out
    return out


def _checked_token(token: str) -> bool:
    return base62_crc(token[4:-6]) == token[-6:]


def _jwt(token: str) -> bool:
    head = token.split(".")[0]
    try:
        got = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, RecursionError):  # no JSON, or nested too deeply to be a header
        return False
    return isinstance(got, dict) and "alg" in got


#: Keyword (in lower case) -> kind.
KEYWORDS = {**dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"), "akia": "access",
            **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "github"), "npm_": "npm", "eyj": "jwt", "-----begin ": "private_key"}
_RULES = {
    "assign": (_ASSIGN, lambda m: len(m[1]) >= LEAST["assign"]),
    "access": (_ACCESS, lambda m: len(m[0]) >= LEAST["access"]),
    "github": (_GITHUB, lambda m: _checked_token(m[0])),
    "npm": (_NPM, lambda m: _checked_token(m[0])),
}


class _Tokens:
    """Ends of ``eyJ..eyJ...`` tokens; what a run of their characters is followed by is looked at once a run."""

    def __init__(self, text: str):
        self.text, self.run, self.rest = text, (0, 0), None

    def end(self, at: int) -> int | None:
        if not self.run[0] <= at < self.run[1]:
            end = _JWT_PART.match(self.text, at).end()
            rest = _JWT_REST.match(self.text, end)
            self.run, self.rest = (at, end), rest and rest.end()
        # the first part has a character after its eyJ
        return self.rest if at + 3 < self.run[1] else None


class _Keys:
    """Ends of PEM blocks; the places of all end lines are found once a text."""

    def __init__(self, text: str):
        self.text, self.ends = text, None

    def end(self, at: int) -> int | None:
        begin = _PEM.match(self.text, at)
        if not begin:
            return None
        if self.ends is None:
            self.ends = {}
            for m in _PEM_END.finditer(self.text):
                self.ends.setdefault(m[1], []).append(m.start())
        ends = self.ends.get(begin[1], [])
        i = bisect_left(ends, begin.end())
        return ends[i] + len(begin[0]) - 2 if i < len(ends) else None  # END is two letters shorter than BEGIN


@lru_cache(maxsize=1)
def _keywords() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


def find(text: str) -> list[Span]:
    """All spans of a text, in no order."""
    lower = text.lower()
    if len(lower) != len(text):  # some letters get longer: only A-Z then
        lower = text.translate(_LOWER)
    out: list[Span] = [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    done, blocks = dict.fromkeys(KINDS, 0), {"jwt": _Tokens(text), "private_key": _Keys(text)}
    for last, (kind, size) in _keywords().iter(lower):
        at = last + 1 - size
        if at < done[kind]:
            continue
        if kind in blocks:
            end = blocks[kind].end(at) if kind != "jwt" or text.startswith("eyJ", at) else None
            good = end is not None and (kind != "jwt" or _jwt(text[at:end]))
        else:
            pattern, holds = _RULES[kind]
            m = pattern.match(text, at)
            end, good = (m.end(), holds(m)) if m else (None, False)
        if end is not None:
            done[kind] = end
        if good:
            out.append((kind, at, end))
    return out


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text column by ``spans``: array<struct<kind, start, end>>, in code points, end exclusive."""
    return with_spans(df, find, KINDS, text_col)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The text with every secret replaced by ``[SECRET]``; a null text stays null.
    All other columns, their order included, stay."""
    def run(texts: list) -> dict:
        return {text_col: [t and masked(t, find(t), lambda _: "[SECRET]") for t in texts]}

    return map_column(df, text_col, f"`{text_col}` string", run).select(*map(named, df.columns))
