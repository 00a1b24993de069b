"""Personal data by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs (also written out), schemes,
plus-digit, digit-dot-digit and digit pairs, and cue words of accounts.  From
each anchor a local parser takes the longest stretch of characters that a kind
may consist of and validates what it finds there (parts of an address, Luhn and
mod-97 sums, numbers of digits).  A stretch lies wholly within characters that
its kind allows, so that scanning the stretches gives the same leftmost,
non-overlapping matches as scanning the whole text.

Kinds: ``email``, ``ip``, ``card``, ``phone`` (the base rules), and besides
``email_spelled`` (``name [at] host [dot] org``), ``url_login`` (a URL with
user and password), ``iban`` (mod-97) and ``account`` (a cue such as
"account no." before 8 to 12 digits, which are the span).

Defined results: a null or empty text has no spans; ties start at the same
place and follow the order of the kinds; repeated rows give repeated results;
texts are scanned whole; further columns pass through.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from .scan import Span, masked, with_spans

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "email_spelled", "url_login", "iban", "account"]

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOTTED = _DIGITS | {"."}
_SPACED = _DIGITS | {" ", "-"}
_SPELLED = re.compile(r"([A-Za-z0-9._%+-]+)\x20?[(\[{]at[)\]}]\x20?([A-Za-z0-9-]+(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]+)+)", re.I | re.A)
_LOGIN = re.compile(r"://[^\s/@:]+:[^\s/@]+@[^\s/@]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"(?:account|acct)\.?\x20?(?:number|no\.?|nr\.?|#)?\x20?[:=]?\x20?([0-9]{8,12})(?![0-9])", re.I | re.A)


def luhn(digits: str) -> bool:
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(int(d) if k % 2 == 0 else doubled[int(d)] for k, d in enumerate(reversed(digits))) % 10 == 0


def iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    cues = {"@": "at", "://": "scheme"}
    cues |= {f"{x}at{y}": "spelled" for x in "([{" for y in ")]}"}
    cues |= {f"{x}AT{y}": "spelled" for x in "([{" for y in ")]}"}
    cues |= {w: "account" for w in ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")}
    for d in _DIGITS:
        cues[f"+{d}"] = "plus"
        for e in _DIGITS:
            cues |= {f"{d}.{e}": "dot", d + e: "digits", f"{d} {e}": "digits", f"{d}-{e}": "digits"}
    for k, v in cues.items():
        a.add_word(k, (v, len(k)))
    a.make_automaton()
    return a


def _stretch(text: str, at: int, allowed: frozenset, least: int) -> tuple[int, int]:
    """The run of allowed characters around ``at``, from ``least`` on."""
    a = b = at
    while a > least and text[a - 1] in allowed:
        a -= 1
    n = len(text)
    while b < n and text[b] in allowed:
        b += 1
    return a, b


def find(text: str) -> list[Span]:
    """All spans of a text, in no order."""
    out: list[Span] = []
    done = dict.fromkeys(("email", "dot", "digits", "phone", "spelled", "account"), 0)
    for last, (cue, size) in _anchors().iter(text):
        at = last + 1 - size
        if cue == "at":
            m = _HOST.match(text, at)
            if m:
                a = _stretch(text, at, _LOCAL, done["email"])[0]
                if a < at:
                    out.append(("email", a, m.end()))
                    done["email"] = m.end()
        elif cue == "dot" and at >= done["dot"]:
            a, b = _stretch(text, at, _DOTTED, done["dot"])
            done["dot"] = b
            out += [("ip", m.start(), m.end()) for m in _IP.finditer(text, a, b)
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        elif cue == "digits" and at >= done["digits"]:
            a, b = _stretch(text, at, _SPACED, done["digits"])
            done["digits"] = b
            if b - a >= 14:
                for m in _CARD.finditer(text, a, b):
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", m.start(), m.end()))
            m = _IBAN.match(text, at - 2) if at >= 2 and text[at - 2].isupper() and text[at - 1].isupper() else None
            if m and (at < 3 or not text[at - 3].isalnum()):
                end = m.end()
                while end - m.start() >= 15 and not iban(text[m.start():end]):
                    end -= 1  # a following word in capitals isn't part of it
                if end - m.start() >= 15:
                    out.append(("iban", m.start(), end - (text[end - 1] == " ")))
        elif cue == "plus" and at >= done["phone"]:
            m = _PHONE.match(text, at)
            if m:
                done["phone"] = m.end()
                if 10 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    out.append(("phone", m.start(), m.end()))
        elif cue == "spelled" and at >= done["spelled"]:
            a = at - 1 if at and text[at - 1] == " " else at
            a = _stretch(text, a, _LOCAL, done["spelled"])[0]
            m = _SPELLED.match(text, a)
            if m:
                out.append(("email_spelled", m.start(), m.end()))
                done["spelled"] = m.end()
        elif cue == "scheme":
            m = _LOGIN.match(text, at)
            if m:
                a = at
                while a and text[a - 1].isalpha() and text[a - 1].isascii():
                    a -= 1
                if a < at:
                    out.append(("url_login", a, m.end()))
        elif cue == "account" and at >= done["account"]:
            m = _ACCOUNT.match(text, at)
            if m:
                out.append(("account", m.start(1), m.end(1)))
                done["account"] = m.end()
    return out


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text column by ``spans``: array<struct<kind, start, end>>, in code points, end exclusive."""
    return with_spans(df, find, KINDS, text_col)


def redact(text: str) -> str:
    return masked(text, find(text), lambda kind: f"[{kind.upper()}]")
