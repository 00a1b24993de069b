"""Byte-pair encoding by backtracking over longest token matches, and decoding.

Encoding finds, with one Aho-Corasick pass over a piece of text, the longest
token that starts at each byte, and takes them greedily.  A token may follow
another only if merging could not have joined bytes across their border; that
is looked up in a pair table which is filled on demand.  Where a token does not
fit, its next shorter prefix token is tried, then the token before is taken
back; a byte position that led nowhere is never tried again, so the work is
linear in the piece.  The result is exactly that of applying the merges by
rank.  Decoding cuts the bytes of all tokens out of one blob by an offset table.

The vocabulary file (byte-level BPE in the JSON form of public tokenizers) is a
parameter: a path that every executor can read.

Defined results: a null or empty text has no ids; null ids decode to an empty
text; an id outside the vocabulary adds nothing; bytes that are not UTF-8
become U+FFFD; repeated rows give repeated results; an empty table gives an
empty one; further columns pass through.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_column

#: Fixed value: the public pattern that splits text before the merges (words
#: first, as they are the most frequent and share no beginning with the others).
PATTERN = (r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pieces, and checked pairs, that a worker keeps: as many new ones, and the
#: ones before them that were used again.
MEMO = 180_000
#: Ids that are decoded at once.
STEP = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """What encoding and decoding need of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]

        # A token's rank: single bytes first, then the merges in their order.
        names = sorted((t for t in vocab if len(t) == 1), key=vocab.get)
        rank = {t: r for r, t in enumerate(names)}
        self.single = len(names)
        self.parts: list[tuple[int, int]] = [(r, r) for r in range(len(names))]
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if (t := a + b) not in rank and a in rank and b in rank and t in vocab:
                rank[t] = len(names)
                names.append(t)
                self.parts.append((rank[a], rank[b]))
            if t in rank:
                self.joined.setdefault((rank[a], rank[b]), rank[t])
        self.ids = np.array([vocab[t] for t in names], np.int32)
        texts = [raw(t).decode("latin-1") for t in names]
        self.length = [len(t) for t in texts]
        at = {t: r for r, t in enumerate(texts)}
        self.shorter = [next((at[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in at), -1) for t in texts]
        self.automaton = ahocorasick.Automaton()
        for t, r in at.items():
            if len(t) > 1:
                self.automaton.add_word(t, r)
        self.bytes = [at.get(chr(b), -1) for b in range(256)]
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, bytes] = {}  # ids of a piece as int32
        self.before: dict[str, bytes] = {}
        self.pieces = regex.compile(PATTERN)
        self.added = added
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

        by_id = {i: raw(t) for t, i in vocab.items()} | {i: t.encode() for t, i in added.items()}
        lengths = np.zeros(max(by_id, default=-1) + 2, np.int64)
        for i, t in by_id.items():
            lengths[i + 1] = len(t)
        self.offsets = lengths.cumsum()
        self.blob = np.frombuffer(b"".join(by_id[i] for i in sorted(by_id)), np.uint8)

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves ``a`` and ``b`` side by side: undoing the later
        merge again and again, what touches at their border is never joined by a
        merge that comes before those undone."""
        left, right, limit = a, b, len(self.parts)
        joined, parts, single = self.joined, self.parts, self.single
        while joined.get((left, right), limit) >= limit:
            if left < single and right < single:
                return True
            if left > right:
                limit, left = left, parts[left][1]
            else:
                limit, right = right + 1, parts[right][0]
        return False

    def encode_piece(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        n, length, shorter, pairs = len(raw), self.length, self.shorter, self.pairs
        longest = [*map(self.bytes.__getitem__, raw), -1]
        for end, r in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - length[r]] = r  # a later end is a longer token
        if len(pairs) > MEMO:
            pairs.clear()
        out: list[int] = []
        dead: set[int] = set()
        pos, token, last = 0, longest[0], -1
        while pos < n:
            while token >= 0:
                end = pos + length[token]
                if end not in dead:
                    if last < 0:
                        break
                    ok = pairs.get((last, token))
                    if ok is None:
                        ok = pairs[last, token] = self.fits(last, token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos, last, token = end, token, longest[end]
            elif last < 0:
                raise ValueError("a byte of the text is not in the vocabulary")
            else:
                dead.add(pos)
                token = out.pop()
                pos -= length[token]
                last = out[-1] if out else -1
        return self.ids[out].tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        parts = self.special.split(text) if self.special and any(t in text for t in self.added) else (text,)
        found: list[bytes] = []
        memo = self.memo
        for part in parts:
            if part in self.added:
                found.append(np.int32(self.added[part]).tobytes())
                continue
            pieces = self.pieces.findall(part)
            got = list(map(memo.get, pieces))
            if None in got:
                for k, piece in enumerate(pieces):
                    if got[k] is None:
                        got[k] = memo.get(piece) or self.before.get(piece) or self.encode_piece(piece)
                        if len(piece) <= 64:
                            memo[piece] = got[k]
                if len(memo) > MEMO:
                    self.before, self.memo = memo, (memo := {})
            found += got
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids) -> str:
        ids = np.asarray(ids if ids is not None else (), np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        out = []
        for at in range(0, len(ids), STEP):
            some = ids[at:at + STEP]
            start, size = self.offsets[some], self.offsets[some + 1] - self.offsets[some]
            end = size.cumsum()
            out.append(self.blob[np.repeat(start - end + size, size) + np.arange(end[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tables(path: str) -> Tables:
    return Tables(path)


def _lists(many: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(many) + 1, np.int32)
    np.cumsum([len(x) for x in many], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(many) if many else [], pa.int32()))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Replace the text column by its token ids (array<int>)."""
    return map_column(df, text_col, f"`{ids_col}` array<int>",
                      lambda texts: {ids_col: _lists([tables(path).encode(x) for x in texts])})


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Replace the ids by the text that they stand for."""
    return map_column(df, ids_col, f"`{text_col}` string",
                      lambda many: {text_col: [tables(path).decode(x) for x in many]})


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded", keep: bool = False) -> DataFrame:
    """Replace the text column by its ids and the text decoded from these, in one pass; with ``keep``, add them."""
    def run(texts: list) -> dict:
        many = [tables(path).encode(x) for x in texts]
        return {ids_col: _lists(many), decoded_col: [tables(path).decode(x) for x in many]}

    return map_column(df, text_col, f"`{ids_col}` array<int>, `{decoded_col}` string", run, keep)
