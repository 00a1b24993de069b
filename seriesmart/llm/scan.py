"""What the two span scanners (personal data, secrets) share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .common import map_column

Span = tuple[str, int, int]
SPANS = "spans array<struct<kind:string,start:int,end:int>>"


def with_spans(df: DataFrame, find: Callable[[str], list[Span]], kinds: list[str], text_col: str) -> DataFrame:
    """Replace the text column by its spans, by start and then by kind as listed."""
    order = {k: i for i, k in enumerate(kinds)}

    def run(texts: list) -> dict:
        return {"spans": [[{"kind": k, "start": s, "end": e} for k, s, e in
                           sorted(find(t or ""), key=lambda x: (x[1], order[x[0]], x[2]))] for t in texts]}

    return map_column(df, text_col, SPANS, run)


def masked(text: str, spans: list[Span], mark: Callable[[str], str]) -> str:
    """The text with each run of overlapping spans replaced by the mark of its first kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], mark(kind)]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text
