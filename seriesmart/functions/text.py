"""Column-level text cleaning.  All built-in expressions (codegen, JVM side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace):
# ASCII tab, LF, VT, FF, CR, the separators 0x1C-0x1F, space, NEL, NBSP and
# the Unicode space separators.  Trimming with this set (btrim, no regex)
# gives the same fields as the reference's per-field strip.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")

DEFAULT_NULL_TOKENS = ("", "-")
LEGACY_NULL_TOKENS = ("", "NA", "NaN")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def kept_here(c: Column | str) -> Column:
    """The value by an expression that isn't deterministic: filters above stay above, where they test the column
    made here; pushed below, they would make it anew for each of its uses in them."""
    return F.when(F.spark_partition_id() >= 0, _c(c))


def first_visible(c: Column) -> Column:
    """Whether a text starts with a visible ASCII character (strings are compared by their bytes)."""
    return (c >= "!") & (c < "\x7f")


def clean_text(c: Column | str) -> Column:
    """Trim white space on both sides, Unicode-aware (F.trim keeps \\r, \\t, NBSP).

    Most fields start and end with a visible ASCII character; they are passed
    through, as ``btrim`` compares character by character with the whole set."""
    c = _c(c)
    last = F.substring(c.cast("binary"), -1, 1)      # of bytes: characters would be counted from the start
    visible = first_visible(c) & (last >= F.lit(b"!")) & (last <= F.lit(b"~"))
    return F.when(visible, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def is_blank(c: Column | str) -> Column:
    """True when the text has no non-space character (NULL stays NULL).

    Most lines start with a visible character, so that is tested first and
    the trimmed copy is only made for the rest."""
    c = _c(c)
    return F.when(first_visible(c), F.lit(False)).otherwise(F.btrim(c, F.lit(WHITESPACE)) == "")


def strip_nul(c: Column | str) -> Column:
    """Remove NUL bytes; text without one is passed through without a copy."""
    c = _c(c)
    return F.when(F.contains(c, F.lit("\x00")), F.translate(c, "\x00", "")).otherwise(c)


def strip_quotes(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), r'^"+|"+$', "")


def null_if_token(c: Column | str, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """NULL when the value equals one of ``tokens``; other values unchanged."""
    c = _c(c)
    tokens = list(tokens)
    if not tokens:
        return c
    return F.when(~c.isin(tokens), c)


def clean_field(c: Column | str, tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
                drop_nul: bool = False) -> Column:
    """Trim, optionally drop NUL bytes, then map null tokens to NULL."""
    c = _c(c)
    if drop_nul:
        c = strip_nul(c)
    return null_if_token(clean_text(c), tokens)
