"""Period and seasonal labels of the wide tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period code -> label, as the wide tables must show them.
# Codes not listed keep their own text.
PERIOD_LABELS = {
    "M01": "JAN", "M02": "FEB", "M03": "MAR", "M04": "APR",
    "M05": "MAY", "M06": "JUN", "M07": "JUL", "M08": "AUG",
    "M09": "SEP", "M10": "OCT", "M11": "NOV", "M12": "DEC",
    "M13": "AN AV",
    "S01": "HALF1", "S02": "HALF2", "S03": "AN AV",
    "Q01": "QTR1", "Q02": "QTR2", "Q03": "QTR3", "Q04": "QTR4",
    "A01": "AN AV",
}

# Seasonal flag -> text for datasets without a seasonal file.
SEASONALLY_ADJUSTED = "Seasonally Adjusted"
NOT_SEASONALLY_ADJUSTED = "Not Seasonally Adjusted"


def _period_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(PERIOD_LABELS.items())])


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def period_label(c: Column | str) -> Column:
    """Label of a period code; unknown codes are kept as they are."""
    c = _c(c)
    return F.coalesce(_period_map()[c], c)


def seasonal_label(c: Column | str, adjusted: str = "S", unadjusted: str = "U") -> Column:
    """Seasonal flag to text; anything else gives NULL."""
    c = _c(c)
    return (F.when(c == adjusted, F.lit(SEASONALLY_ADJUSTED))
            .when(c == unadjusted, F.lit(NOT_SEASONALLY_ADJUSTED)))


def seasonal_from_id(c: Column | str, pos: int = 3) -> Column:
    """Seasonal code taken from a fixed position of the series id (1-based)."""
    return F.substring(_c(c), pos, 1)
