from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_segment(c: Column | str, n: int = -2) -> Column:
    """Path segment ``n`` of ``split(url, '/')`` (negative counts from the end)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(F.split(c, "/", -1), F.lit(n))
