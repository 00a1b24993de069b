"""The status report: rows per table and the newest log rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.aggregates import table_counts
from ..operators.loadlog import recent_log


def status_report(tables: Mapping[str, DataFrame], log: DataFrame, n: int = 10):
    """(counts per table, the ``n`` newest log rows) as two DataFrames."""
    return table_counts(tables, name_col="table", count_col="rows"), recent_log(log, n)
