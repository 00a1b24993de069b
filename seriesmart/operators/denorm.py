"""Denormalization: facts JOIN series LEFT JOIN code lists.

Plan shape (the point of this module):

* lookups keyed on *series* columns are joined to the series first - code
  lists x series is small x small;
* the enriched series is joined to the facts once, broadcast when its size
  allows, otherwise shuffled (sort-merge; AQE splits a hot series' partition -
  the series side holds one row per key, so splitting is safe);
* lookups keyed on *fact* columns (the period list) are joined afterwards;
* so are those of code lists that the caller has counted and that can be
  broadcast: the rows then move, are sorted and numbered (``place``) with their
  codes, and get their names in the task that writes them.

That gives the same rows as joining every lookup to the fact rows, because a
series-keyed lookup depends on series columns only, but the facts are
shuffled at most once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .joins import bounded_broadcast, broadcast_limit, lookup_join


@dataclass(frozen=True)
class Lookup:
    """Left join of code list ``dim`` on a code column.

    ``key`` is a column name, or ``key_sql`` an SQL expression over the row
    (e.g. ``substring(series_id, 3, 1)``).  ``on`` says whether the code is on
    the series row (default) or on the fact row.  The name lands in
    ``name_out``.
    """
    dim: str
    name_out: str
    key: str | None = None
    key_sql: str | None = None
    on: str = "series"

    def key_col(self) -> Column:
        if self.key_sql:
            return F.expr(self.key_sql)
        return F.col(self.key)


def enrich(df: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
           max_rows: int | None = None, dim_rows: Mapping[str, int] | None = None) -> DataFrame:
    dim_rows = dim_rows or {}
    for lk in lookups:
        df = lookup_join(df, dims[lk.dim], lk.key_col(), lk.name_out, max_rows=max_rows,
                         rows=dim_rows.get(lk.dim))
    return df


def denormalize(facts: DataFrame, series: DataFrame, dims: Mapping[str, DataFrame],
                lookups: Sequence[Lookup], fact_key: str = "series_id",
                series_key: str | None = None, select: Sequence[Column | str] | None = None,
                max_rows: int | None = None, series_rows: int | None = None,
                observation: Observation | None = None,
                dim_rows: Mapping[str, int] | None = None,
                place: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Wide rows: every fact row with a series row, plus one name per lookup.

    Facts without a series row are dropped (inner join).  Series columns that
    also exist on the facts are not carried (the fact's value wins).  When
    ``select`` is given the result is projected to it, in that order.
    ``series_rows``, when the caller already counted the series, decides how
    the enriched series is joined (left lookups keep its row count);
    ``dim_rows`` likewise for the code lists; ``place`` deals and orders the joined
    rows before the names of counted, broadcast lists are looked up.  Without counts Spark's byte sizes
    decide; no job is started here.
    With ``observation`` the fact rows without a series are counted
    (``orphan_facts``) in the same pass: the join is then a left join on the
    same strategy, observed, and filtered to the matched rows.
    """
    series_key = series_key or fact_key
    keep = [c for c in series.columns if c == series_key or c not in facts.columns]
    limit, counted = broadcast_limit(facts, max_rows), dim_rows or {}
    small = {lk.dim for lk in lookups if place is not None and counted.get(lk.dim, limit + 1) <= limit}
    first = [lk for lk in lookups if lk.on == "series" and lk.dim not in small]
    s = enrich(series.select(*keep), dims, first, max_rows, dim_rows)
    s = bounded_broadcast(s, max_rows, series_rows)
    how = "inner"
    if observation is not None:
        s = s.withColumn("_has_series", F.lit(True))
        how = "left"
    if series_key == fact_key:
        wide = facts.join(s, fact_key, how)
    else:
        wide = facts.join(s, facts[fact_key] == s[series_key], how)
    if observation is not None:
        wide = (wide.observe(observation, F.count_if(F.col("_has_series").isNull())
                             .cast("bigint").alias("orphan_facts"))
                .filter(F.col("_has_series")).drop("_has_series"))
    late = [lk for lk in lookups if lk not in first]
    if place is None:
        wide = enrich(wide, dims, late, max_rows, dim_rows)
    else:
        wide = enrich(wide, dims, [lk for lk in late if lk.dim not in small], max_rows, dim_rows)
        wide = enrich(place(wide), dims, [lk for lk in late if lk.dim in small], max_rows, dim_rows)
    if select is not None:
        wide = wide.select(*select)
    return wide
