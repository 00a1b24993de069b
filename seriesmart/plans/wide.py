"""One plan for all ten wide tables: facts x series x code lists -> DDL columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.casts import cast_value
from ..functions.labels import period_label
from ..operators.aggregates import year_range
from ..operators.denorm import denormalize
from ..operators.ids import with_surrogate_id
from .specs import DatasetSpec


def _year_policy(facts: DataFrame, spec: DatasetSpec) -> DataFrame:
    if spec.null_year == "drop":
        return facts.filter(F.col("year").isNotNull())
    if spec.null_year == "error":
        y = F.col("year")
        return facts.withColumn("year", F.when(y.isNull(), F.raise_error(
            F.concat(F.lit(f"{spec.table}: NULL year for series "),
                     F.coalesce(F.col("series_id"), F.lit("?")))).cast("int")).otherwise(y))
    return facts


def wide_table(facts: DataFrame, series: DataFrame, dims: Mapping[str, DataFrame],
               spec: DatasetSpec, mode: str = "strict", years: tuple[int, int] | None = None,
               with_id: bool | None = None, max_rows: int | None = None,
               series_rows: int | None = None, observation: Observation | None = None,
               values_observation: Observation | None = None,
               dim_rows: dict | None = None,
               place: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The wide table of ``spec`` from parsed facts, series and code lists.

    ``years`` keeps a year range (pushed to the fact scan).  ``mode`` is the
    value cast: ``strict`` fails on text that is not a number or does not fit
    the column's NUMERIC(p,s); ``tolerant`` stores NULL instead.  With
    ``observation`` the facts without a series are counted (``orphan_facts``),
    with ``values_observation`` the fact values that do not fit the column
    (``bad_values``) and the facts dropped for a NULL year (``null_years``) -
    all during the same pass.  ``dim_rows`` and ``place`` as in ``denormalize``; a
    surrogate id is numbered there, on the rows with the columns that are needed.
    """
    facts = facts.select(*[c for c in spec.fact_columns if c in facts.columns])
    if years is not None:
        facts = year_range(facts, years[0], years[1], "year")
    if values_observation is not None:
        raw, dropped = F.col("value"), F.col("year").isNull() & F.lit(spec.null_year == "drop")
        facts = facts.observe(values_observation,
                              F.count_if(~dropped & raw.isNotNull() & raw.try_cast(spec.value_type).isNull())
                              .cast("bigint").alias("bad_values"),
                              F.count_if(dropped).cast("bigint").alias("null_years"))
    facts = _year_policy(facts, spec)
    lookups = list(spec.lookups)
    if spec.period_name == "case":
        lookups = [lk for lk in lookups if lk.dim != "period"]
    with_id = spec.surrogate_id if with_id is None else with_id

    def placed(rows: DataFrame) -> DataFrame:
        rows = place(rows) if place is not None else rows
        if not with_id:
            return rows
        exprs = [*spec.code_from.values(), *(lk.key_sql or lk.key for lk in lookups)]
        needed = {*spec.output_names, *(lk.name_out for lk in lookups), *re.findall(r"\w+", " ".join(exprs))}
        return with_surrogate_id(rows.select(*[c for c in rows.columns if c in needed]), ["series_id", "year", "period"])

    wide = denormalize(facts, series, dims, lookups, fact_key="series_id", max_rows=max_rows,
                       series_rows=series_rows, observation=observation, dim_rows=dim_rows,
                       place=placed if with_id or place is not None else None)
    produced = {lk.name_out for lk in lookups}
    out = []
    for name, typ, _ in spec.columns:
        if name == "value":
            out.append(cast_value("value", typ, mode, what=f"{spec.table}.value").alias(name))
        elif name == "period_name" and spec.period_name == "case":
            out.append(period_label("period").alias(name))
        elif name in spec.code_from:
            out.append(F.expr(spec.code_from[name]).alias(name))
        elif name in produced or name in wide.columns:
            out.append(F.col(name))
        else:
            out.append(F.lit(None).cast("string").alias(name))
    return wide.select(*(["id"] if with_id else []), *out)
