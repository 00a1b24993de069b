"""The dataset catalog: ten surveys, each a fact file, a series file and code lists.

A ``DatasetSpec`` is data: which positional columns the series file has,
which code lists are looked up on which column, and the wide table's columns
and types.  One generic plan (``plans.wide.wide_table``) builds every table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from ..operators.denorm import Lookup

FACT_COLUMNS = ("series_id", "year", "period", "value", "footnote_codes")


def parse_ddl(ddl: str) -> tuple[tuple[str, str, bool], ...]:
    """``"name type [not null], ..."`` -> ((name, type, not_null), ...)."""
    out = []
    for part in re.split(r",\s*(?![^()]*\))", ddl.strip()):
        words = part.split()
        out.append((words[0], words[1].lower(), "not null" in part.lower()))
    return tuple(out)


@dataclass(frozen=True)
class DatasetSpec:
    key: str
    title: str
    table: str
    data_file: str
    series_file: str
    dimension_files: dict = field(hash=False, compare=False)
    series_columns: tuple
    lookups: tuple                  # Lookup, in output order
    columns: tuple                  # (name, type, not_null) of the wide table
    code_from: dict = field(default_factory=dict, hash=False, compare=False)  # out col -> SQL on the row
    fact_columns: tuple = FACT_COLUMNS
    period_name: str = "case"       # 'case' (fixed labels, code kept) or 'lookup' (period file)
    null_year: str = "drop"         # 'keep', 'drop' or 'error'
    chunk_years: int | None = 10
    surrogate_id: bool = False
    primary_key: tuple = ("series_id", "year", "period")
    # per code list (key column, name column) when not (0, 1)
    dim_columns: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def value_type(self) -> str:
        return dict((n, t) for n, t, _ in self.columns)["value"]

    @property
    def output_names(self) -> tuple:
        return tuple(n for n, _, _ in self.columns)

    def struct_type(self):
        """The wide table as a Spark schema (VARCHAR(n) as string - lengths
        are checked by the load, not by the file format)."""
        from pyspark.sql import types as T
        fields = [] if not self.surrogate_id else [T.StructField("id", T.LongType(), False)]
        for name, typ, nn in self.columns:
            t = "string" if typ.startswith("varchar") else typ
            fields.append(T.StructField(name, T.DataType.fromDDL(t), not nn))
        return T.StructType(fields)


def _lk(dim: str, key: str, name_out: str | None = None, on: str = "series",
        key_sql: str | None = None) -> Lookup:
    return Lookup(dim=dim, name_out=name_out or f"{dim}_name", key=key, key_sql=key_sql, on=on)


# The ten datasets' raw file names, positional series columns,
# code lists and target table layouts (column names, VARCHAR lengths, NUMERIC
# precision, NOT NULL). They must equal the published files and the wide
# tables users query, so they are stated as data below.
_HEAD = "series_id varchar(20) not null, year int not null, period varchar(3) not null"

DATASETS: dict[str, DatasetSpec] = {}


def _add(spec: DatasetSpec) -> None:
    DATASETS[spec.key] = spec


_add(DatasetSpec(
    key="cpi", title="Consumer Price Index", table="cpi_data",
    data_file="cu.data.1.AllItems", series_file="cu.series",
    dimension_files={"area": "cu.area", "item": "cu.item", "period": "cu.period",
                     "seasonal": "cu.seasonal"},
    series_columns=("series_id", "area_code", "item_code", "seasonal"),
    lookups=(_lk("area", "area_code"), _lk("item", "item_code"),
             _lk("period", "period", "period_name", on="fact"),
             _lk("seasonal", "seasonal", "seasonal_text")),
    columns=parse_ddl("series_id varchar(20), year int, period varchar(5), period_name varchar(50), "
                      "value decimal(15,4), area_code varchar(10), area_name varchar(255), "
                      "item_code varchar(20), item_name varchar(500), seasonal_code varchar(1), "
                      "seasonal_text varchar(50)"),
    code_from={"seasonal_code": "seasonal"},
    fact_columns=("series_id", "year", "period", "value"),
    period_name="lookup", null_year="keep", chunk_years=None, surrogate_id=True, primary_key=()))

_add(DatasetSpec(
    key="ppi", title="Producer Price Index", table="ppi_data",
    data_file="pr.data.1.AllData", series_file="pr.series",
    dimension_files={"measure": "pr.measure", "sector": "pr.sector", "class": "pr.class",
                     "duration": "pr.duration", "period": "pr.period", "seasonal": "pr.seasonal"},
    series_columns=("series_id", "sector_code", "class_code", "measure_code", "duration_code",
                    "seasonal"),
    lookups=(_lk("measure", "measure_code"), _lk("sector", "sector_code"), _lk("class", "class_code"),
             _lk("duration", "duration_code"), _lk("period", "period", "period_name", on="fact"),
             _lk("seasonal", "seasonal")),
    columns=parse_ddl(_HEAD + ", period_name varchar(20), value decimal(12,4), "
                      "measure_code varchar(2), measure_name varchar(100), sector_code varchar(10), "
                      "sector_name varchar(200), class_code varchar(10), class_name varchar(200), "
                      "duration_code varchar(2), duration_name varchar(50), seasonal_code varchar(1), "
                      "seasonal_name varchar(20), footnote_codes varchar(10)"),
    code_from={"seasonal_code": "seasonal"},
    period_name="lookup", null_year="error", chunk_years=None))

_add(DatasetSpec(
    key="employment", title="Current Employment Statistics", table="ce_data",
    data_file="ce.data.0.AllCESSeries", series_file="ce.series",
    dimension_files={"supersector": "ce.supersector", "industry": "ce.industry",
                     "datatype": "ce.datatype", "period": "ce.period", "seasonal": "ce.seasonal"},
    series_columns=("series_id", "supersector_code", "industry_code", "datatype_code", "seasonal"),
    lookups=(_lk("supersector", "supersector_code"), _lk("industry", "industry_code"),
             _lk("datatype", "datatype_code"), _lk("period", "period", "period_name", on="fact"),
             _lk("seasonal", "seasonal")),
    columns=parse_ddl(_HEAD + ", period_name varchar(20), value decimal(14,2), "
                      "supersector_code varchar(5), supersector_name varchar(100), "
                      "industry_code varchar(10), industry_name varchar(200), datatype_code varchar(5), "
                      "datatype_name varchar(100), seasonal_code varchar(1), seasonal_name varchar(30), "
                      "footnote_codes varchar(10)"),
    code_from={"seasonal_code": "seasonal"},
    period_name="lookup", null_year="error", chunk_years=None))

_add(DatasetSpec(
    key="unemployment", title="Local Area Unemployment Statistics", table="la_data",
    data_file="la.data.2.AllStatesU", series_file="la.series",
    dimension_files={"area": "la.area", "area_type": "la.area_type", "measure": "la.measure",
                     "seasonal": "la.seasonal", "state": "la.state_region_division"},
    series_columns=("series_id", "area_type_code", "area_code", "measure_code", "seasonal",
                    "srd_code", "series_title", "footnote_codes", "begin_year", "begin_period",
                    "end_year", "end_period"),
    lookups=(_lk("area_type", "area_type_code"), _lk("area", "area_code"),
             _lk("measure", "measure_code"), _lk("seasonal", "seasonal"), _lk("state", "srd_code")),
    columns=parse_ddl(_HEAD + ", period_name varchar(50), value decimal(14,2), "
                      "area_type_code varchar(2), area_type_name varchar(100), area_code varchar(20), "
                      "area_name varchar(200), measure_code varchar(2), measure_name varchar(100), "
                      "seasonal_code varchar(1), seasonal_name varchar(30), state_code varchar(2), "
                      "state_name varchar(100), footnote_codes varchar(10)"),
    code_from={"seasonal_code": "seasonal", "state_code": "srd_code"}))

_add(DatasetSpec(
    key="jolts", title="Job Openings and Labor Turnover Survey", table="jt_data",
    data_file="jt.data.1.AllItems", series_file="jt.series",
    dimension_files={"industry": "jt.industry", "state": "jt.state", "area": "jt.area",
                     "sizeclass": "jt.sizeclass", "dataelement": "jt.dataelement",
                     "ratelevel": "jt.ratelevel", "seasonal": "jt.seasonal"},
    series_columns=("series_id", "seasonal", "industry_code", "state_code", "area_code",
                    "sizeclass_code", "dataelement_code", "ratelevel_code", "footnote_codes",
                    "begin_year", "begin_period", "end_year", "end_period"),
    lookups=(_lk("industry", "industry_code"), _lk("state", "state_code"), _lk("area", "area_code"),
             _lk("sizeclass", "sizeclass_code"), _lk("dataelement", "dataelement_code"),
             _lk("ratelevel", "ratelevel_code"), _lk("seasonal", "seasonal")),
    columns=parse_ddl("series_id varchar(22) not null, year int not null, period varchar(3) not null, "
                      "period_name varchar(50), value decimal(14,2), industry_code varchar(10), "
                      "industry_name varchar(200), state_code varchar(10), state_name varchar(100), "
                      "area_code varchar(10), area_name varchar(200), sizeclass_code varchar(10), "
                      "sizeclass_name varchar(100), dataelement_code varchar(10), "
                      "dataelement_name varchar(100), ratelevel_code varchar(10), "
                      "ratelevel_name varchar(50), seasonal_code varchar(10), seasonal_name varchar(30), "
                      "footnote_codes varchar(10)"),
    code_from={"seasonal_code": "seasonal"}))

_add(DatasetSpec(
    key="state_employment", title="State and Area Employment", table="sa_data",
    data_file="sa.data.0.Current", series_file="sa.series",
    dimension_files={"area": "sa.area", "state": "sa.state", "industry": "sa.industry",
                     "data_type": "sa.data_type", "detail": "sa.detail"},
    series_columns=("series_id", "state_code", "area_code", "industry_code", "detail_code",
                    "data_type_code", "seasonal"),
    lookups=(_lk("state", "state_code"), _lk("area", "area_code"), _lk("industry", "industry_code"),
             _lk("detail", "detail_code"), _lk("data_type", "data_type_code")),
    columns=parse_ddl(_HEAD + ", period_name varchar(50), value decimal(14,2), state_code varchar(2), "
                      "state_name varchar(100), area_code varchar(10), area_name varchar(200), "
                      "industry_code varchar(10), industry_name varchar(200), detail_code varchar(2), "
                      "detail_name varchar(100), data_type_code varchar(2), data_type_name varchar(100), "
                      "seasonal_code varchar(1), seasonal_name varchar(30), footnote_codes varchar(10)"),
    code_from={"seasonal_code": "seasonal",
               "seasonal_name": "CASE seasonal WHEN 'S' THEN 'Seasonally Adjusted' "
                                "WHEN 'U' THEN 'Not Seasonally Adjusted' END"}))

_add(DatasetSpec(
    key="occupational", title="Occupational Employment and Wage Statistics", table="oe_data",
    data_file="oe.data.1.AllData", series_file="oe.series",
    dimension_files={"area": "oe.area", "areatype": "oe.areatype", "industry": "oe.industry",
                     "occupation": "oe.occupation", "datatype": "oe.datatype", "sector": "oe.sector",
                     "seasonal": "oe.seasonal"},
    series_columns=("series_id", "seasonal", "areatype_code", "industry_code", "occupation_code",
                    "datatype_code", "state_code", "area_code", "sector_code", "series_title",
                    "footnote_codes", "begin_year", "begin_period", "end_year", "end_period"),
    lookups=(_lk("areatype", "areatype_code"), _lk("area", "area_code"),
             _lk("industry", "industry_code"), _lk("occupation", "occupation_code"),
             _lk("datatype", "datatype_code"), _lk("sector", "sector_code"),
             _lk("seasonal", "seasonal")),
    columns=parse_ddl("series_id varchar(35) not null, year int not null, period varchar(10) not null, "
                      "period_name varchar(50), value decimal(14,2), areatype_code varchar(10), "
                      "areatype_name varchar(100), area_code varchar(20), area_name varchar(200), "
                      "industry_code varchar(20), industry_name varchar(200), "
                      "occupation_code varchar(20), occupation_name varchar(200), "
                      "datatype_code varchar(10), datatype_name varchar(100), sector_code varchar(20), "
                      "sector_name varchar(100), seasonal_code varchar(10), seasonal_name varchar(30), "
                      "footnote_codes varchar(250)"),
    code_from={"seasonal_code": "seasonal"}))

_add(DatasetSpec(
    key="compensation", title="Compensation and Working Conditions", table="ci_data",
    data_file="ci.data.1.AllData", series_file="ci.series",
    dimension_files={"area": "ci.area", "owner": "ci.owner", "industry": "ci.industry",
                     "occupation": "ci.occupation", "estimate": "ci.estimate",
                     "periodicity": "ci.periodicity", "seasonal": "ci.seasonal"},
    series_columns=("series_id", "seasonal", "owner_code", "industry_code", "occupation_code",
                    "subcell_code", "area_code", "periodicity_code", "estimate_code"),
    lookups=(_lk("owner", "owner_code"), _lk("industry", "industry_code"),
             _lk("occupation", "occupation_code"), _lk("area", "area_code"),
             _lk("estimate", "estimate_code"), _lk("periodicity", "periodicity_code"),
             _lk("seasonal", "seasonal")),
    columns=parse_ddl(_HEAD + ", period_name varchar(50), value decimal(14,2), owner_code varchar(10), "
                      "owner_name varchar(100), industry_code varchar(10), industry_name varchar(200), "
                      "occupation_code varchar(10), occupation_name varchar(200), area_code varchar(10), "
                      "area_name varchar(200), estimate_code varchar(10), estimate_name varchar(200), "
                      "periodicity_code varchar(10), periodicity_name varchar(50), "
                      "seasonal_code varchar(10), seasonal_name varchar(30), footnote_codes varchar(10)"),
    code_from={"seasonal_code": "seasonal"}))

_add(DatasetSpec(
    key="productivity", title="Major Sector Total Factor Productivity", table="mp_data",
    data_file="mp.data.1.AllData", series_file="mp.series",
    dimension_files={"sector": "mp.sector", "measure": "mp.measure", "duration": "mp.duration",
                     "seasonal": "mp.seasonal"},
    series_columns=("series_id", "sector_code", "measure_code", "duration_code", "base_year",
                    "series_title", "footnote_codes", "begin_year", "begin_period", "end_year",
                    "end_period"),
    lookups=(_lk("sector", "sector_code"), _lk("measure", "measure_code"),
             _lk("duration", "duration_code"),
             _lk("seasonal", None, key_sql="substring(series_id, 3, 1)")),
    columns=parse_ddl(_HEAD + ", period_name varchar(50), value decimal(14,2), sector_code varchar(10), "
                      "sector_name varchar(200), measure_code varchar(10), measure_name varchar(100), "
                      "duration_code varchar(10), duration_name varchar(100), seasonal_code varchar(10), "
                      "seasonal_name varchar(30), footnote_codes varchar(10)"),
    code_from={"seasonal_code": "substring(series_id, 3, 1)"}))

_add(DatasetSpec(
    key="state_metro", title="State and Metropolitan Area Employment", table="sm_data",
    data_file="sm.data.1.AllData", series_file="sm.series",
    dimension_files={"state": "sm.state", "area": "sm.area", "supersector": "sm.supersector",
                     "industry": "sm.industry", "data_type": "sm.data_type", "seasonal": "sm.seasonal"},
    series_columns=("series_id", "state_code", "area_code", "supersector_code", "industry_code",
                    "data_type_code", "seasonal_code"),
    lookups=(_lk("state", "state_code"), _lk("area", "area_code"),
             _lk("supersector", "supersector_code"), _lk("industry", "industry_code"),
             _lk("data_type", "data_type_code"), _lk("seasonal", "seasonal_code")),
    columns=parse_ddl("series_id varchar(22) not null, year int not null, period varchar(3) not null, "
                      "period_name varchar(50), value decimal(14,2), state_code varchar(2), "
                      "state_name varchar(100), area_code varchar(10), area_name varchar(200), "
                      "supersector_code varchar(2), supersector_name varchar(100), "
                      "industry_code varchar(10), industry_name varchar(200), data_type_code varchar(2), "
                      "data_type_name varchar(100), seasonal_code varchar(1), seasonal_name varchar(30), "
                      "footnote_codes varchar(10)"),
    chunk_years=2))


def select_datasets(names: str | Iterable[str] | None) -> list[DatasetSpec]:
    """``'all'`` (or nothing) gives every dataset; otherwise a comma list,
    trimmed and lower-cased; unknown names are ignored."""
    if names is None:
        return list(DATASETS.values())
    if isinstance(names, str):
        names = names.split(",")
    keys = [n.strip().lower() for n in names]
    if "all" in keys:
        return list(DATASETS.values())
    return [DATASETS[k] for k in keys if k in DATASETS]
