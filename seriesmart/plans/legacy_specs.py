"""The older loader's catalog: thirteen datasets of header-named files.

A dataset is one file, several numbered parts, or (the quarterly census) one
file a year; its table has the listed columns plus ``loaded_at``.
"""

from __future__ import annotations

from dataclasses import dataclass

from .legacy import LegacySpec

_SERIES = "series_id string, year int, period string, value numeric"
_NOTE = _SERIES + ", footnote_codes string"
_SPAN = "begin_year int, begin_period string, end_year int, end_period string"

# The datasets' keys, titles, column names in table order and
# types. They must equal the published files' headers and the tables users
# query, so they are stated as data.
_LAYOUTS = {
    "cu": ("cpi", "Consumer Price Index", _SERIES + ", seasonal string, base_period string, series_title string, " + _SPAN
           + ", aspect_type string, aspect_value string, area_name string, base_name string, item_name string, "
           "period_abbr string, period_name string, periodicity_name string, date date"),
    "ce": ("employment", "Current Employment Statistics", _NOTE),
    "qcew": ("qcew", "Quarterly Census of Employment and Wages",
             "area_fips string, industry_code string, own_code int, agglvl_code int, size_code int, year int, qtr int, "
             "disclosure_code string, qtrly_estabs int, month1_emplvl int, month2_emplvl int, month3_emplvl int, "
             "total_qtrly_wages numeric, taxable_qtrly_wages numeric, qtrly_contributions numeric, avg_wkly_wage numeric, "
             "lq_disclosure_code string, lq_qtrly_estabs numeric, lq_month1_emplvl numeric, lq_month2_emplvl numeric, "
             "lq_month3_emplvl numeric, lq_total_qtrly_wages numeric, lq_taxable_qtrly_wages numeric, "
             "lq_qtrly_contributions numeric, lq_avg_wkly_wage numeric, oty_disclosure_code string, "
             "oty_qtrly_estabs_chg int, oty_qtrly_estabs_pct_chg numeric, oty_month1_emplvl_chg int, "
             "oty_month1_emplvl_pct_chg numeric, oty_month2_emplvl_chg int, oty_month2_emplvl_pct_chg numeric, "
             "oty_month3_emplvl_chg int, oty_month3_emplvl_pct_chg numeric, oty_total_qtrly_wages_chg numeric, "
             "oty_total_qtrly_wages_pct_chg numeric, oty_taxable_qtrly_wages_chg numeric, "
             "oty_taxable_qtrly_wages_pct_chg numeric, oty_qtrly_contributions_chg numeric, "
             "oty_qtrly_contributions_pct_chg numeric, oty_avg_wkly_wage_chg numeric, oty_avg_wkly_wage_pct_chg numeric, "
             "date date, industry_title string, ind_level string, naics_2d string, sector string, vintage_start int, "
             "vintage_end int, area_title string, area_type string, stfips string, specified_region string"),
    "la": ("unemployment", "Local Area Unemployment Statistics (State-level)", _NOTE),
    "sa": ("state_employment", "State and Area Employment",
           _NOTE + ", series_title string, area_code string, area_type_code string, supersector_code string, industry_code string, "
           "data_type_code string, seasonal string, area_name string, supersector_name string, industry_name string, "
           "data_type_name string, date date"),
    "oe": ("occupational", "Occupational Employment and Wage Statistics",
           _NOTE + ", series_title string, area_code string, area_type_code string, industry_code string, occupation_code string, "
           "datatype_code string, area_name string, industry_name string, occupation_name string, datatype_name string, date date"),
    "is": ("import_export", "Import/Export Price Indexes",
           _NOTE + ", series_title string, area_code string, area_name string, item_code string, item_name string, date date"),
    "ci": ("compensation", "Compensation and Working Conditions",
           _NOTE + ", series_title string, area_code string, area_name string, industry_code string, industry_name string, "
           "occupation_code string, occupation_name string, datatype_code string, datatype_name string, date date"),
    "jt": ("jolts", "Job Openings and Labor Turnover Survey",
           _NOTE + ", series_title string, area_code string, area_name string, industry_code string, industry_name string, "
           "dataelement_code string, dataelement_name string, ratelevel_code string, seasonal string, date date"),
    "pr": ("productivity_quarterly", "Major Sector Productivity (Quarterly)",
           _SERIES + ", seasonal string, base_year string, " + _SPAN + ", class_text string, duration_text string, "
           "measure_text string, period_abbr string, period_name string, sector_name string, date date"),
    "mp": ("productivity_annual", "Major Sector Productivity (Annual)",
           _SERIES + ", base_year string, series_title string, " + _SPAN + ", duration_text string, measure_text string, "
           "sector_name string, date date"),
    "sm": ("state_metro", "State and Metropolitan Area Employment",
           _NOTE + ", series_title string, area_code string, area_name string, supersector_code string, supersector_name string, "
           "industry_code string, industry_name string, data_type_code string, data_type_name string, seasonal string, date date"),
    "wp": ("ppi", "Producer Price Index",
           _SERIES + ", seasonal string, series_title string, " + _SPAN + ", item_code string, item_name string, "
           "group_code string, group_name string, date date"),
}
#: Type of a column of unbounded NUMERIC.
NUMERIC = "decimal(28,10)"
#: Datasets of several numbered parts, and of one file a year with its first and last year.
_PARTS = {"la": 2}
_YEARS = {"qcew": (1990, 2024)}


@dataclass(frozen=True)
class CatalogEntry:
    key: str
    title: str
    spec: LegacySpec
    parts: int = 1
    years: tuple[int, int] | None = None


def _columns(ddl: str) -> tuple[tuple[str, str], ...]:
    out = []
    for column in ddl.split(", "):
        name, kind = column.split(" ")
        out.append((name, NUMERIC if kind == "numeric" else kind))
    return tuple(out)


LEGACY_DATASETS: dict[str, CatalogEntry] = {
    key: CatalogEntry(key, title, LegacySpec(key, f"{table}_narrow", _columns(ddl)), _PARTS.get(key, 1), _YEARS.get(key))
    for key, (table, title, ddl) in _LAYOUTS.items()}


def select_legacy(names: str | None) -> list[CatalogEntry]:
    """``'all'`` (or nothing) gives every dataset, else a comma list of keys; unknown ones are ignored."""
    keys = [n.strip().lower() for n in (names or "all").split(",")]
    return [e for k, e in LEGACY_DATASETS.items() if "all" in keys or k in keys]


def year_patterns(key: str) -> list[str]:
    """Names that a yearly file may have under its landing folder."""
    return ["{root}/{year}.csv", "{root}/{year}.q1-q4.singlefile.csv", "{root}/" + key + "_{year}.csv", "{root}/{year}"]


def part_names(entry: CatalogEntry, folder: str) -> list[str]:
    """Paths of a dataset's parts in its landing folder."""
    base = f"{folder.rstrip('/')}/{entry.key}_data"
    return [base] if entry.parts == 1 else [f"{base}_{i + 1}" for i in range(entry.parts)]
