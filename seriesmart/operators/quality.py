"""Set-wise data-quality checks: keys, NOT NULL, lengths, decimal range, row counts.

Parquet tables do not enforce PRIMARY KEY / NOT NULL / VARCHAR(n) /
NUMERIC(p,s), so the load checks them itself.  Each check is one aggregate
(partial per task, then merged), never a collect of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast
from .latest import latest_per_key


def check_unique(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def has_duplicates(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key comes twice: a hash of eight bytes a row is grouped, and only
    rows whose hash comes twice (equal keys, or a collision) are compared by their keys."""
    hashed = F.xxhash64(*keys).alias("_h")
    twice = check_unique(df.select(hashed), ["_h"], "_n").select("_h")
    if not twice.limit(1).count():
        return False
    some = df.select(*keys).withColumn("_h", hashed).join(twice, "_h", "left_semi")
    return check_unique(some, keys, "_n").limit(1).count() > 0


# rules: boolean columns that are true for a violating row

def not_null(c: str) -> Column:
    return F.col(c).isNull()


def longer_than(c: str, n: int) -> Column:
    """VARCHAR(n) violation: longer than n after right-trimming blanks (characters are counted
    only where there are more than n bytes, the trim only runs for the rare value that is longer than n as it is)."""
    return (F.octet_length(F.col(c)) > n) & (F.length(F.col(c)) > n) & (F.length(F.rtrim(F.col(c))) > n)


def out_of_range(c: str, precision: int, scale: int) -> Column:
    """NUMERIC(p,s) violation: a non-NULL text that does not fit."""
    return F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({precision},{scale})").isNull()


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: for each named rule, how many rows violate it."""
    return df.agg(*[F.count_if(rule).cast("bigint").alias(name) for name, rule in rules.items()])


def table_rules(spec_columns: Sequence[tuple[str, str, bool]]) -> dict[str, Column]:
    """Rules from a DDL-like list ``(name, type, not_null)``; ``varchar(n)`` and
    ``decimal(p,s)`` types give length / range rules."""
    import re
    rules: dict[str, Column] = {}
    for name, typ, nn in spec_columns:
        if nn:
            rules[f"null_{name}"] = not_null(name)
        m = re.fullmatch(r"varchar\((\d+)\)", typ)
        if m:
            rules[f"long_{name}"] = longer_than(name, int(m.group(1)))
    return rules


def row_count_verdict(new_rows: Column | str, prev_rows: Column | str,
                      prev_status: Column | str | None = None,
                      fail_below: float = 0.5, warn_below: float = 0.9) -> Column:
    """``success`` / ``warning`` / ``failed`` for a new row count against the
    previous one.  No previous count, a previous load that did not succeed, or
    a previous count NULL or <= 0 always passes; below ``fail_below`` x prev
    fails; below ``warn_below`` x prev warns (strict ``<``)."""
    new = F.col(new_rows) if isinstance(new_rows, str) else new_rows
    prev = F.col(prev_rows) if isinstance(prev_rows, str) else prev_rows
    passes = prev.isNull() | (prev <= 0)
    if prev_status is not None:
        st = F.col(prev_status) if isinstance(prev_status, str) else prev_status
        passes = st.isNull() | (st != "success") | passes
    return (F.when(passes, F.lit("success"))
            .when(new < prev * fail_below, F.lit("failed"))
            .when(new < prev * warn_below, F.lit("warning"))
            .otherwise(F.lit("success")))


def verdict_of(new_rows: int, prev_rows: int | None, prev_status: str | None = "success",
               fail_below: float = 0.5, warn_below: float = 0.9) -> str:
    """``row_count_verdict`` of two counts the driver already has."""
    if prev_rows is None or prev_rows <= 0 or prev_status != "success":
        return "success"
    return "failed" if new_rows < prev_rows * fail_below else "warning" if new_rows < prev_rows * warn_below else "success"


#: What a new row count is compared with: the last successful load (a failed
#: load never lowers the bar), or the latest load (anything passes after a
#: load that did not succeed).
COUNT_RULES = ("last_success", "latest")


def previous_loads(log: DataFrame, rule: str) -> DataFrame:
    """The log rows that may be what a new count is compared with."""
    if rule not in COUNT_RULES:
        raise ValueError(f"count rule {rule!r} is none of {COUNT_RULES}")
    return log.filter(F.col("status") == "success") if rule == "last_success" else log


def validate_row_count(new_counts: DataFrame, log: DataFrame,
                       keys: Sequence[str] = ("dataset", "data_key"),
                       rows_col: str = "rows_loaded", rule: str = "last_success") -> DataFrame:
    """Verdict per key of ``new_counts`` (``keys..., rows_loaded``) against the
    load in the log that ``rule`` names (see ``COUNT_RULES``)."""
    last = latest_per_key(previous_loads(log, rule), keys, ["load_timestamp", "seq"], [rows_col, "status"])
    prev = last.select(*keys, F.col(rows_col).alias("prev_rows"), F.col("status").alias("prev_status"))
    j = new_counts.join(bounded_broadcast(prev), list(keys), "left")
    return j.select(*keys, F.col(rows_col).alias("new_rows"), "prev_rows",
                    row_count_verdict(F.col(rows_col), F.col("prev_rows"), "prev_status").alias("verdict"),
                    F.round(F.lit(100.0) * F.col(rows_col) / F.col("prev_rows"), 1).alias("pct_of_prev"))


def deviation_alert(new_rows: Column | str, prev_rows: Column | str, threshold: float = 0.1) -> Column:
    """True when the new count moves more than ``threshold`` of the previous one."""
    new = F.col(new_rows) if isinstance(new_rows, str) else new_rows
    prev = F.col(prev_rows) if isinstance(prev_rows, str) else prev_rows
    return (prev > 0) & (F.abs(new - prev) > F.lit(threshold) * prev)
