from .aggregates import dimension_sizes, min_max_year, table_counts, year_chunks, year_of, year_range
from .denorm import Lookup, denormalize, enrich
from .ids import with_surrogate_id
from .joins import (bounded_broadcast, lookup_join, map_join, orphan_counts, orphans,
                    skip_counts)
from .latest import latest_per_key, top_k
from .loadlog import (LOG_SCHEMA, alerts, already_loaded, append_log, compact_log, empty_log, failed_loads, full_log,
                      latest_log, log_rows, read_log, recent_log, run_errors, run_summary, should_download,
                      should_reload, stale_success)
from .quality import (check_constraints, check_unique, deviation_alert, has_duplicates,
                      longer_than, not_null, out_of_range, row_count_verdict, table_rules,
                      validate_row_count)

__all__ = [n for n in dir() if not n.startswith("_")]
