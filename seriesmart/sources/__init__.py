from .delimited import clean_header, detect_delimiter, read_delimited, read_years
from .files import manifest
from .text import (FACT_COLUMNS, count_skipped, latest_by_line, parse_lines, read_bulk,
                   read_dimension, read_dimension_table, read_facts, read_lines, read_parts, read_series,
                   read_series_mapping, starts_with)

__all__ = ["clean_header", "detect_delimiter", "read_delimited", "read_years", "manifest",
           "FACT_COLUMNS", "count_skipped", "latest_by_line", "parse_lines", "read_bulk",
           "read_dimension", "read_dimension_table", "read_facts", "read_lines", "read_parts", "read_series",
           "read_series_mapping", "starts_with"]
