from .casts import bad_value_counts, cast_columns, cast_value, date_guard, strict_cast
from .dates import http_date
from .labels import PERIOD_LABELS, period_label, seasonal_from_id, seasonal_label
from .text import (DEFAULT_NULL_TOKENS, LEGACY_NULL_TOKENS, clean_field, clean_text, is_blank,
                   null_if_token, strip_nul, strip_quotes)
from .urls import url_segment

__all__ = [
    "bad_value_counts", "cast_columns", "cast_value", "date_guard", "strict_cast", "http_date",
    "PERIOD_LABELS", "period_label", "seasonal_from_id", "seasonal_label", "DEFAULT_NULL_TOKENS",
    "LEGACY_NULL_TOKENS", "clean_field", "clean_text", "is_blank", "null_if_token", "strip_nul",
    "strip_quotes", "url_segment",
]
