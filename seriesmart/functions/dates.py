"""HTTP / RFC 2822 date text to a timestamp, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def http_date(c: Column | str) -> Column:
    """Parse an HTTP date ("Sun, 06 Nov 1994 08:49:37 GMT"; weekday optional;
    zone name, +hhmm offset, or none for GMT) to TIMESTAMP_NTZ in UTC; NULL
    when it does not parse.

    The text is parsed with its own zone, so the instant does not depend on
    the session time zone; its epoch seconds are then added to the NTZ epoch.
    """
    c = F.col(c) if isinstance(c, str) else c
    body = F.trim(F.regexp_replace(c, r"^\s*[A-Za-z]{3},", ""))
    with_zone = F.when(body.rlike(r":\d\d$"), F.concat(body, F.lit(" GMT"))).otherwise(body)
    instant = F.coalesce(F.try_to_timestamp(with_zone, F.lit("d MMM yyyy HH:mm:ss z")),
                         F.try_to_timestamp(with_zone, F.lit("d MMM yyyy HH:mm:ss Z")))
    return F.timestamp_add("SECOND", F.unix_seconds(instant), F.lit(_EPOCH).cast("timestamp_ntz"))
