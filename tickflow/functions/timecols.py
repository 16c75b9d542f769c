"""Time conversions.

Event times are kept as TIMESTAMP_NTZ holding the UTC wall clock, the type of
the stored tables (TIMESTAMP WITHOUT TIME ZONE).  Every conversion here goes
through epoch integers, so results do not depend on the session time zone and
never take a round trip through a formatted string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _thousandth(n: Column) -> Column:
    """Floor of a thousandth, in whole numbers: a double would lose the last
    digits of microseconds after the year 2255."""
    n = n.cast("long")
    return F.call_function("div", n - F.pmod(n, F.lit(1000)), F.lit(1000))


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds to a second-resolution UTC timestamp (milliseconds
    are dropped, as the message timestamps are truncated to seconds)."""
    return F.timestamp_add("SECOND", _thousandth(_c(ms)), F.expr(EPOCH_NTZ))


def ts_to_epoch_ms(ts) -> Column:
    """UTC wall-clock timestamp (NTZ) to epoch milliseconds."""
    return _thousandth(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(ts)))


def as_instant(ts) -> Column:
    """NTZ UTC wall clock to TIMESTAMP (instant), e.g. for a watermark."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(ts)))


def as_wallclock(ts) -> Column:
    """TIMESTAMP (instant) to its NTZ UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.expr(EPOCH_NTZ))


def ingest_ms() -> Column:
    """Arrival stamp in epoch milliseconds (the event time comes in as a column)."""
    return F.unix_millis(F.current_timestamp())


def arrival_time(ms="ingest_ms") -> Column:
    """A stored arrival stamp as TIMESTAMP_NTZ, to the millisecond: the time
    column of windows by arrival instead of event time."""
    return F.timestamp_add("MICROSECOND", _c(ms).cast("long") * 1000, F.expr(EPOCH_NTZ))
