"""Date text normalisation and zone-free timestamp arithmetic."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_first(text: Column, patterns: list[str], ntz: bool = True) -> Column:
    """Timestamp from the first pattern that parses ``text``; NULL when none does.

    With ``ntz`` the result is a ``timestamp_ntz`` holding the wall time exactly
    as written (no session-zone shift). ``try_to_timestamp`` decides whether a
    pattern fits, so junk never raises under ANSI mode.
    """
    out = None
    for p in patterns:
        fits = F.try_to_timestamp(text, F.lit(p)).isNotNull()
        value = F.to_timestamp_ntz(text, F.lit(p)) if ntz else F.try_to_timestamp(text, F.lit(p))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def matched_pattern(text: Column, patterns: list[str]) -> Column:
    """1-based index of the first pattern that parses ``text``, NULL when none does."""
    out = None
    for i, p in enumerate(patterns, start=1):
        fits = F.try_to_timestamp(text, F.lit(p)).isNotNull()
        out = F.when(fits, F.lit(i)) if out is None else out.when(fits, F.lit(i))
    return out


_DAY_US = 86_400_000_000


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` wall time.

    Built from wall-clock fields (day number, hour, minute, fractional second),
    so no session time zone enters: a gap across a DST change stays exact.
    """
    day = F.unix_date(F.to_date(ts)).cast("long") * F.lit(_DAY_US)
    clock = (F.hour(ts).cast("long") * F.lit(3_600_000_000) + F.minute(ts).cast("long") * F.lit(60_000_000)
             + (F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long"))
    return day + clock
