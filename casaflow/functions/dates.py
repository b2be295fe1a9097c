"""Date handling: multi-format parsing of data-borne text dates (on the
executors) and of wide-file headers (once per column, on the driver)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from casaflow.schemas import HEADER_DATE_FORMATS


def parse_date_multi(c: Column | str, formats=HEADER_DATE_FORMATS) -> Column:
    """First format that parses wins; text that matches none becomes null.

    ``try_to_date`` keeps ANSI mode on while giving null-on-mismatch.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def year_of(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c)


def month_start(c: Column | str) -> Column:
    """Truncate a date (or timestamp) to the first day of its month, as a date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(c.cast("date"), "month")


# Python equivalents of the Spark patterns above, used for header text only.
_HEADER_PATTERNS = {
    "M/d/yyyy": re.compile(r"^(\d{1,2})/(\d{1,2})/(\d{4})$"),
    "yyyy-MM-dd": re.compile(r"^(\d{4})-(\d{2})-(\d{2})$"),
}


def header_date(text: str, formats=HEADER_DATE_FORMATS) -> dt.date | None:
    """Parse one wide-file header (e.g. ``1/31/2012`` or ``2012-01-31``).

    Headers are parsed once on the driver and carried as literals, so the
    per-row ``to_date`` of the unpivoted rows disappears from the plan.
    """
    s = text.strip()
    for f in formats:
        m = _HEADER_PATTERNS[f].match(s)
        if not m:
            continue
        a, b, c = (int(g) for g in m.groups())
        y, mo, d = (c, a, b) if f == "M/d/yyyy" else (a, b, c)
        try:
            return dt.date(y, mo, d)
        except ValueError:
            continue
    return None
