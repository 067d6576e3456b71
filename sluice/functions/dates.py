"""Date and time helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions._cols import as_col

# Dialect format tokens and their Java pattern equivalents,
# longest tokens first.
_FORMAT_TOKENS = [
    ("YYYY", "yyyy"), ("HH24", "HH"), ("HH12", "hh"), ("FF3", "SSS"),
    ("FF6", "SSSSSS"), ("FF9", "SSSSSSSSS"), ("MON", "MMM"), ("DY", "EEE"),
    ("YY", "yy"), ("MM", "MM"), ("DD", "dd"), ("HH", "HH"), ("MI", "mm"),
    ("SS", "ss"), ("AM", "a"), ("PM", "a"), ("TZH:TZM", "XXX"),
]
_TOKEN_RE = re.compile("|".join(re.escape(t) for t, _ in _FORMAT_TOKENS))
_TOKEN_MAP = dict(_FORMAT_TOKENS)


def java_pattern(dialect_format: str) -> str:
    """Translate a dialect format such as ``YYYYMMDD`` to ``yyyyMMdd``.

    Java's ``YYYY`` is the week-based year, so a literal copy is wrong at
    year ends.  Text outside tokens is quoted.
    """
    out, pos = [], 0
    for m in _TOKEN_RE.finditer(dialect_format):
        if m.start() > pos:
            out.append(_quote(dialect_format[pos:m.start()]))
        out.append(_TOKEN_MAP[m.group(0)])
        pos = m.end()
    if pos < len(dialect_format):
        out.append(_quote(dialect_format[pos:]))
    return "".join(out)


def _quote(text: str) -> str:
    if all(ch in " -_:/.,T" for ch in text):
        return text.replace("T", "'T'")
    return "'" + text.replace("'", "''") + "'"


def date_text(c, fmt: str = "YYYYMMDD") -> Column:
    """``TO_VARCHAR(d, 'YYYYMMDD')``."""
    return F.date_format(as_col(c), java_pattern(fmt))


def parse_date(c, fmt: str = "YYYYMMDD", strict: bool = False) -> Column:
    """``TO_DATE(s, 'YYYYMMDD')`` (H12); lenient by default: bad text -> NULL."""
    pattern = java_pattern(fmt)
    return F.to_date(as_col(c), pattern) if strict else F.try_to_date(as_col(c), pattern)


def to_utc(c, source_tz: str | None = None) -> Column:
    """``CONVERT_TIMEZONE('UTC', ts)``.

    With ``source_tz`` the input is a wall-clock (NTZ) timestamp in that zone
    and the result is the UTC wall clock.  Without it the input is an
    instant and the result is its UTC wall clock.
    """
    if source_tz is None:
        return F.convert_timezone(None, F.lit("UTC"), as_col(c).cast("timestamp"))
    return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), as_col(c).cast("timestamp_ntz"))


UTC_STAMP_FORMATS = {
    "date": "yyyyMMdd'_UTC'",
    "time": "yyyyMMddHHmmss'_UTC'",
}


def utc_stamp(c, kind: str = "time") -> Column:
    """``%Y%m%d_UTC`` / ``%Y%m%d%H%M%S_UTC`` stamps."""
    return F.date_format(as_col(c), UTC_STAMP_FORMATS[kind])


def utc_stamp_text(ts, kind: str = "time") -> str:
    """Driver-side stamp for one run timestamp (a Python datetime)."""
    return ts.strftime("%Y%m%d_UTC" if kind == "date" else "%Y%m%d%H%M%S_UTC")


def ntz_literal(ts) -> Column:
    """A TIMESTAMP_NTZ literal from a Python datetime, independent of the
    session and process time zones (built from its wall-clock text)."""
    if ts.tzinfo is not None:
        import datetime as _dt
        ts = ts.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
