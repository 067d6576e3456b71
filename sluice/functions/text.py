"""String and regex helpers.

All helpers return JVM-side Column expressions; nothing here runs Python per
row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions._cols import as_col

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
#
# Characters removed by Python's ``str.strip()`` (``str.isspace``), which the
# reference's cleaning step applies to every cell.  Written as one regex
# character class; it is valid in both Java regex and RE2 (DuckDB).
WHITESPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Strings that pandas ``read_csv`` turns into NaN by default (phase a, the
# cell as read, before stripping).
PANDAS_DEFAULT_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Strings the reference replaces with NULL after stripping (phase b).
CLEANED_NULL_TOKENS = ("", "NaN", "nan", "None", "null")

# The replacement character a lenient UTF-8 decoder puts for invalid bytes.
REPLACEMENT_CHAR = "�"
# ---------------------------------------------------------------------------

_STRIP_PATTERN = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


def strip_all(c) -> Column:
    """Remove leading and trailing whitespace the way ``str.strip()`` does.

    Spark's ``trim`` only removes the space character; ``'\\t a  '`` must
    become ``'a'``.
    """
    return F.regexp_replace(as_col(c), _STRIP_PATTERN, "")


def null_tokens(c, before=PANDAS_DEFAULT_NA, after=CLEANED_NULL_TOKENS) -> Column:
    """Two-phase null-token rule followed by the strip (H18 + H19).

    1. a cell equal to one of ``before`` (as read) becomes NULL;
    2. otherwise strip it; a stripped value in ``after`` becomes NULL.
    So ``'NA'`` -> NULL, ``' NA '`` -> ``'NA'``, ``' null '`` -> NULL.
    """
    col = as_col(c)
    stripped = strip_all(col)
    return (
        F.when(col.isNull() | col.isin(list(before)), F.lit(None).cast("string"))
        .when(stripped.isin(list(after)), F.lit(None).cast("string"))
        .otherwise(stripped)
    )


def drop_invalid(c) -> Column:
    """Remove U+FFFD replacement characters left by a lenient decode."""
    return F.regexp_replace(as_col(c), REPLACEMENT_CHAR, "")


def regexp_group(c, pattern: str, group: int = 1) -> Column:
    """First match's group, NULL when there is no match (H5).

    ``regexp_extract`` yields ``''`` on no match; the dialect gives NULL.
    """
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def regexp_full_match(c, pattern: str) -> Column:
    """Whole-string regex match (H6); ``rlike`` alone is a substring search."""
    return as_col(c).rlike(f"^(?:{pattern})$")


def regexp_count(c, pattern: str) -> Column:
    """Number of non-overlapping matches (H7)."""
    return F.regexp_count(as_col(c), F.lit(pattern))


def rtrim_chars(c, chars: str) -> Column:
    """Remove any trailing characters that occur in ``chars``."""
    if not chars:
        return as_col(c)
    return F.rtrim(as_col(c), F.lit(chars))


def literal_pattern(text: str) -> str:
    """Java-regex pattern matching ``text`` literally (names used as patterns)."""
    return re.escape(text)
