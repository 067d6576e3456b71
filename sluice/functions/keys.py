"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions._cols import as_col

# Text form of a timestamp inside a hash key: the dialect's default output
# format.  A plain cast to string drops trailing zeros of the fraction, so the
# format is fixed explicitly.
TIMESTAMP_KEY_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS Z"


def key_text(c) -> Column:
    """Text a value contributes to a concatenated key (``||`` semantics)."""
    return as_col(c).cast("string")


def surrogate_key(*cols, sep: str = "", null: str | None = "0") -> Column:
    """``MD5(COALESCE(a,0) || COALESCE(b,0) || ...)`` (H4).

    The defaults reproduce the reference exactly: no separator, so the key
    pairs (1, 23) and (12, 3) collide, and NULL collides with 0.  Pass
    ``sep='|'`` for new tables.  ``null=None`` keeps NULL propagation (any
    NULL part makes the key NULL), as plain ``||`` does.
    """
    parts = []
    for c in cols:
        t = key_text(c)
        parts.append(F.coalesce(t, F.lit(null)) if null is not None else t)
    body = F.concat_ws(sep, *parts) if (sep and null is not None) else F.concat(*_interleave(parts, sep))
    return F.md5(body)


def _interleave(parts, sep):
    if not sep:
        return parts
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit(sep))
        out.append(p)
    return out


def concat_key(*cols) -> Column:
    """``MD5(a || b)`` with NULL propagation (lineage keys)."""
    return F.md5(F.concat(*[key_text(c) for c in cols]))
