"""Master lookup: left joins -> surrogate key -> ordered table.

The reference joins a patients table to four sources on one id, hashes the
five ids into a lookup key and inserts the unseen keys into a master table.
Here the inputs are DataFrames, so any tables can play those roles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.keys import surrogate_key
from sluice.operators.joins import left_join_all

# The lineage columns carried into the master lookup.
LINEAGE_COLUMNS = [
    "source_file_loaded_at_utc", "source_file_date_utc", "source_file_name",
    "source_file_unique_key", "source_file_row_number",
    "source_file_record_unique_key",
]


@dataclass
class Side:
    """One joined source: ``df`` has ``key`` and ``value``; output ``alias``."""

    df: DataFrame
    key: str
    value: str
    alias: str
    unique: bool = False  # at most one row per key (a lookup)


def build_master_lookup(base: DataFrame, base_key: str, base_alias: str,
                        sides: Sequence[Side], *, lookup_key: str,
                        carry: Sequence[str] = LINEAGE_COLUMNS,
                        skew_safe: bool = True, order: bool = True) -> DataFrame:
    """Columns: ``carry``, ``lookup_key``, ``base_alias``, then each side alias."""
    k = "__k"
    left = base.select(*[F.col(c) for c in carry], F.col(base_key).alias(k))
    right = [s.df.select(F.col(s.key).alias(k), F.col(s.value).alias(s.alias)) for s in sides]
    joined = left_join_all(left, right, k, unique=[s.unique for s in sides],
                           skew_safe=skew_safe)
    ids = [F.col(k)] + [F.col(s.alias) for s in sides]
    out = joined.select(
        *[F.col(c) for c in carry],
        surrogate_key(*ids).alias(lookup_key),
        F.col(k).alias(base_alias),
        *[F.col(s.alias) for s in sides],
    )
    if order:
        # ORDER BY the base id; the lookup key breaks ties so the range
        # partitioner can split one very frequent id over several tasks.
        out = out.orderBy(F.col(base_alias).asc_nulls_last(), F.col(lookup_key))
    return out
