"""Flatten semi-structured documents.

``LATERAL FLATTEN(input => v:path)`` becomes an explode of the variant
value read as ``map<string,variant>`` (object) or ``array<variant>``
(array).  Both are JVM-side; the explode is a narrow operation, so
flattening never shuffles.  As in the dialect, an empty or NULL input drops
the row (``outer=True`` keeps it with NULL key/index/value).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.json import get_path, json_path
from sluice.operators.rownum import global_row_number


def flatten_entries(v: Column) -> Column:
    """``FLATTEN`` rows of a variant as array<struct<index, key, value>>."""
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    arr = F.try_variant_get(v, "$", "array<variant>")
    from_obj = F.transform(F.map_entries(obj), lambda e: F.struct(
        F.lit(None).cast("int").alias("index"), e["key"].alias("key"), e["value"].alias("value")))
    from_arr = F.transform(arr, lambda x, i: F.struct(
        i.alias("index"), F.lit(None).cast("string").alias("key"), x.alias("value")))
    return F.coalesce(from_obj, from_arr)


def flatten(df: DataFrame, v: Column | str, path: str | None = None, alias: str = "f",
            outer: bool = False) -> DataFrame:
    """Each row of ``df`` times the elements of ``v:path``; adds ``alias`` struct(index, key, value)."""
    col = F.col(v) if isinstance(v, str) else v
    if path:
        col = F.variant_get(col, json_path(path), "variant")
    explode = F.explode_outer if outer else F.explode
    return df.select("*", explode(flatten_entries(col)).alias(alias))


@dataclass(frozen=True)
class Field:
    name: str
    path: str
    type: str = "string"


# The element paths the reference projects, with their output
# names and types (a near-earth-object feed element).
NEO_FIELDS = (
    Field("link_self", "links.self", "string"),
    Field("id", "id", "string"),
    Field("neo_reference_id", "neo_reference_id", "string"),
    Field("name", "name", "string"),
    Field("absolute_magnitude_h", "absolute_magnitude_h", "float"),
    Field("is_hazardous", "is_potentially_hazardous_asteroid", "boolean"),
    Field("close_approach_date", "close_approach_data[0].close_approach_date", "string"),
    Field("velocity_kps", "close_approach_data[0].relative_velocity.kilometers_per_second", "float"),
    Field("miss_distance_km", "close_approach_data[0].miss_distance.kilometers", "float"),
    Field("orbiting_body", "close_approach_data[0].orbiting_body", "string"),
)

LANDING_COLUMNS = ("source_file_loaded_at_utc", "source_file_date_utc", "source_file_name",
                   "source_file_object_unique_key")


def flatten_documents(landing: DataFrame, object_col: str = "source_file_object",
                      outer_path: str = "near_earth_objects",
                      fields: Sequence[Field] = NEO_FIELDS, order_field: str = "id",
                      carry: Sequence[str] = LANDING_COLUMNS, keep_object: bool = False,
                      strict: bool = True, row_number: str = "source_file_row_number",
                      stage: bool = True) -> DataFrame:
    """Two-level flatten + typed projection + global row number (M2).

    Object of arrays (``near_earth_objects: {date: [elements]}``) -> one row
    per element.  The row number orders all elements by the text of
    ``order_field`` (a variant cannot be a sort key, so it is compared as a
    string, ``'10' < '3'``), computed without a single-partition sort.
    ``strict=False`` turns bad casts into NULL instead of an error.
    ``stage`` writes the typed rows once before numbering (the numbering
    reads its input several times; parsing happens only once).
    """
    keep = list(carry) + ([object_col] if keep_object else [])
    level1 = flatten(landing.select(*keep, object_col), object_col, outer_path, "d")
    level2 = flatten(level1.select(*keep, F.col("d.value").alias("__arr")), "__arr", None, "e")
    elem = F.col("e.value")
    typed = level2.select(*keep, *[get_path(elem, f.path, f.type, strict=strict).alias(f.name)
                                   for f in fields],
                          get_path(elem, order_field, "string", strict=False).alias("__order"))
    numbered = global_row_number(typed, ["__order"], name=row_number, stage=stage)
    names = [f.name for f in fields]
    return numbered.select(*keep, row_number, *names)
