"""Semi-structured helpers on the VARIANT type."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions._cols import as_col

# Dialect scalar type names and the Spark type a variant path is read as.
# FLOAT is 64-bit in the dialect, hence double.
TYPE_NAMES = {
    "string": "string", "varchar": "string", "text": "string",
    "float": "double", "double": "double", "real": "double",
    "number": "decimal(38,0)", "int": "bigint", "integer": "bigint",
    "bigint": "bigint", "boolean": "boolean", "date": "date",
    "timestamp": "timestamp_ntz", "variant": "variant",
}

_SEGMENT = re.compile(r"""\.?("[^"]+"|[A-Za-z_$][\w$]*)|\[(\d+)\]""")


def json_path(path: str) -> str:
    """``a.b[0].c`` (dialect path) -> ``$.a.b[0].c`` (Spark variant path)."""
    if path.startswith("$"):
        return path
    out, pos = ["$"], 0
    while pos < len(path):
        m = _SEGMENT.match(path, pos)
        if not m or m.end() == pos:
            raise ValueError(f"bad path segment at {pos} in {path!r}")
        if m.group(2) is not None:
            out.append(f"[{m.group(2)}]")
        else:
            name = m.group(1).strip('"')
            out.append(f".{name}" if re.fullmatch(r"[A-Za-z_][\w]*", name) else f"['{name}']")
        pos = m.end()
    return "".join(out)


def spark_type(name: str) -> str:
    return TYPE_NAMES.get(name.lower(), name)


def get_path(v, path: str, type_name: str = "variant", strict: bool = True) -> Column:
    """``v:a.b[0].c::type``.

    A missing path gives NULL; a JSON null read as a scalar type gives NULL.
    ``strict`` raises on a value that cannot be cast (the dialect's ``::``);
    ``strict=False`` gives NULL instead (``TRY_CAST``).
    """
    fn = F.variant_get if strict else F.try_variant_get
    return fn(as_col(v), json_path(path), spark_type(type_name))


def parse(c, strict: bool = True) -> Column:
    """``PARSE_JSON`` (H21); ``strict=False`` gives NULL for bad text."""
    return F.parse_json(as_col(c)) if strict else F.try_parse_json(as_col(c))


def variant_text(v) -> Column:
    """Variant or struct -> JSON text."""
    return F.to_json(as_col(v))


def object_text(*cols, **named) -> Column:
    """``OBJECT_CONSTRUCT(*)`` / ``OBJECT_CONSTRUCT('k', v, ...)`` as text.

    NULL fields are left out, as the dialect does.
    """
    fields = [as_col(c) for c in cols] + [as_col(v).alias(k) for k, v in named.items()]
    return F.to_json(F.struct(*fields))


def array_text(arr, sep: str) -> Column:
    """``ARRAY_TO_STRING(a, sep)``."""
    return F.array_join(as_col(arr), sep)


def pretty_json(c) -> Column:
    """Indented JSON text of a struct/array."""
    return F.to_json(as_col(c), {"pretty": "true"})
