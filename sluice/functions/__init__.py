"""Column functions: keys, text, dates and variant paths."""

from sluice.functions.dates import (date_text, java_pattern, parse_date, to_utc,
                                    utc_stamp, utc_stamp_text)
from sluice.functions.json import (array_text, get_path, json_path, object_text,
                                   parse, pretty_json, variant_text)
from sluice.functions.keys import concat_key, surrogate_key
from sluice.functions.text import (drop_invalid, null_tokens, regexp_count,
                                   regexp_full_match, regexp_group, rtrim_chars,
                                   strip_all)

__all__ = [
    "array_text", "concat_key", "date_text", "drop_invalid", "get_path",
    "java_pattern", "json_path", "null_tokens", "object_text", "parse",
    "parse_date", "pretty_json", "regexp_count", "regexp_full_match",
    "regexp_group", "rtrim_chars", "strip_all", "surrogate_key", "to_utc",
    "utc_stamp", "utc_stamp_text", "variant_text",
]
