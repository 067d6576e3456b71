"""Header records of CSV files, read as records and judged.

A header is the first CSV record of a file that is not blank; a quoted name
may hold line breaks.  ``read_headers`` streams each file on an executor and
stops at the end of that record: a gzip stream is inflated one chunk past its
header and no further.  A file whose bytes cannot be read that far has no
header here; it stops no other file.

``header_fault`` says why a header cannot name the columns of a table.  A
caller reports that file and goes on with the others.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import SparkSession

from sluice.sources.files import profile
from sluice.sources.streams import each_file, file_chunks

#: A header record longer than this is a fault, not a header.
MAX_HEADER_CHARS = 1 << 20
_CHUNK = 1 << 14
_LINE_END = re.compile(r"\r\n|\r|\n")


@dataclass(frozen=True)
class Header:
    columns: list[str]
    fault: str | None  # why the record cannot be read as a header


def _first_record(text: str, quote: str, escape: str, whole: bool) -> str | None:
    """The first record of the text that is not blank; None if it does not end
    in it.  ``whole``: nothing follows the text."""
    record, open_ = "", False
    lines = _LINE_END.split(text)
    for i, line in enumerate(lines, 1):
        if not record and not line.strip():
            continue
        record = f"{record}\n{line}" if open_ else line
        quotes = record if escape == quote else record.replace(escape + quote, "")
        open_ = quotes.count(quote) % 2 == 1
        if not open_:  # the text's last line may go on
            return record if whole or i < len(lines) else None
    return None if open_ or not whole else record


def read_header(path: str, stream: BinaryIO, sep: str = ",", quote: str = '"',
                escape: str = '"', limit: int = MAX_HEADER_CHARS) -> Header | None:
    """The header of one open file; None for blank files and broken streams."""
    decoder, text, record = codecs.getincrementaldecoder("utf-8-sig")("replace"), "", None
    try:
        for data in file_chunks(path, stream, _CHUNK):
            text = (text + decoder.decode(data)) if text.strip() else decoder.decode(data)
            record = _first_record(text, quote, escape, False)
            if record is not None:
                break
            if len(text) > limit:
                return Header([], f"the header record does not end within {limit} characters")
    except (zlib.error, EOFError, OSError):
        return None
    if record is None:
        record = _first_record(text, quote, escape, True)
        if record is None:
            return Header([], "the header record does not end: a quote is left open")
    if not record:
        return None
    if len(record) > limit:
        return Header([], f"the header record does not end within {limit} characters")
    try:
        names = next(csv.reader(io.StringIO(record, newline=""), delimiter=sep, quotechar=quote,
                                escapechar=None if escape == quote else escape), [])
    except csv.Error as exc:
        return Header([], f"the header record cannot be read: {exc}")
    return Header([c.strip() for c in names], None)


def read_headers(spark: SparkSession, paths: Sequence[str],
                 options: dict[str, str] | None = None,
                 max_chars: int = MAX_HEADER_CHARS) -> dict[str, Header]:
    """Path -> header.  Files without a readable first record (empty or blank
    files, streams that break before it ends) are absent."""
    opts = options or profile("infer_csv")
    sep, quote = opts.get("sep", ","), opts.get("quote", '"')
    escape = opts.get("escape", quote)

    def judge(path: str, stream: BinaryIO) -> tuple:
        got = read_header(path, stream, sep, quote, escape, max_chars)
        return (path, got.columns, got.fault) if got else (path, None, None)

    rows = each_file(spark, paths, judge, "path string, columns array<string>, fault string")
    return {path: Header(list(columns), fault) for path, columns, fault in rows
            if columns is not None}


def header_fault(header: Header, reserved: Sequence[str] = ()) -> str | None:
    """Why the header cannot name the columns of a table; None if it can.

    Names compare without case, as the table's columns are upper-cased.
    """
    if header.fault:
        return header.fault
    seen = {r.upper(): "is taken by the table" for r in reserved}
    for i, name in enumerate(header.columns, 1):
        if not name:
            return f"column {i} of the header has no name"
        if name.upper() in seen:
            return f"column name {name!r} {seen[name.upper()]}"
        seen[name.upper()] = "occurs more than once in the header"
    return None


def distinct_names(columns: Sequence[str]) -> list[str]:
    """Names as a data frame reader gives them: an empty one by its place, a
    repeated one with a number behind it."""
    out: list[str] = []
    for i, name in enumerate(columns):
        base, n, name = name or f"Unnamed: {i}", 0, name or f"Unnamed: {i}"
        while name in out:
            n += 1
            name = f"{base}.{n}"
        out.append(name)
    return out
