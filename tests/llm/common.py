"""Small tables with awkward rows."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators also use for themselves.
CLASHING = ["row", "hits", "score", "copy", "words", "removed", "fp", "h", "d__", "size", "key",
            "text_", "k", "id"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syl = "ka lo mi re tu va ne so pi du ra ge bo zu fe".split()
    return " ".join("".join(rng.choice(syl) for _ in range(rng.randint(1, 4)))
                    for _ in range(words))


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = prose(1, 30_000)
    body = [prose(k, 60) for k in range(2, 10)]
    rows = [(k, body[k % 8] if k < 8 else prose(100 + k, 50), "en", f"s{k % 3}")
            for k in range(16)]
    rows += [(20, None, None, None), (21, "", "en", "s0"), (22, " \n\t ", "en", None),
             (23, long, "en", "s1"), (24, "x", "en", "s2"), (25, body[0], None, "s1"),
             (25, body[0], None, "s1"), (26, body[1] + "\n" + prose(77, 40), "en", "s2"),
             (26, prose(78, 30), "en", "s2"), (None, body[2], "en", "s0"),
             (None, prose(79, 30), "en", None), (30, "aaaa " * 200, "en", "s0"),
             (31, "😀é" * 300, "en", "s1"), (32, long[:5000], "en", "s1")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING])


def write_tables(df, folder: str, **others) -> str:
    """``df`` as documents, and other tables, in a folder the queries read."""
    df.write.parquet(f"{folder}/documents.parquet")
    for name, table in others.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return folder


def line_brute(rows) -> list[tuple]:
    """``(id, text)`` after the line dedup, in the order of the rows: documents in
    order, each against the first holder of every least run of lines that has
    ``MIN_CHARS`` characters, the runs written out as texts."""
    import xxhash

    from sluice.llm import line_dedup as ld

    def key(i, t):
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        return (i is not None, i or 0, h - (1 << 64) if h >= 1 << 63 else h)

    first, lines, out = {}, {}, {}
    for k, t in sorted({(key(i, t), t) for i, t in rows if t is not None}):
        ls = [x.strip() for x in t.split("\n")]
        least = []
        for a in range(len(ls)):
            b, n = a, 0
            while b < len(ls) and n < ld.MIN_CHARS:
                n, b = n + len(ls[b]), b + 1
            if n >= ld.MIN_CHARS > n - len(ls[a]):
                least.append((a, b))
        size, gone = [0] * len(ls), set()
        for a, b in least:
            size[a] = b - a
        for p in {first[r] for a, b in least if (r := tuple(ls[a:b])) in first}:
            gone |= set(ld.common_lines(lines[p], ls, size))
        lines[k] = ls
        for a, b in least:
            first.setdefault(tuple(ls[a:b]), k)
        out[k] = "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone)
    return [(i, None if t is None else out[key(i, t)]) for i, t in rows]
