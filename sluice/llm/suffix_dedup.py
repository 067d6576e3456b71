"""Removal of repeated byte strings by suffix sorting.

A byte goes if a string of ``depth`` bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same one.

1. Anchors: the string at every start chooses one of its ``GRAM``-byte grams
   (the least hash, the rightmost of equals).  The choice depends on the
   string alone, so equal strings choose equal anchors.  Starts with the
   same anchor place lie side by side; the text from the first to the end of
   the last string is the anchor's snippet.
2. Anchors whose gram occurs once in the corpus cannot hold a repeated
   string and go (a shuffle of hashes, without texts).  What repeats within
   one batch of documents is known there and sends one row.
3. The snippets of the other anchors are dealt out by their gram, so all
   places of a repeated string meet in one shard, and each shard's suffixes
   are sorted with their common prefixes by external induced sorting
   (``suffix_array``).  Suffixes that share ``depth`` bytes are neighbours;
   all but the earliest place are repeats.  Equal snippets are folded first,
   in a batch and in a shard: the later ones repeat the first from end to
   end, and the first goes into the suffix array for all of them.  A snippet
   that has no other beside it under its gram repeats nothing.
4. A gram with more than ``crowded`` snippets is dealt out string by string.
   The list of such grams is broadcast up to ``broadcast_rows``; a longer one
   is joined by gram and salt.
   The places of a string are gathered by salts, some ``crowded`` to a row,
   and its first place is the least of the rows' first ones, so that copies
   of one string need not meet in one task either.
5. The repeats' spans are joined back to the documents.

Equal whole texts are folded before all that: all but the first are repeats
throughout (if they have ``depth`` bytes).  Only texts with a candidate are
read a second time.

Defined cases: a null text is empty; rows with the same id and text are one
document and are reported alike; other rows with the same id are ordered by
a hash of the text; a null id comes before all others; texts shorter than
``depth`` bytes lose nothing; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.suffix_array import MEMORY, repeated
from sluice.session import scratch_path, ship_package

DEPTH = 100
GRAM = 32
SHARD_BYTES = 2_000_000
CROWDED = 20_000
BROADCAST_ROWS = 1_000_000  # crowded grams of 16 bytes each
JOIN_SALTS = 64
_CHUNK = 1 << 16
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_NULL_ID = -(1 << 63)


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from every place."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    power, size = _BASE, 1
    while size < gram:
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % (1 << 64)
        size *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _chunk_anchors(raw: np.ndarray, bounds: list[tuple[int, int]], depth: int, gram: int):
    """Anchors of texts laid end to end in ``raw``."""
    h = gram_hashes(raw, gram)
    key = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))  # rightmost is least
    least = _sliding_min(key, depth - gram + 1)
    change = np.flatnonzero(least[1:] != least[:-1]) + 1  # starts with another anchor
    at = np.array(bounds, np.int64)
    which = np.flatnonzero(at[:, 1] - at[:, 0] >= depth)
    if not len(which):
        return None
    a, z = at[which, 0], at[which, 1] - depth  # first and last start of each text
    lo, hi = np.searchsorted(change, a, "right"), np.searchsorted(change, z, "right")
    many = hi - lo + 1
    owner = np.repeat(np.arange(len(which)), many)
    head = np.cumsum(many) - many
    nth = np.arange(len(owner)) - head[owner]
    start = a[owner].copy()
    start[nth > 0] = change[(lo[owner] + nth - 1)[nth > 0]]
    end = np.append(start[1:], 0) - 1
    end[head + many - 1] = z
    p = (_LOW - (least[start] & _LOW)).astype(np.int64)
    return (which[owner], h[p].view(np.int64), start - a[owner], end - a[owner] + depth)


def anchors(texts: list[bytes], depth: int = DEPTH, gram: int = GRAM) -> tuple:
    """(text, hash, start, end) arrays of the snippets of all texts.

    Long texts are read in overlapping chunks: every start is in one chunk,
    with all that its choice depends on.
    """
    out: list[tuple] = []
    pieces: list[tuple[int, int, bytes]] = []  # (text, place of the piece, bytes)
    size = 0

    def flush() -> None:
        nonlocal pieces, size
        if pieces:
            raw = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
            ends = np.cumsum([len(p[2]) for p in pieces]).tolist()
            bounds = [(e - len(p[2]), e) for p, e in zip(pieces, ends)]
            got = _chunk_anchors(raw, bounds, depth, gram) if len(raw) >= depth else None
            if got is not None:
                which, h, a, b = got
                text = np.array([p[0] for p in pieces])[which]
                shift = np.array([p[1] for p in pieces])[which]
                out.append((text, h, a + shift, b + shift))
        pieces, size = [], 0

    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - depth + 1), _CHUNK):
            piece = t[lo:lo + _CHUNK + depth - 1]
            if len(piece) < depth:
                continue
            if size + len(piece) > _CHUNK + depth:
                flush()
            pieces.append((i, lo, piece))
            size += len(piece)
    flush()
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate([o[k] for o in out]) for k in range(4))


def merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of spans that overlap or touch."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    return list(zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist()))


def _utf8(t: str | None) -> bytes:
    return (t or "").encode("utf-8", "surrogatepass")


# --- 2. grams that occur more than once --------------------------------------------------

def _gram_rows(depth: int):
    """Rows (key, h, u, kind): 0 a gram of text u, 1 a gram known to repeat,
    2 the same for text u."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.drop_duplicates(["u", "text"])  # texts may share a hash
            us = f["u"].to_numpy("i8")
            text, h, _, _ = anchors([_utf8(t) for t in f["text"]], depth)
            if not len(h):
                continue
            _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
            many = counts[inverse] > 1
            pairs = np.unique(np.stack([us[text[many]], h[many]]), axis=1) if many.any() \
                else np.zeros((2, 0), np.int64)
            known = np.unique(h[many])
            one_u, one_h = us[text[~many]], h[~many]
            yield pd.DataFrame({
                "key": np.concatenate([one_h, known, pairs[0]]),
                "h": np.concatenate([one_h, known, pairs[1]]),
                "u": np.concatenate([one_u, np.zeros(len(known), np.int64), pairs[0]]),
                "kind": np.repeat(np.array([0, 1, 2], np.int8),
                                  [len(one_h), len(known), pairs.shape[1]])})

    return run


def _repeated_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by key: (u, h) of the grams with another row, streaming
    (one row is held back at most)."""
    held: tuple[int, int] | None = None  # (u, h) of a last row not yet decided
    last: int | None = None  # key of the last row
    for f in frames:
        sure = f["kind"].to_numpy() == 2
        yield pd.DataFrame({"u": f["u"].to_numpy()[sure], "h": f["h"].to_numpy()[sure]})
        key, u = f["h"].to_numpy()[~sure], f["u"].to_numpy()[~sure]
        kind = f["kind"].to_numpy()[~sure]
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        twice = np.zeros(len(key), bool)
        twice[1:] |= same
        twice[:-1] |= same
        us, hs = [], []
        if last is not None and key[0] == last:
            twice[0] = True
            if held:
                us, hs = [held[0]], [held[1]]
        out = twice & (kind == 0)
        us = np.concatenate([np.array(us, "i8"), u[out]])  # never floats: hashes are exact
        hs = np.concatenate([np.array(hs, "i8"), key[out]])
        last = int(key[-1])
        held = None if twice[-1] or kind[-1] != 0 else (int(u[-1]), last)
        yield pd.DataFrame({"u": us, "h": hs})


# --- 3. snippets and shards --------------------------------------------------------------

_PIECE = "h long, d long, u long, start long, end long, snippet binary"


def _snippets(depth: int):
    """Snippets of the texts' repeated grams; a snippet equal to an earlier
    one of the batch gives its span only (h null), and nothing if it is the
    same place of a repeated row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.sort_values(["d", "u"], kind="stable")
            texts = [_utf8(t) for t in f["text"]]
            text, h, a, b = anchors(texts, depth)
            if not len(h):
                continue
            cut = np.searchsorted(text, np.arange(len(texts) + 1))
            seen: dict[tuple[int, bytes], tuple[int, int, int]] = {}
            rows, spans = [], []
            for i, (d, u, hs) in enumerate(zip(f["d"], f["u"], f["hs"])):
                k = np.arange(cut[i], cut[i + 1])
                k = k[np.isin(h[k], hs)]
                later = []
                for x, s, e in zip(h[k].tolist(), a[k].tolist(), b[k].tolist()):
                    snippet = texts[i][s:e]
                    at = d, u, s
                    first = seen.setdefault((x, snippet), at)
                    if first is at:
                        rows.append((x, d, u, s, e, snippet))
                    elif first != at:  # not a repeated row of the same document
                        later.append((s, e))
                if later:
                    got = np.array(later)
                    spans += [(None, d, u, s, e, None) for s, e in merge(got[:, 0], got[:, 1])]
            out = pd.DataFrame(rows + spans, columns=["h", "d", "u", "start", "end", "snippet"])
            out["h"] = out["h"].astype("Int64")
            yield out

    return run


def shard_repeats(d: np.ndarray, u: np.ndarray, start: np.ndarray, h: np.ndarray,
                  snippets: list[bytes], depth: int, memory: int = MEMORY
                  ) -> list[tuple[int, int, int, int]]:
    """Spans (d, u, start, end) of a shard's repeats, by its suffix array."""
    order = np.lexsort((start, u, d))
    stands: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    distinct: dict[int, int] = {}
    chosen: list[int] = []
    spans: list[tuple[int, int, int, int]] = []
    for i in order.tolist():
        at = int(d[i]), int(u[i]), int(start[i])
        first = stands.setdefault((int(h[i]), snippets[i]), at)
        if first is at:
            distinct[int(h[i])] = distinct.get(int(h[i]), 0) + 1
            chosen.append(i)
        elif first != at:  # not a repeated row of the same document
            spans.append((*at, at[2] + len(snippets[i])))
    chosen = [i for i in chosen if distinct[int(h[i])] > 1]
    if not chosen:
        return spans
    group, owner, offset = repeated([snippets[i] for i in chosen], depth, memory)
    if len(group):
        at = np.array(chosen)[owner]
        pd_, pu, ps = d[at], u[at], start[at] + offset
        by = np.lexsort((ps, pu, pd_, group))
        group, pd_, pu, ps = group[by], pd_[by], pu[by], ps[by]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        lead = np.flatnonzero(first)[np.cumsum(first) - 1]
        # repeated rows of a document stand at the same place as the first
        late = (pd_ != pd_[lead]) | (pu != pu[lead]) | (ps != ps[lead])
        spans += zip(pd_[late].tolist(), pu[late].tolist(), ps[late].tolist(),
                     (ps[late] + depth).tolist())
    return spans


def _sort_shards(depth: int, shard_bytes: int, memory: int):
    """Over rows sorted by h: whole groups (``crowded`` snippets at most) are
    gathered into shards."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["d", "u", "start", "end"]
        held: list[pd.DataFrame] = []
        size = 0

        def sort(f: pd.DataFrame) -> pd.DataFrame:
            key = f["h"].to_numpy("i8")
            alone = np.ones(len(key), bool)  # a snippet alone in its group repeats nothing
            same = key[1:] == key[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
            f, key = f[~alone], key[~alone]
            if not len(f):
                return pd.DataFrame(columns=names).astype("int64")
            spans = np.array(shard_repeats(
                f["d"].to_numpy("i8"), f["u"].to_numpy("i8"), f["start"].to_numpy("i8"), key,
                list(f["snippet"]), depth, memory), np.int64).reshape(-1, 4)
            out = []
            if len(spans):
                order = np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))
                spans = spans[order]
                new = np.any(spans[1:, :2] != spans[:-1, :2], axis=1)
                for part in np.split(spans, np.flatnonzero(new) + 1):
                    out += [(part[0, 0], part[0, 1], s, e)
                            for s, e in merge(part[:, 2], part[:, 3])]
            return pd.DataFrame(out, columns=names).astype("int64")

        for f in frames:
            if not len(f):
                continue
            held.append(f)
            size += int(f["snippet"].map(len).sum())
            if size >= shard_bytes:
                f = pd.concat(held, ignore_index=True)
                tail = (f["h"] == f["h"].iloc[-1]).to_numpy()
                if not tail.all():
                    yield sort(f[~tail])
                held = [f[tail]]
                size = int(held[0]["snippet"].map(len).sum()) if not tail.all() else size
        if held:
            yield sort(pd.concat(held, ignore_index=True))

    return run


def string_places(rows: DataFrame, depth: int) -> DataFrame:
    """For snippets ``h, salts, d, u, start, end, snippet``: the places of
    each string of ``depth`` bytes, as ``h, string, salt, first, places``."""
    rows = rows.select("h", "d", "u", "start", "snippet", F.pmod(
        F.xxhash64("d", "u", "start"), F.col("salts")).alias("salt"), F.explode(F.sequence(
            F.lit(0), (F.col("end") - F.col("start") - depth).cast("int"))).alias("o"))
    place = F.struct("d", "u", (F.col("start") + F.col("o")).alias("start"))
    return rows.select("h", "salt", place.alias("place"), F.substr(
        "snippet", F.col("o") + 1, F.lit(depth)).alias("string")).groupBy("h", "string", "salt") \
        .agg(F.min("place").alias("first"), F.collect_list("place").alias("places"))


def late_strings(places: DataFrame, depth: int) -> DataFrame:
    """Spans ``d, u, start, end`` of all but each string's first place; a task
    sees the places of one salt only."""
    firsts = places.groupBy("h", "string").agg(
        F.min("first").alias("least"), F.sum(F.size("places")).alias("n"),
        F.collect_list("salt").alias("every")).filter(F.col("n") > 1)
    firsts = firsts.select(F.col("h").alias("f_h"), F.col("string").alias("f_string"), "least",
                           F.explode("every").alias("f_salt"))
    late = places.join(firsts, (F.col("h") == F.col("f_h")) & (F.col("salt") == F.col("f_salt"))
                       & (F.col("string") == F.col("f_string"))) \
        .select("least", F.explode("places").alias("at"))
    # repeated rows of a document stand at the same place as the first
    return late.filter(F.col("at") != F.col("least")).select(
        "at.d", "at.u", "at.start", (F.col("at.start") + depth).alias("end"))


def with_salts(rows: DataFrame, crowd: DataFrame, broadcast_rows: int) -> DataFrame:
    """``rows`` (``h, d, u, start, ...``) with the salts of a crowded gram, null
    for the others.  Up to ``broadcast_rows`` crowded grams (16 bytes each) are
    broadcast; more are joined by gram and a salt of the row, so that no
    gram's rows meet in one task."""
    if crowd.limit(broadcast_rows + 1).count() <= broadcast_rows:
        small = F.broadcast(crowd.select(F.col("h").alias("c_h"), "salts"))
        return rows.join(small, F.col("h") == F.col("c_h"), "left").drop("c_h")
    dealt = crowd.select(F.col("h").alias("c_h"), "salts", F.explode(F.sequence(
        F.lit(0), F.lit(JOIN_SALTS - 1))).alias("c_part"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("d", "u", "start"), F.lit(JOIN_SALTS)))
    return rows.join(dealt.hint("merge"), (F.col("h") == F.col("c_h"))
                     & (F.col("part") == F.col("c_part")), "left").drop("c_h", "c_part", "part")


def repeated_spans(docs: DataFrame, depth: int = DEPTH, shard_bytes: int = SHARD_BYTES,
                   crowded: int = CROWDED, memory: int = MEMORY,
                   broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """For rows ``d, u, s, text`` (id without nulls, two hashes of the text):
    the first row of each text as ``u, s, first``, and the repeats' spans in
    those as ``d, u, spans``."""
    spark = docs.sparkSession
    ship_package(spark)
    firsts_at, pieces_at = scratch_path(spark, "dedup-firsts"), scratch_path(spark, "dedup-pieces")
    docs.groupBy("u", "s").agg(F.min("d").alias("first")).write.parquet(firsts_at)
    firsts = spark.read.parquet(firsts_at)

    grams = docs.select("u", "text").filter(F.octet_length("text") >= depth) \
        .mapInPandas(_gram_rows(depth), "key long, h long, u long, kind tinyint")
    some = grams.repartition("key").sortWithinPartitions("key", "kind") \
        .mapInPandas(_repeated_rows, "u long, h long")
    wanted = some.groupBy("u").agg(F.collect_set("h").alias("hs"))
    wanted = wanted.join(firsts, "u").select(F.col("u").alias("w_u"), F.col("s").alias("w_s"),
                                             "first", "hs")
    texts = docs.join(wanted, (F.col("u") == F.col("w_u")) & (F.col("d") == F.col("first"))
                      & (F.col("s") == F.col("w_s"))).select("d", "u", "text", "hs")
    texts.mapInPandas(_snippets(depth), _PIECE).write.option("compression", "zstd") \
        .parquet(pieces_at)
    pieces = spark.read.parquet(pieces_at)

    rows = pieces.filter(F.col("h").isNotNull())
    crowd = rows.groupBy("h").count().filter(F.col("count") > crowded).select(
        "h", F.ceil(F.col("count") / crowded).cast("long").alias("salts"))
    crowd_at = scratch_path(spark, "dedup-crowded")
    crowd.write.parquet(crowd_at)
    crowd = spark.read.parquet(crowd_at)
    some_crowded = not crowd.isEmpty()
    rows = with_salts(rows, crowd, broadcast_rows) if some_crowded \
        else rows.withColumn("salts", F.lit(None).cast("long"))
    spans = rows.filter(F.col("salts").isNull()).select("h", "d", "u", "start", "snippet") \
        .repartition("h").sortWithinPartitions("h") \
        .mapInPandas(_sort_shards(depth, shard_bytes, memory),
                     "d long, u long, start long, end long")
    if some_crowded:
        places_at = scratch_path(spark, "dedup-places")
        string_places(rows.filter(F.col("salts").isNotNull()), depth) \
            .write.option("compression", "zstd").parquet(places_at)
        spans = spans.unionByName(late_strings(spark.read.parquet(places_at), depth))
    spans = spans.unionByName(pieces.filter(F.col("h").isNull()).select("d", "u", "start", "end"))
    spans = spans.groupBy("d", "u").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return firsts, spans


REPORT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "kept binary")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
          shard_bytes: int = SHARD_BYTES, crowded: int = CROWDED, memory: int = MEMORY,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every document's counts and what is left of it (``kept``, its bytes)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("id", F.coalesce("id", F.lit(_NULL_ID)).alias("d"),
                       F.xxhash64("text").alias("u"),
                       F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("s"), "text")
    firsts, spans = repeated_spans(rows.select("d", "u", "s", "text"), depth, shard_bytes,
                                   crowded, memory, broadcast_rows)
    spans = spans.select(F.col("d").alias("m_d"), F.col("u").alias("m_u"), "spans")
    known = firsts.join(spans, (F.col("first") == F.col("m_d")) & (F.col("u") == F.col("m_u")),
                        "left").select(F.col("u").alias("k_u"), F.col("s").alias("k_s"),
                                       "first", "spans")
    joined = rows.join(known, (F.col("u") == F.col("k_u")) & (F.col("s") == F.col("k_s"))) \
        .select("id", (F.col("d") != F.col("first")).alias("copy"), "spans", "text")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, copy, spans, t in zip(f["id"], f["copy"], f["spans"], f["text"]):
                raw = _utf8(t)
                if copy and len(raw) >= depth:
                    gone = [(0, len(raw))]
                elif spans is not None and len(spans) and not copy:
                    at = np.array([(x["start"], x["end"]) for x in spans])
                    gone = merge(at[:, 0], at[:, 1])
                else:
                    gone = []
                left, last = [], 0
                for a, b in gone:
                    left.append(raw[last:a])
                    last = b
                kept = b"".join([*left, raw[last:]])
                out.append((i, len(raw), sum(b - a for a, b in gone), len(gone),
                            hashlib.sha256(kept).hexdigest(), kept))
            got = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans",
                                             "kept_sha256", "kept"])
            got["doc_id"] = got["doc_id"].astype("Int64")
            yield got

    return joined.mapInPandas(cut, REPORT)
