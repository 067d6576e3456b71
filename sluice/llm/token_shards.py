"""Token ids of a corpus in wavelet-matrix shards.

``write_shards`` orders documents by id over range partitions, encodes whole
texts with a tokenizer of the ``tokenizers`` library, ends each document with
an end id and writes one compressed file per shard (``wavelet.py``); the
file's header holds its place in the order.  ``read_documents``,
``count_tokens`` and ``find_tokens`` answer from the files: all ids, how often
a token stands in them, and where.  ``digest`` reads every file back.

Spark's own writer makes the files (one binary record each, and a line end
that readers skip), so a task that is lost or run twice leaves no half shard,
on any store that Spark can write.  A shard is closed with the document that
brings it to ``shard_ids`` ids; a document stays whole.

Byte-level BPE never merges over a pre-token's edge, and a blank after a
character that is none always starts a pre-token.  So texts are cut there, the
library encodes each distinct piece once and a worker keeps the ids; texts
with other white space around blanks take a slower cut by the same rule.
Tokenizers of another kind encode whole texts.

Defined cases: a null text is empty and has the end id alone; null document
ids stand last; rows with one id follow each other by hash of the text,
repeated rows each count; an empty table writes no shard and reads as no rows;
other columns of the input are not read.  The input has to give the same rows
when a task runs again (a table, or a checkpoint).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.wavelet import WaveletMatrix, encode
from sluice.session import scratch_path, ship_package

END_ID = 2
SHARD_IDS = 4 << 20
CACHED_PIECES = 1_000_000
_LONG_PIECE = 256
_JOINED = 2048
#: A piece starts at a blank or line feed that follows no white space.
_PIECES = re.compile("[\\s\\S][^ \n]*(?:(?<=[\\s᠎])[ \n][^ \n]*)*")
#: A letter or digit and a point behind it are two pre-tokens.
_POINTS = frozenset(".,;:!?")
_BEFORE = frozenset(c for c in map(chr, range(0x180)) if c.isalnum())


def _ends_in_space(piece: str) -> bool:
    return piece[-1].isspace() or piece[-1] == "᠎"


def _cuts_at_blanks(spec: dict) -> bool:
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("ignore_merges")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                        for t in spec.get("added_tokens") or []))


class Encoder:
    """Ids of whole texts, each distinct piece encoded once while it is kept."""

    def __init__(self, path: str, end_id: int = END_ID, cached: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_piece = _cuts_at_blanks(json.load(f))
        vocab = self.tokenizer.get_vocab()
        top = max(end_id, *vocab.values())
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.size = np.zeros(top + 1, np.int64)  # bytes of a byte-level token
        for token, i in vocab.items():
            self.size[i] = len(token)
        self.end = np.array([end_id], self.dtype)
        self.half, self.young, self.old = max(cached // 2, 1), {}, {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_joined(self, pieces: list[str]) -> list[bytes]:
        """Pieces that start with a blank and end in no white space, encoded as one text."""
        ids = self._ids(["".join(pieces)])[0]
        upto = np.cumsum(self.size[ids])
        ends = np.cumsum([len(p.encode()) for p in pieces])
        at = np.searchsorted(upto, ends)
        if len(ids) == 0 or at[-1] >= len(ids) or (upto[at] != ends).any():
            return [x.tobytes() for x in self._ids(pieces)]
        raw, edge = ids.tobytes(), [0, *((at + 1) * self.dtype.itemsize).tolist()]
        return [raw[a:b] for a, b in zip(edge, edge[1:])]

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of pieces that are not there into the young cache."""
        known, ends, joined, rest = self.young, [], {}, {}
        for p in pieces:
            if p[-1:] in _POINTS and p[-2:-1] in _BEFORE:
                ends.append(p)
                p = p[:-1]
                if p in known:
                    continue
            if p[:1] == " " and len(p) <= _LONG_PIECE and not _ends_in_space(p):
                joined[p] = None
            else:
                rest[p] = None
        joined, rest = list(joined), [*rest, *(_POINTS - known.keys() if ends else ())]
        for i in range(0, len(joined), _JOINED):
            part = joined[i:i + _JOINED]
            known.update(zip(part, self._encode_joined(part)))
        known.update(zip(rest, (x.tobytes() for x in self._ids(rest))))
        known.update([(p, known[p[:-1]] + known[p[-1]]) for p in ends])

    def _values(self, pieces: list[str]) -> list[bytes]:
        """Ids of every piece.  What was looked up since the young cache was
        last full is kept; the older half goes first."""
        vals = list(map(self.young.get, pieces))
        gaps = [i for i, v in enumerate(vals) if v is None]
        for k in range(0, len(gaps), self.half):
            part = gaps[k:k + self.half]
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            old, young, new = self.old.get, self.young, []
            for i in part:
                v = vals[i] = old(pieces[i])
                if v is None:
                    new.append(i)
                else:
                    young[pieces[i]] = v
            self._learn(list(dict.fromkeys([pieces[i] for i in new])))
            for i in new:
                vals[i] = self.young[pieces[i]]
        return vals

    def _one(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self._values(_PIECES.findall(text))), self.dtype)

    def _blanks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts that are cut at each blank; their lengths; which were not (length 0)."""
        parts = pc.split_pattern(texts, " ")
        edge = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        last = pc.utf8_slice_codeunits(coded.dictionary, -1)
        open_ = pc.or_(pc.utf8_is_space(last), pc.is_in(last, pa.array(["", "᠎"], last.type)))
        open_ = open_.to_numpy(zero_copy_only=False)[codes]
        open_[edge[1:] - 1] = False  # nothing follows a text's last piece
        slow = np.add.reduceat(open_, edge[:-1]) > 0
        first = np.unique(codes[edge[:-1]])
        vals = self._values([" " + w for w in words])
        vals += self._values([words[i] for i in first])
        vals.append(self.end.tobytes())
        start_code = codes[edge[:-1]]
        codes = codes.astype(np.int64)
        codes[edge[:-1]] = len(words) + np.searchsorted(first, start_code)
        n = np.diff(edge)
        whole = np.full(len(codes) + len(n), len(vals) - 1)
        whole[np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)] = codes
        keep = np.repeat(~slow, n + 1)
        whole = whole[keep] if slow.any() else whole
        size = np.fromiter(map(len, vals), np.int64, len(vals)) // self.dtype.itemsize
        table = np.frombuffer(b"".join(vals), self.dtype)
        start = np.cumsum(size) - size
        each = size[whole]
        upto = np.cumsum(each)
        at = np.repeat((start[whole] - upto + each).astype(np.int32), each)
        at += np.arange(len(at), dtype=np.int32)
        lens = np.zeros(len(n), np.int64)
        ends = np.cumsum(n[~slow] + 1) - 1
        lens[~slow] = np.diff(upto[ends], prepend=0) if len(ends) else 0
        return table[at], lens, slow

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another with their end ids; how many each has."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if not self.by_piece:
            each = [np.append(x, self.end) for x in self._ids(texts.to_pylist())]
            return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
        ids, lens, slow = self._blanks(texts)
        if not slow.any():
            return ids, lens
        fast, out = iter(np.split(ids, np.cumsum(lens[~slow])[:-1])), []
        for i, s in enumerate(slow.tolist()):
            out.append(np.append(self._one(texts[i].as_py()), self.end) if s else next(fast))
            lens[i] = len(out[-1])
        return np.concatenate(out), lens


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, end_id: int) -> Encoder:
    """One encoder a worker process: what it has learnt serves its later tasks."""
    key = path, end_id
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, end_id)
    return _ENCODERS[key]


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 text: str = "text", doc_id: str = "doc_id", shard_ids: int = SHARD_IDS) -> None:
    """Write the shards of ``docs`` to the new folder ``path``."""
    ship_package(docs.sparkSession)
    texts = F.coalesce(F.col(text), F.lit(""))
    # The last key parts rows that are alike in all else, however many there are.
    keys = [F.col("doc").asc_nulls_last(), F.col("h"), F.col("seq")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), texts.alias("body"),
                       F.xxhash64(texts).alias("h"), F.monotonically_increasing_id().alias("seq"))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        F.spark_partition_id().alias("part"), "doc", "body")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, done = _encoder(tokenizer, end_id), 0, 0
        ids, ns, names, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, ns, names, size, done
            who = pa.concat_arrays(names)
            data = encode(np.concatenate(ids), pc.fill_null(who, 0).to_numpy(),
                          pc.is_null(who).to_numpy(zero_copy_only=False), np.concatenate(ns),
                          part << 24 | done)
            ids, ns, names, size, done = [], [], [], 0, done + 1
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            new, lens = coder.encode(batch.column("body"))
            who, upto, a, at = batch.column("doc"), np.cumsum(lens), 0, 0
            while a < len(lens):
                room = shard_ids - size
                b = min(int(np.searchsorted(upto, at + room)) + 1, len(lens))
                ids.append(new[at:upto[b - 1]])
                ns.append(lens[a:b])
                names.append(who.slice(a, b - a))
                size += int(upto[b - 1]) - at
                a, at = b, int(upto[b - 1])
                if size >= shard_ids:
                    yield close()
        if names:
            yield close()

    rows.mapInArrow(shards, "data binary").select(F.col("data").cast("string")).write.option(
        "maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    ship_package(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter(
        "length > 0").select("content")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[WaveletMatrix]:
    for batch in batches:
        for cell in batch.column("content"):
            yield WaveletMatrix(memoryview(cell.as_buffer()))


def _names(w: WaveletMatrix) -> pa.Array:
    return pa.array(w.doc_ids, mask=w.doc_null)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``shard, doc_id, at, ids``: ids of every document; ``at`` counts within the shard."""
    def read(batches):
        for w in _matrices(batches):
            ids = pa.array(w.decode().astype(np.int64))
            edge = pa.array(np.append(w.doc_start, w.n).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(w.n_docs, w.shard)), _names(w), pa.array(w.doc_start),
                 pa.ListArray.from_arrays(edge, ids)], ["shard", "doc_id", "at", "ids"])

    return _files(spark, path).mapInArrow(
        read, "shard long, doc_id long, at long, ids array<long>")


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``token, n``: occurrences in all shards, from ranks alone."""
    tokens = sorted(set(tokens))

    def count(batches):
        for w in _matrices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.int64()), pa.array([w.count(t) for t in tokens], pa.int64())],
                ["token", "n"])

    return _files(spark, path).mapInArrow(count, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n"))


def find_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``token, shard, doc_id, position``: every occurrence, counted within its document."""
    tokens = sorted(set(tokens))

    def find(batches):
        for w in _matrices(batches):
            for t in tokens:
                places = w.occurrences(t)
                doc = np.searchsorted(w.doc_start, places, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), t)), pa.array(np.full(len(places), w.shard)),
                     _names(w).take(pa.array(doc)), pa.array(places - w.doc_start[doc])],
                    ["token", "shard", "doc_id", "position"])

    return _files(spark, path).mapInArrow(
        find, "token long, shard long, doc_id long, position long")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    def read(batches):
        for w in _matrices(batches):
            ids = w.decode().astype("<u4")
            ends = (w.doc_start + w.doc_len).tolist()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(w.doc_start.tolist(), ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(w.n_docs, w.shard)), _names(w), pa.array(w.doc_start),
                 pa.array(w.doc_len), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    staged = scratch_path(spark, "token-digest")
    _files(spark, path).mapInArrow(
        read, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long"
    ).write.parquet(staged)
    rows = spark.read.parquet(staged)
    # One row a shard (4 M ids each), so the running sum over them is short.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(starts, "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
