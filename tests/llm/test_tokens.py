"""Op 11: wavelet matrices against plain arrays, shards against the tokenizer itself."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluice.llm import token_shards as ts
from sluice.llm.wavelet import BLOCK, WaveletMatrix, encode
from sluice.session import scratch_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\n\n  b\t", "\n", "x,  y . z;",
       "don't, they've!", "a  b  c", "<|endoftext|>", "a <|endoftext|> b",
       "no<|endoftext|>. gap", "\x1c \x1f a\x85 b", "ünï çödé, 你好 世界。 ok",
       "1,000 2.5: 3rd", "é. ñ, ß; ǆ. ᠎ x", "z" * 3000 + " " + "y" * 400 + ".", "\U0001f600 a\U0001f600."]


def _lib(texts):
    tk = Tokenizer.from_file(BPE)
    return [[*e.ids, 2] for e in tk.encode_batch([t or "" for t in texts],
                                                 add_special_tokens=False)]


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (700, 1), (5000, 3), (2 * BLOCK + 77, 60000),
                                    (3000, 1 << 31)])
def test_matrix_against_plain_array(n, top):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.pareto(0.6, n) * 3, top - 1).astype(np.uint32)
    w = WaveletMatrix(encode(ids, np.array([4]), np.array([False]), np.array([n]), 9))
    assert w.shard == 9 and np.array_equal(w.decode(), ids)
    for at in rng.integers(0, n, 20).tolist() if n else []:
        t = int(ids[at])
        places = np.flatnonzero(ids == t)
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        assert w.access(at) == t
        assert w.rank(t, at) == (ids[:at] == t).sum()
        assert w.count(t, lo, hi) == (ids[lo:hi] == t).sum()
        assert np.array_equal(w.occurrences(t), places)
        k = int(rng.integers(len(places)))
        assert w.select(t, k) == places[k]
    assert w.count(top + 1) == 0 and len(w.occurrences(top + 1)) == 0
    with pytest.raises(IndexError):
        w.access(n)
    with pytest.raises(IndexError):
        w.select(top + 1, 0)


def test_frequent_ids_compress():
    ids = np.random.default_rng(5).geometric(0.3, 200_000).astype(np.uint32) * 997
    assert len(encode(ids, np.array([0]), np.array([0]), np.array([len(ids)]))) < len(ids) / 2


def test_pieces_equal_whole_texts():
    rng = random.Random(3)
    atoms = [" ", "  ", "\n", "\t", " \n", "a", "Bc", "é", "1", "'s", "'", ",", ".", "!", " ",
             " ", "\x1d", "᠎", "<|endoftext|>", "世", "\U0001f600", "ing", " the"]
    texts = ODD + ["".join(rng.choices(atoms, k=rng.randint(0, 12))) for _ in range(3000)]
    for cached in (1_000_000, 60):
        ids, lens = ts.Encoder(BPE, cached=cached).encode(pa.array([*texts, None]))
        got = [x.tolist() for x in np.split(ids, np.cumsum(lens)[:-1])]
        assert got == _lib([*texts, None])


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = ts.Encoder(path, end_id=1)
    assert not coder.by_piece
    ids, lens = coder.encode(pa.array(["Hello  there", None]))
    want = Tokenizer.from_file(path).encode("Hello  there", add_special_tokens=False).ids
    assert ids.tolist() == [*want, 1, 1] and lens.tolist() == [len(want) + 1, 1]


@pytest.mark.parametrize("shard_ids", [3, 50, 1 << 22])
def test_shards_read_back(spark, shard_ids):
    rows = [(i * 3 % 23, t) for i, t in enumerate(ODD)] + [(5, None), (5, None), (7, "same id")]
    rows += [(-4, "twice twice")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS doc", "2 AS body", "3 AS part", "4 AS h").repartition(3)
    path = scratch_path(spark, "t11")
    ts.write_shards(docs, path, BPE, shard_ids=shard_ids)
    want = sorted((i, ids) for (i, _), ids in zip(rows, _lib([t for _, t in rows])))
    got = sorted(ts.digest(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [i for i, _ in want]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    crc = {(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want}
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got} == crc
    back = ts.read_documents(spark, path).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in back) == want
    places = {(i, p): 0 for i, x in want for p, t in enumerate(x) if t == 2}
    found = ts.find_tokens(spark, path, [2, 49999]).collect()
    assert {(r["doc_id"], r["position"]) for r in found} == set(places)
    flat = [t for _, x in want for t in x]
    assert {r["token"]: r["n"] for r in ts.count_tokens(spark, path, [2, 64, 49999]).collect()} \
        == {t: flat.count(t) for t in (2, 64, 49999)}


def test_null_ids_stand_last_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "b"), (3, "a"), (None, "a")], "doc_id long, text string")
    path = scratch_path(spark, "t11")
    ts.write_shards(docs, path, BPE)
    got = sorted(ts.digest(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [3, None, None]
    path = scratch_path(spark, "t11")
    ts.write_shards(docs.limit(0), path, BPE)
    assert ts.digest(spark, path).collect() == []
