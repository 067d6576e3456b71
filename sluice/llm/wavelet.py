"""Wavelet matrix of token ids in one compressed byte string.

A shard's ids are renumbered by falling frequency (the alphabet stands in
the file), so the upper bit planes are nearly empty and compress well.  Each
plane is cut into blocks of ``BLOCK`` bits, every block compressed by itself,
with a directory of the ones before it: ``access``, ``rank``, ``count``,
``select`` and ``occurrences`` open only the blocks they touch, ``decode``
undoes the planes from the last to the first and gives all ids.

Layout, little endian::

    magic 8 | shard int64 | ids uint64 | documents uint32 | alphabet uint32
    levels uint32 | blocks of a level uint32 | bytes of the three zstd parts uint32 * 3
    zeros uint64[levels]
    zstd: alphabet uint32[]
    zstd: document ids int64[], null flags uint8[], ids of each document uint32[]
    zstd: bytes of each block uint32[levels * blocks], ones of each block uint32[...]
    blocks, each zstd, or plain where that is not shorter

Defined cases: no ids and no documents, one distinct id (no levels), ids up
to 2**32 - 1.
"""

from __future__ import annotations

import functools
import struct

import numpy as np
import zstandard

MAGIC = b"WVLTMX1\0"
BLOCK = 1 << 16
_HEAD = struct.Struct("<8sqQIIIIIII")


def _pack(level: int, *arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(b"".join(a.tobytes() for a in arrays))


def encode(ids: np.ndarray, doc_ids: np.ndarray, doc_null: np.ndarray, doc_len: np.ndarray,
           shard: int = 0, level: int = 1) -> bytes:
    """The file of one shard: ``ids`` of all its documents, one after another."""
    if int(doc_len.sum()) != len(ids):
        raise ValueError("document lengths do not add up to the ids")
    top = int(ids.max()) + 1 if len(ids) else 0
    if top <= 1 << 20:
        freq = np.bincount(ids, minlength=top)
        alphabet = np.flatnonzero(freq)
        alphabet = alphabet[np.argsort(-freq[alphabet], kind="stable")]
        code = np.zeros(top, np.uint32)
        code[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
        symbols = code[ids]
    else:
        alphabet, back, freq = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-freq, kind="stable")
        code = np.empty(len(order), np.uint32)
        code[order] = np.arange(len(order), dtype=np.uint32)
        alphabet, symbols = alphabet[order], code[back]
    levels = max(len(alphabet) - 1, 0).bit_length()
    if levels <= 16:
        symbols = symbols.astype(np.uint16)
    n_blocks = -(-len(ids) // BLOCK)
    press = zstandard.ZstdCompressor(level=level)
    zeros, parts = np.zeros(levels, np.uint64), []
    ones = np.zeros((levels, n_blocks), np.uint32)
    for k in range(levels):
        bit = (symbols >> (levels - 1 - k)) & 1
        set_ = bit.astype(bool)
        plane = np.packbits(set_, bitorder="little").tobytes()
        if n_blocks:
            ones[k] = [np.count_nonzero(set_[a:a + BLOCK]) for a in range(0, len(ids), BLOCK)]
        for at in range(0, len(plane), BLOCK // 8):
            raw = plane[at:at + BLOCK // 8]
            small = press.compress(raw)
            parts.append(small if len(small) < len(raw) else raw)
        low = np.flatnonzero(~set_)  # places, not a mask: no branch for each id
        zeros[k] = len(low)
        symbols = np.concatenate([symbols[low], symbols[np.flatnonzero(set_)]])
    alpha = _pack(level, alphabet.astype("<u4"))
    docs = _pack(level, doc_ids.astype("<i8"), doc_null.astype("u1"), doc_len.astype("<u4"))
    sizes = np.fromiter(map(len, parts), np.uint32, len(parts))
    table = _pack(level, sizes, ones.ravel())
    return b"".join([
        _HEAD.pack(MAGIC, shard, len(ids), len(doc_ids), len(alphabet), levels, n_blocks,
                   len(alpha), len(docs), len(table)),
        zeros.astype("<u8").tobytes(), alpha, docs, table, *parts])


class WaveletMatrix:
    """Reader of one shard's file."""

    def __init__(self, data: bytes | memoryview, cached_blocks: int = 256):
        self.data = memoryview(data)
        (magic, self.shard, self.n, self.n_docs, self.n_alphabet, self.levels, self.n_blocks,
         alpha, docs, table) = _HEAD.unpack_from(self.data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self._unpack = zstandard.ZstdDecompressor()
        at = _HEAD.size
        self.zeros = np.frombuffer(self.data, "<u8", self.levels, at).astype(np.int64)
        at += 8 * self.levels
        self.alphabet = np.frombuffer(self._open(at, alpha, 4 * self.n_alphabet), "<u4")
        at += alpha
        raw = self._open(at, docs, 13 * self.n_docs)
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs)
        self.doc_null = np.frombuffer(raw, "u1", self.n_docs, 8 * self.n_docs).astype(bool)
        self.doc_len = np.frombuffer(raw, "<u4", self.n_docs, 9 * self.n_docs).astype(np.int64)
        self.doc_start = np.cumsum(self.doc_len) - self.doc_len
        at += docs
        cells = self.levels * self.n_blocks
        both = np.frombuffer(self._open(at, table, 8 * cells), "<u4")
        at += table
        self._size = both[:cells].astype(np.int64)
        self._at = at + np.cumsum(self._size) - self._size
        ones = both[cells:].astype(np.int64).reshape(self.levels, self.n_blocks)
        self._before = np.zeros((self.levels, self.n_blocks + 1), np.int64)
        np.cumsum(ones, axis=1, out=self._before[:, 1:])
        self._bits = functools.lru_cache(cached_blocks)(self._load)

    def _open(self, at: int, size: int, want: int) -> bytes:
        return self._unpack.decompress(self.data[at:at + size], max_output_size=max(want, 1))

    def _raw(self, level: int, block: int) -> bytes:
        cell = level * self.n_blocks + block
        at, size = int(self._at[cell]), int(self._size[cell])
        want = (min(BLOCK, self.n - block * BLOCK) + 7) // 8
        part = self.data[at:at + size]
        return part if size == want else self._unpack.decompress(part, max_output_size=want)

    def _load(self, level: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a block and, before each bit, the ones of the block."""
        n = min(BLOCK, self.n - block * BLOCK)
        bits = np.unpackbits(np.frombuffer(self._raw(level, block), np.uint8), count=n,
                             bitorder="little")
        upto = np.zeros(n + 1, np.int32)
        np.cumsum(bits, dtype=np.int32, out=upto[1:])
        return bits, upto

    def _rank1(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a level."""
        if at == 0:
            return 0
        block, off = divmod(at - 1, BLOCK)
        return int(self._before[level, block] + self._bits(level, block)[1][off + 1])

    def _select(self, level: int, one: bool, ranks: np.ndarray) -> np.ndarray:
        """Places of the ``ranks``-th (from 0) ones or zeros, ascending ranks."""
        before = self._before[level]
        if not one:
            edge = np.minimum(np.arange(self.n_blocks + 1) * BLOCK, self.n)
            before = edge - before
        block = np.searchsorted(before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for b in np.unique(block):
            mine = block == b
            bits = self._bits(level, int(b))[0]
            places = np.flatnonzero(bits) if one else np.flatnonzero(bits == 0)
            out[mine] = b * BLOCK + places[ranks[mine] - before[b]]
        return out

    def _symbol(self, token: int) -> int | None:
        at = np.flatnonzero(self.alphabet == token)
        return int(at[0]) if len(at) else None

    def access(self, at: int) -> int:
        """Token id at a place of the shard."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        symbol = 0
        for k in range(self.levels):
            block, off = divmod(at, BLOCK)
            one = int(self._bits(k, block)[0][off])
            ones = self._rank1(k, at)
            symbol = symbol << 1 | one
            at = int(self.zeros[k]) + ones if one else at - ones
        return int(self.alphabet[symbol])

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the symbol's places of ``[lo, hi)`` stand below the last level."""
        for k in range(self.levels):
            a, b = self._rank1(k, lo), self._rank1(k, hi)
            if symbol >> (self.levels - 1 - k) & 1:
                lo, hi = int(self.zeros[k]) + a, int(self.zeros[k]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often the token stands in places ``[lo, hi)``."""
        hi = self.n if hi is None else min(hi, self.n)
        lo = max(lo, 0)
        symbol = self._symbol(token)
        if symbol is None or lo >= hi:
            return 0
        a, b = self._range(symbol, lo, hi)
        return b - a

    def rank(self, token: int, at: int) -> int:
        """How often the token stands before a place."""
        return self.count(token, 0, at)

    def _up(self, symbol: int, places: np.ndarray) -> np.ndarray:
        for k in reversed(range(self.levels)):
            one = bool(symbol >> (self.levels - 1 - k) & 1)
            places = self._select(k, one, places - (int(self.zeros[k]) if one else 0))
        return places

    def select(self, token: int, k: int) -> int:
        """Place of the token's ``k``-th occurrence, from 0."""
        symbol = self._symbol(token)
        a, b = (0, 0) if symbol is None else self._range(symbol, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        return int(self._up(symbol, np.array([a + k]))[0])

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the token, ascending."""
        symbol = self._symbol(token)
        if symbol is None:
            return np.zeros(0, np.int64)
        return self._up(symbol, np.arange(*self._range(symbol, 0, self.n)))

    def decode(self) -> np.ndarray:
        """All ids, in order."""
        symbols = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for k in reversed(range(self.levels)):
            plane = b"".join(self._raw(k, b) for b in range(self.n_blocks))
            set_ = np.unpackbits(np.frombuffer(plane, np.uint8), count=self.n,
                                 bitorder="little").view(bool)
            out = np.empty_like(symbols)
            zeros = int(self.zeros[k])
            out[np.flatnonzero(~set_)] = symbols[:zeros]
            out[np.flatnonzero(set_)] = symbols[zeros:] | (1 << (self.levels - 1 - k))
            symbols = out
        return self.alphabet[symbols] if self.n else np.zeros(0, np.uint32)
