"""External induced sorting of a shard's suffixes, with common prefixes.

The shard is a byte string of snippets, each closed by a separator that is
smaller than any byte.  Suffixes are wanted up to ``depth`` bytes.

* Suffixes are typed: S (smaller than the next one) or L (larger); the
  leftmost S of each run (LMS) are the seeds.
* ``induce`` derives the order of all others from sorted seeds in two scans
  over the first characters.  It works on monotone priority queues: a scanned
  suffix puts the one before it, as a tuple (position, common prefix with the
  last one put there), into the queue of its first character.  Tuples come
  out by character and arrive in order, so a queue is a file of runs: what
  is over ``memory`` tuples is appended to files on the task's scratch disk
  and read back when its character's turn comes.
* The common prefix of two suffixes that are put behind one another in a
  queue is one more than the least value scanned between their sources; each
  queue keeps that running minimum across the batches.
* The seeds are sorted by a first induction (which sorts the LMS substrings
  and so names them) and by recursion on the string of names, each level
  naming pairs of names of the level below.  (The names' alphabet is too
  large for queues by character, so the levels sort pairs instead of
  inducing.)  The seeds' own common prefixes are read off the text.

Every step is a scan or a sort of plain arrays, which the operating system
pages from the memory-mapped files once a shard is larger than ``memory``.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

import numpy as np

SEPARATOR = 0
ALPHABET = 257
MEMORY = 64_000_000


class Space:
    """Arrays in memory, or on the task's scratch disk when they are large."""

    def __init__(self, memory: int = MEMORY):
        self.memory = memory
        self._dir: tempfile.TemporaryDirectory | None = None
        self._n = 0

    def path(self) -> str:
        if self._dir is None:
            self._dir = tempfile.TemporaryDirectory(prefix="suffix-")
        self._n += 1
        return os.path.join(self._dir.name, f"{self._n}")

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.memory:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype=dtype, mode="w+", shape=(n,))

    def close(self) -> None:
        if self._dir is not None:
            self._dir.cleanup()
            self._dir = None


class BucketQueues:
    """Monotone priority queues of (position, common prefix), by character."""

    def __init__(self, space: Space):
        self.space, self.held = space, 0
        self.runs: list[list] = [[] for _ in range(ALPHABET)]
        self.files: list[list[str]] = [[] for _ in range(ALPHABET)]
        self.least = np.zeros(ALPHABET, np.uint8)  # since the last one put there

    def put(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.runs[c].append((pos, lcp))
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.space.memory:
            self.spill()

    def spill(self) -> None:
        for c, runs in enumerate(self.runs):
            if runs:
                path = self.space.path()
                with open(path, "wb") as f:
                    np.save(f, np.concatenate([r[0] for r in runs]))
                    np.save(f, np.concatenate([r[1] for r in runs]))
                self.files[c].append(path)
                self.runs[c] = []
        self.held = 0

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a character, in order of arrival."""
        parts = []
        for path in self.files[c]:
            with open(path, "rb") as f:
                parts.append((np.load(f), np.load(f)))
            os.remove(path)
        parts += self.runs[c]
        self.held -= sum(p.nbytes + q.nbytes for p, q in self.runs[c])
        self.files[c], self.runs[c] = [], []
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p for p, _ in parts]), np.concatenate([q for _, q in parts])

    def scatter(self, target: np.ndarray, at: np.ndarray, pos: np.ndarray,
                lcp: np.ndarray | None, depth: int) -> None:
        """Put ``pos`` into the queues ``target``; ``at`` are their sources'
        places in the batch scanned, whose common prefixes are ``lcp``."""
        order = np.argsort(target, kind="stable")
        tgt, at, pos = target[order], at[order], pos[order]
        cuts = np.flatnonzero(np.diff(tgt)) + 1
        starts = np.concatenate(([0], cuts)) if len(tgt) else np.zeros(0, int)
        chars = tgt[starts].astype(int)
        if lcp is None:
            value = np.zeros(len(pos), np.uint8)
        else:
            value = self._between(lcp, at, starts, chars, depth)
        for c, a, b in zip(chars.tolist(), starts.tolist(), [*cuts.tolist(), len(tgt)]):
            self.put(c, pos[a:b], value[a:b])

    def _between(self, lcp, at, starts, chars, depth) -> np.ndarray:
        total = lcp.min() if len(lcp) else depth
        got = np.zeros(len(at), np.uint8)
        first = np.zeros(len(at), bool)
        first[starts] = True
        if len(at):
            head = np.minimum.accumulate(lcp)
            tail = np.minimum.accumulate(lcp[::-1])[::-1]
            got[starts] = np.minimum(self.least[chars], head[at[starts]])
            inner = np.flatnonzero(~first)
            lo, hi = at[inner - 1] + 1, at[inner]
            got[inner] = _range_min(lcp, lo, hi)
            ends = np.append(starts[1:], len(at)) - 1
            rest = at[ends] + 1
            after = np.where(rest < len(lcp), tail[np.minimum(rest, len(lcp) - 1)], depth)
        self.least = np.minimum(self.least, total).astype(np.uint8)
        if len(at):
            self.least[chars] = after
        return np.minimum(got.astype(np.int16) + 1, depth).astype(np.uint8)


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of x[lo..hi] (both included) of each pair."""
    out = np.zeros(len(lo), x.dtype)
    level = np.frexp((hi - lo + 1).astype(float))[1] - 1
    table, k = x, 0
    most = int(level.max()) if len(level) else -1
    while k <= most:
        on = np.flatnonzero(level == k)
        if len(on):
            out[on] = np.minimum(table[lo[on]], table[hi[on] - (1 << k) + 1])
        if k < most:
            table = np.minimum(table[:-(1 << k)], table[1 << k:])
        k += 1
    return out


@dataclass
class Sorted:
    """Suffix positions in order, and the common prefix with the one before."""

    order: np.ndarray
    lcp: np.ndarray


class InducedSorter:
    def __init__(self, text: np.ndarray, depth: int, space: Space | None = None):
        """``text``: 0 for a separator, byte + 1 otherwise; ends with 0."""
        self.t, self.depth, self.space = text, depth, space or Space()
        n = len(text)
        self.n = n
        self.idx = np.int32 if n < 1 << 31 else np.int64
        same = np.empty(n, bool)
        same[:-1] = text[:-1] == text[1:]
        same[-1] = False
        smaller = np.ones(n, bool)
        smaller[:-1] = text[:-1] < text[1:]
        stop = np.where(same, n, np.arange(n, dtype=self.idx))
        stop = np.minimum.accumulate(stop[::-1])[::-1]  # next place with another character
        self.s = smaller[stop]
        self.run = np.minimum(stop - np.arange(n, dtype=self.idx) + 1, depth).astype(np.uint8)
        lms = self.s.copy()
        lms[0] = False
        lms[1:] &= ~self.s[:-1]
        self.lms = np.flatnonzero(lms).astype(self.idx)
        ends = np.where(text == SEPARATOR, np.arange(n, dtype=self.idx), n)
        ends = np.minimum.accumulate(ends[::-1])[::-1]
        self.left = np.minimum(ends - np.arange(n, dtype=self.idx), depth).astype(np.uint8)
        pad = np.concatenate([text, np.zeros(4, text.dtype)]).astype(np.uint64)
        # four characters in one word, for comparisons
        self.word = (pad[:n] << np.uint64(48)) | (pad[1:n + 1] << np.uint64(32)) \
            | (pad[2:n + 2] << np.uint64(16)) | pad[3:n + 3]

    def common(self, a: np.ndarray, b: np.ndarray, most) -> np.ndarray:
        """Common prefix of suffix pairs, at most ``most`` (a number or one each)."""
        out = np.zeros(len(a), np.int32)
        most = np.broadcast_to(np.asarray(most, np.int32), len(a))
        on = np.arange(len(a))
        done = 0
        while len(on):
            inside = (np.maximum(a[on], b[on]) + done < self.n)
            on = on[inside]
            x = self.word[a[on] + done] ^ self.word[b[on] + done]
            same = np.where(x == 0, 4, np.where(x >> np.uint64(16) == 0, 3, np.where(
                x >> np.uint64(32) == 0, 2, np.where(x >> np.uint64(48) == 0, 1, 0))))
            out[on] = done + same
            done += 4
            on = on[(same == 4) & (most[on] > done)]
        return np.minimum(out, most)

    def induce(self, seeds: np.ndarray, seed_lcp: np.ndarray | None) -> Sorted:
        """All L and S suffixes from seeds sorted by first character at least;
        common prefixes only if those of the seeds are given."""
        t, s, depth, carry = self.t, self.s, self.depth, seed_lcp is not None
        chars = t[seeds]
        edge = np.searchsorted(chars, np.arange(ALPHABET + 1))
        larger: list[tuple[np.ndarray, np.ndarray]] = []
        q = BucketQueues(self.space)

        def scan(pos, lcp, want_s: bool, own: int):
            """Put the suffixes before those scanned; returns those that
            belong to the queue being read itself."""
            at = np.flatnonzero(pos > 0)
            before = pos[at] - 1
            ok = s[before] == want_s
            at, before = at[ok], before[ok]
            q.scatter(t[before], at, before, lcp if carry else None, depth)
            return q.take(own)

        for c in range(ALPHABET):
            parts = []
            pos, lcp = q.take(c)
            if len(pos):
                lcp = lcp.copy()
                lcp[0] = 0
            while len(pos):
                parts.append((pos, lcp))
                pos, lcp = scan(pos, lcp, False, c)
            larger.append((_cat(parts, 0, self.idx), _cat(parts, 1, np.uint8)))
            a, b = edge[c], edge[c + 1]
            if b > a:
                own = seeds[a:b]
                l0 = seed_lcp[a:b].copy() if carry else np.zeros(b - a, np.uint8)
                last = larger[-1][0]
                l0[0] = min(self.run[last[-1]], self.run[own[0]]) if len(last) else 0
                pos, lcp = scan(own, l0, False, c)
                assert not len(pos)  # what precedes a seed has a larger character

        smaller: list[tuple[np.ndarray, np.ndarray]] = []
        q = BucketQueues(self.space)
        for c in range(ALPHABET - 1, -1, -1):
            parts = []
            pos, lcp = q.take(c)
            if len(pos):
                lcp = lcp.copy()
                lcp[0] = 0
            end = c == t[self.n - 1]  # the last suffix is the least of all
            while len(pos) or end:
                if not len(pos):
                    pos, lcp = np.array([self.n - 1], self.idx), np.zeros(1, np.uint8)
                    end = False
                parts.append((pos, lcp))
                pos, lcp = scan(pos, lcp, True, c)
            own, l1 = _cat(parts, 0, self.idx), _cat(parts, 1, np.uint8)
            smaller.append((own, l1))
            big, l2 = larger[c]
            if len(big):  # scanned downwards: the value belongs to the upper neighbour
                down = np.zeros(len(big), np.uint8)
                down[1:] = l2[:0:-1]
                if len(own):
                    down[0] = min(self.run[big[-1]], self.run[own[-1]])
                scan(big[::-1], down, True, c)
        smaller = smaller[::-1]

        order = self.space.array(self.n, self.idx)
        lcps = self.space.array(self.n, np.uint8)
        k = 0
        for c in range(ALPHABET):
            (big, l2), (own, l1) = larger[c], smaller[c]
            order[k:k + len(big)] = big
            lcps[k:k + len(big)] = l2
            k += len(big)
            if len(own):
                up = np.zeros(len(own), np.uint8)
                up[1:] = l1[:0:-1]
                up[0] = min(self.run[big[-1]], self.run[own[-1]]) if len(big) else 0
                order[k:k + len(own)] = own[::-1]
                lcps[k:k + len(own)] = up
                k += len(own)
        return Sorted(order[:k], lcps[:k])

    def sorted_seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Seeds in order of their suffixes, and their common prefixes."""
        lms = self.lms
        first = lms[np.argsort(self.t[lms], kind="stable")]
        by_substring = self.induce(first, None).order
        is_lms = np.zeros(self.n, bool)
        is_lms[lms] = True
        ranked = by_substring[is_lms[by_substring]]
        nxt = np.empty(self.n, self.idx)
        nxt[lms[:-1]] = lms[1:]
        nxt[lms[-1]] = self.n - 1
        length = np.minimum(nxt[ranked] - ranked + 1, self.depth)
        length[self.t[ranked] == SEPARATOR] = 1  # what follows a separator does not count
        a, b = ranked[:-1], ranked[1:]
        same = length[:-1] == length[1:]
        at = np.flatnonzero(same)
        same[at] = self.common(a[at], b[at], length[at]) >= length[at]
        name = np.concatenate(([0], np.cumsum(~same)))
        names = np.empty(self.n, np.int64)
        names[ranked] = name
        names = names[lms]
        rank = _rank_pairs(names, self.t[lms] == SEPARATOR, 1, self.depth // 2 + 1)
        seeds = lms[np.argsort(rank, kind="stable")]
        lcp = np.zeros(len(seeds), np.uint8)
        # a separator matches nothing, so no prefix reaches beyond one
        a, b = seeds[:-1], seeds[1:]
        lcp[1:] = self.common(a, b, np.minimum(self.left[a], self.left[b]))
        return seeds, lcp

    def sort(self) -> Sorted:
        seeds, lcp = self.sorted_seeds()
        return self.induce(seeds, lcp)


def _cat(parts, k: int, dtype) -> np.ndarray:
    if not parts:
        return np.zeros(0, dtype)
    return parts[0][k] if len(parts) == 1 else np.concatenate([p[k] for p in parts])


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, and for each place in it the first place of its key and
    whether the key occurs again."""
    order = np.argsort(key)
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    again = ~new
    again[:-1] |= ~new[1:]
    return order, first, again


def _rank_pairs(names: np.ndarray, last: np.ndarray, span: int, most: int) -> np.ndarray:
    """Ranks of the suffixes of a string of names, up to a separator."""
    stop = np.where(last, np.arange(len(names)), len(names))
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    order, first, again = _groups(names)
    rank = np.empty(len(names), np.int64)
    rank[order] = first
    return _refine(rank, order[again], stop, span, most)


def _refine(rank: np.ndarray, open_: np.ndarray, stop: np.ndarray, span: int, most: int
            ) -> np.ndarray:
    """One level: equal ranks are told apart by the rank ``span`` names on,
    and what stays equal by the next level, over twice the span."""
    if span >= most or not len(open_):
        return rank
    n = len(rank)
    at = open_ + span
    ahead = np.where(at <= np.minimum(stop[open_], n - 1), rank[np.minimum(at, n - 1)] + 1, 0)
    own = rank[open_]
    order, first, again = _groups(own * (n + 2) + ahead)
    own = own[order]
    base = np.ones(len(own), bool)
    base[1:] = own[1:] != own[:-1]
    base = np.maximum.accumulate(np.where(base, np.arange(len(own)), 0))
    new = own + first - base
    if np.array_equal(new, own):
        return rank
    rank[open_[order]] = new
    return _refine(rank, open_[order[again]], stop, span * 2, most)


def repeated(snippets: list[bytes], depth: int, memory: int = MEMORY
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all strings of ``depth`` bytes that occur more than once.

    Returns (group, snippet, offset): places of one group hold equal strings.
    """
    space = Space(memory)
    try:
        sizes = np.array([len(x) for x in snippets], np.int64)
        ends = np.cumsum(sizes + 1)
        text = space.array(int(ends[-1]), np.uint16)
        raw = np.frombuffer(b"\0".join(snippets) + b"\0", np.uint8)
        text[:] = raw
        text += 1
        text[ends - 1] = SEPARATOR
        got = InducedSorter(text, depth, space).sort()
        long = got.lcp >= depth
        where = np.flatnonzero(long)
        at = got.order[where]
        owner = np.searchsorted(ends, at, side="right")
        long[where] = at + depth < ends[owner]  # not beyond the snippet
        start = np.zeros(len(long), bool)  # first of a group: the next one shares
        start[:-1] = long[1:] & ~long[:-1]
        member = long | start
        pos = np.asarray(got.order[member], np.int64)
        group = np.cumsum(start[member])
        owner = np.searchsorted(ends, pos, side="right")
        return group, owner, pos - (ends[owner] - sizes[owner] - 1)
    finally:
        space.close()
