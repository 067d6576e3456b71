"""Toxicity by a subsequence string kernel machine with Nystroem landmarks.

Kernel: two units (a word, or a run of single characters written apart) are
compared by all their character subsequences of length 2 and 3, gaps
allowed; a subsequence spanning ``k`` characters counts ``DECAY ** k``, and
the kernel is normalised.  A unit's beginning and end count as characters, so
a word that only contains an insult's letters is told apart.  Inserted characters ("i.d.i.o.t", "i d i o t")
and unknown endings so keep most of the likeness.  Units longer than
``WIDTH`` are read in overlapping windows, so whole texts are scored.

Training (one task, on a bounded sample: the first ``sample_toxic`` and
``sample_clean`` labelled rows of each class in the order of a hash of the
id; held-out rows never): texts are cut into sentences.  A sentence of a
clean document is negative; of a toxic document only its witness sentences
are taken as positive, first chosen by character groups that chance would
not confine to toxic documents, then also by the machine itself.  Each sentence stands for itself by its
strongest unit.  Landmarks are spread over both classes; in the Nystroem
feature space a linear support vector machine (squared hinge, Newton steps)
is fitted, and its margins are calibrated to probabilities on the sample.

Scoring: kernel values against all landmarks times the machine's weights
are one linear function of the unit's subsequences, so a unit costs one
table lookup per subsequence; units are scored once per worker and batch.
A document's margin is the largest of its units'.  Score columns use the
text only.

Defined cases: null and empty texts score as a text without any unit (the
lowest margin); without labelled rows of both classes every row scores the
share of toxic rows; labels with null are ignored; repeated rows score
alike; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._names import fresh
from sluice.session import ship_package

FOLDS = 5
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 2000
LANDMARKS = 128
WIDTH = 13
DECAY = 0.75
_CODES = 64
_TABLE = _CODES ** 2 + _CODES ** 3
_START, _END = "\x02", "\x03"  # where a unit begins and ends
_CACHE_UNITS = 600_000
_LOWEST = -4.0

# positions of all subsequences of a window, those of its first characters first
_two = np.array(sorted(combinations(range(WIDTH), 2), key=lambda c: c[-1]))
_three = np.array(sorted(combinations(range(WIDTH), 3), key=lambda c: c[-1]))
_w2 = (DECAY ** (_two[:, 1] - _two[:, 0] + 1)).astype(np.float32)
_w3 = (DECAY ** (_three[:, 2] - _three[:, 0] + 1)).astype(np.float32)
_APART = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_INNER = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_EDGES = "\"'.,;:!?()[]{}|#$%&*_-~`"


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def units_of(text: str | None) -> list[str]:
    """Words and spelt-out runs of a lower-cased text."""
    low = (text or "").lower()
    units = low.split()
    for run in _APART.findall(low):
        units.append("".join(run.split()))
    return units


def _windows(unit: str) -> list[str]:
    """What of a unit is compared: itself, and without inserted marks."""
    unit = unit.strip(_EDGES)
    plain = _INNER.sub("", unit)
    out = []
    for u in (unit,) if plain == unit else (unit, plain):
        u = f"{_START}{u}{_END}"
        if len(u) <= WIDTH:
            out.append(u)
        else:
            starts = [*range(0, len(u) - WIDTH, WIDTH // 2), len(u) - WIDTH]
            out += [u[a:a + WIDTH] for a in starts]
    return out


def _codes(windows: list[str], length: int) -> np.ndarray:
    """Letters, digits and all other characters as numbers below 64."""
    raw = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4")
    o = raw.reshape(len(windows), length).astype(np.int64)
    return np.where((o >= 97) & (o <= 122), o - 97,
                    np.where((o >= 48) & (o <= 57), o - 22,
                             np.where((o == 2) | (o == 3), 60 + o, 36 + o % 26)))


def _subsequences(windows: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Table index of every subsequence of windows of one length, and their
    weights, normalised so that each window's kernel with itself is 1."""
    c = _codes(windows, length)
    n2, n3 = length * (length - 1) // 2, length * (length - 1) * (length - 2) // 6
    two, three = _two[:n2], _three[:n3]
    index = np.concatenate([
        c[:, two[:, 0]] * _CODES + c[:, two[:, 1]],
        _CODES ** 2 + (c[:, three[:, 0]] * _CODES + c[:, three[:, 1]]) * _CODES
        + c[:, three[:, 2]]], axis=1).astype(np.int32)
    w = np.concatenate([_w2[:n2], _w3[:n3]])
    order = np.argsort(index, axis=1)
    rows = np.take_along_axis(index, order, 1)
    first = np.ones(rows.shape, bool)
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    sums = np.add.reduceat(w[order].ravel(), np.flatnonzero(first.ravel()))
    row_of = np.repeat(np.arange(len(windows)), first.sum(1))
    norm = np.sqrt(np.bincount(row_of, sums.astype(float) ** 2, len(windows)))
    return index, (w[None, :] / norm[:, None]).astype(np.float32)


def _by_length(windows: list[str]):
    """Groups (positions, windows, length) of equal length; units of fewer
    than three characters are not compared."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(windows):
        if len(w) > 4:
            groups.setdefault(len(w), []).append(i)
    for length, at in sorted(groups.items()):
        yield np.array(at), [windows[i] for i in at], length


def kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel matrix of windows against landmarks."""
    tables = np.zeros((_TABLE, len(landmarks)), np.float32)
    for at, ws, length in _by_length(landmarks):
        index, w = _subsequences(ws, length)
        for j, row, wt in zip(at, index, w):
            np.add.at(tables[:, j], row, wt)
    out = np.zeros((len(units), len(landmarks)), np.float32)
    for at, ws, length in _by_length(units):
        for lo in range(0, len(ws), 64):
            index, w = _subsequences(ws[lo:lo + 64], length)
            out[at[lo:lo + 64]] = np.einsum("uk,ukm->um", w, tables[index])
    return out


@dataclass
class Model:
    """Linear function over subsequences, and its calibration."""

    table: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    key: str = ""
    landmarks: list[str] = field(default_factory=list)

    def unit_margins(self, units: list[str]) -> np.ndarray:
        windows, owner = [], []
        for i, u in enumerate(units):
            got = _windows(u)
            windows += got
            owner += [i] * len(got)
        owners, out = np.array(owner, int), np.full(len(units), _LOWEST)
        for at, ws, length in _by_length(windows):
            for lo in range(0, len(ws), 2048):
                index, w = _subsequences(ws[lo:lo + 2048], length)
                f = np.einsum("uk,uk->u", self.table[index], w) + self.bias
                np.maximum.at(out, owners[at[lo:lo + 2048]], f)
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


# --- training ----------------------------------------------------------------------------

def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1.0
         ) -> tuple[np.ndarray, float]:
    """Squared hinge machine by Newton steps; the bias is a constant feature."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * reg
    ridge[-1, -1] = 1e-3
    for _ in range(50):
        on = y * (x @ w) < 1
        xa = x[on] * weight[on, None]
        new = np.linalg.solve(ridge + xa.T @ x[on], xa.T @ y[on])
        if np.abs(new - w).max() < 1e-7:
            break
        w = 0.5 * (w + new) if _ > 20 else new
    return w[:-1], float(w[-1])


def _calibrate(margins: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic fit with smoothed targets at the labels' own share of toxic
    rows; slope kept positive."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    wt = np.where(y > 0, share / n1, (1 - share) / n0) * len(y)
    ab = np.array([3.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))], 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        g = x.T @ (wt * (p - t)) + 1e-2 * (ab - [3.0, 0.0])
        h = (x * (wt * p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-2
        step = np.linalg.solve(h, g)
        ab = ab - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(ab[0]), 0.1), float(ab[1])


def _grams(unit: str) -> set[str]:
    return {unit} | {unit[i:i + k] for k in (4, 5) for i in range(len(unit) - k + 1)}


def _odds(toxic: list[set[str]], clean: list[set[str]]) -> tuple[dict[str, float], set[str]]:
    """Log-odds of every unit's best character group (counted once per
    document), and the units with a group that only chance could not confine
    to toxic documents."""
    counts: dict[str, int] = {}  # toxic documents in the upper bits, clean ones in the lower
    for one, docs in ((1 << 32, toxic), (1, clean)):
        for units in docs:
            seen: set[str] = set()
            for u in units:
                seen |= _grams(u)
            for g in seen:
                counts[g] = counts.get(g, 0) + one
    n1, n0 = len(toxic) + 1, len(clean) + 1
    enough = np.log(len(counts) + 1) / np.log((n1 + n0) / n1)
    score: dict[str, float] = {}
    telling: set[str] = set()
    for units in (*toxic, *clean):
        for u in units:
            if u in score:
                continue
            best = -9.0
            for g in _grams(u):
                a, b = counts[g] >> 32, counts[g] & 0xFFFFFFFF
                best = max(best, math.log((a + 0.5) / n1 * n0 / (b + 0.5)))
                if a >= enough and b * n1 <= 0.02 * a * n0:
                    telling.add(u)
            score[u] = best
    return score, telling


def _without_copies(docs: list[list[list[str]]]) -> list[list[list[str]]]:
    """Drop near copies of earlier documents (6 minima of their longer words'
    hashes, 4 equal): statistics over copies would take any of their words
    for telling."""
    rng = np.random.default_rng(5)
    mul, add = rng.integers(1, 1 << 31, (2, 6, 1), dtype=np.uint64) | np.uint64(1)
    seen: dict[tuple[int, int], set[int]] = {}
    out = []
    for i, d in enumerate(docs):
        words = {u for s in d for u in s if len(u) >= 7}
        if words:
            crc = np.array([zlib.crc32(u.encode("utf-8", "surrogatepass"))
                            for u in words], np.uint64)
            mins = (((crc[None] * mul + add) >> np.uint64(11)) % np.uint64((1 << 31) - 1)).min(1)
            keys = list(enumerate(mins.tolist()))
            hits: dict[int, int] = {}
            for k in keys:
                for j in seen.get(k, ()):
                    hits[j] = hits.get(j, 0) + 1
            if max(hits.values(), default=0) >= 4:
                continue
            for k in keys:
                seen.setdefault(k, set()).add(i)
        out.append(d)
    return out


def _landmarks(units: list[str], counts: np.ndarray, most: int) -> list[str]:
    """Spread choice: the most frequent first, then what is least covered."""
    if len(units) <= most:
        return list(units)
    pool = np.argsort(-counts, kind="stable")[:400]
    names, weight = [units[i] for i in pool], np.sqrt(counts[pool])
    near = kernel(names, names)
    cover, picked = np.zeros(len(names)), []
    for _ in range(min(most, len(names))):
        i = int(np.argmax(weight * (1 - cover)))
        picked.append(names[i])
        cover = np.maximum(cover, near[:, i])
        cover[i] = 1
    return picked


def train(texts: list[str | None], labels: list[int], share: float | None = None,
          landmarks: int = LANDMARKS) -> Model:
    """Fit on labelled documents (a bounded list); ``share`` is that of toxic
    rows among all labels, where the list has another."""
    toxic = [t for t, y in zip(texts, labels) if y == 1]
    clean = [t for t, y in zip(texts, labels) if y != 1]
    base = Model(constant=len(toxic) / max(1, len(texts)), key="constant")
    if not toxic or not clean:
        return base
    memo: dict[str, list[str]] = {}

    def windows(u: str) -> list[str]:
        if u not in memo:
            memo[u] = [w for w in _windows(u) if len(w) > 4]
        return memo[u]

    def sentences(t: str | None) -> list[list[str]]:
        low = (t or "").lower()
        parts = [[w for u in s.split() for w in windows(u)] for s in _SENTENCE.split(low)]
        parts += [windows("".join(run.split())) for run in _APART.findall(low)]
        return [p for p in parts if p]

    tox = _without_copies([sentences(t) for t in toxic])
    cle = _without_copies([sentences(t) for t in clean])
    every = sorted({u for d in [*tox, *cle] for s in d for u in s})
    score, telling = _odds([{u for s in d for u in s} for d in tox],
                           [{u for s in d for u in s} for d in cle])
    model, neg, border = base, {}, 0.0
    for turn in range(4):
        def rank(u: str) -> tuple[float, str]:
            return score[u], u

        pos: dict[str, int] = {}
        for d in tox:
            found = {u for s in d for u in s if u in telling}
            if d and not found and (turn or not telling):
                best = max((u for s in d for u in s), key=rank)
                found = {best} if not turn or score[best] > border else found
            for u in found:
                pos[u] = pos.get(u, 0) + 1
        for d in cle:  # hard negatives of earlier turns stay
            for s in d:
                for u in {max(s, key=rank), s[0]} if turn == 0 else {max(s, key=rank)}:
                    neg[u] = neg.get(u, 0) + 1
        if not pos or not neg:
            return base
        # the sentences nearest to the border first, the rest in a fixed spread
        hard = sorted(neg, key=lambda u: (-score[u], u))
        names_n = hard[:2000] + hard[2000::max(1, len(hard) // 2000)]
        names_p = sorted(pos, key=lambda u: (-pos[u], u))
        names_p = sorted(names_p[:1500] + names_p[1500::max(1, len(names_p) // 1500)])
        marks = _landmarks(names_p, np.array([pos[u] for u in names_p], float), landmarks // 2)
        marks += _landmarks(names_n, np.array([neg[u] for u in names_n], float),
                            landmarks - landmarks // 2)
        marks = list(dict.fromkeys(marks))
        units = names_p + names_n
        kzz = kernel(marks, marks).astype(float)
        val, vec = np.linalg.eigh((kzz + kzz.T) / 2)
        root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-3))) @ vec.T
        y = np.array([1.0] * len(names_p) + [-1.0] * len(names_n))
        weight = np.array([np.sqrt(pos[u]) for u in names_p]
                          + [np.sqrt(neg[u]) for u in names_n])
        weight[:len(names_p)] *= weight[len(names_p):].sum() / weight[:len(names_p)].sum() / 2
        w, bias = _svm(kernel(units, marks) @ root, y, weight, reg=0.3)
        beta, table = root @ w, np.zeros(_TABLE)
        for at, ws, length in _by_length(marks):
            index, wt = _subsequences(ws, length)
            for j, row, own in zip(at, index, wt):
                np.add.at(table, row, beta[j] * own)
        model = Model(table=table.astype(np.float32), bias=bias, landmarks=marks)
        score = dict(zip(every, model.unit_margins(every).tolist()))
        tops = [max([_LOWEST, *(score[u] for s in d for u in s)]) for d in cle]
        border = max(0.0, float(np.quantile(tops, 0.995)))
    margins = np.array([max([_LOWEST, *(score[u] for s in d for u in s)]) for d in [*tox, *cle]])
    y = np.array([1.0] * len(tox) + [-1.0] * len(cle))
    share = min(max(len(tox) / len(y) if share is None else share, 0.01), 0.99)
    model.slope, model.shift = _calibrate(margins, y, share)
    model.key = hashlib.md5(model.table.tobytes() + repr(model.bias).encode()).hexdigest()
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", sample_toxic: int = SAMPLE_TOXIC,
        sample_clean: int = SAMPLE_CLEAN) -> Model:
    """Train on a bounded sample of the labelled rows that are not held out."""
    known = labels.select(F.col(doc_id).alias("id__"), F.col(label).cast("int").alias("y__")) \
        .filter(F.col("id__").isNotNull() & F.col("y__").isNotNull()
                & ~held_out(F.col("id__"))).distinct()
    picked = None
    for y, most in ((1, sample_toxic), (0, sample_clean)):
        part = known.filter((F.col("y__") == 1) if y else (F.col("y__") != 1)) \
            .orderBy(F.xxhash64("id__"), "id__").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select(F.col(doc_id).alias("id__"), F.col(text).alias("t__")) \
        .join(F.broadcast(picked), "id__")  # at most the two sample sizes
    share = known.agg(F.avg((F.col("y__") == 1).cast("double"))).first()[0]
    ship_package(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["id__"])])
        if len(f):
            f = f.sort_values(["id__", "t__", "y__"], kind="stable")
            model = train(f["t__"].tolist(), [int(y == 1) for y in f["y__"]], share)
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    # one task holds the sample, which is bounded, and returns the model
    got = rows.withColumn("t__", F.coalesce("t__", F.lit(""))).repartition(1) \
        .mapInPandas(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else Model(constant=0.0, key="constant")


# --- scoring -----------------------------------------------------------------------------

_cache: dict[str, tuple[dict[str, float], dict[str, float]]] = {}


def text_margins(model: Model, texts) -> list[float]:
    """Largest unit margin of each text.  Margins are kept per worker, by unit
    as written and by unit without edge marks; a full store starts anew."""
    if model.key not in _cache:
        _cache.clear()
        _cache[model.key] = ({}, {})
    known, plain = _cache[model.key]
    per = [set(units_of(t)) for t in texts]
    new = {u for us in per for u in us if u not in known}
    if len(known) + len(new) > _CACHE_UNITS:
        known.clear()
        new = {u for us in per for u in us}
    bare = {u: u.strip(_EDGES) for u in new}
    fresh_ones = sorted({b for b in bare.values() if b not in plain})
    if len(plain) + len(fresh_ones) > _CACHE_UNITS:
        plain.clear()
        fresh_ones = sorted(set(bare.values()))
    plain.update(zip(fresh_ones, model.unit_margins(fresh_ones).tolist()))
    known.update((u, plain[b]) for u, b in bare.items())
    return [max([_LOWEST, *map(known.__getitem__, us)]) for us in per]


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``: probability that the label is 1."""
    spark = docs.sparkSession
    name = fresh(docs, out)
    if model.constant is not None:
        return docs.withColumn(name, F.lit(float(model.constant)))
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def prob(texts: pd.Series) -> pd.Series:
        m = shared.value
        out = []
        for lo in range(0, len(texts), 256):
            out += text_margins(m, texts[lo:lo + 256])
        return pd.Series(m.probability(np.array(out, float)), dtype="float64")

    return docs.withColumn(name, prob(F.col(text)))


def keep_clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """Documents whose score is below the threshold, columns as they were."""
    name = fresh(docs, "score")
    model = fit(docs, labels, doc_id, text, label)
    return score(docs, model, text, name).filter(F.col(name) < threshold).drop(name)
