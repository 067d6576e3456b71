"""Bidirectional LSTM over block sequences, in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    """Labels every row of a sequence from the whole sequence."""

    def __init__(self, dims: int, hidden: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.08, (dims, 4 * hidden)).astype(np.float32)
            self.p["h" + d] = rng.normal(0, 0.1, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p["b" + d] = bias
        self.p["o"] = rng.normal(0, 0.1, (2 * hidden, 1)).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """x: (batch, time, dims); padded steps leave the state as it is."""
        n, t, _ = x.shape
        k = self.h
        z = x @ self.p["x" + d] + self.p["b" + d]
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        out = np.zeros((n, t, k), np.float32)
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            g = z[:, s] + h @ self.p["h" + d]
            gates = _sigmoid(g[:, :3 * k])
            i, f, o = gates[:, :k], gates[:, k:2 * k], gates[:, 2 * k:]
            u = np.tanh(g[:, 3 * k:])
            m = mask[:, s, None]
            c2 = np.where(m, f * c + i * u, c)
            tc = np.tanh(c2)
            h2 = np.where(m, o * tc, h)
            if keep is not None:
                keep.append((s, h, c, i, f, o, u, tc, m))
            h, c = h2, c2
            out[:, s] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kf, kb = ([], []) if keep is not None else (None, None)
        both = np.concatenate([self._run(x, mask, "f", kf), self._run(x, mask, "b", kb)], 2)
        if keep is not None:
            keep.update(f=kf, b=kb, both=both)
        return (both @ self.p["o"])[..., 0] + self.p["c"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        keep: dict = {}
        p = _sigmoid(self.logits(x, mask, keep))
        dz = np.where(mask, p - y, 0)[..., None] / max(1, mask.sum())
        g = {"o": (keep["both"] * dz).sum((0, 1))[:, None], "c": dz.sum((0, 1))}
        dboth, k = dz @ self.p["o"].T, self.h
        for d, part in (("f", dboth[..., :k]), ("b", dboth[..., k:])):
            wh, dh, dc = self.p["h" + d], 0, 0
            dgs = np.zeros((*x.shape[:2], 4 * k), np.float32)
            gh = np.zeros_like(wh)
            for s, h, c, i, f, o, u, tc, m in reversed(keep[d]):
                dh = dh + part[:, s]
                do, dct = dh * tc, dc + dh * o * (1 - tc ** 2)
                dg = np.concatenate([dct * u * i * (1 - i), dct * c * f * (1 - f),
                                     do * o * (1 - o), dct * i * (1 - u ** 2)], 1) * m
                gh += h.T @ dg
                dgs[:, s] = dg
                dh = np.where(m, dg @ wh.T, dh)
                dc = np.where(m, dct * f, dc)
            g["h" + d] = gh
            g["x" + d] = np.einsum("nti,ntj->ij", x, dgs)
            g["b" + d] = dgs.sum((0, 1))
        return g

    def fit(self, seqs: list[np.ndarray], labels: list[np.ndarray], rounds: int = 12,
            batch: int = 24, rate: float = 4e-3, seed: int = 11) -> None:
        """Adam over batches of sequences of similar length."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        order = np.argsort([len(s) for s in seqs], kind="stable")
        parts = [order[a:a + batch] for a in range(0, len(order), batch)]
        step = 0
        for r in range(rounds):
            for k in rng.permutation(len(parts)):
                x, mask = pad([seqs[i] for i in parts[k]])
                y = np.zeros(mask.shape, np.float32)
                for row, i in enumerate(parts[k]):
                    y[row, :len(labels[i])] = labels[i]
                step += 1
                lr = rate * (0.3 if r >= rounds * 2 // 3 else 1)
                for name, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.995 * v[name] + 0.005 * g * g
                    self.p[name] = (self.p[name] - lr * (m[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(v[name] / (1 - 0.995 ** step)) + 1e-7)).astype(np.float32)

    def predict(self, seqs: list[np.ndarray], cells: int = 4096) -> list[np.ndarray]:
        """Probability of every row of every sequence; batches are bounded by
        ``cells`` rows with padding (a longer sequence is a batch alone)."""
        out: list[np.ndarray] = [np.zeros(0)] * len(seqs)
        order = sorted((i for i in range(len(seqs)) if len(seqs[i])),
                       key=lambda i: len(seqs[i]))
        at = 0
        while at < len(order):
            n = 1
            while at + n < len(order) and (n + 1) * len(seqs[order[at + n]]) <= cells:
                n += 1
            part = order[at:at + n]
            x, mask = pad([seqs[i] for i in part])
            p = _sigmoid(self.logits(x, mask))
            for row, i in enumerate(part):
                out[i] = p[row, :len(seqs[i])]
            at += n
        return out


def pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(s) for s in seqs)
    x = np.zeros((len(seqs), t, seqs[0].shape[1]), np.float32)
    mask = np.zeros((len(seqs), t), bool)
    for i, s in enumerate(seqs):
        x[i, :len(s)] = s
        mask[i, :len(s)] = True
    return x, mask
