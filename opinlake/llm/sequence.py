"""A small bidirectional LSTM for labelling the lines of a page, in numpy (training on the driver, batch inference in tasks)."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    """Line vectors (summed hashed-word embeddings and shape features) -> probability of a label per line."""

    def __init__(self, buckets: int, emb: int, shape: int, hidden: int, seed: int = 7):
        r = np.random.default_rng(seed)
        d = emb + shape
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden, self.emb_dim = hidden, emb
        self.p = {"E": (r.standard_normal((buckets, emb)) * 0.1).astype(np.float32)}
        for k in ("f", "b"):
            self.p[f"Wx{k}"], self.p[f"Wh{k}"] = f(d, 4 * hidden), f(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, dtype=np.float32)
            bias[hidden:2 * hidden] = 1.0
            self.p[f"b{k}"] = bias
        self.p["Wo"], self.p["bo"] = f(2 * hidden + d, 1)[:, 0], np.zeros(1, dtype=np.float32)

    def vectors(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """One vector per line from the flat hashed-word ids."""
        n = len(counts)
        e = np.zeros((n, self.emb_dim), dtype=np.float32)
        some = counts > 0
        if some.any():
            for a in range(0, n, 20000):  # bounds the gathered rows
                sel = np.flatnonzero(some[a:a + 20000]) + a
                if len(sel):
                    lo, hi = starts[sel[0]], starts[sel[-1]] + counts[sel[-1]]
                    e[sel] = np.add.reduceat(self.p["E"][ids[lo:hi]], starts[sel] - lo, axis=0) / np.sqrt(counts[sel])[:, None]
        return np.concatenate([e, shape], axis=1)

    def _run(self, X: np.ndarray, k: str, keep: bool):
        n, t, _ = X.shape
        H = self.hidden
        Z = X.reshape(n * t, -1) @ self.p[f"Wx{k}"] + self.p[f"b{k}"]
        Z = Z.reshape(n, t, 4 * H)
        h, c = np.zeros((n, H), np.float32), np.zeros((n, H), np.float32)
        out = np.empty((n, t, H), np.float32)
        saved = []
        Wh = self.p[f"Wh{k}"]
        for s in range(t):
            z = Z[:, s] + h @ Wh
            g = np.tanh(z[:, 3 * H:])
            i, f, o = (a for a in np.split(_sigmoid(z[:, :3 * H]), 3, axis=1))
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            h_new = o * tc
            if keep:
                saved.append((h, c, i, f, o, g, tc))
            h, c = h_new, c_new
            out[:, s] = h
        return out, saved

    @staticmethod
    def _flip(X: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        t = X.shape[1]
        at = np.arange(t)[None, :]
        idx = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
        return X[np.arange(len(X))[:, None], idx]

    def logits(self, X: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        hf, _ = self._run(X, "f", False)
        hb, _ = self._run(self._flip(X, lengths), "b", False)
        hb = self._flip(hb, lengths)
        return np.concatenate([hf, hb, X], axis=2) @ self.p["Wo"] + self.p["bo"]

    def predict(self, ids, starts, counts, shape, page_lengths: np.ndarray) -> np.ndarray:
        """Probabilities of all lines of all pages, in order."""
        V = self.vectors(ids, starts, counts, shape)
        first = np.concatenate([[0], np.cumsum(page_lengths)[:-1]]).astype(np.int64)
        out = np.zeros(len(V), dtype=np.float32)
        order = np.argsort(page_lengths, kind="stable")
        order = order[page_lengths[order] > 0]
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and b - a < 512 and (b - a + 1) * page_lengths[order[b]] <= 16384:
                b += 1
            pages = order[a:b]
            ln = page_lengths[pages]
            t = int(ln.max())
            at = np.arange(t)[None, :]
            real = at < ln[:, None]
            idx = np.where(real, first[pages][:, None] + at, 0)
            X = V[idx] * real[:, :, None]
            p = _sigmoid(self.logits(X.astype(np.float32), ln))
            out[idx[real]] = p[real]
            a = b
        return out

    def train(self, pages: list[tuple], epochs: int, lr: float = 0.004, batch: int = 48, seed: int = 3, l2: float = 1e-5) -> None:
        """pages: (ids, starts, counts, shape, labels, weights) each; Adam on the weighted logistic loss."""
        r = np.random.default_rng(seed)
        if not hasattr(self, "_m"):
            self._m = {k: np.zeros_like(v) for k, v in self.p.items()}
            self._v = {k: np.zeros_like(v) for k, v in self.p.items()}
            self._t = 0
        for epoch in range(epochs):
            order = np.argsort(np.array([len(p[2]) for p in pages]) + r.random(len(pages)) * 6)
            chunks = [order[a:a + batch] for a in range(0, len(order), batch)]
            r.shuffle(chunks)
            rate = lr * (1.0 - 0.8 * epoch / max(1, epochs))
            for ch in chunks:
                self._step([pages[i] for i in ch], rate, l2)

    def _step(self, pages, lr, l2):
        ln = np.array([len(p[2]) for p in pages])
        n, t = len(pages), int(ln.max())
        d = self.emb_dim + pages[0][3].shape[1]
        X, y, w = np.zeros((n, t, d), np.float32), np.zeros((n, t), np.float32), np.zeros((n, t), np.float32)
        rows, coef, where = [], [], []
        for j, (ids, starts, counts, shape, lab, wt) in enumerate(pages):
            X[j, :ln[j]] = self.vectors(ids, starts, counts, shape)
            y[j, :ln[j]], w[j, :ln[j]] = lab, wt
            line = np.repeat(np.arange(ln[j]), counts)
            rows.append(ids)
            coef.append(1.0 / np.sqrt(counts[line]))
            where.append(j * t + line)
        hf, sf = self._run(X, "f", True)
        Xr = self._flip(X, ln)
        hb_r, sb = self._run(Xr, "b", True)
        hb = self._flip(hb_r, ln)
        A = np.concatenate([hf, hb, X], axis=2)
        p = _sigmoid(A @ self.p["Wo"] + self.p["bo"])
        dl = (p - y) * w / max(1.0, w.sum())
        g = {"Wo": np.einsum("nta,nt->a", A, dl), "bo": np.array([dl.sum()], np.float32)}
        dA = dl[:, :, None] * self.p["Wo"]
        H = self.hidden
        dX = dA[:, :, 2 * H:].copy()
        g["Wxf"], g["Whf"], g["bf"], dxf = self._back(X, sf, dA[:, :, :H], "f")
        g["Wxb"], g["Whb"], g["bb"], dxb = self._back(Xr, sb, self._flip(dA[:, :, H:2 * H], ln), "b")
        dX += dxf + self._flip(dxb, ln)
        dE = np.zeros_like(self.p["E"])
        dxe = dX[:, :, :self.emb_dim].reshape(n * t, -1)
        np.add.at(dE, np.concatenate(rows), dxe[np.concatenate(where)] * np.concatenate(coef)[:, None].astype(np.float32))
        g["E"] = dE
        self._t += 1
        for k, v in g.items():
            v = np.clip(v, -1, 1) + l2 * self.p[k]
            self._m[k] = 0.9 * self._m[k] + 0.1 * v
            self._v[k] = 0.99 * self._v[k] + 0.01 * v * v
            self.p[k] -= (lr * (self._m[k] / (1 - 0.9**self._t)) / (np.sqrt(self._v[k] / (1 - 0.99**self._t)) + 1e-7)).astype(np.float32)

    def _back(self, X, saved, dH, k):
        n, t, d = X.shape
        H = self.hidden
        Wh = self.p[f"Wh{k}"]
        dZ = np.zeros((n, t, 4 * H), np.float32)
        dh, dc = np.zeros((n, H), np.float32), np.zeros((n, H), np.float32)
        gWh = np.zeros_like(Wh)
        for s in range(t - 1, -1, -1):
            h0, c0, i, f, o, g, tc = saved[s]
            dh = dh + dH[:, s]
            do = dh * tc * o * (1 - o)
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), do, dc * i * (1 - g * g)], axis=1)
            dZ[:, s] = dz
            gWh += h0.T @ dz
            dh = dz @ Wh.T
            dc = dc * f
        flat = dZ.reshape(n * t, -1)
        return X.reshape(n * t, d).T @ flat, gWh, flat.sum(axis=0), (flat @ self.p[f"Wx{k}"].T).reshape(n, t, d)

    def frozen(self) -> BiLSTM:
        """The parameters alone, for sending."""
        out = object.__new__(BiLSTM)
        out.hidden, out.emb_dim, out.p = self.hidden, self.emb_dim, self.p
        return out
