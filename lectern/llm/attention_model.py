"""A causal self-attention model of slots in numpy: forward, gradient and Adam steps in buffers that are used again.

A slot is one of SLOTS classes of ids, put out in two steps: cluster (slot // SIDE) and place (slot % SIDE).
One attention layer, one hidden layer; a unit column beside the activations carries the biases.
"""

from __future__ import annotations

import numpy as np

SIDE = 32
SLOTS = SIDE * SIDE
WIDTH, HIDDEN, WINDOW = 24, 48, 32
#: Windows in memory at a time.
LOT = 128
#: Runs of rows that products over all rows of a lot are cut into.
PARTS = 8

SHAPES = {"E": (SLOTS, WIDTH), "P": (WINDOW, WIDTH), "QKV": (WIDTH, 3 * WIDTH), "O": (WIDTH, WIDTH), "W1": (WIDTH + 1, HIDDEN), "W2": (HIDDEN, WIDTH), "C": (WIDTH + 1, SIDE), "U": (SIDE, WIDTH + 1, SIDE)}
N_WEIGHTS = sum(int(np.prod(s)) for s in SHAPES.values())


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the weights by name."""
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k], at = flat[at : at + n].reshape(shape), at + n
    return out


def first_weights(slot_counts: np.ndarray) -> np.ndarray:
    """Random weights, with the biases of a unigram model of the slots."""
    random, p = np.random.Generator(np.random.PCG64(20240504)), {}
    for k, shape in SHAPES.items():
        p[k] = random.standard_normal(shape) * (0.1 if k in "EP" else (0.2 if k in ("C", "U", "O", "W2") else 1.0) / np.sqrt(WIDTH))
    share = (slot_counts + 1.0).reshape(SIDE, SIDE)
    p["W1"][-1], p["C"][-1] = 0, np.log(share.sum(1) / share.sum())
    p["U"][:, -1] = np.log(share / share.sum(1, keepdims=True))
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float32)


def crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b, summed over PARTS runs of rows: BLAS is slow where the inner dimension is long and the result small."""
    n = len(a) // PARTS * PARTS
    out = np.matmul(a[:n].reshape(PARTS, -1, a.shape[1]).transpose(0, 2, 1), b[:n].reshape(PARTS, -1, b.shape[1])).sum(0)
    if n < len(a):
        out += a[n:].T @ b[n:]
    return out


class Model:
    """The model under weights that may change, with buffers for LOT windows. Windows are rows of slots.

    Rows of width d + 1 are added whole: a unit column stays 1, as what is added to it is 0.
    """

    def __init__(self, flat: np.ndarray):
        d, n = WIDTH, LOT * WINDOW
        self.flat = flat.astype(np.float32)  # a copy: steps change it
        self.p = unpacked(self.flat)
        new = lambda *shape: np.zeros(shape, np.float32)
        self.embedded, self.table, self.embedded_places, self.places = new(SLOTS, d + 1), new(SLOTS, 3 * d + 1), new(WINDOW, d + 1), new(WINDOW, 3 * d + 1)
        self.embedded[:, d] = 1
        self.w2 = new(HIDDEN, d + 1)
        self.e, self.x, self.dx = new(n, d + 1), new(LOT, WINDOW, 3 * d + 1), new(LOT, WINDOW, 3 * d)
        self.a, self.da, self.turned = new(n, WINDOW), new(LOT, WINDOW, WINDOW), new(LOT, d, WINDOW)
        self.o, self.h, self.r, self.z = new(n, d + 1), new(n, d + 1), new(n, HIDDEN), new(n, d + 1)
        self.zs, self.lp, self.lc = new(n, d + 1), new(n, SIDE), new(n, SIDE)
        self.dz, self.dp, self.dh, self.dr, self.on = new(n + 1, d + 1), new(n, d + 1), new(n, d + 1), new(n, HIDDEN), new(n, HIDDEN)
        self.de, self.sorted_de, self.none = new(n, d), new(n, d), new(n, HIDDEN)
        self.rows, self.side, self.at = np.arange(n) * SIDE, np.arange(SIDE + 1), np.zeros(n, np.int64)
        self.past = np.tril(np.ones((WINDOW, WINDOW), np.float32))
        self.g, self.m, self.v, self.step = new(N_WEIGHTS), new(N_WEIGHTS), new(N_WEIGHTS), 0
        self.spare = new(N_WEIGHTS)
        self.gp = unpacked(self.g)
        self._tables()

    def _tables(self) -> None:
        """Queries, keys and values follow from slot and place alone: one row each, to be added. Values are put out at once, so that what attention gives needs no product with O."""
        d = WIDTH
        self.qkv = self.p["QKV"].copy()
        self.qkv[:, :d] *= np.float32(d**-0.5)
        self.qkv[:, 2 * d :] = self.p["QKV"][:, 2 * d :] @ self.p["O"]
        for embedded, table, weights in ((self.embedded, self.table, self.p["E"]), (self.embedded_places, self.places, self.p["P"])):
            embedded[:, :d] = weights
            np.matmul(weights, self.qkv, out=table[:, : 3 * d])
        self.w2[:, :d] = self.p["W2"]

    def _turned(self, x: np.ndarray) -> np.ndarray:
        """Each window's transpose, as a copy: with a view the product takes longer than copy and product."""
        out = self.turned[: len(x)]
        np.copyto(out, x.transpose(0, 2, 1))
        return out

    def _body(self, x: np.ndarray, safe: bool, first: int = 0) -> None:
        """Leaves what the head takes for the places from first on; those before it have keys and values only."""
        d, b, past = WIDTH, len(x), self.past[first:]
        n, kv = b * len(past), self.x[: len(x)]
        np.take(self.table, x, axis=0, out=kv, mode="clip")
        kv += self.places
        a, e, o, h, r, z = self.a[:n], self.e[:n], self.o[:n], self.h[:n], self.r[:n], self.z[:n]
        np.take(self.embedded, x[:, first:], axis=0, out=e.reshape(b, -1, d + 1), mode="clip")
        e.reshape(b, -1, d + 1)[:] += self.embedded_places[first:]
        by_window = a.reshape(b, -1, WINDOW)
        np.matmul(kv[:, first:, :d], self._turned(kv[..., d : 2 * d]), out=by_window)
        if safe:
            by_window -= np.where(past > 0, by_window, -np.inf).max(axis=2, keepdims=True)
            np.minimum(a, 0, out=a)
        np.exp(a, out=a)
        by_window *= past
        a *= (1 / (a @ self.past[-1]))[:, None]
        np.matmul(by_window, kv[..., 2 * d :], out=o.reshape(b, -1, d + 1))
        np.add(e, o, out=h)
        np.matmul(h, self.p["W1"], out=r)
        np.maximum(r, self.none[:n], out=r)  # with an array: with a number it takes three times as long
        np.matmul(r, self.w2, out=z)
        z += h

    def _head(self, order: np.ndarray, target: np.ndarray, safe: bool) -> tuple[np.ndarray, list[int]]:
        """Log probability of each target; order: its place, so that targets ascend. Leaves exp(logits), their sums and where the targets' are."""
        n = len(order)
        cluster = target // SIDE
        edges = np.searchsorted(cluster, self.side).tolist()
        zs, lp, lc = self.zs[:n], self.lp[:n], self.lc[:n]
        np.take(self.z, order, axis=0, out=zs, mode="clip")
        for c in range(SIDE):
            if edges[c] < edges[c + 1]:
                np.matmul(zs[edges[c] : edges[c + 1]], self.p["U"][c], out=lp[edges[c] : edges[c + 1]])
        np.matmul(zs, self.p["C"], out=lc)
        if safe:
            lp -= lp.max(axis=1, keepdims=True)
            lc -= lc.max(axis=1, keepdims=True)
        self.hits = self.rows[:n] + target % SIDE, self.rows[:n] + cluster
        out = lp.reshape(-1)[self.hits[0]] + lc.reshape(-1)[self.hits[1]]
        np.exp(lp, out=lp)
        np.exp(lc, out=lc)
        ones = self.past[-1]
        self.sums = lp @ ones, lc @ ones
        return out - np.log(self.sums[0]) - np.log(self.sums[1]), edges

    def log_probabilities(self, x: np.ndarray, at: np.ndarray, target: np.ndarray, first: int = 0) -> np.ndarray:
        """Natural log of the probability of each target slot. x: at most LOT windows; at: places in the flattened windows, all from a window's place first on."""
        order = np.argsort(target.astype(np.int16), kind="stable")
        at = at - first * (at // WINDOW + 1)
        out = np.empty(len(at), np.float32)
        for safe in (False, True):  # again below 1, if exp ran over
            with np.errstate(all="ignore"):
                self._body(x, safe, first)
                out[order] = self._head(at[order], target[order], safe)[0]
            if np.isfinite(out).all():
                break
        return out

    def add_gradient(self, x: np.ndarray, y: np.ndarray, total: int) -> None:
        """Adds the gradient of the negative log probabilities, over total. x: at most LOT windows; y: targets, -1 where there is none."""
        d, b = WIDTH, len(x)
        n, flat, p, g = b * WINDOW, y.ravel(), self.p, self.gp
        order = np.argsort(flat.astype(np.int16), kind="stable")
        order = order[len(order) - np.count_nonzero(flat >= 0) :]
        target = flat[order]
        for safe in (False, True):
            with np.errstate(all="ignore"):
                self._body(x, safe)
                found, edges = self._head(order, target, safe)
            if np.isfinite(found).all():
                break
        m = len(order)
        lp, lc, zs, dz, dp, dh, dr, on = self.lp[:m], self.lc[:m], self.zs[:m], self.dz[:m], self.dp[:m], self.dh[:n], self.dr[:n], self.on[:n]
        for logits, sums, hits in ((lp, self.sums[0], self.hits[0]), (lc, self.sums[1], self.hits[1])):
            logits *= (np.float32(1 / total) / sums)[:, None]
            logits.reshape(-1)[hits] -= np.float32(1 / total)
        g["C"] += crossed(zs, lc)
        np.matmul(lc, p["C"].T, out=dz)
        for c in range(SIDE):
            i, j = edges[c], edges[c + 1]
            if i < j:
                g["U"][c] += zs[i:j].T @ lp[i:j]
                np.matmul(lp[i:j], p["U"][c].T, out=dp[i:j])
        dz += dp
        # Row m of dz, which is 0, goes to the places without a target. The last column of dh is of a constant, and not used.
        self.dz[m], at = 0, self.at[:n]
        at[:] = m
        at[order] = np.arange(m)
        np.take(self.dz, at, axis=0, out=dh, mode="clip")
        a, o, h, r, kv, da, dx = self.a[:n].reshape(b, WINDOW, WINDOW), self.o[:n], self.h[:n], self.r[:n], self.x[:b], self.da[:b], self.dx[:b]
        g["W2"] += crossed(r, dh[:, :d])
        np.matmul(dh[:, :d], p["W2"].T, out=dr)
        np.copyto(on, r > 0)
        dr *= on
        g["W1"] += crossed(h, dr)
        dh += np.matmul(dr, p["W1"].T, out=self.z[:n])
        do = dh.reshape(b, WINDOW, d + 1)[..., :d]
        q, k, v = kv[..., :d], kv[..., d : 2 * d], kv[..., 2 * d : 3 * d]
        np.matmul(a.transpose(0, 2, 1), do, out=dx[..., 2 * d :])
        np.matmul(do, self._turned(v), out=da)
        da -= np.einsum("nd,nd->n", dh[:, :d], o[:, :d]).reshape(b, WINDOW, 1)
        da *= a
        np.matmul(da, k, out=dx[..., :d])
        np.matmul(da.transpose(0, 2, 1), q, out=dx[..., d : 2 * d])
        flat_dx, de = dx.reshape(n, 3 * d), self.de[:n]
        dqkv = crossed(self.e[:n, :d], flat_dx)
        dqkv[:, :d] *= np.float32(d**-0.5)
        g["O"] += p["QKV"][:, 2 * d :].T @ dqkv[:, 2 * d :]
        dqkv[:, 2 * d :] = dqkv[:, 2 * d :] @ p["O"].T
        g["QKV"] += dqkv
        np.matmul(flat_dx, self.qkv.T, out=de)
        de += dh[:, :d]
        g["P"] += de.reshape(b, WINDOW, d).sum(0)
        order = np.argsort(x.ravel().astype(np.int16), kind="stable")
        rows, many = self.sorted_de[:n], np.bincount(x.ravel(), minlength=SLOTS)
        np.take(de, order, axis=0, out=rows, mode="clip")
        slots = np.flatnonzero(many)
        g["E"][slots] += np.add.reduceat(rows, (np.cumsum(many) - many)[slots], axis=0)

    def train(self, windows: np.ndarray, rate: float) -> None:
        """A step of Adam on all the windows: rows of WINDOW + 1 slots, -1 behind their end."""
        w = windows.astype(np.int64)
        total = int(np.count_nonzero(w[:, 1:] >= 0))
        if not total:
            return
        self.g[:] = 0
        for i in range(0, len(w), LOT):
            self.add_gradient(np.maximum(w[i : i + LOT, :-1], 0), w[i : i + LOT, 1:], total)
        self.step += 1
        g, m, v, t = self.g, self.m, self.v, self.spare  # m: 10 times the first moment, v: 100 times the second
        m *= np.float32(0.9)
        m += g
        np.multiply(g, g, out=t)
        v *= np.float32(0.99)
        v += t
        np.sqrt(v, out=t)
        scale = 0.1 * (1 - 0.99**self.step) ** -0.5
        t += np.float32(1e-7 / scale)
        np.divide(m, t, out=t)
        t *= np.float32(0.1 * rate / (1 - 0.9**self.step) / scale)
        self.flat -= t
        self._tables()
