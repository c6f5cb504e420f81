"""A character-level bidirectional LSTM with CRF transitions: training and decoding in numpy, emissions by onnxruntime."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

from tidemark.llm.onnx import lstm_emissions

#: Character classes: padding, white space, digit, capital, other letters and signs beyond ASCII, then a-z and signs.
PAD, SPACE, DIGIT, CAPITAL, BEYOND = range(5)
_OWN = [c for c in map(chr, range(33, 127)) if not c.isdigit() and not c.isupper()]
CLASSES, AT = 5 + len(_OWN), 5 + _OWN.index("@")
#: Windows whose emissions are computed together, and by `scores`.
BLOCK, TILE = 1024, 512


def _class_table() -> np.ndarray:
    table = np.full(256, BEYOND, np.int64)
    table[[9, 10, 11, 12, 13, 32, 133, 160]] = SPACE
    table[48:58], table[65:91] = DIGIT, CAPITAL
    for i, c in enumerate(_OWN):
        table[ord(c)] = 5 + i
    return table


_TABLE = _class_table()


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _TABLE[np.minimum(points, 255)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


@dataclass
class Tagger:
    """`p` holds the weights: embedding E, for each direction input W, recurrence U and bias b, projection P and c,
    transitions T and first labels s."""

    p: dict[str, np.ndarray]
    #: What computes emissions with these weights; made by the process that asks, not pickled.
    _graph: Callable[[np.ndarray], np.ndarray] | None = field(default=None, init=False, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"p": self.p, "_graph": None}

    @staticmethod
    def new(labels: int, width: int = 16, embedding: int = 12, seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return (r.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

        b = np.zeros((2, 1, 4 * width), np.float32)
        b[:, :, width : 2 * width] = 1.0  # remember at first
        zero = np.zeros(labels, np.float32)
        return Tagger({
            "E": draw(CLASSES, embedding), "W": draw(2, embedding, 4 * width), "U": draw(2, width, 4 * width), "b": b,
            "P": draw(2 * width, labels), "c": zero.copy(), "T": np.zeros((labels, labels), np.float32), "s": zero.copy(),
        })

    def _run(self, x: np.ndarray) -> tuple:
        """States of both directions over windows `x` (window, place); the second direction reads from the end."""
        p, (n, steps) = self.p, x.shape
        width = p["U"].shape[1]
        given = p["E"] @ p["W"] + p["b"]  # direction, class, gates
        both = np.stack((x, x[:, ::-1]))
        h, c = np.zeros((2, n, width), np.float32), np.zeros((2, n, width), np.float32)
        kept = []
        for t in range(steps):
            z = np.stack((given[0][both[0, :, t]], given[1][both[1, :, t]])) + h @ p["U"]
            i, f, o = (_sigmoid(z[..., k * width : (k + 1) * width]) for k in (0, 1, 3))
            g = np.tanh(z[..., 2 * width : 3 * width])
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            kept.append((i, f, g, o, before_h, before_c, tc, h))
        forth = np.stack([k[7][0] for k in kept], 1)
        back = np.stack([k[7][1] for k in reversed(kept)], 1)
        return both, kept, np.concatenate((forth, back), 2)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """The labels' scores (window, place, label) over windows `x`: those of `_run`'s states, which are not kept."""
        parts = [self.block(x[i : i + BLOCK]) for i in range(0, len(x), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, x.shape[1], len(self.p["c"])), self.p["c"].dtype)

    def block(self, x: np.ndarray) -> np.ndarray:
        """The emissions of one to BLOCK windows as (window, place, label), by `scores` where onnxruntime is missing."""
        if self._graph is None:
            self._graph = lstm_emissions(self.p) or self._scores_by_window
        return self._graph(x)

    def _scores_by_window(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.scores(x[i : i + TILE]).transpose(2, 0, 1) for i in range(0, len(x), TILE)])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The emissions of at most TILE windows as (place, label, window).

        Places of all windows lie side by side, class, state and bias make one product for each gate, and these
        stay so small that no library wakes a thread for each core.
        """
        p, (n, steps) = self.p, x.shape
        embedding, width = p["W"].shape[1], p["U"].shape[1]
        m = np.concatenate((p["W"], p["U"], p["b"]), 1).reshape(2, -1, 4, width)[:, :, [3, 0, 1, 2]].transpose(0, 2, 3, 1)
        # a sigmoid is half of 1 and a tanh of half; states are held twice as large, their weights are half as large
        one, half = p["E"].dtype.type(1), p["E"].dtype.type(0.5)
        m = m * np.array([0.5, 0.5, 0.5, 1], m.dtype)[:, None, None]
        m[..., embedding:-1] *= half
        m = m.reshape(2, 4, width, -1)
        out = np.ascontiguousarray(p["P"].reshape(2, width, -1).transpose(0, 2, 1)) * half
        classes, x = np.ascontiguousarray(p["E"].T), np.ascontiguousarray(x.T)
        given = np.ones((2, 1, embedding + width + 1, n), m.dtype)
        forth, back, h = given[0, 0, :embedding], given[1, 0, :embedding], given[:, 0, embedding:-1]
        h[:] = 0
        # the gates o, i, f, then g and c, so that i and f meet g and c in one product
        z, pair = np.zeros((2, 5, width, n), m.dtype), np.empty((2, 2, width, n), m.dtype)
        active, gates, o, both, with_, c = z[:, :4], z[:, :3], z[:, 0], z[:, 1:3], z[:, 3:], z[:, 4]
        new, old = pair[:, 0], pair[:, 1]
        e = np.empty((steps, 2, out.shape[1], n), m.dtype)  # at each step those of its place and of its place from the end
        for t in range(steps):
            classes.take(x[t], axis=1, out=forth, mode="clip")
            classes.take(x[steps - 1 - t], axis=1, out=back, mode="clip")
            np.matmul(m, given, out=active)
            np.tanh(active, out=active)
            np.add(gates, one, out=gates)
            np.multiply(both, with_, out=pair)
            np.add(new, old, out=c)
            np.multiply(c, half, out=c)
            np.tanh(c, out=new)
            np.multiply(o, new, out=h)
            np.matmul(out, h, out=e[t])
        total = e[:, 0] + e[::-1, 1]
        total += p["c"][:, None]
        return total

    def limits(self) -> tuple[float, float]:
        """How far the first label must lead at a place for the likeliest path to hold it there whatever its neighbours
        are, and how far it must lead at each place of a stretch for no path that leaves it there to be the likeliest.

        The first compares the transitions into and out of any other label with those of the first label; the second
        those of a whole stay away with those of staying.
        """
        T, s = self.p["T"].astype(np.float64), self.p["s"].astype(np.float64)
        enter = np.maximum((T[:, 1:] - T[:, :1]).max(0), s[1:] - s[0])
        leave = np.maximum((T[1:] - T[:1]).max(1), 0)
        away = max((T[0, 1:] - T[0, 0]).max(), (s[1:] - s[0]).max()) + max((T[1:, 0] - T[0, 0]).max(), 0)
        return float((enter + leave).max()) + 1e-3, max(0.0, float(T[1:, 1:].max() - T[0, 0])) + max(0.0, away) + 1e-3

    def _forward(self, e: np.ndarray) -> np.ndarray:
        a = np.empty_like(e)
        a[:, 0] = e[:, 0] + self.p["s"]
        for t in range(1, e.shape[1]):
            a[:, t] = _log_sum(a[:, t - 1, :, None] + self.p["T"], 1) + e[:, t]
        return a

    def _backward(self, e: np.ndarray) -> np.ndarray:
        b = np.zeros_like(e)
        for t in range(e.shape[1] - 2, -1, -1):
            b[:, t] = _log_sum(self.p["T"] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        return b

    def marginals(self, e: np.ndarray) -> np.ndarray:
        """The probability of each label at each place, given emissions (sequence, place, label)."""
        m = self._forward(e) + self._backward(e)
        return np.exp(m - _log_sum(m, 2)[..., None])

    def best_path(self, e: np.ndarray) -> np.ndarray:
        """The likeliest labels (Viterbi)."""
        n, steps, _ = e.shape
        score, back = e[:, 0] + self.p["s"], np.zeros(e.shape, np.int8)
        for t in range(1, steps):
            to = score[:, :, None] + self.p["T"]
            back[:, t] = to.argmax(1)
            score = to.max(1) + e[:, t]
        path = np.zeros((n, steps), np.int64)
        path[:, -1] = score.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the labels `y` and its gradient."""
        p, (n, steps) = self.p, x.shape
        width, rows = p["U"].shape[1], np.arange(n)
        both, kept, states = self._run(x)
        e = states @ p["P"] + p["c"]
        a, b = self._forward(e), self._backward(e)
        log_z = _log_sum(a[:, -1], 1)
        gold = e[rows[:, None], np.arange(steps), y].sum(1) + p["s"][y[:, 0]] + p["T"][y[:, :-1], y[:, 1:]].sum(1)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        m = np.exp(a + b - log_z[:, None, None])
        g["s"] = m[:, 0].sum(0)
        np.subtract.at(g["s"], y[:, 0], 1)
        for t in range(1, steps):
            pair = a[:, t - 1, :, None] + p["T"] + (e[:, t] + b[:, t])[:, None, :] - log_z[:, None, None]
            g["T"] += np.exp(pair).sum(0)
        np.subtract.at(g["T"], (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        m[rows[:, None], np.arange(steps), y] -= 1
        g["P"], g["c"] = (states.transpose(0, 2, 1) @ m).sum(0), m.sum((0, 1))
        ds = m @ p["P"].T
        ds = np.stack((ds[..., :width], ds[:, ::-1, width:]))
        dh, dc = np.zeros((2, n, width), np.float32), np.zeros((2, n, width), np.float32)
        dzs: list[np.ndarray] = []
        for t in range(steps - 1, -1, -1):
            i, f, gg, o, before_h, before_c, tc, _ = kept[t]
            dh = dh + ds[:, :, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * gg * i * (1 - i), dc * before_c * f * (1 - f), dc * i * (1 - gg * gg), dh * tc * o * (1 - o)), 2)
            g["U"] += before_h.transpose(0, 2, 1) @ dz
            dzs.append(dz)
            dh, dc = dz @ p["U"].transpose(0, 2, 1), dc * f
        # small products and sums by class: a large product would wake a thread for each core
        given, dzs = np.zeros((2, CLASSES, 4 * width), ds.dtype), np.stack(dzs, 1).reshape(2, steps * n, 4 * width)
        for d in (0, 1):
            seen = both[d].T[::-1].ravel()
            order = np.argsort(seen, kind="stable")
            first = np.flatnonzero(np.diff(seen[order], prepend=-1))
            given[d, seen[order[first]]] = np.add.reduceat(dzs[d][order], first)
        g["W"], g["b"] = p["E"].T @ given, given.sum(1, keepdims=True)
        g["E"] = (given @ p["W"].transpose(0, 2, 1)).sum(0)
        return float((log_z - gold).mean()), {k: v / n for k, v in g.items()}

    def train(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int = 64, rate: float = 0.02, seed: int = 7) -> float:
        """Adam over shuffled batches with a rate that falls to nothing; returns the last loss."""
        r, first, second, loss = np.random.default_rng(seed), {}, {}, 0.0
        for step in range(1, steps + 1):
            pick = r.integers(0, len(x), batch)
            loss, grads = self.loss(x[pick], y[pick])
            norm = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
            for k, v in grads.items():
                v = v * min(1.0, 5.0 / (norm + 1e-9))
                first[k] = 0.9 * first.get(k, 0) + 0.1 * v
                second[k] = 0.99 * second.get(k, 0) + 0.01 * v * v
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                self.p[k] = (self.p[k] - rate * (1 - (step - 1) / steps) * move).astype(np.float32)
        self._graph = None
        return loss
