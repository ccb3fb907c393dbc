"""A character-level bidirectional LSTM with a CRF on top, in numpy.

``Tagger`` has the parameters; ``train`` fits them by Adam on labelled windows; ``decode`` gives
the best tag sequence of each window. Windows of one call have one length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, tuple]:
    """States (T, B, H) of inputs (T, B, E), and what the way back needs."""
    t, n, _ = x.shape
    h = u.shape[0]
    pre = x @ w + b
    state, cell = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
    out = np.empty((t, n, h), x.dtype)
    gates = np.empty((t, n, 4 * h), x.dtype)
    cells = np.empty((t + 1, n, h), x.dtype)
    cells[0] = 0
    for i in range(t):
        z = pre[i] + state @ u
        g = gates[i]
        g[:, : 3 * h] = _sigmoid(z[:, : 3 * h])
        g[:, 3 * h :] = np.tanh(z[:, 3 * h :])
        cell = g[:, h : 2 * h] * cell + g[:, :h] * g[:, 3 * h :]
        state = g[:, 2 * h : 3 * h] * np.tanh(cell)
        cells[i + 1] = cell
        out[i] = state
    return out, (x, gates, cells, out)


def _lstm_back(d_out: np.ndarray, kept: tuple, w: np.ndarray, u: np.ndarray) -> tuple:
    """Gradients by input, w, u and b."""
    x, gates, cells, out = kept
    t, n, h = out.shape
    d_pre = np.empty((t, n, 4 * h), x.dtype)
    d_state, d_cell = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
    for i in range(t - 1, -1, -1):
        g = gates[i]
        a, f, o, c = g[:, :h], g[:, h : 2 * h], g[:, 2 * h : 3 * h], g[:, 3 * h :]
        squashed = np.tanh(cells[i + 1])
        d_state = d_state + d_out[i]
        d_cell = d_cell + d_state * o * (1 - squashed**2)
        z = d_pre[i]
        z[:, :h] = d_cell * c * a * (1 - a)
        z[:, h : 2 * h] = d_cell * cells[i] * f * (1 - f)
        z[:, 2 * h : 3 * h] = d_state * squashed * o * (1 - o)
        z[:, 3 * h :] = d_cell * a * (1 - c**2)
        d_cell = d_cell * f
        d_state = z @ u.T
    before = np.concatenate([np.zeros((1, n, h), x.dtype), out[:-1]])
    flat = d_pre.reshape(-1, 4 * h)
    return (
        d_pre @ w.T,
        x.reshape(-1, x.shape[2]).T @ flat,
        before.reshape(-1, h).T @ flat,
        flat.sum(axis=0),
    )


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Parameters by name, and which tag may follow which."""

    p: dict[str, np.ndarray]
    allowed: np.ndarray
    starts: np.ndarray

    @classmethod
    def new(cls, symbols: int, tags: int, allowed: np.ndarray, starts: np.ndarray, embed: int = 10, hidden: int = 16, seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        p = {"embed": rng.normal(0, 0.5, (symbols, embed)).astype(np.float32)}
        for way in ("f", "b"):
            p[f"w{way}"], p[f"u{way}"] = draw(embed, 4 * hidden), draw(hidden, 4 * hidden)
            p[f"c{way}"] = np.zeros(4 * hidden, np.float32)
            p[f"c{way}"][hidden : 2 * hidden] = 1  # remember at first
        p["out"], p["bias"] = draw(2 * hidden, tags), np.zeros(tags, np.float32)
        p["move"] = np.zeros((tags, tags), np.float32)
        return cls(p, allowed, starts)

    def scores(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores (T, B, K) of symbols (B, T)."""
        p = self.p
        x = p["embed"][windows.T]
        ahead, kept_f = _lstm(x, p["wf"], p["uf"], p["cf"])
        back, kept_b = _lstm(np.ascontiguousarray(x[::-1]), p["wb"], p["ub"], p["cb"])
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return both @ p["out"] + p["bias"], (both, kept_f, kept_b)

    def moves(self) -> np.ndarray:
        return np.where(self.allowed, self.p["move"], np.float32(-1e4))

    def gradient(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags, and its gradient."""
        p, (n, t) = self.p, windows.shape
        emit, (both, kept_f, kept_b) = self.scores(windows)
        move = self.moves()
        begin = np.where(self.starts, 0, -1e4).astype(np.float32)
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[0] = begin + emit[0]
        for i in range(1, t):
            alpha[i] = _log_sum(alpha[i - 1][:, :, None] + move, 1) + emit[i]
        for i in range(t - 2, -1, -1):
            beta[i] = _log_sum(move + (emit[i + 1] + beta[i + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        at, row = np.arange(t)[:, None], np.arange(n)[None, :]
        gold = emit[at, row, tags.T].sum() + move[tags[:, :-1], tags[:, 1:]].sum()
        chance = np.exp(alpha + beta - total[:, None])
        pair = np.exp(
            alpha[:-1][:, :, :, None] + move + (emit[1:] + beta[1:])[:, :, None, :] - total[:, None, None]
        ).sum(axis=(0, 1))
        d_emit = chance
        d_emit[at, row, tags.T] -= 1
        d_emit = (d_emit / n).astype(np.float32)
        np.add.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1.0)
        g = {"move": np.where(self.allowed, pair / n, 0).astype(np.float32)}
        g["out"] = both.reshape(-1, both.shape[2]).T @ d_emit.reshape(-1, emit.shape[2])
        g["bias"] = d_emit.sum(axis=(0, 1))
        d_both = d_emit @ p["out"].T
        h = d_both.shape[2] // 2
        dx, g["wf"], g["uf"], g["cf"] = _lstm_back(d_both[:, :, :h], kept_f, p["wf"], p["uf"])
        db, g["wb"], g["ub"], g["cb"] = _lstm_back(d_both[::-1, :, h:], kept_b, p["wb"], p["ub"])
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], windows.T, dx + db[::-1])
        return float((total.sum() - gold) / n), g

    def train(self, windows: np.ndarray, tags: np.ndarray, steps: int = 300, batch: int = 32, rate: float = 0.02, seed: int = 5) -> float:
        """Adam over random batches; the last batches' mean loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        last: list[float] = []
        for step in range(1, steps + 1):
            at = rng.integers(0, len(windows), min(batch, len(windows)))
            loss, g = self.gradient(windows[at], tags[at])
            last.append(loss)
            size = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
            scale = min(1.0, 5.0 / max(size, 1e-9))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, v in g.items():
                m[k] = 0.9 * m[k] + 0.1 * scale * v
                s[k] = 0.999 * s[k] + 0.001 * (scale * v) ** 2
                self.p[k] = self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        return float(np.mean(last[-20:]))

    def decode(self, windows: np.ndarray) -> np.ndarray:
        """Best tags (B, T) by Viterbi."""
        emit, _ = self.scores(windows)
        t, n, _ = emit.shape
        move = self.moves()
        best = emit[0] + np.where(self.starts, 0, -1e4)
        came = np.empty(emit.shape, np.int8)
        for i in range(1, t):
            step = best[:, :, None] + move
            came[i] = step.argmax(axis=1)
            best = step.max(axis=1) + emit[i]
        out = np.empty((n, t), np.int8)
        out[:, -1] = best.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            out[:, i - 1] = came[i][np.arange(n), out[:, i]]
        return out
