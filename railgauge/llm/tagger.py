"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SYMBOLS = 130  # 0: padding, 1 to 128: ASCII, 129: all other characters
EMBED, HIDDEN = 12, 16
Weights = dict[str, np.ndarray]


def encode(text: str) -> np.ndarray:
    """Symbol numbers of a text's code points."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.where(points < 128, points + 1, SYMBOLS - 1).astype(np.int64)


def initial(tags: int, seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)

    def small(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    weights = {"embed": small(SYMBOLS, EMBED) * 3, "out": small(2 * HIDDEN, tags), "out_bias": np.zeros(tags, np.float32)}
    for side in ("f", "b"):
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        weights |= {f"{side}_in": small(EMBED, 4 * HIDDEN), f"{side}_rec": small(HIDDEN, 4 * HIDDEN), f"{side}_bias": bias}
    return weights | {"move": np.zeros((tags, tags), np.float32), "begin": np.zeros(tags, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, live: np.ndarray, w: Weights, side: str, keep: bool):
    """Hidden states (T, B, H) of one direction over x (T, B, E); where live is 0 the state stays 0."""
    steps, batch, _ = x.shape
    entered = x @ w[f"{side}_in"] + w[f"{side}_bias"]
    h = c = np.zeros((batch, HIDDEN), np.float32)
    states, saved = np.empty((steps, batch, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = entered[t] + h @ w[f"{side}_rec"]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, last = c, h
        c = (f * c + i * g) * live[t][:, None]
        squashed = np.tanh(c)
        h = o * squashed
        states[t] = h
        if keep:
            saved.append((t, i, f, o, g, before, last, squashed))
    return states, saved


def emissions(symbols: np.ndarray, w: Weights) -> np.ndarray:
    """Tag scores (B, T, tags) of symbol windows (B, T)."""
    x, live = w["embed"][symbols.T], (symbols.T > 0).astype(np.float32)
    both = np.concatenate([_run(x, live, w, side, False)[0] for side in ("f", "b")], axis=2)
    return (both @ w["out"] + w["out_bias"]).transpose(1, 0, 2)


def _spread(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return (np.log(np.exp(scores - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def loss_and_gradient(symbols: np.ndarray, tags: np.ndarray, w: Weights) -> tuple[float, Weights]:
    """Mean negative log-likelihood of the tags (B, T) under the CRF, and its gradient."""
    x, live = w["embed"][symbols.T], (symbols.T > 0).astype(np.float32)
    runs = {side: _run(x, live, w, side, True) for side in ("f", "b")}
    both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
    score = both @ w["out"] + w["out_bias"]
    steps, batch, kinds = score.shape
    gold = np.eye(kinds, dtype=np.float32)[tags.T]
    forward, backward = np.empty_like(score), np.zeros_like(score)
    forward[0] = w["begin"] + score[0]
    for t in range(1, steps):
        step = _spread(forward[t - 1][:, :, None] + w["move"], 1) + score[t]
        forward[t] = np.where(live[t][:, None] > 0, step, forward[t - 1])
    total = _spread(forward[-1], 1)
    gradient = {k: np.zeros_like(v) for k, v in w.items()}
    pull = np.zeros_like(score)
    for t in range(steps - 1, -1, -1):
        on = live[t][:, None]
        pull[t] = (np.exp(forward[t] + backward[t] - total[:, None]) - gold[t]) * on
        if t:
            onward = score[t] + backward[t]
            pair = forward[t - 1][:, :, None] + w["move"] + onward[:, None, :] - total[:, None, None]
            truth = gold[t - 1][:, :, None] * gold[t][:, None, :]
            gradient["move"] += ((np.exp(pair) - truth) * on[:, :, None]).sum(0)
            backward[t - 1] = np.where(on > 0, _spread(w["move"] + onward[:, None, :], 2), backward[t])
    gradient["begin"] = pull[0].sum(0)
    path = (score * gold).sum(2) * live
    moved = w["move"][tags[:, :-1], tags[:, 1:]].T * live[1:]
    loss = float((total - path.sum(0) - moved.sum(0) - w["begin"][tags[:, 0]]).mean())

    gradient["out"] = np.einsum("tbh,tbk->hk", both, pull)
    gradient["out_bias"] = pull.sum((0, 1))
    to_states = pull @ w["out"].T
    to_x = np.zeros_like(x)
    for n, side in enumerate(("f", "b")):
        dh = dc = np.zeros((batch, HIDDEN), np.float32)
        for t, i, f, o, g, before, last, squashed in reversed(runs[side][1]):
            dh = dh + to_states[t][:, n * HIDDEN : (n + 1) * HIDDEN]
            dc = (dc + dh * o * (1 - squashed**2)) * live[t][:, None]
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1
            )
            gradient[f"{side}_in"] += x[t].T @ dz
            gradient[f"{side}_rec"] += last.T @ dz
            gradient[f"{side}_bias"] += dz.sum(0)
            to_x[t] += dz @ w[f"{side}_in"].T
            dh, dc = dz @ w[f"{side}_rec"].T, dc * f
    np.add.at(gradient["embed"], symbols.T, to_x)
    return loss, {k: v / batch for k, v in gradient.items()}


def train(windows: list[np.ndarray], tags: list[np.ndarray], kinds: int, epochs: int = 8, batch: int = 64, rate: float = 0.02) -> Weights:
    """Weights fitted to windows of symbols and their tags by Adam; the order of the windows matters, chance does not."""
    w = initial(kinds)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    rng, step = np.random.default_rng(3), 0
    width = max((len(x) for x in windows), default=0)
    symbols, targets = (np.zeros((len(windows), width), np.int64) for _ in range(2))
    for n, (x, y) in enumerate(zip(windows, tags, strict=True)):
        symbols[n, : len(x)], targets[n, : len(y)] = x, y
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            _, gradient = loss_and_gradient(symbols[some], targets[some], w)
            norm = np.sqrt(sum(float(np.square(g).sum()) for g in gradient.values()))
            step += 1
            for k in w:
                g = gradient[k] / max(1.0, norm / 5)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                size = rate * (1 - epoch / epochs) / (1 - 0.9**step) * np.sqrt(1 - 0.99**step)
                w[k] = (w[k] - size * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32)
    return w


def best_tags(score: np.ndarray, lengths: np.ndarray, w: Weights) -> np.ndarray:
    """The likeliest tags (B, T) of padded tag scores (B, T, tags)."""
    batch, steps, _ = score.shape
    best, came = w["begin"] + score[:, 0], np.zeros(score.shape, np.int8)
    for t in range(1, steps):
        options = best[:, :, None] + w["move"]
        came[:, t] = options.argmax(1)
        best = np.where((t < lengths)[:, None], options.max(1) + score[:, t], best)
    tags, rows = np.zeros((batch, steps), np.int8), np.arange(batch)
    now = best.argmax(1)
    for t in range(steps - 1, -1, -1):
        tags[:, t] = np.where(t < lengths, now, 0)
        now = np.where((t < lengths) & (t > 0), came[rows, t, now], now)
    return tags


@dataclass(frozen=True)
class Tagger:
    """Weights with the windows they are used on."""

    weights: Weights
    window: int = 96
    stride: int = 48

    def tag(self, stretches: list[str], most_cells: int = 1 << 18) -> list[np.ndarray]:
        """Tags per character. A stretch is scored in overlapping windows; where they overlap their scores
        are averaged, and one search over the whole stretch chooses the tags.

        Windows that are alike, in any stretch, are scored once.
        """
        coded = [encode(s) for s in stretches]
        places = [(n, a) for n, c in enumerate(coded) for a in range(0, max(len(c) - self.window + self.stride, 1), self.stride)]
        numbers: dict[bytes, int] = {}
        number = [numbers.setdefault(coded[n][a : a + self.window].tobytes(), len(numbers)) for n, a in places]
        distinct = np.zeros((len(numbers), self.window), np.int64)
        for key, k in numbers.items():
            symbols = np.frombuffer(key, np.int64)
            distinct[k, : len(symbols)] = symbols
        each = max(1, most_cells // self.window // 8)
        scores = [emissions(distinct[a : a + each], self.weights) for a in range(0, len(distinct), each)]
        scores = np.concatenate(scores) if scores else np.empty((0, self.window, 1), np.float32)
        sums = [np.zeros((len(c), scores.shape[2]), np.float32) for c in coded]
        times = [np.zeros((len(c), 1), np.float32) for c in coded]
        for (n, a), k in zip(places, number, strict=True):
            size = len(coded[n][a : a + self.window])
            sums[n][a : a + size] += scores[k, :size]
            times[n][a : a + size] += 1
        out: list[np.ndarray] = [np.empty(0, np.int8)] * len(coded)
        order = sorted((n for n in range(len(coded)) if len(coded[n])), key=lambda n: len(coded[n]))
        while order:
            longest = len(coded[order[-1]])
            order, some = (order[: -(most_cells // longest or 1)], order[-(most_cells // longest or 1) :])
            padded = np.zeros((len(some), longest, scores.shape[2]), np.float32)
            for row, n in enumerate(some):
                padded[row, : len(coded[n])] = sums[n] / times[n]
            tags = best_tags(padded, np.array([len(coded[n]) for n in some]), self.weights)
            for row, n in enumerate(some):
                out[n] = tags[row, : len(coded[n])]
        return out
