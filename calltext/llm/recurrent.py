"""A bidirectional LSTM over sequences of vectors, with a label for every step, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(width: int, hidden: int, seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    out: Weights = {}
    for way in "fb":
        out[way + "x"] = rng.normal(0, width ** -0.5, (width, 4 * hidden))
        out[way + "h"] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
        out[way + "0"] = np.zeros(4 * hidden)
        out[way + "0"][hidden:2 * hidden] = 1  # remember at first
    out["o"], out["o0"] = rng.normal(0, hidden ** -0.5, 2 * hidden), np.zeros(1)
    return {k: v.astype(np.float32) for k, v in out.items()}


def batches(sizes: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Numbers of sequences of like length, at most ``limit`` steps with the padding, one at least."""
    order = np.argsort(sizes, kind="stable")
    begin = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or (i + 1 - begin) * max(int(sizes[order[i]]), 1) > limit:
            yield order[begin:i]
            begin = i


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps by sequences by features, forwards and backwards, and which steps are real."""
    longest = max(len(s) for s in sequences)
    there = np.zeros((longest, len(sequences), sequences[0].shape[1]), dtype=np.float32)
    back, real = np.zeros_like(there), np.zeros(there.shape[:2], dtype=bool)
    for j, s in enumerate(sequences):
        there[:len(s), j], back[:len(s), j], real[:len(s), j] = s, s[::-1], True
    return there, back, real


def _reversed(states: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Each sequence's own steps in reverse order."""
    steps = np.arange(len(real))[:, None]
    at = np.where(real, real.sum(axis=0) - 1 - steps, steps)
    return np.take_along_axis(states, at[:, :, None], axis=0)


def _walk(w: Weights, way: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    hidden = w[way + "h"].shape[0]
    driven = x @ w[way + "x"] + w[way + "0"]
    h = c = np.zeros((x.shape[1], hidden), dtype=np.float32)
    out, kept = np.empty((*x.shape[:2], hidden), dtype=np.float32), []
    for t in range(len(x)):
        z = driven[t] + h @ w[way + "h"]
        gates = _sigmoid(z[:, :3 * hidden])
        i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        g = np.tanh(z[:, 3 * hidden:])
        before, c = (h, c), f * c + i * g
        s = np.tanh(c)
        h = o * s
        out[t] = h
        kept.append((before, i, f, o, g, s))
    return out, kept


def _back(w: Weights, way: str, x: np.ndarray, kept: list, upstream: np.ndarray) -> Weights:
    dz_all = np.empty((*x.shape[:2], w[way + "0"].shape[0]), dtype=np.float32)
    dh, dc = np.zeros_like(upstream[0]), np.zeros_like(upstream[0])
    recurrent = np.zeros_like(w[way + "h"])
    for t in range(len(x) - 1, -1, -1):
        (h, c), i, f, o, g, s = kept[t]
        dh = dh + upstream[t]
        dc = dc + dh * o * (1 - s * s)
        dz = np.concatenate((dc * g * i * (1 - i), dc * c * f * (1 - f), dh * s * o * (1 - o),
                             dc * i * (1 - g * g)), axis=1)
        dz_all[t] = dz
        recurrent += h.T @ dz
        dh, dc = dz @ w[way + "h"].T, dc * f
    flat = dz_all.reshape(-1, dz_all.shape[2])
    return {way + "x": x.reshape(-1, x.shape[2]).T @ flat, way + "h": recurrent,
            way + "0": flat.sum(axis=0)}


def scores(w: Weights, sequences: list[np.ndarray], limit: int = 1 << 14) -> list[np.ndarray]:
    """The chance of each step of each sequence; what is held at once follows the longest one."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.float32)] * len(sequences)
    sizes = np.array([len(s) for s in sequences])
    for batch in batches(sizes, limit):
        if not sizes[batch].any():
            continue
        there, back, real = padded([sequences[j] for j in batch])
        both = np.concatenate((_walk(w, "f", there)[0], _reversed(_walk(w, "b", back)[0], real)), axis=2)
        chance = _sigmoid(both @ w["o"] + w["o0"])
        for k, j in enumerate(batch):
            out[j] = chance[:sizes[j], k]
    return out


def loss(w: Weights, there: np.ndarray, back: np.ndarray, real: np.ndarray, truth: np.ndarray
         ) -> tuple[float, Weights]:
    """Mean cross entropy over the real steps, and its gradient."""
    ahead, kept_f = _walk(w, "f", there)
    behind, kept_b = _walk(w, "b", back)
    both = np.concatenate((ahead, _reversed(behind, real)), axis=2)
    chance = _sigmoid(both @ w["o"] + w["o0"])
    total = real.sum()
    sure = np.clip(np.where(truth, chance, 1 - chance), 1e-7, 1)
    wrong = np.where(real, chance - truth, 0).astype(np.float32) / total
    grad = {"o": np.einsum("tb,tbh->h", wrong, both), "o0": wrong.sum(keepdims=True).reshape(1)}
    upstream = wrong[:, :, None] * w["o"]
    hidden = ahead.shape[2]
    grad |= _back(w, "f", there, kept_f, upstream[:, :, :hidden])
    grad |= _back(w, "b", back, kept_b, _reversed(upstream[:, :, hidden:], real))
    return float(-np.log(sure[real]).mean()), grad


def fit(sequences: list[np.ndarray], truths: list[np.ndarray], hidden: int = 20, rounds: int = 10,
        seed: int = 1, rate: float = 0.02, limit: int = 3000) -> Weights:
    """Weights by Adam over batches of like lengths. The same input gives the same weights."""
    w = start(sequences[0].shape[1], hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    rng = np.random.default_rng(seed)
    made = []
    for batch in batches(np.array([len(s) for s in sequences]), limit):
        there, back, real = padded([sequences[j] for j in batch])
        truth = np.zeros(real.shape, dtype=bool)
        for k, j in enumerate(batch):
            truth[:len(truths[j]), k] = truths[j]
        made.append((there, back, real, truth))
    step = 0
    for turn in range(rounds):
        for number in rng.permutation(len(made)):
            step += 1
            _, grad = loss(w, *made[number])
            size = sum(float((g * g).sum()) for g in grad.values()) ** 0.5
            pace = rate * (0.1 if turn >= rounds - 2 else 1)
            for k, g in grad.items():
                g = g / max(size, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = (w[k] - pace * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w
