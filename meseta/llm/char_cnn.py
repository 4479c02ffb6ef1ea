"""A small convolutional network over characters, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH = 64
"""Characters of a window."""
_EMBED, _SPAN, _FILTERS, _HIDDEN = 8, 5, 24, 16


def codes(windows: list[str]) -> np.ndarray:
    """Character codes of windows of ``WIDTH``: ASCII as it is, 1 for other letters, 0 for nothing."""
    raw = "".join(window.ljust(WIDTH, "\0")[:WIDTH] for window in windows).encode("utf-32-le")
    found = np.frombuffer(raw, np.uint32).reshape(-1, WIDTH)
    return np.where(found < 128, found, 1).astype(np.int64)


@dataclass
class CharCNN:
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, seed: int = 2) -> CharCNN:
        draw = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (draw.normal(size=shape) * np.sqrt(2 / np.prod(shape[:-1]))).astype(np.float32)

        embed = draw.normal(size=(128, _EMBED)).astype(np.float32)
        return cls(embed, normal(_SPAN * _EMBED, _FILTERS), np.zeros(_FILTERS, np.float32),
                   normal(2 * _FILTERS, _HIDDEN), np.zeros(_HIDDEN, np.float32), normal(_HIDDEN),
                   np.zeros(1, np.float32))

    def _forward(self, x: np.ndarray):
        e = self.embed[x]  # windows, characters, dimensions
        n, width, size = e.shape
        patches = np.concatenate([e[:, k:width - _SPAN + 1 + k] for k in range(_SPAN)], axis=2)
        conv = np.maximum(patches.reshape(-1, _SPAN * size) @ self.kernel + self.bias, 0).reshape(n, -1, _FILTERS)
        best = conv.argmax(axis=1)
        pooled = np.concatenate((np.take_along_axis(conv, best[:, None], 1)[:, 0], conv.mean(axis=1)), axis=1)
        hidden = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return patches, conv, best, pooled, hidden, hidden @ self.out + self.out_bias

    def logits(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        parts = [self._forward(x[k:k + batch])[-1] for k in range(0, len(x), batch)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def gradients(self, x: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        patches, conv, best, pooled, hidden, logit = self._forward(x)
        n, places = len(x), conv.shape[1]
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - labels)[:, None] / n
        d_hidden = error * self.out * (hidden > 0)
        d_pooled = d_hidden @ self.hidden.T
        d_conv = np.repeat(d_pooled[:, None, _FILTERS:] / places, places, axis=1)
        rows, columns = np.arange(n)[:, None], np.arange(_FILTERS)[None]
        d_conv[rows, best, columns] += d_pooled[:, :_FILTERS]
        d_conv = (d_conv * (conv > 0)).reshape(-1, _FILTERS)
        d_patches = (d_conv @ self.kernel.T).reshape(n, places, _SPAN, _EMBED)
        d_embed = np.zeros_like(self.embed)
        for k in range(_SPAN):
            np.add.at(d_embed, x[:, k:places + k], d_patches[:, :, k])
        return {
            "embed": d_embed, "kernel": patches.reshape(-1, _SPAN * _EMBED).T @ d_conv, "bias": d_conv.sum(0),
            "hidden": pooled.T @ d_hidden, "hidden_bias": d_hidden.sum(0), "out": hidden.T @ error[:, 0],
            "out_bias": error.sum(keepdims=True)[0]}


def fit(x: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, seed: int = 2) -> CharCNN:
    """Adam; the same rows in the same order give the same network."""
    model, draw = CharCNN.start(seed), np.random.default_rng(seed)
    names = list(model.__dataclass_fields__)
    first = {name: np.zeros_like(getattr(model, name)) for name in names}
    second = {name: np.zeros_like(getattr(model, name)) for name in names}
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for chosen in np.array_split(order, max(len(x) // batch, 1)):
            step += 1
            for name, grad in model.gradients(x[chosen], labels[chosen]).items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                move = (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
                setattr(model, name, (getattr(model, name) - 0.003 * move).astype(np.float32))
    return model


def platt(
    logits: np.ndarray, labels: np.ndarray, steps: int = 50, weights: np.ndarray | None = None,
) -> tuple[float, float]:
    """Slope and offset that turn logits into probabilities, by Newton's method on held-out rows.

    ``weights`` says how many rows each entry stands for; one if not given.
    """
    slope, offset = 1.0, 0.0
    weights = np.ones(len(logits)) if weights is None else weights
    # smoothed targets keep separable rows from an infinite slope
    good, bad = (weights * labels).sum(), (weights * (1 - labels)).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * logits + offset, -30, 30)))
        w = weights * (p * (1 - p) + 1e-9)
        error = weights * (p - target)
        gradient = np.array([(error * logits).sum(), error.sum()])
        hessian = np.array([[(w * logits ** 2).sum(), (w * logits).sum()], [(w * logits).sum(), w.sum()]])
        move = np.linalg.solve(hessian + 1e-6 * np.eye(2), gradient)
        slope, offset = slope - float(np.clip(move[0], -1, 1)), offset - float(np.clip(move[1], -2, 2))
    return slope, offset


def recall_threshold(
    scores: np.ndarray, labels: np.ndarray, recall: float, weights: np.ndarray | None = None,
) -> float:
    """The highest threshold that finds at least ``recall`` of the positive rows; above 1 without any.

    ``weights`` says how many rows each entry stands for; one if not given.
    """
    chosen = labels == 1
    if not chosen.any():
        return 2.0
    counts = np.ones(len(scores), np.int64) if weights is None else weights
    order = np.argsort(scores[chosen])
    below = np.cumsum(counts[chosen][order])
    missed = int(np.floor((1 - recall) * below[-1] + 1e-9))
    return float(scores[chosen][order][np.searchsorted(below, missed, side="right")])
