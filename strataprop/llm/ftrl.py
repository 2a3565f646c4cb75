"""Follow-the-regularised-leader (FTRL-proximal) for sparse linear classifiers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class Ftrl:
    """Logistic regression (one output) or multinomial logistic regression (two outputs or more).

    Every weight has its own learning rate, ``alpha / (beta + sqrt(sum of squared gradients))``. The
    elastic net is exact: a weight whose pull stays below ``l1`` is zero, ``l2`` shrinks the rest. The
    last feature is the bias and has no penalty.
    """

    def __init__(self, features: int, outputs: int, alpha: float, beta: float, l1: float, l2: float):
        self.pull = np.zeros((features + 1, outputs))
        self.squares = np.zeros((features + 1, outputs))
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, features

    def _weights_at(self, rows: np.ndarray) -> np.ndarray:
        pull, rate = self.pull[rows], (self.beta + np.sqrt(self.squares[rows])) / self.alpha
        free = (rows == self.bias)[:, None]
        l1, l2 = np.where(free, 0, self.l1), np.where(free, 0, self.l2)
        return np.where(np.abs(pull) <= l1, 0, (np.sign(pull) * l1 - pull) / (rate + l2))

    def step(self, rows: np.ndarray, values: np.ndarray, target: int) -> None:
        """Learn from one example: its features and their values, and its class."""
        rows, values = np.append(rows, self.bias), np.append(values, 1.0)
        weights = self._weights_at(rows)
        p = probabilities(values @ weights)
        p[target if len(p) > 1 else 0] -= 1.0 if len(p) > 1 else float(target)
        gradient = np.outer(values, p)
        squares = self.squares[rows]
        grown = squares + gradient**2
        self.pull[rows] += gradient - (np.sqrt(grown) - np.sqrt(squares)) / self.alpha * weights
        self.squares[rows] = grown

    def fit(self, examples: Sequence[tuple[np.ndarray, np.ndarray]], targets: Sequence[int],
            epochs: int, seed: int = 7) -> Ftrl:
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in order.permutation(len(examples)):
                self.step(*examples[k], targets[k])
        return self

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of all features, and the bias."""
        all_rows = self._weights_at(np.arange(self.bias + 1))
        return all_rows[:-1], all_rows[-1]


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Softmax along the last axis, or the logistic function of a single score."""
    if scores.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(scores, -500, 500)))
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, targets: np.ndarray, low: float = 0.05, high: float = 20.0) -> float:
    """The divisor of the scores under which the targets are likeliest, by golden section in its log."""
    def loss(log_t: float) -> float:
        p = probabilities(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(targets)), targets], 1e-12)).mean()

    a, b, shrink = np.log(low), np.log(high), (np.sqrt(5) - 1) / 2
    for _ in range(50):
        c, d = b - shrink * (b - a), a + shrink * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))
