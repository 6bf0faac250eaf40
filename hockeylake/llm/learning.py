"""Follow-the-regularised-leader for small sparse models, and hashing of features."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """FTRL-proximal weights (features x classes) with an elastic-net penalty and a free bias.

    Coordinates have learning rates of their own; weights whose evidence is below l1 are exactly 0.
    """

    def __init__(self, features: int, classes: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.bias, self.bias_n = np.zeros(classes), np.zeros(classes)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def add(self, at: np.ndarray, gradient: np.ndarray, bias_gradient: np.ndarray | None = None) -> None:
        """Take one step on distinct coordinates."""
        n, square = self.n[at], gradient**2
        self.z[at] += gradient - (np.sqrt(n + square) - np.sqrt(n)) / self.alpha * self.weights(at)
        self.n[at] = n + square
        if bias_gradient is not None:
            self.bias_n += bias_gradient**2
            self.bias -= self.alpha * bias_gradient / (self.beta + np.sqrt(self.bias_n))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits at which held-out labels are likeliest (1 without rows)."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean()
    return float(min(np.geomspace(0.05, 20, 121), key=loss))


def shuffled(n: int, epochs: int, seed: int) -> Iterable[int]:
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        yield from rng.permutation(n)
