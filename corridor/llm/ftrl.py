"""Follow-the-regularised-leader (proximal) for sparse linear models, two classes or many."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Per-coordinate FTRL with elastic net; ``classes`` = 1 is logistic, more is softmax."""

    def __init__(self, dims: int, classes: int = 1, alpha: float = 0.5, beta: float = 1.0,
                 l1: float = 0.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((dims, classes))
        self.n = np.zeros((dims, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        """One example: distinct coordinates ``at`` with values ``x``; ``y`` is 0/1 or the class number."""
        w = self.weights(at)
        score = x @ w
        if len(score) == 1:
            error = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - y
        else:
            error = softmax(score[None])[0]
            error[y] -= 1
        g = x[:, None] * error[None, :]
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], model: Ftrl, epochs: int, seed: int = 1) -> np.ndarray:
    """Run ``epochs`` shuffled passes and return the weights."""
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            model.update(*examples[i])
    return model.weights()
