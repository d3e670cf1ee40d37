"""A generative label model over voters, and a linear scorer; small numpy arrays on the driver.

The model has a class balance and, for each voter, the chance of each vote (negative, abstain,
positive) in either class. Expectation-maximisation estimates both from vote patterns and their
counts. Voters that repeat each other are found by the correlation of their votes that the classes
don't explain; a voter's evidence is divided by the number of voters it amounts to.
"""

from __future__ import annotations

import numpy as np


class LabelModel:
    def __init__(self, balance: float, chances: np.ndarray, share: np.ndarray):
        #: chances[class, voter, vote + 1]; share: a voter's weight after its correlations
        self.balance, self.chances, self.share = balance, chances, share

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class 1) of rows of votes in -1, 0, 1."""
        at = np.arange(votes.shape[1])
        logs = np.log(self.chances)
        gap = (logs[1][at, votes + 1] - logs[0][at, votes + 1]) @ self.share
        return 1 / (1 + np.exp(-np.clip(gap + np.log(self.balance / (1 - self.balance)), -500, 500)))

    @property
    def accuracy(self) -> np.ndarray:
        """Of each voter, where it votes."""
        right = self.balance * self.chances[1, :, 2] + (1 - self.balance) * self.chances[0, :, 0]
        cast = self.balance * (1 - self.chances[1, :, 1]) + (1 - self.balance) * (1 - self.chances[0, :, 1])
        return right / np.maximum(cast, 1e-12)


def _shares(votes: np.ndarray, weight: np.ndarray, post: np.ndarray, floor: float = 0.2) -> np.ndarray:
    """1 / (1 + the correlations with other voters within the classes)."""
    total = np.zeros((votes.shape[1],) * 2)
    for p in (post, 1 - post):
        w = weight * p
        if w.sum() <= 0:
            continue
        centred = votes - np.average(votes, axis=0, weights=w)
        cov = (centred * w[:, None]).T @ centred / w.sum()
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        total += w.sum() / weight.sum() * np.where(np.outer(sd, sd) > 1e-9, cov / np.outer(sd, sd), 0)
    np.fill_diagonal(total, 0)
    return 1 / (1 + np.where(total > floor, total, 0).sum(axis=1))


def fit(votes: np.ndarray, weight: np.ndarray, balance: float, start: np.ndarray | None = None, rounds: int = 60, prior: float = 2.0) -> LabelModel:
    """From distinct rows of votes and their counts; start: first posteriors (else the sign of the sum of votes)."""
    votes = votes.astype(np.int64)
    copies = np.ones(votes.shape[1])
    if start is None:
        # with nothing to begin from, voters that are nearly copies would take the class for themselves: they count as one
        copies = _shares(votes, weight, np.ones(len(votes)), floor=0.8)
        s = votes @ copies
        start = np.where(s > 0, 0.9, np.where(s < 0, 0.1, balance))
    post, share = start.astype(float), copies
    model = None
    for k in range(rounds):
        chances = np.empty((2, votes.shape[1], 3))
        for c, p in enumerate((1 - post, post)):
            w = weight * p
            for v in (-1, 0, 1):
                chances[c, :, v + 1] = ((votes == v) * w[:, None]).sum(axis=0)
            # an honest voter's prior: a few rows, mostly right
            chances[c] += prior * np.where(np.arange(3) == 1, 1.0, np.where(np.arange(3) == 2 * c, 0.75, 0.25))
        chances /= chances.sum(axis=2, keepdims=True)
        balance = float(np.clip((weight * post).sum() / max(weight.sum(), 1e-12), 1e-3, 1 - 1e-3))
        if k % 10 == 5:
            share = np.minimum(copies, _shares(votes, weight, post))
        model = LabelModel(balance, chances, share)
        new = model.posterior(votes)
        if k > 10 and np.abs(new - post).max(initial=0.0) < 1e-6:
            break
        post = new
    return model


def train_linear(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int, size: int, target: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets from sparse features (row, column, value), by Adam on all rows; (weights, bias)."""
    w, b = np.zeros(size), float(np.log(np.clip(np.average(target, weights=weight), 1e-3, 1 - 1e-3) / (1 - np.clip(np.average(target, weights=weight), 1e-3, 1 - 1e-3))))
    m, v, mb, vb, total = np.zeros(size), np.zeros(size), 0.0, 0.0, weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(rows, w[columns] * values, minlength=n) + b
        err = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / total
        g = np.bincount(columns, err[rows] * values, minlength=size) + l2 * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        r = rate / (1 - 0.9**t)
        s = 1 - 0.999**t
        w -= r * m / (np.sqrt(v / s) + 1e-8)
        b -= r * mb / (np.sqrt(vb / s) + 1e-8)
    return w, float(b)
