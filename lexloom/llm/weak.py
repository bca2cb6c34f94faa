"""Weak supervision: a generative model of voters, and a hashed linear scorer.

Both are fitted on the driver with numpy on a bounded sample; the scorer is a
few thousand numbers that travel to the executors in a closure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .tokens import mix


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class LabelModel:
    """``log_odds[j, v + 1]``: what vote v of voter j adds to the log odds of class 1.

    ``accuracy``: chance that a voter that does not abstain is right;
    ``correlation``: of the voters' errors, given the class.
    """

    prior: float
    log_odds: np.ndarray
    accuracy: np.ndarray
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        x = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j in range(votes.shape[1]):
            x += self.log_odds[j, votes[:, j] + 1]
        return sigmoid(x)


def fit_label_model(votes: np.ndarray, prior: float, counts: np.ndarray | None = None, start: np.ndarray | None = None, weight: float = 0.0, discount: float = 1.0, rounds: int = 30) -> LabelModel:
    """Expectation-maximisation over ``votes`` (rows x voters; 1, -1, 0 abstains).

    ``counts``: how often each row of votes occurs, once by default.  Starts
    from the posteriors ``start``, by default from the majority.  ``weight``:
    how much the accuracies that ``start`` gives count, beside those that rows'
    posteriors give, in every step; with 0 they only begin it.  A row's own
    posterior comes from its votes alone.  A voter whose errors go with those
    of others, given the class, counts for less: its log odds are divided by
    one plus ``discount`` times its positive correlations.
    """
    m = votes.shape[1]
    prior = float(np.clip(prior, 0.005, 0.995))
    w = np.ones(len(votes)) if counts is None else counts.astype(float)
    q = sigmoid(np.log(prior / (1 - prior)) + 2.0 * votes.sum(1)) if start is None else start
    table, rho = np.zeros((m, 3)), np.zeros((m, m))
    hits = [[votes[:, j] == v for v in (-1, 0, 1)] for j in range(m)]
    values = np.array([-1.0, 0.0, 1.0])
    p1 = p0 = None
    begun = q
    for _ in range(rounds):
        one, zero = (q + weight * begun) * w, (1 - q + weight * (1 - begun)) * w
        p1 = np.array([[(one[h].sum() + 0.5) for h in row] for row in hits]) / (one.sum() + 1.5)
        p0 = np.array([[(zero[h].sum() + 0.5) for h in row] for row in hits]) / (zero.sum() + 1.5)
        prior = float(np.clip(one.sum() / (one.sum() + zero.sum()), 0.005, 0.995))
        # errors, given the class
        left = votes - (q[:, None] * (p1 @ values) + (1 - q)[:, None] * (p0 @ values))
        left -= (w @ left) / w.sum()
        scale = np.sqrt((w @ left**2) / w.sum()) + 1e-9
        rho = (left.T * w @ left) / w.sum() / np.outer(scale, scale)
        np.fill_diagonal(rho, 0)
        table = (np.log(p1) - np.log(p0)) / (1.0 + discount * np.clip(rho, 0, None).sum(1))[:, None]
        q = sigmoid(np.log(prior / (1 - prior)) + sum(table[j, votes[:, j] + 1] for j in range(m)))
    right = prior * p1[:, 2] + (1 - prior) * p0[:, 0]
    wrong = prior * p1[:, 0] + (1 - prior) * p0[:, 2]
    return LabelModel(prior, table, right / (right + wrong), rho)


class Features:
    """Hashed features of some documents: pairs (row, 64-bit hash), once each, by hash."""

    def __init__(self, rows: np.ndarray, hashes: np.ndarray) -> None:
        order = np.lexsort((rows, hashes))
        rows, hashes = rows[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        self.rows, self.hashes = rows[new], hashes[new]


def promising(found: Features, target: np.ndarray, least_z: float = 4.5, least_rows: int = 4) -> Features:
    """The features of ``least_rows`` rows whose targets are ``least_z`` standard errors from the mean."""
    prior = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    if not len(found.hashes):
        return found
    starts = np.flatnonzero(np.append(True, found.hashes[1:] != found.hashes[:-1]))
    counts = np.diff(np.append(starts, len(found.hashes)))
    ones = np.add.reduceat(target[found.rows], starts)
    chosen = (counts >= least_rows) & (np.abs(ones - counts * prior) >= least_z * np.sqrt(counts * prior * (1 - prior) + 1e-9))
    mine = np.repeat(chosen, counts)
    return Features(found.rows[mine], found.hashes[mine])


#: Slots of the scorer's table; a feature's slot is the top bits of its hash.
BITS = 20


@dataclass
class LinearScorer:
    """``slots`` marks the slots in use; ``keys`` and ``weights`` are its features."""

    bias: float
    keys: np.ndarray
    weights: np.ndarray
    slots: np.ndarray

    def used(self, hashes: np.ndarray) -> np.ndarray:
        """Indexes of the hashes that may have a weight."""
        return np.flatnonzero(self.slots[hashes >> np.uint64(64 - BITS)])

    def score(self, n: int, rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Log odds of ``n`` documents from their features, of which each counts once."""
        out = np.full(n, self.bias)
        if len(self.keys) and len(hashes):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            own = self.keys[at] == hashes
            pairs = np.unique(rows[own] * np.int64(len(self.keys)) + at[own])
            out += np.bincount(pairs // len(self.keys), self.weights[pairs % len(self.keys)], n)
        return out


def fit_linear(n: int, found: Features, target: np.ndarray, least_z: float = 4.5, least_rows: int = 4, ridge: float = 1.0, rounds: int = 600) -> LinearScorer:
    """Logistic regression of ``target`` (posteriors) on hashed features, stage by stage.

    Every round gives a Newton step to the feature with the greatest score
    statistic, so that a feature enters only for what the others leave
    unexplained; it ends when no statistic reaches ``least_z``.  Features of
    under ``least_rows`` rows, and those alike in all rows, are not looked at.
    """
    prior = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    found = promising(found, target, least_z, least_rows)
    keys, cols = np.unique(found.hashes, return_inverse=True)
    rows, cols, k = found.rows, cols.reshape(-1), len(keys)
    starts = np.searchsorted(cols, np.arange(k + 1))
    x, w, b = np.zeros(n), np.zeros(k), np.log(prior / (1 - prior))
    if k:
        for _ in range(rounds):
            p = sigmoid(b + x)
            # the intercept first
            b += float(np.clip((target - p).sum() / ((p * (1 - p)).sum() + ridge), -1, 1))
            p = sigmoid(b + x)
            g = np.add.reduceat((target - p)[rows], starts[:-1])
            h = np.add.reduceat((p * (1 - p))[rows], starts[:-1])
            z = np.abs(g) / np.sqrt(h + ridge)
            best = np.argmax(z)
            if z[best] < least_z:
                break
            step = float(np.clip(g[best] / (h[best] + ridge), -2, 2))
            w[best] += step
            x[rows[starts[best] : starts[best + 1]]] += step
        # what has entered is fitted to the end, with a weak pull to 0
        for _ in range(30):
            for j in np.flatnonzero(w):
                own = rows[starts[j] : starts[j + 1]]
                p = sigmoid(b + x[own])
                step = float(np.clip(((target[own] - p).sum() - 0.1 * w[j]) / ((p * (1 - p)).sum() + 0.3), -1, 1))
                w[j] += step
                x[own] += step
            p = sigmoid(b + x)
            b += float(np.clip((target - p).sum() / ((p * (1 - p)).sum() + ridge), -1, 1))
    kept = np.abs(w) > 1e-6
    keys = keys[kept]
    slots = np.zeros(1 << BITS, bool)
    slots[keys >> np.uint64(64 - BITS)] = True
    return LinearScorer(float(b), keys, w[kept], slots)


def named(name: str) -> np.uint64:
    """The hash of a feature that has a name rather than a word."""
    x = np.uint64(0)
    for c in name.encode():
        x = mix(np.array([x + np.uint64(c) + np.uint64(0x1000)]))[0]
    return x
