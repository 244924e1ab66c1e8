"""Linear-chain conditional random field over long runs of words, in whole-array steps.

Each word has ``K`` features with one value per label; a label's score is their weighted sum
plus a bias, and neighbouring labels score by a transition matrix. Forward and backward
messages are exact for texts of any length: the run of words is cut into equal blocks that
advance side by side; first each block's transfer matrix is formed, then the matrices are
chained, then every block runs again from its true first message.

Training fits the few shared weights by gradient steps on the exact likelihood. Each task
trains on its part of a bounded sample and the parameters are averaged (iterative parameter
mixing), so only parameter vectors reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEPS, RATE = 40, 0.15
BLOCK = 128


@dataclass
class Crf:
    weights: np.ndarray  # K
    bias: np.ndarray  # L
    moves: np.ndarray  # L x L
    first: np.ndarray  # L

    @staticmethod
    def blank(features: int, labels: int) -> Crf:
        return Crf(np.full(features, 0.2), np.zeros(labels), np.zeros((labels, labels)), np.zeros(labels))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights, self.bias, self.moves.ravel(), self.first])

    def like(self, values: np.ndarray) -> Crf:
        k, n = len(self.weights), len(self.bias)
        a, b, c, d = np.split(np.asarray(values, float), [k, k + n, k + n + n * n])
        return Crf(a, b, c.reshape(n, n), d)

    def scores(self, features: np.ndarray) -> np.ndarray:
        """features: words x K x L -> words x L."""
        return np.einsum("nkl,k->nl", features, self.weights) + self.bias


def _scaled(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def messages(crf: Crf, scores: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward messages and scaled emissions, each words x L.

    ``begins`` marks words that start a sequence of their own.
    """
    n, labels = scores.shape
    width = min(BLOCK, max(n, 1))
    rows = -(-n // width)
    pad = rows * width - n
    emit = np.concatenate([_scaled(scores), np.ones((pad, labels))]).reshape(rows, width, labels)
    start = np.concatenate([begins, np.ones(pad, bool)]).reshape(rows, width)
    start[0, 0] = True
    move, first = np.exp(crf.moves - crf.moves.max()), _scaled(crf.first)
    where = [np.flatnonzero(start[:, t]) for t in range(width)]

    def forward(state: np.ndarray, t: int) -> np.ndarray:
        """state: rows x ... x L, advanced over word t."""
        new = state @ move
        if len(where[t]):
            new[where[t]] = state[where[t]].sum(axis=-1, keepdims=True) * first
        e = emit[:, t]
        return new * (e if state.ndim == 2 else e[:, None, :])

    transfer = np.broadcast_to(np.eye(labels), (rows, labels, labels)).copy()
    for t in range(width):
        transfer = forward(transfer, t)
        transfer /= transfer.sum(axis=(1, 2), keepdims=True)
    into, after = np.ones((rows, labels)), np.ones((rows, labels))
    for r in range(1, rows):
        message = into[r - 1] @ transfer[r - 1]
        into[r] = message / message.sum()
    for r in range(rows - 2, -1, -1):
        message = transfer[r + 1] @ after[r + 1]
        after[r] = message / message.sum()
    ahead, back = np.empty((rows, width, labels)), np.empty((rows, width, labels))
    state = into
    for t in range(width):
        state = forward(state, t)
        state /= state.sum(axis=1, keepdims=True)
        ahead[:, t] = state
    state = after
    for t in range(width - 1, -1, -1):
        back[:, t] = state
        weighted = emit[:, t] * state
        state = weighted @ move.T
        if len(where[t]):
            state[where[t]] = (weighted[where[t]] @ first)[:, None]
        state /= state.sum(axis=1, keepdims=True)
    return tuple(x.reshape(-1, labels)[:n] for x in (ahead, back, emit))


def marginals(crf: Crf, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
    if not len(scores):
        return scores
    ahead, back, _ = messages(crf, scores, begins)
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True)


def train(crf: Crf, features: np.ndarray, gold: np.ndarray, begins: np.ndarray, steps: int = STEPS) -> Crf:
    """Gradient steps (with adaptive rates) on the log-likelihood of the gold labels."""
    n, _, labels = features.shape
    one = np.eye(labels)[gold]
    inner = np.flatnonzero(~begins[1:])
    seen_moves = np.zeros((labels, labels))
    np.add.at(seen_moves, (gold[inner], gold[inner + 1]), 1)
    seen = np.concatenate(
        [np.einsum("nkl,nl->k", features, one), one.sum(0), seen_moves.ravel(), one[begins].sum(0)]
    )
    value, mean, square = crf.flat(), np.zeros_like(seen), np.zeros_like(seen)
    for step in range(1, steps + 1):
        now = crf.like(value)
        ahead, back, emit = messages(now, now.scores(features), begins)
        each = ahead * back
        each /= each.sum(axis=1, keepdims=True)
        pair = ahead[inner][:, :, None] * np.exp(now.moves - now.moves.max()) * (emit * back)[inner + 1][:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        expected = np.concatenate(
            [np.einsum("nkl,nl->k", features, each), each.sum(0), pair.sum(0).ravel(), each[begins].sum(0)]
        )
        slope = (seen - expected) / n - 1e-3 * value
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        value = value + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return crf.like(value)


def mixed(crf: Crf, parts: list[tuple[int, list[float]]]) -> Crf:
    """Average of the tasks' parameters, weighted by their words."""
    total = sum(n for n, _ in parts)
    if not total:
        return crf
    return crf.like(sum(n * np.asarray(v) for n, v in parts) / total)
