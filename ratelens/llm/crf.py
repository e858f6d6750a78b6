"""Linear-chain conditional random fields over binary features, in numpy."""

from __future__ import annotations

import numpy as np

_NEVER = -1e9


class Chain:
    """Weights of features and transitions. ``emissions`` are sums of the weights of an item's features."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray):
        self.weights, self.transitions, self.start = weights, transitions, start

    def viterbi(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of a padded batch (sequences, steps, labels); ties go to the smaller label.

        Sequences should come longest first: a step then works on those that still run.
        """
        n, steps, labels = emissions.shape
        back = np.zeros((steps, n, labels), np.int8)
        score = self.start + emissions[:, 0]
        for t in range(1, steps):
            live = int(np.count_nonzero(lengths > t))
            ways = score[:live, :, None] + self.transitions
            back[t, :live] = ways.argmax(axis=1)
            score[:live] = ways.max(axis=1) + emissions[:live, t]
        out = np.full((n, steps), -1, np.int8)
        rows = np.arange(n)
        now = score.argmax(axis=1).astype(np.int8)
        for t in range(steps - 1, -1, -1):
            live = lengths > t
            out[live, t] = now[live]
            if t:
                now = np.where(live, back[t, rows, now], now)
        return out


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def train(
    sequences: list[list[tuple[int, ...]]],
    labels: list[list[int]],
    n_features: int,
    n_labels: int,
    rounds: int = 150,
    rate: float = 0.3,
    penalty: float = 1e-3,
    banned: list[list[list[int]]] | None = None,
) -> Chain:
    """Maximum likelihood with an L2 penalty, by AdaGrad on the exact gradient of the whole table.

    ``sequences`` hold each item's feature numbers, ``banned`` the labels an item can't have. The same input
    gives the same weights. Without sequences all weights are zero.
    """
    weights = np.zeros((n_features, n_labels))
    transitions, start = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    if not sequences:
        return Chain(weights, transitions, start)
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    n, steps = len(order), int(lengths[0])
    most = max(len(f) for s in sequences for f in s)
    index = np.full((n, steps, most), n_features)  # the last row stays zero and pads
    truth = np.zeros((n, steps), np.int64)
    mask = np.arange(steps) < lengths[:, None]
    never = np.zeros((n, steps, n_labels))
    for row, i in enumerate(order):
        for t, features in enumerate(sequences[i]):
            index[row, t, : len(features)] = features
            truth[row, t] = labels[i][t]
            if banned:
                never[row, t, banned[i][t]] = _NEVER
    rows = np.arange(n)
    seen_w, seen_t, seen_s = np.zeros((n_features + 1, n_labels)), np.zeros_like(transitions), np.zeros_like(start)
    gold_t = np.zeros_like(transitions)
    both = mask[:, 1:]
    np.add.at(gold_t, (truth[:, :-1][both], truth[:, 1:][both]), 1)
    gold = np.zeros((n, steps, n_labels))
    gold[rows[:, None], np.arange(steps), truth] = 1
    gold *= mask[:, :, None]
    padded = np.zeros((n_features + 1, n_labels))
    for _ in range(rounds):
        padded[:-1] = weights
        emissions = padded[index].sum(axis=2) + never
        forward = np.empty((n, steps, n_labels))
        forward[:, 0] = start + emissions[:, 0]
        for t in range(1, steps):
            step = _log_sum(forward[:, t - 1, :, None] + transitions, 1) + emissions[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        backward = np.zeros((n, steps, n_labels))
        for t in range(steps - 2, -1, -1):
            step = _log_sum(transitions + (emissions[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        whole = _log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - whole[:, None, None]) * mask[:, :, None]
        expected_t = np.zeros_like(transitions)
        for t in range(1, steps):
            pair = forward[:, t - 1, :, None] + transitions + (emissions[:, t] + backward[:, t])[:, None, :]
            expected_t += (np.exp(pair - whole[:, None, None]) * mask[:, t, None, None]).sum(axis=0)
        grad_w = np.zeros((n_features + 1, n_labels))
        np.add.at(grad_w, index.reshape(-1), np.repeat((gold - marginal).reshape(-1, n_labels), most, axis=0))
        grad_w = grad_w / n
        grad_w[:-1] -= penalty * weights
        grad_t = (gold_t - expected_t) / n - penalty * transitions
        grad_s = (gold[:, 0] - marginal[:, 0]).sum(axis=0) / n - penalty * start
        for value, grad, seen in ((weights, grad_w[:-1], seen_w[:-1]), (transitions, grad_t, seen_t), (start, grad_s, seen_s)):
            seen += grad * grad
            value += rate * grad / np.sqrt(seen + 1e-8)
    return Chain(weights, transitions, start)


def packed(runs: list[np.ndarray], limit: int = 1 << 16):
    """Batches of runs of similar length for ``viterbi``: (indices, padded emissions, lengths)."""
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    at = 0
    while at < len(order):
        steps = len(runs[order[at]])
        some = order[at : at + max(1, limit // steps)]
        lengths = np.array([len(runs[i]) for i in some])
        emissions = np.zeros((len(some), steps, runs[some[0]].shape[1]))
        for row, i in enumerate(some):
            emissions[row, : lengths[row]] = runs[i]
        yield some, emissions, lengths
        at += len(some)
