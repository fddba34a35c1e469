"""Vectors of single words for the log-bilinear model.

Under each class of the symbol model stand groups of words, and the words of each group. The word of rank r in its class
is in group floor(sqrt(r)), so frequent words are in small groups, and normalising over a class's groups and one group's
words costs some square roots of the class.

A word is predicted by the symbol before the last word and by the last word's own vector. Vectors are trained by
noise-contrastive estimation with drawn noise, over all training tokens: each task trains on its own texts, and rows are
averaged over the tasks by the number of tokens behind them. Words start from their smoothed shares, which training
turns by the context; a fixed random vector of each context word lets targets tell contexts apart from the first step on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Steps: noise samples of a batch, step size, and squares of gradients that count as seen before the first.
NOISE = 16
RATE = 0.2
PRIOR = 10.0
#: Size of the fixed vectors' elements.
SPREAD = 0.5
#: Tokens that training goes over at least, in several passes over a smaller corpus, and the most passes.
LEAST_TOKENS = 5_000_000
MOST_PASSES = 20


@dataclass
class Words:
    """The tree of classes, groups and words: a leaf is a vocabulary word, leaves of a group and groups of a class follow
    each other. ``groups`` and ``words`` are target vectors with the bias at the end, ``last`` adds to the fixed vectors
    of context words: leaves, and after them the symbols, which stand for all words without a leaf."""

    leaf: np.ndarray  # of each vocabulary word, in the order of the dictionary
    group: np.ndarray  # of each leaf
    group_start: np.ndarray  # first leaf of each group, and the number of leaves
    class_start: np.ndarray  # first group of each class, and the number of groups
    word_share: np.ndarray  # log share of each leaf in its group
    group_share: np.ndarray  # log share of each group in its class's vocabulary
    class_share: np.ndarray  # log10 share of each class's vocabulary in the class
    last: np.ndarray
    groups: np.ndarray
    words: np.ndarray

    @classmethod
    def build(cls, word_class: np.ndarray, counts: np.ndarray, class_mass: np.ndarray, smooth: float, width: int, symbols: int) -> Words:
        """From the class and count of each vocabulary word, by falling count, and the smoothed tokens of each class."""
        n, k = len(word_class), len(class_mass)
        order = np.argsort(word_class, kind="stable")
        sizes = np.bincount(word_class, minlength=k)
        leaf = np.empty(n, dtype=np.int64)
        leaf[order] = np.arange(n)
        of_class = word_class[order]
        rank = np.arange(n) - (np.cumsum(sizes) - sizes)[of_class]
        own = np.floor(np.sqrt(rank)).astype(np.int64)
        new = np.ones(n, dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (of_class[1:] != of_class[:-1])
        group, first = np.cumsum(new) - 1, np.flatnonzero(new)
        mass = (counts + smooth)[order]
        group_mass = np.bincount(group, weights=mass, minlength=len(first))
        inside = np.bincount(of_class, weights=mass, minlength=k)
        with np.errstate(divide="ignore"):
            class_share = np.log10(inside / class_mass)
        return cls(
            leaf, group, np.append(first, n), np.searchsorted(of_class[first], np.arange(k + 1)), np.log(mass / group_mass[group]).astype(np.float32),
            np.log(group_mass / inside[of_class[first]]).astype(np.float32), class_share,
            np.zeros((n + symbols, width), np.float32), np.zeros((len(first), width + 1), np.float32), np.zeros((n, width + 1), np.float32),
        )

    def fixed(self) -> np.ndarray:
        """The fixed vectors of all context words: the same in every process, so they need not be sent."""
        return np.random.default_rng(17).normal(0, SPREAD, self.last.shape).astype(np.float32)

    def choices(self, leaves: np.ndarray) -> Iterator[tuple[bool, int, int, int, int, np.ndarray]]:
        """(is among groups, from and to of sorted ``leaves``, from and to of the rows to choose from, targets)."""
        ends = np.concatenate(([0], np.cumsum(np.bincount(leaves, minlength=len(self.group)))))
        by_group = ends[self.group_start]
        by_class = by_group[self.class_start]
        groups = self.group[leaves]
        for is_group, bounds, rows, target in ((True, by_class, self.class_start, groups), (False, by_group, self.group_start, leaves)):
            for i in np.flatnonzero((bounds[1:] > bounds[:-1]) & (rows[1:] - rows[:-1] > 1)).tolist():
                a, b, lo, hi = int(bounds[i]), int(bounds[i + 1]), int(rows[i]), int(rows[i + 1])
                yield is_group, a, b, lo, hi, target[a:b] - lo

    def log_inside(self, leaves: np.ndarray, predicted: np.ndarray) -> np.ndarray:
        """ln P(leaf | class's vocabulary, context) of each leaf and its predicted vector."""
        order = by_key(leaves)
        q, found = predicted[order], np.zeros(len(leaves), dtype=np.float32)
        width = q.shape[1]
        for is_group, a, b, lo, hi, target in self.choices(leaves[order]):
            rows, share = (self.groups, self.group_share) if is_group else (self.words, self.word_share)
            score = q[a:b] @ rows[lo:hi, :width].T + (rows[lo:hi, width] + share[lo:hi])
            score -= score.max(axis=1, keepdims=True)
            found[a:b] += score[np.arange(b - a), target] - np.log(np.exp(score).sum(axis=1))
        out = np.empty_like(found)
        out[order] = found
        return out


def by_key(keys: np.ndarray) -> np.ndarray:
    """The stable order of small whole numbers, which numpy finds by radix."""
    return np.argsort(keys.astype(np.uint16) if len(keys) and keys.max() < 1 << 16 else keys, kind="stable")


class Trainer:
    """Trains a task's own copy of the vectors, batch by batch."""

    def __init__(self, tree: Words, seed: int) -> None:
        self.tree, self.draw = tree, np.random.default_rng(seed)
        self.squares = {k: np.full_like(getattr(tree, k), PRIOR) for k in ("last", "groups", "words")}
        self.seen = {k: np.zeros(len(getattr(tree, k))) for k in self.squares}
        self.sums = {k: np.concatenate(([0.0], np.cumsum(np.exp(share.astype(np.float64))))) for k, share in (("groups", tree.group_share), ("words", tree.word_share))}

    def _step(self, kind: str, rows: np.ndarray | slice, gradient: np.ndarray) -> None:
        squares, value = self.squares[kind], getattr(self.tree, kind)
        squares[rows] += gradient * gradient
        value[rows] += RATE * gradient / np.sqrt(squares[rows])

    def batch(self, leaves: np.ndarray, last: np.ndarray, predicted: np.ndarray) -> None:
        """One step on target leaves, their last context words and predicted vectors.

        A real successor is told from ``NOISE`` draws by the shares. A score has the log share in it, and so has the
        noise's level: both fall out.
        """
        order = by_key(leaves)
        q, width = predicted[order], predicted.shape[1]
        back = np.zeros_like(q)
        level = np.float32(np.log(NOISE))
        for is_group, a, b, lo, hi, target in self.tree.choices(leaves[order]):
            kind = "groups" if is_group else "words"
            rows, sums, own = getattr(self.tree, kind)[lo:hi], self.sums[kind], q[a:b]
            drawn = np.searchsorted(sums, sums[lo] + self.draw.random(NOISE) * (sums[hi] - sums[lo]), side="right") - 1 - lo
            times = np.bincount(np.clip(drawn, 0, hi - lo - 1), minlength=hi - lo)
            noise = np.flatnonzero(times)
            score = own @ rows[:, :width].T + rows[:, width] if hi - lo <= 3 * len(noise) else None
            if score is None:
                up = np.einsum("ij,ij->i", own, rows[target, :width]) + rows[target, width]
                down = own @ rows[noise, :width].T + rows[noise, width]
            else:
                up, down = score[np.arange(b - a), target], score[:, noise]
            up = 1 / (1 + np.exp(up - level))
            down = times[noise].astype(np.float32) / (1 + np.exp(level - down))
            back[a:b] += up[:, None] * rows[target, :width] - down @ rows[noise, :width]
            # Targets are sorted, so the real successors' gradients are sums of runs.
            gradient = np.zeros((hi - lo, width + 1), dtype=np.float32)
            starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
            gradient[target[starts], :width] = np.add.reduceat(up[:, None] * own, starts, axis=0)
            gradient[target[starts], width] = np.add.reduceat(up, starts)
            gradient[noise, :width] -= down.T @ own
            gradient[noise, width] -= down.sum(axis=0)
            self._step(kind, slice(lo, hi), gradient)
            self.seen[kind][lo + target[starts]] += np.diff(np.append(starts, b - a))
        words = last[order]
        order = by_key(words)
        own = words[order]
        if len(own):
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            self._step("last", own[starts], np.add.reduceat(back[order], starts, axis=0))
            self.seen["last"][own[starts]] += np.diff(np.append(starts, len(own)))
