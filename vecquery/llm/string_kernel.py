"""Gap-weighted subsequence kernel between words, Nyström features and a linear support vector machine.

A word is described by all its subsequences of ``LENGTH`` characters that stretch over at most ``SPAN``; each
occurrence counts ``DECAY`` to the power of the stretch. The product of two descriptions, divided by norms that depend
on the words' lengths, is raised to ``POWER`` (a product of kernels is a kernel). Characters put in between lengthen a
stretch and so only dampen it; the power keeps words apart that share most but not all subsequences.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np

LENGTH = 3
SPAN = 6
DECAY = 0.8
POWER = 4
#: Words are compared in pieces of at most so many characters.
WIDTH = 14
#: a-z are characters of their own, all others share the remaining codes.
_CODES = 64
_TRIPLES = np.array([t for t in combinations(range(WIDTH), LENGTH) if t[-1] - t[0] < SPAN])
_STRETCH = (DECAY ** (_TRIPLES[:, 2] - _TRIPLES[:, 0] + 1)).astype(np.float32)
#: Norm of a word of each length, occurrences taken one by one.
_NORM = np.array([max(1e-6, np.sqrt((_STRETCH[_TRIPLES[:, 2] < n] ** 2).sum())) for n in range(WIDTH + 1)], dtype=np.float32)


def encoded(words: list[str]) -> np.ndarray:
    """Character codes (n, WIDTH), 0 behind the end."""
    points = np.array(words, dtype=f"<U{WIDTH}").view("<u4").reshape(len(words), WIDTH).astype(np.int32)
    return np.where((points >= 97) & (points <= 122), points - 96, np.where(points > 0, 27 + points % 37, 0))


def _subsequences(x: np.ndarray) -> np.ndarray:
    """Codes of all subsequences (n, triples), 0 where one runs past the end."""
    a, b, c = (x[:, _TRIPLES[:, i]] for i in range(LENGTH))
    return np.where(c > 0, (a * _CODES + b) * _CODES + c, 0)


@dataclass(frozen=True)
class Landmarks:
    """``place[code]`` is a row of ``weight`` (rows, landmarks), 0 for subsequences no landmark has."""

    words: tuple[str, ...]
    place: np.ndarray
    weight: np.ndarray


def landmarks(words: list[str]) -> Landmarks:
    x = encoded(words)
    code = _subsequences(x)
    found = np.unique(code[code > 0])
    place = np.zeros(_CODES**3, dtype=np.int32)
    place[found] = np.arange(1, len(found) + 1)
    weight = np.zeros((len(found) + 1, len(words)), dtype=np.float32)
    for k in range(len(words)):
        np.add.at(weight[:, k], place[code[k]], _STRETCH)
    weight[0] = 0
    return Landmarks(tuple(words), place, weight / _NORM[(x > 0).sum(axis=1)])


def kernel(words: list[str], marks: Landmarks) -> np.ndarray:
    """Kernel (n, landmarks); a word's first ``WIDTH`` characters count."""
    out = np.zeros((len(words), len(marks.words)), dtype=np.float32)
    for s in range(0, len(words), 1_024):
        x = encoded(words[s : s + 1_024])
        rows = marks.place[_subsequences(x)]
        part = out[s : s + 1_024]
        for t in range(rows.shape[1]):  # one triple of positions of all words at a time
            has = np.flatnonzero(rows[:, t])
            if len(has):
                part[has] += marks.weight[rows[has, t]] * _STRETCH[t]
        part /= _NORM[(x > 0).sum(axis=1)][:, None]
    return out**POWER


@dataclass(frozen=True)
class Machine:
    """Decision value of a word: its kernel with the landmarks times ``alpha``, plus ``bias``."""

    marks: Landmarks
    alpha: np.ndarray
    bias: float

    def decide(self, words: list[str]) -> np.ndarray:
        out = [kernel(words[s : s + 8_192], self.marks) @ self.alpha for s in range(0, len(words), 8_192)]
        return np.concatenate([*out, np.zeros(0, dtype=np.float32)]) + self.bias


def train_machine(marks: Landmarks, good: list[str], bad: list[str], cost: float = 30_000.0) -> Machine:
    """Squared-hinge support vector machine on Nyström features; both classes weigh the same.

    A tenth of the good examples are words that no landmark has anything in common with.
    """
    own = kernel(list(marks.words), marks).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = kernel([*bad, *good], marks).astype(float) @ root
    unlike = len(good) // 10 + 1
    x = np.column_stack([np.vstack([x, np.zeros((unlike, x.shape[1]))]), np.ones(len(x) + unlike)])
    clean = len(good) + unlike
    y = np.r_[np.ones(len(bad)), -np.ones(clean)]
    weight = np.r_[np.full(len(bad), cost / max(1, len(bad))), np.full(clean, cost / clean)]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(50):  # Newton on the rows inside the margin
        inside = y * (x @ w) < 1
        part = x[inside] * weight[inside, None]
        new = np.linalg.solve(part.T @ x[inside] + ridge, part.T @ y[inside])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return Machine(marks, (root @ w[:-1]).astype(np.float32), float(w[-1]))
