"""The E8 lattice: nearest points, neighbouring cells, cell numbers."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np

from .common import mix64


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points whose coordinates are integers with an even sum."""
    r = np.rint(x)
    odd = (r.sum(axis=1).astype(np.int64) & 1).astype(bool)
    if odd.any():
        gap = x[odd] - r[odd]
        worst = np.abs(gap).argmax(axis=1)
        at = np.arange(len(worst))
        fixed = r[odd]
        fixed[at, worst] += np.where(gap[at, worst] < 0, -1.0, 1.0)
        r[odd] = fixed
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of the rows of x (n by 8): E8 is the even-sum integer
    points together with the same shifted by one half."""
    a = _nearest_even(x)
    b = _nearest_even(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    return np.where(closer[:, None], b, a)


def _shortest() -> np.ndarray:
    """The 240 shortest vectors, which lead to the neighbouring cells."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


SHORTEST = _shortest()


def cells(x: np.ndarray, probes: int) -> np.ndarray:
    """Points (n, 1 + probes, 8): the home cell's, then the neighbouring cells'
    that lie nearest, nearest first."""
    home = nearest(x)
    if not probes:
        return home[:, None, :]
    score = (x - home) @ SHORTEST.T
    best = np.argpartition(-score, min(probes, len(SHORTEST) - 1), axis=1)[:, :probes]
    best = np.take_along_axis(best, np.argsort(-np.take_along_axis(score, best, axis=1), axis=1), axis=1)
    return np.concatenate((home[:, None, :], home[:, None, :] + SHORTEST[best]), axis=1)


def numbers(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit number for each point (last axis), different for each salt."""
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    mult = mix64(np.arange(1, 9, dtype=np.uint64) + np.uint64(8 * salt + 8)) | np.uint64(1)
    return mix64((twice * mult).sum(axis=-1, dtype=np.uint64)).view(np.int64)
