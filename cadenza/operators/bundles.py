"""Queries of one block in bundles of near ones, and what an item can score at most for any query of a bundle.

A vector may consist of parts of their own geometry, as a unit vector beside a popularity.  A bundle has a ball and a cone per
part, and an item's bound is the sum over the parts of the smaller of two: ``x.c + |x| r`` by the ball, and by the cone the
length of the item times that of a query times the cosine of the least angle between them.  The cone tells
items of one length apart, where the ball reaches all that are near-parallel or near-opposite.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle

HALVED = 4

# Executors get the functions below with the task; they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _divided(coordinates: np.ndarray, most_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows and where each bundle of at most ``most_rows`` starts in it.

    The widest coordinate is cut, in the middle of its range at first, so that a few rows far from all others
    stand alone, and at its median further down.
    """
    order, starts, open_ = np.arange(len(coordinates)), [], [(0, len(coordinates), 0)]
    while open_:
        low, high, depth = open_.pop()
        if high - low <= most_rows:
            starts.append(low)
            continue
        mine = order[low:high]
        rows = coordinates[mine]
        least, most = rows.min(axis=0), rows.max(axis=0)
        widest = (most - least).argmax()
        below = rows[:, widest] <= (least[widest] + most[widest]) / 2
        if depth >= HALVED or below.all():
            below = np.zeros(len(mine), dtype=bool)
            below[np.argpartition(rows[:, widest], len(mine) // 2)[: len(mine) // 2]] = True
        order[low:high] = np.concatenate([mine[below], mine[~below]])
        middle = low + int(below.sum())
        open_ += [(middle, high, depth + 1), (low, middle, depth + 1)]
    return order, np.array(starts)


class Bundles:
    """``order`` puts the rows of a bundle side by side; bundle i starts at ``starts[i]`` of it and has ``sizes[i]`` rows."""

    def __init__(self, vectors: np.ndarray, most_rows: int, widths: Sequence[int] | None = None) -> None:
        ends = np.cumsum(widths or [vectors.shape[1]])
        parts = [slice(end - width, end) for end, width in zip(ends, widths or [vectors.shape[1]], strict=True)]
        lengths = [np.linalg.norm(vectors[:, p], axis=1) for p in parts]
        self.order, self.starts = _divided(np.nan_to_num(np.column_stack([vectors, *lengths]), posinf=0, neginf=0), most_rows)
        self.sizes = np.diff(np.append(self.starts, len(vectors)))
        self.balls = []
        with np.errstate(invalid="ignore", divide="ignore"):
            for part, length in zip(parts, lengths, strict=True):
                rows, length = vectors[self.order][:, part], length[self.order]
                centres = np.add.reduceat(rows, self.starts) / self.sizes[:, None]
                away = np.linalg.norm(rows - np.repeat(centres, self.sizes, axis=0), axis=1)
                radius, longest = (np.maximum.reduceat(x, self.starts) for x in (away, length))
                axes = centres / np.linalg.norm(centres, axis=1)[:, None]
                cosine = np.einsum("ij,ij->i", rows, np.repeat(axes, self.sizes, axis=0)) / length
                # A vector without length is in every cone.
                widest = np.clip(np.minimum.reduceat(np.where(length > 0, cosine, 1.0), self.starts), -1, 1)
                self.balls.append((part, centres, radius, axes, widest, np.minimum.reduceat(length, self.starts), longest))

    def upper(self, items: np.ndarray, i: int) -> np.ndarray:
        """What each item scores at most for a query of bundle i, but for rounding."""
        total = np.zeros(len(items))
        with np.errstate(invalid="ignore", over="ignore"):
            for part, centres, radius, axes, widest, shortest, longest in self.balls:
                mine = items[:, part]
                length = np.sqrt(np.einsum("ij,ij->i", mine, mine))
                most = mine @ centres[i] + length * radius[i]
                if mine.shape[1] > 1:
                    cosine = np.clip((mine @ axes[i]) / np.where(length > 0, length, 1), -1, 1)
                    nearest = cosine * widest[i] + np.sqrt((1 - cosine * cosine) * (1 - widest[i] * widest[i]))
                    nearest = np.where(cosine >= widest[i], 1.0, nearest)
                    # A bundle without an axis has no cone.
                    most = np.fmin(most, length * np.where(nearest > 0, longest[i], shortest[i]) * nearest)
                total += most
        # What is no number bounds nothing.
        return np.nan_to_num(total, nan=np.inf, posinf=np.inf, neginf=-np.inf)
