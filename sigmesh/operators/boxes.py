"""Boxes of vectors: bounds on the products of two groups of rows.

Every vector is taken apart into its parts along a few common directions (those
in which a bounded sample is longest) and the length of what is left. A box has
the least and most of these parts among its rows, and the most of what is left:
no product of a row of one box with a row of another exceeds the sum, over the
directions, of the largest product of their ends, plus the product of what is
left (Cauchy-Schwarz). Rows are dealt into boxes by halving them where they
spread most. Bounds hold whatever the data; how much they exclude depends on it.
"""

from __future__ import annotations

import numpy as np

#: Directions of a box, and rows of the sample they are taken from.
DIRECTIONS, SAMPLE_ROWS = 4, 4096
#: Room for rounding in the bounds.
SLACK = 1e-9


def directions(sample: np.ndarray) -> np.ndarray:
    """The directions in which the rows of ``sample`` are longest, as columns."""
    x = np.nan_to_num(sample)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :DIRECTIONS]


def parts(u: np.ndarray, along: np.ndarray) -> np.ndarray:
    """A row's parts along the directions, and the length of what is left (never too small). A number that is none counts as 0: no
    product with its row reaches anything."""
    u = np.nan_to_num(u.astype(np.float64, copy=False))
    p = u @ along
    return np.column_stack([p, np.sqrt(np.maximum((u * u).sum(1) - (p * p).sum(1), 0.0) + 1e-14)])


def grown(p: np.ndarray, boxes: int, first: int = 0) -> tuple | int:
    """Cuts that deal the rows of ``p`` into so many boxes: (column, from where on right, left, right), or a box's number."""
    if boxes < 2 or len(p) < 2:
        return first
    column, fewer = int(p.std(0).argmax()), boxes // 2
    at = float(np.quantile(p[:, column], fewer / boxes))
    below = p[:, column] < at
    if not below.any():
        return first
    return column, at, grown(p[below], fewer, first), grown(p[~below], boxes - fewer, first + fewer)


def dealt(p: np.ndarray, cuts: tuple | int) -> np.ndarray:
    """The box of each row."""
    if isinstance(cuts, int):
        return np.full(len(p), cuts, np.int32)
    column, at, left, right = cuts
    below = p[:, column] < at
    out = np.empty(len(p), np.int32)
    out[below], out[~below] = dealt(p[below], left), dealt(p[~below], right)
    return out


def most(least: np.ndarray, largest: np.ndarray, least2: np.ndarray, largest2: np.ndarray) -> np.ndarray:
    """For each box of one list (a row of ``least`` and of ``largest`` each) and each of another, what no product exceeds."""
    total = largest[:, None, -1] * largest2[None, :, -1] + SLACK
    for d in range(least.shape[1] - 1):
        total = total + np.maximum.reduce([a[:, None, d] * b[None, :, d] for a in (least, largest) for b in (least2, largest2)])
    return total


class Boxed:
    """Rows (their ``parts``) sorted into boxes of about ``rows`` rows: their order, where each box begins and ends, its least and largest parts."""

    def __init__(self, p: np.ndarray, rows: int):
        box = dealt(p, grown(p, -(-len(p) // rows)))
        self.order = np.argsort(box, kind="stable")
        self.starts = np.flatnonzero(np.diff(box[self.order], prepend=-1))
        self.ends = np.append(self.starts[1:], len(p))
        self.least, self.largest = (f.reduceat(p[self.order], self.starts) for f in (np.minimum, np.maximum))
