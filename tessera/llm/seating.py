"""How many tables a dish has in a Pitman-Yor restaurant: Gibbs draws from the exact conditional.

With c customers at a dish of parent probability p, and m tables at the restaurant's other dishes, all seatings of
the dish with t tables weigh together

    S(c, t) * (strength + d m) (strength + d (m + 1)) ... (strength + d (m + t - 1)) * p ** t

where S(c, t) are the generalised Stirling numbers, S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t).  One draw of t
from these weights re-seats all the dish's customers at once.  Only the ratios S(c, t + 1) / S(c, t) are needed:
they come from the recurrence for c up to EXACT and from its differential form in small steps of log c above, one
curve for every count.  Where the weights peak beyond MOST tables they are all but normal, and drawn so.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from .common import mix

MOST = 256  #: ratios are tabulated for t up to this; every count up to this has a row of its own
EXACT, STEP, LARGEST = 4096, 0.02, 2.0**45  #: rows beyond MOST are STEP apart in log c


def draw(dish: np.ndarray, *step: int) -> np.ndarray:
    """Uniform numbers in (0, 1) by dish and step."""
    salt = np.uint64(0)
    with np.errstate(over="ignore"):
        for s in step:
            salt = mix(np.array([salt + np.uint64(s + 1)]))[0]
    return ((mix(dish ^ salt) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


@lru_cache(maxsize=4)
def ratios(d: float) -> tuple[np.ndarray, np.ndarray]:
    """Counts, ascending from 1, and for each a row of S(c, t + 1) / S(c, t), t = 1 .. MOST (0 from t = c on)."""
    t = np.arange(1, MOST + 1)
    row = np.zeros(MOST)
    counts, rows = [1.0], [row]
    goal = float(MOST)
    for c in range(1, EXACT):
        k = min(c, MOST)
        inverse = np.zeros(k)  # S(c, t - 1) / S(c, t)
        inverse[1:] = 1 / row[: k - 1]
        now = np.zeros(MOST)
        now[:k] = (1 + (c - d * (t[:k] + 1)) * row[:k]) / (inverse + c - d * t[:k])
        row = now
        if c < MOST or c + 1 >= goal:
            counts.append(c + 1.0)
            rows.append(row)
            goal = max(goal, (c + 1) * math.exp(STEP))
    if counts[-1] != EXACT:
        counts.append(float(EXACT))
        rows.append(row)
    past, c = row.tolist(), float(EXACT)
    while c < LARGEST:
        c *= math.exp(STEP)
        inverse = 0.0
        for i in range(MOST):
            h = STEP / (1 + (inverse - d * (i + 1)) / c)
            past[i] = (past[i] + h) / (1 + h * (d + inverse))
            inverse = 1 / past[i]
        counts.append(c)
        rows.append(np.array(past))
    return np.array(counts), np.array(rows)


def seat(dish: np.ndarray, customers: np.ndarray, parent: np.ndarray, other: np.ndarray, discount: float, strength: float, step: int) -> np.ndarray:
    """A number of tables for each dish (0 for one without customers).

    parent: the dish's probability there; other: tables of the restaurant's other dishes; discount in (0, 1).
    Random numbers are hashes of the dish and the step: who has the same figures draws the same tables.
    """
    tables = (customers > 0).astype(np.int64)
    some = np.flatnonzero(customers > 1)
    if not len(some):
        return tables
    counts, table = ratios(discount)
    c = customers[some].astype(np.float64)
    own, p = dish[some], parent[some]
    weight = strength + discount * other[some]
    low = np.minimum(c, MOST).astype(np.int64) - 1
    far = np.flatnonzero(c > MOST)
    low[far] = np.minimum(np.searchsorted(counts, c[far], side="right") - 1, len(counts) - 2)
    peak = far[table[low[far], MOST - 1] * (weight[far] + discount * MOST) * p[far] > 0.7]
    if len(peak):
        tables[some[peak]] = _peaked(own[peak], c[peak], weight[peak], p[peak], discount, step)
    near = c <= MOST
    tables[some[near]] = _walk(own[near], c[near], low[near], None, weight[near], p[near], discount, step, table)
    walk = np.setdiff1d(far, peak, assume_unique=True)
    share = np.log(c[walk] / counts[low[walk]]) / np.log(counts[low[walk] + 1] / counts[low[walk]])
    tables[some[walk]] = _walk(own[walk], c[walk], low[walk], share, weight[walk], p[walk], discount, step, table)
    return tables


def _walk(own, c, low, share, weight, p, d, step, table) -> np.ndarray:
    """One draw from the weights, t by t: of all tables so far the last is chosen with its share of the weights.
    low, share: the row of ratios, and how far towards the next."""
    out = chosen = np.ones(len(c), np.int64)
    place = np.arange(len(c))
    total = np.ones(len(c))  # of all weights so far, as a multiple of the last
    ratio = table.T.copy()
    for t in range(1, MOST):
        grown = ratio[t - 1][low]
        if share is not None:
            grown += share * (ratio[t - 1][low + 1] - grown)
        grown *= (weight + d * t) * p
        on = (c > t) & ((total < 1e7) | (grown > 0.5))  # else t + 1 weighs nothing any more
        n = np.count_nonzero(on)
        if not n:
            break
        if n < 0.7 * len(on):
            out[place] = chosen
            place, own, c, low, weight, p, total, grown = (x[on] for x in (place, own, c, low, weight, p, total, grown))
            chosen = out[place]
            share = share if share is None else share[on]
        with np.errstate(over="ignore"):
            total = 1 + total / np.maximum(grown, 1e-300)
        chosen[draw(own, step, t) * total < 1] = t + 1
    out[place] = chosen
    return out


def _peaked(own, c, weight, p, d, step) -> np.ndarray:
    """Where the weights peak beyond MOST: the peak from the saddle point of f(x) ** t, f(x) = (1 - (1 - x) ** d) / d,
    whose coefficients the Stirling numbers are; the width from how fast the ratio of weights falls there."""

    def at(y):  # log(1 - x) gives t and the log of the ratio of its weight to the one before
        f = -np.expm1(d * y) / d
        t = c * f / (-np.expm1(y) * np.exp((d - 1) * y))
        return t, np.log(f) - np.log(t + 0.5) + np.log((weight + d * t) * p)

    low, high = np.full(len(c), -700.0), np.full(len(c), -1e-9)
    for _ in range(60):
        y = (low + high) / 2
        falls = at(y)[1] > 0  # too few tables
        low, high = np.where(falls, y, low), np.where(falls, high, y)
    y = (low + high) / 2
    (t, a), (u, b) = at(y), at(y * (1 + 1e-4))
    width = np.sqrt(np.maximum((u - t) / np.where(a == b, -np.inf, a - b), 0))
    normal = np.sqrt(-2 * np.log(draw(own, step, 1))) * np.cos(2 * math.pi * draw(own, step, 2))
    # t is where the ratio of t to t - 1, taken half a table early, is 1: the peak is one and a half on.
    return np.clip(np.rint(t + 1.5 + width * normal), 1, c).astype(np.int64)
