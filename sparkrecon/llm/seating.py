"""How many tables a dish has: exact draws for any number of customers.

c customers of one dish, with weight a for a new table and (size - d) for a table, sit at t tables with
a probability in proportion to a^t S(c, t), where S(n + 1, t) = (n - d t) S(n, t) + S(n, t - 1). This is
where moves of single customers end after very many sweeps; a draw from it re-seats all customers at
once, and its cost does not grow with them: up to ``TABULATED`` customers S is tabulated, beyond it is
c! / (t! d^t) times the coefficient of x^c in (1 - (1 - x)^d)^t, an integral around x = 1.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

TABULATED = 512
# Points on half of the contour; weights worked on together.
NODES, TOGETHER = 32, 1 << 18


@lru_cache(4)
def _tabulated(discount: float) -> np.ndarray:
    """log S(customers, tables)."""
    out = np.full((TABULATED + 1, TABULATED + 1), -np.inf)
    out[1, 1] = 0
    t = np.arange(1, TABULATED + 1)
    for n in range(1, TABULATED):
        stay = out[n, 1 : n + 1] + np.log(n - discount * t[:n])
        out[n + 1, 1 : n + 2] = np.logaddexp(np.append(stay, -np.inf), out[n, : n + 1])
    return out


def _log_empty(z: np.ndarray) -> np.ndarray:
    """log(1 - exp(-z)), also for z near 0 and for large z."""
    near = np.abs(z) < 0.7
    return np.where(near, np.log(-np.expm1(-np.where(near, z, 1))), np.log1p(-np.exp(-np.where(near, 1, z))))


def _mean_size(z: np.ndarray, d: float) -> np.ndarray:
    """Minus the slope of log(1 - (1 - exp(-z))^d)."""
    empty = _log_empty(z)
    return d * np.exp((d - 1) * empty - z) / -np.expm1(d * empty)


def _where_it_ends(above, n: int) -> np.ndarray:
    """The z up to which ``above`` holds."""
    low, high = np.full(n, -700.0), np.full(n, np.log(60.0))
    for _ in range(70):
        middle = (low + high) / 2
        up = above(np.exp(middle))
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return np.exp((low + high) / 2)


def _log_coefficient(c: int, t: np.ndarray, d: float) -> np.ndarray:
    """log of the coefficient of x^c in (1 - (1 - x)^d)^t. With x = exp(-z) it is an integral over z,
    taken on a parabola through the saddle point that opens around the cut, or, where the parabola
    would leave the strip of one period, on the line through the saddle point."""
    saddle = _where_it_ends(lambda z: t * _mean_size(z, d) > c, len(t))
    step = 1e-4 * saddle
    curve = np.maximum(t * (_mean_size(saddle - step, d) - _mean_size(saddle + step, d)) / (2 * step), 1e-300)
    least = math.pi * NODES / 12 / c
    tip = np.maximum(saddle, least)
    h = np.where(saddle > least, np.minimum(3 / NODES, 0.2 / (tip * np.sqrt(curve))), 3 / NODES)
    line = 2 * tip * h * NODES > 3
    k = np.arange(NODES + 1)
    u = 1 + 1j * k * h[:, None]
    z = np.where(line[:, None], saddle[:, None] + 1j * math.pi * k / NODES, tip[:, None] * u**2)
    width = np.where(line[:, None], math.pi / NODES, 2 * (tip * h)[:, None] * u)
    height = c * z + t[:, None] * np.log(-np.expm1(d * _log_empty(z)))
    top = height[:, 0].real
    parts = (np.exp(height - top[:, None]) * width).real
    parts[:, 0] /= 2
    parts[line, -1] /= 2
    # All tables of one customer: no saddle point.
    alone = t == c
    return np.where(alone, c * math.log(d), top + np.log(np.where(alone, 1, parts.sum(axis=1) / math.pi)))


def _many(c: int, a: float, d: float) -> tuple[int, np.ndarray]:
    """(least tables, log weight of so many and of each further table) for many customers: where the
    weights are, ten standard deviations to both sides and more. The tables are a sum of independent
    choices, so their variance is below their mean."""
    z = _where_it_ends(lambda z: math.log(a / c) + (d - 1) * _log_empty(z) - z > 0, 1)
    mean = a / d * -np.expm1(d * _log_empty(z))[0]
    around = 10 * math.sqrt(mean) + 30
    least = max(1, min(c, int(mean - around)))
    t = np.arange(least, min(c, int(mean + around) + 1) + 1, dtype=float)
    fewer = np.concatenate([[0], np.cumsum(np.log(t[1:]))])
    return least, t * math.log(a / d) - fewer + _log_coefficient(c, t, d)


def _drawn(weight: np.ndarray, start: np.ndarray, count: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Per group of ``count`` log weights from ``start`` on, the place drawn."""
    top = np.maximum.reduceat(weight, start)
    upto = np.cumsum(np.exp(weight - np.repeat(top, count)))
    before = np.where(start > 0, upto[start - 1], 0)
    at = np.searchsorted(upto, before + u * (upto[start + count - 1] - before), side="right")
    return np.clip(at - start, 0, count - 1)


def table_counts(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """The tables of each dish, drawn anew for all its customers. ``fresh`` is the weight of a new table."""
    tables = np.minimum(customers, 1).astype(np.int64)
    u = rng.random(len(customers))
    few = np.flatnonzero((customers > 1) & (customers <= TABULATED))
    many = np.flatnonzero(customers > TABULATED)
    if len(few):
        log_s = _tabulated(discount)
        cuts = np.flatnonzero(np.diff(np.cumsum(customers[few]) // TOGETHER)) + 1
        for some in np.split(few, cuts):
            count = customers[some]
            start = np.cumsum(count) - count
            t = np.arange(count.sum()) - np.repeat(start, count) + 1
            weight = t * np.repeat(np.log(fresh[some]), count) + log_s[np.repeat(count, count), t]
            tables[some] += _drawn(weight, start, count, u[some])
    for i in many:
        least, weight = _many(int(customers[i]), float(fresh[i]), discount)
        tables[i] = least + _drawn(weight, np.array([0]), np.array([len(weight)]), u[i : i + 1])[0]
    return tables
