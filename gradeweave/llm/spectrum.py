"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

An LDL' factorization of A - s counts the eigenvalues below s: by Sylvester's law the signs of D's
blocks are those of A - s. Bisection on the counts isolates the wanted eigenvalue between two
shifts, Rayleigh quotient iteration converges cubically to its pair, and two more counts, just
under and just over the value found, certify its number. Where a neighbour outside the interval drew
the iteration to itself, the interval is halved and it starts again. Equal or nearly equal eigenvalues cannot
be isolated; they share a certified interval, and their vectors are an orthonormal basis of its space.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
#: Of Bunch and Parlett: keeps the growth of 1 x 1 and 2 x 2 pivots equal.
_PIVOT = (1 + 17**0.5) / 8
#: Times an interval is halved before the iteration starts again.
NARROWER = 3


def count_below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are less than ``shift``."""
    m = a - shift * np.eye(len(a))
    small = _EPS * max(np.abs(m).max(initial=0), np.finfo(float).tiny)
    negative = 0
    while len(m):
        diagonal = np.abs(np.diagonal(m))
        one = int(diagonal.argmax())
        off = np.abs(m)
        np.fill_diagonal(off, 0)
        two = divmod(int(off.argmax()), len(m))
        if diagonal[one] <= small and off[two] <= small:
            break  # zeros to rounding: none of these is below
        if diagonal[one] >= _PIVOT * off[two]:
            at = [one]
            negative += m[one, one] < 0
        else:
            at = list(two)
            negative += 1  # such a block has one eigenvalue of each sign
        rest = np.delete(np.arange(len(m)), at)
        c = m[np.ix_(rest, at)]
        m = m[np.ix_(rest, rest)] - c @ np.linalg.solve(m[np.ix_(at, at)], c.T)
        m = (m + m.T) / 2
    return negative


def _quotient(a: np.ndarray, v: np.ndarray) -> float:
    return float(v @ (a @ v))


def _solved(a: np.ndarray, shift: float, v: np.ndarray, scale: float) -> np.ndarray:
    m = a - shift * np.eye(len(a))
    try:
        w = np.linalg.solve(m, v)
    except np.linalg.LinAlgError:
        w = np.linalg.solve(m + _EPS * scale * np.eye(len(a)), v)
    return w / np.linalg.norm(w) if np.isfinite(w).all() else v


def _outside(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for u in found:
            v = v - (u @ v) * u
    return v / np.linalg.norm(v)


def _pair(a: np.ndarray, low: float, high: float, found: list[np.ndarray], scale: float, rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """An eigenpair with its value in the interval, orthogonal to those found."""
    v = _outside(rng.standard_normal(len(a)), found)
    for _ in range(4):
        v = _outside(_solved(a, (low + high) / 2, v, scale), found)
    best = (np.inf, 0.0, v)
    for _ in range(30):
        value = _quotient(a, v)
        miss = float(np.linalg.norm(a @ v - value * v))
        if miss < best[0]:
            best = (miss, value, v)
        if miss <= 4 * _EPS * scale:
            break
        v = _outside(_solved(a, value if low <= value <= high else (low + high) / 2, v, scale), found)
    return best[1], best[2]


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit eigenvectors as rows; the greatest entry of each is positive."""
    n = len(a)
    wanted = min(wanted, n)
    scale = float(np.abs(a).sum(axis=1).max(initial=0))
    if not scale:
        return np.zeros(wanted), np.eye(n)[:wanted]
    rng = np.random.default_rng(11)
    tiny = 64 * n * _EPS * scale
    values, vectors = [], []
    counts = {-scale - tiny: 0, scale + tiny: n}  # Gershgorin: all lie between

    def halved(low: float, high: float, number: int) -> tuple[float, float]:
        middle = (low + high) / 2
        counts[middle] = count_below(a, middle)
        return (middle, high) if counts[middle] < number else (low, middle)

    def certified(value: float, number: int) -> bool:
        return count_below(a, value - tiny) < number <= count_below(a, value + tiny)

    while len(values) < wanted:
        number = n - len(values)  # counted from below
        low, high = max(s for s, c in counts.items() if c < number), min(s for s, c in counts.items() if c >= number)
        # a wide gap around the one eigenvalue makes the iteration's start a good one
        while (counts[high] - counts[low] > 1 or counts[high] != number or high - low > 0.05 * max(abs(low), abs(high))) and high - low > tiny:
            low, high = halved(low, high, number)
        together = max(counts[high] - counts[low], 1) if high - low <= tiny else 1
        for _ in range(min(together, wanted - len(values))):
            number = n - len(values)
            value, vector = _pair(a, low, high, vectors, scale, rng)
            while not certified(value, number) and high - low > tiny:
                # an eigenvalue just outside drew the iteration to itself: start nearer to the one inside
                for _ in range(NARROWER):
                    low, high = halved(low, high, number)
                value, vector = _pair(a, low, high, vectors, scale, rng)
            if not certified(value, number):
                raise ArithmeticError(f"eigenvalue {value} is not number {n - number + 1}")
            vector = _outside(vector, vectors)
            values.append(value)
            vectors.append(vector * np.sign(vector[np.abs(vector).argmax()]))
            counts[value - tiny] = count_below(a, value - tiny)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.stack(vectors)[order]
