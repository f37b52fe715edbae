"""Closed forms and plans over a few numbers, in plain Python: they run on the driver, once."""

from __future__ import annotations

import math


def decile_ks(a: list[float], b: list[float]) -> float:
    """Largest gap of the two piecewise-linear distribution functions through 11 deciles each."""

    def cdf(points: list[float], x: float) -> float:
        if x < points[0]:
            return 0.0
        if x >= points[-1]:
            return 1.0
        for i in range(len(points) - 1, 0, -1):
            if points[i - 1] <= x < points[i]:
                return (i - 1 + (x - points[i - 1]) / (points[i] - points[i - 1])) / (len(points) - 1)
        return 1.0

    return max(abs(cdf(a, x) - cdf(b, x)) for x in {*a, *b})


def water_fill(wants: list[float], budget: float) -> list[float]:
    """Shares of a budget: smallest wishes first, each gets its wish or an equal part of what is left."""
    out, left, open_ = [0.0] * len(wants), budget, sorted(range(len(wants)), key=lambda i: wants[i])
    while open_:
        share = left / len(open_)
        i = open_[0]
        if wants[i] > share:
            for j in open_:
                out[j] = share
            return out
        out[i] = wants[i]
        left -= wants[i]
        open_.pop(0)
    return out


def fit_joint(rows: list[tuple], margins: list[dict], sweeps: int = 16, floor: float = 1e-9) -> list[float]:
    """Weights of key tuples whose column sums follow the given marginal shares (iterative proportional fitting)."""
    weights = [1.0 / len(rows)] * len(rows) if rows else []
    for _ in range(sweeps):
        for at, margin in enumerate(margins):
            sums: dict = {}
            for r, w in zip(rows, weights, strict=True):
                sums[r[at]] = sums.get(r[at], 0.0) + w
            weights = [w * max(margin.get(r[at], 0.0), floor) / sums[r[at]] for r, w in zip(rows, weights, strict=True)]
        total = sum(weights)
        weights = [w / total for w in weights]
    return weights


def _beta_cf(a: float, b: float, x: float) -> float:
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / (c if abs(c) > tiny else tiny)
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def beta_cdf(x: float, a: float, b: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_cf(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_cf(b, a, 1 - x) / b


def beta_quantile(p: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if beta_cdf(mid, a, b) < p else (low, mid)
    return (low + high) / 2


def clopper_pearson(k: int, n: int, alpha: float = 0.05) -> tuple[float, float]:
    """Exact bounds of a share of k in n."""
    return (beta_quantile(alpha / 2, k, n - k + 1) if k else 0.0), (beta_quantile(1 - alpha / 2, k + 1, n - k) if k < n else 1.0)


def rate_ratio(k1: int, n1: int, k2: int, n2: int, alpha: float = 0.05) -> tuple[float, float]:
    """Bounds of (k1 / n1) / (k2 / n2), conditional on k1 + k2."""
    low, high = clopper_pearson(k1, k1 + k2, alpha)
    odds = lambda p: math.inf if p >= 1 else p / (1 - p)
    return odds(low) * n2 / n1, odds(high) * n2 / n1


def tvd_null(p: list[float], n: int, m: int) -> float:
    """Expected total variation distance of two samples of n and m from one distribution (normal approximation)."""
    return sum(math.sqrt(2 / math.pi * q * (1 - q) * (1 / n + 1 / m)) for q in p) / 2


def mutual_information_bias(rows: int, columns: int, n: int) -> float:
    return (rows - 1) * (columns - 1) / (2 * n)


def k_center(vectors: list[list[float]], k: int, start: int = 0) -> list[int]:
    """Farthest-first selection of k of a few vectors."""
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    chosen = [start % len(vectors)] if vectors else []
    near = [distance(v, vectors[chosen[0]]) for v in vectors] if vectors else []
    while len(chosen) < min(k, len(vectors)):
        chosen.append(max(range(len(vectors)), key=lambda i: (near[i], -i)))
        near = [min(d, distance(v, vectors[chosen[-1]])) for d, v in zip(near, vectors, strict=True)]
    return chosen


def projected_rows(roots: dict[str, int], edges: list[tuple[str, str, float]], order: list[str]) -> dict[str, int]:
    """Rows of each table: a root's as asked, a child's as its driving parent's times the mean fan-out."""
    out = dict(roots)
    driving = {c: (p, mean) for c, p, mean in edges}
    for t in order:
        if t in driving:
            p, mean = driving[t]
            out[t] = round(out[p] * mean)
    return out


def preflight(columns: list[str], pk: list[str], identity: list[str], edges: list[tuple[list[str], list[str]]], parent_columns: list[str], rows: int, capacity: int | None) -> list[str]:
    """What would make a run fail, before it starts."""
    out = [f"P1 key column {c} is missing" for c in pk if c not in columns]
    out += [f"P2 identity column {c} is missing" for c in identity if c not in columns]
    out += [f"P3 foreign key column {c} is missing" for own, _ in edges for c in own if c not in columns]
    out += [f"P4 parent column {c} is missing" for _, theirs in edges for c in theirs if c not in parent_columns]
    if capacity is not None and rows > capacity:
        out.append(f"P5 {rows} rows are asked for, but the key has {capacity} values")
    return out
