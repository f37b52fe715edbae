from __future__ import annotations

import math

import pytest

from tabspark.operators import planning as P


def test_beta_and_intervals():
    assert P.beta_cdf(0.5, 2, 2) == pytest.approx(0.5)
    assert P.beta_cdf(0.3, 1, 5) == pytest.approx(1 - 0.7**5)
    low, high = P.clopper_pearson(8, 20)
    tail = lambda p, ks: sum(math.comb(20, k) * p**k * (1 - p) ** (20 - k) for k in ks)
    assert tail(low, range(8, 21)) == pytest.approx(0.025) and tail(high, range(9)) == pytest.approx(0.025)
    assert P.clopper_pearson(0, 5)[0] == 0 and P.clopper_pearson(5, 5)[1] == 1
    low, high = P.rate_ratio(30, 100, 10, 100)
    assert low < 3 < high and P.rate_ratio(3, 10, 0, 10)[1] == math.inf


def test_distances_and_entropy():
    d = [float(i) for i in range(11)]
    assert P.decile_ks(d, d) == 0 and P.decile_ks(d, [x + 100 for x in d]) == 1
    assert P.decile_ks(d, [x + 1 for x in d]) == pytest.approx(0.1)
    assert P.tvd_null([0.5, 0.5], 100, 100) == pytest.approx(math.sqrt(2 / math.pi * 0.25 * 0.02))
    assert P.mutual_information_bias(3, 4, 100) == 0.03


def test_allocation_and_fitting():
    assert P.water_fill([1, 5, 10], 9) == [1, 4, 4] and P.water_fill([1, 2], 9) == [1, 2] and P.water_fill([], 1) == []
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    w = P.fit_joint(rows, [{"a": 0.7, "b": 0.3}, {1: 0.4, 2: 0.6}])
    assert sum(x for r, x in zip(rows, w) if r[0] == "a") == pytest.approx(0.7, abs=1e-6)
    assert sum(x for r, x in zip(rows, w) if r[1] == 1) == pytest.approx(0.4, abs=1e-6)


def test_plans():
    assert P.k_center([[0.0], [1.0], [10.0], [9.0]], 3) == [0, 2, 1] or P.k_center([[0.0], [1.0], [10.0], [9.0]], 3) == [0, 2, 3]
    assert P.projected_rows({"a": 10}, [("b", "a", 2.5), ("c", "b", 2.0)], ["a", "b", "c"]) == {"a": 10, "b": 25, "c": 50}
    assert P.preflight(["id"], ["id"], ["mail"], [(["x"], ["y"])], ["y"], 10, 5) == ["P2 identity column mail is missing", "P3 foreign key column x is missing", "P5 10 rows are asked for, but the key has 5 values"]
