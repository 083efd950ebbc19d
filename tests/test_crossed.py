"""Crossed fits on groups of many rows, where one step after another hardly moves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Row

from skillframe.models import mixed
from skillframe.models.design import Term
from skillframe.models.mixed import fit_crossed_logit
from skillframe.queries.balance import crossed_balance

GROUPS = ("a", "b")


def cells():
    """(group, other group, rows, wins): effects far smaller than the intercept, some thousand rows a group."""
    draw = random.Random(2)
    a, b, out = [draw.gauss(0, 0.03) for _ in range(12)], [draw.gauss(0, 0.1) for _ in range(4)], []
    for i in range(12):
        for j in range(4):
            n = 4000 if j == 0 else 1000
            out.append((f"a{i}", f"b{j}", n, round(n / (1 + math.exp(-(1.5 + a[i] + b[j] + draw.gauss(0, 0.02)))))))
    return out


@pytest.fixture(scope="module")
def many(spark):
    counted = spark.createDataFrame(cells(), "a string, b string, n int, wins int")
    return counted.selectExpr("a", "b", "explode(sequence(1, n)) AS k", "wins").selectExpr(
        "a", "b", "double(k <= wins) AS win", "1D AS one")


@pytest.fixture(scope="module")
def fit(many):
    return fit_crossed_logit(many, "win", Term("one"), GROUPS)


def test_fit_of_many_rows_ends_where_its_equations_hold(fit):
    assert mixed.PLAIN_ROUNDS < fit.rounds < 60
    rows = fit.effects.collect()
    effects = [{r["grp"]: r["condval"] for r in rows if r["grpvar"] == g} for g in GROUPS]
    assert [len(e) for e in effects] == [12, 4]
    rest, weight = [{}, {}], [{}, {}]
    for a, b, n, wins in cells():
        p = 1 / (1 + math.exp(-(fit.beta[""] + effects[0][a] + effects[1][b])))
        for i, g in enumerate((a, b)):
            rest[i][g] = rest[i].get(g, 0.0) + wins - n * p
            weight[i][g] = weight[i].get(g, 0.0) + n * p * (1 - p)
    assert abs(sum(rest[0].values())) < 0.1
    for i, g in enumerate(GROUPS):
        variance = fit.variances[g]
        for name, u in effects[i].items():
            step = (rest[i][name] - u / variance) / (weight[i][name] + 1 / variance)
            assert abs(step) < 1e-3 * variance**0.5
        free = sum(w / (w + 1 / variance) for w in weight[i].values())
        assert math.isclose(sum(u * u for u in effects[i].values()) / free, variance, rel_tol=1e-3)


def test_balance_of_many_rows_has_no_gaps(many, fit):
    gaps = crossed_balance(many, "win", Term("one"), GROUPS, fit).collect()
    assert len(gaps) == 12 + 4 + 2
    assert all(r["gap"] == 0 for r in gaps)
    assert {r["n"] for r in gaps if r["grp"] == "(variance)"} == {84000}


def test_joint_step_is_newtons_in_coefficients_and_both_shifts():
    rng, sizes, sigma, totals = np.random.default_rng(4), [5, 3], [0.4, 2.0], [0.7, -0.2]
    level, x = rng.integers(0, 3, 40), rng.normal(size=40) * (rng.random(40) < 0.8)
    score, weight = rng.normal(size=40), rng.random(40)
    x[level == 2] = 0.0  # a level without a coefficient
    columns = np.column_stack([x * (level == 0), x * (level == 1), np.ones(40), np.ones(40)])
    hessian = columns.T @ (columns * weight[:, None]) + np.diag([0, 0, *(n / s for n, s in zip(sizes, sigma))])
    wanted = np.linalg.solve(hessian, columns.T @ score - [0, 0, *(t / s for t, s in zip(totals, sigma))])
    slopes = [Row(s=float(sum((x * score)[level == k])), h=float(sum((x * x * weight)[level == k])), c=float(sum((x * weight)[level == k])),
                  score=float(sum(score[level == k])), weight=float(sum(weight[level == k]))) for k in range(3)]
    shifts = mixed._joint_step(slopes, totals, sizes, sigma)
    assert np.allclose(shifts, wanted[2:])
    assert np.allclose([(r["s"] - r["c"] * sum(shifts)) / r["h"] for r in slopes[:2]], wanted[:2])


def test_variance_without_effects_goes_to_the_floor():
    assert mixed._nearer(1e-6, 0.95e-6, -0.3) < 2e-8
    assert mixed._nearer(2e-8, 1e-8, 0.5) == mixed.VARIANCE_FLOOR
    assert math.isclose(mixed._nearer(0.5, 0.6, 1.0), 0.6)
