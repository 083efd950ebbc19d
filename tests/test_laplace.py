"""Laplace fits of two crossed random intercepts against the dense likelihood in numpy."""

import math
import random

import numpy as np
import pytest

from skillframe.models import laplace
from skillframe.models.design import Term

SCHEMA = "a string, b string, k string, f double, win double"


def games(n, qa, qb, sa, sb, seed):
    draw = random.Random(seed)
    a, b = [draw.gauss(0, sa) for _ in range(qa)], [draw.gauss(0, sb) for _ in range(qb)]
    rows = []
    for _ in range(n):
        i, j = min(int(draw.expovariate(4 / qa)), qa - 1), draw.randrange(qb)  # a few hot groups
        f, k = draw.choice([-1.0, 1.0]), draw.choice("AB")
        rows.append((f"a{i}", f"b{j}", k, f, float(draw.random() < 1 / (1 + math.exp(-((0.5 if k == "A" else -0.2) * f + a[i] + b[j]))))))
    return rows


class Dense:
    """Minus twice the approximate log-likelihood at (log variances, coefficients), with all of H."""

    def __init__(self, rows):
        self.names = [sorted({r[c] for r in rows}) for c in (0, 1)]
        kinds, (qa, qb) = sorted({r[2] for r in rows}), map(len, self.names)
        self.z, self.x = np.zeros((len(rows), qa + qb)), np.zeros((len(rows), len(kinds)))
        for t, r in enumerate(rows):
            self.z[t, self.names[0].index(r[0])] = self.z[t, qa + self.names[1].index(r[1])] = 1
            self.x[t, kinds.index(r[2])] = r[3]
        self.y, self.sizes, self.u = np.array([r[4] for r in rows]), (qa, qb), np.zeros(qa + qb)

    def __call__(self, at):
        s, fixed = np.repeat(np.exp(at[:2]), self.sizes), self.x @ at[2:]
        for _ in range(200):
            p = 1 / (1 + np.exp(-(fixed + self.z @ self.u)))
            self.h = (self.z * (p * (1 - p))[:, None]).T @ self.z + np.diag(1 / s)
            step = np.linalg.solve(self.h, self.z.T @ (self.y - p) - self.u / s)
            self.u = self.u + np.clip(step, -2, 2)
            if abs(step).max() < 1e-11:
                break
        eta = fixed + self.z @ self.u
        return (-2 * np.sum(self.y * eta - np.logaddexp(0, eta)) + np.sum(self.u**2 / s) + np.sum(np.log(s)) + np.linalg.slogdet(self.h)[1])

    def least(self):
        at = np.zeros(2 + self.x.shape[1])
        unit = np.eye(len(at)) * 1e-3
        for _ in range(80):
            here = self(at)
            up, down = [self(at + e) for e in unit], [self(at - e) for e in unit]
            slope = (np.array(up) - down) / 2e-3
            bend = np.diag((np.array(up) - 2 * here + down) / 1e-6)
            for i in range(len(at)):
                for j in range(i):
                    bend[i, j] = bend[j, i] = (self(at + unit[i] + unit[j]) - up[i] - up[j] + 2 * here - down[i] - down[j] + self(at - unit[i] - unit[j])) / 2e-6
            value, turn = np.linalg.eigh(bend)
            step = np.clip(-turn @ ((turn.T @ slope) / np.maximum(abs(value), 1e-2)), -1, 1)
            while self(at + step) > here + 1e-9 and abs(step).max() > 1e-6:
                step = step / 2
            at = at + step
            if abs(step).max() < 1e-5:
                break
        self(at)
        return at


def test_variances_equal_the_dense_likelihood(spark, monkeypatch):
    """With 16 probes for 28 groups: noise, but little."""
    monkeypatch.setattr(laplace, "PROBES", 16)
    close, rows = 0.05, games(700, 16, 12, 1.0, 0.6, 2)
    dense = Dense(rows)
    want = dense.least()
    df = spark.createDataFrame([*rows, (None, "b0", "A", 1.0, 1.0)], SCHEMA)
    fit = laplace.fit_crossed_laplace(df, "win", Term("k", "f"), ("a", "b"))
    assert [fit.variances["a"], fit.variances["b"]] == pytest.approx(np.exp(want[:2]), rel=close)
    assert [fit.beta["A"], fit.beta["B"]] == pytest.approx(want[2:], abs=0.01)
    effects = {(r["grpvar"], r["grp"]): r for r in fit.effects.collect()}
    named = [("a", x) for x in dense.names[0]] + [("b", x) for x in dense.names[1]]
    assert [effects[k]["condval"] for k in named] == pytest.approx(dense.u, abs=0.03)
    assert np.mean([effects[k]["condsd"] for k in named]) == pytest.approx(np.mean(np.sqrt(np.diag(np.linalg.inv(dense.h)))), rel=close)


def test_a_fit_that_does_not_converge_says_so(spark):
    with pytest.raises(RuntimeError, match="no convergence"):
        laplace.fit_crossed_laplace(spark.createDataFrame(games(60, 4, 3, 1.0, 1.0, 1), SCHEMA), "win", Term("k", "f"), ("a", "b"), tol=1e-9, max_rounds=1)
