import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillframe.models.design import Term, gramian, independent
from skillframe.models.glm import coef_band, fit_logit, fit_logit_by, load_fit, score_link, score_map_advantage
from skillframe.models.mixed import fit_crossed_logit
from skillframe.models.ridge import best_lambda, ridge_cv, ridge_fit


def toy(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind, year = rng.choice(["CONTROL", "HYBRID"]), rng.choice(["2018", "2019"])
        flag, deaths = rng.choice([-1.0, 1.0]), float(rng.randint(0, 9))
        chance = 1 / (1 + math.exp(-(0.4 * flag * (kind == "HYBRID") + 0.3 * (4.5 - deaths))))
        rows.append((i, float(rng.random() < chance), kind, year, flag, deaths, 1.0))
    rows.append((n, 1.0, None, "2018", 1.0, 2.0, 1.0))
    return spark.createDataFrame(rows, "i int, win double, map_type string, year string, flag double, deaths double, one double")


TERMS = [Term("map_type", "flag"), Term("deaths", "year"), Term("one")]


def test_score_equations_hold(spark):
    df = toy(spark)
    fit = fit_logit(df, "win", TERMS)
    names = [r[0] for r in fit.rows]
    assert names == ["map_typeCONTROL:flag", "map_typeHYBRID:flag", "deaths:year2018", "deaths:year2019", "one"]
    scored = score_link(df.dropna(), fit, TERMS, "eta").withColumn("rest", F.col("win") - 1 / (1 + F.exp(-F.col("eta"))))
    sums = scored.agg(
        F.sum(F.when(F.col("map_type") == "HYBRID", F.col("rest") * F.col("flag"))),
        F.sum(F.when(F.col("year") == "2019", F.col("rest") * F.col("deaths"))),
        F.sum("rest"),
    ).first()
    assert all(abs(s) < 1e-5 for s in sums)
    collapsed = fit_logit(df, "win", TERMS, collapse=True)
    assert np.allclose([r[1:] for r in fit.rows], [r[1:] for r in collapsed.rows], atol=1e-6)


def test_missing_and_unknown_values_have_no_score(spark):
    df = toy(spark)
    fit = fit_logit(df, "win", TERMS)
    odd = spark.createDataFrame(
        [(1, "HYBRID", "2018", 1.0, 2.0, 1.0), (2, "OTHER", "2018", 1.0, 2.0, 1.0), (3, None, "2018", 1.0, 2.0, 1.0),
         (4, "HYBRID", "2018", 1.0, None, 1.0)],
        "i int, map_type string, year string, flag double, deaths double, one double",
    )
    got = {r["i"]: r["s"] for r in score_link(odd, fit, TERMS, "s").collect()}
    assert got[1] is not None and got[2] is got[3] is got[4] is None


def test_dependent_columns_get_no_estimate(spark):
    df = toy(spark).withColumn("twice", F.col("deaths") * 2).withColumn("zero", F.lit(0.0))
    fit = fit_logit(df, "win", [Term("deaths"), Term("twice"), Term("zero"), Term("one")])
    assert [r[0] for r in fit.rows if r[1] is None] == ["twice", "zero"]
    assert independent(gramian(df, ["deaths", "twice", "one"])) == [0, 2]


def test_one_factor_closed_form(spark):
    df = spark.createDataFrame([("g", 1.0)] * 3 + [("g", 0.0)] + [("h", 1.0), ("h", 0.0)], "k string, win double").withColumn("one", F.lit(1.0))
    rows = {r[0]: r for r in fit_logit(df, "win", [Term("k", "one")]).rows}
    assert rows["kg:one"][1] == pytest.approx(math.log(3), abs=1e-6)
    assert rows["kg:one"][2] == pytest.approx(1 / math.sqrt(4 * 0.75 * 0.25), abs=1e-5)
    assert rows["kh:one"][1] == pytest.approx(0, abs=1e-9)


def test_constant_alone(spark):
    df = spark.createDataFrame([(1.0,)] * 3 + [(0.0,)], "win double").withColumn("half", F.lit(0.5))
    (row,) = fit_logit(df, "win", [Term("half")]).rows
    assert row[1:4] == pytest.approx((2 * math.log(3), 2 / math.sqrt(0.75), math.log(3) * math.sqrt(0.75)), abs=1e-5)


def test_fits_by_group_equal_separate_fits(spark):
    df = toy(spark)
    terms = [Term("map_type", "flag"), Term("deaths"), Term("one")]
    both = {(r["year"], r["term"]): (r["estimate"], r["std_error"]) for r in fit_logit_by(df, "win", terms, "year").collect()}
    for year in ("2018", "2019"):
        for r in fit_logit(df.where(F.col("year") == year), "win", terms).rows:
            assert both[year, r[0]] == pytest.approx(r[1:3], abs=1e-5)
    band = coef_band(fit_logit_by(df, "win", terms, "year"), "deaths").where("year = '2018'").first()
    assert band["upper"] - band["estimate"] == pytest.approx(both["2018", "deaths"][1], abs=1e-6)


def test_map_advantage(spark):
    terms = [Term("map_type", "flag"), Term("deaths")]
    df = toy(spark).dropna()
    fit = fit_logit(df, "win", terms)
    hybrid = {r[0]: r[1] for r in fit.rows}["map_typeHYBRID:flag"]
    got = score_map_advantage(df, fit, terms, ["deaths"], F.col("map_type") == "CONTROL", "adv")
    for r in got.select("map_type", "flag", "adv").distinct().collect():
        assert r["adv"] == pytest.approx(0 if r["map_type"] == "CONTROL" else hybrid * r["flag"])


def test_fit_survives_the_disk(spark, tmp_path):
    df = toy(spark)
    fit = fit_logit(df, "win", TERMS)
    fit.save(spark, str(tmp_path / "m"))
    again = load_fit(spark, str(tmp_path / "m"))
    assert again.converged == fit.converged
    fit.converged = False
    fit.save(spark, str(tmp_path / "open"))
    assert not load_fit(spark, str(tmp_path / "open")).converged
    assert sorted(again.rows) == sorted(fit.rows)
    assert again.model.coefficients.toArray().tolist() == fit.model.coefficients.toArray().tolist()


def duels(spark, maps=400, teams=14, seed=2):
    rng = random.Random(seed)
    true = {f"g{k}": rng.gauss(0, 1) for k in range(teams)}
    rows = []
    for _ in range(maps):
        a, b = rng.sample(sorted(true), 2)
        flag = rng.choice([-1.0, 1.0])
        win = float(rng.random() < 1 / (1 + math.exp(-(true[a] - true[b] + 0.3 * flag))))
        rows += [(a, b, "HYBRID", flag, win), (b, a, "HYBRID", -flag, 1 - win)]
    return true, rows, spark.createDataFrame(rows, "lineup string, opponent string, map_type string, flag double, win double")


def test_crossed_effects_are_stationary_and_mirrored(spark):
    true, rows, df = duels(spark)
    fit = fit_crossed_logit(df, "win", Term("map_type", "flag"), ("lineup", "opponent"), {"lineup": 0.5, "opponent": 0.5}, tol=1e-5)
    eff = {(r["grpvar"], r["grp"]): r["condval"] for r in fit.effects.collect()}
    u, v, beta = ({k[1]: e for k, e in eff.items() if k[0] == g} for g in ("lineup", "opponent")), None, fit.beta["HYBRID"]
    u, v = u
    rest = [(a, b, f, w - 1 / (1 + math.exp(-(beta * f + u[a] + v[b])))) for a, b, _, f, w in rows]
    assert abs(sum(f * r for _, _, f, r in rest)) < 1e-3
    for g in true:
        assert abs(sum(r for a, _, _, r in rest if a == g) - u[g] / 0.5) < 1e-3
        assert abs(sum(r for _, b, _, r in rest if b == g) - v[g] / 0.5) < 1e-3
        assert abs(u[g] + v[g]) < 1e-4
    assert np.corrcoef([true[g] for g in true], [u[g] for g in true])[0, 1] > 0.9


def test_crossed_fit_fails_loudly(spark):
    _, _, df = duels(spark, maps=60)
    with pytest.raises(RuntimeError):
        fit_crossed_logit(df, "win", Term("map_type", "flag"), ("lineup", "opponent"), max_rounds=1, tol=1e-9)


def memberships(spark, groups=60, people=9, seed=3):
    rng = np.random.default_rng(seed)
    x = np.zeros((groups, people))
    for row in x:
        row[rng.choice(people, 3, replace=False)] = 1
    y = x @ rng.normal(size=people) + rng.normal(size=groups) * 0.3
    w = rng.integers(1, 6, groups).astype(float)
    members = [(f"l{i}", f"r{j}") for i, j in zip(*np.nonzero(x))]
    targets = [(f"l{i}", float(y[i]), float(w[i])) for i in range(groups)]
    return x, y, w, spark.createDataFrame(members, "l string, r string"), spark.createDataFrame(targets, "l string, y double, w double")


def brute(x, y, w, lam, scaled):
    w = w / w.sum()
    s2 = w @ x**2 - (w @ x) ** 2
    used = s2 > 1e-12
    if scaled:
        lam = lam / math.sqrt(w @ y**2 - (w @ y) ** 2)
    b = np.zeros(x.shape[1])
    xs = x[:, used]
    b[used] = np.linalg.solve(xs.T @ (xs * w[:, None]) + lam * np.diag(s2[used]), xs.T @ (w * y))
    return b


@pytest.mark.parametrize("scale", ["none", "response_sd"])
def test_ridge_both_ways_equal_brute_force(spark, scale):
    x, y, w, members, targets = memberships(spark)
    want = brute(x, y, w, 0.3, scale == "response_sd")
    dense = {r["member"]: r["estimate"] for r in ridge_fit(members, targets, 0.3, scale).collect()}
    assert np.allclose([dense[f"r{j}"] for j in range(len(want))], want, atol=1e-9)
    if scale == "none":
        large = {r["member"]: r["estimate"] for r in ridge_fit(members, targets, 0.3, scale, max_dense=2).collect()}
        assert np.allclose([large[f"r{j}"] for j in range(len(want))], want, atol=1e-6)


def test_cross_validation_equals_brute_force(spark):
    x, y, w, members, targets = memberships(spark, groups=24, people=5)
    lambdas, folds = [1.0, 0.1], 2
    fold = np.arange(24) % folds
    by_number = F.substring("id", 2, 9).cast("int") % folds
    want = []
    for lam in lambdas:
        error = 0.0
        for k in range(folds):
            b = brute(x[fold != k], y[fold != k], w[fold != k], lam, False)
            error += w[fold == k] @ (y[fold == k] - x[fold == k] @ b) ** 2
        want.append(error / w.sum())
    for dense in (100, 2):
        curve = ridge_cv(members, targets, lambdas, folds, fold=by_number, max_dense=dense)
        got = [r["cv_error"] for r in curve.orderBy(F.desc("lambda")).collect()]
        assert np.allclose(got, want, atol=1e-6)
        assert best_lambda(curve) == lambdas[int(np.argmin(want))]


def test_one_hot_ridge(spark):
    members = spark.createDataFrame([("a", "p"), ("b", "q")], "l string, r string")
    targets = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 2.0), ("b", 5.0, 4.0)], "l string, y double, w double")
    got = {r["member"]: r["estimate"] for r in ridge_fit(members, targets, 2.0).collect()}
    # shares 1/2 and variances 1/4: b = (mean y * 1/2) / (1/2 + 2 * 1/4)
    assert got == pytest.approx({"p": 1.0, "q": 2.5})
