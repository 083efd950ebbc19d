"""Logistic fits with a text column of many values, against the dense fit and closed forms."""

import math
import random

import pytest

from skillframe.models.design import Term
from skillframe.models.glm import fit_logit
from skillframe.models.wide import fit_logit_wide


@pytest.fixture(scope="module")
def frame(spark):
    rng, rows = random.Random(3), []
    for k in range(900):
        team, side, x = f"t{rng.randrange(12)}" if k % 3 else "t0", rng.choice("ab"), rng.gauss(0, 1)
        p = 1 / (1 + math.exp(-(0.1 * (hash_of(team) % 7 - 3) + 0.5 * x + (0.4 if side == "a" else 0))))
        rows.append((int(rng.random() < p), team, side, x, 2 * x, 1.0))
    rows += [(None, "t1", "a", 0.0, 0.0, 1.0), (1, None, "a", 0.0, 0.0, 1.0), (1, "t1", None, 0.0, 0.0, 1.0), (1, "t1", "b", None, 0.0, 1.0)]
    return spark.createDataFrame(rows, "y int, team string, side string, x double, twice double, one double")


def hash_of(text):
    return sum(map(ord, text))


def by_term(df):
    return {r["term"]: (r["estimate"], r["std_error"], r["p_value"]) for r in df.collect()}


@pytest.mark.parametrize("collapse", [False, True])
def test_equals_the_dense_fit_where_both_can_run(spark, frame, collapse):
    terms = [Term("one", "team"), Term("x"), Term("one", "side"), Term("twice"), Term("team", "x")]
    narrow_last = [Term("one", "team"), Term("team", "x"), Term("x"), Term("one", "side"), Term("twice")]
    got = by_term(fit_logit_wide(frame, "y", terms, "team", collapse))
    want = by_term(fit_logit(frame, "y", narrow_last).coef_df(spark))
    assert set(got) == set(want)
    assert [t for t in got if got[t][0] is None] == [t for t in got if want[t][0] is None]
    assert {t for t in got if got[t][0] is None} == {"x", "one:sideb", "twice"}  # x is the sum of team:x
    for t, values in want.items():
        if values[0] is not None:
            assert got[t] == pytest.approx(values, abs=1e-5), t


def test_narrow_columns_that_do_not_depend_keep_their_estimates(spark, frame):
    terms = [Term("one", "team"), Term("x"), Term("x", "side")]
    got, want = by_term(fit_logit_wide(frame, "y", terms, "team")), by_term(fit_logit(frame, "y", terms).coef_df(spark))
    assert got["x"][0] is not None and got["x:sideb"][0] is None
    for t, values in want.items():
        assert got[t] == (values if values[0] is None else pytest.approx(values, abs=1e-5)), t


def test_more_values_than_a_dense_design_can_hold(spark):
    rows = spark.range(5000 * 4).selectExpr("concat('g', id % 5000) AS g", "1D AS one", "int(id < 5000 * (1 + id % 3)) AS y")
    got = fit_logit_wide(rows, "y", [Term("one", "g")], "g", collapse=True)
    assert got.count() == 5000 and got.where("NOT converged").count() == 0
    want = {r["g"]: r["p"] for r in rows.groupBy("g").agg({"y": "avg"}).withColumnRenamed("avg(y)", "p").collect()}
    inner = {r["term"][5:]: r for r in got.collect() if 0 < want[r["term"][5:]] < 1}
    assert len(inner) > 1000
    for g, r in inner.items():
        p = want[g]
        assert r["estimate"] == pytest.approx(math.log(p / (1 - p)), abs=1e-6)
        assert r["std_error"] == pytest.approx(1 / math.sqrt(4 * p * (1 - p)), abs=1e-5)


def test_no_rows_and_wrong_terms(spark, frame):
    assert fit_logit_wide(frame.where("x IS NULL"), "y", [Term("one", "team"), Term("x")], "team").collect() == []
    with pytest.raises(ValueError, match="no term"):
        fit_logit_wide(frame, "y", [Term("x")], "team")
