"""Logistic fits of many groups against closed forms, dense fits and the one-fit solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillframe.models.design import Term
from skillframe.models.glm import fit_logit_by
from skillframe.models.grouped import fit_logit_groups


def test_ten_thousand_groups_have_their_closed_form(spark):
    """Each group holds two cells of a text value; a cell's estimate is the log-odds of its share."""
    cells = spark.range(20_000).selectExpr("id DIV 2 AS g", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS side", "int(1 + id % 7) AS ones", "int(2 + id % 5) AS zeros")
    rows = cells.selectExpr("g", "side", "1 AS one", "explode(concat(array_repeat(1, ones), array_repeat(0, zeros))) AS y")
    got = fit_logit_groups(rows, "y", [Term("one", "side")], "g", collapse=True).join(cells.withColumnRenamed("side", "s"), ["g"])
    got = got.where("term = 'one:side' || s")
    gap = got.agg(F.count("*").alias("n"), F.max(F.expr("abs(estimate - ln(ones / zeros))")).alias("e"),
                  F.max(F.expr("abs(std_error - sqrt(1 / ones + 1 / zeros))")).alias("s"), F.min("converged").alias("c")).first()
    assert gap["n"] == 20_000 and gap["e"] < 1e-6 and gap["s"] < 1e-6 and gap["c"]


@pytest.fixture(scope="module")
def mixed(spark):
    """One group with most of the rows, small ones, a missing value and a column that depends on another."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(900):
        g = "hot" if k % 3 else f"g{k % 4}"
        x, kind = float(rng.normal()), "uvw"[int(rng.integers(3))]
        y = int(rng.random() < 1 / (1 + np.exp(-(0.4 * x + 0.3 * (kind == "u")))))
        rows.append((g, y, x, 2 * x, kind, 1.0))
    rows += [(None, 1, 0.5, 1.0, "u", 1.0), ("hot", 1, None, 1.0, "u", 1.0), ("hot", None, 1.0, 2.0, "u", 1.0)]
    return spark.createDataFrame(rows, "team string, y int, x double, twice double, kind string, one double")


@pytest.mark.parametrize("collapse", [False, True])
def test_equal_to_one_block_diagonal_fit(spark, mixed, collapse):
    terms = [Term("one", "kind"), Term("x"), Term("twice")]
    got = {(r["team"], r["term"]): r for r in fit_logit_groups(mixed, "y", terms, "team", collapse).collect()}
    want = {(r["team"], r["term"]): r for r in fit_logit_by(mixed, "y", terms, "team", collapse).collect()}
    assert set(got) == set(want) and {g for g, _ in got} == {"hot", "g0", "g1", "g2", "g3"}
    for key, row in want.items():
        for c in ("estimate", "std_error", "statistic", "p_value"):
            assert got[key][c] == (None if row[c] is None else pytest.approx(row[c], rel=1e-4, abs=1e-6)), (key, c)
        assert (row["estimate"] is None) == (key[1] == "twice")


def test_text_values_of_other_groups_have_no_coefficient(spark):
    rows = spark.createDataFrame([(1, "a", y) for y in (0, 1, 1)] + [(2, "b", y) for y in (0, 0, 1)], "g int, side string, y int")
    got = fit_logit_groups(rows.withColumn("one", F.lit(1)), "y", [Term("side", "one")], "g").collect()
    assert sorted((r["g"], r["term"], round(r["estimate"], 6)) for r in got) == [(1, "sidea:one", 0.693147), (2, "sideb:one", -0.693147)]


def test_separated_open_and_empty(spark):
    rows = spark.createDataFrame([(1, 1.0, 1), (1, 1.0, 1), (2, 1.0, 0), (2, 1.0, 1)], "g int, one double, y int")
    got = {r["g"]: r for r in fit_logit_groups(rows, "y", [Term("one")], "g").collect()}
    assert got[1]["estimate"] > 10 and got[1]["std_error"] > 100 and abs(got[2]["estimate"]) < 1e-9
    with pytest.warns(UserWarning, match="1 logistic fits"):
        short = {r["g"]: r["converged"] for r in fit_logit_groups(rows, "y", [Term("one")], "g", max_iter=4).collect()}
    assert short == {1: False, 2: True}
    assert fit_logit_groups(rows.limit(0), "y", [Term("one")], "g").count() == 0


def test_rows_of_a_group_never_meet_in_one_task(spark, mixed):
    from skillframe.models import grouped

    cells, state, _ = grouped._design(mixed, "y", [Term("one", "kind"), Term("x")], "team", False)
    text = grouped._normal_equations(cells, None, [Term("one", "kind"), Term("x")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "Python" not in text and "Window" not in text


def test_stacks_of_equations_are_solved_as_single_ones():
    """Groups are solved many at once; dependent columns, empty ones and equations that have run out stay as in one group."""
    from skillframe.models.design import independent, independent_each
    from skillframe.models.grouped import _coefficients

    rng = np.random.default_rng(8)
    rows = rng.normal(size=(200, 30, 4))
    rows[::2, :, 2] = rows[::2, :, 0] - 2 * rows[::2, :, 1]
    rows[::5, :, 1] = 0.0
    grams = rows.transpose(0, 2, 1) @ rows
    kept = independent_each(grams)
    assert [np.flatnonzero(k).tolist() for k in kept] == [independent(g) for g in grams]
    right = rng.normal(size=(200, 4))
    for broken in (False, True):
        part = grams * (kept[:, :, None] & kept[:, None, :])
        part[0] = 0.0 if broken else part[0]
        for x, m, r, k in zip(_coefficients(part, right, kept), part, right, kept):
            want = np.linalg.lstsq(m[np.ix_(k, k)], r[k], rcond=None)[0]
            assert x[k] == pytest.approx(want) and not x[~k].any()
