"""No row is lost or multiplied without a word: lookups, corrections, intervals, pivots, aliased terms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skillframe.functions.text import hrefs
from skillframe.models.design import Term
from skillframe.models.glm import fit_logit, fit_logit_by
from skillframe.models.mixed import fit_crossed_logit
from skillframe.operators.joins import interval_join
from skillframe.operators.lookup import apply_corrections, relabel
from skillframe.operators.reshape import pivot_wide


def test_repeated_lookup_keys_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, n int")
    lookup = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("b", "z")], "old string, new string")
    assert sorted(tuple(r) for r in relabel(rows, "k", lookup).collect()) == [("c", 3), ("x", 1), ("z", 2)]
    fixes = spark.createDataFrame([("a", 9), ("a", 8)], "k string, n int")
    assert sorted(tuple(r) for r in apply_corrections(rows, fixes, ["k"], "n").collect()) == [("a", 8), ("b", 2), ("c", 3)]


@pytest.mark.parametrize("bounds", ["midnight", "whole_day"])
@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_intervals_give_the_same_rows_at_any_number(spark, bounds, kind):
    day = dt.datetime(2020, 1, 1)
    events = spark.createDataFrame([(k, day + dt.timedelta(hours=7 * k)) for k in range(60)], "id int, ts timestamp_ntz")
    spans = [(i, day + dt.timedelta(days=2 * i, hours=9), day + dt.timedelta(days=2 * i + (-1 if i == 3 else i % 4), hours=15)) for i in range(9)]
    for n in (8, 9):
        table = spark.createDataFrame(spans[:n], "p int, a timestamp_ntz, b timestamp_ntz").withColumns({c: F.col(c).cast(kind) for c in "ab"})
        found = [sorted((r["id"], -1 if r["p"] is None else r["p"]) for r in interval_join(events, table, "ts", "a", "b", bounds, way).collect())
                 for way in ("auto", "direct", "by_day")]
        assert found[0] == found[1] == found[2]


def test_pivot_finds_its_names(spark):
    rows = spark.createDataFrame([("m", "b", 1), ("m", "a", 2), ("n", None, 3), ("n", "b", 4)], "id string, k string, v int")
    wide = pivot_wide(rows, ["id"], "k", None, ["v"])
    assert wide.columns == ["id", "a", "b", "NA"]
    assert sorted(tuple(r) for r in wide.collect()) == [("m", 2, 1, 0), ("n", 0, 4, 3)]


def outcomes(spark):
    rows = [(g, f, float(k % 3 != 0), 1.0) for g in ("x", "y") for f in (("u", "v") if g == "x" else ("u", "w")) for k in range(12)]
    return spark.createDataFrame(rows, "g string, f string, y double, one double").withColumn("f2", F.concat(F.lit("m"), "f"))


def test_aliased_terms_of_a_group_stay_as_null(spark):
    terms = [Term("one", "f"), Term("one", "f2")]
    alone = {r["term"]: r["estimate"] for r in fit_logit(outcomes(spark).where("g = 'x'"), "y", terms).coef_df(spark).collect()}
    grouped = {r["term"]: r["estimate"] for r in fit_logit_by(outcomes(spark), "y", terms, "g").where("g = 'x'").collect()}
    assert set(alone) == set(grouped)
    for term, estimate in alone.items():
        assert (estimate is None) == (grouped[term] is None)
        assert estimate is None or grouped[term] == pytest.approx(estimate, abs=1e-6)


def test_a_fit_that_stops_early_says_so(spark):
    rows = spark.createDataFrame([(float(k), float(k > 0)) for k in range(-9, 10) if k], "x double, y double")
    with pytest.warns(UserWarning, match="did not converge"):
        assert not fit_logit(rows, "y", [Term("x")]).converged


def test_estimated_variances_of_planted_effects(spark):
    from test_models import duels

    _, _, df = duels(spark, maps=500)
    fit = fit_crossed_logit(df, "win", Term("map_type", "flag"), ("lineup", "opponent"))
    tight = fit_crossed_logit(df, "win", Term("map_type", "flag"), ("lineup", "opponent"), tol=1e-6)
    eff, exact = ({(r["grpvar"], r["grp"]): r["condval"] for r in f.effects.collect()} for f in (fit, tight))
    deviation = max(tight.variances.values()) ** 0.5
    assert max(abs(eff[k] - exact[k]) for k in exact) < 1e-3 * deviation
    for (group, name), value in exact.items():  # every contest is there from both sides
        other = exact["opponent" if group == "lineup" else "lineup", name]
        assert abs(value + other) < 1e-2 * deviation
    one, two = tight.variances.values()
    assert one == pytest.approx(two, rel=1e-2)


def test_links_in_all_forms(spark):
    page = """<A class=x HREF='a.html'>1</A><a href="b.html?x=1&amp;y=&quot;2&quot;">2</a><a
      data-href="no" title='t'
      href = c.html>3</a><a name="n">4</a><abbr href="no">5</abbr><a href=' d '>6</a><a title="href=no" id=1 href="">7</a>"""
    rows = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    got = [r["l"] for r in rows.select(hrefs("html").alias("l")).collect()]
    assert got == [["a.html", 'b.html?x=1&y="2"', "c.html", "d", ""], None, []]
    inside = rows.select(hrefs("html", r"(?s)<abbr(.*)").alias("l")).first()["l"]
    assert inside == ["d", ""]
