import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skillframe.operators import ranges
from skillframe.operators.joins import equi_join, interval_join, natural_join, theta_join
from skillframe.operators.ranking import dense_rank_id, first_by, top1, zscore
from skillframe.operators.reshape import across, contained, membership, ordered_concat, pivot_sparse, pivot_wide, sparse_cell, sum_numeric
from skillframe.operators.sides import other_side, signed_mean, two_sided


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_rules_for_missing_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "q string, v int")
    safe = equi_join(left, right, {"k": "q"}, "left")
    assert safe.columns == ["k", "v", "v_right"]
    assert {tuple(r) for r in safe.collect()} == {("a", 1, 10), (None, 2, 20)}
    sql = equi_join(left, right, {"k": "q"}, "inner", nullsafe=False)
    assert [tuple(r) for r in sql.collect()] == [("a", 1, 10)]


def test_natural_join(spark):
    left = spark.createDataFrame([("m", "t", 1), ("m", None, 2)], "map_id string, team string, x int")
    right = spark.createDataFrame([("m", "t", "h"), ("m", None, "n")], "map_id string, team string, heroes string")
    assert {(r["x"], r["heroes"]) for r in natural_join(left, right).collect()} == {(1, "h"), (2, "n")}


CASES = [
    (dt.datetime(2018, 1, 1), "1.18", "1.18"),
    (dt.datetime(2018, 2, 15), "1.18", "1.18"),
    (dt.datetime(2018, 2, 15, 10), None, "1.18"),
    (dt.datetime(2018, 2, 16), "1.19c", "1.19c"),
    (dt.datetime(2017, 12, 31, 23, 59, 59), None, None),
    (None, None, None),
]


@pytest.mark.parametrize("strategy", ["direct", "by_day", "auto"])
@pytest.mark.parametrize("bounds", ["midnight", "whole_day"])
def test_interval_join(spark, strategy, bounds):
    patches = spark.createDataFrame(
        [("1.18", dt.date(2018, 1, 1), dt.date(2018, 2, 15)), ("1.19c", dt.date(2018, 2, 16), dt.date(2018, 3, 30)),
         ("never", dt.date(2018, 3, 1), dt.date(2018, 2, 1))],
        "patch string, a date, b date",
    )
    events = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, ts timestamp_ntz")
    joined = interval_join(events, patches, "ts", "a", "b", bounds, strategy)
    got = {r["i"]: r["patch"] for r in joined.collect()}
    assert got == {i: c[1 if bounds == "midnight" else 2] for i, c in enumerate(CASES)}
    assert "Broadcast" in plan(joined)


def test_interval_join_repeats_events_in_overlaps(spark):
    patches = spark.createDataFrame(
        [("x", dt.date(2018, 1, 1), dt.date(2018, 1, 9)), ("y", dt.date(2018, 1, 5), dt.date(2018, 1, 7))],
        "patch string, a date, b date",
    )
    events = spark.createDataFrame([(1, dt.datetime(2018, 1, 6, 5))], "i int, ts timestamp_ntz")
    for strategy in ("direct", "by_day"):
        assert interval_join(events, patches, "ts", "a", "b", "midnight", strategy).count() == 2


def test_theta_join_of_long_sides(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BUCKET_ROWS", 40)
    draw = random.Random(1)
    values = [draw.choice([7.5, None, draw.uniform(0, 100), draw.uniform(0, 100)]) for _ in range(900)] + [float("inf"), float("-inf"), 0.0]
    left = spark.createDataFrame(list(enumerate(values)), "i int, x double").repartition(3)
    spans = [(k, draw.uniform(-5, 100)) for k in range(300)] + [(300, None), (301, 7.5), (302, 7.5)]
    right = spark.createDataFrame([(k, a, None if a is None or k % 50 == 7 else a + draw.choice([-1, 0, 0.5, 30])) for k, a in spans], "k int, a double, b double")
    bounds = [tuple(r) for r in right.collect()]
    for tests, fits in ((([("x", ">=", "a"), ("x", "<=", "b")]), lambda x, a, b: a is not None and b is not None and a <= x <= b),
                        (([("x", ">", "a"), ("x", "<", "b")]), lambda x, a, b: a is not None and b is not None and a < x < b),
                        (([("x", "<", "a")]), lambda x, a, b: a is not None and x < a)):
        pairs = sorted((i, k) for i, x in enumerate(values) for k, a, b in bounds if x is not None and fits(x, a, b))
        assert sorted((r["i"], r["k"]) for r in theta_join(left, right, tests, "inner").collect()) == pairs
        alone = sorted(set(range(len(values))) - {i for i, _ in pairs})
        found = [(r["i"], r["k"]) for r in theta_join(left, right, tests).collect()]
        assert sorted(i for i, k in found if k is None) == alone and sorted(p for p in found if p[1] is not None) == pairs
    assert theta_join(left.limit(0), right, [("x", ">=", "a")]).count() == 0
    times = left.withColumn("x", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, i)"))
    spans = right.select("k", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, k)").alias("a"))
    assert ranges.range_join(times, spans, [("x", "<=", "a"), ("x", ">=", "a")], "inner").count() == 303
    with pytest.raises(ValueError, match="one left column"):
        ranges.range_join(left, right, [("x", ">=", "a"), ("i", "<", "b")])


def test_dense_rank_id(spark):
    t = [dt.datetime(2020, 1, 1, 10), dt.datetime(2020, 1, 1, 10), dt.datetime(2020, 1, 1, 10, 20),
         dt.datetime(2020, 1, 3), None]
    df = spark.createDataFrame([(i, "7", x) for i, x in enumerate(t)], "i int, m string, t timestamp_ntz")
    ranked = dense_rank_id(df, ["m"], "t", "id", "m")
    assert [r["id"] for r in ranked.orderBy("i").collect()] == ["7_1", "7_1", "7_2", "7_3", "7_NA"]


def test_top1_ties_and_missing(spark):
    df = spark.createDataFrame(
        [("a", "tank", 300.0), ("a", "support", 300.0), ("b", None, 400.0), ("b", "damage", 100.0),
         ("c", "tank", None), ("c", "damage", 1.0)],
        "p string, role string, t double",
    )
    best = top1(df, ["p"], "t", ["role"])
    assert dict(best.collect()) == {"a": "support", "b": None, "c": "damage"}
    assert "WindowGroupLimit" in plan(best)


def test_first_keeps_missing_values(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, None), ("k", None, "never")], "k string, o int, v string")
    assert first_by(df, ["k"], ["o"], ["v"]).collect() == [("k", None)]


def test_zscore(spark):
    df = spark.createDataFrame(
        [("g", 1.0), ("g", 2.0), ("g", 3.0), ("g", None), ("one", 5.0), ("flat", 1.0), ("flat", 1.0), (None, 1.0), (None, 3.0)],
        "k string, v double",
    )
    got = {}
    for r in zscore(df, ["k"], "v", "z").collect():
        got.setdefault(r["k"], set()).add(None if r["z"] is None else round(r["z"], 9))
    assert got == {"g": {-1.0, 0.0, 1.0, None}, "one": {None}, "flat": {None}, None: {-0.707106781, 0.707106781}}


def test_pivot_poisons_then_fills(spark):
    df = spark.createDataFrame(
        [("p1", "deaths", 3.0), ("p1", "deaths", 2.0), ("p1", "final_blows", 7.0), ("p1", "solo_kills", None),
         ("p2", "deaths", 4.0), ("p2", "deaths", None)],
        "p string, s string, v double",
    )
    wide = pivot_wide(df, ["p"], "s", ["deaths", "final_blows", "solo_kills"], ["v"])
    assert {tuple(r) for r in wide.collect()} == {("p1", 5.0, 7.0, 0.0), ("p2", 0.0, 0.0, 0.0)}


def test_pivot_names_run_by_value(spark):
    df = spark.createDataFrame([("m", "DPS", 1.0, 2.0), ("m", None, 3.0, 4.0)], "m string, r string, deaths double, blows double")
    wide = pivot_wide(df, ["m"], "r", {"DPS": "DPS", "tank": "tank", None: "NA"}, ["deaths", "blows"])
    assert wide.columns == ["m", "deaths_DPS", "deaths_tank", "deaths_NA", "blows_DPS", "blows_tank", "blows_NA"]
    assert tuple(wide.first()) == ("m", 1.0, 0.0, 3.0, 2.0, 0.0, 4.0)
    top = pivot_wide(df, ["m"], "r", ["DPS"], ["deaths"], agg=F.max, fill_num=None)
    assert top.first()["DPS"] == 1.0


def test_ordered_text(spark):
    df = spark.createDataFrame([("t", "p1", "Mercy", 500.0), ("t", "p2", "Lucio", 600.0), ("t", "p3", "Pharah", 500.0)],
                               "team string, p string, hero string, time double")
    got = ordered_concat(df, ["team"], "hero", ["time DESC NULLS LAST", "p"], ", ", "heroes").first()["heroes"]
    assert got == "Lucio, Mercy, Pharah"
    lineup = spark.createDataFrame([("t", "b", "b_DPS"), ("t", "a", "a_tank"), ("t", "c", None)], "team string, p string, r string")
    assert ordered_concat(lineup, ["team"], "r", ["p"], ";", "l").first()["l"] == "a_tank;b_DPS;NA"


def test_membership_modes(spark):
    lineups = spark.createDataFrame([("BenFits_DPS;a_main_tank",), ("Fits_DPS",)], "lineup string")
    roles = spark.createDataFrame([("Fits_DPS",), ("a_main_tank",), ("x",)], "player_role string")
    exact = {tuple(r) for r in membership(lineups, "lineup", roles=roles).collect()}
    assert exact == {("BenFits_DPS;a_main_tank", "a_main_tank"), ("Fits_DPS", "Fits_DPS")}
    regex = {tuple(r) for r in membership(lineups, "lineup", mode="regex", roles=roles).collect()}
    assert regex == exact | {("BenFits_DPS;a_main_tank", "Fits_DPS")}
    assert membership(lineups, "lineup").count() == 3


def test_contained_by_character_runs(spark):
    texts = ["abc;bcd", "abcabc", "\U0001f600bé", "x", "", "a.c", None, "x"]
    parts = ["abc", "bc", "b", "", "bcd", "zzz", "abz", "\U0001f600b", "bé", "a.c", "abcabcabc", None, "x", "x"]
    left = spark.createDataFrame([(t,) for t in texts], "lineup string")
    right = spark.createDataFrame([(p,) for p in parts], "lineup string")
    want = sorted({(t, p) for t in texts for p in parts if t is not None and p is not None and p in t})
    for size in (1, 2, 3, 5):
        found = contained(left, "lineup", right.withColumnRenamed("lineup", "part"), "part", size)
        assert sorted(tuple(r) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert contained(left.limit(0), "lineup", right, "lineup").count() == 0


def test_contained_meets_few_parts_that_share_their_ends(spark, monkeypatch):
    """Names that differ by a number between equal ends: as many candidates as pairs, not all texts by all parts of an ending."""
    from skillframe.operators import reshape

    texts = spark.range(3000).selectExpr("'player_' || id || '_support;player_' || (id + 1) || '_support' AS lineup")
    parts = spark.range(3001).selectExpr("'player_' || id || '_support' AS part")
    want = 2 * 3000
    for bounds in ((500_000, 4_000_000), (10, 4_000_000), (10, 10)):
        monkeypatch.setattr(reshape, "MAX_BROADCAST_PARTS", bounds[0])
        monkeypatch.setattr(reshape, "MAX_BROADCAST_RUNS", bounds[1])
        met, where = [], type(texts).where
        monkeypatch.setattr(type(texts), "where", lambda df, c: (met.append(df) if "contains(" in str(c) else None, where(df, c))[1])
        assert contained(texts, "lineup", parts, "part").count() == want
        monkeypatch.undo()
        assert met[0].count() <= 3 * want


def test_prices_and_spans_meet_once(spark, tmp_path, monkeypatch):
    """Lines of one price and parts of one price are one row each when the ranges are compared; keys may repeat or miss."""
    from skillframe.queries import tables

    lines = [(k, p) for k, p in enumerate([100.0] * 40 + [110.0] * 30 + [200.0, 500.0, None, None])]
    parts = [(1, 5.0), (2, 5.0), (2, 5.0), (None, 5.0), (3, 10.0), (3, 5.5), (4, None), (5, 90.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    met, join = [], tables.theta_join
    monkeypatch.setattr(tables, "theta_join", lambda *a: met.append(join(*a)) or met[-1])
    got = {r["p_partkey"]: tuple(r)[1:] for r in tables.range_left_join(spark, str(tmp_path)).collect()}
    assert got == {1: (70, 100.0, 110.0), 2: (140, 100.0, 110.0), 3: (31, 110.0, 200.0), None: (73, 100.0, 500.0)}
    assert met[0].count() == 6  # 100 in one span, 110 in two, 200 in one, 500 and the missing price in none


def test_sparse_pivot(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, 1.0), ("a", "x", 2, None), ("a", None, 5, 2.0), ("a", "NA", 7, 3.0), (None, "y", 1, 1.0)], "name string, hero string, n int, v double")
    got = {r["name"]: [tuple(c) for c in r["cells"]] for r in pivot_sparse(df, ["name"], "hero", ["n", "v"]).collect()}
    assert got == {"a": [("NA", 7, 3.0), ("x", 3, None), (None, 5, 2.0)], None: [("y", 1, 1.0)]}
    wide = pivot_sparse(df, ["name"], "hero", ["n", "v"]).where("name = 'a'")
    cells = [("x", "n", 0), ("x", "v", 0.0), ("x", "v", None), (None, "n", 0), ("NA", "n", 0), ("z", "n", 0), ("z", "n", None)]
    assert list(wide.select(*[sparse_cell("cells", *c).alias(str(i)) for i, c in enumerate(cells)]).first()) == [3, 0.0, None, 5, 7, 0, None]
    with pytest.raises(ValueError):
        pivot_sparse(df, ["hero"], "hero", ["name"])


def test_sparse_pivot_of_many_names(spark):
    df = spark.range(300_000).selectExpr("id % 7 AS team", "'n' || (id % 100000) AS name", "id AS v")
    got = pivot_sparse(df, ["team"], "name", ["v"]).selectExpr("sum(size(cells)) AS n", "sum(aggregate(cells, 0L, (s, c) -> s + c.v)) AS v")
    assert tuple(got.first()) == (df.select("team", "name").distinct().count(), 300_000 * 299_999 // 2)


def test_across_and_numeric_sums(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None)], "k string, x int, deaths_a double")
    assert tuple(across(df, lambda c: c.startswith("deaths"), lambda c: c * 0).first()) == ("a", 1, 0.0)
    assert tuple(sum_numeric(df, ["k"]).first()) == ("a", 3, None)


def test_two_sides(spark):
    results = spark.createDataFrame(
        [("m1", "A", "B", "A", "B"), ("m2", "A", "B", "A", "draw"), ("m3", "A", "B", "A", None), ("m4", "A", "B", None, "A")],
        "map_id string, one string, two string, first string, winner string",
    ).withColumn("second", other_side("first", "one", "two"))
    stats = spark.createDataFrame([("m1", "A", 5), ("m1", "B", 6), ("m2", "A", 7)], "map_id string, team string, x int")
    decided = two_sided(results, stats, "map_id", "first", "second", "winner", "team", True)
    rows = {(r["map_id"], r["player_team"], r["first_attacker_flg"], r["win"], r["x"]) for r in decided.collect()}
    assert rows == {("m1", "A", 1.0, 0.0, 5), ("m1", "B", -1.0, 1.0, 6), ("m4", None, 1.0, None, None), ("m4", "A", -1.0, 1.0, None)}
    every = two_sided(results, stats, "map_id", "first", "second", "winner", "team", False)
    wins = {(r["map_id"], r["win"]) for r in every.collect()}
    assert ("m2", 0.0) in wins and ("m3", None) in wins
    assert every.agg(F.sum("first_attacker_flg")).first()[0] == 0


def test_signed_mean(spark):
    df = spark.createDataFrame([("lineup", "g", 0.4), ("lineup_opponent", "g", -0.2)], "side string, g string, v double")
    assert signed_mean(df, ["g"], "side", "lineup", "v", "e").first()["e"] == pytest.approx(0.3)
