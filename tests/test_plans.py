import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skillframe.plans import ingest, results, roles, run
from skillframe.sources.files import Dialect, list_files, read_dialects, read_text_csv, read_table, swap_table, write_table

MAP_COLUMNS = (
    "stage string, match_id string, map_id string, patch string, team_one_name string, team_two_name string, "
    "match_winner string, map_winner string, game_number string, winning_team_final_map_score double, "
    "losing_team_final_map_score double, attacker string, round_start_time int, map_round string"
)


def rounds(spark, rows):
    return spark.createDataFrame([("s", "m", *r) for r in rows], MAP_COLUMNS)


def test_results_by_map(spark):
    df = rounds(spark, [
        ("m_1", "p", "A", "B", "A", "A", "1", 3.0, 2.0, "B", 1, "1"),
        ("m_1", "p", "A", "B", "A", "A", "1", 3.0, 2.0, "A", 2, "2"),
        ("m_2", "p", "A", "B", "A", "draw", "2", 2.0, 2.0, "A", 3, "1"),
        ("m_3", "p", "A", "B", "A", None, "3", 3.0, 1.0, "A", 4, "1"),
        ("m_4", None, "A", "B", "A", "B", "4", 3.0, 1.0, None, 5, "1"),
    ])
    got = {r["map_id"]: (r["team_one_map_score"], r["team_two_map_score"], r["first_attacker"])
           for r in results.results_by_map(df).collect()}
    assert got == {"m_1": (3.0, 2.0, "B"), "m_2": (2.0, 2.0, "A"), "m_3": (None, None, "A"), "m_4": (1.0, 3.0, None)}


def match_rows(spark, games):
    rows = [("s", "m", f"m_{g}", "p", "A", "B", "A", w, g) for g, w in games]
    columns = "stage string, match_id string, map_id string, patch string, team_one_name string, team_two_name string, " \
              "match_winner string, map_winner string, game_number string"
    r = results.results_by_match(spark.createDataFrame(rows, columns)).collect()
    assert len(r) == 1
    return r[0]["games"], r[0]["team_one_match_score"], r[0]["team_two_match_score"], r[0]["ties"]


def test_results_by_match(spark):
    assert match_rows(spark, [("1", "A"), ("2", "draw"), ("3", "B")]) == ("3", 1, 1, 1.0)
    assert match_rows(spark, [("9", "A"), ("10", "A")]) == ("9", 2, 0, 7.0)
    assert match_rows(spark, [("1", "A"), ("2", None)]) == ("2", None, None, None)


def test_roles_and_subroles(spark):
    rows = [
        ("p1", "Time Played", "Mercy", 500.0), ("p1", "Time Played", "Ana", 100.0), ("p1", "Time Played", "All Heroes", 600.0),
        ("p2", "Time Played", "Lucio", 600.0), ("p3", "Time Played", "Pharah", 500.0), ("p3", "Deaths", "Pharah", 9.0),
        ("p4", "Time Played", "Newcomer", 400.0), ("p4", "Time Played", "Genji", 100.0), ("p5", "Time Played", None, 9.0),
    ]
    log = spark.createDataFrame([(p, "m_1", "HYBRID", "T", s, h, a) for p, s, h, a in rows],
                                "player string, map_id string, map_type string, team string, stat_name string, hero string, stat_amount double")
    time = roles.time_on_hero(log)
    assert {r["player"]: r["role"] for r in roles.player_roles(time).collect()} == {
        "p1": "support", "p2": "support", "p3": "damage", "p4": None,
    }
    got = {r["player"]: (r["hero"], r["heroes"], r["subrole"]) for r in roles.player_subroles(time).collect()}
    roster = "Lucio, Mercy, Pharah, Newcomer"
    assert got == {"p1": ("Mercy", roster, "off_support"), "p2": ("Lucio", roster, "main_support"),
                   "p3": ("Pharah", roster, "DPS"), "p4": ("Newcomer", roster, None)}


def test_header_mismatch_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception):
        read_text_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_columns_are_bound_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n20,10\n")
    (tmp_path / "c.csv").write_text("why,x\n200,junk\n")
    schema = {"x": "double", "y": "string", "z": "string"}
    found = read_dialects(spark, str(tmp_path), {"c.csv": Dialect("c", {"why": "y"})}, Dialect("plain"), schema)
    assert {tuple(r) for r in found.collect()} == {
        (1.0, "2", None, "a.csv"), (10.0, "20", None, "b.csv"), (None, "200", None, "c.csv"),
    }


def test_swap_reads_what_it_overwrites(spark, tmp_path):
    write_table(spark.range(3), str(tmp_path), "t")
    swap_table(read_table(spark, str(tmp_path), "t").withColumn("twice", F.col("id") * 2), str(tmp_path), "t")
    assert sorted(r["twice"] for r in read_table(spark, str(tmp_path), "t").collect()) == [0, 2, 4]
    write_table(spark.range(2).withColumn("twice", F.lit(1)), str(tmp_path), "t", mode="append")
    assert read_table(spark, str(tmp_path), "t").count() == 5


@pytest.fixture(scope="module")
def season(spark, tmp_path_factory):
    import logs

    folder = tmp_path_factory.mktemp("season")
    logs.write(folder)
    run.run(spark, str(folder / "csvs"), str(folder / "patch_map.csv"), str(folder / "out"))
    return folder


@pytest.fixture(scope="module")
def out(spark, season):
    return lambda name: read_table(spark, str(season / "out"), name)


def test_files_of_all_dialects_become_one_table(spark, season, out):
    assert "match_map_stats.csv" in list_files(spark, str(season / "csvs"))
    players = out("player_stats")
    assert players.where("start_time IS NULL OR match_id IS NULL OR player IS NULL OR stat_amount IS NULL").count() == 0
    assert {r[0] for r in players.select("stage").distinct().collect()} == {
        "2018 Stage 1 Regular Season", "2019 Stage 1 Regular Season", "2019 Stage 2 Regular Season", "2020 Regular Season and Playoffs",
    }
    heroes = {r[0] for r in players.select("hero").distinct().collect()}
    assert "Lucio" in heroes and "Torbjorn" in heroes and "Lúcio" not in heroes
    gaps = ingest.map_id_gaps(out("match_map_stats"), players)
    assert gaps.count() == 0


def test_rounds_have_patches(spark, out):
    table = out("match_map_stats")
    assert table.where("patch IS NULL").count() == 0
    assert table.where("match_id = '21352' AND map_round = '1'").select("round_start_time").first()[0] == dt.datetime(2019, 4, 27, 16, 55)
    assert out("patch_map").count() == 4


def test_results_tables(out):
    maps, matches = out("results_by_map"), out("results_by_match")
    # The corrected time of one round puts it, and so its map, under a second patch as well.
    assert maps.count() == out("match_map_stats").select("map_id", "patch").distinct().count()
    assert maps.select("map_id").distinct().count() == 44 * 4
    split = maps.groupBy("match_id").agg(F.countDistinct("patch").alias("n")).where("n > 1").count()
    assert matches.count() == 44 + split
    total = F.col("team_one_match_score") + F.col("team_two_match_score") + F.col("ties")
    assert matches.where(total != F.col("games").cast("double")).count() == 0


def test_model_and_scores(spark, season, out):
    from skillframe.models.glm import load_fit

    fit = load_fit(spark, str(season / "out" / "models" / "stat_model"))
    estimates = {r[0]: r[1] for r in fit.rows}
    assert estimates["final_blows_DPS:year2019"] > 0 > estimates["deaths_DPS:year2019"]
    assert fit.model.numFeatures == sum(e is not None for e in estimates.values())
    table = out("stat_scores")
    assert table.columns == ["year", "stage", "map_id", "patch", "map_type", "player_team", "subrole", "player", "score",
                             "scaled_score", "map_adv_score"]
    for r in table.groupBy("subrole").agg(F.avg("scaled_score").alias("m"), F.stddev_samp("scaled_score").alias("s")).collect():
        assert abs(r["m"]) < 1e-9 and abs(r["s"] - 1) < 1e-9
    control = table.where("map_type = 'CONTROL'").select("map_adv_score").distinct().collect()
    assert [r[0] for r in control] == [0.0]
    assert table.where("map_type = 'HYBRID'").agg(F.max(F.abs("map_adv_score"))).first()[0] == pytest.approx(
        abs(estimates["map_typeHYBRID:first_attacker_flg"]))


def test_lineup_and_player_ratings(out):
    lineup_table, player_table = out("on_off_lineup_scores"), out("on_off_player_scores")
    assert {r[0] for r in lineup_table.select("year").distinct().collect()} == {2018, 2019, 2020}
    assert lineup_table.columns == ["lineup", "n", "estimate", "team", "year"]
    mean = {r["team"]: r["e"] for r in lineup_table.groupBy("team").agg(
        (F.sum(F.col("estimate") * F.col("n")) / F.sum("n")).alias("e")).collect()}
    assert mean["Alpha"] > mean["Delta"]
    assert player_table.columns == ["players", "score", "year"]
    assert player_table.where("score IS NULL").count() == 0
    by_team = {t: [r["score"] for r in player_table.where(F.col("players").startswith(t)).collect()] for t in ("Alpha", "Delta")}
    assert sum(by_team["Alpha"]) / len(by_team["Alpha"]) > sum(by_team["Delta"]) / len(by_team["Delta"])
    assert not any(math.isnan(s) for scores in by_team.values() for s in scores)


def test_seasons_come_from_the_stages(spark, out):
    from skillframe.plans.frames import seasons_of
    from skillframe.plans.lineups import side_players

    later = out("results_by_map").withColumn("stage", F.replace("stage", F.lit("2020"), F.lit("2021")))
    seasons = seasons_of(later)
    assert seasons == ("2018", "2019", "2021")
    years = side_players(later, out("player_stats_subroles"), seasons).select("year").distinct().collect()
    assert {r["year"] for r in years} == {"2018", "2019", "2021"}
    assert seasons_of(later.limit(0)) == ()


def test_map_id_gaps_shuffle_ids_once_and_list_missing_ids_on_both_sides(spark):
    rounds = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "map_id string")
    players = spark.createDataFrame([("b",), ("c",), ("c",), (None,), (None,)], "map_id string")
    gaps = ingest.map_id_gaps(rounds, players)
    text = gaps._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert sorted(map(str, gaps.collect())) == sorted(
        f"Row(map_id={m!r}, only_in={s!r})" for m, s in [("a", "rounds"), ("c", "players"), (None, "rounds"), (None, "players")])


def test_subroles_deal_rows_by_team_and_map_once(spark, monkeypatch):
    """Main heroes, rosters and their join need no further shuffle; missing maps and teams stay apart from empty texts."""
    monkeypatch.setattr(roles, "DEALT_ROWS", 2, raising=False)
    rows = [(p, m, "CONTROL", t, h, 1.0 + k) for m in ("1", "11", "", None) for t in ("a", "1a", "", None)
            for p, k in (("x", 0), ("y", 1)) for h in ("Ana", f"{m}|{t}")]
    time = spark.createDataFrame(rows, "player string, map_id string, map_type string, team string, hero string, seconds double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = roles.player_subroles(time)
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange ") == text.count("Exchange hashpartitioning(__at") == 2
    got = {(r["player"], r["map_id"], r["team"]): (r["hero"], r["heroes"]) for r in found.collect()}
    assert len(got) == 32 == found.count()
    for (_, m, t), (hero, heroes) in got.items():
        best = min("Ana", f"{m}|{t}")
        assert (hero, heroes) == (best, f"{best}, {best}")


def test_score_sums_shuffle_no_long_form_and_build_the_frame_once(spark, sf_dir, monkeypatch):
    from skillframe.plans import scores
    from skillframe.queries import balance

    plans, frames, write, build = [], [], balance.materialize, scores.player_frame
    monkeypatch.setattr(balance, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    monkeypatch.setattr(scores, "player_frame", lambda *a: frames.append(build(*a)) or frames[-1])
    gaps = balance.stat_scores_balance(spark, sf_dir).collect()
    assert gaps and all(r["gap"] == r["scaled_gap"] == r["map_gap"] == 0 for r in gaps)
    summed = [p for p in plans if "estimate" in p and "explode" in p]
    assert len(summed) == 1 == len(frames) and "SortMergeJoin" not in summed[0] and summed[0].count("BroadcastHashJoin") == 2


def _hand_lineups(results, players):
    """Lineups of both sides of a map, in plain Python."""
    rows = set()
    texts = {}
    for stage, m, first, winner in results:
        for team, other, flag in ((first, "b" if first == "a" else "a", 1.0), ("b" if first == "a" else "a", first, -1.0)):
            mine = [p for p in players if p[1] == m and p[2] == team] or [(None, m, team, None, None)]
            for kind in {p[3] for p in mine}:
                key = (team, other, m, None if team is None else float(team == winner), kind, flag, stage[:4])
                texts.setdefault(key, []).extend(p for p in mine if p[3] == kind)
    shown = {k: ";".join(f"{p[0] or 'NA'}_{p[4] or 'NA'}" for p in sorted(v, key=lambda p: (p[0] is None, p[0] or "", p[4] or "NA"))) for k, v in texts.items()}
    for k, text in shown.items():
        rows |= {(*k, text, o) for q, o in shown.items() if q[2] == k[2] and q[6] == k[6] and q[0] == k[1]}
    return rows


def test_lineups_deal_rows_by_map_once_and_keep_missing_maps_and_teams(spark, sf_dir):
    from skillframe.plans import lineups
    from skillframe.queries import ratings

    results = [("2018 x", "1", "a", "a"), ("2018 x", "1", "a", "a"), ("2019 x", "11", "b", "a"), ("2018 x", None, "a", "b"),
               ("2018 x", "", None, "b"), ("2020 x", "2", "a", "a")]
    players = [(p, m, t, "CONTROL", s) for m in ("1", "11", "", None) for t in ("a", "b", None) for p, s in (("y", "z"), ("x", None), (None, "w"))]
    made = spark.createDataFrame(
        [(s, m, "p", "a", "b", w, 1.0, 0.0, f) for s, m, f, w in results],
        "stage string, map_id string, patch string, team_one_name string, team_two_name string, map_winner string, "
        "team_one_map_score double, team_two_map_score double, first_attacker string")
    logged = spark.createDataFrame(players, "player string, map_id string, team string, map_type string, subrole string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = lineups.lineup_frame(lineups.side_players(made, logged))
        got = [tuple(r) for r in found.collect()]
        frame = lineups.lineup_frame(lineups.side_players(ratings.order_results(spark, sf_dir), ratings._type_players(spark, sf_dir)))
        text = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.columns == [*lineups.SIDE, "lineup", "lineup_opponent"]
    want = _hand_lineups(results, players)
    assert len(got) == len(set(got)) and set(got) == want
    # Both sides of the joins with parts and suppliers are dealt by those keys; from there on rows are dealt by map alone.
    assert text.count("hashpartitioning(__map") == 2 and text.count("Exchange hashpartitioning") == 2 + 4
    assert "ObjectHashAggregate" not in text


def test_roles_are_taken_from_distinct_lineups(spark):
    from skillframe.plans.lineups import lineup_roles

    frame = spark.createDataFrame([("a_x;b_y",)] * 3 + [("b_y",), (None,)], "lineup string")
    assert sorted(r[0] for r in lineup_roles(frame).collect()) == ["a_x", "b_y"]
    text = lineup_roles(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in text[text.index("Generate"):]
