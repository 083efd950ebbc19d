"""Queries that build the rating tables themselves, from test tables dressed as match logs.

Orders are maps between ``home`` and ``away``, suppliers are players, part brands are heroes, quantities are amounts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nulls import paste
from ..models.glm import fit_logit
from ..operators.joins import equi_join
from ..operators.lookup import relabel_expr
from ..plans import fixed, frames, ingest, lineups, roles, scores
from ..session import materialize, materialize_last
from . import table
from .columns import TIME_TEXT

BRAND_HEROES = dict(
    enumerate(
        [
            "Lucio", "Moira", "Brigitte", "Zenyatta", "Mercy", "Ana", "Baptiste", "Reinhardt", "Sigma", "Wrecking Ball",
            "Zarya", "Winston", "D.Va", "Roadhog", "Orisa", "Ashe", "Echo", "Pharah", "Genji", "Torbjorn", "Tracer",
            "Widowmaker", "Mei", "All Heroes", "Newcomer",
        ],
        start=1,
    )
)
STAT_BY_DISCOUNT = dict(enumerate([*fixed.TEAM_STATS, "Weapon Accuracy", "Time Alive"]))
PRIORITY_STAGES = {
    "1-URGENT": "Overwatch League - Stage 1",
    "2-HIGH": "Overwatch League Stage 1",
    "3-MEDIUM": "OWL APAC All-Stars",
    "4-NOT SPECIFIED": "Some Cup",
}


def _lines(spark, sf):
    """Line items with their supplier's team."""
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "l_discount", "l_quantity"
    )
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") < 12, "home").otherwise("away").alias("team")
    )
    return equi_join(line, suppliers, {"l_suppkey": "s_suppkey"}, nullsafe=False)


def _players_of(lines, *more):
    return lines.select(
        F.concat(F.lit("p"), "l_suppkey").alias("player"), F.col("l_orderkey").cast("string").alias("map_id"),
        F.when(F.col("l_linestatus") == "O", "CONTROL").otherwise("HYBRID").alias("map_type"), "team",
        F.when(F.col("l_quantity") < 50, F.col("l_quantity")).alias("stat_amount"), *more,
    )


def line_players(spark, sf):
    return _players_of(_lines(spark, sf), "l_partkey", "l_discount")


def time_log(spark, sf):
    """Play time per hero: every line item is time on the hero of its part's brand."""
    brands = {f"Brand#{k}": hero for k, hero in BRAND_HEROES.items()}
    part = table(spark, sf, "part").select("p_partkey", relabel_expr(F.col("p_brand"), brands, None).alias("hero"))
    # Texts are made after the join, so that keys are shuffled and not they.
    log = _players_of(equi_join(_lines(spark, sf).drop("l_discount"), part, {"l_partkey": "p_partkey"}, nullsafe=False), "hero")
    return log.select("player", "map_id", "map_type", "team", "hero", F.lit("Time Played").alias("stat_name"), "stat_amount")


def stat_log(spark, sf):
    """Totals over heroes: the discount decides which statistic a line item counts for."""
    names = F.create_map(*[F.lit(x) for item in STAT_BY_DISCOUNT.items() for x in item])
    stat = F.try_element_at(names, F.round(F.col("l_discount") * 100).cast("int"))
    return line_players(spark, sf).select(
        "player", "map_id", "map_type", "team", F.lit("All Heroes").alias("hero"), stat.alias("stat_name"), "stat_amount"
    )


def order_results(spark, sf):
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate")
    stage = F.when(year <= 1996, "2018 Stage 1").when(year <= 1998, "2019 Playoffs").otherwise("2020 Regular Season")
    winner = F.when(F.col("o_orderstatus") == "F", "home").when(F.col("o_orderstatus") == "O", "away").otherwise("draw")
    attacker = F.when(F.col("o_custkey") % 3 == 0, "away").when(F.col("o_custkey") % 3 == 1, "home")
    return orders.select(
        stage.alias("stage"), F.col("o_orderkey").cast("string").alias("map_id"), F.col("o_orderpriority").alias("patch"),
        F.lit("home").alias("team_one_name"), F.lit("away").alias("team_two_name"),
        F.when(F.col("o_totalprice") < 450000, winner).alias("map_winner"),
        F.col("o_totalprice").alias("team_one_map_score"), F.col("o_custkey").cast("double").alias("team_two_map_score"),
        attacker.alias("first_attacker"),
    )


def match_map_stats(spark, sf):
    """Cleaned rounds with their patch; one order number is made to meet a known time error."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    line = equi_join(table(spark, sf, "lineitem"), orders, {"l_orderkey": "o_orderkey"}, nullsafe=False)
    rounds = line.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("round_start_time"),
        relabel_expr(F.col("o_orderpriority"), PRIORITY_STAGES, None).alias("stage"),
        (F.col("l_orderkey") + 15000).cast("string").alias("match_id"),
        F.col("l_partkey").cast("string").alias("game_number"), F.col("l_linenumber").cast("string").alias("map_round"),
        "l_suppkey", "l_quantity",
    )
    patches = spark.createDataFrame(
        [(f"Patch {y}.{m}", f"{y}-{m:02d}-01", f"{y}-{m:02d}-28") for y in range(1995, 2002) for m in range(1, 13)],
        "patch string, a string, b string",
    ).select("patch", F.col("a").cast("date").alias("start_date"), F.col("b").cast("date").alias("end_date"))
    return ingest.add_patches(ingest.clean_rounds(rounds), patches).select(
        "map_id", "stage", "map_round", "l_suppkey", "l_quantity", "patch",
        F.date_format("round_start_time", TIME_TEXT).alias("start_time"),
    )


def player_stats(spark, sf):
    """Cleaned player log from events: the event type is the file, the user the match, the hour the start time."""
    events = table(spark, sf, "events")
    hero = F.when(F.col("event_id") % 3 == 0, "Lúcio").when(F.col("event_id") % 3 == 1, "Torbj")
    stage = F.when(F.col("value") < 5, "OWL North America All-Stars").when(F.col("value") < 30, "OWL 2020 Regular Season")
    log = events.select(
        F.col("event_type").alias("file_name"), F.col("user_id").cast("string").alias("match_id"),
        F.when(F.col("value") < 200, F.date_trunc("hour", "ts")).cast("timestamp_ntz").alias("start_time"),
        hero.alias("hero"), stage.alias("stage"), F.col("value").alias("stat_amount"), "event_id",
    )
    return ingest.clean_players(log).select("event_id", "map_id", "hero", "stage", "stat_amount")


def player_stats_roles(spark, sf):
    return roles.player_roles(roles.time_on_hero(time_log(spark, sf)))


def player_stats_subroles(spark, sf):
    return roles.player_subroles(roles.time_on_hero(time_log(spark, sf)))


def _subroles(spark, sf):
    return materialize_last(spark, lambda: player_stats_subroles(spark, sf))


def team_model_frame(spark, sf):
    return scores.team_frame(order_results(spark, sf), stat_log(spark, sf), _subroles(spark, sf))


def player_model_frame(spark, sf):
    wide = frames.player_stats_wide(stat_log(spark, sf), _subroles(spark, sf))
    return frames.model_frame(order_results(spark, sf), wide, drop_draws=False)


def stat_scores(spark, sf):
    results, log, subroles = order_results(spark, sf), stat_log(spark, sf), _subroles(spark, sf)
    fit = scores.fit_win_model(scores.team_frame(results, log, subroles))
    return scores.stat_scores(results, log, subroles, fit)


def stat_model(spark, sf):
    frame = scores.team_frame(order_results(spark, sf), stat_log(spark, sf), _subroles(spark, sf))
    return fit_logit(frame, "win", scores.WIN_TERMS).coef_df(spark)


def lineup_frame(spark, sf):
    return lineups.lineup_frame(lineups.side_players(order_results(spark, sf), _subroles(spark, sf)))


def _type_players(spark, sf):
    """Part types as players and return flags as subroles, so that lineups recur."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = equi_join(line, part, {"l_partkey": "p_partkey"}, nullsafe=False)
    joined = equi_join(joined, suppliers, {"l_suppkey": "s_suppkey"}, nullsafe=False)
    players = joined.select(
        F.col("p_type").alias("player"), F.col("l_orderkey").cast("string").alias("map_id"),
        F.when(F.col("s_nationkey") < 12, "home").otherwise("away").alias("team"), F.lit("HYBRID").alias("map_type"),
        F.when(F.col("l_returnflag") == "R", "back").otherwise("front").alias("subrole"),
    )
    # Dealt by map before equal rows are dropped, as the lineups need them.
    return players.withColumn(lineups.DEALT, F.expr(frames.MAP)).repartition(lineups.DEALT).distinct()


def _rated(spark, sf):
    sides = lineups.side_players(order_results(spark, sf), _type_players(spark, sf))
    frame = materialize(lineups.lineup_frame(sides))
    return frame, lineups.lineup_scores(frame)


def on_off_lineup_scores(spark, sf):
    return _rated(spark, sf)[1]


def on_off_player_scores(spark, sf):
    frame, rated = _rated(spark, sf)
    return lineups.player_scores(materialize(rated), lineups.lineup_roles(frame))


def map_id_gaps(spark, sf):
    """Orders that occur as map results but have no play time, and the other way round."""
    return ingest.map_id_gaps(order_results(spark, sf), line_players(spark, sf))


def lineup_text(spark, sf):
    """Player and subrole joined per team and map, missing subroles shown as NA."""
    players = player_stats_subroles(spark, sf)
    return players.select("map_id", "team", paste("player", "subrole", sep="_").alias("player_role"), "map_type")


QUERIES = {
    "match_map_stats": match_map_stats,
    "player_stats": player_stats,
    "player_stats_roles": player_stats_roles,
    "player_stats_subroles": player_stats_subroles,
    "player_role_text": lineup_text,
    "map_id_gaps": map_id_gaps,
    "team_model_frame": team_model_frame,
    "player_model_frame": player_model_frame,
    "lineup_frame": lineup_frame,
    "stat_model": stat_model,
    "stat_scores": stat_scores,
    "on_off_lineup_scores": on_off_lineup_scores,
    "on_off_player_scores": on_off_player_scores,
}


def _listed(names) -> str:
    return ", ".join("'" + n + "'" for n in names)


def _has(*names: str) -> str:
    return "(" + " OR ".join(f"contains(heroes, '{n}')" for n in names) + ")"


_LINE = """
    line AS (SELECT 'p' || l_suppkey AS player, l_orderkey::VARCHAR AS map_id,
                    CASE WHEN l_linestatus = 'O' THEN 'CONTROL' ELSE 'HYBRID' END AS map_type,
                    CASE WHEN s_nationkey < 12 THEN 'home' ELSE 'away' END AS team,
                    CASE WHEN l_quantity < 50 THEN l_quantity END AS stat_amount, l_partkey, l_discount
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
_HERO = "CASE p_brand " + " ".join(f"WHEN 'Brand#{k}' THEN '{h}'" for k, h in BRAND_HEROES.items()) + " END"
_TIME = f"""{_LINE},
    seconds AS (SELECT player, map_id, map_type, team, hero,
                       CASE WHEN count(stat_amount) = count(*) THEN sum(stat_amount) END AS s
                FROM (SELECT line.*, {_HERO} AS hero FROM line JOIN part ON l_partkey = p_partkey)
                WHERE hero <> 'All Heroes' GROUP BY ALL)"""
_NA = "CASE WHEN count(s) = count(*) THEN sum(s) END"
_ROLE = (
    f"CASE WHEN hero IN ({_listed(fixed.SUPPORT)}) THEN 'support' WHEN hero IN ({_listed(fixed.TANK)}) THEN 'tank' "
    f"WHEN hero IN ({_listed(fixed.HITSCAN + fixed.PROJECTILE)}) THEN 'damage' END"
)
_ALONE = "(contains(heroes, 'Mercy') AND NOT contains(heroes, 'Pharah') AND NOT contains(heroes, 'Echo'))"
_SUBROLE = f"""CASE
    WHEN hero IN ({_listed(fixed.HITSCAN + fixed.PROJECTILE)}) THEN 'DPS'
    WHEN hero = 'Lucio' THEN CASE WHEN {_has('Moira')} OR {_ALONE} THEN 'off_support' ELSE 'main_support' END
    WHEN hero = 'Moira' THEN 'main_support'
    WHEN hero = 'Brigitte' THEN CASE WHEN {_has('Lucio', 'Moira', 'Ana', 'Baptiste')} OR {_ALONE}
        THEN 'off_support' ELSE 'main_support' END
    WHEN hero = 'Zenyatta' THEN 'off_support'
    WHEN hero = 'Ana' THEN CASE WHEN {_has('Lucio', 'Moira', 'Baptiste')} OR {_ALONE}
        THEN 'off_support' ELSE 'main_support' END
    WHEN hero = 'Baptiste' THEN CASE WHEN {_has('Lucio', 'Moira')} OR {_ALONE}
        THEN 'off_support' ELSE 'main_support' END
    WHEN hero = 'Mercy' THEN CASE WHEN {_has('Pharah', 'Echo')} AND NOT {_has('Zenyatta')}
        AND {_has('Moira', 'Lucio')} THEN 'off_support' ELSE 'main_support' END
    WHEN hero IN ('Reinhardt', 'Orisa', 'Winston') THEN 'main_tank'
    WHEN hero = 'Sigma' THEN CASE WHEN {_has('Reinhardt', 'Orisa', 'Winston')} THEN 'off_tank' ELSE 'main_tank' END
    WHEN hero = 'Wrecking Ball' THEN CASE WHEN {_has('Reinhardt', 'Orisa', 'Winston', 'Sigma')}
        THEN 'off_tank' ELSE 'main_tank' END
    WHEN hero = 'Zarya' THEN CASE WHEN {_has('Reinhardt', 'Orisa', 'Winston', 'Sigma', 'Wrecking Ball')}
        THEN 'off_tank' ELSE 'main_tank' END
    WHEN hero = 'D.Va' THEN CASE WHEN {_has('Reinhardt', 'Orisa', 'Winston', 'Sigma', 'Wrecking Ball', 'Zarya')}
        THEN 'off_tank' ELSE 'main_tank' END
    WHEN hero = 'Roadhog' THEN 'off_tank' END"""
_SUBROLES = f"""{_TIME},
    main AS (SELECT player, map_id, map_type, team, hero
             FROM (SELECT *, row_number() OVER (PARTITION BY player, map_id, map_type, team
                                                ORDER BY s DESC NULLS LAST, hero NULLS LAST) AS rn FROM seconds)
             WHERE rn = 1),
    best AS (SELECT player, map_id, team, hero, s
             FROM (SELECT *, row_number() OVER (PARTITION BY player, map_id, team
                                                ORDER BY s DESC NULLS LAST, hero NULLS LAST) AS rn
                   FROM (SELECT player, map_id, team, hero, {_NA} AS s FROM seconds GROUP BY ALL))
             WHERE rn = 1),
    lists AS (SELECT map_id, team, string_agg(coalesce(hero, 'NA'), ', ' ORDER BY s DESC NULLS LAST, player) AS heroes
              FROM best GROUP BY ALL),
    subroles AS (SELECT player, map_id, map_type, team, hero, heroes, {_SUBROLE} AS subrole
                 FROM main JOIN lists USING (map_id, team))"""
_RESULTS = """
    results AS (SELECT CASE WHEN year(o_orderdate) <= 1996 THEN '2018 Stage 1' WHEN year(o_orderdate) <= 1998
                            THEN '2019 Playoffs' ELSE '2020 Regular Season' END AS stage,
                       CASE WHEN year(o_orderdate) <= 1996 THEN '2018' WHEN year(o_orderdate) <= 1998 THEN '2019'
                            ELSE '2020' END AS year,
                       o_orderkey::VARCHAR AS map_id, o_orderpriority AS patch, 'home' AS team_one_name,
                       'away' AS team_two_name,
                       CASE WHEN o_totalprice < 450000 THEN CASE o_orderstatus WHEN 'F' THEN 'home' WHEN 'O' THEN 'away'
                            ELSE 'draw' END END AS map_winner,
                       o_totalprice AS team_one_map_score, o_custkey::DOUBLE AS team_two_map_score,
                       CASE o_custkey % 3 WHEN 0 THEN 'away' WHEN 1 THEN 'home' END AS first_attacker,
                       CASE o_custkey % 3 WHEN 1 THEN 'away' ELSE 'home' END AS first_defender
                FROM orders),
    sides AS (SELECT *, 1.0::DOUBLE AS first_attacker_flg, first_attacker AS player_team, first_defender AS opponent_team,
                     (first_attacker = map_winner)::INT::DOUBLE AS win FROM results
              UNION ALL
              SELECT *, -1.0::DOUBLE, first_defender, first_attacker, (first_defender = map_winner)::INT::DOUBLE
              FROM results)"""


def _stat_case() -> str:
    return "CASE round(l_discount * 100)::INT " + " ".join(
        f"WHEN {k} THEN '{frames.slug(s)}'" for k, s in STAT_BY_DISCOUNT.items()
    ) + " END"


def _wide(stats) -> str:
    cells = ", ".join(
        f"coalesce(CASE WHEN count(s) FILTER (stat = '{c}') = count(*) FILTER (stat = '{c}') "
        f"THEN sum(s) FILTER (stat = '{c}') END, 0) AS {c}"
        for c in map(frames.slug, stats)
    )
    return f"""
    wide AS (SELECT l.map_type, l.player, l.map_id, l.team, coalesce(subrole, '0') AS subrole, {cells}
             FROM (SELECT *, stat_amount AS s, {_stat_case()} AS stat FROM line) l
             JOIN subroles r ON l.map_id = r.map_id AND l.player = r.player
             WHERE stat IN ({_listed(map(frames.slug, stats))}) GROUP BY ALL)"""


def _spread(values) -> str:
    return ", ".join(
        f"coalesce(sum({v}) FILTER (subrole = '{r}'), 0) AS {v}_{r}" for v in values for r in [*fixed.SUBROLES, "0"]
    )


_TEAM_VALUES = [frames.slug(s) for s in fixed.TEAM_STATS if s != "Time Played"] + ["assisted_kills"]
_PLAYER_VALUES = [frames.slug(s) for s in fixed.PLAYER_STATS]
_SIDE_COLUMNS = (
    "stage, s.map_id, patch, team_one_name, team_two_name, map_winner, team_one_map_score, team_two_map_score, "
    "first_attacker, first_defender, first_attacker_flg, player_team, opponent_team, win, year"
)

ORACLES = {
    "match_map_stats": """
        WITH named AS (SELECT CASE WHEN l_orderkey + 15000 = 21352 AND l_linenumber = 1
                                   THEN TIMESTAMP '2019-04-27 16:55:00' ELSE l_shipdate::TIMESTAMP END AS t,
                              CASE o_orderpriority WHEN '1-URGENT' THEN '2018 Stage 1 Regular Season'
                                  WHEN '2-HIGH' THEN '2019 Stage 1 Regular Season'
                                  WHEN '3-MEDIUM' THEN 'OWL APAC All-Stars' WHEN '4-NOT SPECIFIED' THEN 'Some Cup'
                              END AS stage,
                              (l_orderkey + 15000) || '_' || l_partkey AS map_id, l_linenumber::VARCHAR AS map_round,
                              l_suppkey, l_quantity
                       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
             months AS (SELECT 'Patch ' || y || '.' || m AS patch, make_date(y, m, 1) AS a, make_date(y, m, 28) AS b
                        FROM range(1995, 2002) AS ys(y), range(1, 13) AS ms(m))
        SELECT map_id, stage, map_round, l_suppkey, l_quantity, patch, strftime(t, '%Y-%m-%d %H:%M:%S') AS start_time
        FROM named LEFT JOIN months ON t >= a::TIMESTAMP AND t < b::TIMESTAMP + INTERVAL 1 DAY
        WHERE stage IS NULL OR stage NOT IN ('OWL APAC All-Stars', 'OWL North America All-Stars')""",
    "player_stats": """
        WITH log AS (SELECT event_type, user_id, CASE WHEN value < 200 THEN date_trunc('hour', ts) END AS t,
                            CASE event_id % 3 WHEN 0 THEN 'Lucio' WHEN 1 THEN 'Torbjorn' END AS hero,
                            CASE WHEN value < 5 THEN 'exhibition' WHEN value < 30 THEN '2020 Regular Season and Playoffs'
                            END AS stage, value AS stat_amount, event_id FROM events)
        SELECT event_id, map_id, hero, stage, stat_amount
        FROM (SELECT *, user_id || '_' || CASE WHEN t IS NULL THEN 'NA' ELSE
                        dense_rank() OVER (PARTITION BY event_type, user_id, t IS NULL ORDER BY t)::VARCHAR END AS map_id
              FROM log)
        WHERE stage IS NULL OR stage <> 'exhibition'""",
    "player_stats_roles": f"""WITH {_TIME}
        SELECT player, map_id, map_type, team, role
        FROM (SELECT *, row_number() OVER (PARTITION BY player, map_id, map_type, team
                                           ORDER BY s DESC NULLS LAST, role NULLS LAST) AS rn
              FROM (SELECT player, map_id, map_type, team, role, {_NA} AS s
                    FROM (SELECT *, {_ROLE} AS role FROM seconds) GROUP BY ALL))
        WHERE rn = 1""",
    "player_stats_subroles": f"WITH {_SUBROLES} SELECT * FROM subroles",
    "player_role_text": f"""WITH {_SUBROLES}
        SELECT map_id, team, player || '_' || coalesce(subrole, 'NA') AS player_role, map_type FROM subroles""",
    "map_id_gaps": """
        SELECT o_orderkey::VARCHAR AS map_id, 'rounds' AS only_in FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL
        SELECT DISTINCT l_orderkey::VARCHAR, 'players' FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    "team_model_frame": f"""WITH {_SUBROLES}, {_RESULTS}, {_wide(fixed.TEAM_STATS)},
        teams AS (SELECT map_id, map_type, team, {_spread(_TEAM_VALUES)}
                  FROM (SELECT *, final_blows - solo_kills AS assisted_kills FROM wide) GROUP BY ALL)
        SELECT {_SIDE_COLUMNS}, t.* EXCLUDE (map_id, team)
        FROM sides s LEFT JOIN teams t ON s.map_id = t.map_id AND s.player_team = t.team
        WHERE map_winner <> 'draw'""",
    "player_model_frame": f"""WITH {_SUBROLES}, {_RESULTS}, {_wide(fixed.PLAYER_STATS)},
        players AS (SELECT map_id, map_type, player, team, subrole, {_spread(_PLAYER_VALUES)} FROM wide GROUP BY ALL)
        SELECT {_SIDE_COLUMNS}, t.* EXCLUDE (map_id, team)
        FROM sides s LEFT JOIN players t ON s.map_id = t.map_id AND s.player_team = t.team""",
    "lineup_frame": f"""WITH {_SUBROLES}, {_RESULTS},
        lineups AS (SELECT player_team, opponent_team, s.map_id, win, map_type, first_attacker_flg, year,
                           string_agg(coalesce(player, 'NA') || '_' || coalesce(subrole, 'NA'), ';'
                                      ORDER BY player NULLS LAST, coalesce(subrole, 'NA')) AS lineup
                    FROM sides s LEFT JOIN subroles r ON s.map_id = r.map_id AND s.player_team = r.team
                    WHERE map_winner <> 'draw' GROUP BY ALL)
        SELECT a.*, b.lineup AS lineup_opponent
        FROM lineups a JOIN lineups b ON a.map_id = b.map_id AND a.opponent_team IS NOT DISTINCT FROM b.player_team
             AND a.year = b.year""",
}
