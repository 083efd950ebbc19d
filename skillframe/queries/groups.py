"""Queries for ranks, rosters, rules, reshaping and group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nulls import na_sum, paste
from ..operators.joins import equi_join, natural_join
from ..operators.lookup import Clause, Rule, classify
from ..operators.ranking import dense_rank_id, top1, zscore
from ..operators.reshape import contained, membership, ordered_concat, pivot_sparse, pivot_wide, sparse_cell
from ..plans.results import results_by_map as map_results
from ..plans.results import results_by_match as match_results
from ..session import materialize
from . import table

FLAGS = ["A", "N", "R"]
KINDS = ["click", "error", "purchase", "signup", "view"]

RULES = [
    Rule(("LARGE", "MEDIUM"), "core"),
    Rule(("ECONOMY",), "off", ((Clause(("PROMO",)), Clause(("SMALL",), ("LARGE", "MEDIUM"))),)),
    Rule(("ECONOMY",), "main"),
    Rule(("PROMO",), "off", ((Clause(("LARGE", "STANDARD"), ("SMALL",)),), (Clause(("MEDIUM", "ECONOMY")),))),
    Rule(("PROMO",), "main"),
    Rule(("SMALL",), "main", ((Clause(none_of=("ECONOMY", "PROMO")),),)),
    Rule(("SMALL",), "off"),
]


def dense_rank_id_(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    timed = line.withColumn("at", F.when(F.year("l_shipdate") != 1998, F.col("l_shipdate")))
    ranked = dense_rank_id(timed, ["l_orderkey"], "at", "ship_id", "l_orderkey", F.trunc("at", "month"))
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ship_id")


def main_types(spark, sf):
    """Quantity of the part type a supplier ships most of in an order; the smallest type wins a tie."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    typed = equi_join(line, part, {"l_partkey": "p_partkey"}, nullsafe=False)
    sums = typed.groupBy("l_suppkey", "l_orderkey", "p_type").agg(na_sum("l_quantity").alias("quantity"))
    return top1(sums.withColumn("amount", F.col("quantity")), ["l_suppkey", "l_orderkey"], "quantity", ["p_type"])


def top1_per_group(spark, sf):
    return main_types(spark, sf).select("l_suppkey", "l_orderkey", "p_type", "amount")


def rosters(spark, sf):
    best = main_types(spark, sf)
    order = ["amount DESC NULLS LAST", "l_suppkey ASC NULLS LAST"]
    lists = ordered_concat(best, ["l_orderkey"], "p_type", order, ", ", "roster")
    return natural_join(best.drop("amount"), lists, "left")


def roster_string(spark, sf):
    return rosters(spark, sf).select("l_suppkey", "l_orderkey", "p_type", "roster")


def rule_classifier(spark, sf):
    return classify(rosters(spark, sf), RULES, "p_type", "roster", "subrole").select(
        "l_suppkey", "l_orderkey", "p_type", "subrole"
    )


def member_roles(spark, sf):
    """One row per order and supplier with the text supplier_type; type PROMO counts as missing."""
    best = main_types(spark, sf)
    role = paste("l_suppkey", F.nullif("p_type", F.lit("PROMO")), sep="_")
    return best.select("l_orderkey", "l_suppkey", role.alias("player_role"))


def lineups(spark, sf):
    return _lineups(member_roles(spark, sf))


def _lineups(roles):
    return ordered_concat(roles, ["l_orderkey"], "player_role", ["l_suppkey"], ";", "lineup")


def lineup_string(spark, sf):
    return lineups(spark, sf).select("l_orderkey", "lineup")


def membership_design(spark, sf):
    return membership(lineups(spark, sf), "lineup").select("lineup", "player_role")


def membership_search(spark, sf):
    """Every role that occurs inside a lineup's text, as a whole member or inside a longer one."""
    roles = materialize(member_roles(spark, sf))
    return contained(_lineups(roles), "lineup", roles, "player_role")


def pivot_many_names(spark, sf):
    """Quantity per supplier and part, a cell per part that the supplier has; flag R counts as a part of no name."""
    line = table(spark, sf, "lineitem").select(
        "l_suppkey", F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("part"), F.col("l_quantity").cast("long").alias("quantity"))
    wide = pivot_sparse(line, ["l_suppkey"], "part", ["quantity"])
    shown = F.transform("cells", lambda c: F.concat_ws("=", F.coalesce(c["name"].cast("string"), F.lit("none")), c["quantity"].cast("string")))
    return wide.select("l_suppkey", F.array_join(shown, ";").alias("cells"), F.size("cells").cast("long").alias("n_names"),
                       sparse_cell("cells", 7, "quantity").alias("part_7"), sparse_cell("cells", None, "quantity").alias("no_part"))


def distinct_values(spark, sf):
    return member_roles(spark, sf).select("player_role").distinct()


def pivot_sum_fill(spark, sf):
    events = table(spark, sf, "events").withColumn("v", F.when(F.col("value") <= 200, F.col("value")))
    wide = pivot_wide(events, ["user_id"], "event_type", KINDS, ["v"])
    wide = wide.withColumn("difference", F.col("view") - F.col("click"))
    return wide.select("user_id", *[F.round(c, 4).alias(c) for c in [*KINDS, "difference"]])


def pivot_multi_value(spark, sf):
    line = table(spark, sf, "lineitem").withColumnsRenamed({"l_quantity": "quantity", "l_extendedprice": "price"})
    wide = pivot_wide(line, ["l_orderkey"], "l_returnflag", FLAGS, ["quantity", "price"])
    return wide.select("l_orderkey", *[F.round(f"{v}_{f}", 4).alias(f"{v}_{f}") for v in ("quantity", "price") for f in FLAGS])


def player_pivot_keep_key(spark, sf):
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", F.col("l_returnflag").alias("flag2"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    wide = pivot_wide(line, ["l_orderkey", "l_returnflag"], "flag2", FLAGS, ["quantity", "price"])
    return wide.select(
        "l_orderkey", "l_returnflag",
        *[F.round(f"{v}_{f}", 4).alias(f"{v}_{f}") for v in ("quantity", "price") for f in FLAGS],
    )


def group_zscore(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("signup")).alias("kind"),
        F.when(F.col("value") <= 300, F.col("value")).alias("v"),
    )
    scaled = zscore(events, ["kind"], "v", "z")
    return scaled.select("event_id", "kind", F.round("z", 6).alias("z"))


def rounds_of_orders(spark, sf):
    """Line items dressed as round logs: the order is the match, the line number the map."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    line = equi_join(table(spark, sf, "lineitem"), orders, {"l_orderkey": "o_orderkey"}, nullsafe=False)
    one = F.col("l_returnflag")
    two = F.when(one == "A", "R").when(one == "R", "N").otherwise("A")
    winner = F.when(F.col("l_quantity") < 25, "A").when(F.col("l_quantity") < 45, "R").when(F.col("l_quantity") < 49, "draw")
    game = (F.col("l_linenumber") * 3).cast("string")
    return line.select(
        F.col("o_orderpriority").alias("stage"), F.col("l_orderkey").alias("match_id"),
        F.concat_ws("_", "l_orderkey", game).alias("map_id"), F.col("o_orderstatus").alias("patch"),
        one.alias("team_one_name"), two.alias("team_two_name"), F.col("l_linestatus").alias("match_winner"),
        winner.alias("map_winner"), game.alias("game_number"),
        F.col("l_extendedprice").alias("winning_team_final_map_score"),
        F.col("l_discount").alias("losing_team_final_map_score"), F.col("l_returnflag").alias("attacker"),
        F.col("l_shipdate").alias("round_start_time"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
    )


ROUND_ORDER = ["round_start_time", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax"]


def results_by_map(spark, sf):
    return map_results(rounds_of_orders(spark, sf), ROUND_ORDER)


def results_by_match(spark, sf):
    maps = map_results(rounds_of_orders(spark, sf), ROUND_ORDER)
    return match_results(maps)


QUERIES = {
    "dense_rank_id": dense_rank_id_,
    "top1_per_group": top1_per_group,
    "roster_string": roster_string,
    "rule_classifier": rule_classifier,
    "lineup_string": lineup_string,
    "membership_design": membership_design,
    "membership_search": membership_search,
    "pivot_many_names": pivot_many_names,
    "distinct_values": distinct_values,
    "pivot_sum_fill": pivot_sum_fill,
    "pivot_multi_value": pivot_multi_value,
    "player_pivot_keep_key": player_pivot_keep_key,
    "group_zscore": group_zscore,
    "results_by_map": results_by_map,
    "results_by_match": results_by_match,
}

_MAIN = """
    main AS (SELECT l_suppkey, l_orderkey, p_type, amount
             FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY amount DESC, p_type) AS rn
                   FROM (SELECT l_suppkey, l_orderkey, p_type, sum(l_quantity) AS amount
                         FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL))
             WHERE rn = 1)"""
_ROSTER = f"""WITH {_MAIN},
    lists AS (SELECT l_orderkey, string_agg(p_type, ', ' ORDER BY amount DESC, l_suppkey) AS roster
              FROM main GROUP BY 1)"""
_ROLES = f"""WITH {_MAIN},
    roles AS (SELECT l_orderkey, l_suppkey,
                     l_suppkey || '_' || coalesce(nullif(p_type, 'PROMO'), 'NA') AS player_role FROM main),
    lineups AS (SELECT l_orderkey, string_agg(player_role, ';' ORDER BY l_suppkey) AS lineup FROM roles GROUP BY 1)"""


def _sum(value: str, flag: str) -> str:
    return (
        f"round(coalesce(sum({value}) FILTER (l_returnflag = '{flag}'), 0), 4)"
    )


_PIVOT = ", ".join(
    f"{_sum(col, flag)} AS {name}_{flag}"
    for name, col in (("quantity", "l_quantity"), ("price", "l_extendedprice"))
    for flag in FLAGS
)
_NA_CELL = (
    "coalesce(CASE WHEN count(v) FILTER (event_type = '{k}') = count(*) FILTER (event_type = '{k}') "
    "THEN sum(v) FILTER (event_type = '{k}') END, 0)"
)
_EVENT_CELLS = ", ".join(f"{_NA_CELL.format(k=k)} AS {k}" for k in KINDS)

_ROUNDS = """
    rounds AS (SELECT o_orderpriority AS stage, l_orderkey AS match_id,
                      l_orderkey || '_' || (l_linenumber * 3) AS map_id, o_orderstatus AS patch,
                      l_returnflag AS team_one_name,
                      CASE l_returnflag WHEN 'A' THEN 'R' WHEN 'R' THEN 'N' ELSE 'A' END AS team_two_name,
                      l_linestatus AS match_winner,
                      CASE WHEN l_quantity < 25 THEN 'A' WHEN l_quantity < 45 THEN 'R' WHEN l_quantity < 49 THEN 'draw'
                      END AS map_winner,
                      (l_linenumber * 3)::VARCHAR AS game_number, l_extendedprice AS high, l_discount AS low,
                      l_returnflag AS first_attacker,
                      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey,
                                         l_suppkey, l_quantity, l_extendedprice, l_tax) AS rn
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    maps AS (SELECT stage, match_id, map_id, patch, team_one_name, team_two_name, match_winner, map_winner, game_number,
                    CASE WHEN map_winner IS NULL THEN NULL WHEN team_one_name = map_winner THEN high ELSE low END
                        AS team_one_map_score,
                    CASE WHEN map_winner IS NULL THEN NULL WHEN team_one_name = map_winner THEN low ELSE high END
                        AS team_two_map_score,
                    first_attacker
             FROM rounds WHERE rn = 1)"""

ORACLES = {
    "dense_rank_id": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_orderkey || '_' || CASE WHEN t IS NULL THEN 'NA'
                   ELSE (dense_rank() OVER (PARTITION BY l_orderkey, t IS NULL ORDER BY t))::VARCHAR END AS ship_id
        FROM (SELECT *, CASE WHEN year(l_shipdate) <> 1998 THEN l_shipdate END AS t FROM lineitem)""",
    "top1_per_group": f"WITH {_MAIN} SELECT l_suppkey, l_orderkey, p_type, amount FROM main",
    "roster_string": f"{_ROSTER} SELECT l_suppkey, l_orderkey, p_type, roster FROM main JOIN lists USING (l_orderkey)",
    "rule_classifier": f"""{_ROSTER}
        SELECT l_suppkey, l_orderkey, p_type,
               CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'core'
                    WHEN p_type = 'ECONOMY' AND (contains(roster, 'PROMO') OR (contains(roster, 'SMALL')
                         AND NOT (contains(roster, 'LARGE') OR contains(roster, 'MEDIUM')))) THEN 'off'
                    WHEN p_type = 'ECONOMY' THEN 'main'
                    WHEN p_type = 'PROMO' AND (contains(roster, 'LARGE') OR contains(roster, 'STANDARD'))
                         AND NOT contains(roster, 'SMALL')
                         AND (contains(roster, 'MEDIUM') OR contains(roster, 'ECONOMY')) THEN 'off'
                    WHEN p_type = 'PROMO' THEN 'main'
                    WHEN p_type = 'SMALL' AND NOT contains(roster, 'ECONOMY') AND NOT contains(roster, 'PROMO') THEN 'main'
                    WHEN p_type = 'SMALL' THEN 'off' END AS subrole
        FROM main JOIN lists USING (l_orderkey)""",
    "lineup_string": f"{_ROLES} SELECT l_orderkey, lineup FROM lineups",
    "membership_design": f"""{_ROLES}
        SELECT DISTINCT lineup, player_role
        FROM (SELECT lineup, unnest(string_split(lineup, ';')) AS player_role FROM lineups)""",
    "pivot_many_names": """
        SELECT l_suppkey, string_agg(coalesce(part::VARCHAR, 'none') || '=' || q, ';' ORDER BY part NULLS LAST) AS cells,
               count(*) AS n_names, coalesce(max(q) FILTER (part = 7), 0)::BIGINT AS part_7,
               coalesce(max(q) FILTER (part IS NULL), 0)::BIGINT AS no_part
        FROM (SELECT l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS part, sum(l_quantity::BIGINT)::BIGINT AS q
              FROM lineitem GROUP BY ALL) GROUP BY l_suppkey""",
    "membership_search": f"""{_ROLES}
        SELECT lineup, player_role FROM (SELECT DISTINCT lineup FROM lineups) JOIN (SELECT DISTINCT player_role FROM roles)
             ON contains(lineup, player_role)""",
    "distinct_values": f"{_ROLES} SELECT DISTINCT player_role FROM roles",
    "pivot_sum_fill": f"""
        SELECT user_id, {', '.join(f'round({k}, 4) AS {k}' for k in KINDS)}, round(view - click, 4) AS difference
        FROM (SELECT user_id, {_EVENT_CELLS}
              FROM (SELECT *, CASE WHEN value <= 200 THEN value END AS v FROM events) GROUP BY user_id)""",
    "pivot_multi_value": f"SELECT l_orderkey, {_PIVOT} FROM lineitem GROUP BY l_orderkey",
    "player_pivot_keep_key": f"SELECT l_orderkey, l_returnflag, {_PIVOT} FROM lineitem GROUP BY l_orderkey, l_returnflag",
    "group_zscore": """
        SELECT event_id, kind,
               round((v - avg(v) OVER (PARTITION BY kind)) / nullif(stddev_samp(v) OVER (PARTITION BY kind), 0), 6) AS z
        FROM (SELECT event_id, nullif(event_type, 'signup') AS kind, CASE WHEN value <= 300 THEN value END AS v
              FROM events)""",
    "results_by_map": f"WITH {_ROUNDS} SELECT * FROM maps",
    "results_by_match": f"""WITH {_ROUNDS},
        first AS (SELECT stage, match_id, patch, team_one_name, team_two_name, match_winner
                  FROM (SELECT *, row_number() OVER (PARTITION BY stage, match_id, patch ORDER BY map_id) AS k FROM maps)
                  WHERE k = 1),
        scored AS (SELECT f.*, max(m.game_number) AS games,
                          CASE WHEN count(m.map_winner) = count(*) THEN
                              sum((f.team_one_name = m.map_winner)::INT)::BIGINT END AS team_one_match_score,
                          CASE WHEN count(m.map_winner) = count(*) THEN
                              sum((f.team_two_name = m.map_winner)::INT)::BIGINT END AS team_two_match_score
                   FROM first f JOIN maps m USING (stage, match_id, patch) GROUP BY ALL)
        SELECT *, games::DOUBLE - (team_one_match_score + team_two_match_score) AS ties FROM scored""",
}
