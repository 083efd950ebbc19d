"""Rounds to map results, map results to match results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import ifelse3
from ..operators.joins import equi_join
from ..operators.ranking import first_by

ROUND_ORDER = ("round_start_time", "map_round")


def results_by_map(rounds: DataFrame, order: Sequence[Column | str] = ROUND_ORDER) -> DataFrame:
    """First round of each map in the given order, with scores turned from winner/loser to team one/team two."""
    keys = ["stage", "match_id", "map_id", "patch"]
    cols = [
        "team_one_name", "team_two_name", "match_winner", "map_winner", "game_number",
        "winning_team_final_map_score", "losing_team_final_map_score", "attacker",
    ]
    first = first_by(rounds, keys, order, cols)
    one_won = F.col("team_one_name") == F.col("map_winner")
    high, low = F.col("winning_team_final_map_score"), F.col("losing_team_final_map_score")
    return first.select(
        *keys, "team_one_name", "team_two_name", "match_winner", "map_winner", "game_number",
        ifelse3(one_won, high, low).alias("team_one_map_score"),
        ifelse3(one_won, low, high).alias("team_two_map_score"),
        F.col("attacker").alias("first_attacker"),
    )


def results_by_match(
    maps: DataFrame,
    keys: Sequence[str] = ("stage", "match_id", "patch"),
    order: Sequence[str] = ("map_id",),
) -> DataFrame:
    """Match score from map winners, compared with the team names of the match's first map.

    The number of games is the largest game number as text. One missing winner leaves the scores missing. Winners are
    counted per match before they meet the names, so a match is never gathered row by row.
    """
    keys = list(keys)
    names = ["team_one_name", "team_two_name", "match_winner"]
    first = first_by(maps, keys, list(order), names)
    counts = maps.groupBy(*keys, "map_winner").agg(
        F.count(F.lit(1)).alias("n"), F.max("game_number").alias("games")
    )
    joined = equi_join(counts, first, keys)

    def wins(team: str) -> Column:
        hit = F.col(team) == F.col("map_winner")
        known = F.count(F.when(hit.isNotNull(), F.lit(1))) == F.count(F.lit(1))
        return F.when(known, F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0))))

    scored = joined.groupBy(*keys, *names).agg(
        F.max("games").alias("games"),
        wins("team_one_name").alias("team_one_match_score"),
        wins("team_two_name").alias("team_two_match_score"),
    )
    ties = F.col("games").try_cast("double") - (F.col("team_one_match_score") + F.col("team_two_match_score"))
    return scored.select(
        *keys, *names, "games", "team_one_match_score", "team_two_match_score", ties.alias("ties")
    )
