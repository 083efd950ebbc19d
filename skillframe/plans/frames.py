"""Model frames: statistics per team or player, turned wide and put next to map results from both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_contained, slugify
from ..operators.joins import equi_join
from ..operators.reshape import pivot_wide
from ..operators.sides import other_side, two_sided
from .fixed import ALL_HEROES, PLAYER_STATS, SEASONS, SUBROLES, TEAM_STATS

RESULT_COLUMNS = [
    "stage", "map_id", "patch", "team_one_name", "team_two_name", "map_winner", "team_one_map_score",
    "team_two_map_score", "first_attacker",
]


def slug(name: str) -> str:
    """``slugify`` for a name known in advance."""
    return "".join(ch for ch in name if ch.isalnum() or ch == " ").replace(" ", "_").lower()


def stats_with_subrole(player_stats: DataFrame, subroles: DataFrame, stats: Sequence[str]) -> DataFrame:
    """Totals over heroes joined with the player's subrole on map and player; missing keys match nothing."""
    totals = player_stats.where((F.col("hero") == ALL_HEROES) & F.col("stat_name").isin(*stats)).select(
        "map_type", "player", "map_id", "team", slugify("stat_name").alias("stat_name"), "stat_amount"
    )
    return equi_join(totals, subroles.select("map_id", "player", "subrole"), ["map_id", "player"], nullsafe=False)


def wide_by_player(long: DataFrame, stats: Sequence[str]) -> DataFrame:
    """One row per player, map and subrole with one column per statistic; missing cells and texts are filled."""
    ids = ["map_type", "player", "map_id", "team", "subrole"]
    return pivot_wide(long, ids, "stat_name", [slug(s) for s in stats], ["stat_amount"])


# The fill leaves nothing missing, so the second pivot sums plainly.
def _subroles_with_missing(subroles: Sequence[str] | None) -> list[str] | None:
    return None if subroles is None else [*subroles, "0"]  # the fill turns a missing subrole into the text 0


def team_stats(player_stats: DataFrame, subroles: DataFrame, names: Sequence[str] | None = SUBROLES) -> DataFrame:
    """Statistics of a team on a map, one column per statistic and subrole; ``names=None`` takes all subroles present."""
    players = wide_by_player(stats_with_subrole(player_stats, subroles, TEAM_STATS), TEAM_STATS)
    players = players.withColumn("assisted_kills", F.col("final_blows") - F.col("solo_kills"))
    values = [slug(s) for s in TEAM_STATS if s != "Time Played"] + ["assisted_kills"]
    return pivot_wide(players, ["map_id", "map_type", "team"], "subrole", _subroles_with_missing(names), values, F.sum)


def player_stats_wide(player_stats: DataFrame, subroles: DataFrame, names: Sequence[str] | None = SUBROLES) -> DataFrame:
    """The same at player grain: the player's own statistics stand under the player's subrole, zeros elsewhere."""
    players = wide_by_player(stats_with_subrole(player_stats, subroles, PLAYER_STATS), PLAYER_STATS)
    values = [slug(s) for s in PLAYER_STATS]
    kept = players.withColumn("subrole_column", F.col("subrole"))
    ids = ["map_id", "map_type", "player", "team", "subrole"]
    return pivot_wide(kept, ids, "subrole_column", _subroles_with_missing(names), values, F.sum)


def season(stage: str | Column = "stage", seasons: Sequence[str] = SEASONS) -> Column:
    return first_contained(stage, seasons)


def seasons_of(results: DataFrame) -> tuple[str, ...]:
    """The years that stage names hold, in order: what ``seasons`` takes to leave no season out."""
    year = F.regexp_extract("stage", r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1).alias("year")
    return tuple(sorted(r["year"] for r in results.select(year).where("year <> ''").distinct().collect()))


#: A map's name as a text that is never missing.
MAP = "coalesce(concat('=', map_id), '')"


def model_frame(
    results: DataFrame, stats: DataFrame, drop_draws: bool, seasons: Sequence[str] = SEASONS, dealt: str | None = None
) -> DataFrame:
    """Each map from both sides with that side's statistics, the outcome and the season (NULL outside ``seasons``).

    ``dealt`` names the column of ``stats`` that holds ``MAP``; both tables are then dealt by map, and the column stays.
    """
    named = [F.expr(MAP).alias(dealt)] if dealt else []
    sides = results.select(*RESULT_COLUMNS, *named).withColumn(
        "first_defender", other_side("first_attacker", "team_one_name", "team_two_name")
    )
    framed = two_sided(
        sides, stats, "map_id", "first_attacker", "first_defender", "map_winner", "team", drop_draws, dealt=dealt)
    return framed.withColumn("year", season(seasons=seasons))
