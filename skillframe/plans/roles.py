"""Role and subrole of each player per map, from play time and team composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import na_sum
from ..operators.joins import equi_join
from ..operators.lookup import classify, relabel_expr
from ..operators.ranking import top1
from ..operators.reshape import ordered_concat
from ..session import materialize
from .fixed import ALL_HEROES, TIME_PLAYED, hero_roles, subrole_rules

PLAYER_MAP = ["player", "map_id", "map_type", "team"]


def time_on_hero(player_stats: DataFrame) -> DataFrame:
    """Play time per player, map and hero; rows without a hero drop out. All later sums start from this one."""
    played = player_stats.where((F.col("stat_name") == TIME_PLAYED) & (F.col("hero") != ALL_HEROES))
    return played.groupBy(*PLAYER_MAP, "hero").agg(na_sum("stat_amount").alias("seconds"))


def player_roles(time: DataFrame, compat: bool = False) -> DataFrame:
    """Most played role. Heroes outside the lists form a role of their own, NULL, that can win."""
    labelled = time.withColumn("role", relabel_expr(F.col("hero"), hero_roles(compat), default=None))
    sums = labelled.groupBy(*PLAYER_MAP, "role").agg(na_sum("seconds").alias("seconds"))
    return top1(sums, PLAYER_MAP, "seconds", ["role"]).select(*PLAYER_MAP, "role")


def team_rosters(time: DataFrame, team_map: Sequence[str] = ("map_id", "team")) -> DataFrame:
    """The main heroes of a team on a map, most played first, as one text; ``team_map`` are the columns that tell them apart."""
    by_player = ["player", *team_map]
    sums = time.groupBy(*by_player, "hero").agg(na_sum("seconds").alias("seconds"))
    # Keep the time of the winning hero: it orders the roster.
    best = top1(sums.withColumn("time", F.col("seconds")), by_player, "seconds", ["hero"])
    order = ["time DESC NULLS LAST", "player ASC NULLS LAST"]
    return ordered_concat(best, team_map, "hero", order, ", ", "heroes")


#: Rows that a task should get of those dealt by team and map.
DEALT_ROWS = 100_000
#: Team and map as one text, missing ones included, so that equal texts are equal pairs.
_TEAM_MAP = "concat(coalesce(concat(length(map_id), ':', map_id), '-'), coalesce(concat('=', team), ''))"


def player_subroles(time: DataFrame, compat: bool = False) -> DataFrame:
    # Written once for both uses below. Rows dealt by team and map then stay where they are: main heroes, rosters and their join.
    dealt = materialize(time.withColumn("__at", F.expr(_TEAM_MAP)))
    dealt = dealt.repartition(1 + dealt.count() // DEALT_ROWS, "__at")
    main = top1(dealt, ["player", "__at", "map_type"], "seconds", ["hero"])
    with_roster = equi_join(main, team_rosters(dealt, ["__at"]), ["__at"], "left", nullsafe=False)
    return classify(with_roster, subrole_rules(compat), "hero", "heroes", "subrole").select(
        *PLAYER_MAP, "hero", "heroes", "subrole"
    )
