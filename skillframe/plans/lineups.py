"""Lineup frame, lineup effects and the player scores derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import paste
from ..models.design import Term
from ..models.laplace import fit_crossed_laplace
from ..models.mixed import fit_crossed_logit
from ..models.ridge import best_lambda, ridge_cv, ridge_fit
from ..operators.joins import equi_join
from ..operators.reshape import membership, ordered_concat
from ..operators.sides import signed_mean
from ..session import materialize
from .fixed import SEASONS
from .frames import MAP, model_frame

#: The column that holds ``MAP``: rows are dealt by it once.
DEALT = "__map"
SIDE = ["player_team", "opponent_team", "map_id", "win", "map_type", "first_attacker_flg", "year"]


def side_players(results: DataFrame, subroles: DataFrame, seasons: Sequence[str] = SEASONS) -> DataFrame:
    """One row per side of a decided map and player, all ``seasons`` at once; ``DEALT`` is kept where players have it."""
    if DEALT not in subroles.columns:
        subroles = subroles.withColumn(DEALT, F.expr(MAP))
    players = subroles.select("player", "map_id", "team", "map_type", "subrole", DEALT)
    framed = model_frame(results, players, drop_draws=True, seasons=seasons, dealt=DEALT)
    return framed.withColumn("player_role", paste("player", "subrole", sep="_")).where(F.col("year").isNotNull())


def lineup_frame(sides: DataFrame) -> DataFrame:
    """One row per side and map with its lineup, paired with the opponent's lineup on the same map."""
    # Players and results come dealt by map, so no grouping here moves a row again; sorted rows are added up as they pass.
    by_map = [DEALT, "map_id", "year"]
    keys = [*by_map, *[c for c in SIDE if c not in by_map]]
    order = ["player ASC NULLS LAST", "player_role"]
    lineups = ordered_concat(sides.sortWithinPartitions(*keys), keys, "player_role", order, ";", "lineup")
    # A map has two sides, so its lineups meet in one short array instead of a join of the table with itself.
    own = [c for c in lineups.columns if c not in by_map]
    sides_of = lineups.sortWithinPartitions(*by_map).groupBy(*by_map).agg(F.collect_list(F.struct(*own)).alias("sides"))
    each = sides_of.select("map_id", "year", "sides", F.explode("sides").alias("a"))
    against = F.filter("sides", lambda b: b["player_team"].eqNullSafe(F.col("a.opponent_team")))
    return each.select(
        *[F.col(c) if c in ("map_id", "year") else F.col(f"a.{c}") for c in [*SIDE, "lineup"]], F.explode(against).alias("b")
    ).select(*SIDE, "lineup", F.col("b.lineup").alias("lineup_opponent"))


def lineup_roles(frame: DataFrame) -> DataFrame:
    """The player roles of a frame's lineups, each lineup taken apart once."""
    lineups = frame.select("lineup").distinct()
    return lineups.select(F.explode(F.split("lineup", ";")).alias("player_role")).distinct()


def lineup_scores(frame: DataFrame, tol: float = 1e-4, method: str = "pql") -> DataFrame:
    """Lineup effects of one season: lineup, n, estimate, team.

    ``method='laplace'`` estimates the variances by the marginal likelihood, in more jobs a round; ``'pql'`` lets them run low.
    """
    if method not in ("pql", "laplace"):
        raise ValueError(f"unknown method: {method}")
    fitter = fit_crossed_laplace if method == "laplace" else fit_crossed_logit
    fit = fitter(frame, "win", Term("map_type", "first_attacker_flg"), ("lineup", "lineup_opponent"), tol=tol)
    effects = signed_mean(fit.effects, ["grp"], "grpvar", "lineup", "condval", "estimate")
    counts = frame.groupBy("lineup", "player_team").agg(F.count(F.lit(1)).alias("n"))
    joined = equi_join(counts, effects, {"lineup": "grp"})
    return joined.select("lineup", "n", "estimate", F.col("player_team").alias("team"))


def player_scores(
    lineups: DataFrame, roles: DataFrame, mode: str = "exact", lambda_scale: str = "response_sd", seed: int = 0
) -> DataFrame:
    """Ridge coefficient of every player role of one season; roles in no rated lineup score 0."""
    members = materialize(membership(lineups, "lineup", ";", mode, roles))
    targets = lineups.select("lineup", "estimate", "n")
    lam = best_lambda(ridge_cv(members, targets, seed=seed, lambda_scale=lambda_scale))
    scores = ridge_fit(members, targets, lam, lambda_scale).withColumnsRenamed(
        {"member": "players", "estimate": "score"}
    )
    everyone = roles.select(F.col("player_role").alias("players")).distinct()
    return equi_join(everyone, scores, ["players"], "left").na.fill(0.0, ["score"])


def rate_seasons(
    results: DataFrame, subroles: DataFrame, tol: float = 1e-4, seasons: Sequence[str] = SEASONS, method: str = "pql"
) -> tuple[DataFrame, DataFrame]:
    """(player scores, lineup scores) of all seasons that have decided maps; the frame is built once for all."""
    sides = materialize(side_players(results, subroles, seasons))
    frame = materialize(lineup_frame(sides))
    years = sorted(r[0] for r in frame.select("year").distinct().collect())
    players, lineups = [], []
    for year in years:
        season = frame.where(F.col("year") == year)
        rated = materialize(lineup_scores(season, tol, method))
        roles = sides.where(F.col("year") == year).select("player_role").distinct()
        lineups.append(rated.withColumn("year", F.lit(int(year))))
        players.append(player_scores(rated, roles).withColumn("year", F.lit(int(year))))
    if not lineups:
        raise ValueError("no season has a decided map")
    return _stack(players), _stack(lineups)


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
