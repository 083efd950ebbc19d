"""The win model on team statistics and the player scores it gives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.design import Term
from ..models.glm import LogitFit, fit_logit, fit_logit_by, score_link, score_map_advantage
from ..operators.ranking import zscore
from ..session import materialize
from .fixed import NEUTRAL_MAP_TYPE, PLAYER_STATS, SEASONS, SUBROLES
from .frames import model_frame, player_stats_wide, slug, team_stats

FLAG = "first_attacker_flg"
MAP_TERM = Term("map_type", FLAG)
MODEL_STATS = [f"{slug(s)}_{r}" for s in PLAYER_STATS for r in SUBROLES]
WIN_TERMS = [MAP_TERM, *[Term(s, "year") for s in MODEL_STATS]]


def team_frame(
    results: DataFrame, player_stats: DataFrame, subroles: DataFrame, seasons: Sequence[str] = SEASONS
) -> DataFrame:
    return model_frame(results, team_stats(player_stats, subroles), drop_draws=True, seasons=seasons)


def fit_win_model(frame: DataFrame) -> LogitFit:
    """Win on who attacked first, by map type, and on deaths and final blows by subrole and season."""
    return fit_logit(frame, "win", WIN_TERMS)


def coefficients_by_season(frame: DataFrame) -> DataFrame:
    """The same statistics with one fit per season: term, estimate, std_error, statistic, p_value, year."""
    return fit_logit_by(frame, "win", [MAP_TERM, *[Term(s) for s in MODEL_STATS]], "year")


def player_frame(
    results: DataFrame, player_stats: DataFrame, subroles: DataFrame, seasons: Sequence[str] = SEASONS
) -> DataFrame:
    return model_frame(results, player_stats_wide(player_stats, subroles), drop_draws=False, seasons=seasons)


def stat_scores(
    results: DataFrame, player_stats: DataFrame, subroles: DataFrame, fit: LogitFit, seasons: Sequence[str] = SEASONS,
    frame: DataFrame | None = None,
) -> DataFrame:
    """Log-odds each player's own statistics add, the same scaled within the subrole, and the map's own share.

    ``frame`` is the ``player_frame`` of the first three, where it has been written already.
    """
    frame = player_frame(results, player_stats, subroles, seasons) if frame is None else frame
    scored = score_link(frame, fit, WIN_TERMS, "score", {FLAG: 0.0})
    neutral = F.col("map_type") == NEUTRAL_MAP_TYPE
    scored = score_map_advantage(scored, fit, WIN_TERMS, MODEL_STATS, neutral, "map_adv_score")
    kept = ["year", "stage", "map_id", "patch", "map_type", "player_team", "subrole", "player", "score"]
    # The group statistics and the final rows both start here: compute the joins once.
    scored = materialize(scored.select(*kept, "map_adv_score"))
    return zscore(scored, ["subrole"], "score", "scaled_score").select(*kept, "scaled_score", "map_adv_score")
