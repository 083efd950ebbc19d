"""All tables from a folder of files, in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..session import configure, materialize, scratch
from ..sources.files import read_table, write_table
from . import frames, ingest, lineups, results, roles, scores


def run(
    spark: SparkSession, source: str, patches: str, target: str, bounds: str = "whole_day", tol: float = 1e-4,
    refused: bool = False, seasons: Sequence[str] | None = None,
) -> None:
    """Read the CSV files in ``source`` and the patch calendar, write every table and the model to ``target``.

    ``seasons`` are the years to rate; None takes every year that a stage name holds.
    ``refused`` also writes ``refused_cells``, the cells that could not be read, in a further pass over the files.
    Each stage starts from the written table of the one before, so a lost executor costs one stage at most.
    """
    with scratch(configure(spark)):
        _write_all(spark, source, patches, target, bounds, tol, seasons)
        if refused:
            write_table(ingest.read_refused(spark, source), target, "refused_cells")


def _write_all(
    spark: SparkSession, source: str, patches: str, target: str, bounds: str, tol: float,
    seasons: Sequence[str] | None,
) -> None:
    write_table(ingest.read_patches(spark, patches), target, "patch_map")
    rounds = ingest.add_patches(
        ingest.clean_rounds(ingest.read_rounds(spark, source)), read_table(spark, target, "patch_map"), bounds
    )
    write_table(rounds, target, "match_map_stats")
    # Ranking reads the log twice; the typed copy spares the second pass over the text files.
    players = materialize(ingest.read_players(spark, source))
    write_table(ingest.clean_players(players), target, "player_stats")

    by_map = results.results_by_map(read_table(spark, target, "match_map_stats"))
    write_table(by_map, target, "results_by_map")
    by_map = read_table(spark, target, "results_by_map")
    write_table(results.results_by_match(by_map), target, "results_by_match")

    player_stats = read_table(spark, target, "player_stats")
    time = materialize(roles.time_on_hero(player_stats))
    write_table(roles.player_roles(time), target, "player_stats_roles")
    write_table(roles.player_subroles(time), target, "player_stats_subroles")
    subroles = read_table(spark, target, "player_stats_subroles")

    seasons = frames.seasons_of(by_map) if seasons is None else seasons
    fit = scores.fit_win_model(scores.team_frame(by_map, player_stats, subroles, seasons))
    fit.save(spark, f"{target}/models/stat_model")
    write_table(scores.stat_scores(by_map, player_stats, subroles, fit, seasons), target, "stat_scores")

    player_table, lineup_table = lineups.rate_seasons(by_map, subroles, tol, seasons)
    write_table(player_table, target, "on_off_player_scores")
    write_table(lineup_table, target, "on_off_lineup_scores")
