"""Files to clean tables: rounds, player statistics, patches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.nulls import not_in_keep_null, paste
from ..operators.joins import interval_join
from ..operators.lookup import apply_corrections, relabel
from ..operators.ranking import dense_rank_id
from ..sources.files import conform, read_dialects, read_text_csv, refused_cells, refused_in_dialects
from .fixed import (
    EXHIBITIONS,
    HEROES,
    PLAYER_DEFAULT,
    PLAYER_DIALECTS,
    PLAYER_SCHEMA,
    ROUND_DIALECT,
    ROUND_FILE,
    ROUND_SCHEMA,
    STAGES,
    START_TIME_FIXES,
)


def read_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return conform(read_text_csv(spark, f"{folder}/{ROUND_FILE}"), ROUND_DIALECT, ROUND_SCHEMA)


def read_players(spark: SparkSession, folder: str) -> DataFrame:
    return read_dialects(spark, folder, PLAYER_DIALECTS, PLAYER_DEFAULT, PLAYER_SCHEMA, exclude=[ROUND_FILE])


def read_refused(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the round and player files that hold text but no readable value: file_name, column_name, cell."""
    rounds = refused_cells(read_text_csv(spark, f"{folder}/{ROUND_FILE}"), ROUND_DIALECT, ROUND_SCHEMA)
    players = refused_in_dialects(spark, folder, PLAYER_DIALECTS, PLAYER_DEFAULT, PLAYER_SCHEMA, exclude=[ROUND_FILE])
    return rounds.unionByName(players)


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """Patch calendar with true dates."""
    raw = read_text_csv(spark, path)
    return raw.select(
        F.col("Patch").alias("patch"),
        parse_date(F.col("`Start Date`")).alias("start_date"),
        parse_date(F.col("`End Date`")).alias("end_date"),
    )


def clean_rounds(rounds: DataFrame) -> DataFrame:
    """Map id, stage names, known time errors, no exhibitions."""
    spark = rounds.sparkSession
    named = relabel(rounds.withColumn("map_id", paste("match_id", "game_number", sep="_")), "stage", STAGES)
    fixes = spark.createDataFrame(START_TIME_FIXES, "match_id string, map_round string, t string").select(
        "match_id", "map_round", F.col("t").cast("timestamp_ntz").alias("round_start_time")
    )
    fixed = apply_corrections(named, fixes, ["match_id", "map_round"], "round_start_time")
    return fixed.where(not_in_keep_null("stage", EXHIBITIONS))


def add_patches(rounds: DataFrame, patches: DataFrame, bounds: str = "whole_day") -> DataFrame:
    return interval_join(rounds, patches, "round_start_time", "start_date", "end_date", bounds)


def clean_players(players: DataFrame) -> DataFrame:
    """Hero and stage names, map id from the order of start times within a file's match, no exhibitions.

    Ranks count exhibition maps too, because they are taken before the exhibitions leave.
    """
    named = relabel(relabel(players, "hero", HEROES), "stage", STAGES)
    ranked = dense_rank_id(named, ["file_name", "match_id"], "start_time", "map_id", "match_id")
    return ranked.where(not_in_keep_null("stage", EXHIBITIONS)).drop("file_name")


def map_id_gaps(rounds: DataFrame, players: DataFrame) -> DataFrame:
    """Map ids that occur on one side only; ids come from game numbers there and from time ranks here."""
    # One shuffle of both sides' ids; missing ids match nothing, so they are listed for every side that has them.
    ids = rounds.select("map_id", F.lit("rounds").alias("side")).unionByName(players.select("map_id", F.lit("players").alias("side")))
    held = ids.groupBy("map_id").agg(F.bool_or(F.col("side") == "rounds").alias("a"), F.bool_or(F.col("side") == "players").alias("b"))
    sides = F.array_compact(F.array(F.when(F.col("a"), F.lit("rounds")), F.when(F.col("b"), F.lit("players"))))
    return held.where("map_id IS NULL OR NOT (a AND b)").select("map_id", F.explode(sides).alias("only_in"))
