"""Two-sided frames: every result seen from both teams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col
from .joins import equi_join


def other_side(first: str, one: str, two: str) -> Column:
    """The team that is not ``first``; team one when ``first`` is missing or neither."""
    return F.when(F.col(one) == F.col(first), F.col(two)).otherwise(F.col(one))


def two_sided(
    results: DataFrame,
    stats: DataFrame,
    key: str,
    first: str,
    second: str,
    winner: str,
    stats_side: str,
    drop_draws: bool,
    flag: str = "first_attacker_flg",
    dealt: str | None = None,
) -> DataFrame:
    """Each result twice, once per side, joined with that side's statistics.

    Adds ``flag`` (1 for ``first``, -1 for ``second``), ``win`` and the two team columns ``player_team`` and
    ``opponent_team``. Results are unfolded before the join, so statistics are shuffled once, not once per side.
    With ``drop_draws`` draws and missing winners leave; without it a draw is a win for nobody. ``dealt``: as in ``equi_join``.
    """
    if drop_draws:
        results = results.where(F.col(winner) != "draw")
    sides = F.array(
        F.struct(F.lit(1.0).alias("f"), F.col(first).alias("t"), F.col(second).alias("o")),
        F.struct(F.lit(-1.0).alias("f"), F.col(second).alias("t"), F.col(first).alias("o")),
    )
    unfolded = results.select("*", F.explode(sides).alias("__side")).select(
        *results.columns,
        F.col("__side.f").alias(flag),
        F.col("__side.t").alias("player_team"),
        F.col("__side.o").alias("opponent_team"),
    )
    won = (F.col("player_team") == F.col(winner)).cast("double")
    return equi_join(unfolded.withColumn("win", won), stats, {key: key, "player_team": stats_side}, "left", dealt=dealt)


def signed_mean(df: DataFrame, keys: Sequence[str], side: str, positive: str, value: Column | str, out: str) -> DataFrame:
    """Mean of ``value`` per group, counted negative on any side but ``positive``."""
    v = as_col(value)
    return df.groupBy(*keys).agg(F.avg(F.when(F.col(side) == positive, v).otherwise(-v)).alias(out))
