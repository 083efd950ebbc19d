"""First, top and rank within groups, without ever holding one group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import paste
from ..session import materialize
from .joins import equi_join


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], cols: Sequence[str]) -> DataFrame:
    """The values of the first row of each group in the given order (NULL values count, NULL order comes last).

    The filter on the row number lets Spark cut every group to one row before the shuffle.
    """
    ordering = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    w = W.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("__row", F.row_number().over(w)).where("__row = 1").select(*keys, *cols)


def top1(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str]) -> DataFrame:
    """The row with the largest ``by`` in each group; NULL loses, ties go to the smallest ``ties``. Drops ``by``."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    cols = [c for c in df.columns if c not in keys and c != by]
    return first_by(df, keys, order, cols)


def dense_rank_id(
    df: DataFrame, keys: Sequence[str], order: str, out: str, label: str, coarse: Column | None = None
) -> DataFrame:
    """Add ``out`` = ``label`` value, underscore, dense rank of ``order`` within ``keys``; a NULL time gives ``_NA``.

    The rank is worked out on the distinct (keys, order) pairs in two levels: the number of pairs in earlier
    ``coarse`` steps plus the position within the step. ``coarse`` must never fall while ``order`` rises; its default
    is the hour. One key that holds a large part of the table is so spread over its hours, and the task that adds up
    the key's steps sees one number per hour.
    """
    step = F.date_trunc("hour", order) if coarse is None else coarse
    pairs = (
        df.where(F.col(order).isNotNull()).select(*keys, order).distinct().withColumn("__step", step)
    )
    steps = pairs.groupBy(*keys, "__step").agg(F.count(F.lit(1)).alias("__size"))
    before = W.partitionBy(*keys).orderBy("__step").rowsBetween(W.unboundedPreceding, -1)
    offsets = steps.select(*keys, "__step", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    position = F.row_number().over(W.partitionBy(*keys, "__step").orderBy(order))
    placed = equi_join(pairs.withColumn("__position", position), offsets, [*keys, "__step"])
    # As a written table of known size, the ranks are broadcast when few and joined by shuffle when many.
    ranks = materialize(placed.select(*keys, order, (F.col("__offset") + F.col("__position")).alias("__rank")))
    ranked = equi_join(df, ranks, [*keys, order], "left")
    return ranked.withColumn(out, paste(F.col(label), F.col("__rank"), sep="_")).drop("__rank")


def zscore(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Add the group z-score (sample deviation). NULL when the group has one value or no spread.

    Mean and deviation are aggregated first, written, and joined back: a group is never gathered in one task, and
    Spark knows from the files whether the statistics are small enough to spare the rows a shuffle.
    """
    stats = materialize(df.groupBy(*keys).agg(F.avg(col).alias("__mean"), F.stddev_samp(col).alias("__sd")))
    scaled = (F.col(col) - F.col("__mean")) / F.nullif(F.col("__sd"), F.lit(0.0))
    return equi_join(df, stats, keys, "left").withColumn(out, scaled).drop("__mean", "__sd")
