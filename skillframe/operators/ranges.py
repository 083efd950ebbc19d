"""Range joins of two long sides: comparisons of one left column with bounds on the right, without looking at every pair."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Left rows a bucket should have, and the most buckets there are; a heavier bucket is split, whatever its values.
BUCKET_ROWS, MAX_BUCKETS = 100_000, 10_000
_COMPARE = {">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt, "==": operator.eq}


def _number(df: DataFrame, column: str) -> Column:
    """The column as a number in the same order; values that become equal only share a bucket."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if kind == "string":
        raise ValueError(f"a range needs a number or a time: {column}")
    return F.col(column).cast("double")


def range_join(left: DataFrame, right: DataFrame, conditions: Sequence[tuple[str, str, str]], how: str = "left") -> DataFrame:
    """Join on ``(left column, operator, right column)`` comparisons of one left column, of any number of rows on both sides.

    The left column's quantiles cut it into buckets. A left row lies in one; a right row goes to all buckets between its
    bounds, which is one copy for about ``BUCKET_ROWS`` rows that it matches. Buckets that hold more rows (a hot value, missing
    values) are split by a hash of the row's place, and the right rows there are copied to each part. The comparisons themselves
    are checked at the end, so buckets decide work, never results. A missing value or bound matches nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    columns = {l for l, op, _ in conditions if op != "=="}
    if len(columns) != 1:
        raise ValueError(f"a range join compares one left column, not {sorted(columns)}")
    (column,) = columns
    rows = materialize(left.withColumns({"__x": _number(left, column), "__at": F.monotonically_increasing_id()}))
    n = rows.count()
    wanted = min(MAX_BUCKETS, 1 + n // BUCKET_ROWS)
    cuts = rows.approxQuantile("__x", [k / wanted for k in range(1, wanted)], 0.1 / wanted) if wanted > 1 else []
    splits = [float("-inf"), *sorted(set(cuts) - {float("-inf"), float("inf")}), float("inf")]
    if len(splits) < 3:
        splits.insert(1, 0.0)

    def bucket(df: DataFrame, value: str, name: str) -> DataFrame:
        return Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df).withColumn(name, F.col(name).cast("int"))

    placed = bucket(rows, "__x", "__bucket")
    # At most MAX_BUCKETS rows: how many parts the heavy ones need.
    heavy = placed.groupBy("__bucket").count().where(F.col("count") > 2 * BUCKET_ROWS).select(
        "__bucket", F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("__parts"))
    heavy = materialize(heavy)
    parts = F.coalesce("__parts", F.lit(1))
    placed = placed.join(F.broadcast(heavy), "__bucket", "left").withColumn("__part", F.pmod(F.xxhash64("__at"), parts).cast("int")).drop("__parts", "__x", "__at")

    used = [r for l, op, r in conditions]
    bounds = right.where(reduce(operator.and_, [F.col(r).isNotNull() for r in used]))
    low = [_number(right, r) for l, op, r in conditions if op in (">", ">=")]
    high = [_number(right, r) for l, op, r in conditions if op in ("<", "<=")]
    edge = lambda some, pick, none: pick(*some) if len(some) > 1 else some[0] if some else F.lit(none)
    bounds = bounds.withColumns({"__low": edge(low, F.greatest, float("-inf")), "__high": edge(high, F.least, float("inf"))})
    bounds = bucket(bucket(bounds.where(F.col("__low") <= F.col("__high")), "__low", "__first"), "__high", "__last")
    spread = bounds.withColumn("__b", F.explode(F.sequence("__first", "__last"))).drop("__first", "__last", "__low", "__high")
    spread = spread.join(F.broadcast(heavy.withColumnRenamed("__bucket", "__b")), "__b", "left").withColumn(
        "__p", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    renamed = spread.select("__b", "__p", *[F.col(c).alias(f"__r_{c}") for c in right.columns])
    tests = [_COMPARE[op](placed[l], renamed[f"__r_{r}"]) for l, op, r in conditions]
    met = placed.join(renamed, reduce(operator.and_, tests, (placed["__bucket"] == renamed["__b"]) & (placed["__part"] == renamed["__p"])), how)
    return met.select(*[placed[c] for c in left.columns], *[renamed[f"__r_{c}"].alias(c) for c in right.columns])
