"""Joins with explicit rules for missing keys, colliding names and time intervals.

None of them forces a broadcast on a side whose size was not counted; everything else is left to the optimizer, which
splits hot keys at run time (see ``session.configure``).
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import range_join

#: Right sides up to this many rows may be compared with every left row.
MAX_COMPARED_ROWS = 256
#: Interval tables up to this many rows are compared directly with every event; longer ones go by day. Both give the same rows.
MAX_DIRECT_INTERVALS = 8
#: Day tables up to this many rows (a few MB) are broadcast.
MAX_BROADCAST_DAYS = 50_000

_COMPARE = {">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt, "==": operator.eq}


def _key_pairs(on: Mapping[str, str] | Sequence[str]) -> list[tuple[str, str]]:
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    how: str = "inner",
    nullsafe: bool = True,
    suffix: str = "_right",
    dealt: str | None = None,
) -> DataFrame:
    """Join on equal keys; the right keys vanish and other colliding right columns get ``suffix``.

    ``on`` maps left names to right names. With ``nullsafe`` a missing key matches a missing key; without it the SQL
    rule holds and a missing key matches nothing. Only inner and left joins exist. ``dealt`` is a column of both sides that is
    never missing and equal where the keys are: rows meet by it alone, so what is grouped by it later stays where it is.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    pairs = _key_pairs(on)
    key_alias = {r: f"__key_{i}" for i, (_, r) in enumerate(pairs)}
    kept = [c for c in right.columns if c not in key_alias and c != dealt]
    out_name = {c: c + suffix if c in left.columns else c for c in kept}
    right = right.select(
        *[F.col(r).alias(a) for r, a in key_alias.items()],
        *[F.col(c).alias(f"__val_{c}") for c in kept],
        *([F.col(dealt).alias("__dealt")] if dealt else []),
    )
    def matches(l: str, r: str) -> Column:
        a, b = left[l], right[key_alias[r]]
        if dealt:  # written so that Spark checks it and does not deal rows by it
            return F.coalesce(a == b, a.isNull() & b.isNull() if nullsafe else F.lit(False))
        return a.eqNullSafe(b) if nullsafe else a == b

    met = [left[dealt] == right["__dealt"]] if dealt else []
    joined = left.join(right, reduce(operator.and_, met + [matches(l, r) for l, r in pairs]), how)
    return joined.select(
        *[left[c] for c in left.columns],
        *[right[f"__val_{c}"].alias(out_name[c]) for c in kept],
    )


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on all columns the two sides share."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("the two sides share no column")
    return equi_join(left, right, common, how)


def theta_join(
    left: DataFrame, right: DataFrame, conditions: Sequence[tuple[str, str, str]], how: str = "left"
) -> DataFrame:
    """Join on a list of ``(left column, operator, right column)`` comparisons.

    A short right side (it is counted) is compared with every row; a long one without an equality goes by ``range_join``,
    which gives the same rows.
    """
    size = right.limit(MAX_COMPARED_ROWS + 1).count()
    has_equality = any(op == "==" for _, op, _ in conditions)
    if size > MAX_COMPARED_ROWS and not has_equality:
        return range_join(left, right, conditions, how)
    if size <= MAX_COMPARED_ROWS:
        right = F.broadcast(right)
    condition = reduce(operator.and_, [_COMPARE[op](left[l], right[r]) for l, op, r in conditions])
    return left.join(right, condition, how)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    start: str,
    end: str,
    bounds: str = "midnight",
    strategy: str = "auto",
) -> DataFrame:
    """Left join of events with the date intervals that hold them; an event in several intervals is repeated.

    ``bounds='midnight'`` takes both dates as midnight instants, so most of the end date lies outside;
    ``bounds='whole_day'`` includes the end date to its last moment. Bounds count as the dates they fall on; an interval that
    ends before it starts holds nothing. Short interval tables are compared directly; long ones are spread over their days
    and joined on the day, with the exact bounds as a residual. Both ways give the same rows.
    """
    if bounds not in ("midnight", "whole_day"):
        raise ValueError(f"unknown bounds: {bounds}")
    if strategy not in ("auto", "direct", "by_day"):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "auto":
        short = right.limit(MAX_DIRECT_INTERVALS + 1).count() <= MAX_DIRECT_INTERVALS
        strategy = "direct" if short else "by_day"

    # Turn the dates into instants once per interval, not once per comparison.
    first, final = F.to_date(start), F.to_date(end)
    last = F.date_add(final, 1) if bounds == "whole_day" else final
    bounded = right.where(first <= final).withColumns(
        {"__from": first.cast("timestamp_ntz"), "__to": last.cast("timestamp_ntz")}
    )

    def inside(intervals: DataFrame) -> Column:
        before_end = left[ts] < intervals["__to"] if bounds == "whole_day" else left[ts] <= intervals["__to"]
        return (left[ts] >= intervals["__from"]) & before_end

    if strategy == "direct":
        if bounded.limit(MAX_COMPARED_ROWS + 1).count() <= MAX_COMPARED_ROWS:
            bounded = F.broadcast(bounded)
        return left.join(bounded, inside(bounded), "left").drop("__from", "__to")

    days = bounded.withColumn("__day", F.explode(F.sequence(first, final, F.expr("interval 1 day"))))
    n_days = bounded.agg(F.sum(F.date_diff(final, first) + 1)).first()[0] or 0
    if n_days <= MAX_BROADCAST_DAYS:
        days = F.broadcast(days)
    condition = (F.to_date(left[ts]) == days["__day"]) & inside(days)
    return left.join(days, condition, "left").drop("__day", "__from", "__to")
