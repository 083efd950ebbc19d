"""Logistic model with two crossed random intercepts, fitted by penalised quasi-likelihood on DataFrames.

The model is ``win ~ number:factor + (1|group) + (1|other group) + 0``. The state is one coefficient per factor level
(driver) and one effect per group level (DataFrames). Every step is a grouped aggregation of the collapsed outcome
table, so nothing that grows with the data leaves the executors.

For given variances and fixed coefficients the effects are the conditional modes a Laplace fit reports. The variances
come from Schall's fixed point, which underestimates them for 0/1 data when groups are small; compare signs and ranks
with a Laplace fit, not digits.

The first ``PLAIN_ROUNDS`` move coefficients, effects and variances one after another. The more rows a group has, the less a
coefficient and the mean of all effects can move one at a time, so fits that go on move them together (``_joint_step``) and
take Newton steps for the variances (``_nearer``). Both ways have the same fixed point.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import sqltext
from ..session import materialize
from .design import Term, levels, split_term

VARIANCE_FLOOR = 1e-8
WEIGHT_FLOOR = 1e-6
JUMP = math.log(100.0)
#: Rounds of one step after another; fits that need more take joint steps from there.
PLAIN_ROUNDS = 30
#: Least slope of a variance's equation that a Newton step divides by.
LEAST_SLOPE = 0.01
#: Effect tables up to this many rows (some MB) are broadcast.
MAX_BROADCAST_GROUPS = 200_000


@dataclass
class CrossedFit:
    """Fixed coefficients by factor level, effects (grpvar, grp, condval, condsd), variances and rounds used."""

    beta: dict[str, float]
    effects: DataFrame
    variances: dict[str, float]
    rounds: int


def collapse(df: DataFrame, y: str, fixed: Term, groups: Sequence[str]) -> DataFrame:
    """Identical rows as one row with a count and a number of wins; rows with a missing model value are left out."""
    number, factor = split_term(df, fixed)
    keys = [*groups, *([factor] if factor else []), number]
    rows = df.select(y, *keys).dropna()
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("__n"), F.sum(F.col(y).cast("double")).alias("__wins")
    )


def fit_crossed_logit(
    df: DataFrame,
    y: str,
    fixed: Term,
    groups: tuple[str, str],
    variances: Mapping[str, float] | None = None,
    tol: float = 1e-4,
    max_rounds: int = 200,
) -> CrossedFit:
    """Fit until a round moves no effect, deviation or coefficient by ``tol`` or more of the effects' deviation.

    The rule is relative, so that small effects do not count as standing still; coefficients are held against the larger
    deviation or their own size. Below the deviation of ``VARIANCE_FLOOR`` there is no effect to resolve. ``variances`` fixes the effect variances instead of estimating them. Raises when ``max_rounds`` do not suffice.
    """
    number, factor = split_term(df, fixed)
    level = F.col(factor) if factor else F.lit("")
    cells = materialize(
        collapse(df, y, fixed, groups).select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
            level.alias("__level"), F.col(number).cast("double").alias("__x"), "__n", "__wins",
        )
    )
    beta = {name: 0.0 for name in levels(cells, "__level")}
    sigma = [float(variances[g]) if variances else 1.0 for g in groups]
    trail = [[math.log(s)] for s in sigma]
    effects, sizes = [], []
    for i in range(2):
        start = cells.select(F.col(f"__g{i}").alias("grp")).distinct()
        effects.append(materialize(start.select("grp", F.lit(0.0).alias("eff"), F.lit(0.0).alias("var"))))
        sizes.append(effects[i].count())
    totals = [0.0, 0.0]

    for round_no in range(1, max_rounds + 1):
        moved, joint = 0.0, round_no > PLAIN_ROUNDS
        slopes = _scored(cells, beta, effects, sizes).groupBy("__level").agg(
            F.expr("sum(__x * __score) AS s"), F.expr("sum(__x * __x * __weight) AS h"), F.expr("sum(__x * __weight) AS c"),
            F.expr("sum(__score) AS score"), F.expr("sum(__weight) AS weight"),
        ).collect()  # one row per factor level
        shifts = _joint_step(slopes, totals, sizes, sigma) if joint else [0.0, 0.0]
        for row in slopes:
            step = (row["s"] - row["c"] * sum(shifts)) / row["h"] if row["h"] else 0.0
            beta[row["__level"]] += step
            moved = max(moved, abs(step) / max(*map(_deviation, sigma), abs(beta[row["__level"]])))
        if joint:
            effects = [e.withColumn("eff", F.col("eff") + F.lit(shift)) for e, shift in zip(effects, shifts)]
            moved = max(moved, *(abs(shift) / _deviation(s) for shift, s in zip(shifts, sigma)))

        for i in range(2):
            old, scale = f"first(__eff{i})", f"(sum(__weight) + {sqltext.literal(1.0 / sigma[i])})"
            new = f"(sum(__score) + sum(__weight) * {old}) / {scale}"
            updated = _scored(cells, beta, effects, sizes).groupBy(f"__g{i}").agg(
                F.expr(f"{new} AS eff"), F.expr(f"1 / {scale} AS var"), F.expr(f"abs({new} - {old}) AS step")
            )
            effects[i] = materialize(updated.withColumnRenamed(f"__g{i}", "grp"))
        summary = []
        for i, e in enumerate(effects):
            told = f"(1 - var / {sqltext.literal(sigma[i])})"  # the share of an effect that the data decide
            summary.append(e.selectExpr(f"{i} AS i", "max(step)", "sum(eff * eff)", "sum(var)", "sum(eff)", f"sum({told} * {told})", f"sum(eff * eff * {told})"))
        for i, step, squares, spread, total, told_squares, told_effects in summary[0].union(summary[1]).collect():
            totals[i] = total
            moved = max(moved, step / _deviation(sigma[i]))
            if variances is None:
                free = max(sizes[i] - spread / sigma[i], 1e-12)
                estimate = max(squares / free, VARIANCE_FLOOR)
                moved = max(moved, abs(_deviation(estimate) / _deviation(sigma[i]) - 1))
                if joint:
                    sigma[i] = _nearer(sigma[i], estimate, 2 * told_effects / max(squares, 1e-300) - told_squares / free)
                    continue
                trail[i].append(math.log(estimate))
                sigma[i] = math.exp(_ahead(trail[i]))
        if moved < tol:
            parts = [
                effects[i].select(
                    F.lit(g).alias("grpvar"), "grp", F.col("eff").alias("condval"), F.sqrt("var").alias("condsd")
                )
                for i, g in enumerate(groups)
            ]
            return CrossedFit(dict(beta), parts[0].unionByName(parts[1]), dict(zip(groups, sigma)), round_no)
    raise RuntimeError(f"no convergence within {max_rounds} rounds; the last round moved by {moved:.3g}")


def _deviation(variance: float) -> float:
    return max(variance, VARIANCE_FLOOR) ** 0.5


def _ahead(trail: list[float]) -> float:
    """The last log-variance, or after two plain steps the point they head for.

    Plain steps shrink geometrically, towards a point inside or, when the data hold no group effect, without end; the
    jump is limited to a factor of 100 either way and the fixed point stays the same.
    """
    if len(trail) < 3:
        return trail[-1]
    before, last = trail[-2] - trail[-3], trail[-1] - trail[-2]
    del trail[:-1]
    if before == 0 or last / before <= 0:
        return trail[-1]
    ratio = min(last / before, 0.99)
    jump = max(-JUMP, min(JUMP, last * ratio / (1 - ratio)))
    trail[0] = max(trail[0] + jump, math.log(VARIANCE_FLOOR))
    return trail[0]


def _joint_step(slopes: Sequence[Row], totals: Sequence[float], sizes: Sequence[int], sigma: Sequence[float]) -> list[float]:
    """What the effects of both factors shift by, each as a whole, in a Newton step together with all coefficients.

    Coefficients are eliminated first, since they do not meet in a row; two equations are left.
    """
    used = [r for r in slopes if r["h"]]
    shared = max(sum(r["weight"] for r in slopes) - sum(r["c"] ** 2 / r["h"] for r in used), 0.0)
    rest = sum(r["score"] for r in slopes) - sum(r["c"] * r["s"] / r["h"] for r in used)
    own = [n / s for n, s in zip(sizes, sigma)]
    side = [rest - t / s for t, s in zip(totals, sigma)]
    scale = own[0] * own[1] + shared * (own[0] + own[1])
    return [(side[i] * own[1 - i] + shared * (side[i] - side[1 - i])) / scale for i in range(2)]


def _nearer(variance: float, estimate: float, slope: float) -> float:
    """A Newton step in the logarithm towards the variance that is its own estimate, by a factor of 100 at most.

    ``slope``: how fast log(variance / estimate) grows with log(variance), as far as a factor's own sums tell. Where the
    estimate grows as fast as the variance there is no group effect that way, and the step is a long one.
    """
    jump = math.log(estimate / variance) / min(max(slope, LEAST_SLOPE), 1.0)
    return max(variance * math.exp(max(-JUMP, min(JUMP, jump))), VARIANCE_FLOOR)


def _scored(
    cells: DataFrame, beta: Mapping[str, float], effects: Sequence[DataFrame], sizes: Sequence[int]
) -> DataFrame:
    """Cells with the score and weight of the current fit, and the current effects of their groups.

    Effect tables are broadcast while their counted size allows it; beyond that Spark joins them by shuffle and
    splits hot groups at run time.
    """
    out = cells
    for i in range(2):
        side = effects[i].selectExpr(f"grp AS __g{i}", f"eff AS __eff{i}")
        out = out.join(F.broadcast(side) if sizes[i] <= MAX_BROADCAST_GROUPS else side, f"__g{i}")
    linear = f"try_element_at({sqltext.mapping(beta.items())}, __level) * __x + __eff0 + __eff1"
    kept = ["__g0", "__g1", "__level", "__x", "__eff0", "__eff1"]
    return out.selectExpr(*kept, "__n", "__wins", f"1 / (1 + exp(-({linear}))) AS __p").selectExpr(
        *kept, "__wins - __n * __p AS __score", f"__n * greatest(__p * (1 - __p), {WEIGHT_FLOOR!r}D) AS __weight"
    )
