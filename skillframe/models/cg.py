"""Ridge regression for any number of members: multi-shift conjugate gradients on DataFrames.

All penalties of a fold share one Krylov space, so one pass over the memberships per round serves every penalty and
every fold. A row per member holds the vectors of all folds; the driver holds a few numbers per fold and penalty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


@dataclass
class RidgePaths:
    """Solutions of all folds (lanes) and penalties, one row per member: ``x0``, ``x1``, ... are arrays by penalty."""

    members: DataFrame
    targets: DataFrame
    solved: DataFrame
    lanes: int
    penalties: int

    def coefficients(self) -> DataFrame:
        found = self.solved.select("member", F.col("x0")[0].alias("estimate"))
        everyone = self.members.select("member").distinct()
        return everyone.join(found, "member", "left").na.fill(0.0, ["estimate"])

    def errors(self) -> np.ndarray:
        """Weighted mean squared error of every penalty, each group predicted by the fit that left its fold out."""
        by_fold = self.members.join(self.targets.select("id", "fold"), "id").join(self.solved, "member")
        lane = F.array(*[F.col(f"x{k}") for k in range(self.lanes)])[F.col("fold")]
        fitted = by_fold.select("id", lane.alias("x")).groupBy("id").agg(
            *[F.sum(F.col("x")[j]).alias(f"f{j}") for j in range(self.penalties)]
        )
        rows = self.targets.join(fitted, "id", "left")
        sums = rows.agg(
            F.sum("w").alias("w"),
            *[
                F.sum(
                    F.col("wyy")
                    - 2 * F.col("w") * F.col("y") * F.coalesce(F.col(f"f{j}"), F.lit(0.0))
                    + F.col("w") * F.coalesce(F.col(f"f{j}"), F.lit(0.0)) ** 2
                ).alias(f"e{j}")
                for j in range(self.penalties)
            ],
        ).first()
        return np.array([sums[f"e{j}"] for j in range(self.penalties)]) / sums["w"]


def ridge_paths(
    members: DataFrame,
    targets: DataFrame,
    lambdas: Sequence[float],
    folds: int,
    lambda_scale: str,
    tol: float = 1e-9,
    max_rounds: int = 500,
) -> RidgePaths:
    """Solve every fold's training problem (or, with ``folds=0``, the whole problem) for every penalty."""
    from .ridge import penalty_scale

    lanes = max(folds, 1)
    members, targets = materialize(members), materialize(targets)

    def share(k: int) -> Column:
        return F.when(F.col("fold") != k, F.col("w")).otherwise(F.lit(0.0)) if folds else F.col("w")

    whole = targets.agg(
        *[F.sum(share(k)).alias(f"w{k}") for k in range(lanes)],
        *[F.sum(share(k) * F.col("y")).alias(f"y{k}") for k in range(lanes)],
        *[F.sum(share(k) / F.col("w") * F.col("wyy")).alias(f"q{k}") for k in range(lanes)],
    ).first()
    weight = [whole[f"w{k}"] for k in range(lanes)]
    scale = [penalty_scale(whole[f"q{k}"] / weight[k], whole[f"y{k}"] / weight[k], lambda_scale) for k in range(lanes)]
    shares = targets.select("id", "y", *[(share(k) / F.lit(weight[k])).alias(f"w{k}") for k in range(lanes)])

    pairs = members.join(shares, "id")
    sums = pairs.groupBy("member").agg(
        *[F.sum(f"w{k}").alias(f"m{k}") for k in range(lanes)],
        *[F.sum(F.col(f"w{k}") * F.col("y")).alias(f"b{k}") for k in range(lanes)],
    )

    def inverse_sd(k: int) -> Column:
        variance = F.col(f"m{k}") - F.col(f"m{k}") ** 2
        return F.when(variance > 1e-12, 1 / F.sqrt(variance)).otherwise(F.lit(0.0))

    penalties = len(lambdas)
    shift = np.array([[lam * scale[k] for lam in lambdas] for k in range(lanes)])
    base = shift.min(axis=1)
    zeros = F.array_repeat(F.lit(0.0), penalties)
    start = []
    for k in range(lanes):
        r = F.col(f"b{k}") * F.col(f"d{k}")
        start += [F.col(f"d{k}"), r.alias(f"r{k}"), r.alias(f"p{k}"), zeros.alias(f"x{k}"),
                  F.array_repeat(r, penalties).alias(f"v{k}")]
    state = materialize(sums.select("*", *[inverse_sd(k).alias(f"d{k}") for k in range(lanes)]).select("member", *start))
    norm = _norms(state, lanes)
    first = norm.copy()

    older, zeta = np.ones((lanes, penalties)), np.ones((lanes, penalties))
    alpha_before, beta = np.ones(lanes), np.zeros(lanes)
    extra = shift - base[:, None]
    for _ in range(max_rounds):
        if np.all(norm <= tol**2 * np.maximum(first, 1e-300)):
            break
        image = materialize(_image(members, shares, state, lanes, base))
        inner = image.agg(*[F.sum(F.col(f"p{k}") * F.col(f"a{k}")).alias(f"s{k}") for k in range(lanes)]).first()
        inner = np.array([inner[f"s{k}"] or 0.0 for k in range(lanes)])
        live = norm > tol**2 * np.maximum(first, 1e-300)
        open_shift = live[:, None] & (zeta**2 * norm[:, None] > tol**2 * first[:, None] * 1e-4)
        alpha = np.where(live, norm / np.where(inner > 0, inner, 1.0), 0.0)
        bottom = alpha_before[:, None] * older * (1 + alpha[:, None] * extra) + (alpha * beta)[:, None] * (older - zeta)
        newer = np.where(open_shift, zeta * older * alpha_before[:, None] / np.where(open_shift, bottom, 1.0), zeta)
        ratio = newer / zeta
        step = np.where(open_shift, alpha[:, None] * ratio, 0.0)
        stepped = image.select(
            "member",
            *[c for k in range(lanes) for c in (
                F.col(f"d{k}"), F.col(f"p{k}"), F.col(f"v{k}"),
                (F.col(f"r{k}") - alpha[k] * F.col(f"a{k}")).alias(f"r{k}"),
                _axpy(step[k], f"v{k}", f"x{k}").alias(f"x{k}"),
            )],
        )
        fresh = _norms(stepped, lanes)
        grown = np.where(live, fresh / np.where(norm > 0, norm, 1.0), 0.0)
        state = materialize(stepped.select(
            "member",
            *[c for k in range(lanes) for c in (
                F.col(f"d{k}"), F.col(f"r{k}"), F.col(f"x{k}"),
                (F.col(f"r{k}") + grown[k] * F.col(f"p{k}")).alias(f"p{k}"),
                _scaled(newer[k], f"r{k}", grown[k] * ratio[k] ** 2, f"v{k}").alias(f"v{k}"),
            )],
        ))
        alpha_before = np.where(live, alpha, alpha_before)
        older, zeta, beta = np.where(open_shift, zeta, older), newer, grown
        norm = np.where(live, fresh, norm)
    else:
        raise RuntimeError(f"no convergence within {max_rounds} rounds")
    solved = state.select(
        "member",
        *[_times(f"x{k}", f"d{k}").alias(f"x{k}") for k in range(lanes)],
    )
    return RidgePaths(members, targets, materialize(solved), lanes, penalties)


def _image(members: DataFrame, shares: DataFrame, state: DataFrame, lanes: int, base: np.ndarray) -> DataFrame:
    """State plus ``a``: the standardised cross-product matrix, with the smallest penalty, times ``p``."""
    carried = state.select("member", *[(F.col(f"p{k}") * F.col(f"d{k}")).alias(f"q{k}") for k in range(lanes)])
    fitted = members.join(carried, "member").groupBy("id").agg(*[F.sum(f"q{k}").alias(f"t{k}") for k in range(lanes)])
    pulled = fitted.join(shares, "id").select(
        "id", *[(F.col(f"t{k}") * F.col(f"w{k}")).alias(f"t{k}") for k in range(lanes)]
    )
    back = members.join(pulled, "id").groupBy("member").agg(*[F.sum(f"t{k}").alias(f"u{k}") for k in range(lanes)])
    return state.join(back, "member").select(
        *state.columns,
        *[(F.col(f"u{k}") * F.col(f"d{k}") + float(base[k]) * F.col(f"p{k}")).alias(f"a{k}") for k in range(lanes)],
    )


def _norms(df: DataFrame, lanes: int) -> np.ndarray:
    row = df.agg(*[F.sum(F.col(f"r{k}") * F.col(f"r{k}")).alias(f"n{k}") for k in range(lanes)]).first()
    return np.array([row[f"n{k}"] or 0.0 for k in range(lanes)])


def _literals(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _axpy(factors: np.ndarray, direction: str, point: str) -> Column:
    step = F.zip_with(_literals(factors), F.col(direction), lambda a, v: a * v)
    return F.zip_with(F.col(point), step, lambda x, s: x + s)


def _times(values: str, factor: str) -> Column:
    return F.transform(values, lambda x: x * F.col(factor))


def _scaled(first: np.ndarray, r: str, second: np.ndarray, v: str) -> Column:
    left = F.transform(_literals(first), lambda z: z * F.col(r))
    right = F.zip_with(_literals(second), F.col(v), lambda b, d: b * d)
    return F.zip_with(left, right, lambda a, b: a + b)
