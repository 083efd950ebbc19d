"""Weighted ridge regression of a group's value on its members, without intercept, with cross-validation.

Minimises ``1/2 sum w~ (y - x b)^2 + 1/2 lam sum s_j^2 b_j^2`` where ``w~`` are the weights scaled to sum 1, ``x`` is the
0/1 membership and ``s_j`` the weighted population deviation of column j. A column without spread gets coefficient 0.
``lambda_scale='response_sd'`` divides the penalty by the weighted deviation of y, as solvers do that scale the
response first.

Up to ``MAX_DENSE`` members the sums of cross products are built inside the tasks, added by Spark and solved once for
all penalties. Beyond that a conjugate-gradient solver keeps all vectors in DataFrames (``cg.py``). Neither way emits
the pairs of members of a group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cg import ridge_paths

#: Members up to which the cross products of all folds are solved on the driver.
MAX_DENSE = 400
#: Groups that partial sums are first added in.
TREE = 32
#: Penalties tried by default: ten to the power 3, 2.9, ... -2.
LAMBDAS = [10 ** (3 - k / 10) for k in range(51)]


@dataclass
class FoldSums:
    """Cross products per fold of the columns (members..., y, 1), weighted."""

    roles: list[str]
    sums: np.ndarray  # folds x (P + 2) x (P + 2)


def fold_of(key: str, folds: int, seed: int) -> Column:
    """The fold of a group: a stable hash, the same in every run."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int")


def ridge_cv(
    members: DataFrame,
    targets: DataFrame,
    lambdas: Sequence[float] | None = None,
    folds: int = 10,
    seed: int = 0,
    lambda_scale: str = "none",
    max_dense: int = MAX_DENSE,
    fold: Column | None = None,
) -> DataFrame:
    """Held-out weighted mean squared error per penalty: columns ``lambda``, ``cv_error``, ``is_min``.

    ``members`` holds distinct (group, member) pairs in its first two columns; ``targets`` holds (group, y, w).
    Groups fall into folds by a stable hash, or by ``fold``, an expression of the group's ``id`` from 0 to folds - 1.
    Of several penalties with the least error the largest counts as the minimum.
    """
    lambdas = sorted(LAMBDAS if lambdas is None else lambdas, reverse=True)
    members, targets = _standard(members, targets)
    targets = targets.withColumn("fold", fold_of("id", folds, seed) if fold is None else fold.cast("int"))
    roles = _roles(members, max_dense)
    if roles is None:
        errors = ridge_paths(members, targets, lambdas, folds, lambda_scale).errors()
    else:
        part = _fold_sums(members, targets, roles, folds)
        total = part.sums.sum(axis=0)
        errors = np.zeros(len(lambdas))
        p = len(roles)
        for k in range(folds):
            held = part.sums[k]
            if held[p + 1, p + 1] <= 0:
                continue
            for j, b in enumerate(_solve(total - held, lambdas, lambda_scale)):
                errors[j] += held[p, p] - 2 * b @ held[:p, p] + b @ held[:p, :p] @ b
        errors = errors / total[p + 1, p + 1]
    best = int(np.argmin(errors))
    rows = [(float(lam), float(e), j == best) for j, (lam, e) in enumerate(zip(lambdas, errors))]
    return members.sparkSession.createDataFrame(rows, "lambda double, cv_error double, is_min boolean")


def ridge_fit(
    members: DataFrame,
    targets: DataFrame,
    lam: float,
    lambda_scale: str = "none",
    max_dense: int = MAX_DENSE,
) -> DataFrame:
    """Coefficients at one penalty: columns ``member``, ``estimate``, one row per member."""
    members, targets = _standard(members, targets)
    roles = _roles(members, max_dense)
    if roles is None:
        return ridge_paths(members, targets.withColumn("fold", F.lit(-1)), [lam], 0, lambda_scale).coefficients()
    part = _fold_sums(members, targets.withColumn("fold", F.lit(0)), roles, 1)
    estimates = _solve(part.sums[0], [lam], lambda_scale)[0]
    rows = [(r, float(b)) for r, b in zip(roles, estimates)]
    return members.sparkSession.createDataFrame(rows, "member string, estimate double")


def best_lambda(cv: DataFrame) -> float:
    return cv.where("is_min").first()["lambda"]


def _standard(members: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Name the columns; groups listed more than once (a lineup under two teams) become one weighted row."""
    i, m = members.columns[:2]
    g, y, w = targets.columns[:3]
    members = members.select(F.col(i).alias("id"), F.col(m).cast("string").alias("member")).distinct()
    weight = F.sum(F.col(w).cast("double"))
    # For equal x the sum of squares only needs the weighted mean of y and the rest, which is constant in b.
    targets = targets.groupBy(F.col(g).alias("id")).agg(
        (F.sum(F.col(w) * F.col(y)) / weight).alias("y"),
        weight.alias("w"),
        F.sum(F.col(w) * F.col(y) * F.col(y)).alias("wyy"),
    )
    return members, targets


def _roles(members: DataFrame, max_dense: int) -> list[str] | None:
    found = members.select("member").distinct().limit(max_dense + 1).collect()
    return None if len(found) > max_dense else sorted(r[0] for r in found)


def _fold_sums(members: DataFrame, targets: DataFrame, roles: list[str], folds: int) -> FoldSums:
    spark = members.sparkSession
    p = len(roles)
    index = F.broadcast(spark.createDataFrame([(r, k) for k, r in enumerate(roles)], "member string, k int"))
    # A group holds each member once, so its array is no longer than the number of members (at most max_dense).
    packed = members.join(index, "member").groupBy("id").agg(F.collect_set("k").alias("ks"))
    rows = targets.join(packed, "id", "left").select("fold", "y", "w", "wyy", "ks")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((folds, p + 2, p + 2))
        for batch in batches:
            x = np.zeros((len(batch), p + 2))
            listed = batch["ks"][batch["ks"].notna()]
            if len(listed):
                at = np.repeat(batch["ks"].notna().to_numpy().nonzero()[0], listed.map(len))
                x[at, np.concatenate(listed.to_numpy()).astype(int)] = 1.0
            x[:, p] = batch["y"]
            x[:, p + 1] = 1.0
            w = batch["w"].to_numpy()
            spread = batch["wyy"].to_numpy() - w * batch["y"].to_numpy() ** 2
            for k in np.unique(batch["fold"]):
                here = batch["fold"].to_numpy() == k
                total[k] += x[here].T @ (x[here] * w[here, None])
                total[k, p, p] += spread[here].sum()
        used = np.flatnonzero(total.any(axis=(1, 2)))
        part = TaskContext.get().partitionId() % TREE if TaskContext.get() else 0
        yield pd.DataFrame({"f": used.astype("int32"), "part": np.full(len(used), part, "int32"), "v": [total[k].tobytes() for k in used]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in rows["v"]], axis=0)
        return pd.DataFrame({"f": rows["f"].iloc[:1], "part": rows["part"].iloc[:1], "v": [total.tobytes()]})

    # One matrix per task and fold, added in two levels.
    schema = "f int, part int, v binary"
    sums = rows.mapInPandas(partial, schema).groupBy("f", "part").applyInPandas(add, schema).groupBy("f").applyInPandas(add, schema)
    out = np.zeros((folds, p + 2, p + 2))
    for row in sums.collect():  # one matrix per fold
        out[row["f"]] = np.frombuffer(row["v"]).reshape(p + 2, p + 2)
    return FoldSums(roles, out)


def _solve(sums: np.ndarray, lambdas: Sequence[float], lambda_scale: str) -> list[np.ndarray]:
    """Coefficients for every penalty from one eigendecomposition of the standardised cross products."""
    p = sums.shape[0] - 2
    norm = sums / sums[p + 1, p + 1]
    mean = norm[:p, p + 1]
    variance = np.diag(norm)[:p] - mean**2
    used = np.flatnonzero(variance > 1e-12)
    s = np.sqrt(variance[used])
    cross = norm[np.ix_(used, used)] / np.outer(s, s)
    target = norm[used, p] / s
    scale = penalty_scale(norm[p, p], norm[p, p + 1], lambda_scale)
    values, vectors = np.linalg.eigh(cross)
    rotated = vectors.T @ target
    out = []
    for lam in lambdas:
        b = np.zeros(p)
        b[used] = vectors @ (rotated / (np.maximum(values, 0.0) + lam * scale)) / s
        out.append(b)
    return out


def penalty_scale(mean_yy: float, mean_y: float, lambda_scale: str) -> float:
    if lambda_scale == "none":
        return 1.0
    if lambda_scale != "response_sd":
        raise ValueError(f"unknown lambda_scale: {lambda_scale}")
    spread = mean_yy - mean_y**2
    return 1.0 / np.sqrt(spread) if spread > 0 else 1.0
