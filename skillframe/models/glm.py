"""Logistic regression without intercept, its coefficient tables and link-scale scores."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext
from .design import Term, complete_cases, design_columns, gramian, independent, split_term

COEF_SCHEMA = "term string, estimate double, std_error double, statistic double, p_value double"


@dataclass
class LogitFit:
    """A fitted model with its coefficient rows; aliased columns have NULL estimates.

    ``converged`` is false if the fit stopped at its last round, as it does where a term separates the outcomes.
    """

    model: GeneralizedLinearRegressionModel
    rows: list[tuple]
    group: str | None = None
    converged: bool = True

    def coef_df(self, spark: SparkSession) -> DataFrame:
        schema = COEF_SCHEMA + (f", {self.group} string" if self.group else "")
        return spark.createDataFrame(self.rows, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        coefs = self.coef_df(spark).withColumn("converged", F.lit(self.converged))
        coefs.write.mode("overwrite").parquet(f"{path}/coefficients")


def load_fit(spark: SparkSession, path: str) -> LogitFit:
    coefs = spark.read.parquet(f"{path}/coefficients")
    flag = coefs.select("converged").first() if "converged" in coefs.columns else None
    coefs = coefs.drop("converged")
    group = coefs.columns[5] if len(coefs.columns) > 5 else None
    model = GeneralizedLinearRegressionModel.load(f"{path}/model")
    return LogitFit(model, [tuple(r) for r in coefs.collect()], group, bool(flag[0]) if flag else True)


def fit_logit(
    df: DataFrame,
    label: str,
    terms: Sequence[Term],
    group: str | None = None,
    collapse: bool = False,
    max_iter: int = 25,
    tol: float = 1e-8,
) -> LogitFit:
    """Maximum likelihood fit of a 0/1 label on the terms, without intercept.

    Rows with a missing model value are left out. Columns that depend on earlier ones are left out of the fit and
    reported with NULL estimates. With ``group`` every group gets its own coefficients: the groups share no column, so
    one fit of the block-diagonal design gives the same numbers as one fit per group.
    ``collapse`` first turns rows that agree in all model columns into one weighted row: the same likelihood, worth a
    shuffle when the model columns take few values.
    """
    extra = [group] if group else []
    cases = complete_cases(df, label, terms, *extra)
    y = f"double({sqltext.name(label)})"
    patterns = [c for c in cases.columns if c != label]
    if collapse:
        cells = cases.groupBy(*patterns).agg(F.expr(f"avg({y}) AS __y"), F.expr("double(count(1)) AS __n"))
    else:
        cells = cases.select(*patterns, F.expr(f"{y} AS __y"), F.lit(1.0).alias("__n"))
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        columns = design_columns(cells, terms, group)
        gram = gramian(cells, [c.sql() for c in columns] + ["1D"])
        kept = independent(gram[:-1, :-1])
        # Spark's solver gives a constant column no weight; it has to be fitted as the intercept.
        constant = [j for j in kept if _is_constant(gram, j)]
        varying = [j for j in kept if j not in constant]
        names = [f"x{j}" for j in varying]
        design = cells.selectExpr("__y", "__n", *[f"{columns[j].sql()} AS {n}" for j, n in zip(varying, names)])
        if not names:  # nothing varies: an all-zero column leaves the intercept alone
            names, design = ["x"], design.withColumn("x", F.lit(0.0))
        assembled = VectorAssembler(inputCols=names, outputCol="features").transform(design)
        learner = GeneralizedLinearRegression(
            family="binomial", link="logit", fitIntercept=bool(constant), regParam=0.0, maxIter=max_iter, tol=tol,
            labelCol="__y", weightCol="__n", featuresCol="features",
        )
        model = learner.fit(assembled.select("__y", "__n", "features"))
        found = _coefficients(model, cells, gram, varying, constant)
    finally:
        cells.unpersist()
    converged = model.summary.numIterations < max_iter
    if not converged:
        warnings.warn(f"the logistic fit did not converge in {max_iter} rounds", stacklevel=2)
    rows = []
    for j, column in enumerate(columns):
        if j not in found and column.factor is not None and group is not None and gram[j, j] == 0:
            continue  # a text value that does not occur in this group; a dependent one stays, with NULL
        values = found.get(j, (None, None, None, None))
        values = [None if v is None else float(v) for v in values]
        rows.append((column.name, *values, *([column.group_level] if group else [])))
    return LogitFit(model, rows, group, converged)


def _is_constant(gram: np.ndarray, j: int) -> bool:
    rows, total, squares = gram[-1, -1], gram[j, -1], gram[j, j]
    return rows * squares - total**2 <= 1e-12 * rows * squares


def _coefficients(
    model: GeneralizedLinearRegressionModel, cells: DataFrame, gram: np.ndarray, varying: list[int], constant: list[int]
) -> dict[int, tuple[float, float, float, float]]:
    """Estimate, standard error, z and p of every fitted column."""
    if not varying:  # the constant alone: its error has a closed form
        n, p = cells.agg(F.sum("__n"), F.sum(F.col("__n") * F.col("__y")) / F.sum("__n")).first()
        size = gram[constant[0], -1] / gram[-1, -1]
        estimate, error = model.intercept, 1 / math.sqrt(n * p * (1 - p))
        z = estimate / error
        return {constant[0]: (estimate / size, error / abs(size), z * math.copysign(1, size), math.erfc(abs(z) / 2**0.5))}
    summary = model.summary
    rows = list(zip(
        [*model.coefficients.toArray().tolist(), model.intercept],
        summary.coefficientStandardErrors, summary.tValues, summary.pValues,
    ))
    found = dict(zip(varying, rows))
    if constant:  # the intercept stands last
        size = gram[constant[0], -1] / gram[-1, -1]
        estimate, error, z, p = rows[len(varying)]
        found[constant[0]] = (estimate / size, error / abs(size), z * math.copysign(1, size), p)
    return found


def fit_logit_by(
    df: DataFrame, label: str, terms: Sequence[Term], group: str, collapse: bool = False
) -> DataFrame:
    """One coefficient table per group, stacked."""
    return fit_logit(df, label, terms, group, collapse).coef_df(df.sparkSession)


def coef_band(coefs: DataFrame, term: str) -> DataFrame:
    """Estimate of one term with the band of one standard error on each side."""
    return coefs.where(F.col("term") == term).select(
        *[c for c in coefs.columns if c not in ("statistic", "p_value", "std_error")],
        (F.col("estimate") - F.col("std_error")).alias("lower"),
        (F.col("estimate") + F.col("std_error")).alias("upper"),
    )


def link_expr(df: DataFrame, fit: LogitFit, terms: Sequence[Term], overrides: Mapping[str, float] | None = None) -> Column:
    """Log-odds of a row: NULL when a model column is missing or a text value was not in the fit.

    ``overrides`` sets numeric columns to a constant first, for what-if scores.
    """
    overrides = overrides or {}
    estimates = {row[0]: (0.0 if row[1] is None else row[1]) for row in fit.rows}
    parts = []
    for term in terms:
        number, factor = split_term(df, term)
        value = sqltext.literal(float(overrides[number])) if number in overrides else f"double({sqltext.name(number)})"
        if factor is None:
            estimate = sqltext.literal(estimates[term.first])
        else:
            found = sqltext.mapping(_level_estimates(estimates, term, factor))
            estimate = f"try_element_at({found}, {sqltext.name(factor)})"
        parts.append(f"{estimate} * {value}")
    return F.expr(" + ".join(parts))


def _level_estimates(estimates: Mapping[str, float], term: Term, factor: str) -> list[tuple[str, float]]:
    before, after = (":".join(p) for p in _around(term, factor))
    before = before + ":" if before else ""
    after = ":" + after if after else ""
    head = before + factor
    return [
        (name[len(head) : len(name) - len(after)], estimate)
        for name, estimate in estimates.items()
        if name.startswith(head) and name.endswith(after)
    ]


def _around(term: Term, factor: str) -> tuple[list[str], list[str]]:
    names = list(term.variables)
    at = names.index(factor)
    return names[:at], names[at + 1 :]


def score_link(
    df: DataFrame, fit: LogitFit, terms: Sequence[Term], out: str, overrides: Mapping[str, float] | None = None
) -> DataFrame:
    """Add the log-odds of every row, optionally with some columns set to a constant."""
    return df.withColumn(out, link_expr(df, fit, terms, overrides))


def score_map_advantage(
    df: DataFrame, fit: LogitFit, terms: Sequence[Term], stats: Sequence[str], neutral: Column, out: str
) -> DataFrame:
    """Log-odds with all ``stats`` at zero, which leaves the map's share; 0 where ``neutral`` holds."""
    share = link_expr(df, fit, terms, {s: 0.0 for s in stats})
    return df.withColumn(out, F.when(neutral, F.lit(0.0)).otherwise(share))
