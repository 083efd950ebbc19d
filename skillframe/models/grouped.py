"""One logistic regression per group, for any number of groups, by reweighted least squares in batches.

A round is one pass over the rows of the groups that have not converged: their log-odds come from the group's coefficients,
their weighted cross products are added per combination of text values, then per pair of coefficients. Every group's normal
equations become one row, and tasks solve them row by row. A group's rows are never brought together, so a hot group costs
what its rows cost; what a task holds of a group is its matrix, the square of the group's own coefficients. Neither
the number of groups nor terms times groups is bounded, and nothing but the count of open groups reaches the driver.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext
from ..session import materialize
from .design import Term, complete_cases, independent_each, split_term

_STATE = ("__off array<int>, __beta array<double>, __se array<double>, __p array<double>, __kept array<int>, "
          "__dev double, __done boolean")


def fit_logit_groups(
    df: DataFrame,
    label: str,
    terms: Sequence[Term],
    group: str,
    collapse: bool = False,
    max_iter: int = 25,
    tol: float = 1e-8,
) -> DataFrame:
    """Maximum likelihood fits of a 0/1 label on the terms, without intercept, one per value of ``group``.

    Returns group, term, estimate, std_error, statistic, p_value, converged. A group has a coefficient for every text value
    that occurs in it. Columns that depend on earlier ones of their group have NULL estimates. Rows with a missing value in
    a model column, the group included, are left out. A group stops when its deviance changes by less than ``tol`` of
    itself; where a term separates the outcomes that happens at large estimates with larger errors. Groups still open after
    ``max_iter`` rounds have ``converged`` false, and a warning is given. ``collapse`` adds up rows that agree in all model
    columns first.
    """
    cells, state, names = _design(df, label, terms, group, collapse)
    lists = [c for c in state.columns if c != "__g"]
    finished: list[DataFrame] = []
    for k in range(max_iter + 1):
        sums = _normal_equations(cells, state if k else None, terms)
        state = materialize(_solved(sums.join(state, "__g"), lists, k, max_iter, tol))
        finished.append(state.where("__done"))
        state = state.where("NOT __done")
        left = state.count()
        if not left:
            break
    else:
        warnings.warn(f"{left} logistic fits did not converge in {max_iter} rounds", stacklevel=2)
        finished.append(state)
    fits = finished[0]
    for part in finished[1:]:
        fits = fits.unionByName(part)
    each = fits.selectExpr("__g", "__done", "__kept", f"posexplode(transform({names}, (t, i) -> struct(t, __beta[i] AS b, __se[i] AS s, __p[i] AS p))) AS (k, c)")
    known = "CASE WHEN array_contains(__kept, k) THEN"
    return each.selectExpr(
        f"__g AS {sqltext.name(group)}", "c.t AS term", f"{known} c.b END AS estimate", f"{known} c.s END AS std_error",
        f"{known} c.b / c.s END AS statistic", f"{known} c.p END AS p_value", "__done AS converged",
    )


def _design(df: DataFrame, label: str, terms: Sequence[Term], group: str, collapse: bool) -> tuple[DataFrame, DataFrame, str]:
    """Rows (group, share of ones, weight, values v0.., places of text values p0..), a row per group with its text values,
    and the SQL of a group's coefficient names."""
    cases = complete_cases(df, label, terms, group)
    split = [split_term(cases, t) for t in terms]
    factors = list(dict.fromkeys(f for _, f in split if f))
    keys = [f"{sqltext.name(group)} AS __g", *[f"double({sqltext.name(n)}) AS v{t}" for t, (n, _) in enumerate(split)],
            *[f"{sqltext.name(f)} AS f{j}" for j, f in enumerate(factors)]]
    cells = cases.selectExpr(*keys, f"double({sqltext.name(label)}) AS __y")
    if collapse:
        cells = cells.groupBy([c for c in cells.columns if c != "__y"]).agg(F.expr("avg(__y) AS __y"), F.expr("double(count(1)) AS __n"))
    else:
        cells = cells.withColumn("__n", F.lit(1.0))
    state = materialize(cells.groupBy("__g").agg(F.count(F.lit(1)).alias("__rows"), *[
        F.expr(f"array_sort(collect_set(f{j})) AS l{j}") for j in range(len(factors))]).drop("__rows"))
    for j in range(len(factors)):
        places = state.selectExpr("__g", f"posexplode(l{j}) AS (p{j}, f{j})")
        cells = cells.join(places, ["__g", f"f{j}"]).drop(f"f{j}")
    sizes, names = [], []
    for t, (_, f) in enumerate(split):
        if f is None:
            sizes.append("1")
            names.append(f"array({sqltext.literal(terms[t].first)})")
        else:
            j = factors.index(f)
            sizes.append(f"size(l{j})")
            shown = " || ':' || ".join(f"{sqltext.literal(v)} || x" if v == f else sqltext.literal(v) for v in terms[t].variables)
            names.append(f"transform(l{j}, x -> {shown})")
    starts = [" + ".join(sizes[:t]) or "0" for t in range(len(terms) + 1)]
    state = state.withColumn("__off", F.expr(f"array({', '.join(f'int({s})' for s in starts)})"))
    # A term's place in the rows: that of its text value, 0 without one.
    for t, (_, f) in enumerate(split):
        cells = cells.withColumn(f"q{t}", F.col(f"p{factors.index(f)}") if f else F.lit(0))
    return materialize(cells), state, f"concat({', '.join(names)})"


def _normal_equations(cells: DataFrame, state: DataFrame | None, terms: Sequence[Term]) -> DataFrame:
    """Per group the arrays ta, pa, tb, pb, s: the sum for the pair of coefficients (ta, pa) and (tb, pb). tb = -1 is the right
    side, ta = -1 the deviance. Without a state the log-odds are those of the shares, drawn half a case to the middle."""
    size = range(len(terms))
    if state is None:
        rows = cells.withColumn("__eta", F.expr("ln((__n * __y + 0.5D) / (__n * (1D - __y) + 0.5D))"))
    else:
        eta = " + ".join(f"v{t} * __beta[__off[{t}] + q{t}]" for t in size)
        rows = cells.join(state.select("__g", "__off", "__beta"), "__g").withColumn("__eta", F.expr(f"greatest(-30D, least(30D, {eta}))"))
    rows = rows.withColumn("__mu", F.expr("1D / (1D + exp(-__eta))")).withColumn("__w", F.expr("__n * __mu * (1D - __mu)"))
    rows = rows.withColumn("__z", F.expr("__w * __eta + __n * (__y - __mu)"))
    pairs = [(a, b) for a in size for b in size if a <= b]
    sums = [f"sum(__w * v{a} * v{b}) AS s{a}_{b}" for a, b in pairs] + [f"sum(__z * v{a}) AS r{a}" for a in size]
    sums.append("sum(2D * __n * (ln(1D + exp(__eta)) - __y * __eta)) AS dev")
    # First by combination of text values, one row in and no more out; then by pair of coefficients.
    patterns = rows.groupBy("__g", *[f"q{t}" for t in size]).agg(*[F.expr(s) for s in sums])
    parts = [f"struct({a} AS ta, q{a} AS pa, {b} AS tb, q{b} AS pb, s{a}_{b} AS s)" for a, b in pairs]
    parts += [f"struct({a} AS ta, q{a} AS pa, -1 AS tb, 0 AS pb, r{a} AS s)" for a in size]
    parts.append("struct(-1 AS ta, 0 AS pa, -1 AS tb, 0 AS pb, dev AS s)")
    entries = patterns.selectExpr("__g", f"inline(array({', '.join(parts)}))")
    entries = entries.groupBy("__g", "ta", "pa", "tb", "pb").agg(F.sum("s").alias("s"))
    whole = entries.groupBy("__g").agg(F.collect_list(F.struct("ta", "pa", "tb", "pb", "s")).alias("e"))
    return whole.selectExpr("__g", *[f"e.{c} AS __{c}" for c in ("ta", "pa", "tb", "pb", "s")])


#: Numbers that a stack of matrices may hold in a task.
STACK = 2_000_000


class Entries:
    """The entries of ``_normal_equations`` of a batch of groups, one after another: the group's place ``g`` in the batch and ta, pa,
    tb, pb, s; ``off`` has a row per group."""

    def __init__(self, batch: pd.DataFrame):
        self.off = np.stack(batch["__off"].to_numpy())
        self.g = np.repeat(np.arange(len(batch)), batch["__s"].map(len))
        self.ta, self.pa, self.tb, self.pb, self.s = (np.concatenate(batch[f"__{c}"].to_numpy()) for c in ("ta", "pa", "tb", "pb", "s"))


def marked(lists: pd.Series, size: int) -> np.ndarray:
    """Rows of 0 and 1 that are 1 at the listed places."""
    out = np.zeros((len(lists), size), dtype=bool)
    out[np.repeat(np.arange(len(lists)), lists.map(len)), np.concatenate(lists.to_numpy()).astype(int)] = True
    return out


def p_values(b: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Two-sided p-values of the estimates; 1 without an error."""
    z = np.abs(b) / np.where(e > 0, e, 1.0)
    return np.where(e > 0, np.array([math.erfc(x / 2**0.5) for x in z.ravel()]).reshape(z.shape), 1.0)


def _solved(equations: DataFrame, lists: Sequence[str], k: int, max_iter: int, tol: float) -> DataFrame:
    """The groups' next coefficients, or their errors where they have converged or this was the last round."""
    texts = [c for c in lists if c.startswith("l")]
    kinds = {f.name: f.dataType.simpleString() for f in equations.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("__g", *texts)) + f", {_STATE}"

    def step(batch: pd.DataFrame) -> pd.DataFrame:
        """A round of groups that have the same number of coefficients."""
        e = Entries(batch)
        n, size = len(batch), int(e.off[0, -1])
        matrix, right, dev = np.zeros((n, size, size)), np.zeros((n, size)), np.zeros(n)
        rows, sides = (e.ta >= 0) & (e.tb >= 0), (e.ta >= 0) & (e.tb < 0)
        g, i, j = e.g[rows], e.off[e.g[rows], e.ta[rows]] + e.pa[rows], e.off[e.g[rows], e.tb[rows]] + e.pb[rows]
        matrix[g, i, j] = matrix[g, j, i] = e.s[rows]
        right[e.g[sides], e.off[e.g[sides], e.ta[sides]] + e.pa[sides]] = e.s[sides]
        dev[e.g[e.ta < 0]] = e.s[e.ta < 0]
        kept = marked(batch["__kept"], size) if k else independent_each(matrix)
        done = np.abs(dev - batch["__dev"].to_numpy()) <= tol * (np.abs(dev) + 0.1) if k > 1 else np.zeros(n, dtype=bool)
        last = done | (k == max_iter)
        part = matrix * (kept[:, :, None] & kept[:, None, :])
        beta, se, p = np.zeros((n, size)), np.zeros((n, size)), np.ones((n, size))
        if last.any():
            beta[last] = np.stack(batch["__beta"].to_numpy()[last])
            inverse = np.linalg.pinv(part[last], hermitian=True)
            se[last] = np.sqrt(np.maximum(np.diagonal(inverse, axis1=1, axis2=2), 0.0)) * kept[last]
            p[last] = p_values(beta[last], se[last])
        if not last.all():
            beta[~last] = _coefficients(part[~last], right[~last], kept[~last])
        return batch[["__g", *texts]].assign(__off=list(e.off), __beta=list(beta), __se=list(se), __p=list(p), __kept=[
            np.flatnonzero(x).astype("int32") for x in kept], __dev=dev, __done=done)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["__off"].map(lambda off: off[-1]).to_numpy()
            for size in np.unique(sizes):
                alike, most = batch[sizes == size], max(1, STACK // int(size) ** 2)
                for at in range(0, len(alike), most):
                    yield step(alike.iloc[at : at + most].reset_index(drop=True))

    return equations.mapInPandas(run, schema)


def _coefficients(matrix: np.ndarray, right: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Solutions of a stack of equations; columns that are not kept get 0."""
    try:
        return np.linalg.solve(matrix + np.eye(matrix.shape[1]) * ~kept[:, None, :], (right * kept)[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:  # weights of a separated term have run out
        out = np.zeros_like(right)
        for x, m, r, k in zip(out, matrix, right, kept):
            if k.any():
                part = m[np.ix_(k, k)]
                try:
                    x[k] = np.linalg.solve(part, r[k])
                except np.linalg.LinAlgError:
                    x[k] = np.linalg.lstsq(part, r[k], rcond=None)[0]
        return out
