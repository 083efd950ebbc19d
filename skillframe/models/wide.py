"""Logistic regression on a text column of any number of values beside a narrow design.

The design has two parts: terms on the ``wide`` text column, of which a row touches one value only, and the others. In the
normal equations of a round the wide part is block-diagonal, a small block per text value. Blocks are grouped sums; tasks
take each block out of the equations of the narrow part, whose sums alone reach the driver; with its solution
every block gets its own coefficients back. No matrix over the text values exists, and their coefficients stay in tables.

A text value's own coefficients follow from its rows and the narrow coefficients of all rounds so far. Rows are therefore written
once, packed by text value, and a round is one reading pass in which tasks go through the rounds again: nothing is shuffled or written
between rounds. Text values of more than ``PACKED_ROWS`` rows are not packed; sums of theirs are added up by Spark.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext
from ..session import materialize
from .design import Term, complete_cases, independent, independent_each, levels, split_term
from .grouped import STACK, Entries, _design, _normal_equations, marked, p_values

#: The narrow part is solved on the driver: its matrix has at most this many rows.
MAX_NARROW = 1024
#: A text value of more rows is not brought together.
PACKED_ROWS = 16_384
_COEFS = "term string, estimate double, std_error double, statistic double, p_value double"


def fit_logit_wide(
    df: DataFrame,
    label: str,
    terms: Sequence[Term],
    wide: str,
    collapse: bool = False,
    max_iter: int = 25,
    tol: float = 1e-8,
) -> DataFrame:
    """Maximum likelihood fit of a 0/1 label on the terms, without intercept: term, estimate, std_error, statistic, p_value,
    converged.

    ``wide`` is the text column of at least one term and may have any number of values; the other terms may have
    ``MAX_NARROW`` columns together. Rows with a missing value in a model column are left out. Columns that depend on earlier
    ones have NULL estimates, where columns of ``wide`` come before all others, whatever the order of the terms. The fit stops
    when its deviance changes by less than ``tol`` of itself, as in ``fit_logit_groups``; else ``converged`` is false, with a warning.
    Without usable rows the result is empty.
    """
    own = [t for t in terms if split_term(df, t)[1] == wide]
    narrow = [t for t in terms if t not in own]
    if not own:
        raise ValueError(f"no term has the text column {wide}")
    if any(wide in t.variables for t in narrow):
        raise ValueError(f"{wide} has to be a text column")
    # Every text value of ``wide`` is a group here: its own columns first, then the narrow ones that occur with it.
    local = [Term(split_term(df, t)[0]) for t in own] + narrow
    used = list(dict.fromkeys(v for t in local for v in t.variables))
    cases = complete_cases(df, label, local, wide)
    cases = cases.select(label, wide, *[c for c in used if c != label])
    places = _Places(cases, narrow, len(own))
    large = materialize(cases.groupBy(wide).agg(F.count(F.lit(1)).alias("__rows")).where(f"__rows > {PACKED_ROWS}").select(wide))
    parts: list[_Packed | _Joined] = []
    if large.count():  # as many as the rows have multiples of PACKED_ROWS at most
        parts.append(_Joined(places, cases.join(F.broadcast(large), wide, "left_semi"), label, local, wide, collapse))
        cases = cases.join(F.broadcast(large), wide, "left_anti")
    parts.append(_Packed(places, cases, label, local, wide, collapse))

    before, kept, betas, error, done = math.inf, None, [], np.zeros((0, 0)), False
    for k in range(max_iter + 2):
        matrix, right, norms, deviance, n = (sum(x) for x in zip(*(part.reduced(betas) for part in parts)))
        if not n:
            break
        kept = independent(matrix, norms=norms) if kept is None else kept
        part = matrix[np.ix_(kept, kept)]
        done = k > 1 and abs(deviance - before) <= tol * (abs(deviance) + 0.1)
        before = deviance
        if done or k > max_iter:  # the coefficients stand; the matrix at them gives the errors
            error = np.linalg.pinv(part, hermitian=True) if kept else np.zeros((0, 0))
            break
        beta = np.zeros(places.size)
        if kept:
            beta[kept] = np.linalg.lstsq(part, right[kept], rcond=None)[0]
        betas.append(beta)
    if n and not done:
        warnings.warn(f"the logistic fit did not converge in {max_iter} rounds", stacklevel=2)
    if n:
        beta, spread = betas[-1], np.zeros((places.size, places.size))
        spread[np.ix_(kept, kept)] = error
        found = reduce(DataFrame.unionByName, [part.errors(betas, own, wide, spread) for part in parts])
    else:
        found = df.sparkSession.createDataFrame([], _COEFS)
    se = np.sqrt(np.maximum(np.diag(error), 0.0))
    rows = []
    for j, name in enumerate(places.names if n else []):
        if j in kept:
            b, e = float(beta[j]), float(se[kept.index(j)])
            rows.append((name, b, e, *_test(b, e)))
        else:
            rows.append((name, None, None, None, None))
    return found.unionByName(df.sparkSession.createDataFrame(rows, _COEFS)).withColumn("converged", F.lit(done))


def _test(b: float, e: float) -> tuple[float | None, float]:
    return (b / e, math.erfc(abs(b / e) / 2**0.5)) if e > 0 else (None, 1.0)


class _Places:
    """Where the narrow columns of a group stand among all narrow columns, and the passes over the groups' equations."""

    def __init__(self, cases: DataFrame, narrow: Sequence[Term], own: int):
        self.own, self.names, self.terms, self.factors = own, [], [], []
        for term in narrow:
            factor = split_term(cases, term)[1]
            start = len(self.names)
            if factor is None:
                self.names.append(term.first)
                self.terms.append((start, None, None))
                continue
            if factor not in self.factors:
                self.factors.append(factor)
            values = levels(cases, factor, MAX_NARROW)
            self.names += [":".join(v + x if v == factor else v for v in term.variables) for x in values]
            self.terms.append((start, self.factors.index(factor), {x: i for i, x in enumerate(values)}))
        self.size = len(self.names)
        if self.size > MAX_NARROW:
            raise ValueError(f"{self.size} columns beside the wide text column; at most {MAX_NARROW} can be solved")

    def pieces(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The groups in pieces whose cross blocks fit into a stack."""
        most = max(1, STACK // max(1, self.own * self.size))
        for batch in batches:
            for at in range(0, len(batch), most):
                yield batch.iloc[at : at + most].reset_index(drop=True)

    def levels_of(self, batch: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per factor: which of its values the groups have, one group after another, and where each group's begin."""
        out = []
        for j in range(len(self.factors)):
            index = next(x for _, k, x in self.terms if k == j)
            values = batch[f"l{j}"]
            out.append((np.array([index[x] for row in values for x in row], dtype=int), np.cumsum(values.map(len)) - values.map(len)))
        return [(at, start.to_numpy()) for at, start in out]

    def place(self, values: list, g: np.ndarray, t: np.ndarray, p: np.ndarray) -> np.ndarray:
        """The global places of narrow columns: of term ``t`` and the group's text value ``p``."""
        out = np.zeros(len(t), dtype=int)
        for k, (start, j, _) in enumerate(self.terms, self.own):
            here = t == k
            out[here] = start if j is None else start + values[j][0][values[j][1][g[here]] + p[here]]
        return out

    def blocks(self, batch: pd.DataFrame, first: bool) -> tuple:
        """Of every group: own columns kept, inverse of their block, cross block (0 where not kept), own right side; the
        entries and the global places of their two columns."""
        e, o, n = Entries(batch), self.own, len(batch)
        values = self.levels_of(batch)
        i, j = self.place(values, e.g, e.ta, e.pa), self.place(values, e.g, e.tb, e.pb)
        matrix, cross, side = np.zeros((n, o, o)), np.zeros((n, o, self.size)), np.zeros((n, o))
        mine = (e.ta >= 0) & (e.ta < o)
        at = mine & (e.tb >= 0) & (e.tb < o)
        matrix[e.g[at], e.ta[at], e.tb[at]] = matrix[e.g[at], e.tb[at], e.ta[at]] = e.s[at]
        at = mine & (e.tb >= o)
        cross[e.g[at], e.ta[at], j[at]] = e.s[at]
        at = mine & (e.tb < 0)
        side[e.g[at], e.ta[at]] = e.s[at]
        kept = independent_each(matrix) if first else marked(batch["__kept"], o)
        inverse = np.linalg.pinv(matrix * (kept[:, :, None] & kept[:, None, :]), rcond=1e-14, hermitian=True)
        return kept, inverse, cross * kept[:, :, None], side * kept, e, i, j

    def reduced(self, equations: DataFrame, first: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
        """The narrow part's matrix and right side without what the groups' own columns explain, the squared lengths of its
        columns, the deviance and the number of groups. Tasks add their groups, Spark adds the tasks."""
        places = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m, o = places.size, places.own
            matrix, right, norms, deviance, n = np.zeros((m, m)), np.zeros(m), np.zeros(m), 0.0, 0
            for batch in places.pieces(batches):
                _, inverse, cross, side, e, i, j = places.blocks(batch, first)
                pairs, sides = (e.ta >= o) & (e.tb >= o), (e.ta >= o) & (e.tb < 0)
                np.add.at(matrix, (i[pairs], j[pairs]), e.s[pairs])
                mirrored = pairs & (i != j)
                np.add.at(matrix, (j[mirrored], i[mirrored]), e.s[mirrored])
                own_length = pairs & (i == j)
                np.add.at(norms, i[own_length], e.s[own_length])
                np.add.at(right, i[sides], e.s[sides])
                explained = (inverse @ cross).reshape(len(batch) * o, m)
                matrix -= explained.T @ cross.reshape(len(batch) * o, m)
                right -= explained.T @ side.ravel()
                deviance, n = deviance + e.s[e.ta < 0].sum(), n + len(batch)
            yield pd.DataFrame(dict(zip("ijs", sums_of(matrix, right, norms, deviance, n))))

        return self.added(equations.mapInPandas(run, "i int, j int, s double"))

    def added(self, sums: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
        """What the tasks have sent by ``sums_of``, added up."""
        out, last = np.zeros((self.size + 2, self.size)), [0.0, 0.0]
        for r in sums.groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
            if r["i"] == -3:
                last[r["j"]] = r["s"]
            else:
                out[r["i"] if r["i"] >= 0 else self.size - 1 - r["i"], r["j"]] = r["s"]
        matrix = out[: self.size]
        return (matrix + matrix.T) / 2, out[self.size], out[self.size + 1], last[0], int(last[1])

    def solved(self, equations: DataFrame, lists: Sequence[str], beta: np.ndarray) -> DataFrame:
        """The groups with their coefficients: their own, given the narrow ones, then the narrow ones that occur with them."""
        places, first = self, "__kept" not in lists and "__kept" not in equations.columns
        kinds = {f.name: f.dataType.simpleString() for f in equations.schema.fields}
        texts = [c for c in lists if c.startswith("l")]
        schema = ", ".join(f"{c} {kinds[c]}" for c in ("__g", *texts, "__off")) + ", __beta array<double>, __kept array<int>"

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            o = places.own
            for batch in places.pieces(batches):
                kept, inverse, cross, side, e, _, _ = places.blocks(batch, first)
                mine = (inverse @ (side - cross @ beta)[:, :, None])[:, :, 0]
                # Coefficients of all groups one after another, each where the group's ``off`` puts its term.
                ends = np.cumsum(e.off[:, -1])
                begins, flat = ends - e.off[:, -1], np.zeros(ends[-1])
                flat[begins[:, None] + np.arange(o)] = mine
                values, groups = places.levels_of(batch), np.arange(len(batch))
                for k, (start, j, _) in enumerate(places.terms, o):
                    if j is None:
                        flat[begins + e.off[:, k]] = beta[start]
                    else:
                        found, starts = values[j]
                        g = np.repeat(groups, np.diff(np.append(starts, len(found))))
                        flat[begins[g] + e.off[g, k] + np.arange(len(found)) - starts[g]] = beta[start + found]
                yield batch[["__g", *texts, "__off"]].assign(
                    __beta=np.split(flat, ends[:-1]), __kept=[np.flatnonzero(x).astype("int32") for x in kept])

        return equations.mapInPandas(run, schema)

    def errors(self, equations: DataFrame, own: Sequence[Term], wide: str, spread: np.ndarray) -> DataFrame:
        """The wide columns' rows: their estimates, and errors that know of the narrow part's."""
        places = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in places.pieces(batches):
                known, inverse, cross, _, _, _, _ = places.blocks(batch, False)
                betas = np.stack([x[: places.own] for x in batch["__beta"]])
                for rows in named_rows(pa.array(batch["__g"]), betas, known, inverse, cross, spread, own, wide):
                    yield rows.to_pandas()

        return equations.mapInPandas(run, _COEFS)


def sums_of(matrix: np.ndarray, right: np.ndarray, norms: np.ndarray, deviance: float, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A task's sums as rows i, j, s: the matrix, the right side at i = -1, the squared lengths at -2, deviance and number at -3."""
    m, (i, j) = len(right), np.nonzero(matrix)
    rows = [np.array([i, j, matrix[i, j]]), np.array([np.full(m, -1), np.arange(m), right]),
            np.array([np.full(m, -2), np.arange(m), norms]), np.array([[-3, -3], [0, 1], [deviance, n]])]
    i, j, s = np.concatenate(rows, axis=1)
    return i.astype("int32"), j.astype("int32"), s


def named_rows(
    groups: pa.Array, betas: np.ndarray, known: np.ndarray, inverse: np.ndarray, cross: np.ndarray, spread: np.ndarray, own: Sequence[Term], wide: str
) -> Iterator[pa.RecordBatch]:
    """Per own term the rows of ``_COEFS`` of a stack of groups; NULL where a group's column is not kept."""
    half = inverse @ cross
    se = np.sqrt(np.maximum(np.diagonal(inverse, axis1=1, axis2=2) + (half @ spread * half).sum(axis=2), 0.0))
    for t, term in enumerate(own):
        b, e, k = betas[:, t], se[:, t], known[:, t]
        at = term.variables.index(wide)
        names = pc.binary_join_element_wise(":".join([*term.variables[:at], wide]), groups, "".join(":" + v for v in term.variables[at + 1 :]), "")
        columns = [np.where(k, b, np.nan), np.where(k, e, np.nan), np.where(k & (e > 0), b / np.where(e > 0, e, 1.0), np.nan),
                   np.where(k, p_values(b, e), np.nan)]
        yield pa.RecordBatch.from_arrays([names, *[pa.array(x, from_pandas=True) for x in columns]], [c.split()[0] for c in _COEFS.split(", ")])


class _Joined:
    """Groups of any number of rows: Spark adds up their equations, and joins their coefficients with their rows."""

    def __init__(self, places: _Places, cases: DataFrame, label: str, local: Sequence[Term], wide: str, collapse: bool):
        self.places, self.local, self.equations = places, local, None
        self.cells, self.state, _ = _design(cases, label, local, wide, collapse)
        self.lists = [c for c in self.state.columns if c != "__g"]

    def reduced(self, betas: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
        if betas:
            self.state = materialize(self.places.solved(self.equations, self.lists, betas[-1]))
        sums = _normal_equations(self.cells, self.state if betas else None, self.local)
        self.equations = materialize(sums.join(self.state, "__g"))
        return self.places.reduced(self.equations, first=not betas)

    def errors(self, betas: Sequence[np.ndarray], own: Sequence[Term], wide: str, spread: np.ndarray) -> DataFrame:
        return self.places.errors(self.equations, own, wide, spread)


class _Replay:
    """What tasks do with bundles of rows: the rounds so far once more. ``values`` says which number column every term has."""

    def __init__(self, places: _Places, values: Sequence[int]):
        self.places, self.values = places, values

    def stacks(self, batches: Iterator[pa.RecordBatch], betas: Sequence[np.ndarray]) -> Iterator[tuple]:
        """Stacks of groups at the last round: the groups, their own coefficients, which of them are kept, inverse of their block, cross
        block, own right side, and of their rows: weights, right sides, log-odds, places and values of narrow columns, share of ones, cases."""
        places, o = self.places, self.places.own
        most = max(1, STACK // max(1, o * places.size))
        for batch in batches:
            for at in range(batch.num_rows):
                bundle = {c: batch.column(c)[at].values for c in batch.schema.names}
                ends = bundle["ends"].to_numpy()
                for first in range(0, len(ends), most):
                    stop = ends[first : first + most]
                    start = int(ends[first - 1]) if first else 0
                    part = {c: v[start : int(stop[-1])].to_numpy() for c, v in bundle.items() if c not in ("g", "ends")}
                    groups = bundle["g"][first : first + most] if "g" in bundle else None
                    yield groups, *self.replayed(part, stop - start, betas)

    def replayed(self, rows: dict[str, np.ndarray], ends: np.ndarray, betas: Sequence[np.ndarray]) -> tuple:
        o, m, n, y = self.places.own, self.places.size, len(ends), rows["y"]
        begins = np.concatenate([[0], ends[:-1]])
        of = np.repeat(np.arange(n), np.diff(ends, prepend=0))
        count = rows.get("n", 1.0)
        values = [rows[f"x{i}"] for i in self.values]
        own, narrow = values[:o], values[o:]
        spots = [np.full(len(y), start) if j is None else start + rows[f"p{j}"] for start, j, _ in self.places.terms]
        added = lambda x: np.add.reduceat(x, begins)
        eta, mine, kept = np.log((count * y + 0.5) / (count * (1 - y) + 0.5)), np.zeros((n, o)), None
        for beta in [*betas, None]:
            mu = 1 / (1 + np.exp(-eta))
            w = count * mu * (1 - mu)
            z = w * eta + count * (y - mu)
            matrix, side = np.zeros((n, o, o)), np.zeros((n, o))
            for a in range(o):
                side[:, a] = added(z * own[a])
                for b in range(a, o):
                    matrix[:, a, b] = matrix[:, b, a] = added(w * own[a] * own[b])
            kept = independent_each(matrix) if kept is None else kept
            side *= kept
            inverse = _inverted(matrix * (kept[:, :, None] & kept[:, None, :]))
            if beta is None:
                break
            given = sum((x * beta[at] for x, at in zip(narrow, spots)), np.zeros(len(y)))
            rest = side - np.stack([added(w * x * given) for x in own], axis=1) * kept
            mine = (inverse @ rest[:, :, None])[:, :, 0]
            eta = np.clip(given + sum(x * mine[of, a] for a, x in enumerate(own)), -30, 30)
        cross = np.zeros((n, o, m))
        for a in range(o):
            for x, at in zip(narrow, spots):
                cross[:, a] += np.bincount(of * m + at, w * own[a] * x, n * m).reshape(n, m)
        return mine, kept, inverse, cross * kept[:, :, None], side, w, z, eta, spots, narrow, y, count

class _Packed:
    """Groups of up to ``PACKED_ROWS`` rows, many to a row of the table: per bundle the groups, where each ends, and their rows' values
    one after another. A round reads it once; what a group's own coefficients were in earlier rounds is found again from ``betas``."""

    def __init__(self, places: _Places, cases: DataFrame, label: str, local: Sequence[Term], wide: str, collapse: bool):
        self.places, spark = places, cases.sparkSession
        split = [split_term(cases, t) for t in local]
        numbers = list(dict.fromkeys(n for n, _ in split))
        self.replay = _Replay(places, [numbers.index(n) for n, _ in split])
        rows = cases.selectExpr(f"{sqltext.name(wide)} AS g", f"double({sqltext.name(label)}) AS y", *[
            f"double({sqltext.name(n)}) AS x{i}" for i, n in enumerate(numbers)], *[f"{sqltext.name(f)} AS f{j}" for j, f in enumerate(places.factors)])
        if collapse:
            rows = rows.groupBy([c for c in rows.columns if c != "y"]).agg(F.expr("avg(y) AS y"), F.expr("double(count(1)) AS n"))
        for j in range(len(places.factors)):
            index = next(x for _, k, x in places.terms if k == j)
            known = spark.createDataFrame(list(index.items()), f"f{j} string, p{j} int")  # MAX_NARROW rows at most
            rows = rows.join(F.broadcast(known), f"f{j}").drop(f"f{j}")
        names = [c for c in rows.columns if c != "g"]
        kinds = ", ".join(f"{c} array<{'int' if c.startswith('p') else 'double'}>" for c in names)
        self.table = materialize(rows.repartition("g").sortWithinPartitions("g").mapInArrow(_bundled, f"g array<string>, ends array<int>, {kinds}"))

    def reduced(self, betas: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
        """As ``_Places.reduced``."""
        replay, m, o = self.replay, self.places.size, self.places.own

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matrix, right, norms, deviance, n = np.zeros((m, m)), np.zeros(m), np.zeros(m), 0.0, 0
            for _, _, _, inverse, cross, side, w, z, eta, spots, narrow, y, count in replay.stacks(batches, betas):
                whole = np.zeros((m, m))
                for t, (x, at) in enumerate(zip(narrow, spots)):
                    right += np.bincount(at, z * x, m)
                    whole += np.bincount(at * m + at, w * x * x, m * m).reshape(m, m)
                    for x2, at2 in zip(narrow[t + 1 :], spots[t + 1 :]):
                        sums = np.bincount(at * m + at2, w * x * x2, m * m).reshape(m, m)
                        whole += sums + sums.T
                norms += np.diag(whole)
                explained = (inverse @ cross).reshape(len(side) * o, m)
                matrix += whole - explained.T @ cross.reshape(len(side) * o, m)
                right -= explained.T @ side.ravel()
                deviance, n = deviance + (2 * count * (np.log1p(np.exp(eta)) - y * eta)).sum(), n + len(side)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in sums_of(matrix, right, norms, deviance, n)], ["i", "j", "s"])

        return self.places.added(self.table.drop("g").mapInArrow(run, "i int, j int, s double"))

    def errors(self, betas: Sequence[np.ndarray], own: Sequence[Term], wide: str, spread: np.ndarray) -> DataFrame:
        """As ``_Places.errors``."""
        replay = self.replay

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for groups, mine, known, inverse, cross, *_ in replay.stacks(batches, betas):
                yield from named_rows(groups, mine, known, inverse, cross, spread, own, wide)

        return self.table.mapInArrow(run, _COEFS)


def _inverted(matrix: np.ndarray) -> np.ndarray:
    if matrix.shape[1] == 1:
        return np.divide(1.0, matrix, out=np.zeros_like(matrix), where=matrix != 0)
    return np.linalg.pinv(matrix, rcond=1e-14, hermitian=True)


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their group g as bundles of whole groups, a bundle of what a batch holds."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
        g = rows["g"].chunk(0)
        starts = np.flatnonzero(pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)) + 1
        cut = int(starts[-1]) if len(starts) else 0
        if cut:
            yield _bundle(rows.slice(0, cut), starts)
        held = rows.slice(cut)
    if held is not None:
        yield _bundle(held, np.array([held.num_rows]))


def _bundle(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
    columns = {c: rows[c].combine_chunks() for c in rows.column_names}
    columns["g"] = columns["g"].take(pa.array(ends - 1))
    columns = {"g": columns.pop("g"), "ends": pa.array(ends.astype("int32")), **columns}
    return pa.RecordBatch.from_arrays([
        pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in columns.values()], list(columns))
