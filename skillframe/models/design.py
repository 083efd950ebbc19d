"""Model terms, their design columns, and the dependent columns among them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext

#: Spark's iteratively reweighted least squares solves at most this many coefficients.
MAX_COLUMNS = 4096


@dataclass(frozen=True)
class Term:
    """A numeric column, or the product of a numeric and a text column (one coefficient per text value)."""

    first: str
    second: str | None = None

    @property
    def variables(self) -> tuple[str, ...]:
        return (self.first,) if self.second is None else (self.first, self.second)


@dataclass(frozen=True)
class DesignColumn:
    """One coefficient: ``number`` where ``factor`` equals ``level`` (and ``group`` equals ``group_level``), else 0."""

    name: str
    number: str
    factor: str | None = None
    level: str | None = None
    group: str | None = None
    group_level: str | None = None

    def sql(self) -> str:
        value = f"double({sqltext.name(self.number)})"
        tests = [
            f"{sqltext.name(text)} = {sqltext.literal(wanted)}"
            for text, wanted in ((self.factor, self.level), (self.group, self.group_level))
            if text is not None
        ]
        return f"CASE WHEN {' AND '.join(tests)} THEN {value} ELSE 0D END" if tests else value


def split_term(df: DataFrame, term: Term) -> tuple[str, str | None]:
    """(numeric column, text column or None) of a term, told apart by the schema."""
    kinds = {name: df.schema[name].dataType.typeName() for name in term.variables}
    texts = [n for n, k in kinds.items() if k == "string"]
    numbers = [n for n in term.variables if n not in texts]
    if len(numbers) != 1 or len(texts) > 1:
        raise ValueError(f"a term needs one numeric and at most one text column: {term}")
    return numbers[0], (texts[0] if texts else None)


def complete_cases(df: DataFrame, label: str, terms: Sequence[Term], *extra: str) -> DataFrame:
    """Rows with a value in every model column, and only those columns."""
    names = list(dict.fromkeys([label, *[v for t in terms for v in t.variables], *extra]))
    return df.select(*names).dropna(subset=names)


def levels(df: DataFrame, column: str, limit: int = MAX_COLUMNS) -> list[str]:
    """The sorted distinct values of a text column; refuses more than a model can hold."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    return sorted(found)


def design_columns(
    df: DataFrame, terms: Sequence[Term], group: str | None = None
) -> list[DesignColumn]:
    """The columns of the no-intercept design, in term order; all levels of a text column are kept."""
    known: dict[str, list[str]] = {}
    out: list[DesignColumn] = []
    for group_level in levels(df, group) if group else [None]:
        for term in terms:
            number, factor = split_term(df, term)
            if factor is None:
                out.append(DesignColumn(term.first, number, group=group, group_level=group_level))
                continue
            if factor not in known:
                known[factor] = levels(df, factor)
            for level in known[factor]:
                name = ":".join(v + level if v == factor else v for v in term.variables)
                out.append(DesignColumn(name, number, factor, level, group, group_level))
    if len(out) > MAX_COLUMNS:
        raise ValueError(f"the design has {len(out)} columns; at most {MAX_COLUMNS} can be solved")
    return out


def gramian(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Sum of the outer products of the rows of SQL expressions: tasks reduce their rows, Spark adds the partial sums."""
    size = len(columns)
    wide = df.selectExpr(f"array({', '.join(columns)}) AS x")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                total += x.T @ x
        i, j = np.nonzero(np.triu(total))
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "g": total[i, j]})

    sums = wide.mapInPandas(partial, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    out = np.zeros((size, size))
    for row in sums.toLocalIterator():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["g"]
    return out


def independent(gram: np.ndarray, tolerance: float = 1e-9, norms: np.ndarray | None = None) -> list[int]:
    """Indexes of the columns that are not linear combinations of earlier ones.

    ``norms`` gives the columns' squared lengths where ``gram`` holds what other columns have left of them.
    """
    kept: list[int] = []
    basis = np.zeros((0, 0))
    for j in range(gram.shape[0]):
        norm = gram[j, j] if norms is None else norms[j]
        if norm <= 0:
            continue
        if kept:
            cross = gram[np.ix_(kept, [j])][:, 0]
            half = np.linalg.solve(basis, cross)
            rest = gram[j, j] - half @ half
        else:
            half, rest = np.zeros(0), gram[j, j]
        if rest <= tolerance * norm:
            continue
        grown = np.zeros((len(kept) + 1, len(kept) + 1))
        grown[:-1, :-1] = basis
        grown[-1, :-1] = half
        grown[-1, -1] = np.sqrt(rest)
        basis = grown
        kept.append(j)
    return kept


def independent_each(grams: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """For every matrix of a stack, which columns are not linear combinations of earlier ones."""
    rest, kept = grams.copy(), np.zeros(grams.shape[:2], dtype=bool)
    for j in range(grams.shape[1]):
        norm, left = grams[:, j, j], rest[:, j, j]
        use = kept[:, j] = (norm > 0) & (left > tolerance * norm)
        share = rest[:, :, j] / np.where(use, left, 1.0)[:, None] * use[:, None]
        rest -= share[:, :, None] * rest[:, None, j, :]
    return kept
