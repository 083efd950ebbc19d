"""Relabelling, class labels, corrections and ordered rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext
from .joins import equi_join

#: Lookup tables up to this many rows travel to every executor.
MAX_BROADCAST_ROWS = 100_000


def lookup_table(spark: SparkSession, mapping: Mapping[str, str], key: str = "old", value: str = "new") -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def relabel(df: DataFrame, col: str, lookup: DataFrame | Mapping[str, str], default: str | None = "keep") -> DataFrame:
    """Replace values through a lookup (first column old, second column new).

    ``default='keep'`` passes unknown values through; ``default=None`` makes them NULL (class labels). A mapping
    becomes an expression; a lookup table is joined, and broadcast only when a bounded count shows it is small. If a key
    is listed twice, the smallest new value holds (missing ones last), so no row of ``df`` is multiplied.
    """
    if isinstance(lookup, Mapping):
        return df.withColumn(col, relabel_expr(F.col(col), lookup, default))
    key, value = lookup.columns[:2]
    table = lookup.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__old")).agg(F.min(value).alias("__new"))
    if table.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        table = F.broadcast(table)
    joined = df.join(table, df[col] == table["__old"], "left")
    new = F.coalesce(F.col("__new"), F.col(col)) if default == "keep" else F.col("__new")
    return joined.withColumn(col, new).select(*df.columns)


def relabel_expr(c: Column, mapping: Mapping[str, str], default: str | None = "keep") -> Column:
    new = F.try_element_at(F.expr(sqltext.mapping(mapping.items())), c)
    return F.coalesce(new, c) if default == "keep" else new


def apply_corrections(df: DataFrame, corrections: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Override ``col`` in the rows whose keys are listed in ``corrections`` (keys plus a column named ``col``).

    If keys are listed twice, the smallest value holds (missing ones last), so no row of ``df`` is multiplied.
    """
    fixes = corrections.groupBy(*keys).agg(F.min(col).alias("__fix"), F.lit(True).alias("__hit"))
    if fixes.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        fixes = F.broadcast(fixes)
    joined = equi_join(df, fixes, keys, "left", nullsafe=False)
    fixed = F.when(F.col("__hit"), F.col("__fix")).otherwise(F.col(col))
    return joined.withColumn(col, fixed).select(*df.columns)


@dataclass(frozen=True)
class Clause:
    """Holds when at least one of ``any_of`` and none of ``none_of`` is on the list."""

    any_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()

    def sql(self, members: str) -> str:
        tests = []
        if self.any_of:
            tests.append("(" + " OR ".join(f"contains({members}, {sqltext.literal(n)})" for n in self.any_of) + ")")
        tests += [f"NOT contains({members}, {sqltext.literal(n)})" for n in self.none_of]
        return "(" + (" AND ".join(tests) or "true") + ")"


@dataclass(frozen=True)
class Rule:
    """Label for some subjects: when every ``all_of`` group has a clause that holds."""

    subjects: tuple[str, ...]
    label: str
    all_of: tuple[tuple[Clause, ...], ...] = field(default=())

    def sql(self, subject: str, members: str) -> str:
        tests = [f"{subject} IN ({sqltext.listing(self.subjects)})"]
        tests += ["(" + " OR ".join(c.sql(members) for c in alternatives) + ")" for alternatives in self.all_of]
        return " AND ".join(tests)


def classify(df: DataFrame, rules: Sequence[Rule], subject: str, members_col: str, out: str) -> DataFrame:
    """Label of the first rule that applies; NULL if none does. Members are looked up in the group's list text."""
    subject, members = sqltext.name(subject), sqltext.name(members_col)
    branches = [f"WHEN {r.sql(subject, members)} THEN {sqltext.literal(r.label)}" for r in rules]
    return df.withColumn(out, F.expr(f"CASE {' '.join(branches)} END"))
