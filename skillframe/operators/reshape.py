"""Long to wide, wide names, ordered text aggregation and column-wise application."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext
from ..functions.nulls import as_col, fill_missing, na_sum
from ..session import materialize

#: Characters of the shortest runs by which long parts are searched.
GRAM = 4
#: Parts up to this many rows travel to the texts whole (some 100 bytes each); of more parts only their runs do, up to
#: ``MAX_BROADCAST_RUNS`` numbers.
MAX_BROADCAST_PARTS, MAX_BROADCAST_RUNS = 500_000, 4_000_000
NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC and f.name not in skip]


def across(df: DataFrame, selector: Callable[[str], bool], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every column whose name the selector accepts; the others pass through."""
    return df.select(*[fn(F.col(c)).alias(c) if selector(c) else F.col(c) for c in df.columns])


def sum_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group sums of all numeric columns that are not keys."""
    return df.groupBy(*keys).agg(*[na_sum(c).alias(c) for c in numeric_columns(df, keys)])


def pivot_wide(
    df: DataFrame,
    ids: Sequence[str],
    names_from: str,
    names: Mapping[object, str] | Sequence[str] | None,
    values_from: Sequence[str],
    agg: Callable[[Column], Column] = na_sum,
    fill_num: float | None = 0,
    fill_str: str | None = "0",
) -> DataFrame:
    """One row per ``ids``, one column per value of ``names_from`` and value column.

    ``names`` lists the values to spread, or maps them to column labels; a value of None stands for missing. ``names=None``
    takes every value present, found by one distinct pass, sorted, missing last under the label ``NA``. With one
    value column the labels are the column names; with several the names are ``value_label``, value by value. Only
    matching rows enter ``agg``; cells without rows are missing, then filled. Cost is one group-by.
    """
    if names is None:
        found = [r[0] for r in df.select(names_from).distinct().collect()]
        names = {v: "NA" if v is None else str(v) for v in sorted(found, key=lambda v: (v is None, v if v is not None else 0))}
    labels = dict(names) if isinstance(names, Mapping) else {n: n for n in names}
    single = len(values_from) == 1
    cells = []
    for value in values_from:
        for key, label in labels.items():
            here = f"{sqltext.name(names_from)} <=> {sqltext.literal(key)}"
            out = label if single else f"{value}_{label}"
            cells.append(_cell(agg, here, value).alias(out))
    wide = df.groupBy(*ids).agg(*cells)
    return wide if fill_num is None else fill_missing(wide, fill_num, fill_str)


def pivot_sparse(
    df: DataFrame, ids: Sequence[str], names_from: str, values_from: Sequence[str], agg: Callable[[Column], Column] = na_sum, out: str = "cells"
) -> DataFrame:
    """One row per ``ids`` with the cells that have rows, for any number of names, known or not.

    ``out`` is an array of structs (name, then one field per value column), sorted by name, missing last; ``sparse_cell``
    reads one of them. The names are never listed anywhere; a row holds those of its own ids. Cells are added up before
    rows are put together, so a hot id costs what its distinct names cost.
    """
    if "name" in values_from:
        raise ValueError("the field name is taken by the names: rename the value column")
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate(ids)]
    cells = df.groupBy(*keys, F.col(names_from).alias("__name")).agg(*[agg(v).alias(f"__v{i}") for i, v in enumerate(values_from)])
    fields = [F.col("__name").alias("name"), *[F.col(f"__v{i}").alias(v) for i, v in enumerate(values_from)]]
    sort = F.struct(F.col("__name").isNull().alias("last"), F.col("__name").alias("by"), F.struct(*fields).alias("cell"))
    rows = cells.groupBy(*[f"__k{i}" for i in range(len(ids))]).agg(F.array_sort(F.collect_list(sort)).alias("__cells"))
    return rows.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(ids)], F.transform("__cells", lambda x: x["cell"]).alias(out))


def sparse_cell(cells: Column | str, name: object, value: str, fill: object = 0) -> Column:
    """A value of one name (None: missing) of ``pivot_sparse``; cells without rows and missing values are filled."""
    here = F.filter(cells, lambda x: x["name"].eqNullSafe(F.lit(name)))
    found = F.get(F.transform(here, lambda x: x[value]), F.lit(0))
    return found if fill is None else F.coalesce(found, F.lit(fill))


def _cell(agg: Callable[[Column], Column], here: str, value: str) -> Column:
    inside = f"CASE WHEN {here} THEN {sqltext.name(value)} END"
    if agg is na_sum:
        return F.expr(f"CASE WHEN count({inside}) = count_if({here}) THEN sum({inside}) END")
    return agg(F.expr(inside))


def ordered_concat(
    df: DataFrame, keys: Sequence[str], value: Column | str, order: Sequence[str], sep: str, out: str
) -> DataFrame:
    """Join the values of a group into one text in the given order; NULL prints as ``NA``.

    ``order`` holds SQL sort items such as ``'seconds DESC NULLS LAST'``. The result is one text per group, so give
    it one row per member (a team's players), not raw logs.
    """
    shown = F.coalesce(as_col(value).cast("string"), F.lit("NA"))
    quoted = sep.replace("'", "''")
    text = f"listagg(__shown, '{quoted}') WITHIN GROUP (ORDER BY {', '.join(order)})"
    return df.withColumn("__shown", shown).groupBy(*keys).agg(F.expr(text).alias(out))


def membership(
    lineups: DataFrame,
    col: str,
    sep: str = ";",
    mode: str = "exact",
    roles: DataFrame | None = None,
    role: str = "player_role",
) -> DataFrame:
    """Long form of the lineup-by-member 0/1 design: the distinct (lineup, member) pairs that hold a 1.

    ``exact`` splits the lineup text into its members. ``regex`` reproduces a text search instead, where every value
    of ``roles`` is a pattern that may also match inside a longer name. Roles without pattern signs are plain text, found
    by ``contained``; the distinct lineups are searched for the other roles in slices that are small enough to broadcast.
    """
    texts = lineups.select(col).where(F.col(col).isNotNull()).distinct()
    if mode == "exact":
        members = texts.select(col, F.explode(F.array_distinct(F.split(F.col(col), _quote(sep)))).alias(role))
        if roles is None:
            return members
        return members.join(roles.select(role).distinct(), role, "left_semi").select(col, role)
    if mode != "regex":
        raise ValueError(f"unknown mode: {mode}")
    if roles is None:
        raise ValueError("regex mode needs the roles to search for")
    roles = roles.select(role).where(F.col(role).isNotNull()).distinct()
    signs = F.rlike(F.col(role), F.lit(r"[\\^$.|?*+()\[\]{}]"))
    out = contained(texts, col, roles.where(~signs), role)
    patterns = roles.where(signs)
    slices = -(-patterns.count() // ROLES_PER_SLICE)
    sliced = patterns.withColumn("__slice", F.pmod(F.xxhash64(role), F.lit(slices)))
    for k in range(slices):
        part = F.broadcast(sliced.where(F.col("__slice") == k).drop("__slice"))
        found = texts.join(part, F.rlike(F.col(col), F.col(role)), "inner").select(col, role)
        out = out.unionByName(found)
    return out


def contained(texts: DataFrame, col: str, parts: DataFrame, part: str, size: int = GRAM) -> DataFrame:
    """The pairs (text, part) of distinct values where the part occurs inside the text.

    A part of up to ``size`` characters is looked up whole, a longer one by one of its runs of ``size`` characters, doubled as
    often as the part's length allows: the run that the fewest parts have. A text meets the parts whose run it has; those pairs
    are then compared. Missing values pair with nothing, an empty part with every text. Work grows with the texts' length times
    the lengths of runs, and with the pairs that share a run; runs go by hash, which decides work, never results.
    """
    texts = texts.select(F.col(col).alias("__text")).where("__text IS NOT NULL").distinct()
    parts = materialize(parts.select(F.col(part).alias("__part")).where("__part IS NOT NULL").distinct())
    width = f"CASE WHEN length(__part) <= {size} THEN length(__part) ELSE shiftleft({size}, int(log2(length(__part) DIV {size}))) END"
    runs = parts.selectExpr("__part", f"{width} AS __w").selectExpr("__part", f"explode(array_distinct({_runs('__part', '__w')})) AS __run")
    shared = runs.groupBy("__run").agg(F.count(F.lit(1)).alias("__parts"))
    rarest = runs.join(shared, "__run").groupBy("__part").agg(F.expr("min(struct(__parts, __run)) AS r"))
    keys = materialize(rarest.selectExpr("__part", "r.__run AS __run"))
    n = keys.count()
    widths = sorted(r[0] for r in parts.selectExpr(f"{width} AS w").distinct().collect())  # size and some doublings
    here = ", ".join(f"CASE WHEN length(__text) >= {w} THEN {_runs('__text', str(w))} ELSE array() END" for w in widths or [0])
    distinct_runs = f"explode(array_distinct(flatten(array({here})))) AS __run"
    if n <= MAX_BROADCAST_PARTS:
        met = texts.selectExpr("__text", distinct_runs).join(F.broadcast(keys), "__run")
    else:
        texts = materialize(texts.withColumn("__id", F.monotonically_increasing_id()))
        postings = texts.selectExpr("__id", distinct_runs)
        if n <= MAX_BROADCAST_RUNS:
            postings = postings.join(F.broadcast(keys.select("__run").distinct()), "__run", "left_semi")
        met = postings.join(keys, "__run").join(texts, "__id")
    return met.where("contains(__text, __part)").select(F.col("__text").alias(col), F.col("__part").alias(part))


def _runs(text: str, width: str) -> str:
    """SQL of the hashes of all runs of ``width`` characters in a text that has as many."""
    return f"transform(sequence(1, length({text}) - {width} + 1), i -> xxhash64(substring({text}, i, {width})))"


#: Patterns per broadcast slice in regex mode.
ROLES_PER_SLICE = 20_000


def _quote(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in sep)
