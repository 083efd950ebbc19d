"""Missing-value rules of the rating recipe, as Column expressions.

They differ from Spark's defaults: a group sum with one missing value is missing, an exclusion list keeps missing
values, a missing condition gives a missing result, and text pasting prints a missing value as ``NA``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_sum(c: Column | str) -> Column:
    """Group sum that is NULL as soon as one value of the group is NULL."""
    c = as_col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def not_in_keep_null(c: Column | str, values: Iterable[str]) -> Column:
    """True unless the value is on the list; NULL is not on any list, so it is kept."""
    c = as_col(c)
    return c.isNull() | ~c.isin(*values)


def ifelse3(condition: Column, yes: Column, no: Column) -> Column:
    """Three-valued choice: a NULL condition gives NULL instead of falling to ``no``."""
    return F.when(condition, yes).when(~condition, no)


def paste(*parts: Column | str, sep: str = "") -> Column:
    """Concatenate as text, printing NULL as ``NA``."""
    texts = [F.coalesce(as_col(p).cast("string"), F.lit("NA")) for p in parts]
    if not sep:
        return F.concat(*texts)
    return F.concat_ws(sep, *texts)


def fill_missing(df: DataFrame, number: float = 0, text: str | None = "0", skip: Iterable[str] = ()) -> DataFrame:
    """Replace NULL in every numeric column by ``number`` and, unless ``text`` is None, in text columns by ``text``."""
    skip = set(skip)
    fills: dict[str, float | str] = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if field.name in skip:
            continue
        if kind in ("byte", "short", "integer", "long", "float", "double"):
            fills[field.name] = number
        elif kind == "string" and text is not None:
            fills[field.name] = text
    return df.na.fill(fills) if fills else df


def clean_text(c: Column | str) -> Column:
    """Trim; empty text and the mark ``NA`` mean missing."""
    trimmed = F.trim(as_col(c))
    return F.when((trimmed != "") & (trimmed != "NA"), trimmed)
