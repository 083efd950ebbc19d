"""Text files of several dialects into one typed table, and table sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ISO_TIME, parse_time
from ..functions.nulls import clean_text


@dataclass(frozen=True)
class Dialect:
    """How one family of files spells the canonical columns."""

    name: str
    renames: Mapping[str, str] = field(default_factory=dict)
    time_format: str = ISO_TIME


def read_text_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header, every cell as text; blank cells and the mark ``NA`` are missing.

    Columns are named by the header of the first file; a file with another header raises an error instead of shifting
    its cells. Adds ``file_name``.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(paths)
    cleaned = [clean_text(F.col(f"`{c}`")).alias(c.strip()) for c in raw.columns]
    return raw.select(*cleaned, F.col("_metadata.file_name").alias("file_name"))


def conform(
    df: DataFrame, dialect: Dialect, schema: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Rename and type the columns of one dialect to the canonical schema; unreadable cells become NULL.

    ``schema`` maps names to ``string``, ``double`` or ``timestamp_ntz``; columns the files lack are NULL.
    """
    renamed = df.withColumnsRenamed(dict(dialect.renames))
    return renamed.select(*[c.alias(n) for n, c in _typed(renamed, dialect, schema).items()], *keep)


def _typed(renamed: DataFrame, dialect: Dialect, schema: Mapping[str, str]) -> dict[str, Column]:
    """Each canonical column's value, read from the dialect's text."""
    out = {}
    for name, kind in schema.items():
        if name not in renamed.columns:
            out[name] = F.lit(None).cast(kind)
        elif kind == "timestamp_ntz":
            out[name] = parse_time(name, dialect.time_format)
        elif kind == "string":
            out[name] = F.col(name).cast("string")
        else:
            out[name] = F.col(name).try_cast(kind)
    return out


def _refused(renamed: DataFrame, dialect: Dialect, schema: Mapping[str, str]) -> dict[str, Column]:
    """For each column that can be unreadable: whether a cell has text but no value."""
    typed = _typed(renamed, dialect, schema)
    return {n: F.col(n).isNotNull() & typed[n].isNull() for n, kind in schema.items() if kind != "string" and n in renamed.columns}


def conform_observed(
    df: DataFrame, dialect: Dialect, schema: Mapping[str, str], keep: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """``conform`` with counts that come with the first action on the rows, without a second pass: ``rows``, and per column
    that can be unreadable the number of refused cells."""
    renamed, seen = df.withColumnsRenamed(dict(dialect.renames)), Observation()
    counts = [F.count_if(c).alias(n) for n, c in _refused(renamed, dialect, schema).items()]
    # Counted below the typing, from the text that the rows bring along.
    watched = renamed.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    return conform(watched, Dialect(dialect.name, time_format=dialect.time_format), schema, keep), seen


def refused_cells(df: DataFrame, dialect: Dialect, schema: Mapping[str, str], keep: Sequence[str] = ("file_name",)) -> DataFrame:
    """The cells ``conform`` turns into NULL although they hold text: ``keep``, column_name, cell. A row per such cell."""
    renamed = df.withColumnsRenamed(dict(dialect.renames))
    cells = [F.when(c, F.struct(F.lit(n).alias("column_name"), F.col(n).cast("string").alias("cell")))
             for n, c in _refused(renamed, dialect, schema).items()]
    nothing = F.expr("array(CAST(NULL AS struct<column_name: string, cell: string>))")
    found = renamed.select(*keep, F.filter(F.array(*cells) if cells else nothing, lambda c: c.isNotNull()).alias("found"))
    return found.select(*keep, F.inline("found"))


def refusals(df: DataFrame, dialect: Dialect, schema: Mapping[str, str], by: str = "file_name") -> DataFrame:
    """Per file and column that can be unreadable: n rows and refused cells, in one aggregation."""
    renamed = df.withColumnsRenamed(dict(dialect.renames))
    counts = _refused(renamed, dialect, schema)
    sums = renamed.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"r{k}") for k, c in enumerate(counts.values())])
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(f"r{k}").alias("refused")) for k, n in enumerate(counts)]
    if not pairs:
        return sums.select(by, F.lit("").alias("column_name"), "n", F.lit(0).cast("long").alias("refused")).where(F.lit(False))
    return sums.select(by, "n", F.inline(F.array(*pairs))).select(by, "column_name", "n", "refused")


def union_dialects(
    parts: Sequence[tuple[DataFrame, Dialect]], schema: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Conform every part and stack the parts by column name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform(df, d, schema, keep) for df, d in parts]
    )


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv", exclude: Sequence[str] = ()) -> list[str]:
    """Sorted names of the files in a folder, through Hadoop's file system so that any store works."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(path)]
    return sorted(n for n in names if n.endswith(suffix) and n not in exclude)


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a text file, through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def read_dialects(
    spark: SparkSession,
    folder: str,
    choose: Mapping[str, Dialect],
    default: Dialect,
    schema: Mapping[str, str],
    exclude: Sequence[str] = (),
) -> DataFrame:
    """All CSV files of a folder as one typed table with ``file_name``.

    ``choose`` gives the dialect of particular file names, all others have the ``default``. Files that share dialect
    and header line are read together, so the number of scans is the number of layouts, not of files; files that order
    their columns differently are still bound by name.
    """
    return union_dialects(_parts(spark, folder, choose, default, exclude), schema, keep=["file_name"])


def refused_in_dialects(
    spark: SparkSession,
    folder: str,
    choose: Mapping[str, Dialect],
    default: Dialect,
    schema: Mapping[str, str],
    exclude: Sequence[str] = (),
) -> DataFrame:
    """The cells of the same files that ``read_dialects`` leaves out: file_name, column_name, cell."""
    parts = [refused_cells(raw, dialect, schema) for raw, dialect in _parts(spark, folder, choose, default, exclude)]
    return reduce(DataFrame.unionByName, parts)


def _parts(
    spark: SparkSession, folder: str, choose: Mapping[str, Dialect], default: Dialect, exclude: Sequence[str]
) -> list[tuple[DataFrame, Dialect]]:
    """One scan per dialect and header line that occur in the folder."""
    layouts: dict[tuple[str, str], tuple[Dialect, list[str]]] = {}
    for file in list_files(spark, folder, exclude=exclude):
        dialect, path = choose.get(file, default), f"{folder}/{file}"
        layouts.setdefault((dialect.name, header_line(spark, path)), (dialect, []))[1].append(path)
    if not layouts:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return [(read_text_csv(spark, paths), dialect) for dialect, paths in layouts.values()]


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}")
    return table.select(*columns) if columns else table


def write_table(df: DataFrame, folder: str, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(f"{folder}/{name}")


def swap_table(df: DataFrame, folder: str, name: str) -> None:
    """Overwrite a table with rows computed from itself: write beside it, then trade names.

    The old files are removed only after the new ones are complete.
    """
    spark = df.sparkSession
    fresh = f"{folder}/_{name}_{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    jvm = spark.sparkContext._jvm
    target, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{folder}/{name}", fresh))
    old = jvm.org.apache.hadoop.fs.Path(f"{fresh}_old")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target) and not system.rename(target, old):
        raise OSError(f"cannot move {target}")
    if not system.rename(new, target):
        raise OSError(f"cannot move {new}; the former table is at {old}")
    system.delete(old, True)
