"""Append the files that are new in a folder, each exactly once: file streams that stop when they have caught up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import clean_text
from .files import Dialect, conform


@dataclass(frozen=True)
class Layout:
    """The files of one dialect with one header: a pattern of file names and the header's columns in order."""

    dialect: Dialect
    pattern: str
    header: Sequence[str]


def stream_text_csv(spark: SparkSession, folder: str, header: Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """``read_text_csv`` as a stream over the files whose name fits ``pattern``; another header raises an error.

    Files are known by their path, whatever their age: one that changes later is not read again.
    """
    schema = ", ".join(f"`{name}` string" for name in header)
    raw = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
           .option("pathGlobFilter", pattern).option("maxFileAge", "36500d").csv(folder))
    cleaned = [clean_text(F.col(f"`{c}`")).alias(c.strip()) for c in raw.columns]
    return raw.select(*cleaned, F.col("_metadata.file_name").alias("file_name"))


def append_new(stream: DataFrame, target: str, state: str) -> int:
    """Append what is new in ``stream`` to the Parquet table ``target`` and stop; the number of rows read.

    ``state`` remembers which files were taken and ``target`` lists its complete files, so a run that was broken off is
    finished by the next one without a row lost or doubled. One ``state`` belongs to one ``target``, which nothing else
    writes. Read the table with ``spark.read.parquet``, which keeps to that list.
    """
    writer = stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", target)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def append_dialects(
    spark: SparkSession, folder: str, layouts: Sequence[Layout], schema: Mapping[str, str], target: str, state: str
) -> int:
    """New files of several layouts into one typed table with ``file_name``, in one run; the number of rows read.

    The layouts are the stream's sources: ``state`` knows them by their order, so a further layout needs a new ``state`` and
    ``target``. A file that fits two patterns is read by both.
    """
    parts = [conform(stream_text_csv(spark, folder, x.header, x.pattern), x.dialect, schema, ["file_name"]) for x in layouts]
    return append_new(reduce(DataFrame.unionByName, parts), target, state)
