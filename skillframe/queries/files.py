"""Queries for text files: new files appended once, cells that cannot be read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import ISO_TIME
from ..operators.joins import equi_join
from ..session import fresh_path, materialize
from ..sources.files import Dialect, conform_observed, refusals, refused_cells
from ..sources.incremental import Layout, append_dialects
from . import table

SCHEMA = {"event_id": "double", "at": "timestamp_ntz", "kind": "string", "amount": "double"}
SHORT = Dialect("short", {"time": "at", "event": "event_id"}, "M/d/yyyy HH:mm")
LONG = Dialect("long")


def append_new_files(spark, sf):
    """Events come as three drops of CSV files in two layouts; each run appends what is new, the last finds nothing.

    ``last_run`` is the number of rows that the run without new files has read.
    """
    folder, target, state = fresh_path(spark), fresh_path(spark), fresh_path(spark)
    events = table(spark, sf, "events").withColumn("drop", F.expr("int(pmod(event_id, 3))"))
    layouts = [Layout(SHORT, "short-*.csv", ["event", "time", "kind", "amount"]),
               Layout(LONG, "part-*.csv", ["at", "kind", "amount", "event_id"])]
    amount = F.col("value").cast("string").alias("amount")
    for drop in range(3):
        rows = events.where(F.col("drop") == drop)
        if drop == 1:
            rows = rows.select(F.col("event_id").alias("event"), F.date_format("ts", SHORT.time_format).alias("time"),
                               F.col("event_type").alias("kind"), amount)
        else:
            rows = rows.select(F.date_format("ts", ISO_TIME).alias("at"), F.col("event_type").alias("kind"), amount, "event_id")
        _drop_files(rows, folder, "short-" if drop == 1 else "part-")
        append_dialects(spark, folder, layouts, SCHEMA, target, state)
    last = append_dialects(spark, folder, layouts, SCHEMA, target, state)
    return spark.read.parquet(target).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("events"), F.round(F.sum("amount"), 2).alias("amount"),
        F.count("at").alias("times")).withColumn("last_run", F.lit(last).cast("long"))


def _drop_files(rows, folder, prefix):
    """Write CSV files beside those in ``folder``; whole files appear under their names at once."""
    spark, beside = rows.sparkSession, fresh_path(rows.sparkSession)
    rows.write.option("header", True).csv(beside)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for file in system.listStatus(path(beside)):
        name = file.getPath().getName()
        if name.endswith(".csv"):
            system.rename(file.getPath(), path(f"{folder}/{name if prefix == 'part-' else prefix + name}"))


def unreadable_cells(spark, sf):
    """Events as text, a file per type: errors have a unit behind the amount, every seventh user's clock another format.

    Per file and column the rows, the refused cells as counted and as listed; file ``(all)`` is what writing the typed
    table has observed.
    """
    late = F.col("user_id") % 7 == 0
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("file_name"), F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("kind"),
        F.when(late, F.date_format("ts", SHORT.time_format)).otherwise(F.date_format("ts", ISO_TIME)).alias("at"),
        F.concat(F.col("value").cast("string"), F.when(F.col("event_type") == "error", " pts").otherwise("")).alias("amount"))
    typed, seen = conform_observed(log, LONG, SCHEMA, ["file_name"])
    materialize(typed)
    found = dict(seen.get)
    observed = spark.createDataFrame(
        [("(all)", c, found["rows"], found[c], found[c]) for c in found if c != "rows"],
        "file_name string, column_name string, n long, refused long, listed long")
    listed = refused_cells(log, LONG, SCHEMA).groupBy("file_name", "column_name").agg(F.count("cell").alias("listed"))
    counted = equi_join(refusals(log, LONG, SCHEMA), listed, ["file_name", "column_name"], "left").na.fill(0, ["listed"])
    return counted.unionByName(observed)


QUERIES = {"append_new_files": append_new_files, "unreadable_cells": unreadable_cells}

_CELLS = """SELECT event_type AS file_name, 0::BIGINT AS event_id, (user_id % 7 = 0 AND ts IS NOT NULL)::BIGINT AS "at",
                   (event_type = 'error' AND value IS NOT NULL)::BIGINT AS amount FROM events"""
_LONG = """SELECT file_name, column_name, count(*) AS n, sum(bad)::BIGINT AS refused FROM (
             SELECT file_name, 'event_id' AS column_name, event_id AS bad FROM cells
             UNION ALL SELECT file_name, 'at', "at" FROM cells UNION ALL SELECT file_name, 'amount', amount FROM cells) GROUP BY ALL"""

ORACLES = {
    "append_new_files": """
        SELECT event_type AS kind, count(*) AS n, count(DISTINCT event_id) AS events, round(sum(value), 2) AS amount,
               count(ts) AS times, 0::BIGINT AS last_run FROM events GROUP BY event_type""",
    "unreadable_cells": f"""WITH cells AS ({_CELLS}), files AS ({_LONG})
        SELECT *, refused AS listed FROM files
        UNION ALL SELECT '(all)', column_name, sum(n)::BIGINT, sum(refused)::BIGINT, sum(refused)::BIGINT FROM files GROUP BY column_name""",
}
