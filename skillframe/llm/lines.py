"""Line dedup: lines seen on many sites are boilerplate; all but their first occurrence go.

A line is what stands between line feeds, compared without the blanks (space, tab to carriage return) around it; blank lines
are never judged and stay. Its spread is the number of distinct sites it is seen on; no site counts as one site. Spreads
are HyperLogLog sketches per line hash, merged by aggregation: what is shuffled is one sketch per line and task, however
often the line is repeated. Lines whose estimate lies near the threshold get an exact distinct count. Lines are identified
by 128 bits of hash.

The first occurrence (smallest document id, null ids last, then smallest position) stays, so no line is lost to the corpus.

Defined cases: a null text has no lines and stays null; rows with the same id and text are treated alike; an empty table gives
no rows; all further columns are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BLANKS = " \t\n\x0b\x0c\r"
#: log2 of the sketch's registers, and the relative error (5 standard errors: 5 * 1.04 / sqrt(2^10)) beyond which an estimate decides.
LG_K, MARGIN = 10, 0.17


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _line_table(docs: DataFrame, doc: str, text: str, site: str) -> DataFrame:
    lines = docs.select(
        F.col(doc).alias("doc"), F.xxhash64(text).alias("body"), F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("none")).alias("site"),
        F.posexplode(_split(F.col(text))).alias("pos", "line"))
    line = F.btrim("line", F.lit(BLANKS))
    return lines.where(line != "").select(
        "doc", "body", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Lines (h1, h2) on ``min_sites`` or more sites, with their first place."""
    place = F.min(F.struct(F.col("doc").isNull().alias("no"), "doc", "pos", "body")).alias("first")
    sketched = materialize(
        lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), place)
        .select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - MARGIN)))
    far = sketched.where(F.col("sites") > min_sites * (1 + MARGIN))
    near = sketched.where(F.col("sites") <= min_sites * (1 + MARGIN))
    exact = (lines.join(near.select("h1", "h2"), ["h1", "h2"]).select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= min_sites))
    return far.drop("sites").unionByName(near.drop("sites").join(exact.drop("count"), ["h1", "h2"]))


def dedup_lines(docs: DataFrame, min_sites: int = 10, doc: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """``docs`` with the text left, and n_lines and n_removed (lines that are not blank)."""
    lines = materialize(_line_table(docs, doc, text, site))
    spread = materialize(spread_lines(lines, min_sites))
    again = ~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("pos") == F.col("first.pos")) & (F.col("body") == F.col("first.body")))
    gone = (lines.join(spread, ["h1", "h2"]).where(again).groupBy("doc", "body")
            .agg(F.collect_set("pos").alias("_gone")))
    joined = docs.alias("d").join(
        gone.alias("g"), F.col(f"d.{doc}").eqNullSafe(F.col("g.doc")) & (F.xxhash64(f"d.{text}") == F.col("g.body")), "left")
    parts = _split(F.col(f"d.{text}"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("g._gone")), lambda i: F.get(parts, i))
    kept = F.when(F.col("g._gone").isNull(), F.col(f"d.{text}")).otherwise(F.array_join(left, "\n"))
    judged = F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    return joined.select(
        *[kept.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns],
        judged.cast("long").alias("n_lines"), F.coalesce(F.size("g._gone"), F.lit(0)).cast("long").alias("n_removed"))
