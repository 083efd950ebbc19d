"""Queries for joins, unions and two-sided frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import ISO_TIME, US_TIME
from ..operators.joins import equi_join, interval_join, theta_join
from ..operators.ranking import first_by
from ..operators.reshape import ordered_concat
from ..operators.sides import signed_mean, two_sided
from ..sources.files import Dialect, union_dialects
from . import table
from .columns import TIME_TEXT

CALENDAR = [("A", "2024-01-01", "2024-01-10"), ("B", "2024-01-11", "2024-01-28"), ("C", "2024-01-20", "2024-01-22")]


def sql_filter_join(spark, sf):
    line = table(spark, sf, "lineitem").where(F.col("l_returnflag") != "N")
    part = table(spark, sf, "part").where(F.col("p_type").isin("PROMO", "SMALL", "STANDARD"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = equi_join(line, part.select("p_partkey", "p_type"), {"l_partkey": "p_partkey"}, nullsafe=False)
    return equi_join(joined, suppliers, {"l_suppkey": "s_suppkey"}, nullsafe=False).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "p_type", "s_nationkey"
    )


def _calendar(spark):
    return spark.createDataFrame(CALENDAR, "patch string, a string, b string").select(
        "patch", F.col("a").cast("date").alias("start_date"), F.col("b").cast("date").alias("end_date")
    )


def _patched(df):
    return df.select("event_id", "patch", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"))


def interval_left_join(spark, sf):
    conditions = [("at", ">=", "start_date"), ("at", "<=", "end_date")]
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("at"))
    return _patched(theta_join(events, _calendar(spark), conditions))


def range_left_join(spark, sf):
    """Lines by the price spans of all parts, two long sides; lines in no span are counted under no part.

    Lines of one price meet the same spans and parts of one price have the same span, so each price and span is met once.
    """
    lines = table(spark, sf, "lineitem").groupBy("l_extendedprice").agg(F.count("*").alias("lines"))
    low = F.col("p_retailprice") * 20
    spans = table(spark, sf, "part").select("p_partkey", low.alias("low"), (low + 25).alias("high"))
    met = theta_join(lines, spans.select("low", "high").distinct(), [("l_extendedprice", ">=", "low"), ("l_extendedprice", "<", "high")])
    found = met.groupBy("low", "high").agg(
        F.sum("lines").alias("n"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"))
    return equi_join(found, spans, ["low", "high"], "left", nullsafe=False).groupBy("p_partkey").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def interval_left_join_day(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("at"))
    return _patched(interval_join(events, _calendar(spark), "at", "start_date", "end_date", "whole_day", "by_day"))


def multi_dialect_union(spark, sf):
    events = table(spark, sf, "events")
    long = events.select(
        F.col("value").cast("string").alias("amount"),
        F.col("event_id").cast("string").alias("esports_event_id"),
        F.date_format("ts", US_TIME).alias("start_time"),
        F.col("event_type").alias("stat_name"),
        F.lit("long").alias("origin"),
    )
    short = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", TIME_TEXT).alias("pelstart_time"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.lit("short").alias("origin"),
    )
    schema = {"event_id": "string", "start_time": "timestamp_ntz", "stat_name": "string", "value": "double"}
    both = union_dialects(
        [
            (long, Dialect("long", {"amount": "value", "esports_event_id": "event_id"}, US_TIME)),
            (short, Dialect("short", {"pelstart_time": "start_time"}, ISO_TIME)),
        ],
        schema,
        keep=["origin"],
    )
    return both.withColumn("start_time", F.date_format("start_time", TIME_TEXT))


def _orders_with_sides(spark, sf):
    """Each order as a result: its first supplier's nation against its customer's nation."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("nation"))
    first = line.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("l_suppkey"))
    first = equi_join(first, suppliers, {"l_suppkey": "s_suppkey"}, nullsafe=False)
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("second"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    named = equi_join(orders, customers, {"o_custkey": "c_custkey"}, nullsafe=False)
    named = equi_join(named, first.select("l_orderkey", "nation"), {"o_orderkey": "l_orderkey"}, nullsafe=False)
    winner = (
        F.when(F.col("o_orderstatus") == "F", F.col("nation"))
        .when(F.col("o_orderstatus") == "O", F.col("second"))
        .otherwise(F.lit("draw"))
    )
    return named.select("o_orderkey", F.col("nation").alias("first"), "second", winner.alias("winner"))


def two_sided_union(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("team"))
    stats = (
        equi_join(line, suppliers, {"l_suppkey": "s_suppkey"}, nullsafe=False)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), "team")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    results = _orders_with_sides(spark, sf)
    return two_sided(results, stats, "o_orderkey", "first", "second", "winner", "team", drop_draws=True).select(
        "o_orderkey", "player_team", "opponent_team", "first_attacker_flg", "win", "quantity"
    )


def self_join_opponent(spark, sf):
    side = F.when(F.col("l_returnflag") == "A", F.lit("home")).otherwise(F.lit("away"))
    other = F.when(F.col("l_returnflag") == "A", F.lit("away")).otherwise(F.lit("home"))
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", side.alias("player_team"), other.alias("opponent_team"), "l_suppkey"
    )
    keys = ["l_orderkey", "player_team", "opponent_team"]
    members = line.distinct()
    lineups = ordered_concat(members, keys, "l_suppkey", ["l_suppkey"], ";", "lineup")
    opponents = lineups.select("l_orderkey", "player_team", "lineup")
    on = {"l_orderkey": "l_orderkey", "opponent_team": "player_team"}
    return equi_join(lineups, opponents, on, suffix="_opponent")


def first_by_order(spark, sf):
    line = table(spark, sf, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "flag"]
    return first_by(line, ["l_orderkey"], order, ["l_suppkey", "flag", "l_quantity"])


def ranef_signed_mean(spark, sf):
    line = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    effects = signed_mean(line, ["l_suppkey"], "l_returnflag", "A", "l_quantity", "effect")
    counts = line.groupBy(F.col("l_suppkey").alias("lineup"), "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    joined = equi_join(counts, effects, {"lineup": "l_suppkey"})
    return joined.select("lineup", "l_linestatus", "n", F.round("effect", 6).alias("effect"))


QUERIES = {
    "sql_filter_join": sql_filter_join,
    "interval_left_join": interval_left_join,
    "interval_left_join_day": interval_left_join_day,
    "range_left_join": range_left_join,
    "multi_dialect_union": multi_dialect_union,
    "two_sided_union": two_sided_union,
    "self_join_opponent": self_join_opponent,
    "first_by_order": first_by_order,
    "ranef_signed_mean": ranef_signed_mean,
}

_CALENDAR_SQL = ", ".join(f"('{p}', DATE '{a}', DATE '{b}')" for p, a, b in CALENDAR)

ORACLES = {
    "sql_filter_join": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, p_type, s_nationkey
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        WHERE p_type IN ('PROMO', 'SMALL', 'STANDARD') AND NOT l_returnflag = 'N'""",
    "interval_left_join": f"""
        SELECT event_id, patch, strftime(a, '%Y-%m-%d') AS start_date
        FROM events LEFT JOIN (VALUES {_CALENDAR_SQL}) AS t(patch, a, b)
             ON ts >= a::TIMESTAMP AND ts <= b::TIMESTAMP""",
    "range_left_join": """
        SELECT p_partkey, count(*) AS n, min(l_extendedprice) AS least, max(l_extendedprice) AS most
        FROM lineitem LEFT JOIN part ON l_extendedprice >= p_retailprice * 20 AND l_extendedprice < p_retailprice * 20 + 25
        GROUP BY p_partkey""",
    "interval_left_join_day": f"""
        SELECT event_id, patch, strftime(a, '%Y-%m-%d') AS start_date
        FROM events LEFT JOIN (VALUES {_CALENDAR_SQL}) AS t(patch, a, b)
             ON ts >= a::TIMESTAMP AND ts < b::TIMESTAMP + INTERVAL 1 DAY""",
    "multi_dialect_union": """
        SELECT event_id::VARCHAR AS event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS start_time,
               event_type AS stat_name, value, 'long' AS origin
        FROM events
        UNION ALL BY NAME
        SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_time,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, 'short' AS origin
        FROM events""",
    "two_sided_union": """
        WITH f AS (SELECT l_orderkey, s_nationkey::VARCHAR AS nation
                   FROM (SELECT l_orderkey, min(l_suppkey) AS k FROM lineitem GROUP BY 1) JOIN supplier ON k = s_suppkey),
             r AS (SELECT o_orderkey, nation AS first, c_nationkey::VARCHAR AS second,
                          CASE o_orderstatus WHEN 'F' THEN nation WHEN 'O' THEN c_nationkey::VARCHAR ELSE 'draw' END AS winner
                   FROM orders JOIN customer ON o_custkey = c_custkey JOIN f ON o_orderkey = l_orderkey),
             s AS (SELECT l_orderkey, s_nationkey::VARCHAR AS team, sum(l_quantity) AS quantity
                   FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
        SELECT o_orderkey, first AS player_team, second AS opponent_team, 1.0::DOUBLE AS first_attacker_flg,
               (first = winner)::INT::DOUBLE AS win, quantity
        FROM r LEFT JOIN s ON o_orderkey = l_orderkey AND first = team WHERE winner <> 'draw'
        UNION ALL
        SELECT o_orderkey, second, first, -1.0::DOUBLE, (second = winner)::INT::DOUBLE, quantity
        FROM r LEFT JOIN s ON o_orderkey = l_orderkey AND second = team WHERE winner <> 'draw'""",
    "self_join_opponent": """
        WITH m AS (SELECT DISTINCT l_orderkey, CASE WHEN l_returnflag = 'A' THEN 'home' ELSE 'away' END AS player_team,
                          CASE WHEN l_returnflag = 'A' THEN 'away' ELSE 'home' END AS opponent_team, l_suppkey
                   FROM lineitem),
             l AS (SELECT l_orderkey, player_team, opponent_team,
                          string_agg(l_suppkey::VARCHAR, ';' ORDER BY l_suppkey) AS lineup
                   FROM m GROUP BY ALL)
        SELECT a.l_orderkey, a.player_team, a.opponent_team, a.lineup, b.lineup AS lineup_opponent
        FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.opponent_team = b.player_team""",
    "first_by_order": """
        SELECT l_orderkey, l_suppkey, flag, l_quantity
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey,
                                           l_quantity, l_extendedprice, flag NULLS LAST) AS rn
              FROM (SELECT *, nullif(l_returnflag, 'N') AS flag FROM lineitem))
        WHERE rn = 1""",
    "ranef_signed_mean": """
        SELECT lineup, l_linestatus, n, round(effect, 6) AS effect
        FROM (SELECT l_suppkey AS lineup, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL)
        JOIN (SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE -l_quantity END) AS effect
              FROM lineitem GROUP BY 1) ON lineup = l_suppkey""",
}
