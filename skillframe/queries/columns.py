"""Queries for column functions, lookups and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import US_TIME, parse_time, rate_per
from ..functions.nulls import ifelse3, na_sum, not_in_keep_null
from ..functions.text import first_contained, hrefs, inner_html, slugify, url_basename
from ..operators.lookup import apply_corrections, lookup_table, relabel
from . import table

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def relabel_lookup(spark, sf):
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "4-NOT SPECIFIED": "unspecified"}
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return relabel(orders, "priority", lookup_table(spark, names))


def class_lookup(spark, sf):
    classes = {"ECONOMY": "basic", "PROMO": "basic", "STANDARD": "middle", "LARGE": "bulky"}
    part = table(spark, sf, "part").select("p_partkey", "p_type", F.col("p_type").alias("p_class"))
    return relabel(part, "p_class", classes, default=None)


def conditional_override(spark, sf):
    orders = table(spark, sf, "orders")
    fixes = spark.createDataFrame(
        [("1-URGENT", "P", "2000-01-01 10:30:00")], "o_orderpriority string, o_orderstatus string, t string"
    ).select("o_orderpriority", "o_orderstatus", F.col("t").cast("timestamp_ntz").alias("at"))
    typed = orders.select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", F.col("o_orderdate").cast("timestamp_ntz").alias("at")
    )
    fixed = apply_corrections(typed, fixes, ["o_orderpriority", "o_orderstatus"], "at")
    return fixed.select("o_orderkey", F.date_format("at", TIME_TEXT).alias("order_time"))


def not_in_keep_null_(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return events.where(not_in_keep_null("kind", ["error", "signup"]))


def ifelse_three_valued(spark, sf):
    orders = table(spark, sf, "orders")
    won = F.nullif("o_orderstatus", F.lit("P")) == "F"
    high, low = F.col("o_totalprice"), F.col("o_custkey").cast("double")
    return orders.select(
        "o_orderkey", ifelse3(won, high, low).alias("one_score"), ifelse3(won, low, high).alias("two_score")
    )


def na_sum_(spark, sf):
    events = table(spark, sf, "events").withColumn("v", F.when(F.col("value") <= 150, F.col("value")))
    return events.groupBy("user_id", "event_type").agg(
        F.round(na_sum("v"), 4).alias("total"), F.count(F.lit(1)).alias("n")
    )


def datetime_parse(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("99/99/2024 1:00")).otherwise(F.date_format("ts", US_TIME))
    events = table(spark, sf, "events").select("event_id", text.alias("text"))
    return events.select("event_id", F.date_format(parse_time("text", US_TIME), TIME_TEXT).alias("parsed"))


def slugify_(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.concat_ws(" ", F.lit("Lúcio:"), "p_brand", "p_type").alias("text")
    )
    region = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("key"), F.col("r_name").alias("text"))
    return part.unionByName(region).select("key", "text", slugify("text").alias("slug"))


def year_from_text(spark, sf):
    year = F.year("o_orderdate")
    stage = F.concat(F.lit("Stage "), year.cast("string"), F.lit(" to "), (year + 1).cast("string"))
    orders = table(spark, sf, "orders").select("o_orderkey", stage.alias("stage"))
    return orders.withColumn("year", first_contained("stage", ["1998", "1997", "1996"]))


def href_extract(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(hrefs("html")).alias("href"))


def container_links(spark, sf):
    """Links of the menu, and of nothing else on the page."""
    inside = inner_html("html", "nav")
    return table(spark, sf, "pages").select("page_id", F.posexplode(hrefs(inside)).alias("place", "href"))


def container_text(spark, sf):
    """What the element of class ad holds, as written."""
    pages = table(spark, sf, "pages").select("page_id", inner_html("html", "div", "class", "ad").alias("inside"))
    return pages.select("page_id", "inside", F.length("inside").alias("n_chars"))


def url_basename_(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_basename("url", "data/").alias("file"))


def rate_per_ten(spark, sf):
    line = table(spark, sf, "lineitem")
    rate = rate_per("l_quantity", F.col("l_linenumber") - 1)
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(rate, 6).alias("per_ten"))


QUERIES = {
    "relabel_lookup": relabel_lookup,
    "class_lookup": class_lookup,
    "conditional_override": conditional_override,
    "not_in_keep_null": not_in_keep_null_,
    "ifelse_three_valued": ifelse_three_valued,
    "na_sum": na_sum_,
    "datetime_parse": datetime_parse,
    "slugify": slugify_,
    "year_from_text": year_from_text,
    "href_extract": href_extract,
    "container_links": container_links,
    "container_text": container_text,
    "url_basename": url_basename_,
    "rate_per_ten": rate_per_ten,
}

ORACLES = {
    "relabel_lookup": """
        SELECT o_orderkey, coalesce(new, o_orderpriority) AS priority
        FROM orders LEFT JOIN (VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high'), ('4-NOT SPECIFIED', 'unspecified'))
             AS t(old, new) ON o_orderpriority = old""",
    "class_lookup": """
        SELECT p_partkey, p_type,
               CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'basic' WHEN p_type = 'STANDARD' THEN 'middle'
                    WHEN p_type = 'LARGE' THEN 'bulky' END AS p_class
        FROM part""",
    "conditional_override": """
        SELECT o_orderkey,
               strftime(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
                             THEN TIMESTAMP '2000-01-01 10:30:00' ELSE o_orderdate::TIMESTAMP END,
                        '%Y-%m-%d %H:%M:%S') AS order_time
        FROM orders""",
    "not_in_keep_null": """
        SELECT event_id, kind FROM (SELECT event_id, nullif(event_type, 'view') AS kind FROM events)
        WHERE kind IS NULL OR kind NOT IN ('error', 'signup')""",
    "ifelse_three_valued": """
        SELECT o_orderkey,
               CASE WHEN s IS NULL THEN NULL WHEN s = 'F' THEN o_totalprice ELSE o_custkey::DOUBLE END AS one_score,
               CASE WHEN s IS NULL THEN NULL WHEN s = 'F' THEN o_custkey::DOUBLE ELSE o_totalprice END AS two_score
        FROM (SELECT *, nullif(o_orderstatus, 'P') AS s FROM orders)""",
    "na_sum": """
        SELECT user_id, event_type, round(CASE WHEN count(v) = count(*) THEN sum(v) END, 4) AS total,
               count(*)::BIGINT AS n
        FROM (SELECT *, CASE WHEN value <= 150 THEN value END AS v FROM events) GROUP BY user_id, event_type""",
    "datetime_parse": """
        SELECT event_id,
               strftime(try_strptime(CASE WHEN event_type = 'error' THEN '99/99/2024 1:00'
                                          ELSE strftime(ts, '%-m/%-d/%Y %-H:%M') END, '%m/%d/%Y %H:%M'),
                        '%Y-%m-%d %H:%M:%S') AS parsed
        FROM events""",
    "slugify": r"""
        SELECT key, text, lower(replace(regexp_replace(text, '[^\p{L}\p{N} ]', '', 'g'), ' ', '_')) AS slug
        FROM (SELECT p_partkey AS key, 'Lúcio: ' || p_brand || ' ' || p_type AS text FROM part
              UNION ALL SELECT r_regionkey::BIGINT, r_name FROM region)""",
    "year_from_text": """
        SELECT o_orderkey, stage,
               CASE WHEN contains(stage, '1998') THEN '1998' WHEN contains(stage, '1997') THEN '1997'
                    WHEN contains(stage, '1996') THEN '1996' END AS year
        FROM (SELECT o_orderkey, 'Stage ' || year(o_orderdate) || ' to ' || (year(o_orderdate) + 1) AS stage
              FROM orders)""",
    "href_extract": """
        SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href FROM pages""",
    "container_links": """
        SELECT page_id, (k - 1)::INT AS place, found[k] AS href
        FROM (SELECT page_id, found, unnest(range(1, len(found) + 1)) AS k
              FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
                                                       '<a [^>]*href="([^"]*)"', 1) AS found FROM pages))""",
    "container_text": """
        SELECT page_id, inside, length(inside)::INT AS n_chars
        FROM (SELECT page_id, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS inside FROM pages)""",
    "url_basename": """
        SELECT page_id, CASE WHEN regexp_extract(url, '/([^/]+)$', 1) = '' THEN ''
                             ELSE 'data/' || regexp_extract(url, '/([^/]+)$', 1) END AS file
        FROM pages""",
    "rate_per_ten": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               round(l_quantity * 600 / nullif(l_linenumber - 1, 0), 6) AS per_ten
        FROM lineitem""",
}
