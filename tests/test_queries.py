"""Every query against its SQL, hot groups, and the plans the operators should have."""

import pytest
from oracle import check, expected, rows_of
from pyspark.sql import functions as F

from skillframe.operators.ranking import dense_rank_id, first_by, zscore
from skillframe.operators.reshape import pivot_wide
from skillframe.queries import all_oracles, all_queries

SF = "/root/testdata/sf0.01"
ORACLES = all_oracles()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_sql(spark, name):
    line = check(spark, name, all_queries()[name], ORACLES[name], SF)
    assert line.startswith("ok"), line


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(all_queries())


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Events of which every third belongs to one user, far more than any other has."""
    path = str(tmp_path_factory.mktemp("hot") / "events.parquet")
    events = spark.read.parquet(f"{SF}/events.parquet")
    user = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    events.withColumn("user_id", user).repartition(8).write.parquet(path)
    return path


def duck(path, sql):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
    rows = con.execute(sql).fetchall()
    return sorted(rows)


def test_rank_of_a_hot_match(spark, hot):
    df = spark.read.parquet(hot).select("event_id", F.col("user_id").cast("string").alias("m"), F.date_trunc("minute", "ts").alias("t"))
    got = sorted((r["event_id"], r["id"]) for r in dense_rank_id(df, ["m"], "t", "id", "m").collect())
    want = duck(hot, """SELECT event_id, user_id || '_' || dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('minute', ts))
                        FROM events""")
    assert got == want


def test_first_of_a_hot_group_is_cut_before_the_shuffle(spark, hot):
    df = first_by(spark.read.parquet(hot), ["user_id"], ["value", "event_id"], ["event_id"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == duck(hot, """SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY value, event_id) AS k FROM events) WHERE k = 1""")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in text


def test_group_statistics_need_no_window(spark, hot):
    df = zscore(spark.read.parquet(hot).select("event_id", "user_id", "value"), ["user_id"], "value", "z")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "BroadcastHashJoin" in text
    got = sorted((r["event_id"], round(r["z"], 6)) for r in df.collect())
    assert got == duck(hot, """SELECT event_id, round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6)
                               FROM events WINDOW w AS (PARTITION BY user_id)""")


def test_pivot_is_one_aggregation(spark, hot):
    wide = pivot_wide(spark.read.parquet(hot), ["user_id"], "event_type", ["view", "click"], ["value"])
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_sum" in text


@pytest.mark.parametrize("name", ["top1_per_group", "rule_classifier", "two_sided_union", "pivot_multi_value", "results_by_match"])
def test_relational_queries_stay_in_the_jvm(spark, name):
    df = all_queries()[name](spark, SF)
    text = df._jdf.queryExecution().toString()
    assert "Python" not in text and "CartesianProduct" not in text


def test_scans_read_only_what_they_need(spark):
    text = all_queries()["sql_filter_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in text and "PushedFilters: [IsNotNull(l_returnflag)" in text


def test_comparison_notices_a_difference(spark):
    names, rows = expected("SELECT r_regionkey, r_name FROM region", SF)
    regions = spark.read.parquet(f"{SF}/region.parquet").select("r_regionkey", "r_name")
    assert rows_of(regions) == rows
    assert rows_of(regions.where("r_regionkey > 0")) != rows
