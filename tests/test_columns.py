import datetime as dt

import pytest
from pyspark.sql import functions as F

from skillframe.functions.dates import US_TIME, parse_date, parse_time, rate_per
from skillframe.functions.nulls import clean_text, fill_missing, ifelse3, na_sum, not_in_keep_null, paste
from skillframe.functions.text import first_contained, hrefs, slugify, url_basename
from skillframe.operators.lookup import apply_corrections, classify, lookup_table, relabel
from skillframe.plans.fixed import EXHIBITIONS, HEROES, STAGES, hero_roles, subrole_rules


def values(df, col):
    return [r[col] for r in df.orderBy("i").collect()]


def frame(spark, items, kind="string"):
    return spark.createDataFrame(list(enumerate(items)), f"i int, x {kind}")


def test_exclusion_keeps_null(spark):
    df = frame(spark, ["OWL APAC All-Stars", None, "2019 Playoffs"])
    assert values(df.where(not_in_keep_null("x", EXHIBITIONS)), "x") == [None, "2019 Playoffs"]


def test_na_sum(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0), ("b", 2.0)], "k string, v double")
    assert dict(df.groupBy("k").agg(na_sum("v")).collect()) == {"a": None, "b": 3.0}


def test_three_valued_choice(spark):
    df = frame(spark, [True, False, None], "boolean")
    assert values(df.withColumn("y", ifelse3(F.col("x"), F.lit(1), F.lit(2))), "y") == [1, 2, None]


def test_paste_prints_missing(spark):
    df = frame(spark, ["m", None]).withColumn("y", paste("x", "i", sep="_"))
    assert values(df, "y") == ["m_0", "NA_1"]


def test_fill_reaches_text(spark):
    df = spark.createDataFrame([(None, None, 1)], "a string, b double, c int")
    assert fill_missing(df).first() == ("0", 0.0, 1)
    assert fill_missing(df, text=None).first() == (None, 0.0, 1)


def test_clean_text(spark):
    assert values(frame(spark, [" a ", "", " ", "NA", " NA ", None]).withColumn("y", clean_text("x")), "y") == [
        "a", None, None, None, None, None,
    ]


@pytest.mark.parametrize(
    "text, slug",
    [("Hero Damage Done", "hero_damage_done"), ("Soldier: 76", "soldier_76"), ("D.Va", "dva"), ("Lúcio", "lúcio"), (None, None)],
)
def test_slugify(spark, text, slug):
    assert values(frame(spark, [text]).withColumn("y", slugify("x")), "y") == [slug]


def test_slugify_options(spark):
    df = frame(spark, ["A.b C"]).withColumn("y", slugify("x", "-", ".", lower=False))
    assert values(df, "y") == ["A-b.C"]


def test_first_contained_follows_the_list(spark):
    df = frame(spark, ["2019 after 2018", "2020 x", "1999", None]).withColumn("y", first_contained("x", ["2018", "2019", "2020"]))
    assert values(df, "y") == ["2018", "2020", None, None]


def test_links(spark):
    html = '<a href="/z">no</a><div class="d"><a class="b" href="/x/a.zip">1</a><a>2</a><a href="/y/b.zip">3</a></div>'
    df = frame(spark, [html])
    assert values(df.withColumn("y", hrefs("x")), "y") == [["/z", "/x/a.zip", "/y/b.zip"]]
    assert values(df.withColumn("y", hrefs("x", '(?s)<div class="d">(.*?)</div>')), "y") == [["/x/a.zip", "/y/b.zip"]]
    urls = frame(spark, ["http://h/x/a.zip", "nothing", "http://h/x/", None]).withColumn("y", url_basename("x"))
    assert values(urls, "y") == ["data/a.zip", "", "", None]


def test_times(spark):
    df = frame(spark, ["3/4/2020 9:05", "03/04/2020 09:05", "junk", None]).withColumn("y", parse_time("x", US_TIME))
    assert values(df, "y") == [dt.datetime(2020, 3, 4, 9, 5)] * 2 + [None, None]
    assert values(frame(spark, ["2/15/2018", "x"]).withColumn("y", parse_date("x")), "y") == [dt.date(2018, 2, 15), None]


def test_rate(spark):
    df = spark.createDataFrame([(5.0, 300.0), (5.0, 0.0)], "a double, t double")
    assert [r[0] for r in df.select(rate_per("a", "t")).collect()] == [10.0, None]


def test_relabel(spark):
    df = frame(spark, ["Overwatch League - Stage 1", "Overwatch League Stage 1", "X", None])
    want = ["2018 Stage 1 Regular Season", "2019 Stage 1 Regular Season", "X", None]
    assert values(relabel(df, "x", STAGES), "x") == want
    assert values(relabel(df, "x", lookup_table(spark, STAGES)), "x") == want
    assert values(relabel(df, "x", {"X": "known"}, default=None), "x") == [None, None, "known", None]
    assert len(STAGES) == 18 and HEROES["Lúcio"] == "Lucio"


def test_corrections_touch_only_their_row(spark):
    df = spark.createDataFrame([("21352", "1", "a"), ("21352", "2", "b"), (None, "1", "c")], "m string, r string, t string")
    fix = spark.createDataFrame([("21352", "1", "z")], "m string, r string, t string")
    assert sorted(r["t"] for r in apply_corrections(df, fix, ["m", "r"], "t").collect()) == ["b", "c", "z"]


@pytest.mark.parametrize(
    "hero, heroes, subrole",
    [
        ("Lucio", "Lucio, Mercy, Pharah", "main_support"),
        ("Lucio", "Lucio, Mercy, Tracer", "off_support"),
        ("Lucio", "Lucio, Moira", "off_support"),
        ("Moira", "Lucio, Moira", "main_support"),
        ("Mercy", "Lucio, Mercy, Pharah", "off_support"),
        ("Mercy", "Lucio, Mercy, Pharah, Zenyatta", "main_support"),
        ("Mercy", "Mercy, Ana", "main_support"),
        ("Ana", "Ana, Zenyatta", "main_support"),
        ("Ana", "Ana, Baptiste", "off_support"),
        ("Baptiste", "Ana, Baptiste", "main_support"),
        ("Brigitte", "Ana, Brigitte", "off_support"),
        ("Zenyatta", "Zenyatta", "off_support"),
        ("Sigma", "Sigma, D.Va", "main_tank"),
        ("Sigma", "Sigma, Orisa", "off_tank"),
        ("D.Va", "D.Va, Sigma", "off_tank"),
        ("D.Va", "D.Va, Roadhog", "main_tank"),
        ("Wrecking Ball", "Wrecking Ball, Winston", "off_tank"),
        ("Zarya", "Wrecking Ball, Zarya", "off_tank"),
        ("Roadhog", "Roadhog", "off_tank"),
        ("Torbjorn", "Torbjorn", "DPS"),
        ("Somebody", "Somebody", None),
        (None, "Ana", None),
    ],
)
def test_subroles(spark, hero, heroes, subrole):
    df = spark.createDataFrame([(hero, heroes)], "hero string, heroes string")
    assert classify(df, subrole_rules(), "hero", "heroes", "s").first()["s"] == subrole


def test_compat_misses_the_long_spelling(spark):
    df = spark.createDataFrame([("Torbjorn", "Torbjorn")], "hero string, heroes string")
    assert classify(df, subrole_rules(compat=True), "hero", "heroes", "s").first()["s"] is None
    assert "Torbjorn" not in hero_roles(compat=True) and hero_roles()["Torbjorn"] == "damage"
