"""Queries for the fitted models. Where a model has a closed form, SQL computes it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.design import Term
from ..models.glm import coef_band as band
from ..models.glm import fit_logit, fit_logit_by, score_link as link, score_map_advantage
from ..models.grouped import fit_logit_groups
from ..models.mixed import fit_crossed_logit
from ..models.ridge import ridge_cv as cross_validate
from ..models.ridge import ridge_fit as solve
from ..models.wide import fit_logit_wide
from ..operators.joins import equi_join
from ..session import materialize
from . import table

RIDGE_LAMBDA = 0.1
FOLDS = 10


def labelled(spark, sf):
    """Labelled documents with a constant, a log size and a two-valued size class."""
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf, "labels")
    joined = equi_join(labels, documents, ["doc_id"], nullsafe=False)
    return joined.select(
        "doc_id", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"),
        "lang", "source", F.log(F.col("n_chars").cast("double")).alias("log_size"),
        F.when(F.col("n_chars") >= 1000, "long").otherwise("short").alias("size"), F.lit(1.0).alias("one"),
        F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("tone"),
    )


def glm_saturated(spark, sf):
    coefs = fit_logit(labelled(spark, sf), "quality", [Term("one", "lang")], collapse=True).coef_df(spark)
    return coefs.select("term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error"))


def glm_by_group(spark, sf):
    coefs = fit_logit_by(labelled(spark, sf), "quality", [Term("one", "size")], "tone", collapse=True)
    return coefs.select(
        "tone", "term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error"),
        F.round("statistic", 4).alias("statistic"),
    )


def coef_band(spark, sf):
    coefs = fit_logit_by(labelled(spark, sf), "quality", [Term("one")], "lang", collapse=True)
    return band(coefs, "one").select("lang", *[F.round(c, 4).alias(c) for c in ("estimate", "lower", "upper")])


SCORE_TERMS = [Term("one", "size"), Term("toxic", "size")]


def score_link(spark, sf):
    frame = labelled(spark, sf)
    fit = fit_logit(frame, "quality", SCORE_TERMS, collapse=True)
    scored = link(link(frame, fit, SCORE_TERMS, "score"), fit, SCORE_TERMS, "score_clean", {"toxic": 0.0})
    return scored.select("doc_id", F.round("score", 4).alias("score"), F.round("score_clean", 4).alias("score_clean"))


def score_map_adv(spark, sf):
    frame = labelled(spark, sf)
    fit = fit_logit(frame, "quality", SCORE_TERMS, collapse=True)
    scored = score_map_advantage(frame, fit, SCORE_TERMS, ["toxic"], F.col("size") == "short", "advantage")
    return scored.select("doc_id", "size", F.round("advantage", 4).alias("advantage"))


def glm_logit(spark, sf):
    terms = [Term("lang", "one"), Term("log_size", "lang"), Term("toxic", "lang")]
    fit = fit_logit(labelled(spark, sf), "quality", terms)
    return fit.coef_df(spark).withColumn("converged", F.lit(fit.converged))


def mixed_intercepts(spark, sf):
    fit = fit_crossed_logit(labelled(spark, sf), "quality", Term("one"), ("source", "lang"))
    return fit.effects


def returns(spark, sf, *more):
    """Lines with whether they were returned, their share of the largest quantity, and a two-valued size class."""
    return table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", *more, F.expr("int(l_returnflag = 'R')").alias("returned"), F.lit(1.0).alias("one"),
        (F.col("l_quantity") / 50).alias("share"), F.when(F.col("l_quantity") > 25, "large").otherwise("small").alias("size"),
    )


def glm_groups(spark, sf):
    """A fit per part. Cells of one outcome only have no finite estimate; they are left out before the fit."""
    rows = returns(spark, sf)
    both = rows.groupBy("l_partkey", "size").agg(F.min("returned").alias("low"), F.max("returned").alias("high")).where("low < high")
    usable = equi_join(rows, both.drop("low", "high"), ["l_partkey", "size"], nullsafe=False)
    coefs = fit_logit_groups(usable, "returned", [Term("one", "size")], "l_partkey", collapse=True)
    return coefs.select("l_partkey", "term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error"), "converged")


def glm_groups_balance(spark, sf):
    """A fit per supplier: the sums of residuals times each column, which are 0 at the maximum."""
    rows, terms = returns(spark, sf), [Term("one"), Term("share")]
    coefs = fit_logit_groups(rows, "returned", terms, "l_suppkey").groupBy("l_suppkey").agg(
        F.expr("max(estimate) FILTER (WHERE term = 'one') AS b0"), F.expr("max(estimate) FILTER (WHERE term = 'share') AS b1"))
    rest = "returned - 1 / (1 + exp(-(b0 + b1 * share)))"
    sums = equi_join(rows, coefs, ["l_suppkey"], nullsafe=False).groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.expr(f"round(sum({rest}), 3) + 0D AS score_one"), F.expr(f"round(sum(share * ({rest})), 3) + 0D AS score_share"))
    return sums


def glm_wide_balance(spark, sf):
    """A fit with an intercept per order, of orders with both outcomes: per term the number of rows, whether it has an
    estimate, and the sum of residuals times its column, which is 0 at the maximum. Orders and size classes add up to the
    same, so the last class has none."""
    rows = returns(spark, sf, "l_orderkey").select("l_orderkey", "returned", "one", "share", "size")
    both = rows.groupBy("l_orderkey").agg(F.min("returned").alias("low"), F.max("returned").alias("high")).where("low < high")
    usable = equi_join(rows, both.drop("low", "high"), ["l_orderkey"], nullsafe=False)
    usable = materialize(usable.withColumn("l_orderkey", F.concat(F.lit("o"), "l_orderkey")))
    terms = [Term("one", "l_orderkey"), Term("share"), Term("one", "size")]
    coefs = materialize(fit_logit_wide(usable, "returned", terms, "l_orderkey"))
    own = coefs.where("term LIKE 'one:l_orderkey%'").select(F.expr("substr(term, 15)").alias("l_orderkey"), F.col("estimate").alias("b"))
    found = {r["term"]: r["estimate"] for r in coefs.where("term NOT LIKE 'one:l_orderkey%'").collect()}  # three terms
    share, large, small = (found.get(t) or 0.0 for t in ("share", "one:sizelarge", "one:sizesmall"))
    eta = f"b + {share!r}D * share + CASE size WHEN 'large' THEN {large!r}D ELSE {small!r}D END"
    gaps = equi_join(usable, own, ["l_orderkey"]).withColumn("gap", F.expr(f"returned - 1 / (1 + exp(-({eta})))"))
    gaps = materialize(gaps.select("l_orderkey", "share", "size", "b", "gap"))
    parts = [("share", "share", "1 = 1"), ("one:sizelarge", "1", "size = 'large'"), ("one:sizesmall", "1", "size = 'small'")]
    narrow = [gaps.where(cells).agg(F.count("*").alias("n"), F.expr(f"round(sum({x} * gap), 2) + 0D AS score")).select(
        F.lit(term).alias("term"), "n", F.lit(found.get(term) is not None).alias("known"), "score") for term, x, cells in parts]
    each = gaps.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.first("b").isNotNull().alias("known"), F.expr("round(sum(gap), 3) + 0D AS score"))
    each = each.select(F.concat(F.lit("one:l_orderkey"), "l_orderkey").alias("term"), "n", "known", "score")
    return reduce(DataFrame.unionByName, [each, *narrow])


def one_hot_members(spark, sf):
    """Each supplier as a group with one member, its nation; value is the mean quantity, weight the line count."""
    line = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.avg("l_quantity").alias("y"), F.count(F.lit(1)).cast("double").alias("w")
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("n"), "s_nationkey").alias("member"))
    groups = equi_join(line, suppliers, {"l_suppkey": "s_suppkey"}, nullsafe=False)
    return groups.select("l_suppkey", "member"), groups.select("l_suppkey", "y", "w")


def ridge_fit(spark, sf):
    members, targets = one_hot_members(spark, sf)
    found = solve(members, targets, RIDGE_LAMBDA)
    return found.select("member", F.round("estimate", 5).alias("estimate"))


def ridge_cv(spark, sf):
    members, targets = one_hot_members(spark, sf)
    curve = cross_validate(members, targets, folds=FOLDS, fold=F.pmod(F.col("id"), F.lit(FOLDS)))
    return curve.select(F.round("lambda", 6).alias("penalty"), F.round("cv_error", 5).alias("cv_error"), "is_min")


QUERIES = {
    "glm_saturated": glm_saturated,
    "glm_by_group": glm_by_group,
    "glm_groups": glm_groups,
    "glm_groups_balance": glm_groups_balance,
    "glm_wide_balance": glm_wide_balance,
    "coef_band": coef_band,
    "score_link": score_link,
    "score_map_adv": score_map_adv,
    "glm_logit": glm_logit,
    "mixed_intercepts": mixed_intercepts,
    "ridge_fit": ridge_fit,
    "ridge_cv": ridge_cv,
}

_LABELLED = """
    labelled AS (SELECT doc_id, quality, toxic, lang, CASE WHEN n_chars >= 1000 THEN 'long' ELSE 'short' END AS size,
                        CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS tone
                 FROM labels JOIN documents USING (doc_id))"""


def _cells(keys: str) -> str:
    return f"(SELECT {keys}, count(*) AS n, avg(quality) AS p FROM labelled GROUP BY ALL)"


_GROUPS = """
    groups AS (SELECT l_suppkey, 'n' || s_nationkey AS member, y, w
               FROM (SELECT l_suppkey, avg(l_quantity) AS y, count(*)::DOUBLE AS w FROM lineitem GROUP BY 1)
               JOIN supplier ON l_suppkey = s_suppkey)"""

ORACLES = {
    "glm_saturated": f"""WITH {_LABELLED}
        SELECT 'one:lang' || lang AS term, round(ln(p / (1 - p)), 4) AS estimate,
               round(1 / sqrt(n * p * (1 - p)), 4) AS std_error
        FROM {_cells('lang')}""",
    "glm_by_group": f"""WITH {_LABELLED}
        SELECT tone, 'one:size' || size AS term, round(ln(p / (1 - p)), 4) AS estimate,
               round(1 / sqrt(n * p * (1 - p)), 4) AS std_error,
               round(ln(p / (1 - p)) * sqrt(n * p * (1 - p)), 4) AS statistic
        FROM {_cells('tone, size')}""",
    "glm_groups": """
        SELECT l_partkey, 'one:size' || size AS term, round(ln(p / (1 - p)), 4) AS estimate,
               round(1 / sqrt(n * p * (1 - p)), 4) AS std_error, true AS converged
        FROM (SELECT l_partkey, CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS size, count(*) AS n,
                     avg((l_returnflag = 'R')::INT) AS p
              FROM lineitem GROUP BY ALL) WHERE p > 0 AND p < 1""",
    "glm_groups_balance": """
        SELECT l_suppkey, count(*) AS n, 0::DOUBLE AS score_one, 0::DOUBLE AS score_share FROM lineitem GROUP BY l_suppkey""",
    "glm_wide_balance": """
        WITH both_ways AS (SELECT *, count(*) OVER w AS n, avg((l_returnflag = 'R')::INT) OVER w AS p FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)),
             usable AS (SELECT * FROM both_ways WHERE p > 0 AND p < 1)
        SELECT 'one:l_orderkeyo' || l_orderkey AS term, n, true AS known, 0::DOUBLE AS score FROM usable GROUP BY l_orderkey, n
        UNION ALL SELECT 'share', count(*), true, 0 FROM usable
        UNION ALL SELECT 'one:sizelarge', count(*), true, 0 FROM usable WHERE l_quantity > 25
        UNION ALL SELECT 'one:sizesmall', count(*), false, 0 FROM usable WHERE NOT l_quantity > 25""",
    "coef_band": f"""WITH {_LABELLED}
        SELECT lang, round(ln(p / (1 - p)), 4) AS estimate,
               round(ln(p / (1 - p)) - 1 / sqrt(n * p * (1 - p)), 4) AS lower,
               round(ln(p / (1 - p)) + 1 / sqrt(n * p * (1 - p)), 4) AS upper
        FROM {_cells('lang')}""",
    "score_link": f"""WITH {_LABELLED}, cells AS {_cells('size, toxic')}
        SELECT doc_id, round(ln(a.p / (1 - a.p)), 4) AS score, round(ln(b.p / (1 - b.p)), 4) AS score_clean
        FROM labelled l JOIN cells a ON l.size = a.size AND l.toxic = a.toxic
             JOIN cells b ON l.size = b.size AND b.toxic = 0""",
    "score_map_adv": f"""WITH {_LABELLED}, cells AS {_cells('size, toxic')}
        SELECT doc_id, l.size, CASE WHEN l.size = 'short' THEN 0 ELSE round(ln(p / (1 - p)), 4) END AS advantage
        FROM labelled l JOIN cells c ON l.size = c.size AND c.toxic = 0""",
    "ridge_fit": f"""WITH {_GROUPS}, s AS (SELECT sum(w) AS total FROM groups)
        SELECT member, round(b / (m + {RIDGE_LAMBDA} * m * (1 - m)), 5) AS estimate
        FROM (SELECT member, sum(w * y) / any_value(total) AS b, sum(w) / any_value(total) AS m
              FROM groups, s GROUP BY member)""",
    "ridge_cv": f"""WITH {_GROUPS},
        g AS (SELECT *, l_suppkey % {FOLDS} AS fold FROM groups),
        f AS (SELECT DISTINCT fold FROM g),
        lam AS (SELECT pow(10, 3 - k / 10.0) AS penalty FROM range(51) AS t(k)),
        totals AS (SELECT f.fold, sum(w) AS total FROM f JOIN g ON g.fold <> f.fold GROUP BY 1),
        train AS (SELECT f.fold, member, sum(w * y) / any_value(total) AS b, sum(w) / any_value(total) AS m
                  FROM f JOIN totals USING (fold) JOIN g ON g.fold <> f.fold GROUP BY 1, 2),
        beta AS (SELECT fold, member, penalty, b / (m + penalty * m * (1 - m)) AS beta FROM train, lam),
        curve AS (SELECT penalty, sum(w * pow(y - coalesce(beta, 0), 2)) / sum(w) AS cv_error
                  FROM g JOIN lam ON true LEFT JOIN beta USING (fold, member, penalty) GROUP BY 1)
        SELECT round(penalty, 6) AS penalty, round(cv_error, 5) AS cv_error,
               penalty = (SELECT arg_min(penalty, cv_error) FROM curve) AS is_min
        FROM curve""",
}
