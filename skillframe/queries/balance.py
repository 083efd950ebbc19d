"""The equations that a fitted model must satisfy, per term or group: 0 but for rounding, with counts SQL can give too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext
from ..models.design import Term, complete_cases, split_term
from ..models.glm import LogitFit, fit_logit, link_expr
from ..models.mixed import VARIANCE_FLOOR, CrossedFit, fit_crossed_logit
from ..models.ridge import best_lambda, penalty_scale
from ..models.ridge import ridge_cv as cross_validate
from ..models.ridge import ridge_fit as solve
from ..operators.joins import equi_join
from ..operators.reshape import membership
from ..plans import fixed, lineups, scores
from ..session import materialize
from .models import labelled
from .ratings import _RESULTS, _SIDE_COLUMNS, _SUBROLES, _TEAM_VALUES, _spread, _subroles, _type_players, _wide
from .ratings import ORACLES as RATINGS
from .ratings import order_results, stat_log

LOGIT_TERMS = [Term("lang", "one"), Term("log_size", "lang"), Term("toxic", "lang")]


def _zero(value: str, digits: int) -> Column:
    return F.expr(f"round({value}, {digits}) + 0D")


def logit_balance(frame: DataFrame, label: str, terms: list[Term], fit: LogitFit) -> DataFrame:
    """Score equation of every term: sum of its column times outcome less fitted share, in units of the column's length."""
    cases = complete_cases(frame, label, terms)
    fitted = materialize(cases.withColumn("__gap", F.col(label).cast("double") - 1 / (1 + F.exp(-link_expr(cases, fit, terms)))))
    parts = []
    for term in terms:
        number, factor = split_term(frame, term)
        named = [F.concat(F.lit(v), F.col(v)) if v == factor else F.lit(v) for v in term.variables]
        x = f"double({sqltext.name(number)})"
        parts.append((F.concat_ws(":", *named), F.expr(x)))
    spread = fitted.select("__gap", F.explode(F.array(*[F.struct(n.alias("term"), x.alias("x")) for n, x in parts])).alias("t"))
    sums = spread.groupBy(F.col("t.term").alias("term")).agg(
        F.count("*").alias("n"), F.expr("sum(t.x * __gap) AS s"), F.expr("sqrt(sum(t.x * t.x)) AS size"))
    return sums.select("term", "n", _zero("coalesce(s / nullif(size, 0D), 0D)", 3).alias("score"))


def crossed_balance(frame: DataFrame, y: str, fixed_term: Term, groups: tuple[str, str], fit: CrossedFit) -> DataFrame:
    """What a further step would move each effect, in deviations: the penalised score equation of every group; and the group
    ``(variance)``: by what share the effects and their errors put the deviation off the fit's."""
    number, factor = split_term(frame, fixed_term)
    names = [y, *groups, number, *([factor] if factor else [])]
    rows = frame.select(*names).dropna()
    level = F.col(factor) if factor else F.lit("")
    rows = rows.select(*names, F.try_element_at(F.expr(sqltext.mapping(fit.beta.items())), level).alias("__beta"))
    for i, g in enumerate(groups):
        effects = fit.effects.where(F.col("grpvar") == g).select(F.col("grp").alias(g), F.col("condval").alias(f"__e{i}"))
        rows = rows.join(effects, g)
    p = F.expr(f"1 / (1 + exp(-(__beta * double({sqltext.name(number)}) + __e0 + __e1)))")
    rows = materialize(rows.withColumn("__p", p))
    parts = []
    for i, g in enumerate(groups):
        variance, precision = fit.variances[g], sqltext.literal(1 / fit.variances[g])
        deviation = sqltext.literal(max(variance, VARIANCE_FLOOR) ** 0.5)
        sums = materialize(rows.groupBy(F.lit(g).alias("grpvar"), F.col(g).alias("grp")).agg(
            F.count("*").alias("n"), F.sum(F.col(y).cast("double") - F.col("__p")).alias("s"), F.sum(F.col("__p") * (1 - F.col("__p"))).alias("w"),
            F.first(f"__e{i}").alias("e")))
        parts.append(sums.select("grpvar", "grp", "n", _zero(f"(s - e * {precision}) / (w + {precision}) / {deviation}", 2).alias("gap")))
        # From effects one step on, so that effects held at 0 against the data show.
        step = sums.selectExpr("n", f"(s + w * e) / (w + {precision}) AS e", f"{precision} / (w + {precision}) AS shrunk")
        estimate = f"greatest(sum(e * e) / greatest(sum(1 - shrunk), 1e-12D), {VARIANCE_FLOOR!r}D)"
        parts.append(step.agg(F.sum("n").alias("n"), _zero(f"sqrt({estimate}) / {deviation} - 1", 1).alias("gap")).select(
            F.lit(g).alias("grpvar"), F.lit("(variance)").alias("grp"), "n", "gap"))
    return reduce(DataFrame.unionByName, parts)


def glm_logit_balance(spark, sf):
    frame = labelled(spark, sf)
    return logit_balance(frame, "quality", LOGIT_TERMS, fit_logit(frame, "quality", LOGIT_TERMS))


def stat_model_balance(spark, sf):
    frame = materialize(scores.team_frame(order_results(spark, sf), stat_log(spark, sf), _subroles(spark, sf)))
    return logit_balance(frame, "win", scores.WIN_TERMS, scores.fit_win_model(frame))


def stat_scores_balance(spark, sf):
    """Scores per season and subrole against sums over the long form of statistics and coefficients."""
    results, log, subroles = order_results(spark, sf), stat_log(spark, sf), _subroles(spark, sf)
    # Written, so that the fit keeps no shuffle files of the frame's joins while the rest is worked out.
    frame = scores.team_frame(results, log, subroles).select("win", "map_type", scores.FLAG, "year", *scores.MODEL_STATS)
    fit = scores.fit_win_model(materialize(frame))
    # Written once for the scores and the sums they are held against.
    used = ["stage", "patch", "year", "subrole", "map_id", "map_type", "player", "player_team", scores.FLAG, *scores.MODEL_STATS]
    wide = materialize(scores.player_frame(results, log, subroles).select(*used))
    long = wide.select("year", "subrole", "map_id", "map_type", "player", "player_team", scores.FLAG, F.explode(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("v")) for s in scores.MODEL_STATS])).alias("x"))
    # One row per term, of which a design has MAX_COLUMNS at most: the long form stays where it is.
    coefs = F.broadcast(fit.coef_df(spark).select("term", F.coalesce("estimate", F.lit(0.0)).alias("estimate")))
    key = ["year", "subrole", "map_id", "map_type", "player", "player_team"]
    summed = long.join(coefs, F.concat(F.col("x.stat"), F.lit(":year"), F.col("year")) == F.col("term"), "left").groupBy(*key).agg(
        F.expr("sum(estimate * x.v) AS expected"), F.first(scores.FLAG).alias("flag"))
    flag = F.concat(F.lit("map_type"), F.col("map_type"), F.lit(f":{scores.FLAG}")) == F.col("term")
    advantage = F.when(F.col("map_type") == fixed.NEUTRAL_MAP_TYPE, F.lit(0.0)).otherwise(F.expr("estimate * flag"))
    summed = materialize(summed.join(coefs, flag, "left").select(*key, "expected", advantage.alias("advantage")))
    scored = scores.stat_scores(results, log, subroles, fit, frame=wide).select(*key, "score", "scaled_score", "map_adv_score")
    spread = summed.groupBy("subrole").agg(F.avg("expected").alias("mean"), F.stddev_samp("expected").alias("sd"))
    both = equi_join(equi_join(scored, summed, key), spread, ["subrole"])
    pairs = {"gap": ("score", "expected"), "scaled_gap": ("scaled_score", "(expected - mean) / nullif(sd, 0D)"),
             "map_gap": ("map_adv_score", "advantage")}
    return both.groupBy("year", "subrole").agg(F.count("*").alias("n"), *[
        F.expr(f"round(max(CASE WHEN isnull({a}) <> isnull({b}) THEN 1D ELSE coalesce(abs({a} - {b}), 0D) END), 6) + 0D AS {out}")
        for out, (a, b) in pairs.items()])


def mixed_intercepts_balance(spark, sf):
    frame, groups = labelled(spark, sf), ("source", "lang")
    return crossed_balance(frame, "quality", Term("one"), groups, fit_crossed_logit(frame, "quality", Term("one"), groups))


def _paired(spark, sf):
    return materialize(lineups.lineup_frame(lineups.side_players(order_results(spark, sf), _type_players(spark, sf))))


def on_off_lineup_balance(spark, sf):
    frame, groups, term = _paired(spark, sf), ("lineup", "lineup_opponent"), Term("map_type", "first_attacker_flg")
    return crossed_balance(frame, "win", term, groups, fit_crossed_logit(frame, "win", term, groups))


def on_off_player_balance(spark, sf):
    """Normal equations of the ridge as ``player_scores`` fits it: weighted residual on each member less its penalty, in units of the response."""
    frame = _paired(spark, sf)
    rated = materialize(lineups.lineup_scores(frame))
    members = materialize(membership(rated, "lineup", ";", "exact", lineups.lineup_roles(frame)))
    targets = rated.select("lineup", "estimate", F.col("n").cast("double").alias("n"))
    best = best_lambda(cross_validate(members, targets, lambda_scale="response_sd"))
    fit = solve(members, targets, best, "response_sd")
    squares, mean = targets.agg(F.expr("sum(n * estimate * estimate) / sum(n)"), F.expr("sum(n * estimate) / sum(n)")).first()
    penalty = best * penalty_scale(squares, mean, "response_sd")
    who, lineup = members.columns[1], members.columns[0]
    listed = members.select(F.col(lineup).alias("lineup"), F.col(who).alias("member")).distinct()
    predicted = listed.join(fit, "member").groupBy("lineup").agg(F.sum("estimate").alias("fitted"))
    total = targets.agg(F.sum("n").alias("all"), F.expr("sqrt(sum(n * estimate * estimate) / sum(n)) AS unit"))
    rows = targets.join(predicted, "lineup", "left").na.fill(0.0, ["fitted"])
    sums = listed.join(rows, "lineup").groupBy("member").agg(
        F.count("*").alias("n_lineups"), F.sum("n").alias("w"), F.expr("sum(n * (estimate - fitted)) AS s"))
    joined = sums.join(fit, "member").crossJoin(F.broadcast(total))  # one row of totals
    return joined.select("member", "n_lineups", _zero(
        f"(s / all - {sqltext.literal(float(penalty))} * (w / all) * (1 - w / all) * estimate) / nullif(unit, 0D)", 4).alias("gap"))


QUERIES = {
    "glm_logit_balance": glm_logit_balance,
    "stat_model_balance": stat_model_balance,
    "stat_scores_balance": stat_scores_balance,
    "mixed_intercepts_balance": mixed_intercepts_balance,
    "on_off_lineup_balance": on_off_lineup_balance,
    "on_off_player_balance": on_off_player_balance,
}

_ROWS = """labelled AS (SELECT lang, source, ln(n_chars) AS log_size, toxic, quality FROM labels JOIN documents USING (doc_id))"""
_TYPES = f"""{_RESULTS},
    types AS (SELECT DISTINCT p_type AS player, l_orderkey::VARCHAR AS map_id,
                     CASE WHEN s_nationkey < 12 THEN 'home' ELSE 'away' END AS team, 'HYBRID' AS map_type,
                     CASE WHEN l_returnflag = 'R' THEN 'back' ELSE 'front' END AS subrole
              FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
    lineups AS (SELECT player_team, opponent_team, s.map_id, win, map_type, first_attacker_flg, year,
                       string_agg(coalesce(player, 'NA') || '_' || coalesce(subrole, 'NA'), ';'
                                  ORDER BY player NULLS LAST, coalesce(subrole, 'NA')) AS lineup
                FROM sides s LEFT JOIN types r ON s.map_id = r.map_id AND s.player_team = r.team
                WHERE map_winner <> 'draw' GROUP BY ALL),
    paired AS (SELECT a.*, b.lineup AS lineup_opponent
               FROM lineups a JOIN lineups b ON a.map_id = b.map_id AND a.opponent_team IS NOT DISTINCT FROM b.player_team
                    AND a.year = b.year),
    usable AS (SELECT * FROM paired WHERE win IS NOT NULL AND map_type IS NOT NULL)"""

_STAT_TERMS = " UNION ALL ".join(f"SELECT '{s}:year' || year AS term, count(*) AS n, 0::DOUBLE AS score FROM usable GROUP BY year"
                                 for s in scores.MODEL_STATS)

ORACLES = {
    "glm_logit_balance": f"""WITH {_ROWS}
        SELECT 'lang' || lang || ':one' AS term, count(*) AS n, 0::DOUBLE AS score FROM labelled GROUP BY lang
        UNION ALL SELECT 'log_size:lang' || lang, count(*), 0 FROM labelled GROUP BY lang
        UNION ALL SELECT 'toxic:lang' || lang, count(*), 0 FROM labelled GROUP BY lang""",
    "stat_model_balance": f"""WITH {_SUBROLES}, {_RESULTS}, {_wide(fixed.TEAM_STATS)},
        teams AS (SELECT map_id, map_type, team, {_spread(_TEAM_VALUES)}
                  FROM (SELECT *, final_blows - solo_kills AS assisted_kills FROM wide) GROUP BY ALL),
        usable AS (SELECT {_SIDE_COLUMNS}, map_type FROM sides s JOIN teams t ON s.map_id = t.map_id AND s.player_team = t.team
                   WHERE map_winner <> 'draw' AND win IS NOT NULL)
        SELECT 'map_type' || map_type || ':first_attacker_flg' AS term, count(*) AS n, 0::DOUBLE AS score
        FROM usable GROUP BY map_type UNION ALL {_STAT_TERMS}""",
    "stat_scores_balance": f"""WITH frame AS ({RATINGS['player_model_frame']})
        SELECT year, subrole, count(*) AS n, 0::DOUBLE AS gap, 0::DOUBLE AS scaled_gap, 0::DOUBLE AS map_gap FROM frame GROUP BY ALL""",
    "mixed_intercepts_balance": f"""WITH {_ROWS}
        SELECT 'source' AS grpvar, source AS grp, count(*) AS n, 0::DOUBLE AS gap FROM labelled GROUP BY source
        UNION ALL SELECT 'lang', lang, count(*), 0 FROM labelled GROUP BY lang
        UNION ALL SELECT unnest(['source', 'lang']), '(variance)', count(*), 0 FROM labelled""",
    "on_off_lineup_balance": f"""WITH {_TYPES}
        SELECT 'lineup' AS grpvar, lineup AS grp, count(*) AS n, 0::DOUBLE AS gap FROM usable GROUP BY lineup
        UNION ALL SELECT 'lineup_opponent', lineup_opponent, count(*), 0 FROM usable GROUP BY lineup_opponent
        UNION ALL SELECT unnest(['lineup', 'lineup_opponent']), '(variance)', count(*), 0 FROM usable""",
    "on_off_player_balance": f"""WITH {_TYPES},
        rated AS (SELECT DISTINCT player_team, lineup FROM paired
                  WHERE lineup IN (SELECT lineup FROM usable UNION SELECT lineup_opponent FROM usable)),
        members AS (SELECT DISTINCT player_team, lineup, unnest(string_split(lineup, ';')) AS member FROM rated)
        SELECT member, count(*) AS n_lineups, 0::DOUBLE AS gap FROM members GROUP BY member""",
}
