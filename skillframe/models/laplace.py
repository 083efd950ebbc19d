"""Logistic model with two crossed random intercepts, fitted by Laplace's approximation of the marginal likelihood.

The model is that of ``mixed``; minus twice its approximate log-likelihood is

    -2 log p(y | u) + sum of u^2 / s + log|S| + log|H|,    H = Z'WZ + S^-1,

at the conditional modes u, with W the binomial weights there. Its derivatives need the diagonal of H^-1, its entries at the
crossings that occur, and how W moves with u; none of them needs H^-1 as a whole. They come from solves with H:

* the diagonal and the crossings from probes: H x = z for ``PROBES`` vectors z of 1 and -1. Groups are numbered and take the
  rows of a Hadamard matrix, with a random sign once the rows are used up, so any two groups with different rows add
  no noise. With up to ``PROBES`` groups the result is exact, beyond that noise falls with the number of groups;
* the way of W from one more right side; the Newton step of the modes is another.

All right sides are solved at once by conjugate gradients. One factor is eliminated, since its block of H is diagonal, so a
step is two grouped sums over the table of crossings (vectors of ``PROBES`` + 2 numbers), and the driver sees one number per right
side. Every round does one solve, starting from the last one's solution, and moves modes, coefficients and variances together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sqltext
from ..session import materialize
from .design import Term, levels, split_term
from .mixed import VARIANCE_FLOOR, WEIGHT_FLOOR, CrossedFit, _ahead, _deviation, collapse

#: A power of two.
PROBES = 32
#: A solve ends when every right side's residual is this share of it, or after so many steps.
SOLVE_TOL, SOLVE_STEPS = 1e-3, 60
#: A factor whose variance still falls where the data decide less than this share of its effects has none.
NOTHING_TOLD = 0.02
#: Groups numbered by one task.
NUMBERED = 200_000
#: Longest move of a mode in one round, in deviations of its factor.
LONGEST_STEP = 3.0


def fit_crossed_laplace(
    df: DataFrame, y: str, fixed: Term, groups: tuple[str, str], tol: float = 1e-3, max_rounds: int = 60
) -> CrossedFit:
    """Fit until no coefficient, variance (as a deviation) or mode moves by ``tol`` or more of the effects' deviation.

    Rows with a missing model value are left out. Effects have the conditional modes, the deviations that H^-1 gives, and
    ``way``, which the equation of a variance needs: n * variance = sum of condval^2 + condsd^2 - condval * way. Raises when ``max_rounds`` do not suffice.
    """
    number, factor = split_term(df, fixed)
    level = F.col(factor) if factor else F.lit("")
    cells = materialize(
        collapse(df, y, fixed, groups).select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
            level.alias("__level"), F.col(number).cast("double").alias("__x"), "__n", "__wins",
        )
    )
    beta = {name: 0.0 for name in levels(cells, "__level")}
    numbered, sizes = _numbered(cells)
    # The factor with more groups is eliminated, so that the iterates are the smaller side.
    big = 0 if sizes[0] >= sizes[1] else 1
    effects = [
        e.select(f"__g{i}", "z", F.lit(0.0).alias("u"), F.array_repeat(F.lit(0.0), PROBES + 2).alias("sol"))
        for i, e in enumerate(numbered)
    ]
    sigma, trail, held = [1.0, 1.0], [[0.0], [0.0]], [False, False]

    for round_no in range(1, max_rounds + 1):
        scored = materialize(_scored(cells, beta, effects))
        moved = _move_slopes(scored, beta, sigma)
        sides = []
        for i in range(2):
            sums = scored.groupBy(f"__g{i}").agg(F.expr("sum(w) AS d"), F.expr("sum(score) AS s"), F.expr("sum(bend) AS k"))
            precision = 1.0 / sigma[i]
            sides.append(materialize(effects[i].join(sums, f"__g{i}").select(
                f"__g{i}", "z", "u", "sol", (F.col("d") + precision).alias("d"),
                F.concat(F.array(F.col("s") - F.col("u") * precision, F.col("k")), "z").alias("b"))))
        solved = _solve(scored, sides, big)
        rows = []
        for i in range(2):
            bound = LONGEST_STEP * _deviation(sigma[i])
            step = F.greatest(F.least(F.col("sol")[0], F.lit(bound)), F.lit(-bound))
            kept = sides[i].select(f"__g{i}", "z", "u").join(solved[i], f"__g{i}")
            effects[i] = materialize(kept.select(f"__g{i}", "z", (F.col("u") + step).alias("u"), F.abs(step).alias("step"), "sol"))
            rows.append(effects[i].select(
                F.lit(i).alias("i"), "step", (F.col("u") * F.col("u")).alias("uu"), (F.col("u") * F.col("sol")[1]).alias("ut"),
                _own("z", "sol").alias("h")))
        for i, step_, uu, ut, trace in rows[0].unionByName(rows[1]).groupBy("i").agg(
                F.max("step"), F.sum("uu"), F.sum("ut"), F.sum("h")).collect():
            moved = max(moved, step_ / _deviation(sigma[i]))
            if held[i]:
                continue
            free = sizes[i] - trace / sigma[i]  # effects that the data decide, not the variance
            estimate = max((uu - ut) / max(free, 1e-9), VARIANCE_FLOOR)
            if free < NOTHING_TOLD * sizes[i] and estimate < sigma[i]:
                held[i], sigma[i], moved = True, VARIANCE_FLOOR, 1.0
                continue
            # Far from the modes a plain step may overshoot; only later ones are drawn out to where they head.
            estimate = math.exp(min(max(math.log(estimate), math.log(sigma[i]) - 2), math.log(sigma[i]) + 2))
            moved = max(moved, abs(_deviation(estimate) / _deviation(sigma[i]) - 1))
            if round_no <= 3:
                trail[i] = []
            trail[i].append(math.log(estimate))
            sigma[i] = math.exp(_ahead(trail[i]))
        if moved < tol:
            parts = [
                effects[i].select(F.lit(g).alias("grpvar"), F.col(f"__g{i}").alias("grp"), F.col("u").alias("condval"),
                                  F.sqrt(F.greatest(_own("z", "sol"), F.lit(0.0))).alias("condsd"), F.col("sol")[1].alias("way"))
                for i, g in enumerate(groups)
            ]
            return CrossedFit(dict(beta), parts[0].unionByName(parts[1]), dict(zip(groups, sigma)), round_no)
    raise RuntimeError(f"no convergence within {max_rounds} rounds; the last round moved by {moved:.3g}")


def _numbered(cells: DataFrame) -> tuple[list[DataFrame], list[int]]:
    """Groups of both factors with their probes (z); numbers are dealt in parallel, by ranges of the names."""
    out, sizes, before = [], [], 0
    for i in range(2):
        name = f"__g{i}"
        names = materialize(cells.select(name).distinct())
        sizes.append(names.count())
        ranges = names.repartitionByRange(1 + sizes[i] // NUMBERED, name).withColumn("__range", F.spark_partition_id())
        dealt = materialize(ranges.withColumn("__k", F.row_number().over(Window.partitionBy("__range").orderBy(name)) - 1))
        counts = dict(dealt.groupBy("__range").count().collect())  # one row per range
        starts, start = [], before
        for r in sorted(counts):
            starts.append((r, start))
            start += counts[r]
        number = F.expr(f"try_element_at({sqltext.mapping([(str(r), float(s)) for r, s in starts])}, string(__range))")
        ids = dealt.withColumn("id", F.col("__k") + F.coalesce(number, F.lit(0.0)).cast("long"))
        sign = F.when((F.col("id") < PROBES) | (F.xxhash64("id") % 2 == 0), 1.0).otherwise(-1.0)
        z = F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda c: sign * (1 - 2 * (F.bit_count(F.col("id").bitwiseAND(c)) % 2)))
        out.append(materialize(ids.select(name, z.alias("z"))))
        before += sizes[i]
    return out, sizes


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _own(z: str, sol: str) -> Column:
    """A group's entry on the diagonal of H^-1."""
    return _dot(F.col(z), F.slice(sol, 3, PROBES)) / PROBES


def _scored(cells: DataFrame, beta: dict[str, float], effects: Sequence[DataFrame]) -> DataFrame:
    """Crossings with score, weight, and bend: the weight's derivative times the linear predictor's variance."""
    out = cells
    for i in range(2):
        out = out.join(effects[i].select(f"__g{i}", *[F.col(c).alias(f"{c}{i}") for c in ("z", "u", "sol")]), f"__g{i}")
    linear = f"try_element_at({sqltext.mapping(beta.items())}, __level) * __x + u0 + u1"
    probes = [F.slice(f"sol{i}", 3, PROBES) for i in range(2)]
    crossed = (_dot(F.col("z0"), probes[1]) + _dot(F.col("z1"), probes[0])) / PROBES
    spread = F.greatest(_own("z0", "sol0") + _own("z1", "sol1") + crossed, F.lit(0.0))
    told = out.withColumn("p", F.expr(f"1 / (1 + exp(-({linear})))")).withColumn("spread", spread)
    return told.select(
        "__g0", "__g1", "__level", "__x", (F.col("sol0")[1] + F.col("sol1")[1]).alias("way"),
        F.expr("__wins - __n * p").alias("score"), F.expr(f"__n * greatest(p * (1 - p), {WEIGHT_FLOOR!r}D)").alias("w"),
        F.expr("__n * p * (1 - p) * (1 - 2 * p) * spread").alias("bend"))


def _move_slopes(scored: DataFrame, beta: dict[str, float], sigma: Sequence[float]) -> float:
    """A step down the likelihood's slope in every coefficient; how far the farthest went."""
    sums = scored.groupBy("__level").agg(
        F.expr("sum(__x * (score - bend / 2 + w * way / 2)) AS s"), F.expr("sum(__x * __x * w) AS h"))
    moved = 0.0
    for row in sums.collect():  # one row per factor level
        step = row["s"] / row["h"] if row["h"] else 0.0
        beta[row["__level"]] += step
        moved = max(moved, abs(step) / max(*map(_deviation, sigma), abs(beta[row["__level"]])))
    return moved


def _sum(vectors: Column, weight: Column | None = None) -> Column:
    return Summarizer.sum(array_to_vector(vectors), weight) if weight is not None else Summarizer.sum(array_to_vector(vectors))


def _scaled(a: Column, by: Column) -> Column:
    return F.transform(a, lambda x: x / by)


def _plus(a: Column, b: Column, factors: np.ndarray | None = None, sign: float = 1.0) -> Column:
    """a + sign * factors * b, element by element."""
    if factors is None:
        return F.zip_with(a, b, lambda x, y: x + sign * y)
    f = F.array(*[F.lit(float(sign * v)) for v in factors])
    return F.zip_with(a, F.zip_with(b, f, lambda x, y: x * y), lambda x, y: x + y)


def _solve(scored: DataFrame, sides: Sequence[DataFrame], big: int) -> list[DataFrame]:
    """Solutions (group, sol) of H sol = b for both factors; sides: group, d, b, and the sol to start from."""
    small = 1 - big
    gb, gs = f"__g{big}", f"__g{small}"

    def across(vectors: DataFrame, start: str, end: str) -> DataFrame:
        """The crossings' weights times vectors (group, v), summed per group of the other factor."""
        met = scored.select("__g0", "__g1", "w").join(vectors, start)
        return met.groupBy(end).agg(_sum(F.col("v"), F.col("w")).alias("s")).select(end, vector_to_array("s").alias("s"))

    own = sides[big].select(gb, F.col("d").alias("db"))

    def back(vectors: DataFrame) -> DataFrame:
        """Over to the eliminated factor and back."""
        over = across(vectors, gs, gb).join(own, gb).select(gb, _scaled(F.col("s"), F.col("db")).alias("v"))
        return across(over, gb, gs)

    lent = across(sides[big].select(gb, _scaled(F.col("b"), F.col("d")).alias("v")), gb, gs).withColumnRenamed("s", "lent")
    # The Newton step starts from nothing, the others from where they were.
    x = F.concat(F.array(F.lit(0.0)), F.slice("sol", 2, PROBES + 1))
    begun = back(sides[small].select(gs, x.alias("v")))
    state = sides[small].join(lent, gs).join(begun, gs)
    wanted = _plus(F.col("b"), F.col("lent"), sign=-1.0)
    state = state.select(gs, "d", x.alias("x"), wanted.alias("wanted"), "s")
    residual = _plus(_plus(F.col("wanted"), F.transform("x", lambda v: v * F.col("d")), sign=-1.0), F.col("s"))
    state = materialize(state.select(gs, "d", "x", "wanted", residual.alias("r")))
    square = lambda a, b: F.zip_with(a, b, lambda x, y: x * y / F.col("d"))
    first = state.agg(_sum(square("r", "r")).alias("rr"), _sum(square("wanted", "wanted")).alias("ww")).first()
    rr, target = first["rr"].toArray(), SOLVE_TOL**2 * np.maximum(first["ww"].toArray(), 1e-30)
    state = state.withColumn("p", _scaled(F.col("r"), F.col("d")))
    for _ in range(SOLVE_STEPS):
        if (rr <= target).all():
            break
        over = back(state.select(gs, F.col("p").alias("v")))
        image = _plus(F.transform("p", lambda v: v * F.col("d")), F.col("s"), sign=-1.0)
        met = materialize(state.join(over, gs).select(gs, "d", "x", "r", "p", image.alias("a")))
        sums = met.agg(
            _sum(F.zip_with("p", "a", lambda x, y: x * y)).alias("pa"), _sum(square("r", "a")).alias("ra"), _sum(square("a", "a")).alias("aa")).first()
        pa, ra, aa = (sums[c].toArray() for c in ("pa", "ra", "aa"))
        length = np.where((rr > target) & (pa > 0), rr / np.where(pa > 0, pa, 1), 0.0)
        now = np.maximum(rr - 2 * length * ra + length**2 * aa, 0.0)
        turn = np.where(rr > 0, now / np.where(rr > 0, rr, 1), 0.0)
        state = met.select(
            gs, "d", _plus(F.col("x"), F.col("p"), length).alias("x"), _plus(F.col("r"), F.col("a"), length, -1.0).alias("r"), "p")
        state = state.withColumn("p", _plus(_scaled(F.col("r"), F.col("d")), F.col("p"), turn))
        rr = now
    found = materialize(state.select(gs, F.col("x").alias("sol")))
    rest = across(found.select(gs, F.col("sol").alias("v")), gs, gb)
    other = sides[big].select(gb, "d", "b").join(rest, gb).select(gb, _scaled(_plus(F.col("b"), F.col("s"), sign=-1.0), F.col("d")).alias("sol"))
    return [found, other] if small == 0 else [other, found]
