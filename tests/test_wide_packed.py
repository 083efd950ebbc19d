"""Wide fits on packed rows: written once, whatever the rounds, and equal to the fit that Spark adds up."""

import math
import random

import pyarrow as pa
import pytest

from skillframe.models import wide
from skillframe.models.design import Term
from skillframe.models.wide import fit_logit_wide

TERMS = [Term("one", "team"), Term("half", "team"), Term("x"), Term("one", "side"), Term("x", "kind")]


@pytest.fixture(scope="module")
def frame(spark):
    rng, rows = random.Random(8), []
    for _ in range(1200):
        team, side, kind, x = f"t{min(int(rng.expovariate(0.15)), 30)}", rng.choice("ab"), rng.choice("pqr"), rng.gauss(0, 1)
        p = 1 / (1 + math.exp(-(0.3 * x + (0.4 if side == "a" else 0) + (0.5 * x if kind == "q" else 0))))
        rows.append((int(rng.random() < p), team, side, kind, x, round(rng.random(), 1), 1.0))
    return spark.createDataFrame(rows, "y int, team string, side string, kind string, x double, half double, one double")


def rows_of(df):
    return {r["term"]: (r["estimate"], r["std_error"], r["statistic"], r["p_value"], r["converged"]) for r in df.collect()}


def test_rounds_write_nothing(frame, monkeypatch):
    written, rounds, plain, added = [], [], wide.materialize, wide._Places.added
    monkeypatch.setattr(wide, "materialize", lambda df, *a: written.append(1) or plain(df, *a))
    monkeypatch.setattr(wide._Places, "added", lambda self, sums: rounds.append(1) or added(self, sums))
    fit_logit_wide(frame, "y", [Term("one", "team"), Term("x")], "team").collect()
    assert len(rounds) > 3 and len(written) == 2  # the large text values and the packed rows


@pytest.mark.parametrize("collapse", [False, True])
@pytest.mark.parametrize("most", [0, 60])
def test_text_values_of_any_size_give_the_same_fit(frame, monkeypatch, collapse, most):
    packed = rows_of(fit_logit_wide(frame, "y", TERMS, "team", collapse))
    monkeypatch.setattr(wide, "PACKED_ROWS", most)
    split = rows_of(fit_logit_wide(frame, "y", TERMS, "team", collapse))
    assert set(split) == set(packed) and len(packed) > 50
    for term, values in packed.items():
        # Separated text values have estimates without a limit: equal as long as both stop in the same round.
        assert split[term] == tuple(v if v is None or v is True else pytest.approx(v, rel=1e-5, abs=1e-6) for v in values), term


def test_bundles_hold_whole_groups():
    def batch(*groups):
        return pa.RecordBatch.from_pydict({"g": list(groups), "y": [float(ord(g)) for g in groups]}, pa.schema([("g", pa.string()), ("y", pa.float64())]))

    bundles = list(wide._bundled(iter([batch("a", "a", "b"), batch(), batch("b"), batch("b", "c"), batch("c", "d")])))
    assert [b.to_pydict() for b in bundles] == [
        {"g": [["a"]], "ends": [[2]], "y": [[97.0, 97.0]]}, {"g": [["b"]], "ends": [[3]], "y": [[98.0] * 3]},
        {"g": [["c"]], "ends": [[2]], "y": [[99.0] * 2]}, {"g": [["d"]], "ends": [[1]], "y": [[100.0]]}]
    assert list(wide._bundled(iter([batch()]))) == []
