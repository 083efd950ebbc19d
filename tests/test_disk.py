"""What written tables leave on disk."""

import os
import time

import pytest

from skillframe import session


def _shuffles(spark):
    """Shuffle files on this machine's disk; the driver of a local session has them all."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before, setting = _shuffles(spark), spark.conf.get(session.SHUFFLES_GO, "false")
    found = session.materialize(spark.range(5000).selectExpr("id % 7 AS k").groupBy("k").count())
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert spark.conf.get(session.SHUFFLES_GO, "false") == setting
    assert sorted(r["count"] for r in found.collect()) == [714] * 5 + [715] * 2
    with pytest.raises(Exception, match="boom"):
        session.materialize(spark.range(3).selectExpr("assert_true(id < 0, 'boom') AS x"))
    assert spark.conf.get(session.SHUFFLES_GO, "false") == setting


def test_materialize_last_keeps_only_what_is_returned(spark, monkeypatch):
    paths, fresh = [], session.fresh_path
    monkeypatch.setattr(session, "fresh_path", lambda s: paths.append(fresh(s)) or paths[-1])
    found = session.materialize_last(spark, lambda: session.materialize(spark.range(3)).selectExpr("id + 1 AS id"))
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 3]
    assert len(paths) == 2 and [os.path.exists(p.removeprefix("file:")) for p in paths] == [True, False]


def test_score_balance_fits_a_written_frame_and_keeps_no_play_time(spark, sf_dir, monkeypatch):
    from skillframe.plans import scores
    from skillframe.queries import balance

    read, fit = [], scores.fit_win_model
    monkeypatch.setattr(scores, "fit_win_model", lambda df: read.append(df._jdf.queryExecution().executedPlan().toString()) or fit(df))
    with session.scratch(spark):
        folder = os.path.dirname(session.fresh_path(spark)).removeprefix("file:")
        gaps = balance.stat_scores_balance(spark, sf_dir).collect()
        assert gaps and all(r["gap"] == r["scaled_gap"] == r["map_gap"] == 0 for r in gaps)
        assert len(read) == 1 and "Exchange" not in read[0]
        written = [{f.name for f in spark.read.parquet(f"{folder}/{d}").schema} for d in os.listdir(folder)]
    assert written and not any("seconds" in names for names in written)
