from pathlib import Path

import pytest

from skillframe import session
from skillframe.operators import reshape


def test_scratch_tables_go_when_the_block_ends(spark):
    base = Path(session.shared_dir(spark).removeprefix("file:")) / "skillframe"
    before = set(base.iterdir()) if base.exists() else set()
    with session.scratch(spark):
        assert session.materialize(spark.range(5)).count() == 5
        (made,) = set(base.iterdir()) - before
        assert made.name.startswith("scope-")
    assert not made.exists()


def test_materialized_sizes_are_known_to_the_optimizer(spark):
    small = session.materialize(spark.range(5).withColumnRenamed("id", "k"))
    joined = spark.range(10**7).withColumnRenamed("id", "k").join(small, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


class Cluster:
    """A session of a cluster, as far as the choice of the folder looks at it."""

    def __init__(self, settings):
        self.settings = settings
        self.sparkContext = self.conf = self
        self.master = "yarn"

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getCheckpointDir(self):
        return None


def test_a_cluster_must_name_its_folder():
    assert session.shared_dir(Cluster({"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster({}))


def test_regex_membership_in_slices(spark, monkeypatch):
    monkeypatch.setattr(reshape, "ROLES_PER_SLICE", 2)
    lineups = spark.createDataFrame([("ab_x;cd_y",), ("d_y",)], "lineup string")
    roles = spark.createDataFrame([(r,) for r in ("b_x", "d_y", "ab_x", ".d_y", "zz")], "player_role string")
    got = {tuple(r) for r in reshape.membership(lineups, "lineup", mode="regex", roles=roles).collect()}
    assert got == {("ab_x;cd_y", r) for r in ("b_x", "d_y", "ab_x", ".d_y")} | {("d_y", "d_y")}
