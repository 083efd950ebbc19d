"""Session settings the operators rely on, and the lineage cut they share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Match times are zone-less; every cast between date and time happens in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot match or team is split at run time, also when a group-by on the same key follows the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Groups that come sorted by their key are added up as they pass, without a table of unfinished groups.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Python tasks read rows of very different sizes; a batch is bounded by its bytes, not by its rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a fresh temporary folder, remembered on the
    SparkContext so that one session uses one folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skillframe-"))
    return context.getCheckpointDir().rstrip("/")


#: Spark's setting that drops the shuffle files of a query when it ends, instead of when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scope: ContextVar[str | None] = ContextVar("skillframe_scope", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what ``materialize`` wrote inside the block when the block ends."""
    mark = f"scope-{uuid.uuid4().hex}"
    token = _scope.set(mark)
    try:
        yield
    finally:
        _scope.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/skillframe/{mark}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession) -> str:
    """A new path in the shared folder, removed with the enclosing ``scratch`` block like what ``materialize`` writes."""
    folder = _scope.get() or spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/skillframe/{folder}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer the real size of the result, so that a
    later join broadcasts it only when it is small. codec: of the files, else the session's. The files stay until the enclosing ``scratch`` block ends; without
    one they belong to the application's folder. Shuffle files of the query go when the table is written: nothing reads them again.
    """
    return _written(df, fresh_path(df.sparkSession), codec)


def materialize_last(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``materialize(build())``; what ``build`` itself wrote on the way is deleted."""
    path = fresh_path(spark)
    with scratch(spark):
        return _written(build(), path)


def _written(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)
