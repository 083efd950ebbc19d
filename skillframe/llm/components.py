"""Connected components of links between documents, as joins and groupings of two-column tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Links that one task replaces by stars.
TASK_LINKS = 1 << 17


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of these links, sorted, and for each the least id that these links reach."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = np.split(at, 2)
    least = np.arange(len(ids))
    while True:
        x, y = least[a], least[b]
        if (x == y).all():
            return ids, ids[least]
        # Roots of linked ids are joined, then every id follows its root to the end.
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars around the least id of each of their components, both ways, and each id with itself."""
    parts = [np.empty((2, 0), np.int64), *(np.stack([batch.column(c).to_numpy() for c in ("a", "b")]) for batch in batches)]
    ids, least = least_reachable(*np.concatenate(parts, axis=1))
    far = ids != least
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((ids[far], least[far], ids), (least[far], ids[far], ids))], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """links: (a, b). Returns (doc, label): the least id reachable from each linked document.

    Links are dealt to as many tasks as their number asks for, whatever the partitions of a shuffle, and each task first replaces
    its links by stars. So links that fit one task need no round but the last. Every round takes
    the least label among a document and its neighbours, then the label of that label, so the distance covered doubles. A hub is
    met by partial aggregation, or split at run time as a skewed join; each round is written, which cuts the lineage. A round
    keeps to two joins, since each may leave a broadcast table with the driver, however few its rows.
    """
    pairs = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
    edges = materialize(pairs.repartition(1 + pairs.count() // TASK_LINKS).mapInArrow(_stars, "a long, b long"))
    labels = materialize(edges.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("label")))
    while True:
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("label")
        near = edges.join(labels.select(F.col("doc").alias("b"), "label"), "b").groupBy(F.col("a").alias("doc")).agg(own, F.min("label").alias("m"))
        jump = labels.select(F.col("doc").alias("m"), F.col("label").alias("far"))
        moved = materialize(near.join(jump, "m").select("doc", F.least("m", "far").alias("label"), (F.least("m", "far") < F.col("label")).alias("new")))
        labels = moved.select("doc", "label")
        if moved.where("new").isEmpty():
            return labels
