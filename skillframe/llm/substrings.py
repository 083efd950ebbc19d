"""Substring dedup on the de Bruijn graph of the corpus.

The words of a text are a path through the graph whose edges are its windows of ``WINDOW`` words. An edge is repeated if it
occurs in several documents; its source is its first occurrence (smallest document id, then smallest place). Consecutive
repeated edges of a document whose sources are consecutive too form a nonbranching path; paths are compacted to one row: where
the span lies and where its source lies. Words on edges with a source in an earlier document are removed.

1. Every window has a minimizer, the least hash of the 5-grams in it; neighbours share it, so a text has few. A repeated window
   has a repeated minimizer: groups of documents send their distinct minimizers, and learn which occur in two documents.
2. For windows with such a minimizer only, groups send edges with their first occurrence and learn the source of each.
3. The answers meet the texts. A path of n edges is held together by n independent 64-bit hashes whose source
   coordinates agree; ``verify`` compares the words of long spans with those at their source.

Defined cases: a null text has no words; texts below ``WINDOW`` words keep all; rows of one id are one document; a missing id counts
as larger than all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups
from .words import Slice, grams, inside

WINDOW, SEED_WORDS = 13, 5
_SPANS = "array<struct<start:int,length:int,source_doc:bigint,source_start:int>>"


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each n consecutive values."""
    out, width = x, 1
    while 2 * width <= n:
        out, width = np.minimum(out[:-width], out[width:]), 2 * width
    return np.minimum(out[: len(x) - n + 1], out[n - width :]) if width < n else out


def _windows(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, document within the slice and minimizer of each window."""
    places, doc = inside(part.bounds, WINDOW)
    if not len(places):
        return places, doc, np.empty(0, np.uint64)
    return places, doc, _least(grams(part.hashes, SEED_WORDS), WINDOW - SEED_WORDS + 1)[places]


def _firsts(keys: np.ndarray) -> np.ndarray:
    """keys sorted: where each distinct key begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def _minimizers(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct minimizers, and whether two documents of the group have it."""
    of, mins, docs = groups.ids(table), [], []
    for part in groups.parts(table, lower=False):
        _, doc, least = _windows(part)
        new = np.ones(len(doc), bool)
        new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
        mins.append(least[new])
        docs.append(of[part.first + doc[new]])
    least, doc = np.concatenate(mins or [np.empty(0, np.uint64)]), np.concatenate(docs or [np.empty(0, np.int64)])
    order = np.lexsort((doc, least))
    least, doc = least[order], doc[order]
    first = _firsts(least)
    last = np.append(first[1:], len(least))[: len(first)] - 1
    return least[first], (doc[first] != doc[last]).astype(np.uint8)


def _seen_twice(keys: np.ndarray, several: np.ndarray) -> tuple[np.ndarray]:
    _, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = count >= 2
    twice[at[several > 0]] = True
    return (twice[at].astype(np.uint8),)


def _candidates(table: pa.Table, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges with a shared minimizer: hash, row, place in the document."""
    found: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for part in groups.parts(table, lower=False):
        places, doc, least = _windows(part)
        at = np.searchsorted(shared, least)
        hit = shared[np.minimum(at, len(shared) - 1)] == least if len(shared) else np.zeros(len(least), bool)
        places, doc = places[hit], doc[hit]
        if len(places):
            found.append((grams(part.hashes, WINDOW)[places], part.first + doc, places - part.bounds[doc]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _shared(table: pa.Table, answers: pa.Table) -> np.ndarray:
    mine, _ = _minimizers(table)
    return mine[groups.read(answers, [np.uint8])[0] > 0]


def _edges(table: pa.Table, answers: pa.Table) -> tuple[np.ndarray, ...]:
    """Distinct edges with the document and place of their first occurrence in the group."""
    edge, row, place = _candidates(table, _shared(table, answers))
    doc = groups.ids(table)[row]
    order = np.lexsort((place, doc, edge))
    first = order[_firsts(edge[order])]
    return edge[first], doc[first], place[first].astype(np.int32)


def _sources(keys: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((place, doc, keys))
    first = _firsts(keys[order])
    of = np.empty(len(keys), np.int64)
    of[order] = np.repeat(order[first], np.diff(np.append(first, len(keys))))
    return doc[of], place[of]


def _result(table: pa.Table, shared: np.ndarray, source_doc: np.ndarray, source_place: np.ndarray) -> pa.Table:
    edge, row, place = _candidates(table, shared)
    known, at = np.unique(edge, return_inverse=True)
    del known
    doc, start = source_doc[at], source_place[at]
    gone = doc < groups.ids(table)[row]
    row, place, doc, start = row[gone], place[gone], doc[gone], start[gone].astype(np.int64)
    # Paths: consecutive edges of a row with consecutive sources.
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    edges = np.diff(np.append(head, len(row)))
    per_row = np.concatenate([[0], np.cumsum(np.bincount(row[head], minlength=table.num_rows))]).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(per_row), pa.StructArray.from_arrays(
        [pa.array(place[head].astype(np.int32)), pa.array((edges + WINDOW - 1).astype(np.int32)), pa.array(doc[head]), pa.array(start[head].astype(np.int32))],
        ["start", "length", "source_doc", "source_start"]))
    bounds = np.searchsorted(row, np.arange(table.num_rows + 1))
    n_words, n_removed, kept = [], [], []
    for i, text in enumerate(table.column("text")):
        words = (text.as_py() or "").encode().split()
        a, b = bounds[i], bounds[i + 1]
        if b > a:
            cover = np.zeros(len(words) + 1, np.int32)
            cover[place[a:b]] += 1
            np.subtract.at(cover, place[a:b] + WINDOW, 1)
            stay = np.cumsum(cover[:-1]) == 0
            n_removed.append(len(words) - int(stay.sum()))
            kept.append(b" ".join(compress(words, stay.tolist())).decode())
        else:
            n_removed.append(0)
            kept.append(b" ".join(words).decode())
        n_words.append(len(words))
    return pa.table({"doc": table.column("doc"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "text": pa.array(kept, pa.string()), "spans": spans})


def dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n_words, n_removed, text (kept words joined by one space), spans (start, length in words; source_doc, source_start)."""
    dealt = groups.deal(docs, doc, text)
    buckets, by_group = dealt.buckets, dealt.frame.groupBy("g")
    repeated = groups.answer(groups.send(dealt, _minimizers, 1), _seen_twice, [np.uint8], 1)

    def edges(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        return groups.packed(key[0].as_py(), buckets, *_edges(table, answers))

    sent = by_group.cogroup(repeated.groupBy("g")).applyInArrow(edges, groups.send_schema(2))
    sources = groups.answer(sent, _sources, [np.int64, np.int32], 2)
    both = repeated.withColumns({"r1": F.lit(None).cast("binary"), "step": F.lit(1)}).unionByName(sources.withColumn("step", F.lit(2)))

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        step = answers.column("step").to_numpy()
        first, second = (answers.filter(pa.array(step == s)) for s in (1, 2))
        return _result(table, _shared(table, first), *groups.read(second, [np.int64, np.int32]))

    return by_group.cogroup(both.groupBy("g")).applyInArrow(finish, f"doc long, n_words long, n_removed long, text string, spans {_SPANS}")


def verify(docs: DataFrame, found: DataFrame, least: int = 50, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of ``least`` words or more whose words differ from those at their source (none, but for colliding hashes)."""
    words = docs.select(F.col(doc).alias("id"), F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "").alias("w"))
    spans = found.select("doc", F.explode_outer("spans").alias("s")).where(F.col("s.length") >= least)

    def cut(ids: str, start: str) -> DataFrame:
        at = words.alias("t").join(spans.alias("p"), F.col("t.id") == F.col(ids))
        return at.select("p.doc", "p.s", F.xxhash64(F.array_join(F.slice("t.w", F.col(start) + 1, F.col("p.s.length")), " ")).alias("h"))

    own, source = cut("p.doc", "p.s.start"), cut("p.s.source_doc", "p.s.source_start")
    return own.alias("a").join(source.alias("b"), ["doc", "s"]).where(F.col("a.h") != F.col("b.h")).select("doc", "s")
