"""Quality classifier: support vectors on n-gram indicators scaled by naive Bayes log-count ratios.

Features of a text, all taken from the whole text:

* indicators of its lower-cased words, hashed; divided by the root of their number, so that long texts weigh no more;
* indicators of n-grams (one and two) of word shapes that make up at least 1/2, 1/4 ... 1/64 of its words. A shape says which
  kinds of characters a word has and how many marks, its length class, and whether it repeats the word before.

A feature's ratio is the log of its smoothed share of good documents over that of bad ones. The scaled indicators go into a
linear hinge-loss model fitted by dual coordinate descent. The fit sees at most ``max_labelled`` labelled documents, the first
by hash of their id (the only bound); its features, a few megabytes, meet on the driver. Scoring is one pass over the documents
without a shuffle. The score is the logistic function of twice the margin.

Defined cases: a null or empty text has no feature and scores by the intercept alone; a document with contradictory labels
is not learned from; with labels of one class only, or none, every score is 0.5; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Slice, mix, slices

BITS = 18
SHARES = 6
_U = np.uint64


@dataclass(frozen=True)
class Model:
    """weights: per feature, ratio included. bias: intercept."""

    weights: np.ndarray
    bias: float


# Kinds of bytes: 1 upper case, 2 digit, 3 mark (other ASCII), 0 the rest.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = 1
_KIND[0x61:0x7B] = 0


def _shapes(part: Slice) -> np.ndarray:
    kinds = _KIND[part.data]

    def count(kind: int) -> np.ndarray:
        sums = np.zeros(len(kinds) + 1, dtype=np.int32)
        np.cumsum(kinds == kind, out=sums[1:])
        return sums[part.ends] - sums[part.begins]

    length = part.ends - part.begins
    upper, digits, marks = count(1), count(2), count(3)
    same = np.zeros(len(length), dtype=np.int64)
    same[1:] = part.hashes[1:] == part.hashes[:-1]
    starts = part.bounds[:-1]
    same[starts[starts < len(same)]] = 0
    size = np.minimum(np.log2(np.maximum(length, 1)).astype(np.int64), 5)
    code = (np.minimum(upper, 2) * 3 + np.minimum(digits, 2)) * 4 + np.minimum(marks, 3)
    return ((code * 2 + (marks + digits == length)) * 6 + size) * 2 + same


def _features(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document within the slice, feature, value), each feature of a document once."""
    n = part.counts
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    mask = _U((1 << BITS) - 1)
    words = np.unique((doc << _U(BITS)) | (part.hashes & mask))
    word_doc = (words >> _U(BITS)).astype(np.int64)
    per_doc = np.bincount(word_doc, minlength=len(n))
    found = [(word_doc, (words & mask).astype(np.int64), 1 / np.sqrt(per_doc[word_doc]))]
    shape = _shapes(part)
    pair = shape[:-1] * 4096 + shape[1:] + 4096
    within = doc[1:] == doc[:-1] if len(doc) else np.empty(0, bool)
    for grams, at in ((shape, doc), (pair[within], doc[1:][within] if len(doc) else doc)):
        keys, times = np.unique((at << _U(32)) | grams.astype(np.uint64), return_counts=True)
        of = (keys >> _U(32)).astype(np.int64)
        level = np.ceil(np.log2(n[of] / times) - 1e-9).astype(np.int64)
        for share in range(1, SHARES + 1):
            has = level <= share
            gram = keys[has] & _U(0xFFFFFFFF)
            found.append((of[has], (mix(gram * _U(64) + _U(share)) & mask).astype(np.int64), np.ones(int(has.sum()))))
    of, feature, value = (np.concatenate(x) for x in zip(*found, strict=True))
    return of, feature, value


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column("text")):
            of, feature, value = _features(part)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(len(part.counts) + 1))
            rows = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("y").slice(part.first, part.last - part.first),
                pa.array([feature[r].astype(np.int32).tobytes() for r in rows], pa.binary()),
                pa.array([value[r].astype(np.float32).tobytes() for r in rows], pa.binary())], ["y", "feature", "value"])


def fit_rows(labels: np.ndarray, features: list[np.ndarray], values: list[np.ndarray], alpha: float = 1.0, cost: float = 1.0,
             rounds: int = 20, least: int = 3) -> Model:
    """labels: +1 or -1. Dual coordinate descent for the hinge loss; the intercept is a feature of value 1."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(size, np.float32), 0.0)
    good, bad = (np.bincount(np.concatenate([f for f, y in zip(features, labels, strict=True) if y == side]), minlength=size) for side in (1, -1))
    n_good, n_bad = int((labels == 1).sum()), int((labels == -1).sum())
    ratio = np.log((alpha + good) / (2 * alpha + n_good)) - np.log((alpha + bad) / (2 * alpha + n_bad))
    ratio[good + bad < least] = 0
    scaled = [v * ratio[f] for f, v in zip(features, values, strict=True)]
    # Both classes get the same weight in all.
    caps = np.where(labels == 1, cost * len(labels) / (2 * n_good), cost * len(labels) / (2 * n_bad))
    weights, bias, dual = np.zeros(size), 0.0, np.zeros(len(labels))
    squares = np.array([float(x @ x) + 1 for x in scaled])
    draw = np.random.default_rng(1)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(labels)):
            f, x, y = features[i], scaled[i], labels[i]
            slope = y * (weights[f] @ x + bias) - 1
            new = min(max(dual[i] - slope / squares[i], 0.0), caps[i])
            if new != dual[i]:
                step = (new - dual[i]) * y
                moved = max(moved, abs(new - dual[i]))
                weights[f] += step * x
                bias += step
                dual[i] = new
        if moved < 1e-3:
            break
    return Model((weights * ratio).astype(np.float32), bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", doc: str = "doc_id", text: str = "text",
        max_labelled: int = 8000) -> Model:
    """``learn``: which label rows may be learned from. Labels are 1 (good) or 0."""
    clear = labels.where(learn & F.col(doc).isNotNull()).groupBy(doc).agg(F.min(label).alias("y"), F.max(label).alias("top")).where(
        (F.col("y") == F.col("top")) & F.col("y").isin(0, 1))
    sample = clear.select(doc, "y", F.xxhash64(doc).alias("h")).orderBy("h", doc).limit(max_labelled).select(doc, "y")
    # The sample has at most max_labelled rows of two numbers.
    joined = docs.select(doc, F.col(text).alias("text")).join(F.broadcast(sample), doc).select("text", F.col("y").cast("int").alias("y"))
    rows = joined.mapInArrow(_rows, "y int, feature binary, value binary").collect()
    y = np.array([2 * r["y"] - 1 for r in rows])
    features = [np.frombuffer(r["feature"], np.int32) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (bytes(rows[i]["feature"]), y[i]))  # the order of arrival must not matter
    return fit_rows(y[order], [features[i] for i in order], [np.frombuffer(rows[i]["value"], np.float32) for i in order])


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score``; the text only if it is to be kept."""
    weights, bias = model.weights, model.bias
    others = [c for c in docs.columns if keep_text or c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part in slices(batch.column(text)):
                of, feature, value = _features(part)
                margin = np.bincount(of, weights=value * weights[feature], minlength=len(part.counts)) + bias
                out.append(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))
            scores = np.concatenate(out) if out else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(scores)], [*others, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in others)
    return docs.mapInArrow(run, f"{kinds}, score double" if kinds else "score double")
