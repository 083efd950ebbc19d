"""Language-model scores by online logistic context mixing.

A text is its lower-cased words and one end. Three predictors say how likely the next token is: the corpus' counts of the token
(unigram), of the token after the one before it (hashed bigram context), and of the token in the text so far (cache). Two
binary choices decide between them: cache or corpus, then bigram or unigram. Each choice is a bit predicted by several
hashed contexts: how often the word before is known together with the last outcomes, the hashed word before, and the run of
recent outcomes with the place in the text. Their log-odds are added with weights from a set that a gate selects, and the
weights are refined along the text, chunk by chunk, by the gradient of the coded length. The mixture is normalised, so the
summed log2 is a code length; it is also given as bits per byte.

All that is learned comes from all documents that may be learned from; one that is learned from is scored without its own bigrams
and outcomes, but single words count it. Counts of words and bigrams are exchanged by groups of documents (see ``groups``): exact 64-bit keys for words,
shortened keys for bigrams, of which about one in two thousand may be taken for another. What a document needs of them is
written once, then read three times, document by document:

1. The outcomes in each slot of each context are summed over all learning documents. An outcome compares predictors that no
   table enters (the corpus stands as the mean of bigram and unigram there), so one sum serves both choices.
2. Learning documents refine their weights along their text, against tables without their own outcomes. The mean of the refined
   weights, by tokens, is where every text starts; a learning document starts from the mean without its own fold of documents.
3. Scores. Tables and weights are sums of whole numbers, so a score hangs on the text and the corpus, not on what is read beside it.

Predicting the eight bits of every byte would take some 7 billion steps per gigabyte, each with several table look-ups, which
no numpy loop does within 960 CPU seconds; the README gives the figures.

Defined cases: a null or empty text is one end; without learning documents all counts are 0; rows of one id share a group and
are scored one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import groups
from .words import mix, slices

_U = np.uint64
_START, _END = _U(0x5AFE5AFE5AFE5AFE), _U(0xE0DE0DE0DE0DE0D1)
CHUNK, GATES, SLOTS, RATE = 32, 6, 1 << 14, 0.02
#: Folds of documents for the start weights; tokens handled at a time; weights are summed as whole numbers of this part.
FOLDS, TOKENS, WHOLE = 16, 1 << 18, 1 << 20
#: Slots of the three contexts of a choice, and where each begins when those of both choices follow each other.
_SIZES = (256, SLOTS, 144)
_STARTS = np.concatenate([[0], np.cumsum(_SIZES * 2)])
_ONES = np.array([bin(x).count("1") for x in range(256)])
#: What is kept of a token, and in how many bytes.
_WIDE = {"count": 5, "pair": 5, "own": 4, "seen": 4, "before": 2}


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All rows' tokens, each row's closed by an end; where each row begins."""
    hashes, counts = [], []
    for part in groups.parts(table, lower=True):
        hashes.append(part.hashes)
        counts.append(part.counts)
    n = np.concatenate(counts) if counts else np.empty(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(n + 1)])
    tokens = np.full(int(bounds[-1]), _END, dtype=np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[bounds[1:] - 1] = True
    tokens[~is_end] = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return tokens, bounds


def _pairs(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each token with the one before it, and that one."""
    before = np.concatenate([[_START], tokens[:-1]]).astype(np.uint64)
    before[bounds[:-1]] = _START
    return mix(before * _U(0x9E3779B97F4A7C15) + (tokens ^ (tokens >> _U(29)))), before


def _learning(table: pa.Table, bounds: np.ndarray) -> np.ndarray:
    held = table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
    return np.repeat(~held, np.diff(bounds))


def _counted(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(keys, return_inverse=True)
    return known, np.bincount(at, weights=learned, minlength=len(known)).astype(np.uint32)


def _words_sent(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    tokens, bounds = _tokens(table)
    return _counted(tokens, _learning(table, bounds))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray]:
    _, at = np.unique(keys, return_inverse=True)
    return (np.bincount(at, weights=counts).astype(np.int64)[at],)


def _own(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token: how often its key is in its row, and how often before it."""
    mine = mix(keys + row.astype(np.uint64) * _U(0xD1342543DE82EF95))
    order = np.argsort(mine, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], mine[order][1:] != mine[order][:-1]])) if len(mine) else np.empty(0, np.int64)
    runs = np.diff(np.append(first, len(mine)))
    total, before = np.empty(len(mine), np.int64), np.empty(len(mine), np.int64)
    total[order] = np.repeat(runs, runs)
    before[order] = np.arange(len(mine)) - np.repeat(first, runs)
    return total, before


def _history(outcome: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    """The outcomes of the ``back`` tokens before each, as bits; none before a row's beginning."""
    bits = np.zeros(len(outcome), np.int64)
    for j in range(1, back + 1):
        bits[j:] |= (outcome[:-j] & (place[j:] >= j)).astype(np.int64) << (j - 1)
    return bits


def mixed(first: np.ndarray, second: np.ndarray, may: np.ndarray, odds: np.ndarray, gate: np.ndarray, bounds: np.ndarray,
          weights: np.ndarray | None = None) -> np.ndarray:
    """Probability of each token when a predicted bit chooses between two predictors.

    first, second: their probabilities; ``may``: whether the first has one at all. odds: a column per context. weights: of each
    row, gate and context; they follow the gradient of the log probability, one step after each chunk, in place.
    """
    out = np.array(second, dtype=np.float64)
    n = np.diff(bounds)
    rows = np.argsort(-n, kind="stable")
    if weights is None:
        weights = np.full((len(n), GATES, odds.shape[1]), 1 / odds.shape[1])
    for start in range(0, int(n.max()) if len(n) else 0, CHUNK):
        active = rows[: int(np.searchsorted(-n[rows], -start, side="left"))]
        lengths = np.minimum(n[active] - start, CHUNK)
        row = np.repeat(active, lengths)
        at = np.repeat(bounds[active] + start - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(row))
        keep = may[at]
        row, at = row[keep], at[keep]
        x, g = odds[at], gate[at]
        share = np.clip(1 / (1 + np.exp(-np.einsum("ij,ij->i", x, weights[row, g]))), 1e-4, 0.999)
        hit, rest = share * first[at], (1 - share) * second[at]
        out[at] = hit + rest
        step = (hit / (hit + rest) - share)[:, None] * x * RATE
        flat = row * GATES + g
        for j in range(odds.shape[1]):
            weights[..., j] += np.bincount(flat, weights=step[:, j], minlength=len(n) * GATES).reshape(len(n), GATES)
    return out


@dataclass(frozen=True)
class _Corpus:
    """Learning tokens, distinct ones, and documents."""

    total: int
    distinct: int
    docs: int


@dataclass
class _Choice:
    """A choice at each token: its two predictors, whether there is one, the outcome, the slot in each context, and the gate."""

    first: np.ndarray
    second: np.ndarray
    may: np.ndarray
    outcome: np.ndarray
    slots: list[np.ndarray]
    gate: np.ndarray


def _choice(first: np.ndarray, second: np.ndarray, may: np.ndarray, known: np.ndarray, before: np.ndarray, place: np.ndarray) -> _Choice:
    outcome = (first > second) & may
    log_known = np.minimum(np.log2(known + 1).astype(np.int64), 31)
    log_place = np.minimum(np.log2(place + 1).astype(np.int64), 15)
    recent = _history(outcome, place, 8)
    runs = _ONES[recent]
    slots = [log_known * 8 + (recent & 7), before, runs * 16 + log_place]
    return _Choice(first, second, may, outcome, slots, np.minimum(runs, 2) * 2 + (log_known >= 8))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return sum(groups.joined(table.column(f"{name}{i}"), np.uint8)[0].astype(np.int64) << (8 * i) for i in range(_WIDE[name]))


def _bytes(name: str, numbers: np.ndarray, lengths: np.ndarray) -> dict[str, pa.Array]:
    """A column for each byte of the numbers: high ones are nearly all 0 and shrink to nothing on disk."""
    return {f"{name}{i}": groups.cells((numbers >> (8 * i)).astype(np.uint8), lengths) for i in range(_WIDE[name])}


class _Texts:
    """Some documents as ``_state`` left them, with the choices at their tokens."""

    def __init__(self, table: pa.Table, corpus: _Corpus):
        self.table = table
        n = table.column("n_tokens").to_numpy()
        self.bounds = np.concatenate([[0], np.cumsum(n)])
        self.row = np.repeat(np.arange(len(n)), n)
        learns = ~table.column("held_out").to_numpy().astype(bool)
        learned = learns[self.row]
        self.learns, self.learned, self.fold = learns, learned, table.column("fold").to_numpy()
        count, pair, own, seen, self.before = (_numbers(table, name) for name in _WIDE)
        place = np.arange(len(count)) - self.bounds[:-1][self.row]
        # How often the word before is followed by anything elsewhere: as often as it occurs there; a text's beginning: per document.
        known = np.concatenate([[0], (count - learned * own)[:-1]])
        known[self.bounds[:-1]] = corpus.docs - learns
        uni = (count + 1) / (corpus.total + corpus.distinct + 1)
        bi = np.where(known > 0, np.minimum(pair / np.maximum(known, 1), 1.0), uni)
        self.choices = [_choice(bi, uni, known > 0, known, self.before, place),
                        _choice(seen / np.maximum(place, 1), (bi + uni) / 2, place > 0, place, self.before, place)]

    def outcomes(self) -> tuple[np.ndarray, np.ndarray]:
        """Learned tokens in each slot of both choices' contexts, and those with outcome 1."""
        n, ones = [], []
        for choice in self.choices:
            use = self.learned & choice.may
            for slot, size in zip(choice.slots, _SIZES, strict=True):
                n.append(np.bincount(slot[use], minlength=size))
                ones.append(np.bincount(slot[use & choice.outcome], minlength=size))
        return np.concatenate(n), np.concatenate(ones)

    def _odds(self, k: int, n: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """The contexts' predictions: smoothed share of outcomes of other documents in the token's slot, as log-odds."""
        choice, columns = self.choices[k], []
        use = (self.learned & choice.may).astype(np.float64)
        for j, (slot, size) in enumerate(zip(choice.slots, _SIZES, strict=True)):
            start = _STARTS[k * len(_SIZES) + j]
            if j == 1:
                if k == 0:
                    self._at = np.unique(self.row * size + slot, return_inverse=True)[1]
                at = self._at
            else:
                at = self.row * size + slot
            own, own_ones = np.bincount(at, weights=use), np.bincount(at, weights=use * choice.outcome)
            p = (ones[start + slot] - own_ones[at] + 0.4) / (n[start + slot] - own[at] + 0.8)
            columns.append(np.log(p / (1 - p)).astype(np.float32))
        return np.column_stack(columns)

    def mix(self, n: np.ndarray, ones: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Probability of each token. weights: of each row, choice, gate and context; they are refined in place."""
        corpus = None
        for k, choice in enumerate(self.choices):
            refined = weights[:, k].copy()
            corpus = mixed(choice.first, choice.second if corpus is None else corpus, choice.may, self._odds(k, n, ones), choice.gate, self.bounds, refined)
            weights[:, k] = refined
        return corpus

    def refined(self, n: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """By fold, choice and gate: the sums of refined weights by tokens, and the tokens, as whole numbers."""
        weights = np.broadcast_to(_even(), (self.table.num_rows, *_even().shape)).copy()
        self.mix(n, ones, weights)
        out = np.zeros((FOLDS, *_even().shape[:2], len(_SIZES) + 1), np.int64)
        for k, choice in enumerate(self.choices):
            use = self.learned & choice.may
            tokens = np.bincount(self.row[use] * GATES + choice.gate[use], minlength=self.table.num_rows * GATES).reshape(-1, GATES)
            np.add.at(out[:, k, :, :-1], self.fold, np.rint(weights[:, k] * tokens[..., None] * WHOLE).astype(np.int64))
            np.add.at(out[:, k, :, -1], self.fold, tokens)
        return out

    def scores(self, n: np.ndarray, ones: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """log10 of each row."""
        others = np.where(self.learns[:, None, None, None], sums.sum(axis=0) - sums[self.fold], sums.sum(axis=0))
        weights = (others[..., :-1] / WHOLE + _even()) / (others[..., -1:] + 1)
        log = np.log10(self.mix(n, ones, weights))
        return np.add.reduceat(log, self.bounds[:-1]) if self.table.num_rows else np.empty(0)


def _even() -> np.ndarray:
    return np.full((2, GATES, len(_SIZES)), 1 / len(_SIZES))


def _state(table: pa.Table, word_counts: np.ndarray, pair_counts: np.ndarray, buckets: int, corpus: _Corpus) -> pa.Table:
    """For each row what scores need: of each token its count, that of its pair elsewhere, its own in the text and so far, the word before."""
    tokens, bounds = _tokens(table)
    n, learned = np.diff(bounds), _learning(table, bounds)
    row = np.repeat(np.arange(len(n)), n)
    _, at = np.unique(tokens, return_inverse=True)
    count = word_counts[at] if len(tokens) else np.empty(0, np.int64)
    pairs, before = _pairs(tokens, bounds)
    pairs = groups.shortened(pairs, buckets)
    _, at = np.unique(pairs, return_inverse=True)
    pair_own, _ = _own(pairs, row)
    word_own, seen = _own(tokens, row)
    pair_count = (pair_counts[at] if len(tokens) else np.empty(0, np.int64)) - learned * pair_own
    uni = (count + 1) / (corpus.total + corpus.distinct + 1)
    add = lambda x: np.add.reduceat(x, bounds[:-1]) if len(n) else np.empty(0)
    size = np.array([len((t.as_py() or "").encode()) for t in table.column("text")], dtype=np.int64)
    slot = (before & _U(SLOTS - 1)).astype(np.int64)
    return pa.table({
        "doc": table.column("doc"), "held_out": table.column("held_out"), "fold": table.column("fold"), "n_tokens": pa.array(n.astype(np.int64)),
        "n_known": pa.array(add((count > 0).astype(np.int64)).astype(np.int64)), "base_score": pa.array(add(np.log10(uni)).astype(np.float64)),
        "size": pa.array(size)} | {c: v for name, x in zip(_WIDE, (count, pair_count, word_own, seen, slot), strict=True) for c, v in _bytes(name, x, n).items()})


def _texts(batches: Iterator[pa.RecordBatch], corpus: _Corpus) -> Iterator[_Texts]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        ends = np.cumsum(table.column("n_tokens").to_numpy())
        first = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOKENS, side="right")))
            yield _Texts(table.slice(first, last - first), corpus)
            first = last


def _summed_up(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of rows (place, value), as many places as given, whatever the size of the corpus."""
    rows = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size, np.int64)
    out[[r["i"] for r in rows]] = [r["v"] for r in rows]
    return out


def _placed(numbers: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(numbers)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(numbers[at], pa.int64())], ["i", "v"])


def _corpus(docs: DataFrame, buckets: int) -> _Corpus:

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [part.hashes for part in slices(batch.column("text"), lower=True)]
            hashes = np.concatenate(kept) if kept else np.empty(0, np.uint64)
            keys, counts = np.unique(hashes, return_counts=True)
            table = groups.packed(0, buckets, keys, counts.astype(np.uint32), small=True)
            yield from table.to_batches()

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, _ = groups.unzipped(table.column("keys"), np.uint64)
        counts, _ = groups.unzipped(table.column("v0"), np.uint32)
        return pa.table({"n": [int(counts.sum())], "v": [len(np.unique(keys))]})

    learned = docs.where(~F.col("held_out")).select("text")
    n_docs = learned.count()
    got = learned.mapInArrow(words, groups.send_schema(1)).groupBy("b").applyInArrow(count, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return _Corpus((got[0] or 0) + n_docs, (got[1] or 0) + (n_docs > 0), n_docs)


def score(docs: DataFrame, doc: str = "doc_id", text: str = "text", held_out: str = "held_out") -> DataFrame:
    """doc, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), bits_per_byte of every row."""
    fold = F.pmod(F.xxhash64(F.coalesce(F.col(doc).cast("string"), F.col(text))), F.lit(FOLDS)).cast("int")
    named = docs.select(doc, text, F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), fold.alias("fold"))
    dealt = groups.deal(named, doc, text, "held_out", "fold")
    buckets, by_group = dealt.buckets, dealt.frame.groupBy("g")
    corpus = _corpus(dealt.frame, buckets)

    def pairs_sent(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        tokens, bounds = _tokens(table)
        return _counted(groups.shortened(_pairs(tokens, bounds)[0], buckets), _learning(table, bounds))

    counts = groups.answer(groups.send(dealt, _words_sent, 1, small=True), _summed, [np.uint32], 1, small=True)
    pairs = groups.answer(groups.send(dealt, pairs_sent, 1, short=True, small=True), _summed, [np.uint32], 1, short=True, small=True)
    both = counts.withColumn("step", F.lit(1)).unionByName(pairs.withColumn("step", F.lit(2)))

    def prepare(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        step = answers.column("step").to_numpy()
        first, second = (groups.read(answers.filter(pa.array(step == s)), [np.int64], small=True)[0] for s in (1, 2))
        return _state(table, first, second, buckets, corpus)

    columns = "".join(f", {name}{i} binary" for name, wide in _WIDE.items() for i in range(wide))
    state = materialize(by_group.cogroup(both.groupBy("g")).applyInArrow(
        prepare, "doc long, held_out boolean, fold int, n_tokens long, n_known long, base_score double, size long" + columns), codec="zstd")
    learned = state.where(~F.col("held_out"))

    def outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _STARTS[-1]), np.int64)
        for texts in _texts(batches, corpus):
            total += texts.outcomes()
        yield _placed(total.ravel())

    n, ones = _summed_up(learned.mapInArrow(outcomes, "i int, v long"), 2 * _STARTS[-1]).reshape(2, -1)

    def refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for texts in _texts(batches, corpus):
            total += texts.refined(n, ones)
        yield _placed(total.ravel())

    shape = (FOLDS, 2, GATES, len(_SIZES) + 1)
    sums = _summed_up(learned.mapInArrow(refined, "i int, v long"), math.prod(shape)).reshape(shape)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches, corpus):
            table, score = texts.table, texts.scores(n, ones, sums)
            bits = -score * np.log2(10) / np.maximum(table.column("size").to_numpy(), 1)
            yield from pa.table({
                "doc": table.column("doc"), "held_out": table.column("held_out"), "n_tokens": table.column("n_tokens"), "n_known": table.column("n_known"),
                "train_tokens": pa.array(np.full(table.num_rows, corpus.total, np.int64)), "base_score": table.column("base_score"),
                "score": pa.array(score, pa.float64()), "bits_per_byte": pa.array(bits, pa.float64())}).combine_chunks().to_batches()

    return state.mapInArrow(
        finish, "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
