"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made.

A text's symbols are its characters, a space being U+2581; a character without a piece of its own stands for its UTF-8 bytes.
The adjacent pair of lowest rank is popped again and again and merged in the linked list, the leftmost first among equals.
The count is the number of initial symbols less the number of merges.

No piece holds a space mark after another character (checked when the vocabulary is read), so no merge crosses the place
where a run of spaces begins, and a text is the sum of its units: a run of spaces with the word after it. A task remembers the
counts of short units, so a word costs its merges once per task. There is no shuffle, and a lost task is simply run again.

Defined cases: a null or empty text has no tokens; control pieces inside a text are ordinary characters; no begin or end
piece, no truncation; a row without id, repeated rows: counted as they are; an empty table gives no rows; other columns are left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Units a task remembers, and the longest of them: at most some 30 MB.
REMEMBERED, LONGEST = 200_000, 32


@dataclass(frozen=True)
class Vocabulary:
    """ranks: pieces that merges may make, lower first."""

    ranks: dict[str, float]


def read_pieces(path: str) -> Vocabulary:
    """A byte-pair vocabulary with byte fallback as sentencepiece keeps it; read on the driver, a few hundred kilobytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = range(model.get_piece_size())
    if sum(model.is_byte(i) for i in pieces) != 256 or any(model.is_unused(i) for i in pieces):
        raise ValueError("only vocabularies with byte fallback and without unused pieces are counted")
    if model.normalize(" ﬁ  Å ") != f"{SPACE * 2}ﬁ{SPACE * 2}Å{SPACE}":
        raise ValueError("only vocabularies that leave characters as they are and lead with one space are counted")
    ranks = {model.id_to_piece(i): -model.get_score(i) for i in pieces
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    if any(SPACE in piece.lstrip(SPACE) for piece in ranks):
        raise ValueError("a piece goes on after a space; units could not be counted one by one")
    return Vocabulary(ranks)


def merges(symbols: list[str], ranks: dict[str, float]) -> int:
    """How many merges the symbols allow. ``symbols`` is used up."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        pair = symbols[i] + symbols[i + 1]
        if pair in ranks:
            heap.append((ranks[pair], i, len(pair)))
    heapify(heap)
    merged = 0
    while heap:
        _, i, size = heappop(heap)
        j = after[i]
        # A pair only ever grows at its place, so one of another size is out of date.
        if not symbols[i] or j == n or len(symbols[i]) + len(symbols[j]) != size:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        merged += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            pair = symbols[i] + symbols[k]
            if pair in ranks:
                heappush(heap, (ranks[pair], i, len(pair)))
        k = before[i]
        if k >= 0:
            pair = symbols[k] + symbols[i]
            if pair in ranks:
                heappush(heap, (ranks[pair], k, len(pair)))
    return merged


def count_unit(unit: str, ranks: dict[str, float]) -> int:
    symbols = list(unit)
    initial = sum(1 if c in ranks else len(c.encode("utf-8", "surrogatepass")) for c in symbols)
    return initial - merges(symbols, ranks)


class _Counts(dict):
    """Counts of units, made when they are first asked for."""

    def __init__(self, ranks: dict[str, float]) -> None:
        self.ranks = ranks

    def __missing__(self, unit: str) -> int:
        count = count_unit(unit, self.ranks)
        if len(unit) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = count
        return count


def count_text(text: str, counts: _Counts) -> int:
    if not text:
        return 0
    return sum(map(counts.__getitem__, _UNIT.findall(SPACE + text.replace(" ", SPACE))))


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc (as given), n_bytes (UTF-8), n_tokens."""
    ranks = docs.sparkSession.sparkContext.broadcast(vocabulary.ranks)  # as large as the vocabulary, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(ranks.value)
        for batch in batches:
            n = [count_text(cell.as_py() or "", counts) for cell in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, n_bytes long, n_tokens long")
