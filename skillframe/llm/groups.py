"""Questions about keys that many documents share, asked by groups of documents instead of row by row.

Documents are dealt by hash of their id into groups of a few megabytes of text. A group sends each of its distinct keys once
(64-bit hashes, packed into one binary cell per bucket of keys), so a key that is everywhere costs one entry per group and
not one per occurrence. A bucket combines the entries of all groups and answers each group in the same order. The group then
meets its texts again, makes the same keys again and reads the answers beside them. Plans use one and the same ``dealt``
frame each time, so its shuffle is planned once and reused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Slice, slices

GROUP_BYTES, BUCKET_BYTES = 4 << 20, 12 << 20
_U = np.uint64
NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Dealt:
    """frame: g, doc (long), text and further columns; groups and buckets: how many."""

    frame: DataFrame
    groups: int
    buckets: int


def deal(docs: DataFrame, doc: str = "doc_id", text: str = "text", *more: str) -> Dealt:
    size = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    groups, buckets = 1 + size // GROUP_BYTES, 1 + size // BUCKET_BYTES
    key = F.xxhash64(F.coalesce(F.concat(F.lit("i"), F.col(doc).cast("string")), F.col(text)))
    frame = docs.select(F.pmod(key, F.lit(groups)).cast("int").alias("g"), F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"), *more)
    return Dealt(frame, groups, buckets)


def ids(table: pa.Table) -> np.ndarray:
    """The ids as numbers; a missing one is larger than all."""
    return table.column("doc").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def parts(table: pa.Table, lower: bool) -> Iterator[Slice]:
    return slices(table.column("text"), lower)


def joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a column of binary cells, and how many each cell holds."""
    array = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    data = array.buffers()[2] if len(array) else None
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return np.frombuffer(raw.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def cells(numbers: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary cells of so many numbers each."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32) * numbers.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


def zipped(numbers: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Cells as ``cells`` makes them, compressed byte plane by byte plane: for exchanges that would fill the disk."""
    out, wide, ends = [], numbers.dtype.itemsize, np.cumsum(lengths)
    for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
        planes = np.ascontiguousarray(numbers[end - n : end]).view(np.uint8).reshape(n, wide).T.tobytes()
        out.append(n.to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True))
    return pa.array(out, pa.binary())


def unzipped(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``joined`` gives, of cells that ``zipped`` made."""
    wide, parts, lengths = np.dtype(kind).itemsize, [np.empty(0, kind)], []
    for cell in column.to_pylist():
        n = int.from_bytes(cell[:4], "little")
        planes = np.frombuffer(pa.decompress(cell[4:], n * wide, codec="zstd", asbytes=True), np.uint8)
        parts.append(np.ascontiguousarray(planes.reshape(wide, n).T).view(kind).ravel())
        lengths.append(n)
    return np.concatenate(parts), np.array(lengths, np.int64)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """keys sorted. The buckets that occur, and the number of keys in each; the order of buckets is that of keys."""
    of = ((keys >> _U(32)) * _U(buckets)) >> _U(32)
    found, counts = np.unique(of, return_counts=True)
    return found.astype(np.int32), counts


def short_shift(buckets: int) -> int:
    """Low bits to leave off so that a key's place within its bucket fits 32 bits; about 21 bits of them tell apart what meets there."""
    return 32 - (buckets.bit_length() - 1)


def shortened(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> _U(short_shift(buckets))) << _U(short_shift(buckets))


def packed(g: int, buckets: int, keys: np.ndarray, *values: np.ndarray, short: bool = False, small: bool = False) -> pa.Table:
    """One row per bucket: b, g, keys and values (v0, v1 ...) as binary cells. keys sorted and distinct.

    short: keys that went through ``shortened``; they are sent as their places within the bucket, four bytes each.
    small: cells are compressed (``zipped``), here and in ``send``, ``answer`` and ``read``.
    """
    made = zipped if small else cells
    b, counts = by_bucket(keys, buckets)
    if short:
        base = np.array([(-(-(int(x) << 32) // buckets)) << 32 for x in b], dtype=np.uint64)
        keys = ((keys - np.repeat(base, counts)) >> _U(short_shift(buckets))).astype(np.uint32)
    return pa.table({"b": pa.array(b), "g": pa.array(np.full(len(b), g, np.int32)), "keys": made(keys, counts),
                     **{f"v{i}": made(v, counts) for i, v in enumerate(values)}})


def send_schema(values: int) -> str:
    return "b int, g int, keys binary" + "".join(f", v{i} binary" for i in range(values))


def send(dealt: Dealt, make: Callable[[pa.Table], tuple[np.ndarray, ...]], values: int, short: bool = False, small: bool = False) -> DataFrame:
    """make(texts) returns sorted distinct keys and ``values`` arrays beside them."""
    buckets = dealt.buckets

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return packed(key[0].as_py(), buckets, *make(table), short=short, small=small)

    return dealt.frame.groupBy("g").applyInArrow(run, send_schema(values))


def answer(sent: DataFrame, combine: Callable[..., tuple[np.ndarray, ...]], kinds: list[type], answers: int, short: bool = False, small: bool = False) -> DataFrame:
    """combine(keys, *values) gets a bucket's entries, those of one key in any order, and returns arrays beside them (r0, r1 ...)."""

    made, got = (zipped, unzipped) if small else (cells, joined)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, lengths = got(table.column("keys"), np.uint32 if short else np.uint64)
        back = combine(keys, *(got(table.column(f"v{i}"), k)[0] for i, k in enumerate(kinds)))
        return pa.table({"g": table.column("g"), "b": table.column("b"), **{f"r{i}": made(r, lengths) for i, r in enumerate(back)}})

    return sent.groupBy("b").applyInArrow(run, "g int, b int" + "".join(f", r{i} binary" for i in range(answers)))


def read(answers: pa.Table, kinds: list[type], small: bool = False) -> list[np.ndarray]:
    """A group's answers in the order of its sorted keys."""
    answers = answers.take(pa.array(np.argsort(answers.column("b").to_numpy(), kind="stable")))
    return [(unzipped if small else joined)(answers.column(f"r{i}"), k)[0] for i, k in enumerate(kinds)]
