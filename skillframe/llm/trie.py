"""The prefix trie of conversations: every distinct sequence of first turns is a node, with what its subtree holds.

A turn is known by a 128-bit digest of its role and text, so texts are read once and never shuffled. A conversation is the row
of a matrix of turn ids, padded with 0. Conversations are dealt into shards by ranges of their whole sequence (then id), so a
node's conversations stand next to each other, and copies of one text, however many, may fill several shards.

In a shard: numpy's lexsort orders the rows, in slabs of ``SLAB`` columns so that one long conversation pads nobody else; the
change masks of neighbouring rows, OR-accumulated along the columns, say from which depth on a row starts nodes of its own;
``reduceat`` sums every depth over the runs between starts. A row's share of every sum needs only what it has in common with
the rows before and after it. For a shard's first and last row these are the neighbouring shards' rows, so all sums add up
over shards: nodes that go on in a neighbour are sent under a digest of their prefix, and grouped again.

Defined cases: turns are ordered by turn (null first), then digest; a null role or text counts as empty; rows without a
conversation id take no part; repeated rows are turns of their own; an empty table gives no nodes; further columns are ignored.
A conversation is one row of the matrix (20 bytes a turn), so it must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import groups

SHARD_BYTES, SLAB = 4 << 20, 16
#: Ids in one cell of a list that goes on in other shards.
CELL = 512
DIGEST = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, t: array of (digest, size) in order; size: UTF-8 bytes of the text."""
    said_by, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(said_by).cast("string"), F.lit(":"), said_by, said).cast("binary"))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(said).alias("size")).alias("x"))
    return rows.groupBy("conv").agg(F.transform(
        F.sort_array(F.collect_list("x")), lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("t"))


def branched(made: DataFrame, heads: int, keep: int) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % heads; h = crc32 of c in decimal, modulo keep."""
    made = materialize(made)
    h = F.expr(f"cast(crc32(cast(cast(conv AS string) AS binary)) % {keep} AS int)")
    head = made.where(F.col("conv") % heads == 0).select(F.col("conv").alias("base"), F.slice("t", 1, keep - 1).alias("first"))
    none = F.slice("t", 1, 0)
    both = made.withColumn("base", F.col("conv") - F.col("conv") % heads).join(head, "base", "left").withColumn("h", h)
    return both.select("conv", F.concat(F.slice(F.coalesce("first", none), F.lit(1), F.col("h")), F.slice("t", F.col("h") + 1, F.size("t"))).alias("t"))


def dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Digests as small numbers from 1 in the digests' order."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), np.int64)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new)
    return ids


def padded(ids: np.ndarray, first: np.ndarray, length: np.ndarray, start: int) -> np.ndarray:
    """Columns start to start + SLAB of the rows, padded with 0."""
    column = start + np.arange(SLAB)
    inside = column[None, :] < length[:, None]
    return np.where(inside, ids[np.minimum(first[:, None] + column[None, :], max(len(ids) - 1, 0))], 0) if len(ids) else np.zeros(inside.shape, np.int64)


def order_rows(ids: np.ndarray, first: np.ndarray, length: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows by their turn ids, shorter first, then by conversation."""
    n = len(length)
    rank = np.zeros(n, np.int64)  # where a row's equals so far begin
    for start in range(0, int(length.max(initial=0)), SLAB):
        many = np.bincount(rank, minlength=n)[rank] > 1
        at = np.flatnonzero(many & (length > start))
        if not len(at):
            break
        ended = np.bincount(rank[many & (length <= start)], minlength=n)  # they come before those that go on
        matrix = padded(ids, first[at], length[at], start)
        old = rank[at]
        by = np.lexsort(np.vstack([matrix[:, ::-1].T, old]))
        matrix, old, at = matrix[by], old[by], at[by]
        split = np.ones(len(at), bool)
        split[1:] = old[1:] != old[:-1]
        fresh = split.copy()
        fresh[1:] |= (matrix[1:] != matrix[:-1]).any(axis=1)
        place = np.arange(len(at))
        place -= np.maximum.accumulate(np.where(split, place, 0))
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        rank[at] = old + ended[old] + place[begin]
    return np.lexsort((conv, rank))


def in_common(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many first turns each row has in common with the row before it; rows in order."""
    common = np.zeros(len(length), np.int64)
    at = np.arange(1, len(length))
    for start in range(0, int(length.max(initial=0)), SLAB):
        at = at[(length[at] > start) & (length[at - 1] > start)]
        if not len(at):
            break
        changed = padded(ids, first[at], length[at], start) != padded(ids, first[at - 1], length[at - 1], start)
        changed |= start + np.arange(SLAB)[None, :] >= np.minimum(length[at], length[at - 1])[:, None]
        mask = np.logical_or.accumulate(changed, axis=1)
        common[at] += (~mask).sum(axis=1)
        at = at[~mask[:, -1]]
    return common


def shared_turns(one: bytes | None, other: bytes | None) -> int:
    """Turns two packed sequences begin with in common; -1 where one is missing."""
    if one is None or other is None:
        return -1
    n = min(len(one), len(other)) // DIGEST
    a, b = (np.frombuffer(x, f"V{DIGEST}", count=n) for x in (one, other))
    differ = np.flatnonzero(a != b)
    return int(differ[0]) if len(differ) else n


def prefix_keys(sequence: bytes, depth: int) -> list[bytes]:
    """Digests of the first 0, 1 ... depth turns."""
    running = hashlib.md5(usedforsecurity=False)
    keys = [running.digest()]
    for d in range(depth):
        running.update(sequence[d * DIGEST : (d + 1) * DIGEST])
        keys.append(running.digest())
    return keys


_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, node binary, parent binary, shard int, ids binary")
_NUMBERS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _joined_ids(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _nodes(shard: int, table: pa.Table, before: bytes | None, after: bytes | None) -> pa.Table:
    """Nodes of a shard. Those with a ``node`` digest go on in a neighbour; rows with ``ids`` hold only a part of a node's ends."""
    flat, lengths = groups.joined(table.column("seq"), np.dtype(">u8"))
    length = lengths // 2
    sizes = table.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(length) - length
    ids = dense(flat[0::2].astype(np.uint64), flat[1::2].astype(np.uint64))
    conv = table.column("conv").to_numpy()
    order = order_rows(ids, first, length, conv)
    first, length, conv = first[order], length[order], conv[order]
    n = len(order)
    # upto[k]: bytes of all turns before turn k of the shard, so that differences give the bytes between two depths.
    upto = np.concatenate([[0], np.cumsum(sizes)])
    common = in_common(ids, first, length)
    sequence = [table.column("seq")[int(order[k])].as_py() for k in (0, n - 1)]
    left, right = shared_turns(before, sequence[0]), shared_turns(sequence[1], after)
    common[0] = left
    leaf = np.append(common[1:], right) < length
    keys = prefix_keys(sequence[0], left), prefix_keys(sequence[1], right)

    out: dict[str, list[np.ndarray]] = {c: [] for c in _NUMBERS}
    ends: list[str | None] = []
    node: list[bytes | None] = []
    parent: list[bytes | None] = []
    parts: list[tuple[bytes, bytes]] = []
    above, chain = np.full(n, -1, np.int64), np.zeros(n, np.int8)  # per row: the parent's least id, and whose chain it is in
    alive = np.arange(n)
    for depth in range(int(length.max(initial=0)) + 1):
        alive = alive[length[alive] >= depth]
        reach = common[alive]
        start = reach < depth
        start[0] |= alive[0] == 0  # a shard's first row starts runs here, if not nodes
        starts = np.flatnonzero(start)
        many = np.diff(np.append(starts, len(alive)))
        least = np.minimum.reduceat(conv[alive], starts)
        ended = np.add.reduceat(length[alive] == depth, starts, dtype=np.int64)
        kids = np.add.reduceat((reach <= depth) & (length[alive] > depth), starts, dtype=np.int64)
        # What a row repeats of this depth and below: the bytes from here to where it leaves the row before it.
        at = first[alive]
        repeated = np.where(reach >= depth, upto[at + np.maximum(reach, 0)] - upto[at + max(depth - 1, 0)], 0)
        out["conv_id"].append(least)
        out["depth"].append(np.full(len(starts), depth))
        out["parent_conv_id"].append(above[alive[starts]])
        out["n_convs"].append(many)
        out["n_children"].append(kids)
        out["n_leaves"].append(np.add.reduceat(leaf[alive], starts, dtype=np.int64))
        out["saved_tokens"].append(np.add.reduceat(repeated, starts))
        named: list[bytes | None] = [None] * len(starts)
        own = np.zeros(len(starts), np.int8)
        if depth <= left and alive[0] == 0:
            named[0], own[0] = keys[0][depth], 1
        if depth <= right and alive[-1] == n - 1:
            named[-1], own[-1] = keys[1][depth], 2
        node += named
        up = chain[alive[starts]]
        parent += [keys[c - 1][depth - 1] if c else None for c in up.tolist()] if up.any() else [None] * len(starts)
        digests: list[str | None] = [None] * len(starts)
        for k in np.flatnonzero(ended).tolist():
            members = conv[alive[starts[k] : starts[k] + ended[k]]]
            if named[k] is None:
                digests[k] = hashlib.sha256(_joined_ids(members)).hexdigest()
            else:
                parts += [(named[k], members[c : c + CELL].astype(np.int64).tobytes()) for c in range(0, len(members), CELL)]
        ends += digests
        above[alive], chain[alive] = np.repeat(least, many), np.repeat(own, many)
    extra, rows = len(parts), len(node)
    made = {c: pa.array(np.concatenate([*v, np.arange(extra) if c == "n_convs" else np.zeros(extra, np.int64)]).astype(np.int64)) for c, v in out.items()}
    made["parent_conv_id"] = pa.array(made["parent_conv_id"].to_numpy(), mask=made["depth"].to_numpy() == 0)
    return pa.table({
        **made, "ends_sha256": pa.array(ends + [None] * extra, pa.string()), "node": pa.array(node + [k for k, _ in parts], pa.binary()),
        "parent": pa.array(parent + [None] * extra, pa.binary()), "shard": pa.array(np.full(rows + extra, shard, np.int32)),
        "ids": pa.array([None] * rows + [x for _, x in parts], pa.binary())})


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of id lists that come in order, cell by cell; nothing but the running digest is kept."""
    key, running = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if node == key:
                running.update(b",")
            else:
                if key is not None:
                    done.append((key, running.hexdigest()))
                key, running = node, hashlib.sha256()
            running.update(_joined_ids(np.frombuffer(ids, np.int64)))
        yield _digests(done)
    if key is not None:
        yield _digests([(key, running.hexdigest())])


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([x for _, x in rows], pa.string())], ["node", "ends"])


def prefix_trie(made: DataFrame) -> DataFrame:
    """made: (conv, t) as ``sequences`` gives it, one row per conversation. One row per node of the trie:

    conv_id (least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens (bytes that
    the subtree's nodes would save if each were kept once) and ends_sha256 (of the ids that end here, ascending, with commas).
    """
    packed = materialize(made.select(
        "conv", F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), "")).alias("seq"), F.transform("t", lambda x: x["size"]).alias("sizes")))
    total = packed.agg(F.sum(F.octet_length("seq") + 2 * DIGEST).alias("n")).first()["n"] or 0
    sharded = materialize(packed.repartitionByRange(1 + total // SHARD_BYTES, "seq", "conv").withColumn("shard", F.spark_partition_id()))
    edges = sharded.groupBy("shard").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    by = Window.orderBy("shard")  # two sequences per shard
    edges = edges.select("shard", F.lag("high").over(by).alias("before"), F.lead("low").over(by).alias("after"))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table, edge: pa.Table) -> pa.Table:
        return _nodes(key[0].as_py(), table, edge.column("before")[0].as_py(), edge.column("after")[0].as_py())

    found = materialize(sharded.groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(run, _NODE))
    nodes, shared = found.where(F.col("node").isNull()), found.where(F.col("node").isNotNull() & F.col("ids").isNull())
    cells = found.where(F.col("ids").isNotNull()).select("node", "shard", F.col("n_convs").alias("k"), "ids")
    ends = cells.repartition("node").sortWithinPartitions("node", "shard", "k").mapInArrow(_ends, "node binary, ends string")
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    whole = materialize(
        shared.groupBy("node", "depth", "parent").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in sums))
        .join(ends, "node", "left"))
    columns = ["conv_id", "depth", "parent_conv_id", *sums, "ends_sha256", "parent"]
    rows = nodes.select(*columns).unionByName(whole.withColumn("parent_conv_id", F.lit(None).cast("long")).withColumn("ends_sha256", F.col("ends")).select(*columns))
    names = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("least"))
    # Only children of nodes that go on in other shards meet those; the others know their parent.
    below = rows.where(F.col("parent").isNotNull()).join(names, "parent", "left").withColumn("parent_conv_id", F.col("least"))
    return rows.where(F.col("parent").isNull()).select(*columns[:-1]).unionByName(below.select(*columns[:-1])).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
