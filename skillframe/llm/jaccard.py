"""Near-duplicate documents: an exact Jaccard join on word n-grams with adaptive multi-match prefixes.

A document's set is its distinct ``N``-word shingles as 64-bit hashes, in one order for all sets. If two sets link, the prefixes that
leave out all but ``l - 1`` of the shingles they must share have at least l shingles in common, for every l. So a longer prefix
asks for more common shingles.

1. Equal texts are collapsed to the smallest id. Groups of documents send the shingles of their longest prefixes, ordered by hash,
   and learn which occur elsewhere; a document with too few of them has no partner.
   Among those left, the documents of every shingle are counted the same way: what a set shares with any other bounds what it
   shares with one, so a pair whose sizes ask for more is not a candidate. From here on sets are ordered by these counts, so
   that prefixes hold the rarest shingles, and what many documents share stays out of the postings wherever it may.
2. Each document chooses its l by the estimated cost of its candidates (posting lengths, and verifications, which fall with l).
   A longer prefix also lets it leave out its most common shingles: with m of them in the prefix, l - m of the others must match.
3. Leaders: each document is verified against those of its postings that have the least of their own, as an unedited
   original has. Families of copies fall into one component in linear time.
4. Families whose members lie around a leader but partly not near enough to link with it: the members not in its component are
   compared with all others of the family in blocks, as products of 0/1 matrices, which return links only.
5. All remaining pairs: a document probes the postings for sets at least as large, but for those of its own component or family.
   Entries and probes of a posting's largest family do not even meet.
6. Candidates with enough matches are verified on whole sets: 100 * intersection >= 80 * union. Links form components.

Only pairs that are in one component already, or compared already, are ever left out, so no component is lost.

Defined cases: no words or no text: an empty set, linked with nothing; fewer than N words: one shingle, the whole; a row without id
links through equal texts that have one, and has no component otherwise; repeated rows are copies; rows of one id with
different texts are judged one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import groups
from .components import components
from .words import grams, inside, whole

N, SHARE = 5, 80
#: Postings longer than this are left out where a longer prefix allows it; the cost of a verification in posting entries.
COMMON, VERIFY = 64, 200
LEADERS = 3
#: A family needs so many members that share at least half of a union with their leader; block size of their comparison.
FAMILY, BLOCK, COLUMNS = 32, 256, 4096
_U = np.uint64


def least_common(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n must share with a partner."""
    return (SHARE * n + 99) // 100


def longest(n: np.ndarray) -> np.ndarray:
    """Largest l a set of n may choose."""
    return 1 + n // 10


def _sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles sorted within each row, the row of each, set sizes, and a hash of each row's words (0 words: unused)."""
    values, rows, sizes, texts = [], [], [], []
    for part in groups.parts(table, lower=True):
        places, doc = inside(part.bounds, N)
        text = whole(part.hashes, part.bounds)
        short = np.flatnonzero((part.counts > 0) & (part.counts < N))
        value = np.concatenate([grams(part.hashes, N)[places], text[short]])
        doc = np.concatenate([doc, short])
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        values.append(value[new])
        rows.append(doc[new] + part.first)
        sizes.append(np.bincount(doc[new], minlength=len(text)))
        texts.append(text)
    if not sizes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(values), np.concatenate(rows), np.concatenate(sizes), np.concatenate(texts)


def _first_rows(text: np.ndarray, doc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each distinct text that has words, sorted by its hash: its row with the smallest id."""
    order = np.lexsort((doc, text))
    order = order[size[order] > 0]
    return order[np.concatenate([[True], text[order][1:] != text[order][:-1]])] if len(order) else order


def _prefix(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each shingle in its row, and whether it is in the longest prefix."""
    rank = np.arange(len(rows)) - np.concatenate([[0], np.cumsum(sizes)])[:-1][rows] if len(rows) else np.empty(0, np.int64)
    return rank, rank < (sizes - least_common(sizes) + longest(sizes))[rows]


def _asked(table: pa.Table, g: int, buckets: int) -> pa.Table:
    """Distinct prefix shingles and whether two texts of the group have them; and texts with their smallest id, in buckets of their own."""
    values, rows, sizes, text = _sets(table)
    doc = groups.ids(table)
    first = _first_rows(text, doc, sizes)
    once = np.zeros(len(sizes), bool)
    once[first] = True
    _, use = _prefix(rows, sizes)
    keys, counts = np.unique(groups.shortened(values[use & once[rows]], buckets), return_counts=True)
    shingles = groups.packed(g, buckets, keys, (counts > 1).astype(np.uint8), short=True)
    texts = groups.packed(g, buckets, text[first], doc[first])
    b = pa.array(texts.column("b").to_numpy() + np.int32(buckets))
    return pa.concat_tables([shingles, texts.set_column(0, "b", b)])


def _answered(table: pa.Table, b: int, buckets: int) -> pa.Table:
    if b < buckets:
        keys, lengths = groups.joined(table.column("keys"), np.uint32)
        back = _seen_twice(keys, groups.joined(table.column("v0"), np.uint8)[0])[0]
    else:
        keys, lengths = groups.joined(table.column("keys"), np.uint64)
        back = _smallest(keys, groups.joined(table.column("v0"), np.int64)[0])[0]
    return pa.table({"g": table.column("g"), "b": table.column("b"), "r0": groups.cells(back, lengths)})


def _seen_twice(keys: np.ndarray, several: np.ndarray) -> tuple[np.ndarray]:
    _, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = count >= 2
    twice[at[several > 0]] = True
    return (twice[at].astype(np.uint8),)


def _smallest(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray]:
    _, at = np.unique(keys, return_inverse=True)
    least = np.full(int(at.max()) + 1 if len(at) else 0, groups.NO_ID)
    np.minimum.at(least, at, doc)
    return (least[at],)


_BASE = "doc long, n int, rep long, shingles binary"


def _base(table: pa.Table, elsewhere: np.ndarray, smallest: np.ndarray, buckets: int) -> pa.Table:
    values, rows, sizes, text = _sets(table)
    doc = groups.ids(table)
    first = _first_rows(text, doc, sizes)
    known = text[first]
    rep = doc.copy()
    full = sizes > 0
    rep[full] = smallest[np.searchsorted(known, text[full])]
    lists = np.zeros(len(sizes), bool)
    lists[first] = (doc[first] == smallest) & (smallest != groups.NO_ID)  # a text that no id has links with nothing
    _, use = _prefix(rows, sizes)
    once = np.zeros(len(sizes), bool)
    once[first] = True
    keys = groups.shortened(values, buckets)
    sent = np.unique(keys[use & once[rows]])
    shared = sent[elsewhere > 0]
    hit = use & lists[rows]
    at = np.flatnonzero(hit)
    if len(shared):
        spot = np.minimum(np.searchsorted(shared, keys[at]), len(shared) - 1)
        at = at[shared[spot] == keys[at]]
    else:
        at = at[:0]
    # A partner may be smaller, down to the share; its l is what must match at least.
    enough = np.bincount(rows[at], minlength=len(sizes)) >= longest(least_common(sizes))
    at = at[enough[rows[at]]]
    kept = np.zeros(len(sizes), bool)
    kept[rows[at]] = True
    whole_sets = kept[rows]
    count = lambda of: np.bincount(of, minlength=len(sizes))

    def binary(numbers: np.ndarray, of: np.ndarray) -> pa.Array:
        return pa.array([x.as_py() if k else None for x, k in zip(groups.cells(numbers, count(of)), kept, strict=True)], pa.binary())

    return pa.table({
        "doc": table.column("doc"), "n": pa.array(sizes.astype(np.int32)), "rep": pa.array(rep, mask=rep == groups.NO_ID),
        "shingles": binary(values[whole_sets], rows[whole_sets])})


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            tokens, counts = groups.joined(table.column("tokens"), np.int64)
            ranks, _ = groups.joined(table.column("ranks"), np.int32)
            repeat = lambda c: np.repeat(table.column(c).to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), *(pa.array(repeat(c)) for c in ("doc", "n", "s")), pa.array(ranks)], ["token", "doc", "n", "s", "rank"])


def choose(n: int, rank: np.ndarray, length: np.ndarray) -> tuple[int, int, bool]:
    """l, matches asked for, and whether common shingles are left out. rank sorted; length: entries of each posting."""
    offset = n - int(least_common(np.int64(n)))
    options = np.unique(np.linspace(1, int(longest(np.int64(n))), 12).astype(int))
    common = length > COMMON
    best: tuple[float, int, int, bool] | None = None
    for level in options.tolist():
        upto = int(np.searchsorted(rank, offset + level))
        scan, rare = float(length[:upto].sum()), float(length[:upto][~common[:upto]].sum())
        m = int(common[:upto].sum())
        for entries, asked, skip in ((scan, level, False), (rare, level - m, True)):
            if asked >= 1 and (not skip or m):
                cost = entries + VERIFY * entries / asked
                if best is None or cost < best[0]:
                    best = (cost, level, asked, skip)
    return best[1:]  # type: ignore[return-value]


def _shingles(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of listed documents, and which of them each has."""
    values, counts = groups.joined(table.column("shingles"), np.uint64)
    return values, np.repeat(np.arange(table.num_rows), counts)


def _together(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray]:
    _, at = np.unique(keys, return_inverse=True)
    return (np.bincount(at, weights=docs)[at].astype(np.uint32) if len(keys) else docs,)


def support(listed: DataFrame) -> DataFrame:
    """doc, n, s: how many of a listed document's n shingles another listed document has too; and its longest prefix, rarest first.

    tokens, ranks: the prefix's shingles that others have, and their places in the set's order.
    """
    size = listed.select(F.sum("n").alias("n")).first()["n"] or 0
    n_groups, buckets = 1 + 8 * size // groups.GROUP_BYTES, 1 + 6 * size // groups.BUCKET_BYTES
    dealt = listed.select(F.pmod(F.xxhash64("doc"), F.lit(n_groups)).cast("int").alias("g"), "doc", "n", "shingles")

    def ask(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(groups.shortened(_shingles(table)[0], buckets), return_counts=True)
        return keys, counts.astype(np.uint32)

    asked = groups.send(groups.Dealt(dealt, n_groups, buckets), ask, 1, short=True)
    told = groups.answer(asked, _together, [np.uint32], 1, short=True)

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        values, row = _shingles(table)
        short, at = np.unique(groups.shortened(values, buckets), return_inverse=True)
        often = groups.read(answers, [np.uint32])[0][at].astype(np.int64)
        shared = np.bincount(row[often > 1], minlength=table.num_rows)
        # The counts are those of the shortened hashes, so this order is the same in every set.
        order = np.lexsort((values, often, row))
        values, often = values[order], often[order]
        rank, use = _prefix(row, np.bincount(row, minlength=table.num_rows))
        use &= often > 1
        kept = np.bincount(row[use], minlength=table.num_rows)
        return pa.table({
            "doc": table.column("doc"), "n": table.column("n"), "s": pa.array(shared.astype(np.int32)),
            "tokens": groups.cells(values[use], kept), "ranks": groups.cells(rank[use].astype(np.int32), kept)})

    return dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(finish, "doc long, n int, s int, tokens binary, ranks binary")


_CHOSEN = "token long, doc long, n int, s int, prefix int, asked int"


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[np.ndarray, ...]] = []
        for doc, n, s, listed in zip(*(batch.column(c).to_pylist() for c in ("doc", "n", "s", "listed")), strict=True):
            rank, token, length = (np.array([x[c] for x in listed], np.int64) for c in ("rank", "token", "df"))
            level, asked, skip = choose(n, rank, length)
            use = rank < n - int(least_common(np.int64(n))) + level
            if skip:
                use &= length <= COMMON
            count = int(use.sum())
            if count >= asked:
                out.append((token[use], *(np.full(count, x) for x in (doc, n, s, level, asked))))
        if out:
            token, doc, *small = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(doc, pa.int64()), *(pa.array(x, pa.int32()) for x in small)],
                                             ["token", "doc", "n", "s", "prefix", "asked"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared, union = [], []
        for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
            a, b = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
            small, large = (a, b) if len(a) <= len(b) else (b, a)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            shared.append(both)
            union.append(len(a) + len(b) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int32()), pa.array(union, pa.int32())], ["a", "b", "shared", "joint"])


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with the sizes of intersection and union. A set travels once per pair, and never a whole group together."""
    left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left")), "a")
    rows = left.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right")), "b").select("a", "b", "left", "right")
    return rows.mapInArrow(_overlaps, "a long, b long, shared int, joint int")


def _linked(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("shared") * 100 >= F.col("joint") * SHARE).select("a", "b")


def _block_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """Linked pairs between two blocks of sets that are not in one component. The product goes by slices of columns."""
    n, m = left.num_rows, right.num_rows
    (a, row_a), (b, row_b) = _shingles(left), _shingles(right)
    both = np.intersect1d(a, b)
    at = np.searchsorted(both, a)
    hit = both[np.minimum(at, len(both) - 1)] == a if len(both) else np.zeros(len(a), bool)
    at_a, row_a = at[hit], row_a[hit]
    at = np.searchsorted(both, b)
    hit = both[np.minimum(at, len(both) - 1)] == b if len(both) else np.zeros(len(b), bool)
    at_b, row_b = at[hit], row_b[hit]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    at_a, row_a, at_b, row_b = at_a[order_a], row_a[order_a], at_b[order_b], row_b[order_b]
    shared = np.zeros((n, m), np.float32)
    for start in range(0, len(both), COLUMNS):
        x, y = np.zeros((n, COLUMNS), np.float32), np.zeros((m, COLUMNS), np.float32)
        part = slice(*np.searchsorted(at_a, [start, start + COLUMNS]))
        x[row_a[part], at_a[part] - start] = 1
        part = slice(*np.searchsorted(at_b, [start, start + COLUMNS]))
        y[row_b[part], at_b[part] - start] = 1
        shared += x @ y.T
    size = left.column("n").to_numpy()[:, None] + right.column("n").to_numpy()[None, :]
    differ = left.column("label").to_numpy()[:, None] != right.column("label").to_numpy()[None, :]
    i, j = np.nonzero((100 * shared >= SHARE * (size - shared)) & differ)
    return pa.table({"a": left.column("doc").take(pa.array(i)), "b": right.column("doc").take(pa.array(j))})


def _near(compared: DataFrame) -> DataFrame:
    """Families: documents around a leader, near enough to it that two of them may link. Half of the union is ample."""
    return compared.where(F.col("shared") * 2 >= F.col("joint")).select(F.col("a").alias("doc"), F.col("b").alias("family"))


def _around(first_family: DataFrame, large: DataFrame, top: DataFrame, sets: DataFrame) -> DataFrame:
    """(doc, family) of the large families, those with leaders near each other as one. top: a, b, hits, followers."""
    leads = large.select(F.col("family").alias("doc"))
    inner_ring = first_family.join(large, "family")
    # Documents whose own leader has no family, and the leaders themselves, try the most followed leader that has one.
    others = top.join(large.select(F.col("family").alias("b")), "b").join(inner_ring.select(F.col("doc").alias("a")).join(leads.select(F.col("doc").alias("a")), "a", "left_anti"), "a", "left_anti")
    most = Window.partitionBy("a").orderBy(F.desc("followers"), F.desc("hits"), "b")
    tried = materialize(_near(_compared(others.withColumn("k", F.row_number().over(most)).where(F.col("k") == 1).select("a", "b"), sets)))
    rings = inner_ring.join(leads, "doc", "left_anti").unionByName(tried.join(leads, "doc", "left_anti")).unionByName(leads.withColumn("family", F.col("doc")))
    merged = components(tried.join(leads, "doc").select(F.col("doc").alias("a"), F.col("family").alias("b"))).select(
        F.col("doc").alias("family"), F.col("label").alias("root"))
    return rings.join(merged, "family", "left").select("doc", F.coalesce("root", "family").alias("family")).distinct()


def _family_links(members: DataFrame) -> DataFrame:
    """members: doc, n, shingles, label, family, main (label of the family's leader). Links that the leader does not explain."""
    outside = F.col("label") != F.col("main")
    counts = members.groupBy("family").agg(F.count("*").alias("all"), F.count_if(outside).alias("open")).where(F.col("open") > 0)
    dealt = members.join(counts, "family").withColumn("h", F.xxhash64("doc"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    own = lambda c: F.pmod("h", blocks(c)).cast("int")
    kept = ["doc", "n", "shingles", "label", "family"]
    fresh = lambda: [F.col(c).alias(c) for c in kept]  # noqa: E731  two sides of one lineage need columns of their own
    left = dealt.where(outside).select(*fresh(), own("open").alias("i"), each("all").alias("j"))
    right = dealt.select(*fresh(), own("all").alias("j"), each("open").alias("i"))

    def compare(key: tuple[pa.Scalar, ...], one: pa.Table, other: pa.Table) -> pa.Table:
        return _block_links(one, other)

    keys = ["family", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "a long, b long")


def _fits(*supports: str) -> Column:
    """Whether sets of sizes n and bn can share enough: at most what each shares with anything."""
    return (F.col("n") + F.col("bn")) * SHARE <= F.least(*supports) * (100 + SHARE)


def link(base: DataFrame) -> DataFrame:
    """Links (a, b) between different texts, enough to connect every component. base: as ``_base`` gives it."""
    listed = base.where(F.col("shingles").isNotNull())
    sets = listed.select("doc", "shingles")
    # A set that shares less than this with all others together links with none.
    known = materialize(support(listed).where(F.col("s") * 100 >= F.col("n") * SHARE))
    raw = materialize(known.mapInArrow(_postings, "token long, doc long, n int, s int, rank int"))
    df = raw.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    index = materialize(raw.join(df, "token"))
    chosen = materialize(
        index.groupBy("doc", "n", "s").agg(F.sort_array(F.collect_list(F.struct("rank", "token", "df"))).alias("listed"))
        .mapInArrow(_choices, _CHOSEN))
    # Leaders: the documents of a posting with the smallest share of shingles of their own.
    first = Window.partitionBy("token").orderBy((F.col("n") - F.col("s")) / F.col("n"), F.xxhash64("doc"), "doc")
    leaders = index.withColumn("k", F.row_number().over(first)).where(F.col("k") <= LEADERS).select(
        "token", F.col("doc").alias("b"), F.col("n").alias("bn"), F.col("s").alias("bs"))
    led = (chosen.join(leaders, "token").where((F.col("doc") != F.col("b")) & _fits("s", "bs"))
           .groupBy(F.col("doc").alias("a"), "b").agg(F.count("*").alias("hits")))
    # Among leaders with about as many hits the best known one comes first, so that a family agrees on its leader.
    followers = led.groupBy("b").agg(F.count("*").alias("followers"))
    best = Window.partitionBy("a").orderBy(F.desc(F.col("hits") * 2 >= F.col("most")), F.desc("followers"), F.desc("hits"), "b")
    top = materialize(led.join(followers, "b").withColumn("most", F.max("hits").over(Window.partitionBy("a"))).withColumn("k", F.row_number().over(best)))
    led_by = materialize(_compared(top.where(F.col("k") == 1).select("a", "b"), sets))
    links = _linked(led_by)
    # The other leaders at once, and only for those that the first has not taken: a step of its own for each costs more than its pairs.
    left = top.where(F.col("k").between(2, LEADERS)).select("a", "b").join(links.select("a").distinct(), "a", "left_anti")
    links = materialize(links.unionByName(_linked(_compared(left, sets))))
    label = components(links)
    first_family = _near(led_by)
    large = materialize(first_family.groupBy("family").count().where(F.col("count") >= FAMILY).select("family"))
    families = not large.isEmpty()
    around = _around(first_family, large, top, sets) if families else large.select(F.col("family").alias("doc"), "family")
    named = materialize(
        known.select("doc", "n").distinct().join(label, "doc", "left").join(around, "doc", "left")
        .select("doc", "n", F.coalesce("label", "doc").alias("label"), F.coalesce("family", "doc").alias("family")))
    if families:
        large = around.select("family").distinct()
        mains = named.where(F.col("doc") == F.col("family")).select("family", F.col("label").alias("main")).distinct()
        members = named.join(large, "family").join(mains, "family").join(sets, "doc")
        links = materialize(links.unionByName(_family_links(members)))
    # All other pairs, by the postings. The smaller set probes, so it must share enough for a partner of its own size at least.
    placed = named.select("doc", "label", "family").distinct()
    entries, probes = (t.join(placed, "doc") for t in (index, chosen.where(F.col("n") * (2 * SHARE) <= F.col("s") * (100 + SHARE))))
    one_of = lambda c: entries.groupBy("token", c).count().groupBy("token").agg(F.max_by(c, F.struct("count", c)).alias("main"), F.count("*").alias("several"))
    # Postings within one component hold nothing new.
    open_tokens = materialize(
        one_of("family").select("token", "main").join(one_of("label").where(F.col("several") > 1).select("token"), "token"))
    entries = entries.join(open_tokens, "token").select(
        "token", F.col("doc").alias("b"), F.col("n").alias("bn"), F.col("s").alias("bs"), "rank", F.col("label").alias("bl"), F.col("family").alias("bf"), "main")
    probes = probes.join(open_tokens, "token").select(
        "token", F.col("doc").alias("a"), "n", "s", "prefix", "asked", F.col("label").alias("al"), F.col("family").alias("af"), F.col("main").alias("amain"))
    allowed = F.col("rank") < F.col("bn") - F.floor((F.col("bn") * SHARE + 99) / 100) + F.col("prefix")
    larger = (F.col("bn") > F.col("n")) | ((F.col("bn") == F.col("n")) & (F.col("b") > F.col("a")))
    cross = allowed & larger & _fits("s", "bs") & (F.col("al") != F.col("bl")) & (F.col("af") != F.col("bf"))
    outer = probes.where(F.col("af") != F.col("amain")).join(entries, "token").where(cross)
    inner = probes.where(F.col("af") == F.col("amain")).join(entries.where(F.col("bf") != F.col("main")), "token").where(cross)
    keep = ["a", "b", "asked"]
    pairs = outer.select(*keep).unionByName(inner.select(*keep)).groupBy("a", "b").agg(F.count("*").alias("hits"), F.first("asked").alias("asked"))
    rest = materialize(_linked(_compared(pairs.where(F.col("hits") >= F.col("asked")).select("a", "b"), sets)))
    return links.unionByName(rest)


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc, n_shingles, component_id (smallest id reachable by links, itself included)."""
    dealt = groups.deal(docs, doc, text)
    buckets, by_group = dealt.buckets, dealt.frame.groupBy("g")

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _asked(table, key[0].as_py(), buckets)

    def tell(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _answered(table, key[0].as_py(), buckets)

    told = by_group.applyInArrow(ask, groups.send_schema(1)).groupBy("b").applyInArrow(tell, "g int, b int, r0 binary")

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = answers.column("b").to_numpy() >= buckets
        first, second = (groups.read(answers.filter(pa.array(of)), [k])[0] for of, k in ((~texts, np.uint8), (texts, np.int64)))
        return _base(table, first, second, buckets)

    base = materialize(by_group.cogroup(told.groupBy("g")).applyInArrow(finish, _BASE))
    label = components(link(base)).select(F.col("doc").alias("rep"), "label")
    return base.select("doc", "n", "rep").join(label, "rep", "left").select(
        "doc", F.col("n").cast("long").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))


def keep_first(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; rows without id stay."""
    found = near_duplicates(docs, doc, text)
    gone = found.where(F.col("doc") != F.col("component_id")).select(F.col("doc").alias(doc)).distinct()
    return docs.join(gone, doc, "left_anti")
