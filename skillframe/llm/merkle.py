"""A Merkle manifest of a table: trees of three children over its rows, a proof per row, and a check against the root.

Every source has a tree over its leaves in order; the trees' roots are the leaves of one more tree. Nodes are kept by
content: a record of the store says of a digest which digests are its children, its children's children, and so on for
``HEIGHT`` levels, so that equal subtrees are one record and a lookup goes down ``HEIGHT`` levels.

Leaves are numbered in parallel: ranges of the order, then a running count per range. Trees are built from below, a record of
up to 3^HEIGHT nodes a task at a time. Proofs come from above: requests that share the leading digits of their rank in base 3
go down together, record by record, joining the digest they stand on; the children that the digits do not select are
the siblings, and each record's part of the path is reversed, so that the whole runs from the leaf to the root. The paths of a
row are never shuffled: they are made where the last record meets its rows.

Defined cases: a null field is ``-``; rows without an id come first in their source; equal ids go by leaf digest, repeated rows
are leaves of their own; a null source is a source, the first; a tree of one leaf is that leaf; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize

FAN, HEIGHT = 3, 6
RANGE_ROWS = 100_000
Step = tuple[str, int]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*fields: Column) -> Column:
    """Digest of a row's fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    told = [F.coalesce(F.concat(F.octet_length(x.cast("string")).cast("string"), F.lit(":"), x.cast("string")), F.lit("-")) for x in fields]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with rank (from 0, by ``order`` within ``group``) and n (rows of the group). A hot group is spread over ranges.

    The last column of ``order`` should tell rows apart, so that ranges can be cut anywhere.
    """
    ranges = 1 + rows.count() // RANGE_ROWS
    dealt = materialize(rows.repartitionByRange(ranges, group, *order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy(group, "_range").agg(F.count("*").alias("_rows"))
    by = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(group, "_range", F.coalesce(F.sum("_rows").over(by), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy(group)).alias("n"))
    place = F.row_number().over(Window.partitionBy("_range", group).orderBy(*order)) - 1
    return dealt.withColumn("_place", place).join(before, [group, "_range"]).withColumn(
        "rank", F.col("_before") + F.col("_place")).drop("_range", "_place", "_before")


def levels(n: Column) -> Column:
    """Levels above n leaves: the least k with 3^k >= n."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k).cast("long") for k in range(39)]), lambda x: x < n))


def wide(height: Column) -> Column:
    """3^height."""
    return F.element_at(F.array(*[F.lit(FAN**k).cast("long") for k in range(39)]), height + 1)


def record(digests: list[str], height: int) -> tuple[str, list[list[str]]]:
    """The node ``height`` levels above some digests, and all levels below it from the top."""
    kids: list[list[str]] = []
    for _ in range(height):
        kids.append(digests)
        digests = [digest("".join(digests[i : i + FAN])) for i in range(0, len(digests), FAN)]
    return digests[0], kids[::-1]


_RECORD = "tree string, at long, left int, n long, digest string, height int, kids array<array<string>>"


def _built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    tree, block = (k.as_py() for k in key)
    table = table.sort_by("at")
    height, left, n = (table.column(c)[0].as_py() for c in ("height", "left", "n"))
    top, kids = record(table.column("digest").to_pylist(), height)
    return pa.table({
        "tree": pa.array([tree], pa.string()), "at": pa.array([block], pa.int64()), "left": pa.array([left - height], pa.int32()), "n": pa.array([n], pa.int64()),
        "digest": [top], "height": pa.array([height], pa.int32()), "kids": pa.array([kids], pa.list_(pa.list_(pa.string())))})


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """leaves: (tree, rank, n, leaf). Roots (tree, n, digest) and the store (digest, height, kids)."""
    level = leaves.select("tree", F.col("rank").alias("at"), levels(F.col("n")).alias("left"), "n", F.col("leaf").alias("digest"))
    top = leaves.agg(F.max(levels(F.col("n"))).alias("k")).first()["k"] or 0
    roots, store = level.where(F.col("left") == 0).select("tree", "n", "digest"), None
    for _ in range(-(-top // HEIGHT)):
        height = F.least("left", F.lit(HEIGHT))
        below = level.where(F.col("left") > 0).withColumn("height", height).withColumn("block", F.floor(F.col("at") / wide(F.col("height"))).cast("long"))
        level = materialize(below.groupBy("tree", "block").applyInArrow(_built, _RECORD))
        records = level.select("digest", "height", "kids")
        store = records if store is None else store.unionByName(records)
        roots = roots.unionByName(level.where(F.col("left") == 0).select("tree", "n", "digest"))
    if store is None:
        store = leaves.sparkSession.createDataFrame([], "digest string, height int, kids array<array<string>>")
    # Equal subtrees have equal records; one is kept.
    return roots, store.groupBy("digest", "height").agg(F.first("kids").alias("kids"))


def descend(kids: list[list[str]], place: int) -> list[Step]:
    """From a record's top to its node ``place``: the children not selected, and how many of them stand left; from below."""
    steps: list[Step] = []
    for depth, row in enumerate(kids):
        at = place // FAN ** (len(kids) - 1 - depth)
        run = at - at % FAN
        steps.append(("".join(row[run:at] + row[at + 1 : run + FAN]), at - run))
    steps.reverse()
    return steps


def fold(node: str, steps: list[Step]) -> str:
    """The root that a node and the siblings on its path give."""
    for siblings, left in steps:
        cut = left * 64
        node = digest(siblings[:cut] + node + siblings[cut:])
    return node


_PATH = "siblings array<string>, lefts array<int>"
_KIND = {"siblings": pa.list_(pa.string()), "lefts": pa.list_(pa.int32())}
Finish = Callable[[dict, list[list[str]], list[Step], dict], tuple]


def _steps(row: dict) -> list[Step]:
    return list(zip(row["siblings"], row["lefts"], strict=True))


def _height(left: Column) -> Column:
    """Levels of the record below a node with so many levels: what is over, then HEIGHT each."""
    return F.when(left > 0, left - HEIGHT * (F.ceil(left / HEIGHT) - 1)).otherwise(0).cast("int")


def _looked_up(frontier: DataFrame, store: DataFrame) -> DataFrame:
    at = frontier.withColumn("height", _height(F.col("left")))
    return at.where(F.col("left") > 0).join(store, ["digest", "height"]).unionByName(
        at.where(F.col("left") == 0).withColumn("kids", F.lit(None).cast("array<array<string>>")))


def prove(trees: DataFrame, store: DataFrame, requests: DataFrame, finish: Finish, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """Paths of requested leaves. trees: (tree, n, digest, siblings, lefts): roots, and the steps above them, more may follow.

    requests: (tree, rank, n, ...). finish(tree row, kids of the last record, steps above it, request) gives a row
    of ``schema`` (types: ``kinds``) per request.
    """
    names = [x.split()[0] for x in schema.split(", ")]
    more = [c for c in trees.columns if c not in ("tree", "n", "digest", "siblings", "lefts")]
    levels_of = levels(F.col("n"))
    asked = materialize(requests.select("tree", "n", F.floor(F.col("rank") / wide(F.least(levels_of, F.lit(HEIGHT)))).cast("long").alias("block")).distinct())
    kept = {f.name: f.dataType.simpleString() for f in trees.schema.fields}
    frontier = trees.withColumn("at", F.lit(0).cast("long")).withColumn("left", levels_of)
    columns = ["tree", "n", "digest", "siblings", "lefts", *more, "at", "left"]
    below = ", ".join([f"`{c}` {kept[c]}" for c in columns[:-2]] + ["at long", "left int"])

    def down(key: tuple[pa.Scalar, ...], records: pa.Table, wanted: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in columns}
        for row in records.to_pylist():
            for at in wanted.column("goal").to_pylist():
                place = at - row["at"] * FAN ** row["height"]
                steps = descend(row["kids"], place) + _steps(row)
                new = row | {"digest": row["kids"][-1][place], "at": at, "left": row["left"] - row["height"],
                             "siblings": [s for s, _ in steps], "lefts": [x for _, x in steps]}
                for c in columns:
                    out[c].append(new[c])
        types = {c: _KIND.get(c, records.schema.field(c).type) for c in columns}
        return pa.table({c: pa.array(v, types[c]) for c, v in out.items()})

    top = asked.agg(F.max(levels_of).alias("k")).first()["k"] or 0
    for step in range(-(-top // HEIGHT) - 1):
        # Trees that are not yet at their last record go down one record more.
        open_, arrived = frontier.where(F.col("left") > HEIGHT), frontier.where(F.col("left") <= HEIGHT)
        at_record = _looked_up(open_, store)
        rest = HEIGHT * (F.ceil(levels_of / HEIGHT) - 1 - step)  # levels left after this step
        now = levels_of if step == 0 else rest + HEIGHT
        wanted = asked.where(rest >= HEIGHT).withColumn("goal", F.floor(F.col("block") / wide(F.greatest(rest - HEIGHT, F.lit(0)).cast("int"))).cast("long")).withColumn(
            "at", F.floor(F.col("goal") / wide(F.greatest(now - rest, F.lit(0)).cast("int"))).cast("long")).select("tree", "at", "goal").distinct()
        moved = at_record.groupBy("tree", "at").cogroup(wanted.groupBy("tree", "at")).applyInArrow(down, below)
        frontier = materialize(arrived.select(*columns).unionByName(moved.select(*columns)))
    last = _looked_up(frontier, store).withColumnRenamed("at", "block")
    leaves = requests.withColumn("block", F.floor(F.col("rank") / wide(F.least(levels_of, F.lit(HEIGHT)))).cast("long"))

    def end(key: tuple[pa.Scalar, ...], records: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for row in records.to_pylist():
            above, row["folds"] = _steps(row), {}
            out += [finish(row, row["kids"] or [], above, asked_for) for asked_for in rows.to_pylist()]
        cells = zip(*out, strict=True) if out else [[] for _ in names]
        return pa.table([pa.array(list(c), t) for c, t in zip(cells, kinds, strict=True)], names=names)

    return last.groupBy("tree", "block").cogroup(leaves.groupBy("tree", "block")).applyInArrow(end, schema)


def _place(kids: list[list[str]], rank: int) -> int:
    return rank % FAN ** len(kids)


def _path(row: dict, kids: list[list[str]], above: list[Step], asked: dict) -> tuple:
    steps = descend(kids, _place(kids, asked["rank"])) + above
    return asked["name"], asked["rows"], asked["leaf"], row["root"], [s for s, _ in steps], [x for _, x in steps]


def _audit(row: dict, kids: list[list[str]], above: list[Step], asked: dict) -> tuple:
    inside = descend(kids, _place(kids, asked["rank"]))
    proof = digest("".join(s for s, _ in inside + above))
    node, folds = fold(asked["seen"], inside), row["folds"]
    if node not in folds:  # most rows of a record fold to its top, and on from there alike
        folds[node] = fold(node, above)
    return asked["doc"], asked["leaf"], row["subroot"], row["root"], proof, folds[node], folds[node] == row["root"]


def manifest(leaves: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """leaves: (source, doc, leaf, ...). Numbered leaves, trees with their path to the root and the root itself, and the store.

    trees: tree (``s`` and the source, empty for none), n, digest (= subroot), root, siblings, lefts.
    """
    keyed = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))).drop("source")
    named = materialize(keyed.withColumn("_at", F.monotonically_increasing_id()))
    rows = materialize(numbered(named, "tree", "doc", "leaf", "_at").drop("_at"))
    roots, store = build(rows)
    roots = materialize(roots)
    tops = materialize(numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("n").alias("rows"), F.col("digest").alias("leaf")), "tree", "name"))
    head, head_store = build(tops)
    empty = [F.array().cast("array<string>").alias("siblings"), F.array().cast("array<int>").alias("lefts")]
    head = materialize(head.select("tree", "n", "digest", F.col("digest").alias("root"), *empty))
    trees = prove(head, head_store, tops, _path, f"tree string, n long, digest string, root string, {_PATH}",
                  [pa.string(), pa.int64(), pa.string(), pa.string(), *_KIND.values()])
    return rows, materialize(trees), store


def audit(leaves: DataFrame) -> DataFrame:
    """leaves: (source, doc, leaf, seen). Per leaf: doc, leaf, subroot, root, proof_sha256, and the root that ``seen`` folds to."""
    rows, trees, store = manifest(leaves)
    kind = rows.schema["doc"].dataType
    schema = f"doc {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    known = trees.withColumn("subroot", F.col("digest"))
    return prove(known, store, rows, _audit, schema, [to_arrow_type(kind), *[pa.string()] * 5, pa.bool_()])
