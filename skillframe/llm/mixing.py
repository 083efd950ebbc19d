"""Mixing sources to target weights: whole blocks of documents, dealt to shards by a multivariate hypergeometric tree.

1. Targets: sources in code point order (null last) get weights in turn and share ``volume`` times all words; a target stops
   at ``most`` times its source, the excess is reshared by weight until none is above.
2. Blocks: the documents of a source are dealt by hash into blocks of about ``block_words`` words (at most 65,536 blocks a
   source, so that a block list always fits one task; blocks grow beyond that). Full rounds take every block; the last
   round takes blocks in a permuted order while they fit, then documents of the next block in permuted order as long as
   they bring the sum nearer to the target.
3. Splitting tree: every node holds an exact quota of block draws per source and sends half of its draws to each child.
   Drawing the left half without replacement, block by block, gives the multivariate hypergeometric split.
4. A shard's quota is a range of its source's permuted draws, so shards are disjoint; rows are shuffled inside a shard.

Only SQL functions are used. What meets in one task: a list of sources (one row each), a list of blocks of a source, the
documents of ``PART_BLOCKS`` blocks.

Defined cases: a null text has size 0; a size of 0 takes no words; equal rows get equal places; null ids and sources are
values of their own; an empty table gives no rows; further columns are returned by ``mixed`` as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MOST_BLOCKS = 65536
PART_BLOCKS = 4
_WORD_GAP = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.coalesce(bare, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(bare, _WORD_GAP))).cast("long")


def _draw(*parts: Column) -> Column:
    """60 bits from a digest, the same on every engine."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), volume: float = 1.5, most: float = 2) -> DataFrame:
    """One row per source of (source, size): rank, source_size, weight, target."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = total.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    weighted = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double"))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    # What is left for a source and those with a larger size for their weight, if all before it are stopped.
    level = (F.sum("source_size").over(whole) * F.lit(float(volume)) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(most))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = weighted.withColumn("level", level).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    open_level = F.first(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level")), ignorenulls=True).over(
        Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return leveled.withColumn("target", F.least("limit", F.coalesce(open_level * F.col("weight"), F.col("limit")))).select(
        "rank", "source", "source_size", "weight", "target")


def split_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """quotas: (rank, draws) per source. Returns (shard, rank, draws): 2^depth shards, sums exact."""
    level = quotas.select(F.lit(0).cast("long").alias("node"), "rank", "draws")
    for _ in range(depth):
        node = level.groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct("rank", "draws"))).alias("v"), F.sum("draws").cast("long").alias("pop"))
        # Selection sampling: each draw goes left with probability room / pop, so the left half is a uniform subset.
        left = F.expr(f"""aggregate(v, named_struct('pop', pop, 'room', pop div 2, 'l', cast(array() as array<bigint>)), (s, b) ->
            transform(array(aggregate(
                if(b.draws > 0, sequence(1L, b.draws), cast(array() as array<bigint>)),
                named_struct('x', 0L, 'pop', s.pop, 'room', s.room),
                (t, i) -> if(pmod(xxhash64({seed}L, node, b.rank, i), 9007199254740992L) / 9007199254740992D * t.pop < t.room,
                    named_struct('x', t.x + 1L, 'pop', t.pop - 1L, 'room', t.room - 1L),
                    named_struct('x', t.x, 'pop', t.pop - 1L, 'room', t.room)))),
              r -> named_struct('pop', r.pop, 'room', r.room, 'l', concat(s.l, array(r.x))))[0])""")
        parted = node.withColumn("l", left["l"]).select("node", F.posexplode("v").alias("at", "b"), "l").select(
            "node", F.col("b.rank").alias("rank"), F.col("b.draws").alias("draws"), F.get("l", F.col("at")).alias("left"))
        level = parted.select("rank", F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("draws")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("draws") - F.col("left")).alias("draws")))).alias("c")).select(
            F.col("c.node").alias("node"), "rank", F.col("c.draws").alias("draws"))
    return level.withColumnRenamed("node", "shard")


def place(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), volume: float = 1.5, most: float = 2, depth: int = 4,
          block_words: int = 16384, seed: int = 7, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc, body (hash of the text), size, source, source_size, target, places (array of round, shard), key."""
    sizes = materialize(docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("body"), n_words(F.col(text)).alias("size"),
                                    F.col(source).alias("source")))
    goal = materialize(
        targets(sizes, weights, volume, most)
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
        .withColumn("n_blocks", F.least(F.lit(MOST_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))).cast("long")))
    keyed = materialize(
        sizes.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
        .select("d.*", "g.rank", "g.source_size", "g.target", "g.n_blocks", "g.rest", "g.rounds", _draw(F.lit(seed), F.col("doc"), F.col("size")).alias("key"))
        .withColumn("block", F.pmod("key", "n_blocks")))
    blocks = keyed.groupBy("rank", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("rounds").alias("rounds"))
    permuted = Window.partitionBy("rank").orderBy(_draw(F.lit(seed + 1), F.col("rank"), F.col("block")), "block")
    listed = materialize(
        blocks.withColumn("before", F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
        .withColumn("pos", F.row_number().over(permuted).cast("long") - 1)
        .withColumn("whole", F.col("before") + F.col("words") <= F.col("rest"))
        .withColumn("wholes", F.count_if("whole").over(Window.partitionBy("rank")))
        .withColumn("part", ~F.col("whole") & (F.col("rest") > 0) & (F.col("pos") < F.col("wholes") + PART_BLOCKS)))
    quotas = listed.groupBy("rank").agg(
        F.count("*").alias("n"), (F.first("rounds") * F.count("*") + F.count_if("whole") + F.count_if("part")).cast("long").alias("draws"))
    shards = split_tree(quotas, depth, seed)
    upto = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ranges = shards.withColumn("until", F.sum("draws").over(upto)).where(F.col("draws") > 0)
    draws = ranges.join(quotas.select("rank", "n"), "rank").select(
        "rank", "n", "shard", F.explode(F.sequence(F.col("until") - F.col("draws"), F.col("until") - 1)).alias("draw")).select(
        "rank", "shard", (F.col("draw") % F.col("n")).alias("pos"), F.expr("draw div n").alias("round"))
    block_places = listed.join(draws, ["rank", "pos"], "left").groupBy("rank", "block").agg(
        F.first("part").alias("part"), F.first("rounds").alias("rounds"),
        F.sort_array(F.collect_list(F.when(F.col("round").isNotNull(), F.struct("round", "shard")))).alias("places"))
    split = listed.where("part").withColumn("left", F.col("rest") - F.min("before").over(Window.partitionBy("rank"))).select(
        "rank", "block", "left")
    loose = keyed.join(split, ["rank", "block"]).groupBy("rank", "block", "key", "body").agg(
        F.sum("size").alias("size"), F.first("left").alias("left"))
    drawn = (loose.groupBy("rank").agg(F.first("left").alias("left"), F.sort_array(F.collect_list(F.struct(
                _draw(F.lit(seed + 2), F.col("key")).alias("h"), "key", "body", "block", "size"))).alias("v"))
             .withColumn("fit", F.expr("""aggregate(v, named_struct('left', left, 'got', slice(v, 1, 0)), (s, d) -> if(d.size <= s.left,
                named_struct('left', s.left - d.size, 'got', concat(s.got, array(d))), s))"""))
             .withColumn("next", F.expr("array_min(transform(array_except(v, fit.got), d -> named_struct('size', d.size, 'd', d)))"))
             .select("rank", F.explode(F.when(F.col("next.size") < 2 * F.col("fit.left"), F.concat("fit.got", F.array("next.d"))).otherwise(F.col("fit.got"))).alias("d"))
             .select("rank", "d.block", "d.key", "d.body", F.lit(True).alias("drawn")))
    placed = (keyed.drop("rounds").join(block_places.select("rank", "block", "part", "rounds", "places"), ["rank", "block"])
              .join(drawn, ["rank", "block", "key", "body"], "left"))
    valid = F.filter("places", lambda p: ~F.col("part") | F.coalesce(F.col("drawn"), F.lit(False)) | (p["round"] < F.col("rounds")))
    return placed.select("doc", "body", "size", "source", "source_size", "target", valid.alias("places"), "key")


def mixed(docs: DataFrame, places: DataFrame, doc: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """The rows of the mix: ``docs`` once per place, with round, shard and shard_key; sort a shard by it to shuffle it."""
    taken = places.select("doc", "body", F.explode("places").alias("p"), "key").distinct().select(
        F.col("doc").alias("_doc"), F.col("body").alias("_body"), F.col("p.round").alias("round"), F.col("p.shard").alias("shard"),
        F.xxhash64(F.lit(seed), "p.shard", "p.round", "key", "body").alias("shard_key"))
    return docs.join(taken, F.col(doc).eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_body"))).drop("_doc", "_body")


def write_shards(mix: DataFrame, path: str, depth: int = 4) -> None:
    """One folder per shard, rows in shuffled order."""
    salt = F.pmod("shard_key", F.lit(8))
    mix.repartition(8 << depth, "shard", salt).sortWithinPartitions("shard", "shard_key").write.partitionBy("shard").parquet(path)
