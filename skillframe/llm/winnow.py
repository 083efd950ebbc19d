"""Benchmark decontamination by winnowing.

Words are maximal runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. From every ``GRAMS``
consecutive k-grams of a text (k + GRAMS - 1 = 10 words) the least hash is its fingerprint, so any ten words that two texts
share leave a fingerprint they share. Fingerprints of documents and benchmark are joined; around each hit the windows of ten
words that contain it are compared as texts, which settles the match. An item of fewer than ten words is one window; documents
that hold its first word are compared.

Only SQL functions are used. What is shuffled per document is its fingerprints (about a third of its words, hashes only), and
once its text beside the hits. The benchmark is broadcast only if Spark finds its written table small.

Defined cases: a null text has no words; items without words never occur; items without an id hit words but are not listed;
rows of one item id are one item; repeated rows give repeated results; empty tables give no rows, or no hits; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WINDOW, K = 10, 5
GRAMS = WINDOW - K + 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP), "")


def fingerprints(table: DataFrame, words_column: str) -> DataFrame:
    """``table`` with ``fps``: the least of each run of GRAMS k-gram hashes, distinct. Runs cut short by the end add some more."""
    rest = lambda name, n: ", ".join(f"get({name}, i + {j})" for j in range(1, n))
    return (table.withColumn("_h", F.expr(f"transform({words_column}, w -> xxhash64(w))"))
            .withColumn("_g", F.expr(f"transform(_h, (x, i) -> xxhash64(x, {rest('_h', K)}))"))
            .withColumn("fps", F.expr(f"array_distinct(transform(_g, (x, i) -> least(x, {rest('_g', GRAMS)})))"))
            .drop("_h", "_g"))


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """One row per window text: span, len, first (word), fps (of long windows), items (ids as texts)."""
    listed = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(WINDOW))
    starts = listed.select("item", "w", length.alias("len"), F.explode_outer(F.sequence(F.lit(0), F.size("w") - length)).alias("s"))
    spans = starts.select("item", "len", F.slice("w", F.col("s") + 1, F.col("len")).alias("v"))
    grouped = spans.groupBy(F.array_join("v", " ").alias("span"), "len").agg(F.collect_set("item").alias("items"))
    return fingerprints(grouped.withColumn("v", F.split("span", " ")), "v").select(
        "span", "len", F.get("v", F.lit(0)).alias("first"), F.get("fps", F.lit(0)).alias("fp"), "items")


def find(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc, body (hash of the text), n_words, spans (start, len of the hits, from 0), items."""
    windows = materialize(item_windows(benchmark, item, item_text))
    listed = docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("body"), words(F.col(text)).alias("w"))
    # A long window's first fingerprint is the least of its own k-grams, which is what a document holding it has selected.
    prints = materialize(windows.where(F.col("len") == WINDOW).select("fp").distinct())
    # explode_outer: for a plain explode the optimizer derives a filter that computes the array once more, nested in itself.
    hits = fingerprints(listed, "w").select("doc", "body", F.explode_outer("fps").alias("fp")).join(prints, "fp").select(
        "doc", "body", "fp", F.lit(None).cast("string").alias("first"))
    anchors = materialize(windows.where(F.col("len") < WINDOW).select("first").distinct())
    lengths = [r["len"] for r in windows.where(F.col("len") < WINDOW).select("len").distinct().collect()]  # nine at most
    if lengths:
        hits = hits.unionByName(listed.select("doc", "body", F.explode_outer(F.array_distinct("w")).alias("first")).join(anchors, "first").select(
            "doc", "body", F.lit(None).cast("long").alias("fp"), "first"))
    found = materialize(hits.groupBy("doc", "body").agg(F.collect_set("fp").alias("fp"), F.collect_set("first").alias("first")))
    joined = (docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("body"), F.col(text).alias("text")).alias("d")
              .join(found.alias("f"), F.col("d.doc").eqNullSafe(F.col("f.doc")) & (F.col("d.body") == F.col("f.body")), "left")
              .select("d.doc", "d.body", words(F.col("d.text")).alias("w"), "f.fp", "f.first"))
    grams = ", ".join(f"xxhash64(get(w, i + {j}))" for j in range(1, K))
    # Starts of the long windows around each place of a hit k-gram, and of the short windows at each place of a first word.
    long_starts = F.expr(f"""if(size(w) < {WINDOW} or size(fp) = 0, cast(array() as array<struct<s:int,n:int>>), transform(array_distinct(flatten(transform(
        filter(transform(w, (x, i) -> if(array_contains(fp, xxhash64(xxhash64(x), {grams})), i, -1)), i -> i >= 0),
        i -> sequence(greatest(0, i - {GRAMS - 1}), greatest(0, least(i, size(w) - {WINDOW})))))), s -> named_struct('s', s, 'n', {WINDOW})))""")
    short = ", ".join(f"named_struct('s', i, 'n', {n})" for n in lengths)
    short_starts = F.expr(f"""flatten(transform(filter(transform(w, (x, i) -> if(array_contains(first, x), i, -1)), i -> i >= 0),
        i -> filter(array({short}), z -> z.s + z.n <= size(w))))""") if lengths else F.expr("cast(array() as array<struct<s:int,n:int>>)")
    spots = F.when(F.col("fp").isNotNull(), F.concat(long_starts, short_starts))
    spread = joined.withColumn("n_words", F.size("w").cast("long")).withColumn("spots", spots).select(
        "doc", "body", "n_words", "w", "spots")
    # The words of each window are cut out before the rows multiply, so no row carries the whole text along.
    cut = spread.withColumn("spots", F.expr("transform(spots, z -> named_struct('s', z.s, 'n', z.n, 'span', array_join(slice(w, z.s + 1, z.n), ' ')))"))
    rows = cut.select("doc", "body", "n_words", F.posexplode_outer("spots").alias("k", "z"))
    judged = rows.join(windows.select("span", "items"), F.col("z.span") == F.col("span"), "left")
    per_text = judged.groupBy("doc", "body", "n_words").agg(
        F.count_if(F.coalesce("k", F.lit(0)) == 0).alias("copies"),
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct(F.col("z.s").alias("start"), F.col("z.n").alias("len")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return per_text.select("doc", "body", "n_words", "spans", "items", F.explode_outer(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


def n_hit(spans: Column) -> Column:
    """Words inside any of the spans."""
    return F.size(F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))).cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that hold a window of the benchmark."""
    bad = find(docs, benchmark, doc, text).where(F.size("spans") > 0).select(F.col("doc").alias("_doc"), F.col("body").alias("_body")).distinct()
    return docs.join(bad, F.col(doc).eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_body")), "left_anti")
