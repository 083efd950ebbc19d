"""A corpus pipeline of five stages over ``documents``; every stage reads what the one before has written.

Rows whose decisions have no id to hang on (a null ``doc_id``) pass the near-duplicate stage. The texts change in the line stage
only, where ``n_chars`` follows. The last stage returns a row per place in the mix, with round, shard and shard_key; columns of
``documents`` with one of these names come as input_round, input_shard and input_shard_key. Other names may be any that Parquet
takes. Empty tables give no rows; without labels no document is rejected, without benchmark none is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillframe.llm import jaccard, lines, mixing, quality, winnow
from skillframe.llm.queries import in_part
from skillframe.session import configure, materialize


def _aside(docs: DataFrame, *names: str, mark: str = "__") -> DataFrame:
    """``docs`` with the columns that have one of a stage's own names put under other names."""
    return docs.toDF(*[mark + c if c.lower() in names else c for c in docs.columns])


def _quoted(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels that op5 learns from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, ~in_part("doc_id", 3, 1))
    own = _aside(docs, "score")
    return quality.score(own, model, keep_text=True).where(F.col("score") >= 0.5).select(*_quoted(own)).toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines of many sites; those of which nothing is left go."""
    own = _aside(docs, "n_lines", "n_removed")
    found = lines.dedup_lines(own)
    changed = F.col("n_removed") > 0
    length = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.where(~changed | (F.col("n_removed") < F.col("n_lines"))).withColumn("n_chars", length).select(
        *_quoted(own)).toDF(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_first(docs).select(*_quoted(docs))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    own = _aside(docs, "_doc", "_body")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return winnow.decontaminate(own, benchmark).select(*_quoted(own)).toDF(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per place of a document, with round, shard and shard_key."""
    named = _aside(docs, "round", "shard", "shard_key", mark="input_")
    own = _aside(named, "_doc", "_body")
    mix = mixing.mixed(own, mixing.place(own)).select(*_quoted(own), "round", "shard", "shard_key")
    return mix.toDF(*named.columns, "round", "shard", "shard_key")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mixing_stage),
]
#: The classifier is not SQL; tests compare the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, materialize(docs) if k else docs, sf_dir)
    return docs
