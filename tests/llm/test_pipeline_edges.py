"""The pipeline on nulls, repeated rows, empty tables and columns whose names its stages use themselves."""

import pytest
from pyspark.sql import functions as F

from conftest import DOCS

CLASH = ["round", "Shard", "shard_key", "n_lines", "n_removed", "_doc", "_body", "label", "places"]


def put(folder, docs, labels, benchmark):
    for name, table in {"documents": docs, "labels": labels, "benchmark": benchmark}.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def labels(spark, rows):
    judged = [(r[0], int(len(r[1] or "") > 60), 0) for r in rows] + [(None, 1, 0), (3, None, 0)]
    return spark.createDataFrame(judged, "doc_id long, quality int, toxic int")


def test_odd_rows_and_clashing_names(spark, rows, docs, labels, tmp_path):
    import corpus_pipeline

    passage = max((r[1] for r in rows if r[1] and "\n" in r[1]), key=lambda t: len(t.split("\n")[-1])).split("\n")[-1]
    items = spark.createDataFrame([("i1", " ".join(passage.split()[:20])), ("i2", None), ("i3", ""), (None, "\n")], "item_id string, text string")
    odd = docs.unionByName(docs.where("doc_id IN (20, 21)")).unionByName(
        docs.where("doc_id BETWEEN 12 AND 16").withColumn("doc_id", F.lit(None).cast("long")))
    odd = odd.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASH])
    sf = put(tmp_path, odd, labels, items)
    mix = corpus_pipeline.run(spark, sf)
    renamed = ["input_round", "input_Shard", "input_shard_key", *CLASH[3:]]
    assert mix.columns == [*DOCS.names, *renamed, "round", "shard", "shard_key"]
    got = mix.collect()
    texts = {r[0]: r[1] for r in rows}
    assert got
    for row in got:
        who = "none" if row["doc_id"] is None else str(row["doc_id"])
        assert [row[c] for c in renamed] == [f"{c} of {who}" for c in CLASH] and row["score"] == row["g"] == "clash"
        assert passage not in row["text"] and 0 <= row["shard"] < 16
        if row["doc_id"] is not None:
            assert set(row["text"].split("\n")) <= set(texts[row["doc_id"]].split("\n"))
    copies = {r[0] for r in rows if [x[1] for x in rows].count(r[1]) > 1 and len(r[1] or "") > 60}
    assert len({row["doc_id"] for row in got} & copies) <= 1


def test_empty_tables(spark, no_docs, docs, labels, tmp_path):
    import corpus_pipeline

    nothing = spark.createDataFrame([], "item_id string, text string")
    empty = corpus_pipeline.run(spark, put(tmp_path / "a", no_docs, labels.limit(0), nothing))
    assert empty.columns == [*DOCS.names, "round", "shard", "shard_key"] and empty.collect() == []
    some = docs.where("doc_id IN (11, 12, 13, 14, 15)")
    kept = corpus_pipeline.run(spark, put(tmp_path / "b", some, labels.limit(0), nothing))
    assert {r["doc_id"] for r in kept.collect()} == {11, 12, 13, 14, 15}
