"""The registered queries against their SQL, and the pipeline against its operators in plain Python."""

import collections

import pytest
from oracle import check
from test_dedup import expected_components, expected_lines
from test_text import expected_hits, expected_targets

from skillframe.llm import quality
from skillframe.llm.queries import ORACLES, QUERIES, in_part

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_sql(spark, name):
    line = check(spark, name, QUERIES[name], ORACLES[name], SF)
    assert line.startswith("ok"), line


def test_all_are_registered():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline_equals_plain_python(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~in_part("doc_id", 3, 1))
    good = {r["doc_id"] for r in quality.score(docs.select("doc_id", "text"), model).where("score >= 0.5").collect()}
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect() if r["doc_id"] in good]
    found = expected_lines(rows, 10)
    kept = []
    for doc, text, lang, source, n in rows:
        left, gone = found[doc]
        if not gone or any(x.strip() for x in left.split("\n")):
            kept.append((doc, left, lang, source, len(left) if gone else n))
    label = expected_components(kept)
    kept = [r for r in kept if label[r[0]][1] == r[0]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = expected_hits(kept, items)
    kept = {r[0]: r for r in kept if not hits[r[0]][1]}
    mix = corpus_pipeline.run(spark, sf).collect()
    assert mix and all(tuple(r)[:5] == kept[r["doc_id"]] for r in mix)
    rounds = collections.Counter(r["doc_id"] for r in mix)
    assert max(rounds.values()) <= 2
    sizes, taken = collections.Counter(), collections.Counter()
    for doc, text, _, source, _ in kept.values():
        sizes[source] += len((text or "").split())
        taken[source] += len((text or "").split()) * rounds[doc]
    want = expected_targets(sizes)
    longest = collections.defaultdict(int)
    for _, text, _, source, _ in kept.values():
        longest[source] = max(longest[source], len((text or "").split()))
    for s in sizes:  # a source may have no more than one document to choose from
        assert abs(want[s] - taken[s]) <= longest[s] / 2
