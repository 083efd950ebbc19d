"""Line, substring and near-duplicate dedup against plain Python."""

import collections
import hashlib
import random
import sys

from conftest import DOCS, plain_words
from pyspark.sql import functions as F

from skillframe.llm import jaccard, lines, substrings
from skillframe.llm.components import components
from skillframe.session import RUNTIME_SETTINGS, configure, materialize

BLANKS = " \t\n\x0b\x0c\r"


def expected_lines(rows, least):
    sites, first = collections.defaultdict(set), {}
    for doc, text, _, source, *_ in rows:
        for k, line in enumerate((text or "").split("\n")):
            if bare := line.strip(BLANKS):
                sites[bare].add(source)
                first[bare] = min(first.get(bare, (doc, k)), (doc, k))
    out = {}
    for doc, text, *_ in rows:
        kept, gone = [], 0
        for k, line in enumerate((text or "").split("\n")):
            bare = line.strip(BLANKS)
            if bare and len(sites[bare]) >= least and first[bare] != (doc, k):
                gone += 1
            else:
                kept.append(line)
        out[doc] = ("\n".join(kept) if text is not None else None, gone)
    return out


def line_rows(spark, rows):
    more = [(1000 + k, f"own {k}\n common line \nshared by three\nlast {k}" if k % 4 else f"own {k}\ncommon line", "en",
             None if k % 6 == 5 else f"s{k % 6}", 1, "c", "c") for k in range(40)]
    return rows + more, spark.createDataFrame(rows + more, DOCS)


def test_lines_of_many_sites_go_but_once(spark, rows):
    given, docs = line_rows(spark, rows)
    for least in (2, 3, 5, 6, 9):
        want = expected_lines(given, least)
        got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(docs, least).collect()}
        assert got == want


def test_lines_whatever_the_estimate_says(spark, rows, monkeypatch):
    """With coarse sketches and a wide margin the exact counts decide."""
    monkeypatch.setattr(lines, "LG_K", 4)
    monkeypatch.setattr(lines, "MARGIN", 0.9)
    given, docs = line_rows(spark, rows)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(docs, 5).collect()}
    assert got == expected_lines(given, 5)


def test_lines_of_odd_rows(spark, no_docs):
    assert lines.dedup_lines(no_docs).count() == 0
    odd = spark.createDataFrame([(None, "a\nb", "en", f"s{k}", 1, "c", "c") for k in range(12)] + [(1, "a\nc", "en", "s1", 1, "c", "c")] * 2, DOCS)
    got = sorted(((r["doc_id"] is None, r["text"], r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(odd).collect()))
    assert got == [(False, "a\nc", 2, 0)] * 2 + [(True, "", 2, 2)] * 12 or got == [(False, "a\nc", 2, 0)] * 2 + [(True, "b", 2, 1)] * 12
    assert set(lines.dedup_lines(odd).columns) == {*odd.columns, "n_lines", "n_removed"}


def expected_substrings(rows):
    first = {}
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        w = plain_words(text)
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), doc)
    out = {}
    for doc, text, *_ in rows:
        w = plain_words(text)
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < doc for j in range(13)}
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_substrings_equal_brute_force(spark, rows, docs, small_groups):
    found = substrings.dedup(docs)
    got = {r["doc"]: (r["n_words"], r["n_removed"], r["text"]) for r in found.collect()}
    assert got == expected_substrings(rows)
    texts = {r[0]: plain_words(r[1]) for r in rows}
    spans = [(r["doc"], s) for r in found.collect() for s in r["spans"]]
    assert spans
    for doc, s in spans:
        assert s["source_doc"] < doc
        assert texts[doc][s["start"] : s["start"] + s["length"]] == texts[s["source_doc"]][s["source_start"] : s["source_start"] + s["length"]]
    assert substrings.verify(docs, found, 13).count() == 0


def test_substrings_of_odd_rows(spark, no_docs):
    assert substrings.dedup(no_docs).count() == 0
    text = " ".join(f"w{i}" for i in range(20))
    odd = spark.createDataFrame([(None, text, "", "", 0, "", ""), (3, text, "", "", 0, "", ""), (3, text, "", "", 0, "", ""), (9, None, "", "", 0, "", "")], DOCS)
    got = sorted((str(r["doc"]), r["n_words"], r["n_removed"]) for r in substrings.dedup(odd).collect())
    assert got == [("3", 20, 0), ("3", 20, 0), ("9", 0, 0), ("None", 20, 20)]


def expected_components(rows):
    sets = {}
    for doc, text, *_ in rows:
        w = plain_words(text, lower=True)
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), top(d)) for d, s in sets.items()}


def test_near_duplicates_equal_brute_force(rows, docs, small_groups, monkeypatch):
    want = expected_components(rows)
    # 3: most shingles of the family count as common and are left out where they can be. 4, 5: families in small blocks.
    for common, family, block in ((64, 32, 256), (3, 4, 5)):
        monkeypatch.setattr(jaccard, "COMMON", common)
        monkeypatch.setattr(jaccard, "FAMILY", family)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = {r["doc"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
        assert got == want


def test_near_duplicates_of_odd_rows(spark, no_docs):
    assert jaccard.near_duplicates(no_docs).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    odd = spark.createDataFrame([(None, text, "", "", 0, "", ""), (4, text, "", "", 0, "", ""), (4, text, "", "", 0, "", ""),
                                 (7, text + " x", "", "", 0, "", ""), (8, None, "", "", 0, "", ""), (9, "", "", "", 0, "", "")], DOCS)
    got = sorted((str(r["doc"]), r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(odd).collect())
    assert got == [("4", 26, 4), ("4", 26, 4), ("7", 27, 4), ("8", 0, 8), ("9", 0, 9), ("None", 26, 4)]
    assert sorted(str(r["doc_id"]) for r in jaccard.keep_first(odd).collect()) == ["4", "4", "8", "9", "None"]


def test_near_copies_without_id_are_not_listed(spark):
    words, big = [f"w{i}" for i in range(60)], 2**53 + 1
    near = lambda k: " ".join([*words, f"x{k}"])
    rows = [(None, near(0), "", "", 0, "", ""), (None, near(1), "", "", 0, "", ""), (big, near(2), "", "", 0, "", ""), (big + 2, near(3), "", "", 0, "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((str(r["doc"]), r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect())
    assert got == [(str(big), 57, big), (str(big + 2), 57, big), ("None", 57, None), ("None", 57, None)]
    assert sorted(str(r["doc_id"]) for r in jaccard.keep_first(docs).collect()) == [str(big), "None", "None"]


def test_prefix_choice_skips_common_shingles():
    import numpy as np

    rank, length = np.arange(30), np.array([5000] * 2 + [3] * 28)
    level, asked, skip = jaccard.choose(100, rank, length)
    assert skip and asked == level - 2 >= 1
    assert jaccard.choose(10, np.arange(3), np.array([2, 2, 2]))[2] is False


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40, 70)] + [(0, k) for k in range(5, 20)] + [(100, 99), (99, 100)]
    got = {r["doc"]: r["label"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 40 for i in range(40, 71)}, 0: 0, **{k: 0 for k in range(5, 20)}, 99: 99, 100: 99}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def writes(monkeypatch, module):
    made = []
    monkeypatch.setattr(module, "materialize", lambda df: made.append(1) or materialize(df))
    return made


def test_components_of_few_links_need_one_round(spark, monkeypatch):
    made = writes(monkeypatch, sys.modules[components.__module__])
    got = {r["doc"]: r["label"] for r in components(spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long")).collect()}
    assert got == dict.fromkeys(range(65), 0)
    assert len(made) == 3  # links, first labels, the round that finds nothing new


def test_components_of_few_links_whatever_the_shuffle(spark, monkeypatch):
    made = writes(monkeypatch, sys.modules[components.__module__])
    draw = random.Random(3)
    chain = draw.sample(range(200), 200)
    monkeypatch.setitem(RUNTIME_SETTINGS, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = configure(spark).createDataFrame(list(zip(chain, chain[1:], strict=False)), "a long, b long").repartition(7, "a")
        got = {r["doc"]: r["label"] for r in components(links).collect()}
    finally:
        monkeypatch.undo()
        configure(spark)
    assert got == dict.fromkeys(range(200), 0) and len(made) == 3


def test_components_of_more_links_than_a_task_takes(spark, monkeypatch):
    monkeypatch.setattr(sys.modules[components.__module__], "TASK_LINKS", 16)
    chain = random.Random(4).sample(range(40), 40)
    links = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)) + [(300, 200)], "a long, b long")
    got = {r["doc"]: r["label"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(40), 0), 200: 200, 300: 200}


def test_components_across_partitions(spark, monkeypatch):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(50, 90)] + [(draw.randrange(100, 400), draw.randrange(100, 400)) for _ in range(120)] + [(-5, k) for k in range(500, 540)] + [(7, 7), (None, 8)]
    root = {i: i for pair in links for i in pair}
    for _ in root:
        for a, b in links[:-1]:
            root[a] = root[b] = min(root[a], root[b])
    monkeypatch.setitem(RUNTIME_SETTINGS, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc"]: r["label"] for r in components(configure(spark).createDataFrame(links, "a long, b long")).collect()}
    finally:
        monkeypatch.undo()
        configure(spark)
    assert got == {i: root[i] for a, b in links[:-1] if a != b for i in (a, b)}


def test_without_families_nothing_is_done_for_them(spark, docs, small_groups, rows, monkeypatch):
    calls = []
    monkeypatch.setattr(jaccard, "components", lambda links: calls.append(1) or components(links))
    monkeypatch.setattr(jaccard, "FAMILY", 10**6)
    got = {r["doc"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == expected_components(rows) and len(calls) == 2


def test_later_leaders_are_tried_in_one_step(spark, docs, small_groups, rows, monkeypatch):
    made = writes(monkeypatch, jaccard)
    monkeypatch.setattr(jaccard, "FAMILY", 10**6)
    got = {r["doc"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
    # base, known, raw, index, chosen, leaders, compared with the first, links of all, large, named, open tokens, the rest
    assert got == expected_components(rows) and len(made) == 12


def test_kept_text_digest(spark):
    docs = spark.createDataFrame([(1, " a  b\tc ", "", "", 0, "", "")], DOCS)
    row = substrings.dedup(docs).select(F.sha2("text", 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"a b c").hexdigest()
