"""Winnowing, mixing, chat, pages, search, quality and language-model scores."""

import collections
import hashlib
import json
import math
import re
import zlib

import numpy as np
import pytest
from conftest import DOCS, LOW, plain_words
from pyspark.sql import functions as F

from skillframe.llm import chat, html, lm, mixing, quality, topk, winnow


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def expected_hits(rows, items):
    out = {}
    for doc, text, *_ in rows:
        w, hit, found = benchmark_words(text), set(), set()
        for item, item_text in items:
            v = benchmark_words(item_text)
            n = min(10, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def test_windows_of_the_benchmark(spark, rows, docs):
    words = {r[0]: plain_words(r[1]) for r in rows}
    items = [(1, " ".join(words[60][20:55])), (2, " ".join(words[20][:10])), (3, "ONE"), (4, " ".join(words[61][3:9])), (5, None), (6, ""),
             (7, "x " * 15), (8, "not in there at all but long enough for one window"), (None, "two Words"), (1, " ".join(words[21][1:13]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc"]: (r["n_words"], r["n_hit"], sorted(r["items"])) for r in
           winnow.find(docs, benchmark).withColumn("n_hit", winnow.n_hit(F.col("spans"))).collect()}
    want = expected_hits(rows, items)
    assert got == want
    left = {r["doc_id"] for r in winnow.decontaminate(docs, benchmark).collect()}
    assert left == {d for d, (_, hit, _) in want.items() if not hit}
    assert winnow.find(docs, benchmark.limit(0)).where(F.size("spans") > 0).count() == 0


def test_windows_of_odd_rows(spark, no_docs):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert winnow.find(no_docs, benchmark).count() == 0
    odd = spark.createDataFrame([(None, "z a b c", "", "", 0, "", ""), (2, "a b c", "", "", 0, "", ""), (2, "a b c", "", "", 0, "", ""), (2, "d", "", "", 0, "", "")], DOCS)
    got = sorted((str(r["doc"]), r["n_words"], len(r["spans"])) for r in winnow.find(odd, benchmark).collect())
    assert got == [("2", 1, 0), ("2", 3, 1), ("2", 3, 1), ("None", 4, 1)]


def expected_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    open_, left, out = set(order), 1.5 * sum(sizes.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_hits_the_targets(spark, rows, docs):
    places = mixing.place(docs, block_words=200).collect()
    sizes, taken, biggest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in places:
        assert r["size"] == len(plain_words(next(x[1] for x in rows if x[0] == r["doc"])))
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * len(r["places"])
        assert len(r["places"]) <= 2
    want = expected_targets(sizes)
    for r in places:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(want[s] - taken[s]) <= max(0.03 * want[s], 60)


def test_shards_are_disjoint_and_exact(spark, docs):
    places = mixing.place(docs, block_words=50, depth=3)
    mix = mixing.mixed(docs, places)
    assert mix.count() == places.selectExpr("sum(size(places))").first()[0] == mix.select("doc_id", "round").distinct().count()
    assert {r["shard"] for r in mix.select("shard").distinct().collect()} <= set(range(8))
    again = mixing.mixed(docs.repartition(2), mixing.place(docs.repartition(2), block_words=50, depth=3))
    key = lambda x: sorted((r["doc_id"], r["round"], r["shard"], r["shard_key"]) for r in x.collect())
    assert key(mix) == key(again)


def test_tree_splits_like_draws_without_replacement(spark):
    quotas = spark.createDataFrame([(k, 40 if k % 2 else 10) for k in range(1, 41)], "rank long, draws long")
    leaves = mixing.split_tree(quotas, 3, 11).collect()
    total, per_shard = collections.Counter(), collections.Counter()
    for r in leaves:
        total[r["rank"]] += r["draws"]
        per_shard[r["shard"]] += r["draws"]
    assert total == {k: 40 if k % 2 else 10 for k in range(1, 41)}
    assert set(per_shard.values()) == {125}
    # Variance of the hypergeometric law, within wide bounds.
    big = [r["draws"] for r in leaves if r["rank"] % 2]
    assert abs(np.mean(big) - 5) < 0.01 and 2.5 < np.var(big) < 7


def test_mix_of_odd_rows(spark, no_docs):
    assert mixing.place(no_docs).count() == 0
    odd = spark.createDataFrame([(None, None, "", None, 0, "", ""), (1, "a b", "", None, 0, "", ""), (1, "a b", "", None, 0, "", "")], DOCS)
    got = sorted((r["size"], len(r["places"])) for r in mixing.place(odd).collect())
    assert [size for size, _ in got] == [0, 2, 2]
    assert len({n for size, n in got if size}) == 1


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\s>", "<s", "[\\/INST]", "[\\\\/INST] x", "", None, "<<s>>", "[[INST]]", "a\n\\b", "é</s>" * 3]
    rows = [(c, t, role, odd[(c + t) % len(odd)]) for c in range(11) for t, role in enumerate(["system", "user", "assistant", None, "[INST]", "assistant"])]
    rows += [(None, None, "user", "x"), (None, 2, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    made = chat.format_chats(chat.from_rows(turns))
    got = made.select("conv_id", chat.parse_chat(F.col("formatted")).alias("t"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted").collect()
    assert len(got) == 12
    for r in got:
        mine = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: -1 if x[1] is None else x[1])
        assert [(x["role"], x["text"]) for x in r["t"]] == [(x[2] or "", x[3] or "") for x in mine]
        assert r["l"] == [x[3] or "" for x in mine if x[2] == "assistant"]
        assert r["formatted"].count("</s>") == len(mine)
    assert chat.format_chats(chat.from_rows(turns.limit(0))).count() == 0


def test_chat_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"response": "b", "prompt": "a"}, {"prompt": "a", "completion": "b"}, {"instruction": "a", "output": "b"},
        {"instruction": "s", "input": "a", "output": "b"}, {"system": "s", "prompt": "a", "output": "b"}, {"instruction": "s", "input": "", "output": "b"},
        {"other": 1}]
    frame = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(records)] + [(99, None), (98, "[]")], "conv_id long, payload string")
    got = collections.defaultdict(list)
    for r in chat.from_records(frame).orderBy("conv_id", "turn").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    two = [("user", "a"), ("assistant", "b")]
    assert [got[i] for i in range(8)] == [two] * 5 + [[("system", "s"), *two]] * 2 + [[("system", "s"), ("assistant", "b")]]
    assert set(got) == set(range(8))
    assert {r["paths"] for r in chat.unknown_layouts(frame).collect()} == {"other", ""}


def test_chat_records_lose_no_turn(spark):
    """Keys that only some messages have, further keys, and records that no layout fits."""
    records = [
        {"id": "x", "messages": [{"role": "user"}, {"role": "assistant", "content": "b", "weight": 1}]},
        {"messages": [{"name": "n", "role": "user", "content": "a"}, None, {"content": "b"}], "meta": {"k": [1]}},
        {"prompt": "a", "response": "b", "system": "s"}, {"messages": []}, {"messages": ["a", "b"]}, {"messages": "a"}]
    frame = spark.createDataFrame([(i, json.dumps(x), "clash") for i, x in enumerate(records)], "conv_id long, payload string, turn string")
    got = sorted((tuple(r) for r in chat.from_records(frame).collect()), key=lambda r: r[:2])
    assert got == [(0, 0, "user", None), (0, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, None, None), (1, 2, None, "b")]
    rest = chat.unknown_records(frame)
    assert sorted(r["conv_id"] for r in rest.collect()) == [2, 3, 4, 5] and rest.columns == frame.columns


def test_chat_layouts_of_tables(spark):
    lists = spark.createDataFrame(
        [(1, [("human", "a", 3), ("gpt", "b", 4)], "x"), (2, [], "x"), (3, None, "x")],
        "conv_id int, conversations array<struct<from:string,value:string,id:int>>, text string")
    assert [tuple(r) for r in chat.from_rows(lists).orderBy("turn").collect()] == [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    rows = lists.withColumns({"turn": F.lit(7), "role": F.lit(None).cast("string")})
    assert {tuple(r) for r in chat.from_rows(rows).collect()} == {(c, 7, None, "x") for c in (1, 2, 3)}
    with pytest.raises(ValueError, match="no layout"):
        chat.from_rows(lists.drop("conversations"))


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site name</h1><p>Welcome to the best site of all.</p></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav>
<div id="cookie-banner">We use cookies to make this site better for you. <button>OK</button></div><!-- <p>no</p> -->
<article><header><h1>Caf&eacute; &amp more</h1></header><p>First  paragraph
with <b>bold</b>ness and <a href="x">a link</a>.<p>Short.<br>Next<ul><li>item one<li>item two</ul>
<div class="ad-slot">Buy now this great thing for little money.</div><script>var t="</p><p>x";</script><table><tr><td>cell<td>other</table>
<section class="comments"><h3>Comments</h3><p>I think that this is a long comment with many words, really.</p></section></article>
<aside><p>Side text that is long enough to be kept, perhaps.</p></aside><form><p>Write to us please.</p><input></form><footer>&copy; x</footer>"""


def test_page_blocks():
    want = ["Café & more", "First paragraph with boldness and a link.", "Short. Next", "item one", "item two", "cell", "other"]
    assert html.main_text(PAGE) == "\n\n".join(want)


SAID = "Ten or more words that stand in the article and are its own text."


@pytest.mark.parametrize("page", [
    '<article><p><a href="/the-hidden-lake">Ten</a>{rest}</p></article>', '<article><p><a title="The hidden truth" class="share">Ten</a>{rest}</p></article>',
    '<article data-hidden="false"><p>{said}</p></article>', '<article><p><a href="/x?id=comments">Ten</a>{rest}</p></article>',
    "<article><p title='a hidden b' data-role=navigation>{said}</p></article>", '<article><p><span hidden>Not this.</span>{said}</p></article>',
    '<div class="content-sidebar-wrap"><main><p>{said}</p></main></div>', '<div class="page-with-sidebar"><div class="entry-content"><p>{said}</p></div></div>',
    '<div class="sidebar-left"><article><p>{said}</p></article></div>'])
def test_labels_match_whole_names_and_wrappers_are_lifted(page):
    assert html.main_text(page.format(said=SAID, rest=SAID[3:])) == SAID


@pytest.mark.parametrize("page", [
    "<article hidden><p>{said}</p></article>", "<article><p class=x HIDDEN=''>{said}</p></article>", '<article><div class="comments"><article><p>{said}</p></article></div></article>',
    '<div class="sidebar"><div class="content"><p>{said}</p></div></div>', '<nav><main-menu><p>{said}</p></main-menu></nav>', '<article><p><a class="share">{said}</a></p></article>'])
def test_furniture_stays_out(page):
    assert html.main_text(page.format(said=SAID)) == ""


OTHER = "I think that this is a long text with many words, by one of the readers of this page."


@pytest.mark.parametrize("after", [
    "<section><h2>Comments</h2><article><p>{o}</p></article><article><h3>Ann</h3><p>{o}</p></article></section>",
    "<section><h2>Leave a Reply</h2><p>{o}</p></section>", '<section aria-label="Comments"><article><p>{o}</p></article></section>',
    "<section><h3>3 Comments</h3><div><p>{o}</p></div></section>", "<section><header><h2>Comments (12):</h2></header><article><p>{o}</p></article></section>",
    "<div><div><h3>You might also like</h3></div><div><p>{o}</p><ul><li><a href=x>{o}</a></ul></div></div>", "<section><h2>12 thoughts on \u201cA day\u201d</h2><p>{o}</p></section>",
    "<details><summary>Comments</summary><p>{o}</p></details>", "<section><h2>Kommentare</h2><p>{o}</p><p>{o}</p></section>",
    "<h2>Related stories</h2><p>{o}</p><h3>{o}</h3><p>{o}</p>"])
def test_headings_and_labels_speak_for_their_section(after):
    page = "<article><h1>Comments</h1><p>{s}</p><h2>On comments and replies</h2><p>{s}</p>" + after + "<h2>The end</h2><p>{s}</p></article>"
    want = ["Comments", SAID, "On comments and replies", SAID, "The end", SAID]
    assert html.main_text(page.format(o=OTHER, s=SAID)) == "\n\n".join(want)


@pytest.mark.parametrize("page", [
    '<article aria-label="A day in June"><p>{s}</p></article>', "<h2>Related articles</h2><ul><li><a href=x>x</a></ul><article><h1>{s}</h1></article>",
    "<article><h2>Comments are an old habit</h2><p>{s}</p></article>", "<article><p>Comments</p><p>{s}</p></article>"])
def test_other_headings_do_not(page):
    assert SAID in html.main_text(page.format(s=SAID))


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>x", "</p>", "<a href='", "&#x;", "<p>" * 3000, "<nav>x</nav>", "<![CDATA["])
def test_odd_pages_have_no_text(page):
    assert html.main_text(page) == ""


def test_cut_is_minimal():
    import itertools
    import random

    draw = random.Random(2)
    for _ in range(60):
        n = draw.randint(1, 7)
        costs = [draw.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, draw.uniform(0, 2)) for a in range(n) for b in range(a) if draw.random() < 0.6]

        def value(side, costs=costs, edges=edges):
            return sum(max(c, 0) if not s else max(-c, 0) for c, s in zip(costs, side, strict=True)) + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(value(s) for s in itertools.product([False, True], repeat=n))
        assert value(html.min_cut(costs, edges, n)) == pytest.approx(best)


def test_pages_as_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "v", "<article>one two three.</article>", "x")], "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["text"][:13], r["n_chars"]) for r in html.extract(pages).collect())
    assert got[:2] == [("2", "", 0), ("2", "", 0)] and got[2][1] == "one two three" and got[0][0] == "2" or got[0][0] == "1"
    assert html.extract(pages.limit(0)).count() == 0


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in draw.normal(size=9)]) for i in range(1500)]
    vectors += [(2000 + i, list(vectors[7][1])) for i in range(40)]  # ties
    vectors += [(3000, None), (3100, [1.0, None]), (3200, [float("nan")]), (3300, [float("inf")]), (3400, [0.5]), (None, [1.0]), (100, list(vectors[100][1]))]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    whole = topk.scaled(frame)
    got = collections.defaultdict(list)
    for r in topk.top_k(whole, whole.where(F.col("id") % 100 == 0), 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    good = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append([math.floor(1024 * float(np.float32(x))) for x in v])
    queries = [i for i in good if i % 100 == 0]
    assert set(got) == set(queries)
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(good[q][0], v, strict=False)), i) for i, vs in good.items() if i != q for v in vs)
        assert got[q] == [(-s, i) for s, i in scored[:10]]


def test_top_k_of_few(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    whole = topk.scaled(few)
    assert [tuple(r) for r in topk.top_k(whole, whole.where("id = 0"), 10).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(whole.limit(0), whole.limit(0), 10).count() == 0


SF = "/root/testdata/sf0.01"


def test_quality_of_held_out_rows(spark):
    from skillframe.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op5_quality_classifier"](spark, SF).collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good, bad = ([got[i]["score"] for i in labels if i in got and got[i]["held_out"] and labels[i] == q] for q in (1, 0))
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.98
    assert np.mean(np.array(good) >= 0.5) > 0.97


def test_quality_of_odd_rows(spark, no_docs):
    docs = spark.createDataFrame([(1, "A good text", "", "", 0, "", ""), (2, "!! !! !!", "", "", 0, "", ""), (3, None, "", "", 0, "", ""), (None, "", "", "", 0, "", "")], DOCS)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (7, 0)], "doc_id long, quality int")
    one_class = quality.fit(docs, labels, F.lit(True))
    plain = docs.select("doc_id", "text")
    assert {r["score"] for r in quality.score(plain, one_class).collect()} == {0.5}
    both = quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int"), F.lit(True))
    assert quality.score(plain, both).count() == 4
    assert quality.score(no_docs.select("doc_id", "text"), both).count() == 0


def test_hinge_fit_separates():
    draw = np.random.default_rng(0)
    labels = np.where(draw.random(200) < 0.8, 1, -1)
    features = [np.unique(np.append(draw.integers(100, 400, 20), 7 if y == 1 else 9)).astype(np.int32) for y in labels]
    model = quality.fit_rows(labels, features, [np.ones(len(f), np.float32) for f in features])
    margins = np.array([model.weights[f].sum() + model.bias for f in features])
    assert ((margins > 0) == (labels == 1)).all()


def test_language_model_counts(spark, rows, docs, small_groups):
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows}
    frame = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    tokens = {r[0]: [*plain_words(r[1], lower=True), "\n"] for r in rows}
    counts = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for r in lm.score(frame).collect():
        ws = tokens[r["doc"]]
        assert r["held_out"] == held[r["doc"]] and r["n_tokens"] == len(ws) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[w] > 0 for w in ws)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_language_model_learns_from_the_whole_corpus(docs, rows, monkeypatch):
    """A score hangs on the text and the learning documents, not on the group or on held-out rows beside it."""
    from skillframe.llm import groups

    frame = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    scores = lambda x: {r["doc"]: r["score"] for r in lm.score(x).collect()}
    one_group = scores(frame)
    more = frame.where("not held_out").select((F.col("doc_id") + 5000).alias("doc_id"), *(c for c in frame.columns if c not in ("doc_id", "held_out")), F.lit(True).alias("held_out"))
    monkeypatch.setattr(groups, "GROUP_BYTES", 4000)
    many = scores(frame.unionByName(more))
    assert len(many) > len(one_group) == len(rows)
    assert {d: many[d] for d in one_group} == pytest.approx(one_group, rel=1e-9)


def test_language_model_leaves_a_documents_own_outcomes_out():
    import pyarrow as pa

    draw = np.random.default_rng(6)

    def texts(which):
        some = [(i, *v) for i, v in enumerate(given) if i in which]
        n = np.array([len(v[1]) for v in some])
        planes = {c: x for k, name in enumerate(lm._WIDE) for c, x in lm._bytes(name, np.concatenate([v[k + 1] for v in some]), n).items()}
        return lm._Texts(pa.table({"held_out": [False] * len(some), "fold": [v[0] % lm.FOLDS for v in some], "n_tokens": n} | planes), lm._Corpus(5000, 300, 4))

    given = []
    for _ in range(4):
        own, seen = draw.integers(1, 9, 90), draw.integers(0, 9, 90)
        given.append((own + draw.integers(0, 500, 90), draw.integers(0, 40, 90), own, seen, draw.integers(0, 20, 90)))
    everything, one, others = texts({0, 1, 2, 3}), texts({2}), texts({0, 1, 3})
    n, ones = everything.outcomes()
    n_others, ones_others = others.outcomes()
    one.learned = np.zeros(90, bool)
    for k in (0, 1):
        assert everything._odds(k, n, ones)[180:270] == pytest.approx(one._odds(k, n_others, ones_others))


def test_language_model_beats_single_words_on_held_out_rows(spark):
    from skillframe.llm.queries import QUERIES

    got = QUERIES["op7_lm_scoring"](spark, SF).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert got[0] > 0.9 * got[1]


def test_mixture_is_a_probability():
    """Over all tokens that could come next, the mixed probabilities add up to one if the parts do."""
    draw = np.random.default_rng(4)
    first, second = draw.dirichlet(np.ones(50), 2)
    odds, gate = np.repeat(draw.normal(size=(1, 3)), 50, axis=0).astype(np.float32), np.zeros(50, np.int64)
    each = [lm.mixed(first[i : i + 1], second[i : i + 1], np.ones(1, bool), odds[i : i + 1], gate[:1], np.array([0, 1]))[0] for i in range(50)]
    assert sum(each) == pytest.approx(1)


def test_language_model_of_odd_rows(spark, no_docs):
    assert lm.score(no_docs.withColumn("held_out", F.lit(False))).count() == 0
    odd = spark.createDataFrame([(None, None, "", "", 0, "", ""), (1, "", "", "", 0, "", ""), (1, "a a", "", "", 0, "", "")], DOCS)
    none = lm.score(odd.withColumn("held_out", F.lit(True))).collect()
    assert sorted(r["n_tokens"] for r in none) == [1, 1, 3] and {r["train_tokens"] for r in none} == {0}
    assert all(math.isfinite(r["score"]) for r in none)


def test_digests_of_the_chat_query(spark):
    from skillframe.llm.queries import QUERIES

    row = QUERIES["op9_chat_formatting"](spark, SF).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row["loss_chars"] == len(said) and row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
