"""Token counts, the trie of conversations and the Merkle manifest against plain Python."""

import collections
import hashlib
import random
import zlib

import pytest
from conftest import DOCS
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skillframe.llm import merkle, tokens, trie
from skillframe.llm.queries import op12_prefix_trie, op13_merkle_manifest

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return tokens.read_pieces(public_tokenizers.path(MODEL))


ODD = ["", " ", "   ", "a", " a  b ", "<s> hi </s><unk><0x0A>", "é\x00x▁y ▁ z▁▁", "𝔘 日本語 　x\tq\r\n\n\n", "ﬁ Å ²½", " " * 400 + "x" + " " * 37,
       "ab" * 4000, "the" * 3000 + " " + "=" * 999, "á​﻿b  ", "1234567 89", "▁", "▁ ▁"]


def test_counts_equal_the_library(spark, rows, docs, library, pieces):
    odd = [(10_000 + i, t, "", "", 0, "", "") for i, t in enumerate(ODD)] + [(None, "no id", "", "", 0, "", ""), (1, "twice", "", "", 0, "", "")]
    got = tokens.count_tokens(docs.unionByName(spark.createDataFrame(odd, DOCS)), pieces).collect()
    want = [(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in [*rows, *odd]]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_no_texts_no_counts(no_docs, pieces):
    assert tokens.count_tokens(no_docs, pieces).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abtheinr ▁ \nß日1<>s/") | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_counts_as_in_the_library(library, pieces, text):
    assert tokens.count_text(text, tokens._Counts(pieces.ranks)) == len(library.encode(text))


def test_remembered_units_are_bounded(monkeypatch, pieces):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    counts = tokens._Counts(pieces.ranks)
    text = " ".join(f"w{i % 13}" for i in range(100)) + "q" * 100
    assert tokens.count_text(text, counts) == tokens.count_text(text, tokens._Counts(pieces.ranks))
    assert len(counts) <= 5


def turns_of(rows):
    made = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said, text = role or "", text or ""
            digest = hashlib.md5(f"{len(said.encode())}:{said}{text}".encode()).hexdigest()
            made[c].append((turn is not None, turn or 0, digest, said, text))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in made.items()}


def rebuilt(made):
    out = {}
    for c, own in made.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = made.get(c - c % 5, [])[:h] + own[h:]
    return out


def expected_nodes(made):
    members = collections.defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += own
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(made[c]) == len(p)))).encode()).hexdigest()) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string, t string, seq string, shard string"


def conversations(seed=3):
    draw = random.Random(seed)
    rows = []
    for c in range(160):
        n = draw.choice([1, 2, 3, 5, 8, 12])
        copy = c % 3 == 0  # a third of all conversations are one text
        for k in range(n if not copy else 7):
            text = f"copy {k}" if copy else draw.choice(["", "a", "bé", "a longer text"])
            rows.append((c, k, "user" if k % 2 == 0 else "assistant", text))
    rows += [(500, k, "user", f"t{k % 4}") for k in range(60)] + [(501, k, "user", f"t{k % 4}") for k in range(61)]
    rows += [(700, None, None, None), (700, None, "x", None), (700, 1, "x", "y"), (700, 1, "x", "y"), (None, 1, "user", "lost"), (-7, 0, "user", "a")]
    draw.shuffle(rows)
    return [(*r, "clash", "clash", "clash") for r in rows]


def found_nodes(made):
    assert made.columns == COLUMNS
    return sorted(map(tuple, made.collect()))


@pytest.mark.parametrize("shard_bytes", [300, 2000, 4 << 20])
def test_nodes_equal_plain_python(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(trie, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(trie, "SLAB", 3)
    monkeypatch.setattr(trie, "CELL", 2)
    rows = conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    made = turns_of([r[:4] for r in rows])
    said = trie.sequences(turns)
    assert found_nodes(trie.prefix_trie(said)) == expected_nodes(made)
    assert found_nodes(trie.prefix_trie(trie.branched(said, 5, 9))) == expected_nodes(rebuilt(made))


def test_turnless_conversations_and_none(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_BYTES", 64)
    none = spark.createDataFrame([], "conv long, t array<struct<digest:string,size:int>>")
    assert found_nodes(trie.prefix_trie(none)) == []
    some = spark.createDataFrame([(c, []) for c in range(20)], none.schema)
    assert found_nodes(trie.prefix_trie(some)) == expected_nodes({c: [] for c in range(20)})


def test_trie_of_the_table_in_many_shards(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_BYTES", 1000)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found_nodes(op12_prefix_trie(spark, sf_dir)) == expected_nodes(rebuilt(turns_of(rows)))


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    """All levels of a tree, leaves first."""
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        out.append(nodes)
    return out


def path(tree, at):
    for nodes in tree[:-1]:
        run = at - at % 3
        yield "".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])
        at //= 3


def expected_manifest(rows):
    """rows: (doc, source, leaf, seen)."""
    of = collections.defaultdict(list)
    for r in rows:
        of["" if r[1] is None else "s" + r[1]].append(r)
    for v in of.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    names = sorted(of, key=str.encode)
    trees = {s: climb([r[2] for r in of[s]]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, r in enumerate(of[s]):
            steps = [*path(trees[s], at), *path(top, k)]
            node = r[3]
            for before, after in steps:
                node = h(before + node + after)
            out.append((r[0], r[2], trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return collections.Counter(out)


@pytest.mark.parametrize(("height", "range_rows"), [(1, 7), (2, 100_000), (6, 40)])
def test_manifest_equals_plain_python(spark, monkeypatch, height, range_rows):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "RANGE_ROWS", range_rows)
    draw = random.Random(2)
    rows = [(i, draw.choice(["a", "a", "a", "é", "B", None, "", "only"[: 1 + i % 4]]), h(f"leaf {i}"), h(f"leaf {i}" if i % 2 else f"other {i}")) for i in range(150)]
    rows += [(5, "a", h("again"), h("again")), (None, "a", h("none"), h("none")), (None, None, h("none"), h("none"))] + [(77, "copies", h("same"), h("same"))] * 60
    draw.shuffle(rows)
    leaves = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc long, source string, leaf string, seen string, rank string, tree string").repartition(3)
    got = collections.Counter(tuple(r) for r in merkle.audit(leaves.select("doc", "source", "leaf", "seen")).collect())
    assert got == expected_manifest(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, h("x"), h("y"))], [(1, "a", h("x"), h("x")), (2, "b", h("y"), h("y"))]])
def test_manifest_of_few_rows(spark, rows):
    leaves = spark.createDataFrame(rows, "doc long, source string, leaf string, seen string")
    assert collections.Counter(tuple(r) for r in merkle.audit(leaves).collect()) == (expected_manifest(rows) if rows else collections.Counter())


def test_leaves_and_what_was_tampered(spark, tmp_path):
    rows = [(i, t, lang, s, n) for i, (t, lang, s, n) in enumerate([
        (None, None, None, None), ("", "", "", 0), ("é\n日", "de", "s:1", 3), ("a\nb\n", "-", "-", -4), ("no end", "en", "x", 6), ("\n", "en", "x", 1)])]
    rows += [(None, "a\nb", "en", "x", 3), (0, "a\nb", "en", None, 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("rank", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")

    def leaf(doc, text, lang, source, n):
        return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)))

    made = []
    for doc, text, lang, source, n in rows:
        lost = text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0
        made.append((doc, source, leaf(doc, text, lang, source, n), leaf(doc, text.replace("\n", "") if lost else text, lang, source, n)))
    got = collections.Counter(tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect())
    assert got == expected_manifest(made)
    assert any(not r[-1] for r in got)
