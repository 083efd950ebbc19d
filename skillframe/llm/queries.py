"""The operators of this folder as queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import chat, html, jaccard, lines, lm, merkle, mixing, quality, substrings, tokens, topk, trie, winnow

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = mixing.place(table(spark, sf_dir, "documents"))
    return places.select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.size("places")).cast("long").alias("taken"))


OP2_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM total),
weighted AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1]::DOUBLE AS weight FROM ranked),
leveled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size) OVER w, 0) * 2::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighted WINDOW w AS (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (
  SELECT arg_min(level, (source_size::DOUBLE / weight, rank)) AS level FROM leveled WHERE level * weight <= 2 * source_size::DOUBLE),
goal AS (
  SELECT rank, source, source_size, least(2 * source_size::DOUBLE, coalesce((SELECT level FROM opened) * weight, 2 * source_size::DOUBLE)) AS target
  FROM weighted),
rest AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds,
         least(65536, greatest(1, ceil(source_size / 16384)))::BIGINT AS n_blocks FROM goal),
keyed AS (
  SELECT s.doc_id, s.size, r.*, r.target - r.rounds * r.source_size AS rest,
         ('0x' || substr(md5('7:' || coalesce(s.doc_id::VARCHAR, 'null') || ':' || s.size), 1, 15))::BIGINT AS key
  FROM sizes s JOIN rest r ON s.source IS NOT DISTINCT FROM r.source),
dealt AS (SELECT *, key % n_blocks AS block FROM keyed),
blocks AS (SELECT rank, block, sum(size)::BIGINT AS words, any_value(rest) AS rest FROM dealt GROUP BY rank, block),
listed AS (
  SELECT *, sum(words) OVER (PARTITION BY rank ORDER BY ('0x' || substr(md5('8:' || rank || ':' || block), 1, 15))::BIGINT, block) - words AS before
  FROM blocks),
cut AS (SELECT *, before + words <= rest AS whole, row_number() OVER (PARTITION BY rank
         ORDER BY before + words > rest, ('0x' || substr(md5('8:' || rank || ':' || block), 1, 15))::BIGINT, block) AS pos FROM listed),
parts AS (
  SELECT *, NOT whole AND rest > 0 AND pos <= 4 + count(*) FILTER (WHERE whole) OVER (PARTITION BY rank) AS part FROM cut),
placed AS (SELECT d.*, c.before, c.whole, c.part FROM dealt d JOIN parts c USING (rank, block)),
lists AS (
  SELECT rank, max(rest - before) AS left,
         list({'left': 0::DOUBLE, 'got': []::BIGINT[], 'z': size, 'h': h, 'k': key} ORDER BY h) AS v
  FROM (SELECT *, ('0x' || substr(md5('9:' || key), 1, 15))::BIGINT AS h FROM placed WHERE part) GROUP BY rank),
fitted AS (
  SELECT rank, v, list_reduce(v, lambda s, d: CASE WHEN d.z <= s.left
         THEN {'left': s.left - d.z, 'got': list_append(s.got, d.k), 'z': 0::BIGINT, 'h': 0::BIGINT, 'k': 0::BIGINT} ELSE s END,
         {'left': "left", 'got': []::BIGINT[], 'z': 0::BIGINT, 'h': 0::BIGINT, 'k': 0::BIGINT}) AS fit FROM lists),
ended AS (
  SELECT rank, fit, list_sort(list_transform(list_filter(v, lambda x: NOT list_contains(fit.got, x.k)), lambda x: {'z': x.z, 'h': x.h, 'k': x.k}))[1] AS next
  FROM fitted),
greedy AS (SELECT rank, unnest(CASE WHEN next.z < 2 * fit.left THEN list_append(fit.got, next.k) ELSE fit.got END) AS key FROM ended)
SELECT doc_id, size, source_size, target,
       size * (rounds + CASE WHEN whole OR (part AND (rank, key) IN (SELECT (rank, key) FROM greedy)) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM placed
"""


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def in_part(doc: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % parts == part, F.lit(False))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~in_part("doc_id", 3, 1))
    scored = quality.score(docs.withColumn("held_out", in_part("doc_id", 3, 1)), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS v FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(v[s : s + 12], ' ') AS t FROM (SELECT doc_id, v, unnest(range(1, len(v) - 11)) AS s FROM w WHERE len(v) >= 13)),
first AS (SELECT t, min(doc_id) AS doc_id FROM windows GROUP BY t),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM windows JOIN (SELECT t, doc_id AS d FROM first) USING (t) WHERE d < doc_id),
words AS (SELECT doc_id, unnest(v) AS word, generate_subscripts(v, 1) AS p FROM w),
judged AS (SELECT words.*, gone.p IS NOT NULL AS removed FROM words LEFT JOIN gone USING (doc_id, p)),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed) AS text
  FROM judged GROUP BY doc_id)
SELECT w.doc_id, len(v)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", in_part("doc_id", 7, 2).alias("held_out"))
    return lm.score(docs).withColumnRenamed("doc", "doc_id")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = winnow.n_hit(F.col("spans"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


OP8_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, m, w[s : s + m - 1] AS v FROM (
    SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM item_words WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, s, m, w[s : s + m - 1] AS v FROM (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM doc_words, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)),
hits AS (SELECT d.doc_id, d.s, d.m, i.item_id FROM doc_windows d JOIN item_windows i ON d.v = i.v),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    record = f'{{"messages":[{{"role":"user","content":"{said}"}},{{"role":"assistant","content":"{said}"}}]}}'
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(record).alias("payload"))
    turns = chat.from_rows(table(spark, sf_dir, "conversations")).unionByName(chat.from_records(extra))
    read = chat.format_chats(turns).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.parse_chat(F.col("formatted")).alias("t"),
        F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    spoken = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP9_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g') AS e_role,
         regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g') AS e_text FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, e_text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, e_text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(3 + 6 + length(e_role) + 7 + length(e_text) + 4)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
lines AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM split),
spread AS (
  SELECT bare, min((doc_id, pos)) AS first FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 10),
judged AS (
  SELECT l.*, s.first IS NOT NULL AND s.first <> (l.doc_id, l.pos) AS gone FROM lines l LEFT JOIN spread s USING (bare))
SELECT doc_id, count(*) FILTER (WHERE bare <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("id") % 100 == 0), 10)


OP10_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored) WHERE rank <= 10
"""

def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = tokens.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    found = tokens.count_tokens(table(spark, sf_dir, "documents"), pieces)
    return found.select(F.col("doc").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = trie.sequences(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.branched(said, 5, 9))


OP12_SQL = r"""
WITH said AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS v FROM said GROUP BY c),
hashed AS (
  SELECT c, v, (4294967295 - list_reduce(list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT),
         lambda s, b: list_reduce(range(8), lambda t, i: xor(t >> 1, 3988292384 * (t & 1)), xor(s, b)), 4294967295::BIGINT)) % 9 AS h FROM own),
built AS (
  SELECT o.c, list_concat(coalesce(b.v, [])[1 : o.h], o.v[o.h + 1 :]) AS v FROM hashed o LEFT JOIN own b ON b.c = o.c - o.c % 5),
nodes AS (
  SELECT depth, v[1 : depth] AS p, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = len(v)), '')) AS ends_sha256
  FROM (SELECT c, v, unnest(range(0, len(v) + 1)) AS depth FROM built) GROUP BY ALL),
kids AS (SELECT p[1 : depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own_sums AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(p[depth].text) END AS saved
  FROM nodes LEFT JOIN kids USING (p)),
below AS (
  SELECT p[1 : k] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM own_sums) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM own_sums n JOIN below USING (p) LEFT JOIN nodes u ON n.depth > 0 AND u.p = n.p[1 : n.depth - 1]
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = ["doc_id", "source", "lang", "n_chars"]
    text, even = F.col("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    # What storage gives back: in every second row by id the line ends are lost.
    given_back = F.when(F.coalesce(even, F.lit(False)), F.translate(text, "\n", "")).otherwise(text)
    leaves = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc"), "source", merkle.leaf_of(*map(F.col, named), text).alias("leaf"),
        merkle.leaf_of(*map(F.col, named), given_back).alias("seen"))
    return merkle.audit(leaves).withColumnRenamed("doc", "doc_id")


OP13_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text, concat_ws('', CASE WHEN doc_id IS NULL THEN '-' ELSE length(doc_id::VARCHAR) || ':' || doc_id END,
         CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END, CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
         CASE WHEN n_chars IS NULL THEN '-' ELSE length(n_chars::VARCHAR) || ':' || n_chars END) AS head,
         CASE WHEN ((list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
         lambda s, b: list_reduce(range(8), lambda t, i: xor(t >> 1, 3988292384 * (t & 1)), xor(s, b)), 4294967295::BIGINT)) & 1) = 1
         THEN replace(text, chr(10), '') ELSE text END AS seen_text
  FROM documents),
leafs AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(seen_text) || ':' || seen_text, '-')) AS seen FROM fields),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER () AS row FROM leafs),
lv(tree, k, i, d, n) AS (
  SELECT tree, 0, r, leaf, n FROM ranked
  UNION ALL SELECT tree, k + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM lv WHERE n > 1 GROUP BY tree, k, n, i // 3),
subroots AS (SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS r, count(*) OVER () AS n FROM lv WHERE n = 1),
up(k, i, d, n) AS (
  SELECT 0, r, subroot, n FROM subroots
  UNION ALL SELECT k + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY k, n, i // 3),
steps AS (
  SELECT x.row, l.k, 0 AS part, string_agg(l.d, '' ORDER BY l.i) FILTER (WHERE l.i < x.r // (3 ** l.k)::BIGINT) AS before,
         string_agg(l.d, '' ORDER BY l.i) FILTER (WHERE l.i > x.r // (3 ** l.k)::BIGINT) AS after
  FROM ranked x JOIN lv l ON l.tree = x.tree AND l.n > 1 AND l.i // 3 = (x.r // (3 ** l.k)::BIGINT) // 3 GROUP BY x.row, x.r, l.k
  UNION ALL
  SELECT x.row, l.k, 1, string_agg(l.d, '' ORDER BY l.i) FILTER (WHERE l.i < s.r // (3 ** l.k)::BIGINT),
         string_agg(l.d, '' ORDER BY l.i) FILTER (WHERE l.i > s.r // (3 ** l.k)::BIGINT)
  FROM ranked x JOIN subroots s USING (tree) JOIN up l ON l.n > 1 AND l.i // 3 = (s.r // (3 ** l.k)::BIGINT) // 3 GROUP BY x.row, s.r, l.k),
listed AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY part, k) AS step FROM steps),
proofs AS (SELECT row, sha256(string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY step)) AS proof_sha256 FROM listed GROUP BY row),
folding(row, step, d) AS (
  SELECT row, 0, seen FROM ranked
  UNION ALL SELECT f.row, l.step, sha256(coalesce(l.before, '') || f.d || coalesce(l.after, ''))
  FROM folding f JOIN listed l ON l.row = f.row AND l.step = f.step + 1),
folded AS (SELECT row, arg_max(d, step) AS folded_root FROM folding GROUP BY row)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM ranked JOIN (SELECT tree, subroot FROM subroots) USING (tree) JOIN folded USING (row) LEFT JOIN proofs USING (row)
CROSS JOIN (SELECT d AS root FROM up WHERE n = 1)
"""

QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_topk_search": op10_topk_search,
    "op11_token_counts": op11_token_counts,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op2_source_mixing": OP2_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op9_chat_formatting": OP9_SQL,
    "op10_topk_search": OP10_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
