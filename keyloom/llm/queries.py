"""The registered queries opN_<name>, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from keyloom.llm import html, langid, lines, mixing, packing, quality, repair, rules, simhash, tokens, toxicity, trie, vectors
from keyloom.llm.common import table


def _crc_mod(column: str, n: int):
    """crc32 of a column's text, modulo n."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, _crc_mod("doc_id", 3) != 1)
    found = toxicity.score(docs, model)
    return found.select("doc_id", (_crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans")


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_digest(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"), _crc_mod("doc_id", 5) != 0)
    return found.select("doc_id", (_crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), lines_as="n_removed_lines", words_as="n_removed_words")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def graded(labels: DataFrame) -> DataFrame:
    """``labels`` with a grade from 0 to 2: low quality, toxic, good.

    The grades are ordered by what a text is worth to training: one of low quality has nothing to learn from, a toxic one is
    well formed but unwanted, a good one has neither fault.
    """
    return labels.withColumn("grade", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, graded(table(spark, sf_dir, "labels")), _crc_mod("doc_id", 3) != 1)
    found = quality.grades(docs, model)
    return found.select(
        "doc_id", (_crc_mod("doc_id", 3) == 1).alias("held_out"), "expected_grade", F.col("tails")[0].alias("p_above_0"), F.col("tails")[1].alias("p_above_1"),
        (F.col("tails")[0] >= 0.5).alias("kept"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.word_count()).drop("source")


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt_turns(table(spark, sf_dir, "conversations")))


#: crc32 of an ASCII text ``$`` in DuckDB, bit by bit.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split($, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295::BIGINT)"""

OP11_SQL = (
    r"""
WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, """
    + CRC32_SQL.replace("$", "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    + r""" % 20 AS hit FROM conversations),
d AS (SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE hit WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE hit <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i FROM d),
q AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, left(role, 1) AS r,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS r0 FROM p),
f AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM q),
e(letter, was, now, name, cost) AS (VALUES ('K', '', 's', NULL, 0), ('K', '', 'u', NULL, 0), ('K', 's', 'u', NULL, 0), ('K', 'u', 'a', NULL, 0), ('K', 'a', 'u', NULL, 0),
    ('R', '', 'u', 'user', 3), ('R', 's', 'u', 'user', 3), ('R', 'u', 'a', 'assistant', 3), ('R', 'a', 'u', 'user', 3)),
n(ins, was, now, lines, cost) AS (VALUES ('', '', '', ''::VARCHAR, 0), ('', 's', 's', '', 0), ('', 'u', 'u', '', 0), ('', 'a', 'a', '', 0), ('I', '', 'u', chr(10) || 'user:', 3), ('I', 's', 'u', chr(10) || 'user:', 3),
    ('I', 'u', 'a', chr(10) || 'assistant:', 3), ('I', 'a', 'u', chr(10) || 'user:', 3), ('II', '', 'a', chr(10) || 'user:' || chr(10) || 'assistant:', 6), ('II', 's', 'a', chr(10) || 'user:' || chr(10) || 'assistant:', 6)),
w AS (SELECT conv_id, 0::BIGINT AS i, '' AS state, 0 AS cost, ''::VARCHAR AS audit, ''::VARCHAR AS lines FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, state, b.cost, b.audit, b.lines FROM (
    SELECT w.conv_id, f.i, coalesce(e.now, n.now) AS state,
      min({'cost': w.cost + n.cost + coalesce(e.cost + CASE fault WHEN 't' THEN 3 ELSE 0 END, 4), 'audit': w.audit || n.ins || coalesce(e.letter, 'D'),
           'lines': w.lines || n.lines || CASE WHEN e.letter IS NULL THEN '' ELSE chr(10) || coalesce(e.name, f.role) || ':' || f.text END}) AS b
    FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN n ON n.was = w.state
      JOIN (SELECT * FROM e UNION ALL SELECT NULL, s, NULL, NULL, NULL FROM (VALUES (''), ('s'), ('u'), ('a')) x(s)) e ON e.was = n.now
    WHERE e.letter IS NULL OR (fault NOT IN ('b', 'd') AND (e.letter = 'R' OR e.now = f.r))
    GROUP BY w.conv_id, f.i, coalesce(e.now, n.now)) t),
z AS (SELECT w.conv_id, min({'cost': w.cost + n.cost, 'audit': w.audit || n.ins, 'lines': w.lines || n.lines}) AS b FROM w JOIN n ON n.was = w.state AND n.now IN ('', 'a')
  WHERE w.i = (SELECT coalesce(max(f.i), 0) FROM f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id) GROUP BY w.conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (r0 IS NOT NULL AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, z.b.cost::BIGINT AS cost, z.b.audit AS audit, sha256(z.b.lines[2:]) AS repaired_sha256
FROM z LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM z.conv_id
"""
)

OP13_SQL = (
    """
WITH o AS (SELECT conv_id AS c, [coalesce(role, ''), coalesce(text, '')] AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT DISTINCT c, """
    + CRC32_SQL.replace("$", "c::VARCHAR")
    + """ % 6 AS h FROM o),
s AS (SELECT k.c, coalesce(l1.l, []) || coalesce(l2.l, []) AS path FROM k
    LEFT JOIN (SELECT k.c, list(o.t ORDER BY o.p) AS l FROM k JOIN o ON o.c = k.c - k.c % 100 AND o.p < k.h GROUP BY k.c) l1 ON l1.c = k.c
    LEFT JOIN (SELECT k.c, list(o.t ORDER BY o.p) AS l FROM k JOIN o ON o.c = k.c AND o.p >= k.h GROUP BY k.c) l2 ON l2.c = k.c),
m AS (SELECT c, len(path) AS n, d, path[1:d] AS node, path[1:d - 1] AS up, path[d][2] AS last_text FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM s)),
g AS (SELECT node, any_value(d) AS d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(length(last_text)), 0) AS saving,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256 FROM m GROUP BY node),
f AS (SELECT g.*, (SELECT count(*) FROM g b WHERE b.d = g.d + 1 AND b.up = g.node) AS n_children FROM g),
t AS (SELECT a.node, sum((b.n_children = 0)::INT) AS n_leaves, sum(b.saving) AS saved FROM f a JOIN f b ON b.d >= a.d AND b.node[1:a.d] = a.node GROUP BY a.node)
SELECT f.conv_id::BIGINT AS conv_id, f.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
    t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN t ON t.node = f.node LEFT JOIN f p ON f.d > 0 AND p.d = f.d - 1 AND p.node = f.up
"""
)

OP10_SQL = r"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM s GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(turn % 3 + 1)::INT] AS weight, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM p),
f AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
g AS (SELECT *, (SELECT arg_min(lv, cap / weight + turn * 1e-9) FROM f WHERE cap > weight * lv) AS level FROM f),
t AS (SELECT source, source_size, CASE WHEN cap <= weight * lv THEN cap ELSE weight * level END AS target FROM g),
d AS (SELECT s.doc_id, s.size, t.source_size, t.target,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(s.doc_id::VARCHAR), s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (floor(target)::BIGINT // source_size) * size
    + greatest(0, least(size, floor(target)::BIGINT % source_size - start)) END::BIGINT AS taken FROM d
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_pack_sequences": op2_pack_sequences,
    "op3_language_id": op3_language_id,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_extract_html": op5_extract_html,
    "op7_line_dedup": op7_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {"op10_mix_sources": OP10_SQL, "op11_repair_conversations": OP11_SQL, "op13_prefix_trie": OP13_SQL}
