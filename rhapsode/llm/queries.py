"""The queries of this folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(load(spark, sf_dir, "documents")).drop("copies")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linedup import repeated_runs

    return repeated_runs(load(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .paragraphs import repeated_paragraphs

    return repeated_paragraphs(load(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokenio import read_tokens, tokenizer_path, write_tokens

    return read_tokens(write_tokens(load(spark, sf_dir, "documents"), tokenizer_path()))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores

    return toxicity_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import repeated_passages

    return repeated_passages(load(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_personal_data

    return find_personal_data(load(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .egojoin import near_vectors

    return near_vectors(load(spark, sf_dir, "embeddings"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contained_items

    return contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_groups

    return simhash_groups(load(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefixtrie import prefix_trie

    return prefix_trie(load(spark, sf_dir, "conversations"))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ppm import lm_scores

    return lm_scores(load(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations

    return collocations(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mixing, op2_line_dedup, op3_substring_dedup, op4_token_output, op5_toxicity, op6_suffix_dedup, op7_personal_data, op8_embedding_dedup, op9_decontamination, op10_simhash, op11_prefix_trie, op12_language_model, op13_collocations)}

SQL: dict[str, str] = {}

SQL["op9_decontamination"] = r"""
WITH d AS (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, text FROM documents WHERE text IS NOT NULL
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL
), k AS (SELECT DISTINCT least(len(w), 5) AS n FROM b WHERE len(w) > 0
), dg AS (
  SELECT DISTINCT doc_id, md5(text) AS k, unnest(list_transform(range(1, len(w) - k.n + 2), lambda i: array_to_string(w[i:i + k.n - 1], ' '))) AS g FROM d, k WHERE len(w) >= k.n
), bg AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS g FROM b WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_shingles FROM bg GROUP BY item_id)
SELECT DISTINCT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment FROM (
  SELECT dg.doc_id, dg.k, bg.item_id, count(*) AS n_found FROM dg JOIN bg USING (g) GROUP BY ALL
) JOIN n USING (item_id) WHERE n_found >= 0.8 * n_shingles - 1e-9
"""

SQL["op2_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x, i: {'line_no': i - 1, 'x': trim(x, chr(32) || chr(9) || chr(11) || chr(12) || chr(13))}), lambda s: s.x <> '') AS ls FROM documents WHERE text IS NOT NULL
), l AS (
  SELECT doc_id, unnest(ls, recursive := true), unnest(range(0, len(ls))) AS seq FROM d
), m AS (
  SELECT p.doc_id, p.seq, q.doc_id AS qd, q.seq AS qs FROM l p JOIN l q ON p.x = q.x AND (q.doc_id < p.doc_id OR (q.doc_id = p.doc_id AND q.seq < p.seq))
), e AS (
  SELECT *, seq - row_number() OVER (PARTITION BY doc_id, qd, seq - qs ORDER BY seq) AS island FROM m
), r AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, qd, seq - qs, island ORDER BY seq DESC) AS n FROM e
), b AS (
  SELECT doc_id, seq, n, qd, qs FROM r QUALIFY row_number() OVER (PARTITION BY doc_id, seq ORDER BY n DESC, qd, qs) = 1
), w AS (
  SELECT * FROM b QUALIFY seq + n > coalesce(max(seq + n) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
)
SELECT w.doc_id, CAST(p.line_no AS INT) AS line_from, CAST(w.n AS INT) AS n_lines, w.qd AS first_doc_id, CAST(q.line_no AS INT) AS first_line
FROM w JOIN l p ON p.doc_id = w.doc_id AND p.seq = w.seq JOIN l q ON q.doc_id = w.qd AND q.seq = w.qs
"""

SQL["op8_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), u AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93::DOUBLE
), r AS (
  SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a
), c AS (SELECT a, min(c) AS component_id FROM r GROUP BY a), d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN d ON d.a = v.vec_id
"""

SQL["op13_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), g AS (
  SELECT lang, k.m, unnest(list_transform(range(1, len(ws) - k.m + 2), lambda i: ws[i:i + k.m - 1])) AS ph FROM w, (SELECT unnest(range(1, 6)) AS m) k WHERE len(ws) >= k.m
), f AS (SELECT lang, m, ph, count(*) AS f FROM g GROUP BY ALL
), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (SELECT lang, m, ph, f AS a FROM f WHERE m > 1 AND f >= 100
), sub AS (
  SELECT lang, ph[i:i + j - 1] AS ph, max(a) AS longest FROM (
    SELECT lang, a, m, ph, j, unnest(range(1, m - j + 2)) AS i FROM (SELECT lang, a, m, ph, unnest(range(2, m)) AS j FROM c)) GROUP BY ALL
), k AS (
  SELECT c.lang, c.ph, c.a, c.m FROM c LEFT JOIN sub ON sub.lang = c.lang AND sub.ph = c.ph WHERE longest IS NULL OR 100 * longest < 100 * c.a
), s AS (
  SELECT k.lang, k.ph, k.a, x.f AS l, y.f AS r, n.n, h.cut, 1000::HUGEINT * k.a * n.n // (x.f::HUGEINT * y.f) AS score
  FROM k JOIN (SELECT unnest(range(1, 5)) AS cut) h ON h.cut < k.m JOIN f x ON x.lang = k.lang AND x.ph = k.ph[1:h.cut] JOIN f y ON y.lang = k.lang AND y.ph = k.ph[h.cut + 1:k.m] JOIN n ON n.lang = k.lang
), b AS (
  SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

#: crc32 is spelled out: a table of 256 steps of the polynomial, then a fold over the digits.
SQL["op11_prefix_trie"] = """
WITH e AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY i) AS tab FROM range(256) t(i)
), o AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT c, s, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295) % 9 AS h FROM o, e
), q AS (
  SELECT h.c, list_concat(coalesce(b.s, [])[1:h.h], h.s[h.h + 1:]) AS s FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5
), p AS (SELECT c, unnest(range(0, len(s) + 1)) AS d, s, len(s) AS n FROM q
), m AS (
  SELECT d, s[1:d] AS k, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n), '') AS ends FROM p GROUP BY ALL
), w AS (
  SELECT m.*, u.conv_id AS parent, (SELECT count(*) FROM m x WHERE x.d = m.d + 1 AND x.k[1:m.d] = m.k) AS kids FROM m LEFT JOIN m u ON u.d = m.d - 1 AND u.k = m.k[1:m.d - 1]
), b AS (
  SELECT d, k, kids, unnest(range(0, d + 1)) AS up, CASE WHEN d > 0 THEN (n_convs - 1) * strlen(k[d].t) ELSE 0 END AS own FROM w
), t AS (SELECT up AS d, k[1:up] AS k, count(*) FILTER (kids = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens FROM b GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, w.parent AS parent_conv_id, w.n_convs, w.kids AS n_children, t.n_leaves, t.saved_tokens, sha256(w.ends) AS ends_sha256 FROM w JOIN t ON t.d = w.d AND t.k = w.k
"""
