"""One registered query per operator: its whole table, production parameters, the full result.

Each query is thin: the operator in its own module does the work, and the query names the columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB formulations, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text with the 32k piece model and decode it again."""
    from .piece_codec import codec_digest

    return codec_digest(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text with the 49k word vocabulary."""
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, notices and identifier expressions of every text."""
    from .license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the learned decision list over every text."""
    from .quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document: weights 3, 1, 2 over the sources, 150% of all words."""
    from .mixing import takes

    return takes(table(spark, sf_dir, "documents"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and the components of those within 4 bits of each other."""
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts inside 20-word windows that start earlier elsewhere, removed."""
    from .substring_dedup import substring_digest

    return substring_digest(table(spark, sf_dir, "documents"))


ORACLE_SQL["op10_substring_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM texts
), windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i,
         unnest(list_transform(range(1, len(ws) - 18), lambda k: array_to_string(ws[k:k + 19], ' '))) AS win
  FROM texts WHERE len(ws) >= 20
), again AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS repeated FROM windows
), covered AS (
  SELECT words.doc_id, words.i, words.w,
         max(coalesce(repeated, false)::int) OVER (
           PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN again ON again.doc_id = words.doc_id AND again.i = words.i
), per_doc AS (
  SELECT doc_id, count(*) AS n, sum(gone) AS gone, string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS kept
  FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN per_doc USING (doc_id)
"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the rows that are not held out."""
    from .language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


@query
def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, learned from the labelled rows that are not held out."""
    from .quality_gam import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95 or more."""
    from .embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op7_embedding_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), counts AS (
  SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counts USING (vec_id)
JOIN (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x) USING (vec_id)
"""


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern matches and literals that reach names of secrets, of every text."""
    from .secret_scan import secret_digest

    return secret_digest(table(spark, sf_dir, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened by their 16 leading components."""
    from .embedding_whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with its members, children, leaves and savings."""
    from .prefix_trie import trie

    return trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op13_prefix_trie"] = r"""
WITH ranked AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), letters AS (
  SELECT conv_id AS c, list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda k: ascii(substr(conv_id::VARCHAR, k, 1))::UBIGINT) AS bs
  FROM ranked WHERE i = 1
), heads AS (
  SELECT c AS conv_id, (xor(list_reduce(list_prepend(4294967295::UBIGINT, bs), lambda v, b:
    list_reduce(list_prepend(xor(v, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda u, z:
      CASE WHEN u % 2 = 1 THEN xor(u >> 1, 3988292384::UBIGINT) ELSE u >> 1 END)), 4294967295::UBIGINT) % 4)::BIGINT AS h
  FROM letters
), rebuilt AS (
  SELECT heads.conv_id, r.i, r.role, r.txt FROM heads JOIN ranked r ON r.conv_id = heads.conv_id - heads.conv_id % 20 AND r.i <= h
  UNION ALL
  SELECT heads.conv_id, r.i, r.role, r.txt FROM heads JOIN ranked r ON r.conv_id = heads.conv_id AND r.i > h
), paths AS (
  SELECT heads.conv_id, coalesce(list({'r': role, 't': txt} ORDER BY i) FILTER (i IS NOT NULL), []) AS path
  FROM heads LEFT JOIN rebuilt USING (conv_id) GROUP BY heads.conv_id
), members AS (
  SELECT conv_id, path[1:d] AS node, d, len(path) = d AS ends FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ended,
         CASE WHEN any_value(d) = 0 THEN 0 ELSE len(regexp_extract_all(node[-1].t, '[^ 	-
]+')) END AS words
  FROM members GROUP BY node
), family AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT f.node[1:k] AS node, sum((c.n IS NULL)::INT) AS leaves, sum((f.n_convs - 1) * f.words) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM family) f LEFT JOIN children c ON c.node = f.node GROUP BY 1
)
SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(f.ended) AS ends_sha256
FROM family f LEFT JOIN children c ON c.node = f.node JOIN below b ON b.node = f.node
"""
