"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from .bpe import bpe_encode
from .compression_quality import compression_quality
from .exact_dedup import exact_dedup
from .html_text import html_text
from .lexical_search import lexical_search
from .mixing import mix_sources
from .ngram_join import ngram_join
from .pii import find_pii
from .quality_rules import quality_rules
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .token_alignment import align_tokenizers
from .toxicity import toxicity


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).drop("draw")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(read_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_compression_quality": op3_compression_quality,
    "op4_pii": op4_pii,
    "op5_ngram_join": op5_ngram_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_alignment": op12_token_alignment,
    "op13_html_text": op13_html_text,
}

ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), o AS (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM d WHERE len(w) > 0),
c AS (SELECT count(DISTINCT rid)::BIGINT AS docs, count(*)::BIGINT AS terms FROM o),
p AS (SELECT rid, doc_id, term, any_value(n)::BIGINT AS n, count(*)::BIGINT AS tf FROM o GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term, docs),
q AS (
  SELECT DISTINCT item_id, text,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), s AS (
  SELECT item_id, text, rid, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN t USING (term), c GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
""",
    "op6_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""",
    "op1_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT rid, i, array_to_string(w[i : i + 34], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN twice USING (s)),
kept AS (
  SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
  FROM (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
""",
}
