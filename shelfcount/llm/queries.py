"""The operators as registered queries, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, interleave, langid, licenses, page_diff, pair_bitmaps, poisson_mix, postings, ppm, simhash, skipchain, term_search, viterbi
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontam.leak_report(docs, table(spark, folder, "benchmark"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.scored(table(spark, folder, "documents"))


#: A-Z to a-z and nothing else.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op1_decontamination"] = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM doc, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, k, p.n FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return interleave.shard_digest(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language_digest(table(spark, folder, "documents"))


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return postings.neighbours(table(spark, folder, "embeddings"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return skipchain.personal_digest(table(spark, folder, "documents"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return poisson_mix.mix_digest(table(spark, folder, "documents"))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.text_digest(table(spark, folder, "pages"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return viterbi.token_digest(table(spark, folder, "documents"))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digest(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return term_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op12_lexical_search"] = f"""
WITH word AS (
  SELECT row, doc_id, unnest({_WORDS}) AS term FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*)::BIGINT AS tf FROM word GROUP BY ALL),
len AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
total AS (SELECT count(*)::BIGINT AS n_texts, sum(n)::BIGINT AS n_terms FROM len),
weight AS (
  SELECT term, floor(1000 * ln((2 * max(n_texts) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_texts) // n_terms))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN len USING (row), total GROUP BY item_id, row, doc_id)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY rank <= 10
"""


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return pair_bitmaps.alignment_digest(table(spark, folder, "documents"))


ORACLES["op8_mixing"] = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS size, sqrt(sum(coalesce(strlen(text), 0) + 1)::DOUBLE) AS weight
  FROM documents GROUP BY source),
rates AS (
  SELECT source, weight / (SELECT sum(weight::DECIMAL(38, 10))::DOUBLE FROM sizes) * (SELECT sum(size)::DOUBLE FROM sizes) / size AS rate
  FROM sizes),
steps AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM rates)),
drawn AS (
  SELECT doc_id, source, ('0x' || substr(md5(concat_ws('|', '{poisson_mix.SEED}:count', doc_id::VARCHAR, source)), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents),
counted AS (
  SELECT doc_id, d.source, count(*) FILTER (upto <= u)::INTEGER AS n_copies
  FROM drawn d JOIN steps s ON d.source = s.source GROUP BY doc_id, d.source),
copies AS (SELECT doc_id, source, n_copies, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM counted)
SELECT *, ('0x' || substr(md5(concat_ws('|', '{poisson_mix.SEED}:place', doc_id::VARCHAR, source, copy::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0 AS place
FROM copies
"""

for _query in (
    op1_decontamination,
    op2_lm_scoring,
    op3_simhash,
    op4_sharding,
    op5_language_id,
    op6_nearest_neighbours,
    op7_personal_data,
    op8_mixing,
    op9_main_text,
    op10_token_counts,
    op11_license_scan,
    op12_lexical_search,
    op13_tokenizer_alignment,
):
    QUERIES[_query.__name__] = _query
