"""Queries of the operators on words and phrases: language model, search, collocations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobstrata.catalog.registry import table
from jobstrata.llm import collocations, maxent_lm, ranked_search
from jobstrata.llm.registry import corpus_query

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

@corpus_query()
def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.scored(table(spark, sf_dir, "documents"))


# ---- op12: every document scored for every item

OP12_SQL = rf"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * N_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, N_docs),
impacts AS (
  SELECT doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * N_docs) // L))) AS impact
  FROM tf JOIN lengths USING (doc_id) JOIN weights USING (term), corpus),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_LOWER}),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores)
WHERE rank <= 10
"""


@corpus_query(OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search.ranked(docs, table(spark, sf_dir, "benchmark"))


# ---- op13: every phrase of one to five words is listed by itself, cut and compared

OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
  FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM listed GROUP BY lang),
spans AS (
  SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda i: ws[i : i + 4])) AS ws
  FROM listed),
said AS (SELECT lang, ws[1 : k] AS words FROM spans, range(1, 6) AS t(k) WHERE k <= len(ws)),
f AS (SELECT lang, words, count(*) AS f FROM said GROUP BY ALL HAVING count(*) >= 100),
cut AS (
  SELECT lang, words, f AS a, k, words[1 : k] AS head, words[k + 1 : len(words)] AS tail
  FROM f, range(1, 5) AS t(k) WHERE k < len(words)),
cuts AS (
  SELECT c.lang, c.words, c.a, c.k, l.f AS l, r.f AS r, n,
    CAST(1000::HUGEINT * c.a * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cut c JOIN f l ON l.lang = c.lang AND l.words = c.head
    JOIN f r ON r.lang = c.lang AND r.words = c.tail JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, f, words[i : i + k - 1] AS words
  FROM f, range(1, 6) AS s(i), range(2, 5) AS t(k)
  WHERE k < len(words) AND i + k - 1 <= len(words)),
longer AS (SELECT lang, words, max(f) AS f FROM inner_ GROUP BY lang, words),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.words = b.words
  WHERE x.f IS NULL OR 100 * x.f < 100 * b.a),
ranked AS (
  SELECT *, array_to_string(words, ' ') AS phrase FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM ranked) WHERE rank <= 2000
"""


@corpus_query(OP13_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
