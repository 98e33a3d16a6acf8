"""The registered queries of the text operators, with production parameters, and the SQL that some have."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import (
    collision_search, context_tree, exact_dedup, filter_audit, licenses, metric_tree, pii, ranked_search, simhash, toxicity,
)
from ledgerlight.llm.byte_bpe import round_trip
from ledgerlight.llm.common import load
from ledgerlight.llm.packing import pack
from ledgerlight.llm.token_counts import token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(load(spark, folder, "documents"), load(spark, folder, "labels"))


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents"), words=3, distance=3)


@query
def op3_metric_tree(spark: SparkSession, folder: str) -> DataFrame:
    return metric_tree.top_k(load(spark, folder, "embeddings"), k=5, every=50, scale=256)


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(load(spark, folder, "documents"), WORDS, limit=2048)


@query
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(load(spark, folder, "documents"), RANKS)


@query
def op6_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree.scores(load(spark, folder, "documents"))


@query
def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(load(spark, folder, "documents"))


@query
def op8_collision_search(spark: SparkSession, folder: str) -> DataFrame:
    return collision_search.nearest(load(spark, folder, "embeddings"), k=20, every=20)


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(load(spark, folder, "documents"), WORDS, window=4096, end_id=2)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(load(spark, folder, "documents"))
    return found.select(
        "doc_id", *[f"n_{kind}" for kind in pii.BASE_KINDS], F.sha2("base", 256).alias("base_sha256"), "spans",
    )


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(load(spark, folder, "documents"), load(spark, folder, "labels"))


@query
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{folder.rstrip('/')}/documents.parquet")


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.top_documents(load(spark, folder, "documents"), load(spark, folder, "benchmark"), k=10)


def metric_tree_sql(k: int = 5, every: int = 50, scale: int = 256) -> str:
    """Brute force: integer products of every query with every other row."""
    return f"""
WITH v AS (
 SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
 FROM embeddings
 WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
 SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)),
ranked AS (
 SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
 FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""


def licenses_sql() -> str:
    """The same passages, bigrams and coefficients for every pair, without any bound or anchor."""
    templates = ", ".join(
        "({}, [{}])".format(f"'{name}'", ", ".join(f"'{g}'" for g in licenses.bigrams_of(text)))
        for name, text in sorted(licenses.TEMPLATES.items())
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH templates(license, grams) AS (VALUES {templates}),
docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
passages AS (
 SELECT row, unnest(list_distinct(list_concat(list_concat([text], regexp_split_to_array(text, '\n[ \t\r\n]*\n')),
  string_split(text, chr(10))))) AS passage FROM docs),
words AS (
 SELECT row, passage, string_split(trim(regexp_replace(translate(passage, '{upper}', '{lower}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
 FROM passages),
sets AS (
 SELECT row, passage,
  list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM words WHERE len(w) > 1),
compared AS (
 SELECT row, passage, license, 2.0 * len(list_intersect(sets.grams, templates.grams))
  / (len(sets.grams) + len(templates.grams)) AS dice
 FROM sets, templates WHERE list_has_any(sets.grams, templates.grams)),
matched AS (SELECT * FROM compared WHERE dice >= {licenses.THRESHOLD} - 1e-9),
best AS (
 SELECT row, license, dice, row_number() OVER (PARTITION BY row ORDER BY dice DESC, license) AS rn,
 FROM matched),
counted AS (SELECT row, count(DISTINCT passage) AS n FROM matched GROUP BY row)
SELECT doc_id, license, round(dice, 6) AS dice, coalesce(n, 0) AS passages
FROM docs LEFT JOIN (SELECT row, license, dice FROM best WHERE rn = 1) USING (row) LEFT JOIN counted USING (row)"""


ORACLE["op3_metric_tree"] = metric_tree_sql()
ORACLE["op7_licenses"] = licenses_sql()


def filter_audit_sql() -> str:
    """Failure sets counted per part, then every step of every order summed over all sets."""
    blanks = "[\\x20\\x09-\\x0D]+"
    letters = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(filter_audit.FILTERS))
    joins = " ".join(
        f"JOIN f f{i} ON " + " AND ".join(f"f{i}.c <> f{j}.c" for j in range(i)) for i in range(1, len(filter_audit.FILTERS))
    )
    names = " || ".join(f"f{i}.c" for i in range(5))
    steps = " UNION ALL ".join(
        f"SELECT o, {i + 1} AS step, b{i} AS own, {' + '.join([f'b{j}' for j in range(i)] or ['0'])} AS before FROM orders"
        for i in range(5)
    )
    return f"""
WITH d AS (
 SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  list_filter(string_split_regex(coalesce(text, ''), '{blanks}'), lambda w: w <> '') AS words FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
marked AS (
 SELECT doc_id, part,
  CASE WHEN len(words) < {filter_audit.LEAST_WORDS} THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(words)) < {filter_audit.LEAST_DISTINCT} * len(words) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {filter_audit.MOST_CAPITALS} * length(t)
    THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '{filter_audit.MARKS}') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
 FROM d JOIN least USING (t)),
told AS (
 SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
 FROM labels GROUP BY doc_id),
counts AS (
 SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
 FROM marked LEFT JOIN told USING (doc_id) GROUP BY part, mask),
f(c, b) AS (VALUES {letters}),
orders AS (SELECT {names} AS o, {', '.join(f'f{i}.b AS b{i}' for i in range(5))} FROM f f0 {joins}),
steps AS ({steps}),
summed AS (
 SELECT part, o, step, own,
  sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
 FROM counts CROSS JOIN steps GROUP BY part, o, step, own)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
 CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed"""


def exact_dedup_sql() -> str:
    return """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
 row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""


def ranked_search_sql(k: int = 10) -> str:
    """Every document that shares a term with an item is scored."""
    term = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    fold = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH d AS (
 SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), {fold}), '{term}') AS terms
 FROM documents),
lengths AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
items AS (SELECT row_number() OVER () AS item, item_id,
  regexp_extract_all(translate(coalesce(text, ''), {fold}), '{term}') AS terms FROM benchmark),
qtf AS (SELECT item, term, count(*) AS q FROM (SELECT item, unnest(terms) AS term FROM items) GROUP BY item, term),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM qtf) GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, totals),
norms AS (SELECT row, doc_id, 100 - 75 + (75 * n * docs) // total AS m FROM lengths, totals),
scored AS (
 SELECT item, row, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
 FROM qtf JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (row) GROUP BY item, row),
ranked AS (
 SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
 FROM scored JOIN norms USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM ranked JOIN items USING (item) WHERE rank <= {k}"""


ORACLE["op11_filter_audit"] = filter_audit_sql()
ORACLE["op12_exact_dedup"] = exact_dedup_sql()
ORACLE["op13_ranked_search"] = ranked_search_sql()
