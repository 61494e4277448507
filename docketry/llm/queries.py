"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import (
    attention_lm, bpe_codec, chunk_dedup, filter_audit, jaccard_join, mixing, site_quality, spelling, templates, token_counts,
    token_files, toxicity, vp_search,
)
from docketry.sources.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The text of a public tokenizer's file, as its users give it; it goes to the tasks by broadcast."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return counts.transform(token_counts.over(512))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.index(spark, folder)


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


GOOD_FROM = 0.5


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its host and its language the path there."""
    docs = table(spark, sf_dir, "documents")
    model = site_quality.fit(docs, table(spark, sf_dir, "labels"))
    return site_quality.score(docs, model).withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeats(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


TOXIC_FROM = 0.7


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= TOXIC_FROM).cast("int")
    return toxicity.score(docs, model).withColumn("predicted", predicted)


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_token_files": op2_token_files,
        "op3_vector_search": op3_vector_search,
        "op4_site_quality": op4_site_quality,
        "op5_mixing": op5_mixing,
        "op6_decontamination": op6_decontamination,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_toxicity": op10_toxicity,
        "op11_bpe_codec": op11_bpe_codec,
        "op12_filter_audit": op12_filter_audit,
        "op13_spelling": op13_spelling,
    }


JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * both_have >= 75 * (a.n + b.n - both_have)),
reach(origin, node) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT r.origin, l.y FROM reach r JOIN links l ON l.x = r.node)
SELECT origin AS doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(node) AS component_id
FROM reach JOIN sizes ON origin = doc_id GROUP BY origin
"""


FILTER_AUDIT = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (
  SELECT doc_id AS labelled, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {
    'A': len(w) < 100,
    'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(doc_id > first_id, false)} AS f
  FROM words JOIN firsts USING (t) LEFT JOIN marks ON labelled = doc_id),
grouped AS (SELECT part, good, toxic, f, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
growing(o) AS (SELECT x FROM letters UNION ALL SELECT o || x FROM growing, letters WHERE length(o) < 5 AND NOT contains(o, x)),
steps AS (
  SELECT o AS filter_order, CAST(step AS INT) AS step, substr(o, step, 1) AS filter, string_split(substr(o, 1, step - 1), '') AS earlier
  FROM growing, (SELECT unnest(range(1, 6)) AS step) WHERE length(o) = 5),
applied AS (
  SELECT part, filter_order, step, filter, good, toxic, n, f[filter] AS fails,
    len(list_filter(earlier, lambda x: x <> '' AND f[x])) > 0 AS gone, len(list_filter(map_values(f), lambda x: x)) AS failed
  FROM grouped, steps),
found AS (
  SELECT part, filter_order, step, filter,
    CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM applied GROUP BY ALL)
SELECT * EXCLUDE (filter), CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM found
"""

# The CRC of a text, byte by byte with the table that the polynomial 0xEDB88320 gives; near words by a join of their
# forms with one code point left out, or put out of sight at its place.
SPELLING = r"""
WITH RECURSIVE bytes AS (SELECT range AS b FROM range(256)),
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
    ORDER BY b) AS entries FROM bytes),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents),
lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'),
      lambda x: CAST('0x' || x AS BIGINT)),
    lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM lowered, crc_table),
written AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
hidden AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS less FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM hidden a JOIN hidden b ON a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN vocabulary b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN vocabulary b ON a.less = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * v.n THEN other END AS form,
    CASE WHEN other_n >= 10 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON b.word = v.word),
chain(word, here, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form)
SELECT f.word, f.form, c.here AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""


def statements() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can express."""
    return {"op8_jaccard_join": JACCARD_JOIN, "op12_filter_audit": FILTER_AUDIT, "op13_spelling": SPELLING}
