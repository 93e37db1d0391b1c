"""The registered queries of the text-corpus operators, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from demandflow.llm import (
    byte_cnn,
    collocations,
    dedup,
    line_dedup,
    mixing,
    near_dup,
    packing,
    pii,
    quality_rules,
    secret_scan,
    spelling,
    templates,
    toxicity,
)
from demandflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# The rank file holds the same vocabulary and gives the same ids as byte_bpe_50k.json, about four times as fast.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of those with equal text."""
    found = dedup.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLE_SQL["op4_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of the sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.Rules(), docs["doc_id"])


@query
def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: numbers by kind, digest of the base spans, all spans."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = [k.name for k in pii.KINDS if k.base]

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")

    of_base = F.filter("findings", lambda f: f["kind"].isin(base))
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(pii.joined_spans(of_base), 256).alias("base_sha256"),
        pii.joined_spans(F.col("findings")).alias("spans"),
        F.array_max(F.transform("findings", lambda f: f["score"])).alias("max_score"),
    )


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: numbers by kind, digest of the base spans, all spans."""
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    base = secret_scan.KINDS[:3]

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")

    of_base = F.filter("findings", lambda f: f["kind"].isin(*base))
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.joined_spans(of_base), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("findings")).alias("spans"),
        F.array_max(F.transform("findings", lambda f: f["novelty"])).alias("max_novelty"),
    )


@query
def op7_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return templates.main_text(table(spark, sf_dir, "pages"))


@query
def op8_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near-duplicates."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return byte_cnn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many documents share."""
    kept = line_dedup.without_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op11_line_runs"] = r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM texts),
keyed AS (
  SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, coalesce(k.doc_id < s.top, false) AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its near words and the form it is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
placed AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
  FROM worded CROSS JOIN (VALUES (1), (2), (3), (4)) AS sizes(size)
  WHERE len(words) >= size),
counted AS (
  SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, size, count(*) AS a FROM placed GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS words FROM counted WHERE a >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.size, c.k, p.a AS l, q.a AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(p.a AS HUGEINT) + q.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1) c
  JOIN frequent p ON p.lang = c.lang AND p.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN frequent q ON q.lang = c.lang AND q.phrase = array_to_string(c.words[c.k + 1:c.size], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a AS longer, array_to_string(words[i:i + part - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS i
        FROM frequent CROSS JOIN (VALUES (2), (3)) AS parts(part) WHERE size > part)),
most AS (SELECT lang, phrase, max(longer) AS longer FROM inner_parts GROUP BY ALL),
live AS (
  SELECT lowest.* FROM lowest LEFT JOIN most USING (lang, phrase)
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a),
numbered AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM live)
SELECT lang, rank, phrase, a, l, r, n, score FROM numbered JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of ``op1_source_mix``, the columns that do not depend on sampling keys."""
    return op1_source_mix(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


# A source is capped at twice its size if the share per weight of what the tighter ones leave is above its cap.
ORACLE_SQL["mix_targets"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
summed AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE row_number() OVER (ORDER BY source COLLATE C NULLS LAST) % 3 WHEN 1 THEN 3.0 WHEN 2 THEN 1.0 ELSE 2.0 END::DOUBLE AS w,
         1.5 * sum(source_size) OVER () AS budget
  FROM summed),
tightest AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source) AS k FROM weighed),
running AS (
  SELECT *, coalesce(sum(2.0 * source_size) OVER before, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
  FROM tightest WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (SELECT *, (budget - capped) / open AS share FROM running),
level AS (SELECT min(k) AS k FROM shared WHERE share * w <= 2.0 * source_size)
SELECT z.doc_id, z.size, s.source_size,
       round(CAST(CASE WHEN s.k < level.k THEN 2.0 * s.source_size ELSE at_level.share * s.w END AS DOUBLE), 3) AS target
FROM sized z JOIN shared s ON s.source IS NOT DISTINCT FROM z.source, level JOIN shared at_level USING (k)
"""


@query
def pii_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the base kinds of ``op2_pii_spans``, which do not depend on scores."""
    return op2_pii_spans(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


ORACLE_SQL["pii_base_counts"] = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS (
  SELECT doc_id, 'email' AS kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')) AS m FROM texts
  UNION ALL SELECT doc_id, 'ip', unnest(regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)')) FROM texts
  UNION ALL SELECT doc_id, 'card', unnest(regexp_extract_all(text, '[0-9]([\x20-]?[0-9])+')) FROM texts
  UNION ALL SELECT doc_id, 'phone', unnest(regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]')) FROM texts),
told AS (SELECT row_number() OVER () AS id, doc_id, kind, m, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM matches),
places AS (
  SELECT id, digits, unnest(range(1, length(digits) + 1)) AS i FROM told WHERE kind = 'card' AND length(digits) BETWEEN 16 AND 19),
doubled AS (SELECT id, i, CAST(substr(digits, length(digits) + 1 - i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END AS d FROM places),
cards AS (SELECT id FROM doubled GROUP BY id HAVING sum(d // 10 + d % 10) % 10 = 0),
valid AS (
  SELECT doc_id, kind FROM told WHERE kind = 'email'
     OR (kind = 'ip' AND regexp_full_match(m,
         '0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])){3}'))
     OR (kind = 'card' AND id IN (SELECT id FROM cards))
     OR (kind = 'phone' AND length(digits) BETWEEN 8 AND 15))
SELECT t.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
       count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone
FROM texts t LEFT JOIN valid USING (doc_id) GROUP BY t.doc_id
"""


@query
def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and base verdict of ``op5_quality_rules``, which do not depend on the languages."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return op5_quality_rules(spark, sf_dir).select("doc_id", *counts)


ORACLE_SQL["quality_base_counts"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + 2] AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows),
repeated AS (
  SELECT doc_id, count(DISTINCT i + step) AS n_repeat_words
  FROM often CROSS JOIN (VALUES (0), (1), (2)) AS steps(step) WHERE n > 1 GROUP BY doc_id),
worded AS (SELECT doc_id, unnest(lines) AS line FROM texts),
doubled AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM worded WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(array_to_string(words, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols
  FROM texts)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
       n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
FROM counted LEFT JOIN doubled USING (doc_id) LEFT JOIN repeated USING (doc_id)
"""


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
