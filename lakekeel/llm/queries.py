"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.llm.best_fit import pack_pieces
from lakekeel.llm.bwt_dedup import bwt_dedup
from lakekeel.llm.html_text import html_extraction
from lakekeel.llm.iblt import iblt_fingerprints
from lakekeel.llm.language import language_id
from lakekeel.llm.ngram_jaccard import ngram_jaccard
from lakekeel.llm.phrase_automata import phrase_collocations
from lakekeel.llm.piece_codec import piece_decode, piece_encode
from lakekeel.llm.stream_dedup import stream_dedup
from lakekeel.llm.term_counts import source_divergence
from lakekeel.llm.tokens import token_pieces
from lakekeel.llm.toxicity import toxicity
from lakekeel.llm.training_order import training_order
from lakekeel.llm.url_trie import url_filter

#: Tokens of a training sequence, the id that ends a document, and the key of the training order.
SEQUENCE_TOKENS, END_ID, ORDER_KEY = 1024, 2, 20_240_229

#: Rules of the URL filter: host, beginning of the path, verdict.
URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(spark, _table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(_table(spark, sf_dir, "documents"), path, SEQUENCE_TOKENS, END_ID)
    return pack_pieces(spark, pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction(_table(spark, sf_dir, "pages"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bwt_dedup(spark, _table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = piece_decode(piece_encode(_table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark, _table(spark, sf_dir, "documents"))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return training_order(spark, _table(spark, sf_dir, "documents"), path, ORDER_KEY, END_ID)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_dedup(spark, _table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt_fingerprints(spark, _table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_collocations(spark, _table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter(spark, _table(spark, sf_dir, "pages"), rules)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark, _table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


#: Spark derives the same rows from a stream with state; this says what they are.
EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES_SQL = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
counted AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM words, generate_series(1, 4) AS s(size)) GROUP BY ALL
), total AS (SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= 30),
cut AS (
  SELECT lang, phrase, size, f, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS front, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM frequent WHERE size > 1)
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM cut c JOIN frequent x ON x.lang = c.lang AND x.phrase = front JOIN frequent y ON y.lang = c.lang AND y.phrase = rest
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, w, f, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM (SELECT lang, string_split(phrase, ' ') AS w, f FROM frequent WHERE size > 2), generate_series(2, 3) AS s(size) WHERE size < len(w))
  GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT r.lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked r JOIN total t ON t.lang = r.lang WHERE rank <= 2000
"""

_HOST = _LOWERED.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1)")
_FITS = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{{}}'".replace("{}", f"{host}{path} {verdict}")
    for host, path, verdict in sorted(URL_RULES, key=lambda rule: -len(rule[0] + rule[1]))
)

URL_SQL = rf"""
WITH parts AS (SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
judged AS (SELECT *, CASE {_FITS} END AS found FROM parts)
SELECT page_id, host, path, split_part(found, ' ', 1) AS rule, coalesce(split_part(found, ' ', 2), 'allow') AS verdict FROM judged
"""

DIVERGENCE_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), term AS (SELECT doc, lang, source, unnest(terms) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS total FROM term GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
grp AS (SELECT DISTINCT lang, source FROM doc),
size AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS c FROM term SEMI JOIN kept USING (lang, term) GROUP BY ALL),
own AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM grp LEFT JOIN used USING (lang, source) GROUP BY ALL),
share AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 1) // (own.n + v)::HUGEINT AS p,
         1 + 1000000000::HUGEINT * (total + 1) // (size.n + v)::HUGEINT AS q
  FROM own JOIN size USING (lang) JOIN kept USING (lang) LEFT JOIN used USING (lang, source, term)
), apart AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM grp x JOIN grp y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
), terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM share WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op8_exact_dedup": EXACT_DEDUP_SQL, "op11_phrase_collocations": PHRASES_SQL, "op12_url_filter": URL_SQL, "op13_source_divergence": DIVERGENCE_SQL,
    }
