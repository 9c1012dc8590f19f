"""The corpus operators as registered queries over the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm import (bpe_codec, decontamination, hard_negatives, jaccard_join, line_dedup, quality_classifier, quality_rules,
                           repeated_bytes, samples, token_alignment, token_counts, toxicity, training_order, web_archives)
from opsledger.session import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_line_dedup(spark, folder):
    found = line_dedup.remove_repeated_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


SQL["op1_line_dedup"] = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, i, array_to_string(l[i:i+2], chr(10)) AS t FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS n FROM w
      WHERE regexp_matches(t, '[^\x20\x09-\x0D]')),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM r, (VALUES (0), (1), (2)) v(k) WHERE n > 1),
x AS (SELECT d.doc_id, s.i, d.l[s.i] AS line, c.i IS NOT NULL AS gone
      FROM d, unnest(range(1, len(d.l) + 1)) s(i) LEFT JOIN c ON c.doc_id = d.doc_id AND c.i = s.i),
y AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM x)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       CAST(count(*) FILTER (opens) AS BIGINT) AS n_spans,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM y GROUP BY doc_id
"""


@query
def op2_quality_rules(spark, folder):
    return quality_rules.apply_rules(table(spark, folder, "documents"))


SQL["op2_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
p AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
q AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM q, (VALUES (0), (1), (2)) v(k) WHERE q.n > 1 GROUP BY doc_id),
s AS (SELECT d.doc_id, t, w, l, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 6 * len(l)
            OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
            OR length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) < length(translate(t, 'abcdefghijklmnopqrstuvwxyz', ''))
            OR 5 * (length(t) - length(replace(t, '!!', '!'))) > n_words
            OR 10 * len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < 6 * n_words
            OR 10 * len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) > 5 * len(l)) AS kept
FROM b
"""


@query
def op3_jaccard_join(spark, folder):
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


SQL["op3_jaccard_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+3], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(min(r.b) AS BIGINT) AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""


@query
def op4_training_order(spark, folder):
    """The index of the shards that it writes: one row per sequence."""
    return training_order.write_shards(table(spark, folder, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))[0]


@query
def op5_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op6_bpe_codec(spark, folder):
    return bpe_codec.round_trip_digests(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op7_repeated_bytes(spark, folder):
    return repeated_bytes.remove_repeated_bytes(table(spark, folder, "documents")).drop("spans")


@query
def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit_on(docs, table(spark, folder, "labels"), samples.fold("doc_id", 3) != 1)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", F.coalesce(samples.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op9_decontamination(spark, folder):
    return decontamination.benchmark_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    model = quality_classifier.fit_on(docs, table(spark, folder, "labels"), samples.fold("doc_id", 5) != 0)
    return quality_classifier.score_quality(docs, model).select(
        "doc_id", F.coalesce(samples.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op11_hard_negatives(spark, folder):
    return hard_negatives.mine(table(spark, folder, "embeddings"))


SQL["op11_hard_negatives"] = """
WITH e AS (SELECT vec_id AS i, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i AS a, b.i AS b, a.l = b.l AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
      FROM e a JOIN e b ON a.i % 100 = 0 AND a.i <> b.i),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b AS p, p.score AS ps, s.b AS n, s.score AS ns,
             row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE r <= 5
"""


@query
def op12_web_archives(spark, folder):
    """Pages as legacy archives, converted to WARC files, and these read back."""
    work = run_folder(spark, "web_archives")
    web_archives.write_arc(table(spark, folder, "pages"), f"{work}/arc")
    web_archives.convert_arc(spark, f"{work}/arc", f"{work}/warc")
    return web_archives.read_warc(spark, f"{work}/warc").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op12_web_archives"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, strlen(h) >= 1000 AND row_number() OVER (PARTITION BY h ORDER BY page_id DESC) > 1 AS again,
             max(page_id) OVER (PARTITION BY h) AS last
      FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last END AS refers_to
FROM r
"""


@query
def op13_token_alignment(spark, folder):
    return token_alignment.align_tokens(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"),
                                        vocabulary("piece_bpe_32k.model"))
