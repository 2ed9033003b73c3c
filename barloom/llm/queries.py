"""The queries of the text operators over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    byte_bpe, collocations, decontaminate, filter_audit, licenses, line_dedup, quality_model, quality_rules, sharding, simhash, substring_dedup,
    toxicity, warc_bundles,
)
from barloom.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged(scored: DataFrame, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


@query(
    """
    WITH blank AS (SELECT ' ' || chr(9) || chr(11) || chr(12) || chr(13) AS b),
    page AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
    seen AS (
        SELECT source, line, count(*) AS n
        FROM (SELECT DISTINCT doc_id, source, trim(line, b) AS line
              FROM (SELECT doc_id, source, unnest(lines) AS line FROM page), blank)
        WHERE line <> '' GROUP BY source, line),
    total AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
    bad AS (SELECT seen.source, line FROM seen JOIN total ON seen.source IS NOT DISTINCT FROM total.source
            WHERE n >= 5 AND n > 0.1 * pages),
    placed AS (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM page),
    marked AS (SELECT p.doc_id, p.line, p.i, bad.line IS NOT NULL AS gone
               FROM placed p CROSS JOIN blank
               LEFT JOIN bad ON bad.source IS NOT DISTINCT FROM p.source AND bad.line = trim(p.line, b))
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
           count(*) FILTER (gone) AS removed
    FROM marked GROUP BY doc_id
    """
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, "source", ratio=0.1, least_pages=5, removed="removed").drop("source")


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return judged(model.scored(docs), 0.5)


@query()
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.with_verdict(quality_rules.quality_measures(docs))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio",
             "n_chunks", "n_bad_chunks")
    return judged.select("doc_id", *[F.col("quality_measures")[n].alias(n) for n in names])


@query()
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query()
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), width=3, budget=3)


@query(licenses.duckdb_sql())
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_scan(table(spark, sf_dir, "documents"))


@query(
    """
    WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    hashed AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM page),
    largest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM hashed)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
    FROM largest
    """
)
def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.round_trip(table(spark, sf_dir, "pages")).drop("url", "payload")


@query()
def op9_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    length = {"length": F.floor(F.log2(F.greatest("n_chars", F.lit(1))))}
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), metadata=length)
    return judged(model.scored(docs, metadata=length), 0.3)


@query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = byte_bpe.ByteBPE(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.token_digests(bpe, table(spark, sf_dir, "documents"))


@query()
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.sharded(table(spark, sf_dir, "documents"), shards=16)
    return dealt.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query(
    """
    WITH word AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    first AS (SELECT text, min(doc_id) AS least FROM word GROUP BY text),
    mark AS (SELECT max(quality) AS good, max(toxic) AS toxic, doc_id FROM labels GROUP BY doc_id),
    doc AS (SELECT part, coalesce(good = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
                   len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
                   100 * length(regexp_replace(word.text, '[^A-Z]', '', 'g')) > 5 * length(word.text) AS c,
                   regexp_matches(word.text, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e
            FROM word JOIN first ON first.text = word.text LEFT JOIN mark USING (doc_id)),
    seen AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
                    || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END)
                    || (CASE WHEN e THEN 'E' ELSE '' END) AS fails, count(*) AS n FROM doc GROUP BY ALL),
    letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letter p, letter q, letter r, letter s, letter t
               WHERE q.x <> p.x AND r.x NOT IN (p.x, q.x) AND s.x NOT IN (p.x, q.x, r.x) AND t.x NOT IN (p.x, q.x, r.x, s.x)),
    steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS f, filter_order[:step - 1] AS earlier
              FROM orders, range(1, 6) AS k(step)),
    fate AS (SELECT part, filter_order, step, f, good, toxic, n, fails = f AS alone, contains(fails, f) AS hit,
                    translate(fails, earlier, '') <> fails AS gone FROM seen, steps),
    total AS (SELECT part, filter_order, step, f,
                     coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
                     coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
                     coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
                     coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
                     coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
                     coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
              FROM fate GROUP BY ALL)
    SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM total
    """
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    """
    WITH own AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
    piece AS (SELECT doc, lang, unnest(regexp_split_to_array(body, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM own),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece),
    spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
    gram AS (SELECT lang, 1 AS words, w[i] AS phrase FROM spot
             UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM spot WHERE i + 1 <= len(w)
             UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM spot WHERE i + 2 <= len(w)),
    f AS (SELECT lang, phrase, words, count(*) AS a FROM gram GROUP BY ALL),
    total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
    candidate AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10),
    place AS (SELECT lang, phrase, a, 1 AS k, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM candidate
              UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidate WHERE words = 3),
    cut AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r,
                   ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
            FROM place c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
    low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_pair AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
                   FROM candidate WHERE words = 3),
    held AS (SELECT lang, phrase, max(a) AS most FROM inner_pair GROUP BY ALL),
    left_over AS (SELECT low.* FROM low LEFT JOIN held USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
    FROM left_over JOIN total USING (lang) QUALIFY rank <= 2000
    """
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
