"""The registered queries: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, html, licenses, line_dedup, mixing, neighbours, phrases, quality, secrets, simhash, token_counts, trie
from .common import scratch_folder, staged, table

#: the public vocabulary file of the BPE query; a parameter of the operator
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn("coverage", F.round("coverage", 6))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), details=True)
    return drawn.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
                        "topic", "n_tokens", F.round("probability", 9).alias("probability"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                        (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.clean(docs, removed="n_removed").select("doc_id", "n_removed", "n_chars", "text")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = staged(quality.document_stats(table(spark, sf_dir, "documents")))
    model = quality.fit(stats.join(quality.labelled(table(spark, sf_dir, "labels")), "id"))
    return stats.select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"),
                        quality.score_udf(model)("stats").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.tokenize(table(spark, sf_dir, "documents"), VOCABULARY))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with a cache of its own, cold at the start: all distinct texts
    are encoded.  ``stockgap.tokenCache`` in the session names a lasting one."""
    cache = spark.conf.get("stockgap.tokenCache", None) or scratch_folder(spark)
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.Tokenizer(public_tokenizers.path("word_bpe_49k.json")), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_html": op4_html,
    "op5_neighbours": op5_neighbours,
    "op6_simhash": op6_simhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_nearest": op10_nearest,
    "op11_phrases": op11_phrases,
    "op12_token_counts": op12_token_counts,
    "op13_trie": op13_trie,
}

ORACLE: dict[str, str] = {
    "op2_mixing": mixing.oracle(),
    "op7_line_dedup": """
        WITH lines AS (
            SELECT doc_id, coalesce(source, '') AS site, pos, trim(line) AS line, raw
            FROM (SELECT doc_id, source, unnest(parts) AS line, unnest(parts) AS raw,
                         unnest(range(0, len(parts))) AS pos
                  FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
        bad AS (
            SELECT line, min(struct_pack(doc := doc_id, pos := pos)) AS first FROM lines
            WHERE line <> ''
            GROUP BY line HAVING count(DISTINCT site) >= 5)
        SELECT doc_id, count(*) FILTER (gone) AS n_removed,
               length(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS n_chars,
               coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
        FROM (SELECT l.*, b.line IS NOT NULL AND (b.first.doc <> l.doc_id OR b.first.pos <> l.pos) AS gone
              FROM lines l LEFT JOIN bad b ON l.line = b.line)
        GROUP BY doc_id""",
    "op11_phrases": """
        WITH pieces AS (
            SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
            FROM (SELECT coalesce(lang, 'und') AS lang,
                         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
        words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
        places AS (SELECT lang, unnest(w) AS w1, unnest(w[2:]) AS w2, unnest(w[3:]) AS w3 FROM words),
        counts AS (
            SELECT lang, 1 AS k, w1 AS phrase, count(*) AS n FROM places GROUP BY ALL
            UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM places WHERE w2 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM places WHERE w3 IS NOT NULL GROUP BY ALL),
        often AS MATERIALIZED (SELECT * FROM counts WHERE n >= 10),
        cut AS MATERIALIZED (
            SELECT lang, k, phrase, n AS a, c, array_to_string(string_split(phrase, ' ')[1 : c], ' ') AS head,
                   array_to_string(string_split(phrase, ' ')[c + 1 :], ' ') AS tail
            FROM often, (VALUES (1), (2)) AS cs(c) WHERE c < k),
        headed AS MATERIALIZED (SELECT cut.*, o.n AS l FROM cut JOIN often o ON o.lang = cut.lang AND o.phrase = head),
        scored AS MATERIALIZED (
            SELECT h.*, o.n AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * o.n) AS score
            FROM headed h JOIN often o ON o.lang = h.lang AND o.phrase = tail),
        worst AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        longer AS (
            SELECT lang, part, max(n) AS n
            FROM (SELECT lang, n, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                                          array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS part
                  FROM often WHERE k = 3)
            GROUP BY ALL),
        kept AS (
            SELECT worst.* FROM worst LEFT JOIN longer ON longer.lang = worst.lang AND longer.part = worst.phrase
            WHERE worst.k = 3 OR longer.n IS NULL OR 100 * longer.n < 50 * a)
        SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
               phrase, a, l, r, total.n::BIGINT AS n, score::BIGINT AS score
        FROM kept JOIN (SELECT lang, sum(n) AS n FROM counts WHERE k = 1 GROUP BY lang) total ON total.lang = kept.lang
        QUALIFY rank <= 2000""",
}
