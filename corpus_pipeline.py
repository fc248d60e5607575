"""The corpus pipeline: documents -> scored, deduplicated, mixed, tokenized.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockgap.llm import bpe, line_dedup, mixing, quality, simhash
from stockgap.llm.common import staged, table, text_of
from stockgap.llm.queries import VOCABULARY

#: no SQL: the classifier and the tokenizer cannot be expressed; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (score < 0.5)."""
    learn = quality.labelled(table(spark, sf_dir, "labels"))
    ids = F.broadcast(learn.select(F.col("id").alias("__id")).distinct())  # at most about quality.MAX_TRAIN
    known = docs.join(ids, F.col("__id") == docs["doc_id"], "left_semi")
    model = quality.fit(staged(quality.document_stats(known)).join(learn, "id"))
    return docs.where(quality.score_udf(model, of_text=True)(text_of(docs["text"])) >= 0.5)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take cross-site boilerplate lines out of the texts."""
    return line_dedup.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of SimHash near-duplicates."""
    return simhash.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents to the raked source, language and topic weights."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, text) of each document; the text
    is the one its ids decode to."""
    tokens = bpe.tokenize(docs, VOCABULARY, keep=("lang", "source"))
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                         F.col("decoded").alias("text"))


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from documents; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
