"""Line dedup by distinct-site spread.

A line is boilerplate when it stands on ``min_sites`` distinct sites or more.
HyperLogLog sketches of the sites, one per line hash, merge by aggregation;
lines whose estimate lies near the threshold get an exact distinct count.
The first occurrence of a boilerplate line (smallest document, then
position) stays, so no text leaves the corpus; all others go.

Lines are compared without surrounding spaces, by two 64-bit hashes with
different seeds.  Every line that is not blank takes part, whatever its length
or script; blank lines are layout and stay.

Edge cases: a null text stays null and has no lines; a null source is a site of
its own; rows that repeat a document (same id and text) are treated alike; of
equal first places the smallest text hash counts as first; texts and lines of
any length are compared whole; an empty table stays empty.  Columns of any
names are carried along; the operator's own are named apart from them.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own_names, staged, text_batches, text_of

MIN_SITES = 5
LG_K = 12
_LAST = (1 << 63) - 1
_KEY = ["h1", "h2"]


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, site, pos, h1, h2) of each line that is not blank."""
    text = text_of(docs["text"])
    return docs.select(
        docs["doc_id"].alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(docs["source"], F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line")).select("doc_id", "text_hash", "site", "pos", F.trim("line").alias("line")).where(
        "line <> ''").select("doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def near_band(min_sites: int, lg_k: int) -> tuple[int, int]:
    """Estimates that four standard errors (at least one site) may carry across the threshold."""
    e = 4 * 1.04 / math.sqrt(1 << lg_k)
    return min(min_sites - 1, math.floor(min_sites * (1 - e))), max(min_sites + 1, math.ceil(min_sites * (1 + e)))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first): the lines on ``min_sites`` sites or more and where each
    stands first.  A null source is one site of its own; a null doc_id comes
    after all others."""
    lines = line_hashes(docs)
    low, high = near_band(min_sites, lg_k)
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.col("pos"), F.col("text_hash"))
    spread = staged(lines.groupBy(*_KEY).agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min(place).alias("first"))
        .select(*_KEY, "first", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low))
    near = spread.where(F.col("sites") <= high)
    exact = lines.join(near.select(*_KEY), _KEY, "left_semi").select(*_KEY, "site").distinct().groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select(*_KEY)
    return spread.where(F.col("sites") > high).select(*_KEY, "first").unionByName(
        near.join(exact, _KEY).select(*_KEY, "first"))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, drop: pd.Series) -> pd.Series:
    def one(t, d):
        if t is None or d is None:
            return None
        gone = set(d)
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return pd.Series([one(t, d) for t, d in zip(text, drop)], dtype=object)


def clean(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, removed: str | None = None) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text`` (and ``n_chars``,
    if there is one, brought up to date); ``removed`` names an added column
    with the number of lines taken out.

    All rows stay, in the same columns; a document all of whose lines go has
    the empty text.
    """
    if removed in docs.columns:
        raise ValueError(f"docs have a column {removed} already")
    bad = staged(boilerplate(text_batches(docs), min_sites, lg_k))
    hits = line_hashes(docs).join(bad, _KEY).where(
        (F.coalesce("doc_id", F.lit(_LAST)) != F.col("first.doc")) | (F.col("pos") != F.col("first.pos"))
        | (F.col("text_hash") != F.col("first.text_hash")))
    of_id, of_text, drop, n = own_names(docs, "id", "hash", "drop", "n")
    drops = hits.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias(drop)).select(
        F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_text), drop)
    out = docs.join(drops, docs["doc_id"].eqNullSafe(F.col(of_id)) & (F.xxhash64(text_of(docs["text"])) == F.col(of_text)), "left")
    touched = F.col(drop).isNotNull()
    new = F.when(touched, _without(F.when(touched, docs["text"]), F.col(drop))).otherwise(docs["text"])
    out = out.select(*[docs[c] for c in docs.columns if c != "text"], new.alias("text"),
                     F.when(touched, F.size(drop)).otherwise(0).cast("long").alias(n))
    now = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return out.select(*[now.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns],
                      *([F.col(n).alias(removed)] if removed else []))
