"""SimHash near-dedup with anchor-point covering.

Fingerprints: a bit is 1 if over half of the XXH64 values (seed 42) of the
text's word shingles have it set.

Links: of ``MAX_BITS`` = 3 differing bits at most one falls into one of the
two 32-bit halves, so two linked fingerprints agree in a half up to
``THRESHOLD`` = 1 bit.  The anchors of a half are the code words of the
[31,26] Hamming code (covering radius 1) on its low 31 bits.  Every
fingerprint is at home at the one anchor within the radius and is replicated
to all anchors within radius plus threshold (16 or 1 of them); two linked
fingerprints therefore meet at the home anchor of either.  Per anchor, homes
are compared with all replicas by full Hamming distance.

Equal fingerprints are one node before anything is replicated.  An anchor
with many homes is split into chunks of at most ``CHUNK`` homes, each of
which sees all replicas as a stream.  What leaves a chunk is a spanning
forest of its links, so the output grows with its members, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged, text_batches, text_of
from .graph import connected_components

SHINGLE = 3
MAX_BITS = 3
RADIUS, THRESHOLD = 1, MAX_BITS // 2
CHUNK = 4096
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text (no words: zero)."""
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: n - shingle + 1].tolist()
    cuts = map(slice, starts, (ends[shingle - 1:] - 1).tolist())
    h = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(42)), np.uint64, n - shingle + 1)
    by_byte = h.astype(">u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    ones = np.einsum("bv,vk->bk", np.bincount(by_byte.ravel(), minlength=2048).reshape(8, 256), _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprint_udf(shingle: int = SHINGLE):
    """Text column -> fingerprint as a signed long (two's complement)."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return fp


def _anchor_masks() -> list[list[int]]:
    """By syndrome: the error patterns within radius + threshold of a code
    word, the home pattern (weight 0 or 1) first."""
    out = []
    for s in range(32):
        pairs = [(1 << i - 1) | (1 << (i ^ s) - 1) for i in range(1, 32) if s and i < i ^ s]
        out.append([1 << s - 1 if s else 0, *pairs])
    return out


def anchors(fp: str = "fp") -> Column:
    """array<struct<block, anchor, home>> of a fingerprint column."""
    masks = F.array(*[F.array(*map(F.lit, m)) for m in _anchor_masks()])

    def half(block: int) -> Column:
        x = F.shiftrightunsigned(F.col(fp), 32 * block).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
        syndrome = sum(((F.bit_count(x.bitwiseAND(F.lit(sum(1 << i - 1 for i in range(1, 32) if i >> k & 1)))) % 2)
                        * (1 << k) for k in range(5)), F.lit(0)).cast("int")
        return F.transform(F.element_at(masks, syndrome + 1), lambda m, i: F.struct(
            F.lit(block).alias("block"), x.bitwiseXOR(m).alias("anchor"), (i == 0).alias("home")))
    return F.concat(half(0), half(1))


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning forest of the links of each (block, anchor, chunk).

    Rows come sorted by group with the homes first; a group's homes (at most
    about CHUNK) stay in memory, its replicas are read as a stream.
    """
    group, homes, reps, parent = None, None, None, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for b in batches:
        key = b[["block", "anchor", "chunk"]].to_numpy()
        fp, rep, home = b.fp.to_numpy().view(np.uint64), b.rep.to_numpy(), b.home.to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        edges = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)]):
            if hi <= lo:
                continue
            if group != (now := tuple(key[lo])):
                group, homes, reps, parent = now, fp[:0], rep[:0], {}
            own = home[lo:hi]
            homes, reps = np.concatenate([homes, fp[lo:hi][own]]), np.concatenate([reps, rep[lo:hi][own]])
            for at in range(lo, hi, 1024):  # homes are compared among themselves as they come
                near = np.bitwise_count(homes[:, None] ^ fp[None, at:min(hi, at + 1024)]) <= MAX_BITS
                for h, r in zip(*np.nonzero(near)):
                    x, y = find(int(reps[h])), find(int(rep[at + r]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        edges.append((int(reps[h]), int(rep[at + r])))
        yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest, per anchor, of the links between ``nodes``
    (fp, rep), whose fingerprints must be distinct."""
    spark = nodes.sparkSession
    per = Window.partitionBy("block", "anchor")
    met = nodes.select("fp", "rep", F.explode(anchors()).alias("x")).select("fp", "rep", "x.block", "x.anchor", "x.home").select(
        "*", F.sum(F.col("home").cast("int")).over(per).alias("n_home"), F.count(F.lit(1)).over(per).alias("n"))
    chunks = F.ceil(F.col("n_home") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    # a home row is a replica for the other chunks
    spread = met.where("n_home > 0 and n > 1").select(
        "fp", "rep", "block", "anchor", F.col("home").alias("at_home"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")).select(
        "fp", "rep", "block", "anchor", "chunk", (F.col("at_home") & (F.col("own") == F.col("chunk"))).alias("home"))
    dealt = spread.repartition(shuffle_partitions(spark), "block", "anchor", "chunk").sortWithinPartitions(
        "block", "anchor", "chunk", F.desc("home"))
    return dealt.mapInPandas(_forest, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    component_id is the smallest doc_id reachable over links.  Null and empty
    texts have fingerprint zero and link like any other.  A row without
    doc_id has a fingerprint but no component and links nothing.  Rows that
    repeat a doc_id are one document: what any of them links to is linked.
    """
    prints = staged(text_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"),
                                fingerprint_udf(shingle)(text_of(docs["text"])).alias("fp")))
    nodes = staged(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    again = prints.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("doc_id").join(
        prints, "doc_id").join(nodes, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comps = connected_components(links(nodes).unionByName(again))
    classes = staged(nodes.join(comps, nodes["rep"] == comps["node"], "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")))
    found = prints.join(classes, "fp", "left")
    return found.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the documents of each group but its smallest doc_id."""
    gone = near_duplicates(docs, shingle).where("component_id <> doc_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
