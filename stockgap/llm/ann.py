"""Approximate nearest neighbours by inner product: cross-polytope hashing.

Vectors are brought to unit length (by one extra coordinate where norms
differ, so that the inner product decides) and turned by three rounds of
random signs and fast Hadamard transforms per table; a vector's bucket is
the nearest signed axis.  A query probes the buckets of its ``probes``
nearest signed axes in each table; every bucket scores its candidates
exactly, on the original vectors in double precision.

``probes`` is calibrated, not fixed: a sample of ``SAMPLE`` queries is
compared with all rows in blocks, and the count is the least that would have
reached ``RECALL`` of the sample's true neighbours.  Queries for which fewer
than k neighbours turn up probe all buckets.

Equal vectors keep only their k + 1 smallest ids, as no others can be among
anyone's k nearest with ties to the smaller id.  A bucket's candidates and
queries are dealt into blocks of bounded size, and each block pair is one
group, so no group grows with the data.  A block reports one row per query:
its k best that reach the query's k-th best among ``FLOOR_ROWS`` sampled
rows, a lower bound on what a true neighbour scores.  So a query has at most
``tables * probes`` such rows a block, whatever the table's size.  A query's
lists are merged to its k best before any of their pairs becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .vectors import hadamard, matrix, sound, width

TABLES = 8
RECALL = 0.96
SAMPLE = 64
FLOOR_ROWS = 2048
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048


class Hashes:
    """Signed-axis hashes of ``tables`` pseudo-rotations.

    ``top`` is the largest norm, or None if all norms are the same."""

    def __init__(self, dim: int, tables: int, top: float | None, seed: int = 11):
        self.top, self.size = top, 1 << int(np.ceil(np.log2(max(2, dim + (top is not None)))))
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, self.size))

    def scores(self, x: np.ndarray, query: bool) -> Iterator[np.ndarray]:
        """Per table: rows x signed axes, larger is nearer."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        y = np.zeros((len(x), self.size))
        if self.top is None or query:
            y[:, : x.shape[1]] = x / norm
        else:
            y[:, : x.shape[1]] = x / self.top
            y[:, x.shape[1]] = np.sqrt(np.clip(1 - (norm[:, 0] / self.top) ** 2, 0, 1))
        for signs in self.signs:
            z = y
            for s in signs:
                z = hadamard(z * s)
            yield np.hstack([z, -z])

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each row."""
        return np.stack([z.argmax(1) for z in self.scores(x, False)], axis=1)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, columns) of the k best scores, ties to the smaller id; -inf never."""
    for i, row in enumerate(score):
        c = np.flatnonzero(row > -np.inf)
        if len(c) > k:
            c = c[row[c] >= np.partition(row[c], -k)[-k]]
        yield i, c[np.lexsort((ids[c], -row[c]))[:k]]


def _probe_ranks(rows: DataFrame, sample: pd.DataFrame, k: int, hashes: Hashes, dim: int) -> np.ndarray:
    """For each true neighbour of each sampled query, the least rank of its
    bucket in the query's probe order over all tables."""
    q, qid = matrix(sample.v, dim), sample.vec_id.to_numpy()

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = [np.argsort(np.argsort(-z, axis=1, kind="stable"), axis=1) for z in hashes.scores(q, True)]
        for b in batches:
            x, ids = matrix(b.v, dim), b.vec_id.to_numpy()
            score = q @ x.T
            score[qid[:, None] == ids[None, :]] = -np.inf
            code = hashes.buckets(x)
            rank = np.min([o[:, code[:, t]] for t, o in enumerate(order)], axis=0)
            out = [(int(qid[i]), int(ids[j]), float(score[i, j]), int(rank[i, j])) for i, c in _best(score, ids, k) for j in c]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score", "rank"])

    found = rows.select("vec_id", "v").mapInPandas(block, "query_id long, vec_id long, score double, rank int")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("rank").toPandas()["rank"].to_numpy()


def _blocked(rows: DataFrame, sizes: DataFrame, own: str, other: str, keys: list[str], id_: str) -> DataFrame:
    """``rows`` with (b_row, b_query): its own block by id, and each of the
    other side's blocks."""
    return rows.join(sizes, keys).withColumns({
        own: F.pmod(F.xxhash64(id_), F.col("n_" + own)).cast("int"),
        other: F.explode(F.sequence(F.lit(0), F.col("n_" + other) - 1))}).drop("n_b_row", "n_b_query")


def _search(rows: DataFrame, queries: DataFrame, k: int, hashes: Hashes, probes: int, dim: int, floor: pd.DataFrame) -> DataFrame:
    """(query_id, found): of each probed bucket its k best for the query, as
    (-score, vec_id) pairs."""
    fx, fid = matrix(floor.v, dim), floor.vec_id.to_numpy()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            code = hashes.buckets(matrix(b.v, dim))
            for t in range(code.shape[1]):
                yield pd.DataFrame({"t": t, "bucket": code[:, t], "vec_id": b.vec_id, "v": b.v})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 512):
                own = b[at: at + 512]
                x = matrix(own.v, dim)
                seen = x @ fx.T
                seen[own.query_id.to_numpy()[:, None] == fid[None, :]] = -np.inf
                low = np.partition(seen, -k, axis=1)[:, -k] if len(fx) >= k else np.full(len(x), -np.inf)
                for t, z in enumerate(hashes.scores(x, True)):
                    near = np.argsort(-z, axis=1, kind="stable")[:, :probes]
                    i = np.repeat(np.arange(len(own)), near.shape[1])
                    yield pd.DataFrame({"t": t, "bucket": near.ravel(), "query_id": own.query_id.to_numpy()[i],
                                        "qv": own.v.to_numpy()[i], "low": low[i] - 1e-9 * np.abs(low[i])})

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, ids = matrix(left.v, dim), left.vec_id.to_numpy()
        out = []
        for at in range(0, len(right) if len(left) else 0, 256):
            own = right[at: at + 256]
            qid = own.query_id.to_numpy()
            q = matrix(own.qv, dim)
            s = q @ x.T
            s[(s < own.low.to_numpy()[:, None]) | (qid[:, None] == ids[None, :])] = -np.inf
            for i in np.flatnonzero(s.max(axis=1) > -np.inf):
                c = np.flatnonzero(s[i] > -np.inf)
                exact = (x[c] * q[i]).sum(axis=1)  # the same for equal vectors in any block
                best = np.lexsort((ids[c], -exact))[:k]
                out.append((int(qid[i]), [(-float(exact[b]), int(ids[c[b]])) for b in best]))
        return pd.DataFrame(out, columns=["query_id", "found"])

    keys = ["t", "bucket"]
    cells = rows.mapInPandas(place, "t int, bucket int, vec_id long, v array<float>" if "float" in rows.schema["v"].dataType.simpleString() else "t int, bucket int, vec_id long, v array<double>")
    asked = queries.mapInPandas(probe, f"t int, bucket int, query_id long, qv {queries.schema['v'].dataType.simpleString()}, low double")
    sizes = cells.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("n_b_row")).join(
        asked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("n_b_query")), keys)
    sizes = staged(sizes)  # a row per bucket, whatever the data
    group = [*keys, "b_row", "b_query"]
    a = _blocked(cells, sizes, "b_row", "b_query", keys, "vec_id").groupBy(*group)
    b = _blocked(asked, sizes, "b_query", "b_row", keys, "query_id").groupBy(*group)
    return a.cogroup(b).applyInPandas(score, "query_id long, found array<struct<away:double,vec_id:long>>")


def nearest(vectors: DataFrame, is_query, k: int = 20, tables: int = TABLES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows of ``vectors`` (vec_id,
    embedding) for which ``is_query`` (a condition on vec_id) holds.

    Null, zero and non-finite vectors, vectors of another length than most,
    and rows without id take no part.  Rows that repeat an id and its vector
    are one candidate; rows that repeat an id are never each other's
    neighbour.  No queries or no candidates: an empty result.
    """
    v = vectors["embedding"]
    kind = v.cast("array<float>") if "float" in vectors.schema["embedding"].dataType.simpleString() else v.cast("array<double>")
    rows = staged(vectors.where(vectors["vec_id"].isNotNull()).select(vectors["vec_id"].cast("long").alias("vec_id"), kind.alias("v")).where(sound(F.col("v"))).distinct())
    dim = width(rows)
    rows = rows.where(F.size("v") == dim)
    same = Window.partitionBy(F.xxhash64("v"), F.xxhash64(F.lit(1), "v")).orderBy("vec_id")
    distinct = staged(rows.select("*", F.row_number().over(same).alias("copy")).where(F.col("copy") <= k + 1).drop("copy"))
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    low, top, n, ids = distinct.select("vec_id", norm.alias("x")).agg(F.min("x"), F.max("x"), F.count(F.lit(1)), F.count_distinct("vec_id")).first()
    hashes = Hashes(dim, tables, None if not n or top <= low * (1 + 1e-4) else top)
    lot = F.xxhash64(F.lit("sample"), "vec_id")
    sample = queries.select(F.col("query_id").alias("vec_id"), "v").orderBy(lot, "vec_id").limit(SAMPLE).toPandas()
    floor = distinct.orderBy(F.xxhash64(F.lit("floor"), "vec_id"), "vec_id").limit(FLOOR_ROWS).toPandas().drop_duplicates("vec_id")
    ranks = _probe_ranks(distinct, sample, k, hashes, dim) if len(sample) else np.zeros(0)
    probes = min(2 * hashes.size, int(np.quantile(ranks, recall, method="higher")) + 1) if len(ranks) else 1

    def ranked(asked: DataFrame, p: int) -> DataFrame:
        # the lists of a query's blocks become one; a pair turns up in each table at most once
        best = F.array_sort(F.array_distinct(F.flatten(F.collect_list("found"))))
        merged = _search(distinct, asked, k, hashes, p, dim, floor).groupBy("query_id").agg(best.alias("best"))
        if ids < n:  # an id with several vectors stands for its nearest one
            merged = merged.withColumn("best", F.filter("best", lambda x, i: F.array_position(
                F.transform("best", lambda y: y["vec_id"]), x["vec_id"]) == i + 1))
        return staged(merged.select("query_id", F.posexplode(F.slice("best", 1, k)).alias("pos", "x")).select(
            "query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", (-F.col("x.away")).alias("score")))

    first = ranked(queries, probes)
    short = queries.join(first.where(F.col("rank") == min(k, max(1, (n or 0) - 1))).select("query_id"), "query_id", "left_anti")
    if probes == 2 * hashes.size or short.isEmpty():
        return first
    short = staged(short)
    rest = ranked(short, 2 * hashes.size)
    return first.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(rest)
