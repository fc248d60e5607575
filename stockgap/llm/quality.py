"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A text becomes ``STATS`` numbers about its bytes, words and lines.  Random
Fourier features of the standardized numbers approximate a Gaussian kernel;
each partition adds up its share of the normal equations, per fold, and the
driver solves systems whose size depends on the number of features alone.
Out-of-fold scores are calibrated by isotonic regression (pool adjacent
violators) over score bins.

Bounds: about ``MAX_TRAIN`` labelled rows at most enter the fit (the ones with
the smallest id hashes); everything else covers all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_batches, text_of

STATS = ["log_bytes", "log_words", "upper", "lower", "digit", "space", "newline", "high", "pipe",
         "bang", "mark", "stop", "other", "mean_word", "sd_word", "distinct", "repeated",
         "top_word", "concentration", "line_words", "distinct_lines", "bigrams",
         "n_upper", "n_pipe", "n_bang", "n_mark", "n_repeated", "n_lost"]
N_FEATURES = 160
MAX_TRAIN = 1_000_000
FOLDS = 4
BINS = 2000
_CLASSES = ["upper", "lower", "digit", "space", "newline", "high", "pipe", "bang", "mark", "stop", "other"]


def _byte_classes() -> np.ndarray:
    names = {}
    for chars, name in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"), (b"abcdefghijklmnopqrstuvwxyz", "lower"),
                        (b"0123456789", "digit"), (b" \t\r\x0b\x0c", "space"), (b"\n", "newline"), (b"|", "pipe"),
                        (b"!", "bang"), (b"*#$%&@~^_=+<>{}[]\\/", "mark"), (b".,;:?'\"()-", "stop")):
        names.update(dict.fromkeys(chars, name))
    return np.array([_CLASSES.index(names.get(i, "high" if i > 127 else "other")) for i in range(256)], np.uint8)


_CLASS_OF = _byte_classes()


def text_stats(text: str) -> list[float]:
    """The ``STATS`` of one whole text; all zero for an empty one."""
    data = text.encode("utf-8", "replace")
    if not data:
        return [0.0] * len(STATS)
    count_of = np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=len(_CLASSES))
    share = count_of / len(data)
    words = data.split()
    n = len(words)
    if n:
        size = np.fromiter(map(len, words), np.float64, n)
        count = np.fromiter(Counter(words).values(), np.float64)
        again = sum(map(eq, words, islice(words, 1, None)))
        pairs = len(set(zip(words, islice(words, 1, None)))) / max(1, n - 1)
        word = [size.mean() / 10, size.std() / 10, len(count) / n, again / n, count.max() / n, float((count / n) @ (count / n))]
        lost = n - len(count)
    else:
        pairs, word, again, lost = 0.0, [0.0] * 6, 0, 0
    lines = data.split(b"\n")
    # shares mislead in short texts: the marks of junk once more as counts
    counts = [*(count_of[_CLASSES.index(c)] for c in ("upper", "pipe", "bang", "mark")), again, lost]
    return [np.log1p(len(data)) / 10, np.log1p(n) / 10, *share.tolist(), *word,
            np.log1p(n / len(lines)) / 5, len(set(lines)) / len(lines), pairs, *(np.log1p(counts) / 5).tolist()]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def stats_of(texts: pd.Series) -> pd.Series:
    return texts.map(text_stats)


@dataclass(frozen=True)
class Model:
    """mean/scale standardize; w/phase make the features; beta scores them;
    knots/levels are the calibration (score -> probability, non-decreasing)."""
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.w + self.phase) * np.sqrt(2 / self.w.shape[1])
        return np.hstack([z, np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(stats) @ self.beta, self.knots, self.levels), 0.0, 1.0)


def _constant(p: float) -> Model:
    d = len(STATS)
    return Model(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(2), np.zeros(1), np.array([p]))


def isotonic(score: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (score, good, total) bins; the knots are
    the pooled mean scores, the levels their shares of good rows."""
    pools: list[list[float]] = []  # weighted score, good, total
    for i in np.argsort(score):
        pools.append([score[i] * total[i], good[i], total[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def fit(stats: DataFrame, n_features: int = N_FEATURES, ridge: float = 1e-4, gamma: float = 0.2,
        seed: int = 7) -> Model:
    """Fit on ``stats`` (id, stats array<double>, label 0/1), e.g. of the
    documents in :func:`labelled`.

    Null ids, labels or statistics are left out; repeated rows count as often
    as they occur.  No rows: a constant 0.5; one class only: its share.
    """
    rows = stats.where("id is not null and label is not null and stats is not null").select(
        "id", "stats", F.col("label").cast("double").alias("label"))
    n, good = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or good in (0, n):
        return _constant(good / n if n else 0.5)
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(FOLDS)).cast("int")
    train = rows.select(fold.alias("fold"), "stats", "label").repartition(16).persist()
    try:
        d = len(STATS)
        got = train.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(
            F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).toPandas().sort_values("i")
        mean, scale = got.m.to_numpy(), np.maximum(got.s.to_numpy(), 1e-6)
        rng = np.random.default_rng(seed)
        part = Model(mean, scale, rng.standard_normal((d, n_features)) * gamma,
                     rng.uniform(0, 2 * np.pi, n_features), np.zeros(n_features + 1), np.zeros(1), np.zeros(1))
        k = n_features + 1
        up = np.triu_indices(k)

        def normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            gram, rhs = np.zeros((FOLDS, k, k)), np.zeros((FOLDS, k))
            for b in batches:
                z = part.features(np.stack(b.stats.to_numpy()))
                for f in range(FOLDS):
                    own = (b.fold == f).to_numpy()
                    gram[f] += z[own].T @ z[own]
                    rhs[f] += z[own].T @ b.label.to_numpy()[own]
            yield pd.DataFrame({"fold": range(FOLDS), "v": [np.concatenate([gram[f][up], rhs[f]]) for f in range(FOLDS)]})

        sums = train.mapInPandas(normal, "fold int, v array<double>")
        got = sums.select("fold", F.posexplode("v").alias("i", "x")).groupBy("fold", "i").agg(F.sum("x").alias("x")).toPandas()
        flat = np.zeros((FOLDS, len(up[0]) + k))
        flat[got.fold, got.i] = got.x

        def solve(v: np.ndarray) -> np.ndarray:
            g = np.zeros((k, k))
            g[up] = v[: len(up[0])]
            g = g + np.triu(g, 1).T
            return np.linalg.solve(g + ridge * max(g[-1, -1], 1.0) * np.eye(k), v[len(up[0]):])

        beta = solve(flat.sum(0))
        out = np.stack([solve(flat.sum(0) - flat[f]) for f in range(FOLDS)])

        @F.pandas_udf("double")
        def held_score(fold: pd.Series, s: pd.Series) -> pd.Series:
            raw = (part.features(np.stack(s.to_numpy())) * out[fold.to_numpy()]).sum(1)
            return pd.Series(np.clip(raw, -1, 2))

        bins = train.select(F.round(held_score("fold", "stats") * BINS).alias("bin"), "label").groupBy("bin").agg(
            F.sum("label").alias("good"), F.count(F.lit(1)).alias("total")).toPandas()
    finally:
        train.unpersist()
    knots, levels = isotonic(bins.bin.to_numpy() / BINS, bins.good.to_numpy(float), bins.total.to_numpy(float))
    return Model(mean, scale, part.w, part.phase, beta, knots, levels)


def score_udf(model: Model, of_text: bool = False):
    """Column -> score, from the statistics array or (``of_text``) the text."""
    @F.pandas_udf("double")
    def score(s: pd.Series) -> pd.Series:
        if not len(s):
            return pd.Series([], dtype="float64")
        x = np.array([text_stats(t) for t in s]) if of_text else np.stack(s.to_numpy())
        return pd.Series(model.score(x))
    return score


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether the row is kept out of every fit: crc32 of the id as text mod 3 is 1."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(3)) == 1, F.lit(False))


def labelled(labels: DataFrame, max_train: int = MAX_TRAIN, seed: int = 7) -> DataFrame:
    """(id, label) rows that a fit learns from: not held out, and about
    ``max_train`` at most, by the hash of the id.  Few enough to broadcast
    (16 bytes a row)."""
    rows = labels.where(~held_out()).where("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    unit = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / (1 << 30)
    return rows.where(unit < max_train / max(1, rows.count()))


def document_stats(docs: DataFrame) -> DataFrame:
    """(id, stats) of every document, from its whole text (null: empty)."""
    return text_batches(docs).select(F.col("doc_id").alias("id"), stats_of(text_of(docs["text"])).alias("stats"))
