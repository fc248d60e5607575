import random
import zlib

import numpy as np
from llm_data import docs

from stockgap.llm import quality


def _corpus(n):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    out = []
    for i in range(n):
        good = i % 3 != 0
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 300))] if good else [rng.choice(vocabulary[:3])] * rng.randrange(20, 200)
        out.append((i, " ".join(words), "s", "en", int(good)))
    return out


def test_held_out_accuracy_and_ranges(spark):
    rows = _corpus(600)
    stats = quality.document_stats(docs(spark, [r[:4] for r in rows])).cache()
    labels = spark.createDataFrame([(r[0], r[4], 0) for r in rows], "doc_id long, quality int, toxic int")
    model = quality.fit(stats.join(quality.labelled(labels), "id"))
    got = stats.select("id", quality.held_out(stats["id"]).alias("held"), quality.score_udf(model)("stats").alias("s")).collect()
    held = [r for r in got if r.held]
    assert {r.id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(0 <= r.s <= 1 for r in got)
    assert np.mean([(r.s >= 0.5) == bool(rows[r.id][4]) for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = _corpus(120)
    flip = [(r[0], 1 - r[4] if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r[4], 0) for r in rows]
    stats = quality.document_stats(docs(spark, [r[:4] for r in rows]))
    models = [quality.fit(stats.join(quality.labelled(spark.createDataFrame(x, "doc_id long, quality int, toxic int")), "id"))
              for x in (flip, [(r[0], r[4], 0) for r in rows])]
    np.testing.assert_allclose(models[0].beta, models[1].beta, rtol=1e-6, atol=1e-9)


def test_nulls_empty_long_and_no_labels(spark):
    d = docs(spark, [(None, None), (1, ""), (1, ""), (2, None), (3, "x " * 300_000), (4, "\n\n"), (5, "é" * 5)])
    stats = quality.document_stats(d)
    none = spark.createDataFrame([(None, 1, 0), (9, None, 0), (3, 7, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(stats.join(quality.labelled(none), "id"))
    assert [r.s for r in stats.select(quality.score_udf(model)("stats").alias("s")).collect()] == [0.5] * 7
    one = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r.s for r in stats.select(quality.score_udf(quality.fit(stats.join(quality.labelled(one), "id")))("stats").alias("s")).collect()} == {1.0}
    empty = quality.document_stats(docs(spark, []))
    assert empty.select(quality.score_udf(model)("stats")).count() == 0


def test_training_rows_are_bounded(spark):
    labels = spark.range(5000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    n = quality.labelled(labels).count()
    assert n == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(5000))
    assert 300 < quality.labelled(labels, max_train=400).count() < 500


def test_isotonic_pools_violators():
    knots, levels = quality.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 3.0, 1.0, 4.0]), np.array([4.0, 4.0, 4.0, 4.0]))
    assert levels.tolist() == [0.0, 0.5, 1.0] and (np.diff(knots) > 0).all()


def test_random_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(0)
    d = len(quality.STATS)
    m = quality.Model(np.zeros(d), np.ones(d), rng.standard_normal((d, 4000)) * 0.35, rng.uniform(0, 2 * np.pi, 4000), np.zeros(4001), np.zeros(1), np.zeros(1))
    x = rng.standard_normal((6, d))
    z = m.features(x)[:, :-1]
    want = np.exp(-0.35**2 * ((x[:, None] - x[None]) ** 2).sum(2) / 2)
    np.testing.assert_allclose(z @ z.T, want, atol=0.1)
