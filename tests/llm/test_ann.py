import numpy as np
from llm_data import vecs
from pyspark.sql import functions as F

from stockgap.llm import ann, vectors


def _truth(rows, k=20, dim=16, each=5):
    best = {}
    ok = [r for r in rows if r[0] is not None and r[1] is not None and len(r[1]) == dim and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    ids = np.array([r[0] for r in ok])
    x = np.array([r[1] for r in ok], np.float32).astype(float)
    for i, q in zip(ids, x):
        if i % each == 0:
            s = x @ q
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i]
            best[int(i)] = list(dict.fromkeys((int(ids[j]), float(s[j])) for j in order))[:k]
    return best


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def _recall(found, truth):
    assert set(found) == set(truth)
    hit = sum(len({i for i, _ in found[q]} & {i for i, _ in t}) for q, t in truth.items())
    return hit / sum(map(len, truth.values()))


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(16) * rng.uniform(0.2, 3)).tolist()) for i in range(3000)]
    truth = _truth(rows)
    found = _found(ann.nearest(vecs(spark, rows), F.col("vec_id") % 5 == 0))
    assert _recall(found, truth) >= 0.9
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, got in found.items():
        assert len(got) == 20 and q not in {i for i, _ in got}
        assert all(abs(s - x[q] @ x[i]) < 1e-9 for i, s in got)
        assert got == sorted(got, key=lambda y: (-y[1], y[0]))


def test_small_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(800)]
    one = _found(ann.nearest(vecs(spark, rows), F.col("vec_id") % 5 == 0))
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 16)
    two = _found(ann.nearest(vecs(spark, rows), F.col("vec_id") % 5 == 0))
    assert {q: [i for i, _ in v] for q, v in one.items()} == {q: [i for i, _ in v] for q, v in two.items()}


def test_copies_ties_few_candidates_and_unfit_rows(spark):
    one = [1.0] + [0.0] * 15
    rows = [(i, one) for i in range(60)] + [(100, [0.5] * 16), (None, one), (200, None), (205, [0.0] * 16), (210, [float("nan")] * 16), (215, [None] * 16), (220, [1.0]), (225, [float("inf")] * 16), (230, [])]
    truth = _truth(rows)
    found = _found(ann.nearest(vecs(spark, rows), F.col("vec_id") % 5 == 0))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in truth.items()}
    few = [(0, one), (5, [0.5] * 16), (5, [0.5] * 16), (7, one)]
    assert {q: [i for i, _ in v] for q, v in _found(ann.nearest(vecs(spark, few), F.col("vec_id") % 5 == 0)).items()} == {0: [7, 5], 5: [0, 7]}


def test_no_rows_and_no_queries(spark):
    assert ann.nearest(vecs(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert ann.nearest(vecs(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), F.col("vec_id") % 5 == 0).count() == 0
    assert ann.nearest(vecs(spark, [(5, [1.0, 2.0])]), F.col("vec_id") % 5 == 0).count() == 0


def test_rotations_keep_lengths_and_buckets_are_nearest_axes():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((50, 12))
    np.testing.assert_allclose(np.linalg.norm(vectors.hadamard(np.hstack([x, np.zeros((50, 4))])), axis=1), np.linalg.norm(x, axis=1))
    h = ann.Hashes(12, 3, float(np.linalg.norm(x, axis=1).max()))
    for t, z in enumerate(h.scores(x, False)):
        np.testing.assert_allclose((z[:, : h.size] ** 2).sum(1), 1)
        assert (h.buckets(x)[:, t] == z.argmax(1)).all()


def test_an_id_with_several_vectors_is_found_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60) for _ in range(2)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 21)) and len({r.vec_id for r in got}) == 20
    q = [np.array(v) for i, v in rows if i == 0]
    best = {i: max(float((np.array(v) * x).sum()) for j, v in rows if j == i for x in q) for i in range(1, 60)}
    assert all(abs(r.score - best[r.vec_id]) < 1e-12 for r in got)
