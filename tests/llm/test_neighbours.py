import numpy as np
import pytest
from llm_data import components, vecs

from stockgap.llm import neighbours


def _brute(rows, t=0.93):
    ok = [i for i, r in enumerate(rows) if r[0] is not None and r[1] is not None and r[2] is not None and len(r[1]) == 16
          and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    x = np.array([rows[i][1] for i in ok], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([rows[i][2] for i in ok])
    near = (x @ x.T >= t) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = sorted({rows[i][0] for i in ok})
    place = {v: k for k, v in enumerate(ids)}
    comp = components(len(ids), [(place[rows[ok[a]][0]], place[rows[ok[b]][0]]) for a, b in zip(*np.nonzero(near))])
    out = [(r[0], 0, r[0]) for r in rows]
    for k, i in enumerate(ok):
        out[i] = (rows[i][0], int(near[k].sum()), ids[comp[place[rows[i][0]]]])
    return sorted(out, key=str)


def _case(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(30):
        base = rng.standard_normal(16)
        for _ in range([1, 2, 3, 60][c % 4]):
            rows.append((len(rows), (base + rng.standard_normal(16) * 0.06).tolist(), c % 3))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    rows += [(2000 + i, rows[5][1], 7) for i in range(2)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] + [1.0] * 15, 1), (3003, [float("inf")] + [1.0] * 15, 1),
             (3004, [None] + [1.0] * 15, 1), (3005, rows[0][1], None), (3006, rows[0][1], None), (3007, [1.0] * 5, 1), (3008, [], 1), (None, rows[5][1], rows[5][2])]
    return rows


def test_against_brute_force(spark):
    rows = _case()
    got = neighbours.near_duplicates(vecs(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute(rows)


def test_small_lists_buckets_and_tiles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 16)
    monkeypatch.setattr(neighbours, "CHUNK", 24)
    monkeypatch.setattr(neighbours, "TILE", 16)
    rows = _case(1)
    got = neighbours.near_duplicates(vecs(spark, rows), k=6).collect()
    want = _brute(rows)
    assert np.mean([a == b for a, b in zip(sorted((tuple(r) for r in got), key=str), want)]) > 0.99


def test_descent_finds_what_start_lists_missed(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    x = base + rng.standard_normal((12, 16)) * 0.05
    nodes = spark.createDataFrame([(0, i, 1, [float(c) for c in v]) for i, v in enumerate(x)], "label int, node long, weight long, v array<double>")
    chain = spark.createDataFrame([(i, i + 1, 0.99, True) for i in range(11)], "u long, v long, sim double, new boolean")
    got = {(r.u, r.v) for r in neighbours._introduce(chain, nodes, 16, 0.93, 2 * 0.93**2 - 1, 24).collect()}
    assert {(i, i + 2) for i in range(10)} <= got and {(i + 2, i) for i in range(10)} <= got


def test_repeated_ids_no_links_and_empty(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0), (3, [-1.0, 0.0], 0)]
    got = sorted(tuple(r) for r in neighbours.near_duplicates(vecs(spark, rows)).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]
    assert neighbours.near_duplicates(vecs(spark, [])).count() == 0
    assert [tuple(r) for r in neighbours.near_duplicates(vecs(spark, [(4, None, 0)])).collect()] == [(4, 0, 4)]


def test_tables_grow_with_the_bits():
    assert neighbours.tables_for(100, 0.93) == (0, 1)
    bits, tables = neighbours.tables_for(1 << 20, 0.93)
    assert bits == 12 and tables > 20


def _groups(n, cosines, dim=16, seed=4):
    """Tight groups of ``n`` distinct vectors; the centre of each at the given cosine to the first one's."""
    rng = np.random.default_rng(seed)
    axes = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    centres = [axes[0]] + [c * axes[0] + np.sqrt(1 - c * c) * axes[1 + i] for i, c in enumerate(cosines)]
    return [(100 * g + i, (c + rng.standard_normal(dim) * 0.002).tolist(), 1) for g, c in enumerate(centres) for i in range(n)]


@pytest.mark.parametrize("n,cosines", [(25, [0.95]), (60, [0.97]), (40, [0.95, 0.94]), (30, [0.5, 0.95])])
def test_tight_groups_linked_across(spark, n, cosines):
    rows = _groups(n, cosines) + [(5000, _groups(1, [0.94], seed=4)[1][1], 1), (5001, [1.0] * 16, 1), (5002, _groups(1, [])[0][1], 2)]
    got = sorted((tuple(r) for r in neighbours.near_duplicates(vecs(spark, rows)).collect()), key=str)
    assert got == _brute(rows)


def test_links_across_in_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE", 8)
    monkeypatch.setattr(neighbours, "PART", 16)
    rows = _groups(30, [0.95, 0.94])
    got = sorted((tuple(r) for r in neighbours.near_duplicates(vecs(spark, rows)).collect()), key=str)
    assert got == _brute(rows)


def _pairs_beside_a_crowd(seed=6):
    rng = np.random.default_rng(seed)
    crowd = rng.standard_normal(16)
    x = [crowd + rng.standard_normal(16) * 0.05 for _ in range(120)]
    for _ in range(80):
        one = rng.standard_normal(16)
        x += [one, one + rng.standard_normal(16) * 0.05]
    return [(i, v.tolist(), 1) for i, v in enumerate(x)]


def test_chunks_of_a_split_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    rows = _pairs_beside_a_crowd()
    nodes = spark.createDataFrame([(r[2], r[0], 1, r[1]) for r in rows], "label int, node long, weight long, v array<double>")
    got = {(r.u, r.v) for r in neighbours._start(nodes, 16, 100, 0.93, 0.7298, 24, 1, 5).where("sim >= 0.93").collect()}
    assert all({(i, i + 1), (i + 1, i)} <= got for i in range(120, 280, 2))


def test_whole_labels_are_compared_when_the_search_loses_links(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MORE", 1)
    monkeypatch.setattr(neighbours, "TILE", 64)
    monkeypatch.setattr(neighbours, "descend", lambda nodes, *a: nodes.sparkSession.createDataFrame(
        [(i, j, 1.0, True) for i in range(120) for j in range(120) if i != j], "u long, v long, sim double, new boolean"))
    rows = _pairs_beside_a_crowd()
    got = sorted((tuple(r) for r in neighbours.near_duplicates(vecs(spark, rows)).collect()), key=str)
    assert got == _brute(rows)
