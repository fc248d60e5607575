import numpy as np
from llm_data import docs
from pyspark.sql import functions as F

from stockgap.llm import mixing


def _rows(n):
    rng = np.random.default_rng(3)
    return [(i, " ".join(["w"] * int(rng.integers(1, 300))), ["a", "a", "a", "b", "c"][rng.integers(5)], ["en", "en", "de"][rng.integers(3)]) for i in range(n)]


def test_raked_shares_meet_all_three_margins(spark):
    cells = spark.createDataFrame([(s, la, t, 10.0 + 7 * i) for i, (s, la, t) in enumerate((s, la, t) for s in "abc" for la in ("en", "de") for t in "xy")],
                                  "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.9, "y": 0.1}}
    raked = mixing.rake(cells, targets, budget=0.1, tolerance=1e-7)
    got = raked.toPandas()
    assert abs(got.expected.sum() - 0.1 * got.tokens.sum()) < 1e-6
    for d, t in targets.items():
        for k, v in t.items():
            assert abs(got[got[d] == k].expected.sum() / got.expected.sum() - v) < 1e-6
    for r in mixing.residuals(raked).collect():
        assert abs(r.wanted - targets[r.margin][r.value]) < 1e-6 and abs(r.expected - r.wanted) < 1e-6 and abs(r.reachable - r.wanted) < 1e-6


def test_full_cells_leave_their_share_to_others(spark):
    """One topic has fewer tokens than asked: it is taken whole, and the other margins still meet their targets."""
    rows = [(s, la, "x", 1000.0) for s in "ab" for la in ("en", "de")] + [("a", "en", "y", 20.0), ("b", "de", "y", 30.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.7, "b": 0.3}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.5, "y": 0.5}}
    raked = mixing.rake(cells, targets, budget=0.3, tolerance=1e-6)
    got, whole = raked.toPandas(), 0.3 * 4050
    assert (got.expected <= got.tokens + 1e-9).all() and abs(got.expected.sum() - whole) < 0.1
    assert abs(got[got.topic == "y"].expected.sum() - 50) < 0.1
    for d in ("source", "lang"):
        for k, v in targets[d].items():
            assert abs(got[got[d] == k].expected.sum() - v * whole) < 0.1
    missed = {(r.margin, r.value): r for r in mixing.residuals(raked).collect()}
    y = missed["topic", "y"]
    assert abs(y.wanted - 0.5) < 1e-4 and abs(y.reachable - 50 / whole) < 1e-4 and abs(y.expected - y.reachable) < 1e-4


def test_targets_that_cannot_all_be_met_are_reported(spark):
    rows = [("a", "en", "x", 100.0), ("b", "de", "x", 100.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    raked = mixing.rake(cells, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "de": 0.9}}, budget=0.4, max_sweeps=8)
    assert (raked.toPandas().expected <= 100).all()
    assert max(abs(r.expected - r.reachable) for r in mixing.residuals(raked).collect()) > 0.1


def test_expected_tokens_are_the_budget(spark):
    shares = spark.createDataFrame([("a", "en", "x", 10.0, 0.7), ("b", "en", "x", 1000.0, 0.2), ("c", "en", "x", 500.0, 0.1), ("d", "en", "x", 0.0, 0.0)],
                                   "source string, lang string, topic string, tokens double, share double")
    got = mixing.calibrate(shares, 0.5).toPandas().set_index("source")
    assert abs((got.tokens * got.probability).sum() - 755) < 1e-6
    assert got.probability["a"] == 1 and got.probability["d"] == 1
    assert abs((got.probability["b"] * 1000) / (got.probability["c"] * 500) - 2) < 1e-9


def test_sample_follows_its_probabilities(spark):
    rows = _rows(3000)
    d = docs(spark, rows)
    drawn = mixing.mix(d, details=False)
    assert drawn.columns == d.columns
    whole = sum(len(t.split()) for _, t, *_ in rows)
    kept = sum(len(r.text.split()) for r in drawn.collect())
    assert abs(kept / whole - mixing.BUDGET) < 0.05
    again = {r.doc_id for r in mixing.mix(d.repartition(3)).collect()}
    assert again == {r.doc_id for r in drawn.collect()}


def test_targets_move_the_shares(spark):
    rows = _rows(3000)
    got = mixing.mix(docs(spark, rows), targets={"source": {"a": 0.3, "b": 0.4, "c": 0.3}}, budget=0.3).collect()
    tokens = {s: sum(len(r.text.split()) for r in got if r.source == s) for s in "abc"}
    whole = sum(tokens.values())
    assert abs(tokens["b"] / whole - 0.4) < 0.05 and abs(tokens["a"] / whole - 0.3) < 0.05


def test_nulls_empty_texts_repeats_and_empty_tables(spark):
    rows = [(1, None, None, None), (2, "", "a", "en"), (3, "one two", None, "en"), (3, "one two", None, "en"), (None, "x y z", "b", None), (4, "w " * 50_000, "b", "de")]
    d = docs(spark, rows)
    got = mixing.mix(d, budget=1.0)
    assert got.count() == 6
    half = [r.doc_id for r in mixing.mix(d, budget=0.5).collect()]
    assert half.count(3) in (0, 2)
    assert mixing.mix(docs(spark, [])).count() == 0


def test_own_topic_column(spark):
    got = mixing.mix(docs(spark, _rows(50)), topic=F.col("lang"), details=True)
    assert got.columns[-3:] == ["_topic", "n_tokens", "probability"] and got.count() > 0  # the table has a topic of its own
    assert {r["_topic"] for r in got.collect()} == {"en", "de"} and {r.topic for r in got.collect()} == {"c"}
