import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from stockgap.llm import queries, trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in ("depth", "part", "k", "h", "owner", "base", "digest", "tie")]])


def table(spark, rows):
    return spark.createDataFrame([(*r, *["c"] * 8) for r in rows], SCHEMA)


def brute(rows):
    """Rebuilds every conversation as a list and walks the trie of them."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in turns.items()}
    at = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        path = turns.get(c - c % 100, [])[:h] + turns[c][h:]
        for d in range(len(path) + 1):
            at[tuple(path[:d])].append((c, len(path)))
    out = []
    for path, own in at.items():
        below = [p for p in at if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        ends = ",".join(str(c) for c, n in sorted(own) if n == len(path))
        out.append((own[0][0], len(path), at[path[:-1]][0][0] if path else None, len(own), len(children),
                    sum(all(q[:len(p)] != p or q == p for q in at) for p in below),
                    sum((len(at[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made(seed=1, convs=40):
    rng, rows = random.Random(seed), []
    for c in [*range(convs), *range(100, 100 + convs), 1000, 777]:
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "héllo", "x" * 300])))
    return rows


def test_against_brute_force(spark):
    rows = made()
    assert got(trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = made(2, 12) + [(None, 1, "user", "none"), (5, None, None, None), (5, None, None, None), (6, 0, "user", "")]
    rows += [(300, None, "user", "first"), (301, 3, None, "x"), (301, 3, None, "x"), (302, 1, "us", "er x"), (303, 1, "user", " x")]
    assert got(trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    rows = [(0, t, "user", f"t{t % 3}") for t in range(300)] + [(c, t, "user", f"t{t % 3}") for c in (1, 2, 3, 50) for t in range(9)]
    df = table(spark, rows).repartition(8)
    assert got(trie.prefix_trie(df)) == brute(rows)
    products = trie.prefix_products(trie.turn_references(df), 7)
    long = sorted((r.pos, r.before) for r in products.collect() if r.conv_id == 0)
    assert long == [(i + 1, 2 * i) for i in range(300)]


def test_copies_share_their_path(spark):
    rows = [(c, t, "user", text) for c in range(0, 60000, 100) for t, text in enumerate(["same", "for all"])]
    nodes = trie.prefix_trie(table(spark, rows)).collect()
    assert len(nodes) == 3 and {r.n_convs for r in nodes} == {600}
    assert got(trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_collisions_are_found(spark):
    with pytest.raises(RuntimeError):
        trie.prefix_trie(table(spark, made()), prime=101, attempts=2)


def test_empty_table(spark):
    assert trie.prefix_trie(table(spark, [])).collect() == []


def test_registered_query(spark, tmp_path):
    rows = made(3, 10)
    table(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    df = queries.QUERIES["op13_trie"](spark, str(tmp_path))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got(df) == brute(rows)
