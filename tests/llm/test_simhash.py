import random

import numpy as np
import xxhash
from llm_data import components, docs

from stockgap.llm import simhash


def _plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_against_the_definition():
    for t in ("", " \n", "a", "A b", "A B c", "The quick\tbrown  fox\x0bjumps é É ſ", "x " * 50, "a b c d e f g " * 9, "nb sp one two three"):
        assert simhash.fingerprint(t) == _plain(t)


def test_every_pair_within_the_distance_meets_at_an_anchor(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randrange(0, 6)):
            y ^= 1 << b
        rows += [(2 * i, x), (2 * i + 1, y)]
    signed = [(np.uint64(f).view(np.int64).item(), r) for r, f in {f: r for r, f in reversed(rows)}.items() for r, f in [(f, r)]]
    known = {f for f, _ in signed}
    nodes = spark.createDataFrame([(f, r) for f, r in signed], "fp long, rep long")
    assert len(known) == len(signed)
    got = {(r.a, r.b) for r in simhash.links(nodes).collect()}
    value = {r: f % 2**64 for f, r in signed}
    assert all(bin(value[a] ^ value[b]).count("1") <= 3 for a, b in got)
    ids = sorted(value)
    place = {r: i for i, r in enumerate(ids)}
    want = components(len(ids), [(place[a], place[b]) for a in ids for b in ids if a < b and bin(value[a] ^ value[b]).count("1") <= 3])
    assert components(len(ids), [(place[a], place[b]) for a, b in got]) == want


def test_hot_anchor_is_split_and_whole(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = random.Random(6)
    base = rng.getrandbits(64)
    prints = {base ^ (1 << a) ^ (1 << b) for a in range(32, 64, 2) for b in range(33, 64, 3)}
    nodes = spark.createDataFrame([(np.uint64(f).view(np.int64).item(), i) for i, f in enumerate(sorted(prints))], "fp long, rep long")
    value = sorted(prints)
    want = components(len(value), [(a, b) for a in range(len(value)) for b in range(a) if bin(value[a] ^ value[b]).count("1") <= 3])
    got = [(r.a, r.b) for r in simhash.links(nodes).collect()]
    assert components(len(value), got) == want


def test_groups_nulls_copies_and_ties(spark):
    long = "word " * 20_000
    rows = [(5, "one two three four"), (3, "ONE two\tthree  four"), (9, None), (8, ""), (8, ""), (None, "one two three four"), (4, long), (2, long), (7, "un")]
    d = docs(spark, rows)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(d).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (8, 8), (None, None), (4, 2), (2, 2), (7, 7)], key=str)
    kept = simhash.one_per_group(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 8, 8, None, 2, 7], key=str)


def test_one_id_with_two_texts_is_one_document(spark):
    d = docs(spark, [(1, "a b c"), (1, "d e f"), (2, "d e f"), (3, "g h i")])
    assert sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(d).collect()) == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.one_per_group(docs(spark, [])).count() == 0
