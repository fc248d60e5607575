import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import docs

from stockgap.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(rows, max_words):
    count = Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            for k in range(1, max_words + 1):
                count.update((lang, tuple(w[i: i + k])) for i in range(len(w) - k + 1))
    return count


def brute(rows, min_count=10, max_words=3, top=2000):
    count = grams(rows, max_words)
    total, cand = Counter(), {}
    for (lang, p), n in count.items():
        if len(p) == 1:
            total[lang] += n
        elif n >= min_count:
            cand[lang, p] = n
    out = {}
    for (lang, p), a in cand.items():
        score, k = min((1000000 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p)))
        inside = [n for (g, q), n in cand.items() if g == lang and len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))]
        if not any(100 * n >= 50 * a for n in inside):
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for lang, own in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


def table(spark, rows):
    return docs(spark, [(i, t, "s", lang) for i, t, lang in rows])


def made(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "cat", "sat", "on", "mat", "é", "É", " x", "\x1c"] + [f"w{i}" for i in range(30)]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    ends = [" ", "  ", "\t", " ", ", ", ". ", "\n", "\r\n", "; "]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, weight, k=rng.randrange(0, 30))
        rows.append((i, "".join(w + rng.choice(ends) for w in words), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.fixture(scope="module")
def rows():
    fixed = ["new york city hall"] * 12 + ["New  York\tcity. hall"] * 3 + ["a a a a a a a a a a a a", "", None, "x" * 5000, "...", "last"]
    return made(5) + [(1000 + i, t, "xx") for i, t in enumerate(fixed)] + [(None, "no id at all", "xx")] * 11


@pytest.mark.parametrize("max_words,sample,bits", [(3, 16, 1 << 16), (4, 3, 1 << 12), (2, 1, 64)])
def test_against_brute_force(spark, rows, max_words, sample, bits):
    got = phrases.collocations(table(spark, rows), max_words=max_words, sample=sample, bits=bits, chunk=5000)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, max_words=max_words)


def test_failures_of_the_sample_are_expanded(spark, rows, monkeypatch):
    """A sample that holds almost nothing: every level needs a pass of its own, and no phrase is counted twice."""
    passes, plain = [], phrases.counted
    monkeypatch.setattr(phrases, "counted", lambda *a: passes.append(a[1] is None) or plain(*a))
    rows = [(i, t, lang) for i, t, lang in rows]
    got = phrases.frequent_phrases(table(spark, rows), sample=100_000, chunk=5000).where("k > 0").collect()
    want = {(lang, " ".join(p)): n for (lang, p), n in grams(rows, 3).items() if n >= 10}
    assert {(r.lang, r.phrase): r.n for r in got} == want and len(got) == len(want)
    assert len(passes) == 4
    passes.clear()
    phrases.frequent_phrases(table(spark, rows), sample=1, chunk=5000)
    assert len(passes) == 2  # all of it proposed: the first pass closes


def test_top_and_ties(spark):
    rows = [(i, "b c. a b. c a. z z", "en") for i in range(10)]
    got = phrases.collocations(table(spark, rows), top=2).orderBy("rank").collect()
    assert [(r.rank, r.phrase, r.a, r.n, r.score) for r in got] == [(r[1], r[2], r[3], r[6], r[7]) for r in brute(rows, top=2)]


def test_filter_in_spark_is_the_tasks_filter(spark):
    df = spark.createDataFrame([("en", "a"), ("de", "a b"), ("en", "x y z")], "lang string, phrase string")
    bitmap = phrases.filter_of(df, 1 << 12)
    a, b = phrases.word_hashes([b"a", b"b"], "de")
    x, y, z = (np.array([h]) for h in phrases.word_hashes([b"x", b"y", b"z"], "en"))
    assert phrases.holds(bitmap, phrases.word_hashes([b"a"], "en")).all()
    assert phrases.holds(bitmap, phrases.chained(np.array([a]), np.array([b]))).all()
    assert phrases.holds(bitmap, phrases.chained(phrases.chained(x, y), z)).all()
    assert not phrases.holds(bitmap, phrases.word_hashes([b"a", b"q"], "de")).any()


def test_words_of_sliced_batches():
    words, follows = phrases.split_words(pa.array(["skip me", "A b.c", "", " ", "d\te"]).slice(1))
    assert words.to_pylist() == [b"a", b"b", b"c", b"d", b"e"] and follows.tolist() == [True, False, False, True, False]
    words, follows = phrases.split_words(pa.array([], pa.string()))
    assert len(words) == 0 and len(follows) == 0


def test_empty_and_infrequent(spark):
    assert phrases.collocations(table(spark, [])).collect() == []
    assert phrases.collocations(table(spark, [(1, "too few words", "en")])).collect() == []


def test_registered_query(spark, rows, tmp_path):
    table(spark, rows).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.QUERIES["op11_phrases"](spark, str(tmp_path))
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in df.collect()) == brute(rows)
