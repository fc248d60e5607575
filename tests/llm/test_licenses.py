import random

import numpy as np
from llm_data import docs

from stockgap.llm import licenses

INDEX = licenses.Index(licenses.TEMPLATES)


def _plain(doc, template):
    """Matched words of the best unbanded local alignment (any path of the best score)."""
    score = np.zeros((len(template) + 1, len(doc) + 1), int)
    for i, w in enumerate(template, 1):
        for j, x in enumerate(doc, 1):
            score[i, j] = max(0, score[i - 1, j - 1] + (2 if w == x else -1), score[i - 1, j] - 1, score[i, j - 1] - 1)
    return int(score.max())


def test_every_template_is_found_whole_with_its_span():
    rng = random.Random(1)
    for name, text in licenses.TEMPLATES.items():
        before = " ".join(rng.choice(["lorem", "the", "of", "licensed", "ÿ"]) for _ in range(rng.randrange(0, 80))) + " \n "
        got = licenses.matches(before + text + " tail words", INDEX)
        assert [(g[0], g[1]) for g in got if g[0] == name] == [(name, 1.0)]
        g = next(g for g in got if g[0] == name)
        assert (before + text)[g[3]: g[4]] == text.strip(" .\"")[: g[4] - g[3]] and g[3] == len(before)


def test_altered_texts_down_to_the_coverage():
    rng = random.Random(2)
    words = licenses.TEMPLATES["MIT"].split()
    for share, want in ((0.05, True), (0.12, True), (0.5, False)):
        gone = set(rng.sample(range(len(words)), int(len(words) * share)))
        text = " ".join("changed" if i in gone else w for i, w in enumerate(words))
        got = [g for g in licenses.matches("intro " + text, INDEX) if g[0] == "MIT"]
        assert bool(got) is want
        if want:
            assert abs(got[0][1] - (1 - share)) < 0.04


def test_banded_alignment_against_the_full_one():
    rng = random.Random(3)
    for _ in range(60):
        template = [rng.randrange(6) for _ in range(rng.randrange(4, 25))]
        doc = [w for w in template if rng.random() > 0.15]
        for _ in range(rng.randrange(3)):
            doc.insert(rng.randrange(len(doc) + 1), 9)
        pad = rng.randrange(5)
        doc = [7] * pad + doc + [7] * 3
        n, first, last = licenses.align(np.array(doc), np.array(template), pad, 30)
        best = _plain(doc, template)
        assert n * 2 >= best and first <= last < len(doc)
        assert _plain(doc[first: last + 1], template) == best


def test_repetitions_and_larger_matches():
    got = licenses.matches("All rights reserved. All rights reserved. x All rights reserved", INDEX)
    assert [g[0] for g in got] == ["All rights reserved"] * 3
    assert [g[0] for g in licenses.matches(licenses.TEMPLATES["Apache-2.0"], INDEX)] == ["Apache-2.0"]


def test_table_with_nulls_repeats_and_long_texts(spark):
    notice = licenses.TEMPLATES["MIT notice"]
    rows = [(None, notice), (1, None), (2, ""), (3, "word the of " * 60_000 + notice), (4, notice), (4, notice), (5, "released under no license at all")]
    got = sorted(((r.doc_id, r.license, r.coverage, r.text) for r in licenses.scan(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(i, "MIT notice", 1.0, notice[:-1]) for i in (3, 4, 4, None)], key=str)
    assert licenses.scan(docs(spark, [])).count() == 0


def test_winnowing_shares_a_print_with_every_three_words():
    for t, ids in enumerate(INDEX.words):
        for i in range(len(ids) - 2):
            doc = np.concatenate([[-1, -1], ids[i: i + 3], [-1]])
            assert any(h[0] == t for h in INDEX.hits(doc)), INDEX.names[t]


def test_every_template_is_found_as_itself():
    """Whole texts of like licenses (two and three clauses, the GNU notices) are told apart, also between other words."""
    from stockgap.llm.licenses import TEMPLATES, Index, matches
    index = Index(TEMPLATES)
    for name, text in TEMPLATES.items():
        found = matches(f"Some words before it. {text} And a few after.", index)
        assert name in [m[0] for m in found] and all(m[1] >= 0.8 for m in found), name
        assert max(found, key=lambda m: (m[2], m[1]))[0] == name
