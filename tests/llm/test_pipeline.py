import hashlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stockgap.llm import line_dedup, mixing, quality, simhash
from stockgap.llm.queries import VOCABULARY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    """The input of each stage, and the result, as pandas tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF))
        seen.append(docs.toPandas())
    return seen


def test_stages_and_columns(run):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "mixing", "bpe"]
    assert all(list(t.columns) == ["doc_id", "text", "lang", "source", "n_chars"] for t in run[:-1])


def test_quality_keeps_the_good(run):
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    kept = set(run[1].doc_id)
    known = [(i in kept, labels[i] == 1) for i in run[0].doc_id if i in labels.index]
    assert np.mean([a == b for a, b in known]) > 0.9
    assert np.mean([a for a, b in known if b]) > 0.95


def test_lines_near_duplicates_and_sample(run):
    rows = list(zip(run[1].doc_id, run[1].text, run[1].source))
    sites = {}
    for _, t, s in rows:
        for line in t.split("\n"):
            sites.setdefault(line.strip(" "), set()).add(s)
    seen, want = set(), {}
    for i, t, _ in sorted(rows):
        keep = []
        for line in t.split("\n"):
            key = line.strip(" ")
            if not key or len(sites[key]) < line_dedup.MIN_SITES or key not in seen:
                keep.append(line)
            seen.add(key)
        want[i] = "\n".join(keep)
    assert dict(zip(run[2].doc_id, run[2].text)) == want

    prints = {i: simhash.fingerprint(t) for i, t in want.items()}
    ids = sorted(prints)
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            low = min(group[j] for j in ids if bin(prints[i] ^ prints[j]).count("1") <= 3)
            if low < group[i]:
                group[i], changed = low, True
    assert sorted(run[3].doc_id) == [i for i in ids if group[i] == i]
    assert set(run[4].doc_id) < set(run[3].doc_id)


def test_tokens(run):
    library = Tokenizer.from_file(VOCABULARY)
    texts = dict(zip(run[4].doc_id, run[4].text))
    assert sorted(run[5].doc_id) == sorted(texts)
    for i, ids, text in zip(run[5].doc_id, run[5].ids, run[5].text):
        assert list(ids) == library.encode(texts[i], add_special_tokens=False).ids and text == texts[i]


def test_run_is_the_stages(spark, run):
    digest = lambda t: sorted((i, hashlib.sha256(x.encode()).hexdigest()) for i, x in zip(t.doc_id, t.text))
    assert digest(corpus_pipeline.run(spark, SF).toPandas()) == digest(run[-1])
    assert quality.FOLDS > 1 and mixing.MAX_SWEEPS > 0


def test_stages_take_empty_tables_extra_columns_and_nulls(spark):
    from llm_data import docs
    for rows in ([], [(None, None, None, None), (1, "", "s", "en"), (1, "", "s", "en"), (2, "a b c " * 2000, None, "de")]):
        d = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            d = corpus_pipeline.staged(stage(spark, d, SF))
            assert d.columns == docs(spark, []).columns
        assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() == d.count()
