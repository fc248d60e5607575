import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import docs
from tokenizers import Tokenizer

from stockgap.llm import bpe
from stockgap.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(**bpe.load(VOCABULARY))


def _want(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aA '\"sStl!?.\n\t  é日0<|>"), st.characters(codec="utf-8"))), st.sampled_from([1, 2, 3, 7, 16]), st.sampled_from([1, 4, 16]))
def test_tree_equals_the_library(codec, library, text, leaf, window):
    if text:
        parts = codec.halves(text, leaf)
        assert "".join(parts) == text
        assert codec.tree(list(zip(parts, codec.encode(parts))), window).tolist() == _want(library, text)


def test_tree_on_hard_runs(codec, library):
    rng = random.Random(2)
    for alphabet in ("s' tl", "<|endoftext|> a", "aaaa", "   x", "!?'s ", "\t\n  a", "日本a "):
        for _ in range(150):
            text = "".join(rng.choice([*alphabet, "<|endoftext|>" if rng.random() < 0.1 else alphabet[0]]) for _ in range(rng.randrange(1, 120)))
            parts = codec.halves(text, rng.choice([1, 2, 5, 16]))
            assert codec.tree(list(zip(parts, codec.encode(parts))), rng.choice([1, 4])).tolist() == _want(library, text)


def test_halves_never_cut_a_special_token(codec):
    parts = codec.halves("ab<|endoftext|><|endoftext|>" * 9, 2)
    assert "".join(parts).count("<|endoftext|>") == sum(p.count("<|endoftext|>") for p in parts) == 18


def test_documents_of_every_kind(spark, library):
    rng = random.Random(4)
    long = "".join(rng.choice("abc de'sf\n  ") for _ in range(5_000))
    unsplit = "".join(rng.choice("abcdefgh") for _ in range(3_000))
    rows = [(1, None), (2, ""), (3, "Hello <|endoftext|> wörld"), (None, "x"), (4, long), (5, long), (5, long), (6, unsplit), (7, " " * 999), (8, "ss" * 600)]
    got = bpe.digests(bpe.tokenize(docs(spark, rows), VOCABULARY, leaf=100, window=8)).collect()
    key = lambda r: str(r)
    want = []
    for i, t in rows:
        ids = _want(library, t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert bpe.tokenize(docs(spark, []), VOCABULARY).count() == 0


def test_decoding_broken_characters_as_the_library_does(codec, library):
    rng = random.Random(9)
    for _ in range(200):
        ids = [rng.randrange(len(codec.width)) for _ in range(rng.randrange(1, 12))]
        assert codec.decode([__import__("numpy").array(ids)])[0] == library.decode(ids, skip_special_tokens=False)


def test_other_kinds_of_vocabularies_are_an_error():
    import public_tokenizers
    with pytest.raises(ValueError, match="byte-level"):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))
