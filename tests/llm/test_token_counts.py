import random

import public_tokenizers
import pytest
import sentencepiece
from llm_data import docs
from tokenizers import Tokenizer as Library

from stockgap.llm import queries
from stockgap.llm.token_counts import Tokenizer, count_tokens, encode, stored_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", "Hello, World!", "hello,\n\t world!", " hello, world! ", "Straße ΣΑΣ İstanbul K", "a<|endoftext|>b", "A<|ENDOFTEXT|>b", "a<|endoftext|>B",
         "<|startoftext|>", "<|\nendoftext|>", "éÅ   x", "dog's 1234 ?!", "\x00\x1f\x85 x", "日本語 ไทย", "x" * 20000, "word " * 20000, "=\x00hello"]


def rows(texts):
    return [(i, t) for i, t in enumerate(texts)]


def plain(texts, path=WORDS):
    if path.endswith(".model"):
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(p.encode(t or "")) for t in texts]
    t = Library.from_file(path)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def cached(spark, cache, tokenizer):
    return stored_counts(spark, cache, tokenizer).count()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_are_the_librarys(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    got = count_tokens(docs(spark, rows([*TEXTS, None])), Tokenizer(path), f"{tmp_path}/cache").collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in sorted(got)] == [
        (i, len((t or "").encode()), n) for i, (t, n) in enumerate(zip([*TEXTS, None], plain([*TEXTS, None], path)))]


def test_only_distinct_misses_are_encoded(spark, tmp_path, monkeypatch):
    from stockgap.llm import token_counts
    cache, tok, seen = f"{tmp_path}/cache", Tokenizer(WORDS), []
    monkeypatch.setattr(token_counts, "encode", lambda df, t: encode(seen.append(df.count()) or df, t))
    first = docs(spark, [(1, "One text"), (2, "one  TEXT"), (3, "another"), (None, "another"), (3, "another")])
    assert sorted(r.n_tokens for r in count_tokens(first, tok, cache).collect()) == [1, 1, 1, 2, 2]
    assert cached(spark, cache, tok) == 2
    assert sorted(r.n_tokens for r in count_tokens(docs(spark, [(9, "ONE text"), (8, "a third one")]), tok, cache).collect()) == [2, 3]
    assert cached(spark, cache, tok) == 3
    assert count_tokens(first, tok, cache).count() == 5
    assert seen == [2, 1, 0]
    other = Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.digest != tok.digest and cached(spark, cache, other) == 0


def test_counts_come_from_the_cache_and_equal_rows_count_once(spark, tmp_path):
    cache, tok = f"{tmp_path}/cache", Tokenizer(WORDS)
    count_tokens(docs(spark, [(1, "hello")]), tok, cache).count()
    planted = spark.read.parquet(cache).selectExpr("digest", "n_tokens + 41 AS n_tokens", "tokenizer").collect()
    for _ in range(2):  # two runs that appended at the same time
        spark.createDataFrame(planted, "digest binary, n_tokens long, tokenizer string").write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert [r.n_tokens for r in count_tokens(docs(spark, [(1, "hello"), (2, "HELLO")]), tok, cache).collect()] == [42, 42]


def test_folds_keep_special_strings_apart():
    tok = Tokenizer(WORDS)
    assert tok.lower and tok.spaces and tok.words and not Tokenizer(public_tokenizers.path("byte_bpe_50k.json")).lower
    forms = [tok.normaliser()(t.encode()) for t in TEXTS]
    assert forms[1] == forms[2] != forms[3] and forms[5] != forms[6] != forms[7] and len(set(forms)) == len(forms) - 1


def test_words_add_up_to_their_text():
    """Random strings of awkward characters: the words' counts against the library's count of the whole."""
    rng, count, pieces = random.Random(4), Tokenizer(WORDS).counter(), [
        "a", "B", "'s", "'", "9", "42", "é", "e\u0301", "\u0301", "İ", "ΑΣ", "\u212a", "한", "\u1112\u1161", "日本", "👩\u200d👧", "...", "<|", "|>", "<|endoftext|>",
        " ", "  ", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x85", "\u00a0", "\u2003", "\u200b", "\ufeff", "<|startoftext|>", "\x00", "don't", "I'LL"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 30))) for _ in range(20000)]
    assert count([t.encode() for t in texts]) == plain(texts)


def test_remembered_words_are_bounded(monkeypatch):
    from stockgap.llm import token_counts
    monkeypatch.setattr(token_counts, "WORDS", 50)
    count = Tokenizer(WORDS).counter()
    texts = [" ".join(f"word{i * 7 % 200} w{i} {'long' * 40}" for i in range(k, k + 30)) for k in range(0, 400, 10)]
    assert [n for t in texts for n in count([t.encode()])] == plain(texts)
    assert 0 < len(count.known) <= 61 and max(map(len, count.known)) <= token_counts.WORD_BYTES


def test_empty_table_and_kept_columns(spark, tmp_path):
    cache = f"{tmp_path}/cache"
    assert count_tokens(docs(spark, []), Tokenizer(WORDS), cache).collect() == []
    got = count_tokens(docs(spark, [(1, "a", "s1")]), Tokenizer(WORDS), cache, keep=("source", "ids"))
    assert got.columns == ["doc_id", "source", "ids", "n_bytes", "n_tokens"] and got.collect() == [(1, "s1", "c", 1, 1)]
    with pytest.raises(ValueError):
        Tokenizer(__file__)


def test_registered_query(spark, tmp_path):
    texts = [*TEXTS, None, "long text " * 1500]
    docs(spark, rows(texts)).select("doc_id", "text", "lang", "source").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.QUERIES["op12_token_counts"](spark, str(tmp_path))
    want = [(i, len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, plain(texts)))]
    assert [tuple(r) for r in sorted(df.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())] == want
