"""Phrase collocations by Toivonen mining.

A sample of the documents proposes words and phrases.  One pass over all
documents then counts, exactly, the proposed phrases together with their
negative border: every phrase that is not proposed itself while the phrases it
is made of (all its words but the last, all but the first) are.  A phrase of
the border that turns out frequent is a failure of the sample: its own
extensions were not counted.  It joins the proposed ones, and a further pass
counts what that opens up and no pass has counted yet.  When a pass finds no
failure, every frequent phrase has been counted; with phrases of up to ``n``
words that takes at most ``n`` passes.

Proposed phrases reach the tasks as a Bloom filter of a fixed number of bits,
whatever their number.  A false positive only adds a phrase to those that are
counted, so counts are exact at any fill; a filter that is too small costs
time.  Both an earlier pass and a later one decide by the same bits whether a
phrase was counted before, so none is counted twice.

Inside a task everything is columnar: the bytes of a few MB of text are
classified by a table, words become dictionary codes, and neighbouring codes
are counted; only distinct phrases with their counts leave it.

Edge cases: null texts are empty, null languages are ``und``; phrases never
cross a document or a piece; repeated rows are documents like any other; ties
in the order are broken by the phrase, which is unique in its language; a table
without frequent phrases gives an empty result; columns besides text, lang
and doc_id (which only the sample uses) are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_batches, text_of

MIN_COUNT = 10
MAX_WORDS = 3
#: one document in so many is sampled
SAMPLE = 16
#: bits of the filter of proposed phrases (a power of two), and probes a phrase
FILTER_BITS = 1 << 25
PROBES = 3
#: bytes of text that a task counts together
CHUNK = 1 << 23
#: fixed values: what ends a piece, and what separates words in it
PIECE_END = b".,;:!?\n\x0b\x0c\r"
WORD_END = b" \t"

_COUNTED = "lang string, k int, phrase string, n long, known boolean"


def _classes() -> tuple[np.ndarray, np.ndarray]:
    lower, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    lower[65:91] += 32
    kind[list(WORD_END)] = 1
    kind[list(PIECE_END)] = 2
    return lower, kind


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of a batch of texts, in order, and for each word
    whether the next one follows it in the same piece."""
    lower, kind = _classes()
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    start = np.zeros(len(raw) + 1, bool)
    start[offsets - offsets[0]] = True  # the first byte of each text
    of = kind[raw]
    inside = of == 0
    first = inside & (start[:-1] | np.concatenate([[True], ~inside[:-1]]))
    at = np.flatnonzero(first)
    ends = np.cumsum(inside, dtype=np.int32)  # word bytes up to and with each byte (a text has at most 2 GB)
    begins = ends[at] - 1
    total = int(ends[-1]) if len(ends) else 0
    piece = np.cumsum((of == 2) | start[:-1], dtype=np.int32)[at]
    bounds = np.append(begins, total).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(lower[raw[inside]].tobytes())])
    return words, np.append(piece[1:] == piece[:-1], False)[: len(at)]


_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (murmur3's), for arrays of uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed=seed) for w in words), np.uint64, len(words))


def chained(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all its words but the last, and the last's."""
    return _mixed(head * np.uint64(0x9E3779B97F4A7C15) + last)


def _place(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """The bit of each hash in a filter of ``bits`` (a power of two)."""
    return _mixed(hashes + np.uint64(0xA5A5A5A5A5A5A5A5 * probe & _MASK)) & np.uint64(bits - 1)


def filter_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash, one row per probe."""
    return np.stack([_place(hashes, i, bits) for i in range(PROBES)])


def holds(bitmap: np.ndarray, hashes: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
    """Which hashes the filter holds; only those ``among`` are looked up."""
    left = np.arange(len(hashes)) if among is None else np.flatnonzero(among)
    for i in range(PROBES):
        at = _place(hashes[left], i, len(bitmap) * 8)
        left = left[((bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]
    out = np.zeros(len(hashes), bool)
    out[left] = True
    return out


def _joined(parts: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if len(parts) > 1 else parts[0]


def count_chunk(texts: pa.Array, lang: str, old: np.ndarray | None, new: np.ndarray, max_words: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of some texts of one language that the filter
    ``new`` opens up and ``old`` did not (None: words are counted as well).

    A phrase of k words is open if both phrases of k - 1 words in it are
    themselves open and held by the filter; every word is open.
    """
    def batch(k: int, phrases: pa.Array, n: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), k, np.int32)), phrases.cast(pa.binary()).cast(pa.string()),
             pa.array(n.astype(np.int64)), pa.array(known)], ["lang", "k", "phrase", "n", "known"])

    words, follows = split_words(texts)
    if not len(words):
        return
    coded = words.dictionary_encode()
    del words
    vocabulary, code = coded.dictionary, coded.indices.to_numpy()
    single = word_hashes(vocabulary.to_pylist(), lang)
    held = holds(new, single)
    held_old = np.zeros(len(single), bool) if old is None else holds(old, single, held)  # the new filter holds all of the old one
    if old is None:
        yield batch(0, pa.array([b""], pa.large_binary()), np.array([len(code)]), np.array([True]))
        yield batch(1, vocabulary, np.bincount(code, minlength=len(vocabulary)), held)
    # by occurrence: the place of the phrase's last word, its hash, and whether the filters hold it
    last, hashes, held, held_old = None, single[code], held[code], held_old[code]
    for k in range(2, max_words + 1):
        # two overlapping phrases of k - 1 words, one place apart, make one of k
        at = np.flatnonzero(held[:-1] & held[1:] & (follows[:-1] if last is None else (np.diff(last) == 1) & follows[last[:-1]]))
        if not len(at):
            return
        open_old = held_old[at] & held_old[at + 1]
        last = (at if last is None else last[at]) + 1
        hashes = chained(hashes[at], single[code[last]])
        held = holds(new, hashes)
        held_old = np.zeros(len(at), bool) if old is None else holds(old, hashes, held & open_old)
        own = np.flatnonzero(~open_old)  # counted in this pass
        if not len(own):
            continue
        ids = np.stack([code[last[own] - j] for j in range(k - 1, -1, -1)])
        codes = ids[0].astype(np.int64)
        for j in range(1, k):
            codes, keys = pd.factorize(codes * len(vocabulary) + ids[j])
        n = np.bincount(codes, minlength=len(keys))
        some = np.empty(len(keys), np.int64)
        some[codes] = np.arange(len(codes))  # an occurrence of each
        ids, known = ids[:, some], held[own[some]]
        del codes, keys, some
        for i in range(0, len(n), 1 << 17):
            yield batch(k, _joined([vocabulary.take(pa.array(c[i: i + (1 << 17)])) for c in ids]), n[i: i + (1 << 17)], known[i: i + (1 << 17)])


def _tasks(old: "pa.Buffer | None", new, max_words: int, chunk: int):
    """The function of a counting pass over (text, lang) batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = old.value if old is not None else None, new.value
        waiting: list[pa.RecordBatch] = []

        def count() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(waiting).combine_chunks()
            for lang in pc.unique(t["lang"]).to_pylist():
                own = t.filter(pc.equal(t["lang"], lang))["text"].combine_chunks()
                for part in own.chunks if isinstance(own, pa.ChunkedArray) else [own]:
                    yield from count_chunk(part, lang, before, now, max_words)

        size = 0
        for b in batches:
            if waiting and size + b.nbytes > chunk:
                yield from count()
                waiting, size = [], 0
            waiting.append(b)
            size += b.nbytes
        if waiting:
            yield from count()
    return run


def _texts(docs: DataFrame) -> DataFrame:
    return text_batches(docs).select(text_of(docs["text"]).alias("text"), F.coalesce(docs["lang"], F.lit("und")).alias("lang"))


def counted(texts: DataFrame, old: np.ndarray | None, new: np.ndarray, least: int, max_words: int, chunk: int = CHUNK) -> DataFrame:
    """(lang, k, phrase, n, known) of one pass: phrases of ``least``
    occurrences or more, and, with k = 0, the words of each language."""
    sc = texts.sparkSession.sparkContext
    run = _tasks(None if old is None else sc.broadcast(old), sc.broadcast(new), max_words, chunk)
    return texts.mapInArrow(run, _COUNTED).groupBy("lang", "k", "phrase").agg(
        F.sum("n").alias("n"), F.max("known").alias("known")).where((F.col("n") >= least) | (F.col("k") == 0))


def filter_of(phrases: DataFrame, bits: int) -> np.ndarray:
    """The Bloom filter of (lang, phrase) rows: what reaches the driver are its
    own words, ``bits / 64`` at most, whatever the number of phrases."""
    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for lang, own in b.groupby("lang", sort=False):
                split = [p.encode().split(b" ") for p in own.phrase]
                every = word_hashes([w for s in split for w in s], lang)
                size = np.array([len(s) for s in split])
                begin = np.cumsum(size) - size
                h = every[begin] if len(begin) else every
                for k in range(1, int(size.max(initial=1))):
                    more = size > k
                    h = np.where(more, chained(h, every[np.minimum(begin + k, len(every) - 1)]), h)
                out.append(filter_places(h, bits).ravel())
            at = np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)
            yield pd.DataFrame({"word": (at >> np.uint64(6)).astype(np.int64), "mask": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    words = phrases.select("lang", "phrase").mapInPandas(places, "word long, mask long").groupBy("word").agg(
        F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["word"].to_numpy()] = words["mask"].to_numpy()
    return bitmap.view(np.uint8)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, sample: int = SAMPLE,
                     bits: int = FILTER_BITS, chunk: int = CHUNK) -> DataFrame:
    """(lang, k, phrase, n): every phrase of up to ``max_words`` words with
    ``min_count`` occurrences or more in its language, exactly counted; and,
    with k = 0 and the empty phrase, each language's number of words.

    The sample proposes what occurs in it twice, or half as often as its
    share of ``min_count`` if that is more.
    """
    # of a sampled document the sample takes the whole text; nulls count as one id
    drawn = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    lowered = max(2, min_count // (2 * sample))
    everything = np.full(bits // 8, 255, np.uint8)
    proposed = staged(counted(_texts(drawn), None, everything, lowered, max_words - 1, chunk).where("k > 0").select("lang", "phrase"))
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 64 at least")
    texts, old, new, found = _texts(docs), None, filter_of(proposed, bits), None
    for _ in range(max_words):
        part = staged(counted(texts, old, new, min_count, max_words, chunk))
        found = part if found is None else found.unionByName(part)
        failures = part.where((F.col("k") > 0) & (F.col("k") < max_words) & ~F.col("known")).select("lang", "phrase")
        more = filter_of(failures, bits)
        if not more.any():
            break
        old, new = new, new | more
    return found.select("lang", "k", "phrase", "n")


def _cut(whole: Column, k: int, words: int) -> tuple[Column, Column]:
    """The first ``k`` of a phrase's words and the others."""
    return F.substring_index(whole, " ", k), F.substring_index(whole, " ", k - words)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = 2000, **mining) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language (the report's length).

    score = floor(1000000 * a * a / (l * r)) of the phrase's worst cut into
    a first part (l occurrences) and a rest (r).  A phrase inside a longer
    one that has half its occurrences or more is left out.  Arithmetic is
    in decimals of 38 digits: exact up to 10**15 occurrences.
    """
    counts = staged(frequent_phrases(docs, min_count, max_words, **mining))
    size = counts.where("k = 0").select("lang", F.col("n").alias("words"))
    scored = None
    for k in range(2, max_words + 1):
        cand = counts.where(F.col("k") == k).select("lang", "phrase", F.col("n").alias("a"), *[
            c.alias(f"{s}{i}") for i in range(1, k) for s, c in zip("fg", _cut(F.col("phrase"), i, k))])
        for i in range(1, k):
            for s in "fg":
                part = counts.where(F.col("k") == (i if s == "f" else k - i)).select("lang", F.col("phrase").alias(f"{s}{i}"), F.col("n").alias(f"n{s}{i}"))
                cand = cand.join(part, ["lang", f"{s}{i}"])
        d = lambda c: F.col(c).cast("decimal(16,0)")
        cuts = [F.struct(F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * CAST(a * CAST(a AS DECIMAL(16,0)) AS DECIMAL(31,0))) div "
                                f"(CAST(nf{i} AS DECIMAL(16,0)) * CAST(ng{i} AS DECIMAL(16,0)))").cast("long").alias("score"),
                         F.lit(i).alias("cut"), F.col(f"nf{i}").alias("l"), F.col(f"ng{i}").alias("r")) for i in range(1, k)]
        own = cand.select("lang", "phrase", "a", F.lit(k).alias("k"), (F.least(*cuts) if len(cuts) > 1 else cuts[0]).alias("c"))
        scored = own if scored is None else scored.unionByName(own)
    # the largest count of any longer phrase that a phrase lies in
    inner = [(i, j) for k in range(3, max_words + 1) for i, j in [(k, w) for w in range(2, k)]]
    kept = scored
    if inner:
        words = F.split("phrase", " ")
        parts = [F.when(F.col("k") == k, F.array(*[F.array_join(F.slice(words, at, w), " ") for at in range(1, k - w + 2)])) for k, w in inner]
        within = counts.where("k > 2").select("lang", "n", F.explode(F.flatten(F.array_compact(F.array(*parts)))).alias("phrase")).groupBy(
            "lang", "phrase").agg(F.max("n").alias("longer"))
        kept = scored.join(within, ["lang", "phrase"], "left").where(
            F.coalesce(F.lit(100) * F.col("longer") < F.lit(50) * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "c.score", "c.l", "c.r").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
