"""Token counts through a cache of digests.

A text's key is the SHA-256 of its normalised content together with the digest
of the tokenizer (its file, the library's version, the normalisation).  Keys
are joined to the counts stored under them; the distinct keys without one are
encoded once each and appended to the cache, and every document takes its count
from there.  A second run over the same or overlapping documents encodes only
what is new.

Normalisation folds what the tokenizer itself folds before it looks at a text
and nothing more, so that texts with one key have one count: letters A-Z to
lower case if it lower-cases, runs of ASCII white space to one space if it
does that.  A text that holds the string of a special token, in any case, keeps its
own form, as those strings are matched before.  Tokenizers of which the library does
not know that they fold get no normalisation.

The cache is a Parquet table under a folder (partitioned by tokenizer), which
only grows.  Its rows are complete in themselves: a run that dies in the middle
of its append leaves counts that are right, and whatever is missing is encoded
again.  Two runs that append the same key at the same time leave two equal rows,
which count as one.

Edge cases: a null text is empty and has no tokens; equal texts have equal
counts whatever their ids (null ids too); rows are neither merged nor dropped;
columns besides the id and the text are ignored unless named in ``keep``; an
empty table gives an empty result and leaves the cache as it was.  Texts of any
length are encoded whole.

Where a tokenizer drops white space and cuts there (and only there does the
operator rely on it: see ``SPLITS``), a text's count is the sum of its words'
counts.  A task then remembers the words it has met, a bounded number, and the
library encodes each of the others once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_batches, text_of

CACHE = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("tokenizer", T.StringType())])
#: texts of this many bytes at most are encoded together
TOGETHER = 1 << 18
#: words a task remembers, and the longest of them in bytes
WORDS, WORD_BYTES = 1 << 18, 64
#: fixed values: patterns of pre-tokenizers whose matches hold no white space
SPLITS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)


class Tokenizer:
    """What the operator has to know of a tokenizer file: its digest, the
    folds that leave its counts alone, and a function that counts.

    ``.json`` files are read by the tokenizers library, ``.model`` files by
    sentencepiece.  The file's bytes go to the tasks; its size is fixed,
    whatever the data.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.content = f.read()
        self.kind = {".json": "tokenizers", ".model": "sentencepiece"}.get(os.path.splitext(path)[1])
        if self.kind is None:
            raise ValueError(f"{path}: neither a .json nor a .model file")
        self.lower = self.spaces = self.words = False
        self.special: list[str] = []
        if self.kind == "tokenizers":
            spec = json.loads(self.content)
            self.special = [t["content"] for t in spec.get("added_tokens") or []]
            steps = (spec.get("normalizer") or {})
            steps = steps.get("normalizers", [steps]) if steps else []
            # only steps known to commute with the folds may stand beside them
            if all(s["type"] in ("Lowercase", "NFC") or _is_space_fold(s) for s in steps):
                self.lower = any(s["type"] == "Lowercase" for s in steps)
                self.spaces = any(s["type"] == "Replace" for s in steps)
            cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
            cut, bytewise = cuts[0], [c.get("type") == "ByteLevel" and not c.get("add_prefix_space") and not c.get("use_regex") for c in cuts[1:]]
            self.words = (self.lower and self.spaces and bytewise == [True] and cut.get("type") == "Split" and cut.get("behavior") == "Removed" and bool(cut.get("invert"))
                          and cut.get("pattern") in [{"Regex": p} for p in SPLITS] and not any(re.search(r"\s", x) for x in self.special))
        said = f"{self.kind} {version(self.kind)} lower={self.lower} spaces={self.spaces}\n".encode()
        self.digest = hashlib.sha256(said + self.content).hexdigest()

    def normaliser(self) -> Callable[[bytes], bytes]:
        """A function from a text (UTF-8) to the form that its key is taken from."""
        lower, spaces = self.lower, self.spaces
        guard = re.compile(b"|".join(re.escape(s.encode()) for s in self.special), re.IGNORECASE) if self.special else None

        def normalised(text: bytes) -> bytes:
            out = text.lower() if lower else text
            if spaces:
                out = b" ".join([b""] * out[:1].isspace() + out.split() + [b""] * out[-1:].isspace())
            # a fold may also complete a special string, so the folded text is looked at
            if out is not text and guard is not None and (guard.search(out) or guard.search(text)):
                return b"=\x00" + text
            return out
        return normalised

    def counter(self) -> Callable[[list[bytes]], list[int]]:
        """A function from texts (UTF-8) to numbers of tokens, made in the task."""
        if self.kind == "tokenizers":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            import tokenizers
            t = tokenizers.Tokenizer.from_str(self.content.decode("utf-8"))
            t.no_truncation()
            t.no_padding()
            if self.words:
                return WordCounts(t, self.special)
            return lambda texts: [len(e.ids) for e in t.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_proto=self.content)
        return lambda texts: [len(x) for x in p.encode([x.decode() for x in texts], num_threads=1)]


#: a run of ASCII punctuation that ends a word after a letter or digit: the pre-tokenizer cuts before it
END_OF_WORD = re.compile(rb"([a-z0-9])([.,;:!?]+)(?=[\t-\r ]|\Z)")
#: lower-case letters of ASCII and Latin-1: normal form, and one piece for the pre-tokenizer
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself
    where it is printable, else the next free code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class WordCounts:
    """Counts texts by their words; remembers ``WORDS`` words or those of the
    last texts, and none longer than ``WORD_BYTES``.

    A plain word goes to the vocabulary's model directly, since normaliser and
    pre-tokenizer leave it as it is; all others go through the library whole.
    """

    def __init__(self, tokenizer, special: list[str]):
        self.tokenizer, self.known = tokenizer, {}
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special) or b"(?!)", re.IGNORECASE).search
        self.characters = dict(enumerate(byte_characters()))

    def words(self, text: bytes) -> list[bytes]:
        if self.special(text):  # matched by the library in their own case, before anything else
            return text.split()
        return END_OF_WORD.sub(rb"\1 \2", text.lower()).split()

    def learn(self, words: list[bytes]) -> None:
        model, rest = self.tokenizer.model, []
        for w in words:
            if PLAIN.fullmatch(w) and not self.special(w):
                self.known[w] = len(model.tokenize(w.decode("latin-1").translate(self.characters)))
            else:
                rest.append(w)
        if rest:
            found = self.tokenizer.encode([w.decode() for w in rest], is_pretokenized=True, add_special_tokens=False)
            at = np.fromiter(found.word_ids, np.int64, len(found))
            self.known.update(zip(rest, np.bincount(at, minlength=len(rest)).tolist()))

    def __call__(self, texts: list[bytes]) -> list[int]:
        split = [self.words(x) for x in texts]
        words = set().union(*split)
        if len(self.known) + len(words) > WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        self.learn(new)
        out = [sum(map(self.known.__getitem__, ws)) for ws in split]
        for w in new:
            if len(w) > WORD_BYTES:
                del self.known[w]
        return out


def _is_space_fold(step: dict) -> bool:
    return step.get("pattern") == {"Regex": "\\s+"} and step.get("content") == " "


def _task(tokenizer) -> tuple[Callable[[bytes], bytes], Callable[[list[bytes]], list[int]]]:
    """The functions of a broadcast tokenizer; it lives as long as the Python worker."""
    known = tokenizer.value.__dict__
    if "_task" not in known:
        known["_task"] = tokenizer.value.normaliser(), tokenizer.value.counter()
    return known["_task"]


def with_keys(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``digest`` in place of ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    rest = docs.drop("text").columns

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normalised = _task(shared)[0]
        for b in batches:
            texts = b["text"].cast(pa.large_binary()).to_pylist()
            digests = [hashlib.sha256(normalised(x)).digest() for x in texts]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in rest], pa.array(map(len, texts), pa.int64()), pa.array(digests, pa.binary())],
                                             [*rest, "n_bytes", "digest"])

    schema = T.StructType([*docs.drop("text").schema.fields]).add("n_bytes", T.LongType()).add("digest", T.BinaryType())
    return text_batches(docs).select(*rest, "text").mapInArrow(key, schema)


def encode(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) of the different texts of each batch."""
    shared = texts.sparkSession.sparkContext.broadcast(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normalised, counts = _task(shared)
        for b in batches:
            different = {hashlib.sha256(normalised(x)).digest(): x for x in b["text"].cast(pa.large_binary()).to_pylist()}
            out, group, size = [], [], 0
            for x in different.values():
                if group and size + len(x) > TOGETHER:
                    out += counts(group)
                    group, size = [], 0
                group.append(x)
                size += len(x)
            out += counts(group) if group else []
            yield pa.RecordBatch.from_arrays([pa.array(different, pa.binary()), pa.array(out, pa.int64())], ["digest", "n_tokens"])

    return text_batches(texts).select("text").mapInArrow(count, "digest binary, n_tokens long")


def stored_counts(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) stored for this tokenizer, each digest once."""
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)  # the folder exists from now on
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == tokenizer.digest)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def missing(keys: DataFrame, known: DataFrame) -> DataFrame:
    """(digest, place): each digest without a stored count and the place of the
    document it will be encoded from."""
    wanted = keys.groupBy("digest").agg(F.min("place").alias("place"))
    return wanted.join(known, "digest", "left_anti")


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache: str, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of ``docs``, and the columns of ``keep``.

    ``cache`` is a folder that driver and executors share.  Texts are read
    twice: once for their keys, once for the ones to encode.  Only texts of
    places that keys without a count name pass the join to the encoder, and a
    text that passes it besides (two rows of one place) is counted by what it is.
    """
    spark = docs.sparkSession
    text = text_of(docs["text"])
    # a number for the id; rows without one are told apart by their text
    place = F.coalesce(F.xxhash64(F.when(docs[id_col].isNotNull(), docs[id_col].cast("string"))), F.lit(0))
    place = F.when(docs[id_col].isNull(), F.xxhash64(text)).otherwise(place).alias("place")
    rows = docs.select(docs[id_col].alias("id"), *[docs[c].alias(f"kept_{i}") for i, c in enumerate(keep)], place, text.alias("text"))
    keys = staged(with_keys(rows, tokenizer))
    new = staged(missing(keys, stored_counts(spark, cache, tokenizer)))
    texts = rows.select("place", "text").join(new.select("place").hint("shuffle_hash"), "place", "left_semi")
    found = encode(texts, tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    found.withColumn("tokenizer", F.lit(tokenizer.digest)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    # written out, so that the join with a digest of many copies can be split
    counts = staged(stored_counts(spark, cache, tokenizer).join(keys.select("digest"), "digest", "left_semi"))
    return keys.join(counts, "digest").select(
        F.col("id").alias(id_col), *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens")
