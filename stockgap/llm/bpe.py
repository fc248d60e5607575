"""Byte-level BPE encoding and decoding with tree concatenation.

Texts longer than ``LEAF`` code points are halved until they are short
enough; the leaves are encoded in parallel tasks, and neighbours are joined
pairwise up the tree.  A join re-encodes a window around the cut, and doubles
it until its tokens agree with the left side's at one token before the cut
and with the right side's at one after it (or the window has reached the
side's end).  Two neighbouring tokens that BPE leaves side by side in one
word stay so in any other that holds the pair, so agreement at one token on
each side makes the spliced sequence the encoding of the whole.  The split
pattern looks at most two characters ahead (contractions, the last of several
spaces); tokens that close to a cut or to the window's end count as unsettled
and never as agreement.

The vocabulary file reaches tasks as a broadcast of its text; its size is
that of the file, whatever the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import shuffle_partitions, text_batches, text_of

LEAF = 1 << 16
WINDOW = 64
SLICE = 512


#: fixed value: the split pattern of byte-level BPE vocabularies (the tokenizers library's ByteLevel)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself
    where it is one, else the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> dict:
    """What a task needs of a byte-level BPE vocabulary file: ``ranks``
    (token bytes -> id, merged in the order of the ids) and ``special`` (text
    -> id)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    t = Tokenizer.from_str(text)
    special = {a.content: i for i, a in t.get_added_tokens_decoder().items()}
    byte = _byte_of_char()
    ranks = {bytes(map(byte.__getitem__, k)): i for k, i in t.get_vocab(with_added_tokens=False).items() if k not in special}
    spec = json.loads(text)
    cut = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError(f"{path}: not a plain byte-level vocabulary (no normalizer, ByteLevel without prefix space)")
    model = spec["model"]
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path}: the merges are not in the order of the ids")
    return {"ranks": ranks, "special": special}


class Codec:
    """Encodes with the vocabulary's ranks, decodes with its tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = special
        known = {i: k for k, i in {**ranks, **{k.encode(): i for k, i in special.items()}}.items()}
        self.bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.width = np.array(list(map(len, self.bytes)), np.int64)
        if not all(c.encode() in ranks for c in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")):
            raise ValueError("a contraction of the split pattern is not a token")
        #: bytes that a cut may influence to its left: three characters, or a special token
        self.guard = max(12, *map(len, map(str.encode, special))) if special else 12

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(t, allowed_special="all").astype(np.int32) for t in texts]

    def halves(self, text: str, leaf: int) -> list[str]:
        """``text`` halved until no part is longer than ``leaf``; a cut never
        falls into a special token's text."""
        parts = 1
        while len(text) > leaf * parts:
            parts *= 2
        cuts = [0]
        for i in range(1, parts):
            c = len(text) * i // parts
            for s in self.special:
                if (at := text.find(s, max(0, c - len(s) + 1), c + len(s) - 1)) >= 0:
                    c = min(c, at)
            cuts.append(max(c, cuts[-1]))
        return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)])]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return [b"".join(map(self.bytes.__getitem__, x.tolist())).decode("utf-8", "replace") for x in ids]

    def _keys(self, ids: np.ndarray, start: int) -> np.ndarray:
        """One number per token for its first byte and its id."""
        ends = np.cumsum(self.width[ids])
        return (start + ends - self.width[ids]) * len(self.width) + ids

    def join(self, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], window: int = WINDOW) -> tuple[str, np.ndarray]:
        """(text, ids) of two adjoining (text, ids); byte 0 is the cut."""
        (a, x), (b, y) = left, right
        if not a or not b:
            return (a + b, x if a else y)
        from_left, from_right = self._keys(x, -int(self.width[x].sum())), self._keys(y, 0)
        while True:
            head, tail = a[max(0, len(a) - window):], b[:window]
            z = self.encode([head + tail])[0]
            mid, ends = self._keys(z, -len(head.encode())), np.cumsum(self.width[z])
            settled_left = ends <= len(head.encode()) - self.guard
            settled_right = ends <= ends[-1] - self.guard
            at_left = np.flatnonzero(np.isin(mid, from_left) & settled_left) if len(head) < len(a) else np.array([-1])
            at_right = np.flatnonzero(np.isin(mid, from_right) & settled_right) if len(tail) < len(b) else np.array([len(z)])
            if len(at_left) and len(at_right):
                i, j = int(at_left[0]), int(at_right[-1])
                before = x[: np.searchsorted(from_left, mid[i])] if i >= 0 else x[:0]
                after = y[np.searchsorted(from_right, mid[j]) + 1:] if j < len(z) else y[:0]
                return a + b, np.concatenate([before, z[max(i, 0): j + 1], after])
            window *= 2

    def tree(self, leaves: list[tuple[str, np.ndarray]], window: int = WINDOW) -> np.ndarray:
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i: i + 2], window) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0][1]


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``tokenize``'s rows."""
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def tokenize(docs: DataFrame, vocabulary_path: str, leaf: int = LEAF, window: int = WINDOW,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ids array<int>, decoded) per row of ``docs``: the ids of the
    whole text (null: empty) and the text they decode to; ``keep`` names
    columns to carry along.

    Special tokens written out in a text become their ids, as the tokenizers
    library has it.  Rows with equal long texts are encoded once; rows are
    neither merged nor dropped, whatever their doc_id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary_path))

    def codec() -> Codec:
        known = shared.value
        if "codec" not in known:  # the broadcast lives as long as the Python worker
            known["codec"] = Codec(known["ranks"], known["special"])
        return known["codec"]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec()
        for b in batches:
            for at in range(0, len(b), SLICE):  # ids and texts of a few rows at a time
                own = b[at: at + SLICE].copy()
                ids = c.encode(own.pop("text").tolist())
                yield own.assign(ids=ids, decoded=c.decode(ids))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec()
        for b in batches:
            for h1, h2, text in zip(b.h1, b.h2, b.text):
                parts = c.halves(text, leaf)
                for at in range(0, len(parts), 64):
                    own = parts[at: at + 64]
                    yield pd.DataFrame({"h1": h1, "h2": h2, "i": range(at, at + len(own)), "part": own})

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, last = codec(), None
        for b in batches:
            key = list(zip(b.h1, b.h2, b.i))
            new = [k != before for k, before in zip(key, [last, *key])]  # copies follow each other
            last = key[-1] if key else last
            b = b[new]
            if len(b):
                yield b.assign(ids=c.encode(b.part.tolist()))

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        c, group = codec(), group.sort_values("i")
        ids = c.tree(list(zip(group.part, map(np.asarray, group.ids))), window)
        return pd.DataFrame({"h1": group.h1[:1].to_numpy(), "h2": group.h2[:1].to_numpy(), "ids": [ids], "decoded": c.decode([ids])})

    rows = text_batches(docs).select(docs["doc_id"].alias("doc_id"), *[docs[c].alias(c) for c in keep], text_of(docs["text"]).alias("text"))
    carried = T.StructType(rows.drop("text").schema.fields).add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    short = rows.where(F.length("text") <= leaf).mapInPandas(whole, carried)
    long = rows.where(F.length("text") > leaf).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    dealt = long.select("h1", "h2", "text").mapInPandas(cut, "h1 long, h2 long, i int, part string").repartition(
        shuffle_partitions(docs.sparkSession), "h1", "h2", "i").sortWithinPartitions("h1", "h2", "i")
    done = dealt.mapInPandas(leaves, "h1 long, h2 long, i int, part string, ids array<int>").groupBy("h1", "h2").applyInPandas(
        joined, "h1 long, h2 long, ids array<int>, decoded string")
    return short.unionByName(long.select("doc_id", *keep, "h1", "h2").join(done, ["h1", "h2"]).select("doc_id", *keep, "ids", "decoded"))
