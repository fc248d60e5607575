"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty.

Patterns (leftmost, not overlapping, per kind): ``assign`` a credential
assignment, ``access`` a cloud access id, ``hex`` a long hexadecimal run.
Spans are those of the whole match, in code points, end exclusive.

Novelty (``novel``): a candidate is a long token shortly after or before a
sensitive word that no pattern has reported.  Its marginal cost is the growth of the
zstandard frame of its surroundings when it is put between them; the
compressor is primed with the identifiers that stand in most documents of the
corpus.  What costs at least ``MIN_RATIO`` bytes a character is
nothing that the code around it, or common names, would explain.

Memory: the dictionary holds the ``N_IDENTIFIERS`` most frequent identifiers
(counts cover the whole texts of all documents), everything else is per document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_batches, text_of

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # maximal runs: the same as matching on and dropping those under 20
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
SENSITIVE = re.compile(r"(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secrets?|tokens?|api[ _-]?keys?|(?:access|private|client|secret|signing|encryption)[ _-]?keys?"
                       r"|auth(?:orization)?|bearer|credentials?|signature|session[ _-]?id|connection[ _-]?string)(?![A-Za-z])", re.I | re.A)
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_])[A-Za-z0-9+/_][A-Za-z0-9+/_.=~!@#$%^&*-]{14,}[A-Za-z0-9+/_=]")
REACH = 48  # characters between a sensitive word and a candidate
_TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=~!@#$%^&*-"
AROUND = 256  # characters of surroundings on each side
N_IDENTIFIERS = 4096
MIN_DOCS = 3  # documents an identifier must stand in, or any copied key would explain itself
MIN_RATIO = 0.7
MIN_CLASSES = 2


def _spans(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(k, v) for k, v in fields.items()]))


_BASE = _spans(kind=T.StringType(), start=T.IntegerType(), end=T.IntegerType(), text=T.StringType())
_CANDIDATES = _spans(start=T.IntegerType(), end=T.IntegerType(), before=T.StringType(), text=T.StringType(), after=T.StringType())
_NOVEL = _spans(kind=T.StringType(), start=T.IntegerType(), end=T.IntegerType(), text=T.StringType(), marginal_bytes=T.IntegerType())


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, text) of the patterns, by start, then kind."""
    found = [("assign", *m.span(), m[0]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _token_start(text: str, at: int) -> int:
    """Where the run of token characters that reaches ``at`` begins."""
    low = max(0, at - 4096)
    n = len(text[low:at].rstrip(_TOKEN))
    return low + n if n or not low else len(text[:low].rstrip(_TOKEN))


def candidates(text: str, base: Iterable[tuple[str, int, int, str]]) -> list[tuple[int, int, str, str, str]]:
    """(start, end, before, text, after) of tokens near sensitive words that
    touch no base span and mix letter cases, digits or signs."""
    taken = [x[1:3] for x in base]
    out: dict[int, tuple[int, int, str, str, str]] = {}

    def add(i: int, j: int, token: str) -> None:
        classes = sum(any(map(f, token)) for f in (str.islower, str.isupper, str.isdigit))
        if classes >= MIN_CLASSES and not any(a < j and i < b for a, b in taken) and (i not in out or j > out[i][1]):
            out[i] = (i, j, text[max(0, i - AROUND): i], text[i:j], text[j: j + AROUND])

    for word in SENSITIVE.finditer(text):
        at = max(0, word.start() - REACH)
        for m in CANDIDATE.finditer(text, _token_start(text, at), word.start()):
            if m.end() >= at:
                add(*m.span(), m[0])
        for m in CANDIDATE.finditer(text, word.end(), min(len(text), word.end() + REACH + 4096)):
            i, j = m.span()
            if i > word.end() + REACH:
                break
            j = CANDIDATE.match(text, i).end()  # beyond the searched stretch, if it is longer
            add(i, j, m[0])
    return sorted(out.values())


@F.pandas_udf(T.StructType([T.StructField("base", _BASE), T.StructField("cand", _CANDIDATES)]))
def scan_udf(texts: pd.Series) -> pd.DataFrame:
    base = [base_spans(t) for t in texts]
    return pd.DataFrame({"base": base, "cand": [candidates(t, b) for t, b in zip(texts, base)]})


class Novelty:
    """Marginal compressed bytes of a string between its surroundings."""

    def __init__(self, identifiers: list[str], level: int = 9):
        primed = " ".join(identifiers).encode() or b" " * 8
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(
            primed.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)

    def marginal(self, before: str, text: str, after: str) -> int:
        size = lambda x: len(self.compressor.compress(x.encode("utf-8", "replace")))
        return size(before + text + after) - size(before + after)


def identifiers(docs: DataFrame, scanned: DataFrame, n: int = N_IDENTIFIERS) -> list[str]:
    """The ``n`` identifiers that stand in most documents, rarest first
    (zstandard finds what is late in a dictionary cheapest); at most ``n``
    rows reach the driver.  A document doesn't count for a name that is (part
    of) one of its candidates."""
    def counted(text: Column, frame: DataFrame, count: str) -> DataFrame:
        names = F.array_distinct(F.regexp_extract_all(text, F.lit("[A-Za-z_][A-Za-z0-9_]{2,63}"), F.lit(0)))
        return frame.select(F.explode(names).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias(count))

    all_of = counted(text_of(docs["text"]), docs, "n").where(F.col("n") >= MIN_DOCS)
    judged = counted(F.array_join(F.col("cand.text"), " "), scanned.where(F.size("cand") > 0), "m")
    top = all_of.join(judged, "name", "left").select("name", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n")).where(
        F.col("n") >= MIN_DOCS).orderBy(F.desc("n"), "name").limit(n)
    return [r["name"] for r in top.collect()][::-1]


def find_secrets(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """(doc_id, base, novel) per row of ``docs``: arrays of (kind, start, end,
    text), novel ones with their marginal bytes.  Null text: empty; every row
    is judged on its own, whatever its id."""
    scanned = staged(text_batches(docs).select(docs["doc_id"].alias("doc_id"), scan_udf(text_of(docs["text"])).alias("x")).select("doc_id", "x.*"))
    names = identifiers(docs, scanned)

    @F.pandas_udf(_NOVEL)
    def judge(cands: pd.Series) -> pd.Series:
        novelty = Novelty(names)
        out = []
        for own in cands:
            costs = [(c, novelty.marginal(c["before"], c["text"], c["after"])) for c in own]
            out.append([("novel", c["start"], c["end"], c["text"], n) for c, n in costs if n >= min_ratio * (c["end"] - c["start"])])
        return pd.Series(out, dtype=object)

    return scanned.select("doc_id", "base", F.when(F.size("cand") > 0, judge("cand")).otherwise(
        F.array().cast(_NOVEL)).alias("novel"))


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """The counts, hash and span list of ``find_secrets``' rows."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    bare = lambda c: F.transform(c, lambda x: F.struct(
        x["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")))
    return found.select("doc_id", *[count(k).alias("n_" + k) for k in KINDS[:3]], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat(bare("base"), bare("novel")))).alias("spans"), F.size("novel").cast("long").alias("n_novel"))
