"""Prefix trie of rebuilt conversations, by composable monoid fingerprints.

Conversation c is rebuilt from the head of another one (its base) and its own
turns after as many.  No rebuilt conversation is ever written out.  A run of
turns has the fingerprint (length, hash) with

    (n, x) * (m, y) = (n + m, x * B**m + y  mod 2**127 - 1)

which is associative, so the fingerprint of every rebuilt prefix follows from
prefix products of the original conversations: with the head's product H and
the product P(h) of the own turns it replaces, the prefix that ends in own
turn i has the hash P(i) + (H - P(h)) * B**(i - h).  Turns themselves stay
where they are: a reference, 256 bits of SHA-256 over role and text, stands for
a turn; one half of it enters the products, the other half is what groups are
verified by.

A node is a group of equal (depth, hash).  If all members of every group agree
on the last turn's reference, equal hashes mean equal sequences: the parent's
hash follows from the node's and its last turn's, so agreement carries down
from the root.  If a group does not agree, two sequences collided, and
everything is done again with another base B.

Sums over subtrees need no walk through the tree.  With the smallest member of
a node as its owner, the nodes a conversation owns are the end of its path.
What a subtree holds is therefore a sum over the members of its top, each
giving the part of its path that lies below and that it owns.

Edge cases: rows whose conv_id is null belong to no conversation; null roles
and texts are empty; turns that tie are ordered by role and reference; repeated
rows are turns like any other; an empty table has no nodes.  Input columns
besides conv_id, turn, role and text are ignored, whatever their names.  A
turn's text is read once and never shuffled, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions, staged

PRIME = (1 << 127) - 1
ATTEMPTS = 5
#: most turns a rebuilt conversation takes from its base
HEAD = 5
#: conversations whose ids share this block are joined to one text before they are hashed
ID_BLOCK = 4096
_LOW = (1 << 64) - 1


def base_of(attempt: int, prime: int) -> int:
    """The multiplier of an attempt, a fixed pseudo-random residue."""
    return 2 + int.from_bytes(hashlib.sha256(b"conversation trie %d" % attempt).digest(), "big") % (prime - 3)


def _join(hi: int, lo: int) -> int:
    return (int(hi) << 64) | (int(lo) & _LOW)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _split(x: int) -> tuple[int, int]:
    return _signed(x >> 64), _signed(x & _LOW)


def turn_references(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, r1..r4, chars): one row per turn, its text
    replaced by a 256-bit reference over role and text and its length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = [F.conv(F.substring("digest", 16 * i + 1, 16), 16, -10).cast("long").alias(f"r{i + 1}") for i in range(4)]
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        digest.alias("digest"), F.char_length(text).cast("long").alias("chars")).select(
        "conv_id", "turn", "role", *words, "chars")


_LOCAL = T.StructType([T.StructField(c, T.LongType(), False) for c in
                       ("conv_id", "part", "k", "p1", "p2", "before", "r1", "r2", "r3", "r4", "chars")])


def prefix_products(refs: DataFrame, base: int, prime: int = PRIME) -> DataFrame:
    """(conv_id, pos, p1, p2, before, r1..r4, chars): position from 1, the
    hash of the first ``pos`` turns and their code points without the last.

    Turns are sorted by conversation and turn over all partitions, so that a
    conversation of any length is spread over as many as it fills.  Each
    partition multiplies its own turns; then the partitions' products of a
    conversation, one row each, are multiplied in order.
    """
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "r1", "r2", "r3", "r4"]
    tie = F.monotonically_increasing_id().alias("tie")  # repeated rows need not share a partition
    dealt = refs.select("*", tie).repartitionByRange(shuffle_partitions(refs.sparkSession), *order, "tie").sortWithinPartitions(*order)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, conv, k, x, before = TaskContext.get().partitionId(), None, 0, 0, 0
        for b in batches:
            out = []
            for c, r1, r2, r3, r4, n in zip(*(b[col].tolist() for col in ("conv_id", "r1", "r2", "r3", "r4", "chars"))):
                if c != conv:
                    conv, k, x, before = c, 0, 0, 0
                k, x = k + 1, (x * base + _join(r1 & _LOW, r2)) % prime
                out.append((c, part, k, *_split(x), before, r1, r2, r3, r4, n))
                before += n
            yield pd.DataFrame(out, columns=_LOCAL.names)

    local = staged(dealt.select("conv_id", "r1", "r2", "r3", "r4", "chars").mapInPandas(multiply, _LOCAL))
    totals = local.groupBy("conv_id", "part").agg(
        F.max(F.struct("k", "p1", "p2", (F.col("before") + F.col("chars")).alias("end"))).alias("t")).select("conv_id", "part", "t.*")
    spread = totals.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("conv_id")

    def carried(group: pd.DataFrame) -> pd.DataFrame:  # at most one row per partition
        out, n, x, end = [], 0, 0, 0
        for c, part, k, p1, p2, e in group.sort_values("part").itertuples(index=False):
            out.append((c, part, n, *_split(x), end))
            n, x, end = n + k, (x * pow(base, int(k), prime) + _join(p1, p2)) % prime, end + e
        return pd.DataFrame(out, columns=["conv_id", "part", "n", "c1", "c2", "end"])

    carry = totals.join(spread, "conv_id", "left_semi").groupBy("conv_id").applyInPandas(
        carried, "conv_id long, part long, n long, c1 long, c2 long, end long")

    @F.pandas_udf("p1 long, p2 long")
    def composed(c1: pd.Series, c2: pd.Series, k: pd.Series, p1: pd.Series, p2: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_split((_join(a, b) * pow(base, n, prime) + _join(c, d)) % prime) for a, b, n, c, d in
                             zip(c1.tolist(), c2.tolist(), k.tolist(), p1.tolist(), p2.tolist())], columns=["p1", "p2"])

    # the carry has at most two rows per partition of the sort
    met = local.join(carry, ["conv_id", "part"], "left")
    moved = F.col("c1").isNotNull()
    kept, rest = ["r1", "r2", "r3", "r4", "chars"], met.where(moved).withColumn("p", composed("c1", "c2", "k", "p1", "p2"))
    return met.where(~moved).select("conv_id", F.col("k").alias("pos"), "p1", "p2", "before", *kept).unionByName(
        rest.select("conv_id", (F.col("n") + F.col("k")).alias("pos"), "p.p1", "p.p2", (F.col("end") + F.col("before")).alias("before"), *kept))


def head_turns(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from its base."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)


def base_conversation(conv_id: Column) -> Column:
    """The base of a conversation: the last multiple of 100 not above it."""
    return conv_id - F.pmod(conv_id, F.lit(100))


_MEMBER = T.StructType([T.StructField(c, T.LongType(), False) for c in
                        ("conv_id", "depth", "f1", "f2", "q1", "q2", "before", "chars", "r3", "r4", "length")])


def members(turns: DataFrame, base: int, prime: int = PRIME) -> DataFrame:
    """One row per rebuilt conversation and depth: the prefix's hash (f1, f2)
    and its parent's (q1, q2), the code points before its last turn and of it,
    the verifying half of the last turn's reference, and the rebuilt length."""
    own = turns.withColumn("h", head_turns(F.col("conv_id")))
    here = F.col("pos") == F.col("h")
    top = F.when(F.col("pos") <= HEAD, F.struct("pos", "p1", "p2", "before", "chars", "r1", "r2", "r3", "r4"))
    convs = own.groupBy("conv_id").agg(  # at most HEAD turns and one row each
        F.first("h").alias("h"), F.max("pos").alias("n"), F.sort_array(F.collect_list(top)).alias("top"),
        F.max(F.when(here, F.struct("p1", "p2", (F.col("before") + F.col("chars")).alias("end")))).alias("skip"))
    convs = staged(convs.withColumn("base", base_conversation(F.col("conv_id"))))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("top").alias("head"))
    plans = staged(convs.join(heads, "base", "left").select(
        "conv_id", "h", "n", "skip", F.coalesce(F.filter("head", lambda t: t["pos"] <= F.col("h")), F.array()).alias("head")).select(
        "conv_id", "h", "skip", "head", F.size("head").cast("long").alias("taken"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).cast("long").alias("rest")))
    length = (F.col("taken") + F.col("rest")).alias("length")
    last = F.element_at("head", -1)
    some = F.col("taken") > 0
    suffix = turns.join(plans.where("rest > 0").select(
        "conv_id", "h", "taken", length, F.when(some, last["p1"]).otherwise(0).alias("a1"), F.when(some, last["p2"]).otherwise(0).alias("a2"),
        F.when(some, last["before"] + last["chars"]).otherwise(0).alias("kept"),
        *[F.coalesce(F.col("skip")[c], F.lit(0)).alias(a) for c, a in (("p1", "s1"), ("p2", "s2"), ("end", "gone"))]), "conv_id").where("pos > h")
    inverse = pow(base, -1, prime)

    def composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for c, pos, h, taken, n, p1, p2, a1, a2, s1, s2, r1, r2, *other in b.itertuples(index=False):
                shift = (_join(a1, a2) - _join(s1, s2)) % prime
                f = (_join(p1, p2) + shift * pow(base, int(pos - h), prime)) % prime
                q = (f - _join(r1 & _LOW, r2)) * inverse % prime
                out.append((c, taken + pos - h, *_split(f), *_split(q), *other, n))
            yield pd.DataFrame(out, columns=_MEMBER.names)

    def of_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for c, n, depth, p1, p2, r1, r2, *other in b.itertuples(index=False):
                q = (_join(p1, p2) - _join(r1 & _LOW, r2)) * inverse % prime
                out.append((c, depth, p1, p2, *_split(q), *other, n))
            yield pd.DataFrame(out, columns=_MEMBER.names)

    rest = suffix.select("conv_id", "pos", "h", "taken", "length", "p1", "p2", "a1", "a2", "s1", "s2", "r1", "r2",
                         (F.col("kept") + F.col("before") - F.col("gone")).alias("before"), "chars", "r3", "r4").mapInPandas(composed, _MEMBER)
    shared = plans.select("conv_id", length, F.explode("head").alias("t")).select(
        "conv_id", "length", "t.pos", "t.p1", "t.p2", "t.r1", "t.r2", "t.before", "t.chars", "t.r3", "t.r4").mapInPandas(of_head, _MEMBER)
    zero = [F.lit(0).cast("long").alias(c) for c in _MEMBER.names if c not in ("conv_id", "length")]
    roots = plans.select("conv_id", *zero, length).select(*_MEMBER.names)
    return rest.unionByName(shared).unionByName(roots)


_NODE = ["depth", "f1", "f2"]


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256): SHA-256 over the ascending, comma-joined
    ids of the conversations that end in a node.

    Ids are first joined in blocks of close ids, at most ``ID_BLOCK`` each; a
    node's blocks then stream through one hash in order.  SHA-256 reads its
    input in sequence, so a node's digest is one task's work, a block a row.
    """
    blocks = ends.groupBy(*_NODE, F.floor(F.col("conv_id") / ID_BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for b in batches:
            out = []
            for d, f1, f2, ids in zip(*(b[c].tolist() for c in (*_NODE, "ids"))):
                if (d, f1, f2) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (d, f1, f2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*_NODE, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*_NODE, "ends_sha256"])

    return blocks.repartition(shuffle_partitions(ends.sparkSession), *_NODE).sortWithinPartitions(*_NODE, "block").select(
        *_NODE, "ids").mapInPandas(digest, "depth long, f1 long, f2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, prime: int = PRIME, attempts: int = ATTEMPTS) -> DataFrame:
    """The trie's nodes, one row each:

    conv_id, depth    the smallest member and the number of turns: the node's key,
                      and where its text stands (the member's first turns)
    parent_conv_id    the parent's smallest member (its depth is one less; root: null)
    n_convs           members, the rebuilt conversations that start with the node
    n_children, n_leaves, saved_tokens, ends_sha256   as the contract of the query has them

    Raises RuntimeError if ``attempts`` bases in a row made two different
    sequences collide.
    """
    refs = staged(turn_references(conversations))
    for attempt in range(attempts):
        base = base_of(attempt, prime)
        rows = staged(members(prefix_products(refs, base, prime), base, prime))
        nodes = staged(rows.groupBy(*_NODE).agg(
            F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("deepest"),
            F.min("before").alias("before"), *[F.min(c).alias(c) for c in ("q1", "q2")],
            *[f(c).alias(f"{a}{c}") for c in ("r3", "r4") for f, a in ((F.min, "lo_"), (F.max, "hi_"))]))
        if nodes.where("lo_r3 <> hi_r3 OR lo_r4 <> hi_r4").isEmpty():
            return _summed(rows, nodes)
    raise RuntimeError(f"different conversations had equal fingerprints with {attempts} bases")


def _summed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    # each conversation's owned nodes are the end of its path: the first one, and whether the last is a leaf
    owned = nodes.groupBy("owner").agg(
        F.min(F.struct("depth", "before")).alias("first"),
        F.max(F.struct("depth", (F.col("deepest") == F.col("depth")).cast("long").alias("leaf"))).alias("last")).select(
        F.col("owner").alias("conv_id"), F.col("first.depth").alias("since"), F.col("first.before").alias("upto"), "last.leaf")
    end = rows.where("depth = length").select("conv_id", (F.col("before") + F.col("chars")).alias("total"))
    per_conv = staged(end.join(owned, "conv_id", "left").select(
        "conv_id", "since", F.coalesce("upto", "total").alias("upto"), F.coalesce("leaf", F.lit(0)).alias("leaf")))
    sums = rows.select("conv_id", *_NODE, "before").join(per_conv, "conv_id").groupBy(*_NODE).agg(
        F.sum(F.greatest(F.col("upto") - F.col("before"), F.lit(0))).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"),
        F.count_if(F.col("since") == F.col("depth") + 1).alias("joined"))
    # a node's parent has the same owner unless the node is the first that its owner owns
    key = [F.col(c).alias(f"n_{c}") for c in _NODE]
    first = nodes.join(owned.select(F.col("conv_id").alias("owner"), F.col("since").alias("depth")), ["owner", "depth"], "left_semi").where("depth > 0")
    parents = first.select(F.col("depth").alias("c_depth"), F.col("owner").alias("c_owner"), (F.col("depth") - 1).alias("n_depth"),
                           F.col("q1").alias("n_f1"), F.col("q2").alias("n_f2")).join(
        nodes.select(*key, F.col("owner").alias("parent")), [f"n_{c}" for c in _NODE]).select(
        F.col("c_owner").alias("owner"), F.col("c_depth").alias("depth"), "parent")
    reach = rows.where("depth = length").select(F.col("conv_id").alias("owner"), F.col("length").alias("path"))
    ends = ends_digest(rows.where("depth = length").select(*_NODE, "conv_id"))
    out = nodes.select(*_NODE, "owner", "n_convs").join(sums, _NODE).join(ends, _NODE, "left").join(reach, "owner").join(
        parents, ["owner", "depth"], "left")
    # the owner's path goes on into one child; every other child has a first owner of its own
    return out.select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"), "n_convs",
        (F.col("joined") + (F.col("path") > F.col("depth")).cast("long")).alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
