"""Embedding near-dedup by NN-descent.

Only vectors of the same label are compared.  Equal vectors of a label are
one node with a weight.  Lists of at most ``LIST`` neighbours start from
random-hyperplane buckets; rounds of NN-descent then introduce, at every
node, its neighbours (forward and reverse) to each other, until hardly a
list changes.  A list keeps neighbours down to cos(2 * angle of the
threshold), as whoever is linked to a linked neighbour is at least that near.

A list full of links is saturated: there may be more.  The lists of a
component that holds one are enlarged to the whole component, and to all
nodes of the label that lie near enough to it (by the triangle inequality)
to be linked, compared in tiles; what leaves a tile is a count per node,
never its pairs.  Components that turn out to be linked become one.  At the end
the links of sampled nodes (``AUDIT`` of those with no, few and more links
found) are counted against all nodes of their labels; if any has lost one the
search is repeated with twice the tables, and in the end the labels are
compared whole, in tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import runs, shuffle_partitions, staged
from .graph import connected_components
from .vectors import matrix, sound, width

LIST = 24
LEAF = 256  # vectors a start bucket should hold on average
CHUNK = 1024  # a larger one is compared in pairs of chunks of about so many
TILE = 1024
PART = 4096  # nodes that are held against the balls of tiles at a time
MISS = 1e-3  # share of links at the threshold that the start buckets may miss
ROUNDS = 6
SETTLED = 1e-3
AUDIT = 256
FEW = 3
MORE = 8  # times the tables, at most


def _unit(column, dim: int) -> np.ndarray:
    x = matrix(column, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def tables_for(most: int, threshold: float) -> tuple[int, int]:
    """(bits, tables): buckets of about LEAF vectors, and so many tables that
    a pair at the threshold shares none with probability MISS."""
    bits = max(0, math.ceil(math.log2(max(1, most / LEAF))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if not bits else max(1, math.ceil(math.log(MISS) / math.log1p(-together)))


def _best(edges: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return edges.select("u", "v", "sim", "new", F.row_number().over(order).alias("n")).where(F.col("n") <= k).drop("n")


def _start(nodes: DataFrame, dim: int, most: int, threshold: float, floor: float, k: int, more: int, seed: int) -> DataFrame:
    """(u, v, sim, new): lists from random-hyperplane buckets."""
    bits, tables = tables_for(most, threshold)
    tables *= more
    planes = np.random.default_rng(seed).standard_normal((dim, tables * bits))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sign = (matrix(b.v, dim) @ planes > 0).reshape(len(b), tables, bits)
            code = (sign * (1 << np.arange(bits))).sum(2) if bits else np.zeros((len(b), tables), np.int64)
            for t in range(tables):
                yield pd.DataFrame({"label": b.label, "t": t, "code": code[:, t], "node": b.node, "v": b.v})

    cell = ["label", "t", "code"]
    placed = nodes.mapInPandas(place, f"label {nodes.schema['label'].dataType.simpleString()}, t int, code long, node long, v {nodes.schema['v'].dataType.simpleString()}")
    sizes = staged(placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")))

    def lists(g: pd.DataFrame) -> pd.DataFrame:
        x, node, chunk = _unit(g.v, dim), g.node.to_numpy(), g.chunk.to_numpy()
        lo, hi = np.flatnonzero(chunk == g.lo.iloc[0]), np.flatnonzero(chunk == g.hi.iloc[0])
        out = []
        for a, b in [(lo, hi), (hi, lo)] if g.lo.iloc[0] != g.hi.iloc[0] else [(lo, lo)]:
            for at in range(0, len(a), 1024):
                s = x[a[at: at + 1024]] @ x[b].T
                if a is b:
                    s[np.arange(len(s)), at + np.arange(len(s))] = -1
                for i in np.flatnonzero(s.max(1, initial=-1) >= floor):
                    c = np.flatnonzero(s[i] >= floor)
                    c = c[np.lexsort((node[b[c]], -s[i][c]))[:k]]
                    out.append(pd.DataFrame({"u": node[a[at + i]], "v": node[b[c]], "sim": s[i][c]}))
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": [], "sim": []}).astype({"u": "int64", "v": "int64"})

    dealt = placed.join(sizes, cell).withColumn("chunk", F.pmod(F.xxhash64("node", "t"), "chunks").cast("int")).select(
        *cell, "node", "v", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).withColumns(
        {"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")})
    found = dealt.groupBy(*cell, "lo", "hi").applyInPandas(lists, "u long, v long, sim double")
    return _best(found.where("u <> v").groupBy("u", "v").agg(F.max("sim").alias("sim")).withColumn("new", F.lit(True)), k)


def _introduce(graph: DataFrame, nodes: DataFrame, dim: int, threshold: float, floor: float, k: int) -> DataFrame:
    """(u, v, sim): what the neighbours of each node, introduced to each
    other, would put on their lists.  Saturated lists ask for nothing."""
    full = graph.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("low")).select(
        F.col("u").alias("node"), F.when(F.col("n") >= k, F.col("low")).otherwise(floor).alias("low"))
    both = _best(graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "new")).groupBy("u", "v").agg(
        F.max("sim").alias("sim"), F.max("new").alias("new")), 2 * k)
    per = Window.partitionBy("u")
    met = both.join(full.withColumnRenamed("node", "v"), "v", "left").withColumn("low", F.coalesce("low", F.lit(floor))).select(
        "u", "v", "new", "low", F.count(F.lit(1)).over(per).alias("n"), F.max("new").over(per).alias("any"), F.min("low").over(per).alias("least")).where(
        (F.col("n") > 1) & F.col("any") & (F.col("least") < threshold))
    rows = met.join(nodes.select(F.col("node").alias("v"), F.col("v").alias("x")), "v").select("u", "v", "new", "low", "x")

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, ["u"]):
            x, node, new = _unit(g.x, dim), g.v.to_numpy(), g.new.to_numpy()
            s = x @ x.T
            ask = (s >= floor) & (s > g.low.to_numpy()[:, None]) & (g.low.to_numpy()[:, None] < threshold) & (new[:, None] | new[None, :])
            np.fill_diagonal(ask, False)
            i, j = np.nonzero(ask)
            if len(i):
                yield pd.DataFrame({"u": node[i], "v": node[j], "sim": s[i, j]})

    dealt = rows.repartition(shuffle_partitions(nodes.sparkSession), "u").sortWithinPartitions("u", "v")
    return dealt.mapInPandas(pairs, "u long, v long, sim double").where("u <> v")


def descend(nodes: DataFrame, dim: int, most: int, threshold: float, k: int, more: int, seed: int) -> DataFrame:
    """(u, v, sim, new): the neighbour lists when they have settled."""
    floor = 2 * threshold * threshold - 1
    graph = staged(_start(nodes, dim, most, threshold, floor, k, more, seed))
    size = graph.count()
    for _ in range(ROUNDS if size else 0):
        asked = _introduce(graph, nodes, dim, threshold, floor, k).groupBy("u", "v").agg(F.max("sim").alias("sim"))
        fresh = asked.join(graph, ["u", "v"], "left_anti").select("u", "v", "sim", F.lit(True).alias("new"))
        graph = staged(_best(graph.withColumn("new", F.lit(False)).unionByName(fresh), k))
        if graph.where("new").count() <= SETTLED * size:
            break
    return graph


def _enlarged(members: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links): for (root, node, weight, v) rows, how many vectors of
    the component each node is linked to, itself left out."""
    tiles = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = members.join(tiles, "root").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    spread = own.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "root", "node", "weight", "v", "tile", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"))

    def count(g: pd.DataFrame) -> pd.DataFrame:
        left = (g.tile == g.lo).to_numpy()
        right = (g.tile == g.hi).to_numpy()
        x, node, weight = _unit(g.v, dim), g.node.to_numpy(), g.weight.to_numpy()
        out = []
        same = bool(g.lo.iloc[0] == g.hi.iloc[0])
        a, b = x[left], x[right]
        links, back = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        for at in range(0, len(a), 1024):
            near = a[at: at + 1024] @ b.T >= threshold
            near &= node[left][at: at + 1024, None] != node[right][None, :]
            links[at: at + 1024] = near @ weight[right]
            back += weight[left][at: at + 1024] @ near
        out.append(pd.DataFrame({"node": node[left], "links": links}))
        if not same:
            out.append(pd.DataFrame({"node": node[right], "links": back}))
        return pd.concat(out)

    return spread.groupBy("root", "lo", "hi").applyInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def _beyond(grown: DataFrame, nodes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links, root): links between ``grown`` components (root, node) and
    nodes outside them, counted at both ends; ``root`` is linked to ``node``.

    A tile of a component lies in a ball around its mean direction; only nodes
    within the threshold's angle of that ball are compared with the tile.
    """
    spark, reach = nodes.sparkSession, math.acos(threshold) + 1e-6
    tiles = grown.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = staged(grown.join(tiles, "root").join(nodes, "node").select(
        "label", "root", F.pmod(F.xxhash64("node"), "tiles").cast("int").alias("tile"), "node", "weight", "v"))
    label = own.schema["label"].dataType.simpleString()

    def ball(g: pd.DataFrame) -> pd.DataFrame:
        x = _unit(g.v, dim)
        centre = x.mean(0)
        size = np.linalg.norm(centre)
        radius = float(np.arccos(np.clip(x @ centre / size, -1, 1)).max()) if size > 1e-9 else math.pi
        return pd.DataFrame({"label": g.label.iloc[:1].to_numpy(), "root": g.root.iloc[:1].to_numpy(), "tile": g.tile.iloc[:1].to_numpy(),
                             "centre": [centre / max(size, 1e-9)], "radius": [radius]})

    balls = staged(own.groupBy("label", "root", "tile").applyInPandas(ball, f"label {label}, root long, tile int, centre array<double>, radius double"))
    if balls.isEmpty():
        return spark.createDataFrame([], "node long, links long, root long")
    parts = nodes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    bins = balls.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("bins"))
    outside = nodes.join(parts, "label").join(bins, "label").join(grown.select("node", "root"), "node", "left").select(
        "label", F.pmod(F.xxhash64("node"), "parts").alias("part"), F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"),
        "node", "v", F.coalesce("root", "node").alias("own"), F.col("root").isNull().alias("free"))
    cast = balls.join(bins, "label").join(parts, "label").select(
        "label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"),
        F.pmod(F.xxhash64("root", "tile"), "bins").cast("int").alias("bin"), "root", "tile", "centre", "radius")

    def near(n: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(n) or not len(b):
            return pd.DataFrame({"label": n.label[:0], "root": [], "tile": [], "node": []}).astype({"root": "int64", "tile": "int64", "node": "int64"})
        x, c, root, radius = _unit(n.v, dim), np.stack(b.centre.to_numpy()), b.root.to_numpy(), b.radius.to_numpy()
        out = []
        for at in range(0, len(x), 1024):
            close = np.arccos(np.clip(x[at: at + 1024] @ c.T, -1, 1)) <= radius + reach
            # links between two grown components are counted once, from the smaller root
            close &= n.free.to_numpy()[at: at + 1024, None] | (n.own.to_numpy()[at: at + 1024, None] > root)
            i, j = np.nonzero(close)
            out.append(pd.DataFrame({"label": n.label.to_numpy()[at + i], "root": root[j], "tile": b.tile.to_numpy()[j], "node": n.node.to_numpy()[at + i]}))
        return pd.concat(out)

    cell = ["label", "part", "bin"]
    met = staged(outside.groupBy(*cell).cogroup(cast.groupBy(*cell)).applyInPandas(near, f"label {label}, root long, tile int, node long").distinct())
    cell = ["label", "root", "tile"]
    pieces = met.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("pieces"))
    left = own.join(pieces, cell).select(
        *cell, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "node", "weight", "v", F.lit(True).alias("inside"))
    right = met.join(pieces, cell).join(nodes, ["label", "node"]).select(
        *cell, F.pmod(F.xxhash64("node"), "pieces").cast("int").alias("piece"), "node", "weight", "v", F.lit(False).alias("inside"))

    def count(g: pd.DataFrame) -> pd.DataFrame:
        inside = g.inside.to_numpy()
        x, weight = _unit(g.v, dim), g.weight.to_numpy()
        links = np.zeros(len(g), np.int64)
        a, b = np.flatnonzero(inside), np.flatnonzero(~inside)
        for at in range(0, len(a), 1024):
            linked = x[a[at: at + 1024]] @ x[b].T >= threshold
            links[a[at: at + 1024]] = linked @ weight[b]
            links[b] += weight[a[at: at + 1024]] @ linked
        return pd.DataFrame({"node": g.node, "links": links, "root": g.root})[links > 0]

    return staged(left.unionByName(right).groupBy(*cell, "piece").applyInPandas(count, "node long, links long, root long"))


def _merged(nodes: DataFrame, comps: DataFrame, beyond: DataFrame) -> DataFrame:
    """(node, root) of all nodes: the components, joined where ``beyond`` links them."""
    parts = nodes.select("node").distinct().join(comps, "node", "left").select("node", F.coalesce("root", "node").alias("part"))
    bridges = beyond.join(parts, "node").select(F.col("part").alias("a"), F.col("root").alias("b")).distinct()
    tops = connected_components(bridges).select(F.col("node").alias("part"), F.col("root").alias("top"))
    return parts.join(tops, "part", "left").select("node", F.coalesce("top", "part").alias("root"))


def _whole(nodes: DataFrame, comps: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links, root): as ``_beyond``, but all links of all nodes, from
    whole labels compared in tiles; of the links between two components a
    pair of tiles reports one."""
    tiles = nodes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = nodes.join(tiles, "label").join(comps, "node", "left").withColumn("tile", F.pmod(F.xxhash64("node", "v"), "tiles").cast("int"))
    spread = own.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "label", "node", "weight", "v", "tile", F.coalesce("root", "node").alias("part"), F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"))

    def count(g: pd.DataFrame) -> pd.DataFrame:
        tile, same = g.tile.to_numpy(), bool(g.lo.iloc[0] == g.hi.iloc[0])
        a, b = np.flatnonzero(tile == g.lo.iloc[0]), np.flatnonzero(tile == g.hi.iloc[0])
        x, node, weight, part = _unit(g.v, dim), g.node.to_numpy(), g.weight.to_numpy(), g.part.to_numpy()
        links, bridges = np.zeros(len(g), np.int64), set()
        for at in range(0, len(a), 1024):
            s = a[at: at + 1024]
            near = (x[s] @ x[b].T >= threshold) & (node[s][:, None] != node[b][None, :])
            links[s] += near @ weight[b]
            if not same:
                links[b] += weight[s] @ near
            i, j = np.nonzero(near & (part[s][:, None] != part[b][None, :]))
            bridges.update(zip(part[s[i]].tolist(), part[b[j]].tolist()))
        ends = list(bridges)
        return pd.concat([pd.DataFrame({"node": node, "links": links, "root": part}),
                          pd.DataFrame({"node": [p for p, _ in ends], "links": 0, "root": [q for _, q in ends]}).astype("int64")])

    return staged(spread.groupBy("label", "lo", "hi").applyInPandas(count, "node long, links long, root long"))


def _lost(nodes: DataFrame, found: DataFrame, dim: int, threshold: float, seed: int) -> int:
    """How many of the sampled nodes have more links than ``found`` (node, links).

    Nodes with none, few (up to ``FEW``) and more are sampled apart, so that
    large groups do not hide what pairs and triples lose."""
    known = staged(nodes.select("node", "label", "v").join(found, "node", "left").withColumn("links", F.coalesce("links", F.lit(0))))
    sample = pd.concat([known.where(kind).orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(AUDIT).toPandas()
                        for kind in ("links = 0", f"links between 1 and {FEW}", f"links > {FEW}")], ignore_index=True)
    q, label, own, has = _unit(sample.v, dim), sample.label.to_numpy(), sample.node.to_numpy(), sample.links.to_numpy()

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(q), np.int64)
        for b in batches:
            near = (q @ _unit(b.v, dim).T >= threshold) & (label[:, None] == b.label.to_numpy()[None, :]) & (own[:, None] != b.node.to_numpy()[None, :])
            total += near @ b.weight.to_numpy()
        yield pd.DataFrame({"at": np.arange(len(q)), "truth": total})

    truth = nodes.mapInPandas(block, "at long, truth long").groupBy("at").agg(F.sum("truth").alias("truth")).toPandas()
    return int((truth.truth.to_numpy() > has[truth["at"].to_numpy()]).sum())


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, k: int = LIST, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id) per row of ``vectors`` (vec_id, label,
    embedding).

    Rows with a null label, or a vector that is null, zero, not finite or of
    another length than most, link with nothing and are their own component.
    A row without vec_id links with nothing and has no component.  Equal
    vectors of a label are linked.  Rows that repeat a vec_id are one node of
    the components, and each row counts as a vector of its own.
    """
    v = vectors["embedding"]
    kind = "array<float>" if "float" in vectors.schema["embedding"].dataType.simpleString() else "array<double>"
    rows = staged(vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].alias("label"), v.cast(kind).alias("v")))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound(F.col("v"))
    dim = width(rows.where(fit))
    fit = fit & (F.size("v") == dim)
    nodes = staged(rows.where(fit).groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")))
    most = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    more = 1
    while True:
        graph = descend(nodes, dim, most, threshold, k, more, seed)
        linked = graph.where(F.col("sim") >= threshold)
        pairs = staged(linked.select("u", "v").unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
        comps = staged(connected_components(pairs, "u", "v"))
        saturated = linked.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select(F.col("u").alias("node"))
        grown = comps.join(comps.join(saturated, "node", "left_semi").select("root").distinct(), "root", "left_semi")
        enlarged = _enlarged(grown.join(nodes, "node").select("root", "node", "weight", "v"), dim, threshold)
        listed = pairs.join(grown.select(F.col("node").alias("u")), "u", "left_anti").join(
            nodes.select(F.col("node").alias("v"), "weight"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("weight").alias("links"))
        beyond = _beyond(grown, nodes, dim, threshold)
        found = staged(enlarged.unionByName(listed).unionByName(beyond.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links")))
        if not most or not _lost(nodes, found, dim, threshold, seed):
            break
        if more >= MORE:
            beyond = _whole(nodes, comps, dim, threshold)
            found = staged(beyond.groupBy("node").agg(F.sum("links").alias("links")))
            break
        more *= 2
    table = staged(nodes.join(_merged(nodes, comps, beyond), "node", "left").join(found, "node", "left").select(
        "label", "v", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component_id")))
    member = rows.where(fit).join(table, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return member.unionByName(rest)

