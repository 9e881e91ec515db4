"""Embedding near-dedup over a robust-pruned flat graph.

Vectors are dealt to the shards of their nearest centroids, each to more than one, so that
close vectors meet in a shard. A shard builds a flat graph by robust pruning; the adjacency
lists that a vector has got in its shards are united. Every vector then searches its shards
greedily from the medoid and expands from what it finds within range; pairs are verified by
exact cosine. A shard too large for one task, where many vectors lie close together, is cut
into blocks, and every two of them meet. An audit compares a fixed sample of vectors with
brute force and, if recall falls short, the work is done again with more overlap.

Centroids are fitted on a bounded sample; every row is indexed and searched. Equal vectors
collapse to one class first, and a shard returns counts and a spanning forest of its links,
so output grows with the vectors and not with their pairs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import batches, spread_join, table
from gleaner.llm.components import connected_components
from gleaner.runtime import ship

THRESHOLD = 0.98
#: Most vectors the centroids are fitted on, and most centroids; both bound what is broadcast.
SAMPLE, CENTROIDS = 50_000, 8192
SHARD = 1500
#: Most vectors, about, that one task builds a graph of; two such blocks meet in a search.
BLOCK = 2 * SHARD
OVERLAP = 2
DEGREE, CANDIDATES, LONG, CLOSE, ALPHA = 24, 40, 8, 6, 1.2
BEAM, SLACK, ENTRIES = 24, 0.03, 8
AUDITED, RECALL = 200, 0.99


def usable(embedding) -> F.Column:
    """Not null, not empty, all components finite, not all zero."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(rows: list, shard: int, most: int, total: int) -> dict[tuple, np.ndarray]:
    """Spherical k-means per (label, dimensions) over sampled rows."""
    groups: dict[tuple, list] = {}
    for r in rows:
        groups.setdefault((r.label, len(r.embedding)), []).append(r.embedding)
    scale = total / max(len(rows), 1)
    out = {}
    for key, vectors in groups.items():
        x = unit(np.array(vectors, np.float64))
        k = int(min(np.ceil(len(x) * scale / shard), most * len(x) / len(rows), len(x)))
        k = max(k, 1)
        c = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(6 if k > 1 else 0):
            own = np.concatenate([(x[i : i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            c = np.where(norm > 0, sums / np.maximum(norm, 1e-12), c)
        out[key] = c
    return out


def robust_prune(x: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to): near vectors and a few far ones, none shadowed by a closer one.

    Edges are also laid back, as far as a vector has room, so that no vector is unreachable.
    """
    n = len(x)
    random = np.random.RandomState(n)
    near = min(CANDIDATES, n - 1)
    if near < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads, tails, nearest_of = [], [], []
    for a in range(0, n, 512):
        b = min(a + 512, n)
        sims = x[a:b] @ x.T
        sims[np.arange(b - a), np.arange(a, b)] = -2
        cand = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        if n > near + LONG:
            cand = np.hstack([cand, random.randint(0, n, (b - a, LONG))])
        held = np.take_along_axis(sims, cand, axis=1)
        order = np.argsort(-held, axis=1, kind="stable")
        cand, held = np.take_along_axis(cand, order, axis=1), np.take_along_axis(held, order, axis=1)
        nearest_of.append(cand[:, :CLOSE])
        own = x[cand]
        apart = np.sqrt(np.maximum(2 - 2 * np.matmul(own, own.transpose(0, 2, 1)), 0))
        to_q = np.sqrt(np.maximum(2 - 2 * held, 0))
        alive = held > -1.5
        kept = np.zeros_like(alive)
        room = np.full(b - a, degree)
        for j in range(cand.shape[1]):
            kept[:, j] = alive[:, j] & (room > 0)
            room -= kept[:, j]
            alive &= ~(kept[:, j, None] & (ALPHA * apart[:, j, :] <= to_q))
        at, which = np.nonzero(kept)
        heads.append(at + a)
        tails.append(cand[at, which])
    head, tail = np.concatenate(heads), np.concatenate(tails)  # by vector, nearest first
    close = np.concatenate(nearest_of)
    # First the way back from everyone's nearest, then forward edges, then other ways back.
    nearest = np.append(True, head[1:] != head[:-1])
    rank = np.concatenate([np.ones(len(head), np.int64), np.where(nearest, 0, 2)])
    head, tail = np.concatenate([head, tail]), np.concatenate([tail, head])
    order = np.lexsort((tail, rank, head))
    head, tail = head[order], tail[order]
    first = np.searchsorted(head, np.arange(n))
    fits = np.arange(len(head)) - first[head] < 2 * degree
    head, tail = head[fits], tail[fits]
    # A vector that none of its closest had room to lead to is led to by that of them with the fewest edges.
    out = np.bincount(head, minlength=n)
    led = np.isin(close * n + np.arange(n)[:, None], head * n + tail).any(axis=1)
    more = []
    for v in np.flatnonzero(~led).tolist():
        near = close[v]
        via = int(near[out[near].argmin()])
        out[via] += 1
        more.append((via, v))
    if more:
        extra = np.array(more)
        head, tail = np.append(head, extra[:, 0]), np.append(tail, extra[:, 1])
        order = np.argsort(head, kind="stable")
        head, tail = head[order], tail[order]
    return head, tail


def pair_cosine(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows a of x with the rows b of y."""
    out = np.empty(len(a))
    for i in range(0, len(a), 50_000):
        out[i : i + 50_000] = np.einsum("kd,kd->k", x[a[i : i + 50_000]], y[b[i : i + 50_000]])
    return out


def range_search(x: np.ndarray, graph: np.ndarray, asked: np.ndarray, own: np.ndarray | None, threshold: float) -> np.ndarray:
    """(asked, x) booleans: vectors found at cosine ``threshold`` or above, by graph search.

    ``graph`` is padded with the vector's own index. A greedy descent keeps a beam from the
    medoid, a few entries spread over the shard and the place of the vector asked for, if it
    is one of x; then everything within ``SLACK`` of range is expanded until nothing new comes
    up. Cosines are taken of those vectors only that the search comes to.
    """
    n, q = len(x), len(asked)
    sims, seen, expanded = np.full((q, n), -3.0), np.zeros((q, n), bool), np.zeros((q, n), bool)
    degree = graph.shape[1]

    def look(at_q: np.ndarray, at_v: np.ndarray) -> None:
        new = np.unique((at_q * n + at_v)[~seen[at_q, at_v]])
        at_q, at_v = new // n, new % n
        seen[at_q, at_v] = True
        sims[at_q, at_v] = pair_cosine(asked, x, at_q, at_v)

    every = np.arange(q)
    entries = np.unique(np.append(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64), int((x @ x.mean(axis=0)).argmax())))
    look(np.repeat(every, len(entries)), np.tile(entries, q))
    if own is not None:
        look(every, own)
    width = min(4, n)
    for _ in range(100):
        # The best BEAM seen; of these the best that are not yet expanded.
        beam = np.argpartition(-sims, min(BEAM, n) - 1, axis=1)[:, : min(BEAM, n)]
        worth = np.where(expanded[every[:, None], beam], -3.0, sims[every[:, None], beam])
        pick = np.argpartition(-worth, min(width, worth.shape[1]) - 1, axis=1)[:, :width]
        node, use = np.take_along_axis(beam, pick, axis=1), np.take_along_axis(worth, pick, axis=1) > -2
        if not use.any():
            break
        at_q, at_v = np.repeat(every, use.sum(axis=1)), node[use]
        expanded[at_q, at_v] = True
        look(np.repeat(at_q, degree), graph[at_v].ravel())
    while True:
        at_q, at_v = np.nonzero(~expanded & (sims >= threshold - SLACK))
        if not len(at_q):
            break
        expanded[at_q, at_v] = True
        look(np.repeat(at_q, degree), graph[at_v].ravel())
    return sims >= threshold - 1e-5


def exact_cosine(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    squares = np.sqrt((x * x).sum(axis=1))
    for i in range(0, len(a), 200_000):
        p, q = a[i : i + 200_000], b[i : i + 200_000]
        out[i : i + 200_000] = np.einsum("kd,kd->k", x[p], x[q]) / (squares[p] * squares[q])
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _build(group: pa.Table) -> pa.Table:
    x = unit(_matrix(group.column("embedding")))
    node = group.column("node").to_numpy()
    order = np.argsort(node, kind="stable")
    head, tail = robust_prune(x[order])
    node = node[order]
    at = np.searchsorted(head, np.arange(len(node) + 1)).astype(np.int32)
    return pa.table({"node": node, "near": pa.ListArray.from_arrays(at, node[tail])})


def _spanning(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges (root, member) of the components of a symmetric boolean matrix."""
    left = np.ones(len(hit), bool)
    roots, members = [], []
    for root in range(len(hit)):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(hit[front].any(axis=0) & left)
            left[front] = False
            roots += [root] * len(front)
            members += front.tolist()
    return roots, members


def _search(threshold: float):
    def graph_of(lists: list, node: np.ndarray) -> np.ndarray:
        """The united lists as far as they lead to ``node``, padded with the vector's own place."""
        own = []
        for near in lists:
            ids = np.array(near or [], np.int64)
            at = np.minimum(np.searchsorted(node, ids), len(node) - 1)
            own.append(at[node[at] == ids])
        graph = np.repeat(np.arange(len(node))[:, None], max(1, max(map(len, own))), axis=1)
        for i, v in enumerate(own):
            graph[i, : len(v)] = v
        return graph

    def found(x: np.ndarray, graph: np.ndarray, asked: np.ndarray, same: bool) -> np.ndarray:
        step = max(16, min(256, 4_000_000 // len(x)))
        return np.concatenate([
            range_search(x, graph, asked[a : a + step], np.arange(a, min(a + step, len(asked))) if same else None, threshold)
            for a in range(0, len(asked), step)
        ])

    def run(group: pa.Table) -> pa.Table:
        # Rows of one block, or of two blocks whose vectors are compared with each other.
        group = group.take(pa.array(np.lexsort((group.column("node").to_numpy(), group.column("block").to_numpy()))))
        node, block = group.column("node").to_numpy(), group.column("block").to_numpy()
        raw = _matrix(group.column("embedding"))
        x = unit(raw)
        copies, shards, lists = group.column("copies").to_numpy(), group.column("shards").to_pylist(), group.column("near").to_pylist()
        n, m = len(node), int((block == block[0]).sum())
        hit = np.zeros((n, n), bool)
        one = group.column("low")[0].as_py() == group.column("high")[0].as_py()
        if one:
            hit |= found(x, graph_of(lists, node), x, True)
        elif m < n:
            hit[m:, :m] = found(x[:m], graph_of(lists[:m], node[:m]), x[m:], False)
            hit[:m, m:] = found(x[m:], graph_of(lists[m:], node[m:]), x[:m], False)
        # A link is a link from either end: what one search has missed, the other has found.
        hit = np.triu(hit | hit.T, 1)
        a, b = np.nonzero(hit)
        sure = exact_cosine(raw, a, b) >= threshold
        hit[a[~sure], b[~sure]] = False
        a, b = a[sure], b[sure]
        # A pair that meets in several shards counts in the smallest of them.
        here = group.column("shard")[0].as_py()
        names = {s: i for i, s in enumerate(sorted({s for own in shards for s in own if s < here}))}
        member = np.zeros((n, len(names)), bool)
        for i, own in enumerate(shards):
            member[i, [names[s] for s in own if s in names]] = True
        links = np.zeros(n, np.int64)
        for i in range(0, len(a), 200_000):
            p, q = a[i : i + 200_000], b[i : i + 200_000]
            mine = ~(member[p] & member[q]).any(axis=1)
            np.add.at(links, p[mine], copies[q[mine]])
            np.add.at(links, q[mine], copies[p[mine]])
        roots, members = _spanning(hit | hit.T)
        return pa.table({
            "node": pa.array([*node.tolist(), *node[roots].tolist()], pa.int64()),
            "links": pa.array([*links.tolist(), *([0] * len(roots))], pa.int64()),
            "other": pa.array([*([None] * n), *node[members].tolist()], pa.int64()),
        })
    return run


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of ``rows(vec_id, embedding, label)``: vec_id, n_links, component_id, kept.

    Only vectors of equal non-null label and equal dimension are compared, by cosine in
    double precision. Null, empty and zero vectors and those with null or non-finite
    components link with nothing and are their own component. Repeated rows are vectors of
    their own. Rows with a null vec_id take part in links; their component is the smallest
    vec_id reachable, null if there is none, and they are kept only then. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    ship(spark)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    good = usable(F.col("embedding")) & F.col("label").isNotNull()
    keyed = rows.withColumn("h", F.when(good, F.xxhash64("label", "embedding"))).withColumn(
        "g", F.when(good, F.xxhash64(F.lit(5), F.reverse("embedding"), "label"))
    )
    classes = table(
        keyed.where(F.col("h").isNotNull()).groupBy("label", "h", "g")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("node", F.xxhash64("label", "h", "g"))
    )
    total = classes.count()
    centroids = fit_centroids(_drawn(classes, SAMPLE, total, 0), SHARD, CENTROIDS, total)
    expected: dict[int, int] | None = None
    while True:
        found = table(_links(classes, centroids, threshold, overlap))
        links = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("links").alias("links"))
        if expected is None:
            # Half of the audit is drawn from all vectors and half from those with a link, as few may have one.
            linked = table(classes.join(links.where("links > 0").select("node"), "node", "left_semi"))
            asked: dict[tuple, dict] = {}
            for r in (*_drawn(classes, AUDITED // 2, total, 1), *_drawn(linked, AUDITED // 2, linked.count(), 2)):
                asked.setdefault((r.label, len(r.embedding)), {})[r.node] = r.embedding
            expected = _brute_force(classes, {k: list(v.items()) for k, v in asked.items()}, threshold)
        if not sum(expected.values()):
            break
        # What was found is verified, so counts are the pairs found and recall is by pairs.
        got = {r.node: r.links for r in links.where(F.col("node").isin(list(expected))).collect()}
        recall = sum(min(got.get(k, 0), v) for k, v in expected.items()) / max(sum(expected.values()), 1)
        if recall >= RECALL:
            break
        if overlap >= max(map(len, centroids.values())):
            raise RuntimeError(f"link recall of {recall:.4f} with all shards overlapping")
        overlap *= 2
    edges = found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b"))
    parts = connected_components(edges)
    nodes = classes.select("label", "h", "g", "node", "rep", "copies").join(links, "node", "left").join(
        parts.withColumnRenamed("id", "node"), "node", "left"
    ).withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    mapped = nodes.join(least, "component").select("label", "h", "g", "copies", "links", "component_id")
    return keyed.drop("embedding").join(mapped, ["label", "h", "g"], "left").select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.col("component_id").isNull()).alias("kept"),
    )


class Drawn(NamedTuple):
    node: int
    label: int
    embedding: np.ndarray


def _drawn(classes: DataFrame, rows: int, total: int, seed: int) -> list[Drawn]:
    """``rows`` of the classes by a hash, or all if they are fewer.

    A range of the hash that holds little more than these by expectation is cut out where the rows lie, so
    neither a task nor the driver gets many more, however many classes there are.
    """
    h = F.xxhash64(F.lit(seed), "node")
    share = min(1.0, (1.2 * rows + 1000) / max(total, 1))
    least = F.lit(True) if share >= 1 else h < F.lit(int((share - 0.5) * 2.0**64))
    got = classes.where(least).orderBy(h, "node").limit(rows).select("node", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v")).toArrow()
    values, at = got.column("v").combine_chunks(), 0
    flat, out = values.flatten().to_numpy(zero_copy_only=False), []
    for node, label, size in zip(got.column("node").to_pylist(), got.column("label").to_pylist(), values.value_lengths().to_pylist()):
        out.append(Drawn(node, label, flat[at : at + size]))
        at += size
    return out


def _brute_force(classes: DataFrame, asked: dict, threshold: float) -> dict[int, int]:
    """Links of the audited nodes, each compared with every class of its label, block by block."""
    if not asked:
        return {}

    def run(frames):
        for frame in frames:
            labels, vectors = frame.column("label").to_pylist(), frame.column("embedding").to_pylist()
            node, copies = frame.column("node").to_numpy(), frame.column("copies").to_numpy()
            rows: dict[tuple, list] = {}
            for i, (label, v) in enumerate(zip(labels, vectors)):
                rows.setdefault((label, len(v)), []).append(i)
            out_node, out_links = [], []
            for key, at in rows.items():
                if key not in asked:
                    continue
                x = unit(np.array([vectors[i] for i in at], np.float64))
                names = np.array([a for a, _ in asked[key]])
                near = unit(np.array([v for _, v in asked[key]], np.float64)) @ x.T >= threshold
                near &= names[:, None] != node[at][None]
                out_node += names.tolist()
                out_links += (near * copies[at][None]).sum(axis=1).tolist()
            yield pa.RecordBatch.from_pydict({"node": pa.array(out_node, pa.int64()), "links": pa.array(out_links, pa.int64())})

    counted = batches(classes.select("node", "label", "copies", "embedding"), run, "node long, links long")
    return {r.node: r.links for r in counted.groupBy("node").agg(F.sum("links").alias("links")).collect()}


def _links(classes: DataFrame, centroids: dict, threshold: float, overlap: int) -> DataFrame:
    def deal(frames):
        for frame in frames:
            labels, vectors = frame.column("label").to_pylist(), frame.column("embedding")
            sizes = vectors.value_lengths().to_numpy()
            flat, at = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.append(0, np.cumsum(sizes))
            rows: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(labels, sizes.tolist())):
                rows.setdefault(key, []).append(i)
            out: list[list[int]] = [[0]] * len(labels)
            for key, own in rows.items():
                c = centroids.get(key)
                if c is None or len(c) == 1:
                    continue
                for i in range(0, len(own), 1024):
                    part = own[i : i + 1024]
                    x = unit(np.stack([flat[at[j] : at[j + 1]] for j in part]))
                    nearest = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :overlap]
                    for j, cells in zip(part, nearest.tolist()):
                        out[j] = cells
            yield frame.append_column("cells", pa.array(out, pa.list_(pa.int64())))

    dealt = batches(
        classes.select("node", "label", "copies", "embedding"), deal,
        "node long, label long, copies long, embedding array<float>, cells array<long>",
    )
    placed = table(
        dealt.withColumn("shards", F.transform("cells", lambda c: F.xxhash64("label", F.size("embedding"), c)))
        .withColumn("shard", F.explode("shards")).drop("cells", "label")
    )
    # A large shard is cut into blocks by hash, and every two of its blocks meet in a task of their own.
    blocks = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    blocked = table(spread_join(placed, blocks, ["shard"], F.col("node")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    lists = blocked.select("shard", "block", "node", "embedding").groupBy("shard", "block").applyInArrow(_build, "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    return (
        blocked.join(united, "node", "left").withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).drop("with", "blocks")
        .groupBy("shard", "low", "high").applyInArrow(_search(threshold), "node long, links long, other long")
    )


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` at cosine 0.98 within their label."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
