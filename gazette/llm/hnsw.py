"""Approximate nearest neighbours: one navigable small-world graph per shard.

Equal vectors collapse to one node that keeps the ids it stands for (only as
many of the smallest as an answer can use).  Distinct vectors are dealt by hash
to shards of about ``SHARD`` nodes; each shard's hierarchical graph is built by
itself and stored as one row of flat arrays.  Queries meet every shard in
blocks, each block searches the shard's graph from the top layer down, and the
shards' answers are merged and ranked by exact inner products in double
precision.

Inner products are searched as angles: each vector gets one more component that
brings all of a shard to the same length, which keeps the order of products.
Nodes are inserted in batches that grow with the graph; a batch is searched at
once by array operations and its members also see each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

NEAREST = 20
SHARD = 4096        # nodes of a shard, on average
BLOCK = 1024        # queries of a block, on average
LINKS = 16          # links of a node on upper layers; twice as many on the lowest
BUILD_WIDTH = 96    # candidates kept while inserting
WIDTH = 160         # candidates kept while searching
EXPAND = 4          # candidates opened per step
BATCH = 256


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int):
    """Best ``width`` nodes found for each query on one layer: ids (-1: none) and products."""
    rows = np.arange(len(q))[:, None]
    seen = np.zeros((len(q), len(x) + 1), bool)
    seen[:, -1] = True                      # -1 marks no node
    ids = np.full((len(q), width), -1)
    sims = np.full((len(q), width), -np.inf, x.dtype)
    opened = np.ones((len(q), width), bool)
    ids[:, 0], sims[:, 0], opened[:, 0] = entry, np.einsum("bd,bd->b", x[entry], q), False
    seen[rows[:, 0], entry] = True
    live = np.arange(len(q))
    while len(live):
        at = rows[:len(live)]
        score = np.where(opened[live], -np.inf, sims[live])
        step = min(EXPAND, width)
        pick = np.argpartition(-score, step - 1, axis=1)[:, :step] if width > step else np.broadcast_to(
            np.arange(width), (len(live), width))
        some = np.take_along_axis(score, pick, 1) > -np.inf
        go = some.any(axis=1)
        live, pick, some, at = live[go], pick[go], some[go], rows[:go.sum()]
        if not len(live):
            break
        base = np.where(some, ids[live[:, None], pick], -1)
        opened[live[:, None], pick] = True
        near = np.where(base[:, :, None] >= 0, links[base], -1).reshape(len(live), -1)
        near = np.where(seen[live[:, None], near], -1, near)
        near.sort(axis=1)                   # a node reached twice in one step counts once
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[live[:, None], near] = True
        new = np.where(near >= 0, np.einsum("bmd,bd->bm", x[near], q[live]), -np.inf)
        all_s = np.concatenate((sims[live], new), axis=1)
        best = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
        sims[live] = np.take_along_axis(all_s, best, 1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], near), axis=1), best, 1)
        fresh_ = np.concatenate((opened[live], near < 0), axis=1)
        opened[live] = np.take_along_axis(fresh_, best, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    return np.where(sims > -np.inf, ids, -1), sims


def diverse(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Links of each row out of candidates sorted by similarity (-1: none).

    A candidate nearer to a chosen one than to the row itself is passed over;
    free places go to the best of those.
    """
    rows, width = cand.shape
    v = x[np.maximum(cand, 0)]
    between = v @ v.transpose(0, 2, 1)
    hidden = cand < 0
    chosen = np.zeros(cand.shape, bool)
    for j in range(width):
        take = ~hidden[:, j] & (chosen.sum(axis=1) < most)
        chosen[:, j] = take
        hidden |= take[:, None] & (between[:, j] > sims)
    rank = np.where(chosen, 0, np.where(cand >= 0, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.take_along_axis(cand, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _sorted(x, own, cand):
    """Candidates of nodes ``own`` in order of similarity, each once, not itself."""
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == own[:, None]] = -1
    sims = np.where(cand >= 0, np.einsum("bmd,bd->bm", x[cand], x[own]), -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)


def _link(x, links, own, cand, most):
    """Link nodes ``own`` with their best candidates, both ways."""
    cand, sims = _sorted(x, own, cand)
    cand, sims = cand[:, :BUILD_WIDTH], sims[:, :BUILD_WIDTH]
    links[own] = diverse(x, cand, sims, most)
    a, b = np.repeat(own, most), links[own].ravel()
    a, b = a[b >= 0], b[b >= 0]
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    to, first, count = np.unique(b, return_index=True, return_counts=True)
    for s in range(0, len(to), BATCH):
        t, f, c = to[s:s + BATCH], first[s:s + BATCH], count[s:s + BATCH]
        more = np.full((len(t), c.max(initial=1)), -1)
        place = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        more[np.repeat(np.arange(len(t)), c), place] = a[np.repeat(f, c) + place]
        both, near = _sorted(x, t, np.concatenate((links[t], more), axis=1))
        links[t] = diverse(x, both, near, most)


def build(x: np.ndarray, seed: int) -> tuple[list[np.ndarray], int]:
    """Links per layer, lowest first (rows of -1 for absent nodes), and the entry node."""
    n = len(x)
    rng = np.random.Generator(np.random.PCG64(seed))
    level = np.floor(-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int)
    top = int(level.max(initial=0))
    layers = [np.full((n, LINKS * (1 if layer else 2)), -1) for layer in range(top + 1)]
    entry, high, done = 0, int(level[0]), 0
    while done < n:
        batch = np.arange(done, min(n, done + max(16, min(BATCH, done))))
        start = np.full(len(batch), entry)
        for layer in range(top, -1, -1):
            if done and layer <= high:
                wide = BUILD_WIDTH if layer == 0 or (level[batch] >= layer).any() else 4
                ids, _ = beam(x, layers[layer], x[batch], start, wide)
                start = np.where(ids[:, 0] >= 0, ids[:, 0], start)
            else:
                ids = np.full((len(batch), 1), -1)
            own = np.flatnonzero(level[batch] >= layer)
            if len(own):
                peers = np.broadcast_to(batch[own], (len(own), len(own)))
                _link(x, layers[layer], batch[own], np.concatenate((ids[own], peers), axis=1),
                      layers[layer].shape[1])
        best = int(batch[np.argmax(level[batch])])
        if level[best] > high:
            entry, high = best, int(level[best])
        done = int(batch[-1]) + 1
    return layers[:high + 1], entry


def search(x: np.ndarray, layers: list[np.ndarray], entry: int, q: np.ndarray, width: int):
    start = np.full(len(q), entry)
    for links in layers[:0:-1]:
        ids, _ = beam(x, links, q, start, 4)
        start = ids[:, 0]
    return beam(x, layers[0], q, start, width)[0]


def _levelled(v: np.ndarray) -> np.ndarray:
    """Vectors with one more component that brings all to one length of 1."""
    size = (v * v).sum(axis=1)
    most = size.max(initial=0.0) or 1.0
    return (np.concatenate((v, np.sqrt(np.maximum(most - size, 0))[:, None]), axis=1) / np.sqrt(most)).astype(np.float32)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    column = column.combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


INDEX = ("dim int, shard int, vectors binary, members array<array<long>>, entry int, "
         "layers array<struct<width:int,nodes:binary,links:binary>>")


def _build_shard(key, table):
    n = table.num_rows
    order = np.argsort(table["place"].to_numpy(), kind="stable")
    v = _matrix(table["v"], n)[order]
    layers, entry = build(_levelled(v), seed=int(key[1].as_py()) + 1)
    flat = []
    for links in layers:
        nodes = np.flatnonzero((links >= 0).any(axis=1)).astype(np.int32)
        flat.append({"width": links.shape[1], "nodes": nodes.tobytes(), "links": links[nodes].astype(np.int32).tobytes()})
    return pa.Table.from_pydict({
        "dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
        "vectors": pa.array([v.tobytes()], pa.binary()),
        "members": pa.array([table["members"].take(pa.array(order)).to_pylist()], pa.list_(pa.list_(pa.int64()))),
        "entry": pa.array([entry], pa.int32()),
        "layers": pa.array([flat], pa.list_(pa.struct([("width", pa.int32()), ("nodes", pa.binary()), ("links", pa.binary())])))})


def _search_block(nearest: int, width: int):
    def run(key, index, queries):
        out: list = [[], [], [], []]
        if index.num_rows and queries.num_rows:
            dim = key[0].as_py()
            v = np.frombuffer(index["vectors"][0].as_py(), np.float64).reshape(-1, dim)
            members, layers = index["members"][0].as_py(), []
            for part in index["layers"][0].as_py():
                links = np.full((len(v), part["width"]), -1)
                nodes = np.frombuffer(part["nodes"], np.int32)
                links[nodes] = np.frombuffer(part["links"], np.int32).reshape(-1, part["width"])
                layers.append(links)
            x, q = _levelled(v), _matrix(queries["v"], queries.num_rows)
            ids, tags = queries["query_id"].to_pylist(), queries["tag"].to_pylist()
            long = np.concatenate((q, np.zeros((len(q), 1))), axis=1).astype(np.float32)
            for s in range(0, len(q), BATCH):
                found = search(x, layers, index["entry"][0].as_py(), long[s:s + BATCH], width)
                exact = np.einsum("bmd,bd->bm", v[found], q[s:s + BATCH])
                for i, (nodes, scores) in enumerate(zip(found.tolist(), exact.tolist())):
                    mine = ids[s + i]
                    best = sorted((-sc, m) for node, sc in zip(nodes, scores) if node >= 0
                                  for m in members[node] if m != mine)[:nearest]
                    out[0] += [mine] * len(best)
                    out[1] += [tags[s + i]] * len(best)
                    out[2] += [m for _, m in best]
                    out[3] += [-sc for sc, _ in best]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                    names=["query_id", "tag", "vec_id", "score"])
    return run


def usable(embeddings: DataFrame) -> DataFrame:
    """Distinct ``(vec_id, v)``: vectors with finite components, not all zero."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
                      & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda c: c != 0)).distinct()


def graph_index(vectors: DataFrame, nearest: int = NEAREST, shard: int = SHARD) -> DataFrame:
    """One row per shard of distinct vectors: its graph as flat arrays (a written table)."""
    place = Window.partitionBy("v").orderBy("vec_id")
    few = vectors.withColumn("n", F.row_number().over(place)).where(F.col("n") <= nearest + 1)
    nodes = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    nodes = materialize(nodes.select(F.size("v").alias("dim"), "v", "members", F.xxhash64("v").alias("place")), "hnsw-nodes")
    count = max(1, -(-nodes.count() // shard))
    nodes = nodes.withColumn("shard", F.pmod("place", F.lit(count)).cast("int"))
    return materialize(nodes.groupBy("dim", "shard").applyInArrow(_build_shard, INDEX), "hnsw-index")


def nearest_neighbours(embeddings: DataFrame, every: int = 20, nearest: int = NEAREST, width: int = WIDTH,
                       shard: int = SHARD) -> DataFrame:
    """The ``nearest`` rows of largest inner product for each ``vec_id`` divisible by ``every``.

    Returns ``query_id, rank`` (from 1), ``vec_id, score``; ties go to the
    smaller ``vec_id``.  NULL ids, and vectors that are NULL, empty, all zero or
    hold NULL or non-finite components take no part; vectors of another
    dimension are no candidates.  A row repeated whole is one row; rows that
    share an id but not the vector are candidates each, and queries each.  With
    fewer candidates than ``nearest`` those found are returned.
    """
    vectors = materialize(usable(embeddings), "hnsw-vectors")
    index = graph_index(vectors, nearest, shard)
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("tag"), "v", F.size("v").alias("dim"))
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.withColumn("block", F.pmod("tag", F.lit(blocks)).cast("int"))
    last = index.agg(F.max("shard")).first()[0] or 0
    # the stated query set against all shards, in blocks
    dealt = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    stored = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = stored.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        _search_block(nearest, max(width, 2 * nearest)), "query_id long, tag long, vec_id long, score double")
    best = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
