"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Equal vectors share a node, so a vector with very many copies is one point of a graph. Nodes are dealt to
shards of bounded size by a hash. In each shard a graph is built by batches: a greedy beam search over the graph so far
proposes neighbours, relaxed distance pruning keeps diverse edges, and edges are mirrored. A query walks
every shard's graph by beam search; the nodes it meets are scored exactly and the best of all shards merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.storage import store

SHARD_NODES = 4096
QUERY_BLOCK = 1024
DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 128, 1.2


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def beam_search(unit: np.ndarray, graph: np.ndarray, queries: np.ndarray, start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, distances) of the beam of every query, nearest first; -1 where a beam isn't full.

    All queries walk at once: each round opens the nearest unopened node of each beam.
    """
    many, n = len(queries), len(unit)
    nodes = np.full((many, beam), -1, np.int32)
    dist = np.full((many, beam), np.inf, np.float32)
    opened = np.zeros((many, beam), bool)
    met = np.zeros((many, n), bool)
    nodes[:, 0], dist[:, 0] = start, 1 - queries @ unit[start]
    met[:, start] = True
    live = np.arange(many)
    while len(live):
        waiting = np.where(opened[live] | (nodes[live] < 0), np.inf, dist[live])
        pick = waiting.argmin(axis=1)
        go = np.isfinite(waiting[np.arange(len(live)), pick])
        live, pick = live[go], pick[go]
        if not len(live):
            break
        opened[live, pick] = True
        near = graph[nodes[live, pick]]
        fresh = (near >= 0) & ~met[live[:, None], np.maximum(near, 0)]
        # Repeats within one list of edges don't occur, so each fresh node is met once.
        who, slot = np.nonzero(fresh)
        target = near[who, slot]
        met[live[who], target] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[who, slot] = 1 - np.einsum("ij,ij->i", queries[live[who]], unit[target])
        all_nodes = np.concatenate([nodes[live], np.where(fresh, near, -1)], axis=1)
        all_dist = np.concatenate([dist[live], d], axis=1)
        all_open = np.concatenate([opened[live], np.zeros(near.shape, bool)], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        nodes[live] = np.take_along_axis(all_nodes, order, 1)
        dist[live] = np.take_along_axis(all_dist, order, 1)
        opened[live] = np.take_along_axis(all_open, order, 1)
    return nodes, dist


def robust_prune(unit: np.ndarray, own: np.ndarray, nodes: np.ndarray, dist: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Edges of the points ``own`` among candidate ``nodes`` sorted by distance.

    The nearest candidate is kept; candidates that are closer to a kept one than to the point, by the factor
    ``relax``, fall away; and so on.
    """
    many = len(own)
    alive = (nodes >= 0) & (nodes != own[:, None])
    edges = np.full((many, degree), -1, np.int32)
    vectors = unit[np.maximum(nodes, 0)]
    for k in range(degree):
        any_left = alive.any(axis=1)
        if not any_left.any():
            break
        pick = alive.argmax(axis=1)
        chosen = nodes[np.arange(many), pick]
        edges[any_left, k] = chosen[any_left]
        between = 1 - np.einsum("ijk,ik->ij", vectors, unit[np.maximum(chosen, 0)])
        alive &= ~(any_left[:, None] & (relax * between <= dist))
        alive[np.arange(many), pick] = False
    return edges


def build_graph(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """(edges, entry node) of the nodes ``unit``; two passes, in batches that grow with the graph."""
    n = len(unit)
    entry = int((unit @ unit.mean(axis=0)).argmax())
    graph = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(7).permutation(n).astype(np.int32)
    order = np.concatenate([[entry], order[order != entry]]).astype(np.int32)
    for factor in (1.0, relax):
        low = 1 if factor == 1.0 else 0
        while low < n:
            high = min(n, low + max(8, min(low, 512) if factor == 1.0 else 512))
            own = order[low:high]
            nodes, dist = beam_search(unit, graph, unit[own], entry, beam)
            had = graph[own]
            extra = np.where(had >= 0, 1 - np.einsum("ijk,ik->ij", unit[np.maximum(had, 0)], unit[own]), np.inf)
            graph[own] = _pruned(unit, own, np.concatenate([nodes, had], 1), np.concatenate([dist, extra], 1), degree, factor)
            # Mirror the new edges; a node with too many edges is pruned again.
            source, target = np.repeat(own, degree), graph[own].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            touched, first, count = np.unique(target, return_index=True, return_counts=True)
            most = int(count.max()) if len(count) else 0
            if most:
                incoming = np.full((len(touched), most), -1, np.int32)
                incoming[np.repeat(np.arange(len(touched)), count), np.arange(len(target)) - np.repeat(first, count)] = source
                pool = np.concatenate([graph[touched], incoming], axis=1)
                d = np.where(pool >= 0, 1 - np.einsum("ijk,ik->ij", unit[np.maximum(pool, 0)], unit[touched]), np.inf)
                graph[touched] = _pruned(unit, touched, pool, d, degree, factor)
            low = high
    return graph, entry


def _pruned(unit: np.ndarray, own: np.ndarray, nodes: np.ndarray, dist: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Sort candidates, drop repeats, prune."""
    by_node = np.argsort(nodes, axis=1, kind="stable")
    sorted_nodes = np.take_along_axis(nodes, by_node, 1)
    repeat = np.zeros(nodes.shape, bool)
    repeat[:, 1:] = sorted_nodes[:, 1:] == sorted_nodes[:, :-1]
    drop = np.zeros(nodes.shape, bool)
    np.put_along_axis(drop, by_node, repeat, 1)
    dist = np.where(drop | (nodes < 0), np.inf, dist).astype(np.float32)
    nodes = np.where(drop, -1, nodes)
    order = np.argsort(dist, axis=1, kind="stable")
    return robust_prune(unit, own, np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1), degree, relax)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(``id``, ``v``) of the rows whose vector is whole, finite and not zero."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).alias("v"), bad.alias("_bad"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.col("_bad") & F.exists("v", lambda x: x != 0)).select("id", "v")


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found of the rows whose id is divisible by ``every``.

    Nearness is the cosine in double precision, ties go to the smaller id, a query's own row is no candidate.
    Null, zero and non-finite vectors (and null ids) take no part; vectors are compared with others of their
    length only; equal vectors count one by one; rows of one id and vector count once; an empty table gives no rows.
    """
    rows = store(usable(vectors, key, vector).distinct(), "vectors")
    # A query needs k candidates of a node besides itself, and of equal scores the smallest ids.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    nodes = store(
        rows.withColumn("_r", rank).where(F.col("_r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("v")),
        "nodes",
    )
    shards = max(1, -(-nodes.count() // SHARD_NODES))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    queries = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["v"].to_numpy())
        graph, entry = build_graph(_unit(x))
        return pd.DataFrame({"dim": [x.shape[1]], "shard": [pdf["shard"].iloc[0]], "entry": [entry], "vectors": [x.tobytes()], "edges": [graph.tobytes()],
                             "ids": [np.concatenate(pdf["ids"].to_numpy()).astype(np.int64).tobytes()], "held": [pdf["ids"].map(len).to_numpy(np.int32).tobytes()]})

    schema = "dim int, shard int, entry int, vectors binary, edges binary, ids binary, held binary"
    built = store(nodes.groupBy("dim", "shard").applyInPandas(index, schema), "graphs")

    def search(name: tuple, graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(graph) or not len(asked):
            return out
        g = graph.iloc[0]
        x = np.frombuffer(g["vectors"], np.float64).reshape(-1, g["dim"])
        unit, edges = _unit(x), np.frombuffer(g["edges"], np.int32).reshape(len(x), -1)
        held, ids = np.frombuffer(g["held"], np.int32), np.frombuffer(g["ids"], np.int64)
        first = np.cumsum(held) - held
        q, own = np.stack(asked["v"].to_numpy()), asked["id"].to_numpy(np.int64)
        beam = min(len(x), SEARCH_BEAM)
        found, _ = beam_search(unit, edges, _unit(q), int(g["entry"]), beam)
        found = found[:, : 4 * (k + 1)]
        norm = np.sqrt((x * x).sum(axis=1))
        who, slot = np.nonzero(found >= 0)
        node = found[who, slot]
        score = (q[who] * x[node]).sum(axis=1) / (np.sqrt((q[who] * q[who]).sum(axis=1)) * norm[node])
        each = np.repeat(np.arange(len(who)), held[node])
        nth = np.arange(len(each)) - np.repeat(np.cumsum(held[node]) - held[node], held[node])
        vec = ids[first[node[each]] + nth]
        keep = vec != own[who[each]]
        who, vec, score = who[each][keep], vec[keep], score[each][keep]
        order = np.lexsort((vec, -score, who))
        who, vec, score = who[order], vec[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who, "left")
        keep = place < k
        return pd.DataFrame({"query_id": own[who[keep]], "vec_id": vec[keep], "score": score[keep]})

    spread = built.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = spread.groupBy("dim", "shard", "block").cogroup(queries.groupBy("dim", "shard", "block")).applyInPandas(search, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", best.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
