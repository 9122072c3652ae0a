"""Approximate nearest neighbours: a robust-pruned directed graph for each shard, searched by beam.

Equal vectors are one node, which carries its smallest ids: as many as a result
can name, and one more for the query itself; the rest can be in no result. Nodes
are dealt to shards of bounded size by a hash. A task builds its shard's graph:
nodes come in batches, a greedy search of the graph so far proposes their
neighbours, and relaxed pruning keeps an edge only if no kept, nearer neighbour
is closer to its end by the factor ALPHA; edges back are pruned alike. Graphs
are stored as rows. Queries come in blocks that stream past a shard's graph and
search it by beam, distances of what it finds are computed exactly in double precision, and
the best of all shards are ranked.

Edge cases
* null, empty or zero vectors, and null or non-finite components: neither searched nor found;
* null ids: neither searched nor found; rows with equal id and vector count once;
* vectors are only compared with those of equal length;
* ties: the smaller id; fewer candidates than k: all of them (a shard of at most BEAM nodes is searched whole);
* an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch

SHARD = 16_384  # nodes of a shard, about: a query's work in a shard grows far less than the shard
DEGREE, BUILD_BEAM, BEAM, ALPHA = 28, 56, 96, 1.2
ENTRIES, EXPANDED = 32, 4  # random nodes a search starts from, and as many far ones; nodes it expands at a time
BATCH = 512
QUERY_BLOCK, SLICE_BLOCKS = 256, 256  # queries of a block, about, and blocks that pass one copy of a graph
MOST_TASKS = 20_000
GRAPH = "shard int, dim int, n int, vectors binary, edges binary, entries binary, ids binary, bounds binary"


def beam_search(vectors: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int):
    """Nodes nearest to each query as found from the entries: (nodes, squared distances), nearest first, -1 for none."""
    n_queries, n = len(queries), len(vectors)
    norms = np.einsum("ij,ij->i", vectors, vectors)
    seen = np.zeros((n_queries, n), bool)
    seen[:, entries] = True
    dist = norms[entries][None] - 2 * queries @ vectors[entries].T
    node = np.broadcast_to(entries, dist.shape)
    node, dist = _smallest(dist, width, node, dist)
    pad = width - node.shape[1]
    node = np.pad(node, ((0, 0), (0, max(0, pad))), constant_values=-1)
    dist = np.pad(dist, ((0, 0), (0, max(0, pad))), constant_values=np.inf)
    done = node < 0
    active = np.arange(n_queries)
    while len(active):
        open_dist = np.where(done[active], np.inf, dist[active])
        pick = np.argpartition(open_dist, EXPANDED - 1, axis=1)[:, :EXPANDED]
        some = np.isfinite(np.take_along_axis(open_dist, pick, 1))
        on = some.any(axis=1)
        active, pick, some = active[on], pick[on], some[on]
        if not len(active):
            break
        rows = np.repeat(np.arange(len(active)), EXPANDED).reshape(pick.shape)[some]
        done[active[rows], pick[some]] = True
        near = np.full((len(active), EXPANDED, edges.shape[1]), -1, np.int32)
        near[some] = edges[node[active[rows], pick[some]]]
        # a node may come twice in one step; where none is, the last node's mark is read and left out
        near = np.sort(near.reshape(len(active), -1), axis=1)
        fresh = (near >= 0) & ~seen[active[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        which = near[r, c]
        seen[active[r], which] = True
        new = np.full(near.shape, np.inf, np.float32)
        new[r, c] = norms[which] - 2 * np.einsum("ij,ij->i", vectors[which], queries[active[r]])
        all_dist = np.concatenate([dist[active], new], axis=1)
        node[active], dist[active], done[active] = _smallest(
            all_dist, width, np.concatenate([node[active], near], axis=1), all_dist, np.concatenate([done[active], ~fresh], axis=1))
    order = np.argsort(dist, axis=1, kind="stable")
    node, dist = np.take_along_axis(node, order, 1), np.take_along_axis(dist, order, 1)
    return np.where(np.isfinite(dist), node, -1), dist


def _smallest(dist: np.ndarray, width: int, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The columns at the smallest distances of each row, in no order."""
    if dist.shape[1] <= width:
        return columns
    order = np.argpartition(dist, width - 1, axis=1)[:, :width]
    return tuple(np.take_along_axis(c, order, 1) for c in columns)


def robust_prune(vectors: np.ndarray, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
    """Edges [points, DEGREE] of the points, picked from candidates [points, m] (-1 for none)."""
    out = np.full((len(points), DEGREE), -1, np.int32)
    step = max(1, (1 << 23) // max(1, cand.shape[1] ** 2))
    for lo in range(0, len(points), step):
        p, c = points[lo:lo + step], cand[lo:lo + step]
        x = vectors[c]  # row -1 is some vector; its distance is made infinite
        own = ((x - vectors[p][:, None]) ** 2).sum(axis=2)
        own[(c < 0) | (c == p[:, None])] = np.inf
        order = np.argsort(own, axis=1, kind="stable")
        c, own, x = np.take_along_axis(c, order, 1), np.take_along_axis(own, order, 1), np.take_along_axis(x, order[:, :, None], 1)
        sq = (x ** 2).sum(axis=2)
        between = sq[:, :, None] + sq[:, None] - 2 * x @ x.transpose(0, 2, 1)
        alive = np.isfinite(own)
        rows = np.arange(len(p))
        for k in range(DEGREE):
            first = alive.argmax(axis=1)
            on = alive[rows, first]
            if not on.any():
                break
            out[lo:lo + step][on, k] = c[rows[on], first[on]]
            alive &= ~((ALPHA ** 2 * between[rows, first] <= own) & on[:, None])
            alive[rows, first] = False
    return out


def _far_apart(vectors: np.ndarray, n: int) -> np.ndarray:
    """Nodes each farthest from those before it, so that every separate cluster has an entry."""
    got = [int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    least = np.full(len(vectors), np.inf)
    while len(got) < n:
        least = np.minimum(least, ((vectors - vectors[got[-1]]) ** 2).sum(axis=1))
        got.append(int(least.argmax()))
    return np.array(got)


def build_graph(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(edges [nodes, DEGREE], entries) of distinct vectors."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    if n <= BEAM:  # searched whole: every node is an entry
        return np.full((n, DEGREE), -1, np.int32), np.arange(n)
    entries = np.unique(np.concatenate([order[:ENTRIES], _far_apart(vectors, ENTRIES)]))
    order = np.concatenate([entries, order[~np.isin(order, entries)]])
    edges = np.full((n, DEGREE), -1, np.int32)
    edges[entries] = robust_prune(vectors, entries, np.broadcast_to(entries, (len(entries), len(entries))).astype(np.int32))
    at = len(entries)
    while at < n:
        points = order[at:at + min(BATCH, at)]
        found, _ = beam_search(vectors, edges, entries, vectors[points], BUILD_BEAM)
        edges[points] = robust_prune(vectors, points, found)
        _link_back(vectors, edges, points)
        at += len(points)
    # once more over all, now that every node can be proposed
    for lo in range(0, n, BATCH):
        points = order[lo:lo + BATCH]
        found, _ = beam_search(vectors, edges, entries, vectors[points], BUILD_BEAM)
        edges[points] = robust_prune(vectors, points, np.concatenate([found, edges[points]], axis=1))
        _link_back(vectors, edges, points)
    return edges, entries


def _link_back(vectors: np.ndarray, edges: np.ndarray, points: np.ndarray) -> None:
    """Adds to each neighbour of the points an edge back, pruning the lists that grow too long."""
    to = edges[points]
    r, c = np.nonzero(to >= 0)
    end, start = to[r, c], points[r]
    order = np.argsort(end, kind="stable")
    end, start = end[order], start[order]
    ends, first, count = np.unique(end, return_index=True, return_counts=True)
    longest = int(count.max()) if len(count) else 0
    new = np.full((len(ends), longest), -1, np.int32)
    which = np.repeat(np.arange(len(ends)), count)
    new[which, np.arange(len(end)) - first[which]] = start
    new[(new[:, :, None] == edges[ends][:, None]).any(axis=2)] = -1
    full = (edges[ends] >= 0).sum(axis=1) + (new >= 0).sum(axis=1) > DEGREE
    both = np.concatenate([edges[ends], new], axis=1)
    if full.any():
        edges[ends[full]] = robust_prune(vectors, ends[full], both[full])
    rest = both[~full]
    keep = np.argsort(rest < 0, axis=1, kind="stable")[:, :DEGREE]
    edges[ends[~full]] = np.take_along_axis(rest, keep, 1)


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def sound_rows(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    rows = table.select(table[id_col].cast("long").alias("id"), table[vector_col].cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.where("id is not null and vector is not null").where(
        F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))


def nodes(rows: DataFrame, k: int) -> DataFrame:
    """(vector, ids) of distinct vectors, with their k + 1 smallest ids."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    return (rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
            .groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")))


def graphs(distinct: DataFrame, n_nodes: int) -> DataFrame:
    """One row of GRAPH for each shard (and length of vectors)."""
    shards = shard_count(n_nodes)
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64(F.get("ids", F.lit(0))), F.lit(shards)).cast("int"))
    dealt = dealt.withColumn("dim", F.size("vector"))

    def build(key, part):
        part = part.combine_chunks().sort_by([("first", "ascending")])
        vectors = _rows(part.column("vector"))
        edges, entries = build_graph(vectors.astype(np.float32))
        ids = part.column("ids").combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([len(vectors)], pa.int32()),
            "vectors": [vectors.astype("<f8").tobytes()], "edges": [edges.astype("<i4").tobytes()], "entries": [entries.astype("<i8").tobytes()],
            "ids": [ids.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()], "bounds": [bounds.astype("<i8").tobytes()]})

    dealt = dealt.withColumn("first", F.get("ids", F.lit(0)))
    return dealt.groupBy("shard", "dim").applyInArrow(build, GRAPH)


def shard_count(n_nodes: int) -> int:
    return n_nodes // SHARD + 1


def search(stored: DataFrame, shards: int, queries: DataFrame, n_queries: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each shard, each query's k best. queries: (id, vector); stored: rows of GRAPH.

    A unit of work is a shard and a slice of the blocks of queries: the graph comes
    first in a sorted partition, is read once, and the slice's blocks stream past it.
    """
    blocks = n_queries // QUERY_BLOCK + 1
    slices = blocks // SLICE_BLOCKS + 1
    keyed = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("dim", F.size("vector"))

    def pack(key, part):
        return pa.table({
            "dim": pa.array([key[1].as_py()], pa.int32()), "slice": pa.array([key[0].as_py() % slices], pa.int32()),
            "query_ids": [part.column("id").combine_chunks().to_numpy(zero_copy_only=False).astype("<i8").tobytes()],
            "query_vectors": [_rows(part.column("vector")).astype("<f8").tobytes()]})

    packed = keyed.groupBy("block", "dim").applyInArrow(pack, "dim int, slice int, query_ids binary, query_vectors binary")
    # a block goes to each shard, a graph to each slice; a length of vectors may have no graph in some shard
    asked = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("turn", F.lit(1))
    graph = stored.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("turn", F.lit(0))
    unit = ["dim", "shard", "slice"]
    both = (graph.unionByName(asked, allowMissingColumns=True)
            .repartition(min(MOST_TASKS, 2 * shards * slices), *unit).sortWithinPartitions(*unit, "turn")
            .select(*unit, "query_ids", "query_vectors", "vectors", "edges", "entries", "ids", "bounds"))

    def run(batches):
        held = None
        for row in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            dim, shard, part, query_ids, queries, *graph = (c[0].as_py() for c in row.columns)
            if query_ids is None:
                held = dim, shard, part
                vectors, (edges, entries, ids, bounds) = np.frombuffer(graph[0], "<f8").reshape(-1, dim), graph[1:]
                edges = np.frombuffer(edges, "<i4").reshape(len(vectors), -1)
                entries, ids, bounds = (np.frombuffer(x, "<i8") for x in (entries, ids, bounds))
                near = vectors.astype(np.float32)
            elif held == (dim, shard, part):
                query_ids, queries = np.frombuffer(query_ids, "<i8"), np.frombuffer(queries, "<f8").reshape(-1, dim)
                for lo in range(0, len(queries), BATCH):
                    q = queries[lo:lo + BATCH]
                    found, _ = beam_search(near, edges, entries, q.astype(np.float32), BEAM)
                    out = []
                    for name, v, at in zip(query_ids[lo:lo + BATCH].tolist(), q, found):
                        at = at[at >= 0]
                        score = np.sqrt(((vectors[at] - v) ** 2).sum(axis=1))
                        got = [(s, x) for s, r in zip(score.tolist(), at.tolist()) for x in ids[bounds[r]:bounds[r + 1]].tolist() if x != name]
                        out += [(name, x, s) for s, x in sorted(got)[:k]]
                    if out:
                        a, b, c = zip(*out)
                        yield pa.RecordBatch.from_pydict({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": c})

    return both.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found to each row whose id is divisible by ``every``."""
    scratch = Scratch(table.sparkSession, "ann")
    rows = sound_rows(table, id_col, vector_col)
    distinct = scratch.keep(nodes(rows, k), "nodes")
    n_nodes = distinct.count()
    stored = scratch.keep(graphs(distinct, n_nodes), "graphs")
    queries = scratch.keep(rows.where(F.col("id") % every == 0).dropDuplicates(), "queries")
    found = search(stored, shard_count(n_nodes), queries, queries.count(), k)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def digest(table: DataFrame) -> DataFrame:
    return nearest(table)
