"""Hard-negative mining with cover trees over norm-augmented vectors and exact integer scores.

Components become integers, floor(256 * x). Vectors are dealt to shards of
bounded size: by label, a label with more than SHARD of them by a hash as well,
and small labels together. A task gives each vector of its shard one more
component, so that all have the norm of the longest; the nearest vector to an
anchor is then that of the greatest inner product. Over these it builds a cover
tree: at each level, centres farther apart than half the level's radius take the
vectors within it, and every node knows the distance that covers all below it.
That radius bounds the inner products of a node from both sides.

A search goes down best first: of the nodes not yet opened that with the highest
upper bound is next; nodes outside the wanted window of scores, or below the worst
score kept, are skipped; and the vectors of a leaf are scored exactly. Anchors
come in blocks. A shard's tree and the blocks that visit it are streamed to one
task, the tree first; a tree visited by very many blocks is copied to several.

First the anchors meet their own label's shards, for their positives, then the
shards that hold other labels, for the negatives in each positive's window.

Edge cases
* rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part;
* rows equal in id, label and vector count once; rows that share only an id are rows of their own,
  but none is found for an anchor of that id;
* ties: the smaller id. Of equal vectors of one label only as many ids as can be found are kept, the smallest;
* vectors are only compared with those of equal length;
* an anchor without positives, or a positive without negatives in its window, gives no rows: an empty table neither;
* a score beyond 64 bits ends the job with an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, tidied

SHARD = 8192  # vectors of a shard, about
LEAF = 128  # vectors of a leaf at most
BLOCK = 1024  # anchors of a block, about
BLOCKS_PER_TREE = 16  # that one copy of a tree meets
OPENED = 8  # nodes that each anchor opens at a time
BROADCAST_ROWS = 1_000_000
NEVER = np.iinfo(np.int64).max
ITEM = "dim int, shard string, copy int, kind int, vectors binary, ids binary, labels binary, more binary"


class CoverTree:
    """Nodes over a reordering of the vectors; children and leaves' vectors are ranges [first, last)."""

    def __init__(self, vectors: np.ndarray):
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.top = float(norms.max())
        lifted = np.concatenate([vectors, np.sqrt(np.maximum(0, self.top - norms))[:, None]], axis=1)
        order: list[np.ndarray] = []
        self.center, self.radius, self.first, self.last, self.leaf = [], [], [], [], []
        start = int(((lifted - lifted.mean(axis=0)) ** 2).sum(axis=1).argmin())
        waiting = [self._add(lifted, np.arange(len(lifted)), start)]
        done = 0
        for node, members in waiting:
            parts = self._children(lifted, members, self.center[node], self.radius[node])
            if parts is None:
                order.append(members)
                self.first[node], self.last[node], self.leaf[node] = done, done + len(members), True
                done += len(members)
            else:
                self.first[node] = len(self.center)
                waiting += [self._add(lifted, m, c) for c, m in parts]
                self.last[node] = len(self.center)
        self.order = np.concatenate(order)

    def _add(self, lifted: np.ndarray, members: np.ndarray, center: int) -> tuple[int, np.ndarray]:
        far = np.sqrt(((lifted[members] - lifted[center]) ** 2).sum(axis=1).max())
        for name, value in zip(("center", "radius", "first", "last", "leaf"), (center, float(far), 0, 0, False)):
            getattr(self, name).append(value)
        return len(self.center) - 1, members

    def _children(self, lifted, members, center, radius):
        """(center, members) of the next level, or None for a leaf."""
        if len(members) <= LEAF:
            return None
        if radius > 0:
            parts, left, at = [], members, center
            while len(left) and len(parts) <= len(members) // 4:
                d = ((lifted[left] - lifted[at]) ** 2).sum(axis=1)
                mine = d <= (radius / 2) ** 2
                parts.append((at, left[mine]))
                left = left[~mine]
                at = int(left[0]) if len(left) else -1
            if not len(left):
                return parts
        # too far apart for the next radius to gather them, or all the same: ranges by distance from the centre
        d = ((lifted[members] - lifted[center]) ** 2).sum(axis=1)
        runs = np.array_split(members[np.argsort(d, kind="stable")], -(-len(members) // LEAF))
        return [(int(r[len(r) // 2]), r) for r in runs]

    def table(self) -> pa.Table:
        return pa.table({"center": pa.array(self.center, pa.int32()), "radius": self.radius, "first": pa.array(self.first, pa.int32()),
                         "last": pa.array(self.last, pa.int32()), "leaf": self.leaf})


class Shard:
    """A stored tree: vectors in its order, and bounds for blocks of anchors."""

    def __init__(self, vectors, ids, labels, center, radius, first, last, leaf):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.centers, self.radius, self.first, self.last, self.leaf = vectors[center].astype(np.float64), radius, first, last, leaf
        self.reach = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max())

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products of each anchor with all below each node."""
        q = anchors.astype(np.float64)
        own = (q ** 2).sum(axis=1)[:, None]
        dot = q @ self.centers.T
        both = own + self.reach ** 2
        away = np.sqrt(np.maximum(0, both - 2 * dot))
        slack = 1e-9 * both + 1e-6 * np.sqrt(both)
        swing = np.sqrt(own) * self.radius
        high = np.minimum(dot + swing, (both - np.maximum(0, away - self.radius) ** 2) / 2)
        low = np.maximum(dot - swing, (both - (away + self.radius) ** 2) / 2)
        return low - slack, high + slack

    def exact(self, anchors: np.ndarray) -> np.ndarray:
        """The anchors in the type in which inner products with this shard are exact."""
        largest = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) * self.reach
        if largest >= 2.0 ** 62:
            raise ArithmeticError("inner products beyond 64 bits")
        # sums of whole numbers below 2^53 are exact in double precision, in any order
        return anchors.astype(np.float64) if largest < 2.0 ** 52 else anchors

    def scores(self, anchors: np.ndarray, first: int, last: int) -> np.ndarray:
        """Inner products of the anchors, as `exact` gives them, with a range of vectors."""
        return (anchors @ self.vectors[first:last].T.astype(anchors.dtype)).astype(np.int64)

    def search(self, anchors, ids, labels, same: bool, k: int, least: np.ndarray, most: np.ndarray):
        """(row, window, id, score): the best k vectors of the same (or of another) label for each window.

        ``least`` and ``most`` [anchors, windows] bound the scores wanted.
        """
        n, windows = least.shape
        low, high = self.bounds(anchors)
        anchors = self.exact(anchors)
        todo = np.full(high.shape, -np.inf)
        todo[:, 0] = high[:, 0]
        kept = (np.zeros(0, np.int64),) * 3  # anchor * windows + window, id, score
        need = np.where(least <= most, least, NEVER)  # rises to the k-th score found
        active = np.arange(n)
        while len(active):
            pick = np.argpartition(-todo[active], min(OPENED, todo.shape[1]) - 1, axis=1)[:, :OPENED]
            top = todo[active[:, None], pick]
            todo[active[:, None], pick] = -np.inf
            some = top >= need[active].min(axis=1)[:, None]
            active_next = active[some.any(axis=1)]
            # a node is opened if it reaches into a window that it can still improve
            fits = some & ((top[:, :, None] >= need[active][:, None]) & (low[active[:, None], pick][:, :, None] <= most[active][:, None])).any(axis=2)
            row, node = np.repeat(active, pick.shape[1]).reshape(pick.shape)[fits], pick[fits]
            active = active_next
            leaf = self.leaf[node]
            r, child = _ranges(row[~leaf], self.first[node[~leaf]], self.last[node[~leaf]])
            todo[r, child] = high[r, child]
            found = [self._verify(anchors, ids, labels, same, row[leaf][node[leaf] == x], x, need, most) for x in np.unique(node[leaf])]
            if sum(len(x[0]) for x in found):
                kept = _best(*(np.concatenate(x) for x in zip(kept, *found)), k)
                count = np.bincount(kept[0], minlength=n * windows)
                full = np.flatnonzero(count >= k)
                need.reshape(-1)[full] = kept[2][(np.cumsum(count) - 1)[full]]
        return kept[0] // windows, kept[0] % windows, kept[1], kept[2]

    def _verify(self, anchors, ids, labels, same, row, node, need, most):
        """A leaf's exact scores for some anchors, as (anchor and window, id, score) of those wanted."""
        a, b = self.first[node], self.last[node]
        score = self.scores(anchors[row], a, b)
        wanted = (score >= need[row].min(axis=1)[:, None]) & (score <= most[row].max(axis=1)[:, None])
        r, at = np.nonzero(wanted)
        right = ((self.labels[a + at] == labels[row[r]]) == same) & (self.ids[a + at] != ids[row[r]])
        r, at = r[right], at[right]
        score, at, r = score[r, at], a + at, row[r]
        i, window = np.nonzero((score[:, None] >= need[r]) & (score[:, None] <= most[r]))
        return r[i] * need.shape[1] + window, self.ids[at[i]], score[i]


def _ranges(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row with every number of its range."""
    size = (last - first).astype(np.int64)
    shift = np.repeat(first - (np.cumsum(size) - size), size)
    return np.repeat(row, size), shift + np.arange(size.sum())


def _best(row, ids, score, k: int):
    """The first k of each row by score descending and id, in order of row."""
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return tuple(x[rank < k] for x in (row, ids, score))


def whole_rows(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, components as whole numbers, each row once."""
    rows = table.select(table[id_col].cast("long").alias("id"), table[label_col].cast("long").alias("label"),
                        table[vector_col].cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = rows.where("id is not null and label is not null and size(vector) > 0").where(F.forall("vector", finite))
    label = F.when(F.col("id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return sound.select("id", label.alias("label"), F.transform("vector", lambda x: F.floor(x * 256)).alias("vector")).distinct()


def shards(rows: DataFrame, keep: int, scratch: Scratch) -> DataFrame:
    """One ITEM for each shard's tree, without a copy number."""
    rank = F.row_number().over(Window.partitionBy("label", "vector").orderBy("id"))
    points = rows.withColumn("rank", rank).where(F.col("rank") <= keep).withColumn("dim", F.size("vector"))
    points = scratch.keep(points.drop("rank"), "points")
    sizes = points.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n"))
    small = int(sizes.where(F.col("n") < SHARD).agg(F.sum("n")).first()[0] or 0) // SHARD + 1
    shard = F.when(F.col("n") < SHARD, F.concat(F.lit("~"), F.pmod(F.xxhash64("label"), F.lit(small)))).otherwise(
        F.concat(F.lit("="), F.col("label")))
    named = sizes.select("dim", "label", shard.alias("name"), F.ceil(F.col("n") / SHARD).alias("parts"))
    named = scratch.keep(named, "labels")
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    part = F.pmod(F.xxhash64("vector", "id"), F.col("parts"))
    dealt = points.join(named, ["dim", "label"]).select("dim", F.concat("name", F.lit("/"), part).alias("shard"), "id", "label", "vector")

    def build(key, part):
        part = part.combine_chunks().sort_by([("id", "ascending"), ("label", "ascending")])
        vectors = _matrix(part.column("vector"))
        tree = CoverTree(vectors.astype(np.float64))
        ids, labels = (part.column(c).to_numpy()[tree.order] for c in ("id", "label"))
        place = np.empty(len(ids), np.int32)
        place[tree.order] = np.arange(len(ids))
        nodes = tree.table()
        nodes = nodes.set_column(0, "center", pa.array(place[nodes.column("center").to_numpy()]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, nodes.schema) as out:
            out.write_table(nodes)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": [key[1].as_py()], "copy": pa.array([0], pa.int32()),
                         "kind": pa.array([0], pa.int32()), "vectors": [vectors[tree.order].astype("<i8").tobytes()],
                         "ids": [ids.astype("<i8").tobytes()], "labels": [labels.astype("<i8").tobytes()], "more": [sink.getvalue().to_pybytes()]})

    return dealt.groupBy("dim", "shard").applyInArrow(build, ITEM), named


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(anchors: DataFrame, n_blocks: int) -> DataFrame:
    """One ITEM for each block of (dim, name, id, label, vector, more), and the name of its labels' shards."""
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(n_blocks)).cast("int"))

    def join(key, part):
        part = part.combine_chunks()
        raw = {c: part.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "label")}
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "name": [key[1].as_py()], "block": pa.array([key[2].as_py()], pa.int32()),
                         "vectors": [_matrix(part.column("vector")).astype("<i8").tobytes()], "ids": [raw["id"]], "labels": [raw["label"]],
                         "more": [_matrix(part.column("more")).astype("<i8").tobytes()]})

    return dealt.groupBy("dim", "name", "block").applyInArrow(
        join, "dim int, name string, block int, vectors binary, ids binary, labels binary, more binary")


def visit(trees: DataFrame, packed: DataFrame, same: bool, k: int, n_blocks: int) -> DataFrame:
    """(anchor, mark, positive, positive_score, id, score): the best k of each shard, for anchors (same) or for their windows.

    ``more`` of an anchor is its mark, which tells rows of one id apart, and for
    windows also each positive's id and score; absent ones have a score below 0,
    whose window is empty.
    """
    where = trees.select("dim", "shard", F.substring_index("shard", "/", 1).alias("of"))
    where = F.broadcast(where) if where.count() <= BROADCAST_ROWS else where
    # a label's own shard holds no other label
    meets = (F.col("of") == F.col("name")) if same else ((F.col("of") != F.col("name")) | F.col("of").startswith("~"))
    asked = packed.join(where, "dim").where(meets)
    copies = n_blocks // BLOCKS_PER_TREE + 1
    asked = asked.select("dim", "shard", F.pmod("block", F.lit(copies)).cast("int").alias("copy"), F.lit(1).alias("kind"), "vectors", "ids", "labels", "more")
    held = trees.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    stream = held.select(*asked.columns).unionByName(asked).repartition("dim", "shard", "copy").sortWithinPartitions("dim", "shard", "copy", "kind")

    def run(batches):
        key = shard = None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, name, copy, kind, *raw = (c[i].as_py() for c in batch.columns)
                vectors, ids, labels = (np.frombuffer(x, "<i8") for x in raw[:3])
                vectors = vectors.reshape(-1, dim)
                if kind == 0:
                    nodes = pa.ipc.open_stream(raw[3]).read_all()
                    key, shard = (dim, name, copy), Shard(vectors, ids, labels, *(c.to_numpy() for c in nodes.columns))
                    continue
                if key != (dim, name, copy):
                    raise ValueError(f"no tree came before the block of shard {name}")
                more = np.frombuffer(raw[3], "<i8").reshape(len(ids), -1)
                least, most = np.full((len(ids), 1), -NEVER), np.full((len(ids), 1), NEVER)
                if not same:
                    least, most = window(more[:, 2::2])
                row, which, found, score = shard.search(vectors, ids, labels, same, k, least, most)
                positive = np.zeros((len(row), 2), np.int64) if same else np.stack([more[row, 1 + 2 * which], more[row, 2 + 2 * which]], axis=1)
                if len(row):
                    yield pa.RecordBatch.from_pydict({
                        "anchor": ids[row], "mark": more[row, 0], "positive": positive[:, 0].copy(),
                        "positive_score": positive[:, 1].copy(), "id": found, "score": score})

    return stream.mapInArrow(tidied(run), "anchor long, mark long, positive long, positive_score long, id long, score long")


LEAST, MOST = 50, 95  # percent of the positive's score


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most whole scores s with LEAST * p <= 100 * s <= MOST * p, without leaving 64 bits."""
    whole, rest = np.divmod(positive, 100)
    return whole * LEAST - (-rest * LEAST) // 100, whole * MOST + rest * MOST // 100


def mine(table: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ids divisible by ``every``."""
    scratch = Scratch(table.sparkSession, "negatives")
    rows = scratch.keep(whole_rows(table, id_col, vector_col, label_col), "rows")
    trees, named = shards(rows, max(positives + 1, negatives), scratch)
    trees = scratch.keep(trees, "trees")
    anchors = (rows.where(F.col("id") % every == 0).withColumn("dim", F.size("vector")).join(named, ["dim", "label"])
               .select("dim", "name", "id", "label", "vector", F.xxhash64("label", "vector").alias("mark")))
    anchors = scratch.keep(anchors, "anchors")
    n_blocks = anchors.count() // BLOCK + 1
    packed = scratch.keep(blocks(anchors.withColumn("more", F.array("mark")), n_blocks), "blocks")
    best = Window.partitionBy("anchor", "mark").orderBy(F.col("score").desc(), "id")
    found = (visit(trees, packed, True, positives, n_blocks).withColumn("rank", F.row_number().over(best))
             .where(F.col("rank") <= positives).select(F.col("anchor").alias("id"), "mark", F.col("id").alias("positive"), "score"))
    found = scratch.keep(found, "positives")
    # a positive of negative score has an empty window
    each = found.where("score >= 0").groupBy("id", "mark").agg(F.flatten(F.array_sort(F.collect_list(F.array("positive", "score")))).alias("pairs"))
    absent = F.array_repeat(F.lit(-1).cast("long"), (F.lit(2 * positives) - F.size("pairs")).cast("int"))
    windows = anchors.join(each, ["id", "mark"]).withColumn("more", F.concat(F.array("mark"), "pairs", absent)).drop("pairs")
    packed = scratch.keep(blocks(windows, n_blocks), "windows")
    order = Window.partitionBy("anchor", "mark", "positive", "positive_score").orderBy(F.col("score").desc(), "id")
    return (visit(trees, packed, False, negatives, n_blocks).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def digest(table: DataFrame) -> DataFrame:
    return mine(table)


SQL = """WITH r AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT * FROM (SELECT a.id, a.label, a.v, b.id AS pid, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS ps
    FROM r a JOIN r b ON a.label = b.label AND a.id <> b.id WHERE a.id % 50 = 0)
    QUALIFY row_number() OVER (PARTITION BY id, v ORDER BY ps DESC, pid) <= 5),
q AS (SELECT p.*, c.id AS nid, CAST(list_inner_product(p.v, c.v) AS BIGINT) AS ns FROM p JOIN r c ON c.label <> p.label AND c.id <> p.id)
SELECT id AS anchor_id, pid AS positive_id, CAST(row_number() OVER (PARTITION BY id, v, pid, ps ORDER BY ns DESC, nid) AS INT) AS rank,
    nid AS negative_id, ps AS positive_score, ns AS negative_score FROM q WHERE 50 * ps <= 100 * ns AND 100 * ns <= 95 * ps
    QUALIFY row_number() OVER (PARTITION BY id, v, pid, ps ORDER BY ns DESC, nid) <= 3"""
