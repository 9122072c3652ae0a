"""Hard negatives against all pairs, and cover trees against their vectors."""

import math
import random

import numpy as np
import pytest
from conftest import SF001

from tastegraph.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id int, mark int"


def brute(rows, every=50, positives=5, negatives=3):
    seen = set()
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in seen:
        if i % every:
            continue
        others = [(-dot(v, w), j, m) for j, m, w in seen if j != i and len(w) == len(v)]
        for p, pid in sorted((s, j) for s, j, m in others if m == label)[:positives]:
            found = sorted((s, j) for s, j, m in others if m != label and 50 * -p <= 100 * -s <= 95 * -p)[:negatives]
            out += [(i, pid, k + 1, j, -p, -s) for k, (s, j) in enumerate(found)]
    return sorted(out)


def vectors(n, seed=1, dim=6):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = centers[i % 5]
        rows.append((i, [float(np.float32(x + rng.gauss(0, 0.3))) for x in c], rng.randrange(4)))
    same = rows[3][1]
    rows += [(1000 + i, same, i % 3) for i in range(n // 3)]  # a third are copies of one vector
    rows += [rows[0], rows[50 % n], (50, rows[1][1], 2), (None, same, 1), (2001, None, 1), (2002, same, None), (2003, [], 1),
             (2004, [*same[1:], None], 1), (2005, [*same[1:], float("nan")], 1), (2006, [*same[1:], float("inf")], 1),
             (2050, [0.0] * dim, 1), (2051, same[:-1], 1), (2100, same[:-1], 2), (2052, [2 * x for x in same[:-1]], 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_equal_to_all_pairs(spark):
    rows = vectors(400)
    assert got(hn.mine(frame(spark, rows), every=10)) == brute(rows, every=10)


def test_small_shards_leaves_and_blocks(spark, monkeypatch):
    for name, value in (("SHARD", 60), ("LEAF", 3), ("BLOCK", 7), ("BLOCKS_PER_TREE", 1)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(300, seed=2)
    want = brute(rows, 10, 4, 2)
    assert want and got(hn.mine(frame(spark, rows), every=10, positives=4, negatives=2)) == want


def test_trees_cover_their_vectors():
    rng = np.random.default_rng(3)
    for points in (rng.normal(size=(700, 5)), np.repeat(rng.normal(size=(3, 4)), 60, axis=0), np.ones((100, 2)), rng.normal(size=(1, 3))):
        tree = hn.CoverTree(points)
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        norms = (points ** 2).sum(axis=1)
        lifted = np.concatenate([points, np.sqrt(np.maximum(0, norms.max() - norms))[:, None]], axis=1)

        def below(node):
            if tree.leaf[node]:
                return tree.order[tree.first[node]:tree.last[node]].tolist()
            return [x for c in range(tree.first[node], tree.last[node]) for x in below(c)]
        assert sorted(below(0)) == list(range(len(points)))
        for node in range(len(tree.center)):
            d = np.sqrt(((lifted[below(node)] - lifted[tree.center[node]]) ** 2).sum(axis=1))
            assert d.max() <= tree.radius[node] + 1e-9
            assert not tree.leaf[node] or tree.last[node] - tree.first[node] <= hn.LEAF


def test_bounds_hold_and_skip_nodes():
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(8, 16)) * 400
    points = np.floor(centers[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 16)) * 30).astype(np.int64)
    tree = hn.CoverTree(points.astype(float))
    place = np.empty(2000, int)
    place[tree.order] = np.arange(2000)
    shard = hn.Shard(points[tree.order], np.arange(2000), np.zeros(2000, np.int64), place[tree.center],
                     *(np.array(getattr(tree, c)) for c in ("radius", "first", "last", "leaf")))
    anchors = points[:40]
    low, high = shard.bounds(anchors)
    for node in np.flatnonzero(shard.leaf):
        s = anchors @ shard.vectors[shard.first[node]:shard.last[node]].T
        assert (s <= high[:, node][:, None]).all() and (s >= low[:, node][:, None]).all()
    scored = []
    real = shard.scores
    shard.scores = lambda a, first, last: scored.append(len(a) * (last - first)) or real(a, first, last)
    no = np.full((40, 1), hn.NEVER)
    row, _, ids, score = shard.search(anchors, np.full(40, -1), np.zeros(40, np.int64), True, 3, -no, no)
    full = anchors @ shard.vectors.T
    want = [tuple(x) for r in range(40) for x in sorted((-s, i) for i, s in enumerate(full[r].tolist()))[:3]]
    assert list(zip((-score).tolist(), ids.tolist())) == want
    assert sum(scored) < 0.5 * full.size  # the rest was skipped by its bounds


def test_several_windows_at_once():
    rng = np.random.default_rng(6)
    points = rng.integers(-50, 50, (900, 4))
    tree = hn.CoverTree(points.astype(float))
    place = np.empty(900, int)
    place[tree.order] = np.arange(900)
    shard = hn.Shard(points[tree.order], np.arange(900), np.zeros(900, np.int64), place[tree.center],
                     *(np.array(getattr(tree, c)) for c in ("radius", "first", "last", "leaf")))
    least = rng.integers(-3000, 3000, (30, 3))
    most = least + rng.integers(-100, 900, (30, 3))
    got = shard.search(points[:30], np.full(30, -1), np.ones(30, np.int64), False, 2, least, most)
    full = points[:30] @ shard.vectors.T
    want = [(r, w, i, -s) for r in range(30) for w in range(3)
            for s, i in sorted((-s, i) for i, s in enumerate(full[r].tolist()) if least[r, w] <= s <= most[r, w])[:2]]
    assert sorted(zip(*(x.tolist() for x in got))) == sorted(want)


def test_windows_are_exact():
    p = np.array([-7, 0, 1, 2, 19, 100, 12345, 2 ** 61 + 7])
    low, high = hn.window(p)
    for x, a, b in zip(p.tolist(), low.tolist(), high.tolist()):
        assert a == -(-50 * x // 100) and b == 95 * x // 100


def test_scores_beyond_64_bits_are_refused(spark):
    rows = [(i, [3e16, 3e16], i % 2) for i in range(60)]
    with pytest.raises(Exception, match="beyond 64 bits"):
        hn.mine(frame(spark, rows), every=10).collect()


def test_empty_table_and_the_given_one(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    assert hn.mine(table.limit(0)).collect() == []
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert got(hn.digest(table)) == brute(rows)
