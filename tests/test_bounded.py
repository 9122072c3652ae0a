"""Bounded top-k search: the same neighbours as the whole self-join, from fewer pair rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastegraph.operators import bounded as B
from tastegraph.operators import knn as K
from tastegraph.operators import similarity as S
from tastegraph.operators.neighbours import rank_neighbours
from tastegraph.operators.pairs import item_self_join
from tastegraph.sources import ratings as R


@pytest.fixture(scope="module")
def popular(spark):
    """Groups of ten users with like tastes, and three items that everybody rated near the own mean."""
    rng = random.Random(5)
    rows = []
    for u in range(600):
        group = u // 10
        for i in range(8):
            rows.append((u, 100 + 8 * group + i, float(5 if (i + group) % 2 else 1) if rng.random() < 0.9 else 3.0))
        rows += [(u, i, 3.0 + 0.1 * rng.random()) for i in range(3)]
        if u % 50 == 0:  # nothing but popular items: no pair is met on a short list
            rows = [r for r in rows if r[0] != u or r[1] < 100]
            rows += [(u, 0, 5.0), (u, 1, 1.0)] and []
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double").cache()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_long_lists_are_found_only_where_they_pay(spark, popular):
    items = popular.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))
    assert B.long_lists(items) == 512
    train, _ = R.train_test(spark, SF001)
    assert B.long_lists(train.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))) is None
    assert B.long_lists(items.limit(0)) is None


@pytest.mark.parametrize("k", [1, 5, 9, 30])
def test_same_neighbours(popular, k):
    nd = S.preprocess(popular)[2]
    plain = rank_neighbours(S.cosine_similarity(nd=nd), k, 600)
    assert _rows(rank_neighbours(B.bounded_similarity(nd, k, 512), k, 600)) == _rows(plain)


def test_same_neighbours_of_some_users(popular):
    nd = S.preprocess(popular)[2]
    users = popular.select("user_id").distinct().filter("user_id < 40")
    plain = rank_neighbours(S.cosine_similarity(nd=nd, users=users), 5, 600)
    assert _rows(rank_neighbours(B.bounded_similarity(nd, 5, 512, users=users), 5, 600)) == _rows(plain)


def test_same_neighbours_whatever_the_cut(spark):
    train, _ = R.train_test(spark, SF001)
    nd = S.preprocess(train)[2]
    n = train.select("user_id").distinct().count()
    plain = _rows(rank_neighbours(S.cosine_similarity(nd=nd), 3, n))
    for cut in (1, 8, 20, 10 ** 6):
        assert _rows(rank_neighbours(B.bounded_similarity(nd, 3, cut), 3, n)) == plain


def test_fewer_pair_rows_are_made(popular):
    nd = S.preprocess(popular)[2]
    b = B.search_bounds(nd, 5, 512)
    made = (item_self_join(b.rows.filter("not long"), ["nd"]).count() + B.completions(b).count()
            + item_self_join(b.rows.drop("long"), ["nd"], left_users=b.open_users).count())
    whole = item_self_join(b.rows.drop("long"), ["nd"]).count()
    assert made < whole / 4
    assert b.candidates.count() < b.met.count()


def test_used_for_popular_items_and_equal(popular, monkeypatch):
    want = _rows(K.neighbours_table(popular, 5))
    called = []
    real = K.bounded_similarity
    monkeypatch.setattr(K, "bounded_similarity", lambda *a, **kw: called.append(1) or real(*a, **kw))
    monkeypatch.setattr(K, "BOUNDED_PAIR_ROWS", 0)
    assert _rows(K.neighbours_table(popular, 5)) == want and called
