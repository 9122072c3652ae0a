"""Golden answers on the sf0.001 rating table (FIXTURES.md §3) and invariants."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastegraph.operators import knn as K
from tastegraph.operators import similarity as S
from tastegraph.sources import ratings as R


@pytest.fixture(scope="module")
def tt(spark):
    return R.train_test(spark, SF001)


def test_knn_sweep_goldens(tt):
    train, test = tt
    got = {r.k: r.mae for r in K.knn_sweep(train, test, [10, 30, 50, 100, 200, 300]).collect()}
    assert got == {10: 1.380214986, 30: 1.345774709, 50: 1.314086051, 100: 1.297977907,
                   200: 1.284711753, 300: 1.284711753}


def test_all_neighbour_goldens(tt):
    train, test = tt
    assert K.mae(K.predict(train, test, k=None)).first().mae == 1.284711753
    assert K.mae(K.predict(train, test, k=None, similarity="jaccard")).first().mae == 1.267109801


def test_nonzero_weighting_golden(tt):
    train, test = tt
    assert K.mae(K.predict(train, test, k=100, weighting="nonzero_dev")).first().mae == 1.298197583


def test_knn_with_all_users_equals_cosine(tt):
    train, test = tt
    u = K.count_users(train)
    knn = K.mae(K.predict(train, test, k=u - 1)).first().mae
    assert knn == K.mae(K.predict(train, test, k=None)).first().mae


def test_recommendations_golden(spark):
    personal = R.personal_from_part(spark, SF001)
    data = R.with_personal(R.ratings_from_tables(spark, SF001), personal)
    cands = R.personal_candidates(personal)
    top30 = [(r.item_id, r.title, r.score) for r in K.recommend(data, cands, n=5, k=30).orderBy("rank").collect()]
    assert top30 == [(54, "blue rod", 5.0), (107, "small widget", 5.0), (178, "large plate", 5.0),
                     (88, "blue gizmo", 4.94997904), (13, "large anvil", 4.878108359)]
    top300 = [(r.item_id, r.score) for r in K.recommend(data, cands, n=5, k=300).orderBy("rank").collect()]
    assert top300 == [(29, 4.25040414), (20, 3.912000659), (186, 3.892469997), (170, 3.847576341),
                      (13, 3.739359614)]


def test_value_ranges(tt):
    train, test = tt
    dev = S.deviations(train)
    lo, hi = dev.agg(F.min("dev"), F.max("dev")).first()
    assert -1.0 <= lo and hi <= 1.0
    sims = S.cosine_similarity(train, keep_zero=True)
    lo, hi = sims.agg(F.min("sim"), F.max("sim")).first()
    assert -1.0 <= lo and hi <= 1.0
    asym = (sims.alias("a").join(sims.alias("b"), (F.col("a.user_id") == F.col("b.other_id"))
                                 & (F.col("a.other_id") == F.col("b.user_id")))
            .filter(F.col("a.sim") != F.col("b.sim")).count())
    assert asym == 0
    p = K.predict(train, test, k=30)
    lo, hi = p.agg(F.min("prediction"), F.max("prediction")).first()
    assert 1.0 <= lo and hi <= 5.0


def test_jaccard_self_and_range(tt):
    train, _ = tt
    j = S.jaccard_similarity(train)
    lo, hi = j.agg(F.min("sim"), F.max("sim")).first()
    assert 0.0 < lo and hi <= 1.0
    own = S.jaccard_similarity(train, include_self=True).filter("user_id = other_id")
    assert {r.sim for r in own.collect()} == {1.0}


def test_input_order_does_not_matter(spark, tt):
    train, test = tt
    shuffled = train.orderBy(F.rand(7)).repartition(5)
    a = K.mae(K.predict(train, test, k=50)).first().mae
    b = K.mae(K.predict(shuffled, test, k=50)).first().mae
    assert a == b


def test_lowest_k_better_returns_null_row(tt):
    train, test = tt
    sweep = K.knn_sweep(train, test, [10, 30])
    row = K.lowest_k_better(sweep, 0.5).collect()
    assert len(row) == 1 and row[0].k is None
    row = K.lowest_k_better(K.knn_sweep(train, test, [10, 30, 50, 100, 200, 300]), 1.30).first()
    assert (row.k, row.mae) == (100, 1.297977907)
