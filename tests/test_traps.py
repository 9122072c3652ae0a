"""Micro fixtures with hand-computed answers, one per semantic trap."""

import pytest

from conftest import pairs_df, ratings_df
from tastegraph.operators import knn as K
from tastegraph.operators import similarity as S
from tastegraph.operators.neighbours import rank_neighbours
from tastegraph.sources import ratings as R

IMPLICIT_ZERO = {1: {1: 5, 2: 1}, 2: {1: 5, 2: 1, 3: 5}, 3: {1: 3, 2: 3}, 4: {1: 1, 2: 5, 3: 5}}
ZERO_DEV = {1: {1: 5, 2: 1}, 2: {1: 5, 2: 1, 3: 5}, 5: {1: 5, 2: 1, 3: 3}}


def _pred(spark, rows, pair, **kw):
    out = K.predict(ratings_df(spark, rows), pairs_df(spark, [pair]), **kw).collect()
    return out[0]["prediction"] if out else None


def test_implicit_zero_similarities(spark):
    sims = {(r.user_id, r.other_id): r.sim
            for r in S.cosine_similarity(ratings_df(spark, IMPLICIT_ZERO), keep_zero=True).collect()}
    assert sims[(1, 2)] == pytest.approx(0.8164965809, abs=1e-10)
    assert sims[(1, 3)] == 0.0
    assert sims[(1, 4)] == pytest.approx(-0.8164965809, abs=1e-10)


@pytest.mark.parametrize("k,expected", [(1, 5.0), (2, 5.0), (3, 3.0)])
def test_implicit_zero_ranks_above_negatives(spark, k, expected):
    # with k=2 the zero-similarity user 3 takes the second slot, not user 4
    assert _pred(spark, IMPLICIT_ZERO, (1, 3, 5.0), k=k) == pytest.approx(expected, abs=1e-9)


def test_zero_deviation_weightings(spark):
    assert _pred(spark, ZERO_DEV, (1, 3, 5.0), k=2) == pytest.approx(3.8989794855, abs=1e-9)
    assert _pred(spark, ZERO_DEV, (1, 3, 5.0), k=2, weighting="nonzero_dev") == pytest.approx(5.0, abs=1e-9)


def test_self_is_never_a_neighbour(spark):
    sims = S.cosine_similarity(ratings_df(spark, ZERO_DEV))
    nb = rank_neighbours(sims, 1, 3).filter("user_id = 1").collect()
    assert [(r.other_id, r.sim) for r in nb] == [(5, 1.0)]


def test_zero_norm_user_predicts_own_mean(spark):
    assert _pred(spark, IMPLICIT_ZERO, (3, 3, 5.0), k=2) == pytest.approx(3.0)
    assert _pred(spark, IMPLICIT_ZERO, (3, 3, 5.0), k=None) == pytest.approx(3.0)


def test_cold_user_policies(spark):
    assert _pred(spark, IMPLICIT_ZERO, (99, 1, 4.0), k=2) is None
    values = [r for items in IMPLICIT_ZERO.values() for r in items.values()]
    g = sum(values) / len(values)
    assert _pred(spark, IMPLICIT_ZERO, (99, 1, 4.0), k=2, cold_user="global_mean") == pytest.approx(g)


def test_cold_item_predicts_user_mean(spark):
    assert _pred(spark, IMPLICIT_ZERO, (1, 77, 4.0), k=2) == pytest.approx(3.0)


def test_duplicates_rejected_and_folded(spark):
    df = pairs_df(spark, [(1, 1, 5), (1, 1, 5), (1, 2, 3)])
    with pytest.raises(R.ExpectationError):
        R.expect_unique(df)
    folded = R.dedupe_ratings(df)
    assert folded.count() == 2
    R.expect_unique(folded)


def test_row_count_expectation(spark):
    df = pairs_df(spark, [(1, 1, 5), (1, 2, 3)])
    assert R.expect_row_count(df, 2) is df
    with pytest.raises(R.ExpectationError):
        R.expect_row_count(df, 3)


def test_population_stddev(spark):
    from tastegraph.operators.stats import corated_stats

    # users 1,2 share item 1; pairs incl. self: (1,1)=2, (1,2)=1, (2,2)=1 -> mean 4/3
    df = pairs_df(spark, [(1, 1, 5), (1, 2, 3), (2, 1, 4)])
    row = corated_stats(df).first()
    mean = 4 / 3
    pop = (((2 - mean) ** 2 + 2 * (1 - mean) ** 2) / 3) ** 0.5
    assert row.n_pairs == 3 and row.min_co == 1 and row.max_co == 2
    assert row.avg_co == pytest.approx(mean, abs=1e-9)
    assert row.stddev_co == pytest.approx(pop, abs=1e-9)


def test_absent_pairs_count_as_zero(spark):
    from tastegraph.operators.stats import corated_stats

    df = pairs_df(spark, [(1, 1, 5), (2, 2, 3)])
    row = corated_stats(df).first()
    assert row.n_pairs == 3 and row.min_co == 0 and row.max_co == 1


def test_focused_request_matches_full_model(spark):
    """One user's request (neighbourhood-only model) equals the same pair in a full request."""
    import random

    rnd = random.Random(3)
    rows = {}
    for u in range(1, 6):                      # community A: items 1..6
        rows[u] = {i: float(rnd.randint(1, 5)) for i in range(1, 7) if rnd.random() < 0.8}
    for u in range(10, 30):                    # community B: items 100..110
        rows[u] = {i: float(rnd.randint(1, 5)) for i in range(100, 111) if rnd.random() < 0.7}
    rows[1].pop(6, None)
    train = ratings_df(spark, rows)
    single = pairs_df(spark, [(1, 6, 4.0)])
    everyone = pairs_df(spark, [(u, 6, 4.0) for u in range(1, 6)] + [(u, 100, 3.0) for u in range(10, 30)])
    for k in (1, 3, None):
        a = K.predict(train, single, k=k).collect()[0].prediction
        b = K.predict(train, everyone, k=k).filter("user_id = 1").collect()[0].prediction
        assert a == pytest.approx(b, abs=1e-12)
    f = K.Focus(train, single)
    assert f.users is not None and f.train.select("user_id").distinct().count() == 5
    assert f.n_users == 25
