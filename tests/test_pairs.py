"""Pair rows cross a shuffle as lists, once where both directions are the same, in tasks of bounded size."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastegraph.operators import knn as K
from tastegraph.operators import pairs as P
from tastegraph.operators import similarity as S
from tastegraph.session import materialize
from tastegraph.sources import ratings as R


def _rows(df, digits=9):
    return sorted(tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect())


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def repeated(spark):
    """Some (user, item) rows twice, some without a user or an item."""
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(9) if (u + 2 * i) % 3]
    rows += rows[::4] + [(None, 1, 2.0), (3, None, 4.0)]
    return materialize(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), "table")


@pytest.mark.parametrize("hot", [2, 4096])
@pytest.mark.parametrize("clustered", [None, False])
@pytest.mark.parametrize("pair", ["ne", "le"])
def test_lists_make_the_rows_of_the_join(spark, repeated, hot, clustered, pair):
    made = P.item_self_join(repeated, ["rating"], pair=pair).filter("user_id is not null and other_id is not null")
    want = made.groupBy("user_id", "other_id").agg(F.sum(F.col("a_rating") * F.col("b_rating")).alias("p"), F.count(F.lit(1)).alias("n"))
    got = P.pair_aggregate(repeated, ["rating"], {"p": F.col("a_rating") * F.col("b_rating")}, {"p": F.sum("p"), "n": F.count(F.lit(1))},
                           pair=pair, cluster_by_user=clustered, hot_bucket=hot, symmetric=True)
    assert _rows(got.filter("user_id is not null and other_id is not null")) == _rows(want)


def test_each_pair_is_shuffled_once_as_a_list(spark, repeated):
    plan = _plan(S.cosine_similarity(repeated, keep_zero=True))
    assert "slice(" in plan and "RepartitionByExpression [user_id" in plan


def test_tasks_are_sized_by_pair_rows(spark):
    """A join of a few million pair rows is no longer left to the bytes that enter it."""
    df = spark.range(1)
    assert P.join_partitions(df, P.PAIR_ROWS_PER_TASK) is None
    assert P.join_partitions(df, 600_000_000) >= 120


@pytest.mark.parametrize("how, hot_bucket", [({"k": None}, 5), ({"k": None, "similarity": "jaccard"}, 4096), ({"k": 400}, 4096),
                                             ({"k": 30, "weighting": "nonzero_dev"}, 4096)])
def test_lookups_in_user_tasks_give_the_same_predictions(spark, monkeypatch, hot_bucket, how):
    train, test = (materialize(df, "table") for df in R.train_test(spark, SF001))
    cols = ["user_id", "item_id", "rating", "prediction"]
    want = _rows(K.predict(train, test, **how).select(*cols))
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 20_000)
    focus = K.Focus(train, test)
    focus.model.stats(hot_bucket=hot_bucket)
    if how["k"] is None:
        assert K._user_tasks(focus, None, how.get("similarity", "cosine"))
    assert _rows(K.predict(train, test, focus=focus, **how).select(*cols)) == want


def test_similarities_are_not_shuffled_for_the_lookup(spark, monkeypatch):
    train, test = (materialize(df, "table") for df in R.train_test(spark, SF001))
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 20_000)
    df = K.mae(K.predict(train, test, k=None))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan
    assert not any("hashpartitioning(user_id" in line and ", other_id" in line for line in plan.splitlines())


def test_a_user_with_very_many_requests_keeps_the_join_by_both_users(spark, monkeypatch):
    train, test = R.train_test(spark, SF001)
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 20_000)
    focus = K.Focus(train, test)
    assert K._user_tasks(focus, None, "cosine")
    monkeypatch.setattr(K, "PARTNERS_PER_TASK", focus.model.partner_bound() + 1)
    monkeypatch.setattr(K.Focus, "most_met", lambda self, k: K.PARTNERS_PER_TASK + 1)
    assert K._user_tasks(focus, None, "cosine") is None


def test_filters_before_rounding_keep_the_same_pairs(spark):
    x = [5e-11, 4.9999999999999995e-11, -5e-11, -4.9999999999999995e-11, 0.0, 1e-9, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = df.select((F.round("x", 10) != 0).alias("a"), (F.abs("x") >= S.LEAST_SIM).alias("b"),
                    (F.round("x", 10) > 0).alias("c"), (F.col("x") >= S.LEAST_SIM).alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in got)
