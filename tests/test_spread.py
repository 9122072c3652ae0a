"""Keys that hold most rows are dealt to several tasks, with unchanged results; closed forms and checked inputs."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastegraph.operators import knn as K
from tastegraph.operators import predict as P
from tastegraph.operators import similarity as S
from tastegraph.operators import spread
from tastegraph.operators import stats as ST
from tastegraph.session import materialize
from tastegraph.sources import ratings as R
from tastegraph.sources import sinks


@pytest.fixture
def plain_shuffles(spark):
    """No coalescing, no broadcasts: where rows go is where their key sends them."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot_user(spark):
    """User 1 has 5000 of 6000 ratings."""
    base = spark.range(6000).select(F.when(F.col("id") < 5000, F.lit(1)).otherwise(F.col("id") % 50 + 2).cast("long").alias("user_id"),
                                    F.col("id").alias("item_id"), (F.lit(1.0) + F.col("id") % 5).alias("rating"))
    return materialize(base.repartition(4), "table")


def _rows(df, digits=9):
    return sorted(tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect())


def _parts(df, condition):
    return df.where(condition).select(F.spark_partition_id().alias("p")).distinct().count()


def test_a_dominant_users_rows_are_in_several_partitions(spark, hot_user, plain_shuffles, monkeypatch):
    def five():
        dev = S.deviations(hot_user)
        nd = S.preprocess(hot_user)[2]
        some = dev.join(hot_user.select("item_id").filter("item_id % 2 = 0"), "item_id", "left_semi")
        return {"rating_deviations": dev, "normalized_deviations": nd, "user_norms": S.user_norms(dev),
                "user_vectors": ST.user_vectors(nd), "dev_for_test_items": some}
    plain = {name: _rows(df) for name, df in five().items()}
    assert _parts(S.deviations(hot_user), "user_id = 1") == 1
    monkeypatch.setattr(spread, "SPREAD_ROWS", 200)
    for name, df in five().items():
        assert _rows(df) == plain[name], name
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "share" in plan, name
        if name in ("rating_deviations", "normalized_deviations"):
            assert _parts(df, "user_id = 1") > 4, name


def test_jaccard_and_the_model_with_a_dominant_user(spark, monkeypatch):
    train, test = R.train_test(spark, SF001)
    hot = (train.groupBy("item_id").agg(F.round(F.avg("rating")).alias("rating"))
           .select(F.lit(-7).cast("long").alias("user_id"), "item_id", "rating"))
    train = materialize(train.select("user_id", "item_id", "rating").unionByName(hot), "table")
    plain = _rows(S.jaccard_similarity(train)), _rows(K.predict(train, test, k=5).select("user_id", "item_id", "prediction"))
    monkeypatch.setattr(spread, "SPREAD_ROWS", 20)
    assert (_rows(S.jaccard_similarity(train)), _rows(K.predict(train, test, k=5).select("user_id", "item_id", "prediction"))) == plain


def test_model_statistics_with_a_hot_item(spark, monkeypatch):
    """One item holds most rows: its rows are dealt by user before they meet its count."""
    rows = [(u, 1, float(1 + u % 5)) for u in range(800)] + [(u, 2 + u % 7, float(1 + u % 3)) for u in range(200)]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    plain = S.prepare(ratings).stats()
    monkeypatch.setattr(spread, "SPREAD_ROWS", 50)
    dealt = []
    real = spread.spread_join
    monkeypatch.setattr(S, "spread_join", lambda *a, **kw: dealt.append(real(*a, **kw)) or dealt[-1])
    assert S.prepare(ratings).stats() == plain
    assert "share" in dealt[-1]._jdf.queryExecution().optimizedPlan().toString()


def test_a_hot_requester_is_dealt_to_several_tasks(spark, plain_shuffles, monkeypatch):
    """One user asks for most items: each share of the requests has its own copy of the neighbours."""
    train, test = R.train_test(spark, SF001)
    user = train.agg(F.min("user_id")).first()[0]
    every = train.select(F.lit(user).alias("user_id"), "item_id").distinct()
    asked = materialize(test.select("user_id", "item_id").unionByName(every), "table")
    cols = ["user_id", "item_id", "prediction"]
    plain = _rows(K.predict(train, asked, k=10).select(*cols))
    monkeypatch.setattr(P, "REQUESTS_PER_TASK", 20)
    dealt = K.predict(train, asked, k=10).select(*cols)
    assert _rows(dealt) == plain
    assert "share" in dealt._jdf.queryExecution().optimizedPlan().toString()
    met = spread.spread_join(asked, train.select("user_id", F.col("item_id").alias("x")).distinct(), "user_id", "item_id",
                             sizes=asked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), n="n", most=20)
    assert _parts(met, F.col("user_id") == user) > 2


def test_outer_joins_keep_rows_without_a_partner(spark, monkeypatch):
    rows = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 1), (None, 3)], "k long, by long")
    other = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    sizes = spark.createDataFrame([(1, 30), (2, 1)], "k long, n long")
    want = _str(rows.join(other, "k", "left"))
    assert _str(spread.spread_join(rows, other, "k", "by", sizes, "n", "left", most=4)) == want


def _str(df):
    return sorted(map(str, df.collect()))


def test_closed_forms_equal_the_pair_table(spark):
    train = materialize(R.train_test(spark, SF001)[0].select("user_id", "item_id", "rating"), "table")
    twice = train.unionByName(train.filter("item_id % 3 = 0"))  # repeated ratings count each time
    dense = spark.createDataFrame([(u, i, 1.0) for u in range(6) for i in range(u + 1)], "user_id long, item_id long, rating double")
    for ratings in (train, twice, dense, train.limit(0)):
        closed = ST.corated_stats(ratings)
        assert _rows(closed) == _rows(ST.corated_stats(ratings, S.corated_counts(ratings)))
        n = K.count_users(ratings)
        assert _rows(ST.similarity_bytes(S.corated_counts(ratings, pair="lt"), n)) == _rows(ST.similarity_bytes(S.corated_counts(ratings)))
    plan = ST.corated_stats(train)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 1 and "<=" not in joins[0] and "<" in joins[0], plan  # only pairs u < v are joined


def test_self_join_is_sized_by_its_rows(spark, monkeypatch):
    from tastegraph.operators import pairs

    train = materialize(R.train_test(spark, SF001)[0], "table")
    want = _rows(S.corated_counts(train))
    monkeypatch.setattr(pairs, "PAIR_ROWS_PER_TASK", 1000)
    wide = S.corated_counts(train)
    assert "RepartitionByExpression" in wide._jdf.queryExecution().optimizedPlan().toString()
    assert _rows(wide) == want


def test_a_population_below_the_users_present_is_refused(spark):
    train, _ = R.train_test(spark, SF001)
    n = K.count_users(train)
    assert K.neighbours_table(train, 3, n_users=n).count() > 0
    with pytest.raises(ValueError, match="declared"):
        K.neighbours_table(train, 3, n_users=n - 1)


def test_the_sink_refuses_too_many_rows(spark, tmp_path):
    rows = spark.range(20).select(F.lit("q").alias("question"), F.col("id").cast("string").alias("metric"), F.col("id").cast("double").alias("value"))
    path = str(tmp_path / "metrics")
    with pytest.raises(ValueError, match="at most 19"):
        sinks.write_metrics(rows, path, most=19)
    assert not (tmp_path / "metrics").exists()
    sinks.write_metrics(rows, path, most=20)
    assert sinks.read_metrics(spark, path).count() == 20
    assert len(list((tmp_path / "metrics").glob("part-*"))) == 1
