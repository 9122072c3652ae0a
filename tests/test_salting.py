"""The block-salted self-join gives exactly the unsalted pair table."""

from pyspark.sql import functions as F

from conftest import SF001
from tastegraph.operators import similarity as S
from tastegraph.operators.pairs import hot_items
from tastegraph.sources import ratings as R


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_salted_cosine_equals_unsalted(spark):
    train, _ = R.train_test(spark, SF001)
    nd = S.preprocess(train)[2]
    # every item has more than 8 raters here, so every item is split into buckets
    assert hot_items(nd, 8).count() > 0
    plain = S.cosine_similarity(nd=nd, keep_zero=True)
    salted = S.cosine_similarity(nd=nd, keep_zero=True, hot_bucket=8)
    assert _rows(plain) == _rows(salted)


def test_salted_corated_counts_equal(spark):
    train, _ = R.train_test(spark, SF001)
    assert _rows(S.corated_counts(train)) == _rows(S.corated_counts(train, hot_bucket=5))


def test_salted_restricted_users(spark):
    train, test = R.train_test(spark, SF001)
    nd = S.preprocess(train)[2]
    users = test.select("user_id").distinct().orderBy("user_id").limit(7)
    plain = S.cosine_similarity(nd=nd, users=users)
    salted = S.cosine_similarity(nd=nd, users=users, hot_bucket=6)
    assert plain.select("user_id").distinct().count() <= 7
    assert _rows(plain) == _rows(salted)
    assert plain.filter(F.col("user_id") == F.col("other_id")).count() == 0


def test_salted_jaccard_equals_unsalted(spark):
    train, _ = R.train_test(spark, SF001)
    assert _rows(S.jaccard_similarity(train)) == _rows(S.jaccard_similarity(train, hot_bucket=5))


def test_salted_all_neighbour_prediction(spark, monkeypatch):
    """A hot item's requesters and raters are dealt to buckets: same predictions, both similarities."""
    from tastegraph.operators import knn as K

    train, test = R.train_test(spark, SF001)
    for similarity in ("cosine", "jaccard"):
        focus = K.Focus(train, test)
        plain = K.mae(K.predict(train, test, similarity=similarity, focus=focus)).first()
        split = K.Focus(train, test)
        split.model.stats(hot_bucket=5)
        assert split.model.stats()["n_hot_all"] > 0
        salted = K.predict(train, test, similarity=similarity, focus=split)
        assert "lb" in salted._jdf.queryExecution().optimizedPlan().toString()
        assert K.mae(salted).first() == plain


def test_one_users_request_copies_few_rows(spark):
    """The raters' side keeps only the items asked for, once for each left bucket in use."""
    from tastegraph.operators import pairs as P

    train, _ = R.train_test(spark, SF001)
    one = train.agg(F.min("user_id").alias("user_id"))
    rows = P.item_self_join(train, [], left_users=one, hot_bucket=4)
    items = train.join(one, "user_id", "left_semi").select("item_id")
    raters = train.join(items, "item_id", "left_semi").count()
    assert rows.count() == raters - items.count()  # each rater met once; the user itself is left out
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_hot_user_is_split(spark):
    """A stored table of averages lets AQE split the join at a user who holds most rows."""
    from tastegraph.session import materialize

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        base = spark.range(60000).select(
            F.when(F.col("id") < 50000, F.lit(1)).otherwise(F.col("id")).cast("long").alias("user_id"),
            F.col("id").alias("item_id"), (F.lit(1.0) + F.col("id") % 5).alias("rating"))
        ratings = materialize(base.repartition(8), "table")
        dev = S.deviations(ratings, materialize(S.user_averages(ratings), "table"))
        parts = dev.where("user_id = 1").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(parts) > 1 and sum(r["count"] for r in parts) == 50000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_two_phase_ranking_matches(spark, monkeypatch):
    """Pair-partitioned aggregation + partial top-k gives the same neighbours."""
    from tastegraph.operators import knn as K

    train, test = R.train_test(spark, SF001)
    one = K.mae(K.predict(train, test, k=30)).first().mae
    monkeypatch.setattr(K, "PARTNERS_PER_TASK", 0)
    plan = K.neighbours_table(train, 10)._jdf.queryExecution().executedPlan().toString()
    two = K.mae(K.predict(train, test, k=30)).first().mae
    assert one == two
    assert "WindowGroupLimit" in plan


def _with_hot_user(spark, hot_id=-7):
    """The fixture plus one user who rated every item (its rounded mean rating)."""
    train, test = R.train_test(spark, SF001)
    hot = (train.groupBy("item_id").agg(F.round(F.avg("rating")).alias("rating"))
           .select(F.lit(hot_id).cast("long").alias("user_id"), "item_id", "rating"))
    return train.select("user_id", "item_id", "rating").unionByName(hot), test, hot


def test_hot_user_paths_agree(spark, monkeypatch):
    """A user with a row for every item: two-phase ranking and the focused
    (broadcast-neighbour) request give the same predictions as the defaults."""
    from tastegraph.operators import knn as K
    from tastegraph.operators import stats as ST

    train, test, hot = _with_hot_user(spark)
    n_items = hot.count()
    assert train.filter(F.col("user_id") == -7).count() == n_items
    # outputs are compared at the engine's 9-decimal output precision: sums
    # run in plan-dependent order and differ in the last bit (~1e-16)
    cols = ["user_id", "item_id", F.round("prediction", 9).alias("prediction")]
    base = _rows(K.predict(train, test, k=30).select(*cols))
    hot_full = _rows(K.predict(train, test.unionByName(hot), k=30).filter("user_id = -7").select(*cols))
    hot_focused = _rows(K.predict(train, hot, k=30).select(*cols))
    assert len(hot_focused) == n_items and hot_focused == hot_full
    monkeypatch.setattr(K, "PARTNERS_PER_TASK", 0)
    assert _rows(K.predict(train, test, k=30).select(*cols)) == base
    sets = ST.user_item_sets(train).filter("user_id = -7").first()
    assert sets.n_items == n_items
