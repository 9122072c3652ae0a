"""Reliable-checkpoint materialisation gives the same answers; metrics sink writes JSON."""

import json
import os
import tempfile

from conftest import SF001
from tastegraph.operators import knn as K
from tastegraph.session import ensure_checkpoint_dir, materialize
from tastegraph.sources import ratings as R
from tastegraph.sources import sinks


def test_checkpointed_model_matches(spark):
    train, test = R.train_test(spark, SF001)
    a = K.mae(K.predict(train, test, k=100, cache="checkpoint")).first().mae
    b = K.mae(K.predict(train, test, k=100, cache="persist")).first().mae
    c = K.mae(K.predict(train, test, k=100, cache="none")).first().mae
    d = K.mae(K.predict(train, test, k=100, cache="table")).first().mae
    assert a == b == c == d == 1.297977907


def test_checkpoint_uses_session_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder
    df = materialize(spark.range(10), "checkpoint")
    assert df.count() == 10
    assert "LogicalRDD" in df._jdf.queryExecution().optimizedPlan().toString()


def test_table_mode_writes_parquet_in_session_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    df = materialize(spark.range(10).withColumnRenamed("id", "x"), "table")
    assert df.count() == 10
    files = df.inputFiles()
    assert files and all(folder.split(":", 1)[-1] in f for f in files)


def test_self_join_over_table_writes_one_shuffle(spark):
    """Both sides of the item self-join read the same written table: one exchange, reused."""
    from tastegraph.operators.similarity import prepare, cosine_similarity
    train, _ = R.train_test(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = prepare(train, cache="table")
        sims = cosine_similarity(nd=model.nd, n_hot=0)
        sims.collect()
        plan = sims._jdf.queryExecution().executedPlan()
        stages = []

        def walk(node):
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                return walk(node.executedPlan())
            if name.endswith("QueryStage"):
                stages.append(node.plan().nodeName())
                return walk(node.plan())
            seq = node.children()
            for i in range(seq.size()):
                walk(seq.apply(i))

        walk(plan)
        assert "ReusedExchange" in stages, stages
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metrics_sink_writes_json(spark):
    train, test = R.train_test(spark, SF001)
    sweep = K.knn_sweep(train, test, [10, 100])
    metrics = sinks.metric_rows("knn", sweep.filter("k = 10"), ["mae", "n"])
    out = tempfile.mkdtemp(prefix="tg-metrics-")
    sinks.write_metrics(metrics, out)
    rows = []
    for name in os.listdir(out):
        if name.endswith(".json"):
            rows += [json.loads(line) for line in open(os.path.join(out, name))]
    assert {(r["metric"], r["value"]) for r in rows} == {("mae", 1.380214986), ("n", 1088.0)}
    nested = sinks.nested_json(metrics).first()
    assert json.loads(nested.json) == {"mae": 1.380214986, "n": 1088.0}


def test_stored_inputs_are_not_copied(spark):
    """A split of stored ratings is read as it is; other inputs are stored once; all goes in the end."""
    from pyspark.sql import functions as F

    from tastegraph import session

    session.drop_tables()
    ratings = materialize(R.ratings_from_tables(spark, SF001), "table")
    train, test = R.holdout_split(ratings)
    assert session.is_stored(train) and session.is_stored(test)
    assert K._requested(train, "auto") is train
    personal = R.personal_from_part(spark, SF001)
    assert session.is_stored(R.with_personal(ratings, personal))
    assert not session.is_stored(train.withColumn("user_id", F.lit(7)))
    folders = list(session._FOLDERS)
    assert len(folders) == 1 and os.path.isdir(session.open_fs(folders[0])[1])
    session.drop_tables()
    assert not any(os.path.exists(session.open_fs(f)[1]) for f in folders) and not session._FOLDERS


def test_report_shares_one_ratings_table_and_one_model(spark):
    from tastegraph import session
    from tastegraph.plans.catalog import QUERIES

    session.drop_tables()
    rows = QUERIES["metrics_report"](spark, SF001).collect()
    names = [f.rsplit("/", 1)[1].split("-")[0] for f in session._FOLDERS]
    # ratings, the model's three tables, and the four answers that others are made of
    assert names.count("table") == 8 and names.count("metrics") == 1
    values = {(r.question, r.metric): r.value for r in rows}
    u = int(values["similarity_computation_count", "n_users"])
    assert values["knn_sweep", f"mae_k{u - 1}"] == values["mae_cosine", "mae"]
    session.drop_tables()
    assert not session._FOLDERS


def test_single_read_queries_store_nothing(spark):
    from tastegraph import session
    from tastegraph.plans.catalog import QUERIES

    session.drop_tables()
    for name in ("scan_ratings", "holdout_split", "distinct_users", "avg_per_user", "avg_per_item", "global_avg",
                 "user_item_sets", "similarity_computation_count", "ratings_with_personal"):
        QUERIES[name](spark, SF001)
    assert not session._FOLDERS
