"""Named queries over the rating table derived from the order tables.

Every query reads ``lineitem``/``orders`` (and ``part`` for the personal
list) from ``sf_dir`` and runs over the whole tables. DOUBLE outputs are
rounded to 9 decimals (similarities to 10) so that a second engine summing in
another order produces the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import round_out
from ..operators import knn as K
from ..operators import similarity as S
from ..operators import stats as ST
from ..session import mark_stored, materialize, new_folder
from ..sources import ratings as R
from ..sources import sinks

# Fixed parameters of the registered queries: the k values of the sweep, the
# MAE baseline the sweep is compared with, the k of the neighbour table and of
# the prediction table, and the recommendation size.
SWEEP_KS = [10, 30, 50, 100, 200, 300, 400, 800]  # and the number of users less one
BASELINE_MAE = 1.30
NEIGHBOUR_K = 10
PREDICTION_K = 100
TOP_N = 5


def _ratings(spark, sf):
    # read by several jobs of one query (model statistics, requested-user count,
    # the main job), so it is stored once
    return materialize(R.ratings_from_tables(spark, sf), "auto")


def _tt(spark, sf):
    return R.holdout_split(_ratings(spark, sf))


def _train(spark, sf):
    # for queries that read it once: nothing is stored
    return R.holdout_split(R.ratings_from_tables(spark, sf))[0]


def _sweep_ks(n_users):
    return sorted({*SWEEP_KS, n_users - 1})


def q_scan_ratings(spark, sf):
    return R.ratings_from_tables(spark, sf)


def _through_text(sep):
    def run(spark, sf):
        path = new_folder(spark, "text")
        sinks.write_delimited(R.ratings_from_tables(spark, sf), path, sep)
        return R.read_ratings_text(spark, path, sep)
    return run


def q_personal_text(spark, sf):
    path = new_folder(spark, "personal")
    sinks.write_quoted(_personal(spark, sf), path)
    return R.read_personal(spark, path)


def q_row_count_check(spark, sf):
    ratings = _ratings(spark, sf)
    train, test = R.holdout_split(ratings)
    R.expect_row_count(train.unionByName(test), ratings.count())
    R.expect_unique(ratings)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in (("ratings", ratings), ("train", train), ("test", test))]
    return sinks.union_metrics(parts)


def q_holdout_split(spark, sf):
    return R.with_holdout_flag(R.ratings_from_tables(spark, sf))


def q_distinct_users(spark, sf):
    return ST.distinct_users(_train(spark, sf))


def q_avg_per_user(spark, sf):
    avg = S.average_per(_train(spark, sf), "users")
    return avg.select("user_id", round_out("avg_rating").alias("avg_rating"), "n_ratings")


def q_avg_per_item(spark, sf):
    avg = S.average_per(_train(spark, sf), "items")
    return avg.select("item_id", round_out("avg_rating").alias("avg_rating"), "n_ratings")


def q_global_avg(spark, sf):
    g = S.global_average(_train(spark, sf))
    return g.select(round_out("global_avg").alias("global_avg"), "n_ratings")


def q_rating_deviations(spark, sf):
    dev = S.deviations(_tt(spark, sf)[0])
    return dev.select("user_id", "item_id", "rating", round_out("avg_rating").alias("avg_rating"),
                      round_out("dev").alias("dev"))


def q_user_norms(spark, sf):
    n = S.user_norms(S.deviations(_tt(spark, sf)[0]))
    return n.select("user_id", round_out("l2_norm").alias("l2_norm"), round_out("l1_norm").alias("l1_norm"))


def q_normalized_deviations(spark, sf):
    _, _, nd = S.preprocess(_tt(spark, sf)[0])
    return nd.select("user_id", "item_id", round_out("nd").alias("nd"))


def q_dev_for_test_items(spark, sf):
    train, test = _tt(spark, sf)
    dev = S.deviations(train).join(test.select("item_id"), "item_id", "left_semi")
    return dev.select("user_id", "item_id", round_out("dev").alias("dev"))


def q_user_item_sets(spark, sf):
    return ST.user_item_sets(_train(spark, sf))


def q_user_vectors(spark, sf):
    return ST.user_vectors(S.preprocess(_tt(spark, sf)[0])[2])


def q_cosine_similarity(spark, sf):
    train = _tt(spark, sf)[0]
    return S.cosine_similarity(train, keep_zero=True)


def q_jaccard_similarity(spark, sf):
    return S.jaccard_similarity(_tt(spark, sf)[0])


def q_corated_counts(spark, sf):
    return S.corated_counts(_tt(spark, sf)[0])


def q_corated_stats(spark, sf):
    return ST.corated_stats(_tt(spark, sf)[0])


def q_corated_nonzero_bytes(spark, sf):
    train = _tt(spark, sf)[0]
    return ST.similarity_bytes(S.corated_counts(train, pair="lt"), K.count_users(train))


def q_similarity_computation_count(spark, sf):
    return ST.similarity_cost(_train(spark, sf))


def q_topk_bytes(spark, sf):
    train = _tt(spark, sf)[0]
    return ST.topk_bytes(train, _sweep_ks(K.count_users(train)))


def q_knn_neighbours(spark, sf):
    return K.neighbours_table(_tt(spark, sf)[0], NEIGHBOUR_K)


def q_knn_predictions(spark, sf):
    train, test = _tt(spark, sf)
    p = K.predict(train, test, k=PREDICTION_K)
    return p.select("user_id", "item_id", "rating", round_out("prediction").alias("prediction"))


def q_knn_neighbours_declared(spark, sf):
    # a declared population of twice the users: the others share no item with anybody
    train = _tt(spark, sf)[0]
    return K.neighbours_table(train, NEIGHBOUR_K, n_users=2 * K.count_users(train))


def q_knn_predictions_repeated(spark, sf):
    train, test = _tt(spark, sf)
    twice = mark_stored(test.unionByName(test), test)
    p = K.predict(train, twice, k=PREDICTION_K)
    return p.select("user_id", "item_id", "rating", round_out("prediction").alias("prediction"))


def q_knn_predictions_scale10(spark, sf):
    # ratings doubled, on a scale from 0 to 10, for some neighbours and for all
    train, test = (mark_stored(df.withColumn("rating", F.col("rating") * 2), df) for df in _tt(spark, sf))
    focus = K.Focus(train, test, r_min=0.0, r_max=10.0)
    some = K.predict(train, test, k=PREDICTION_K, r_min=0.0, r_max=10.0, focus=focus)
    every = K.predict(train, test, k=None, r_min=0.0, r_max=10.0, focus=focus)
    # one after the other: what the first shuffled is removed before the second
    return _stored_mae(some.withColumn("method", F.lit("k")), ["method"]).unionByName(
        _stored_mae(every.withColumn("method", F.lit("all")), ["method"]))


def q_item_deviation_nonzero(spark, sf):
    train, test = _tt(spark, sf)
    d = K.item_deviation(train, test, k=PREDICTION_K, weighting="nonzero_dev")
    return d.select("user_id", "item_id", round_out("dev_hat").alias("dev_hat"))


def q_mae_cosine(spark, sf):
    train, test = _tt(spark, sf)
    return K.mae(K.predict(train, test, k=None))


def q_mae_jaccard(spark, sf):
    train, test = _tt(spark, sf)
    return K.mae(K.predict(train, test, k=None, similarity="jaccard"))


def _stored_mae(predictions, by=None):
    return materialize(K.mae(predictions, by=by), "auto")


def _mae_knn(k, weighting="raters"):
    def run(spark, sf):
        train, test = _tt(spark, sf)
        p = K.predict(train, test, k=k, weighting=weighting)
        return K.mae(p.withColumn("k", F.lit(k)), by=["k"])
    return run


def q_knn_sweep(spark, sf):
    train, test = _tt(spark, sf)
    focus = K.Focus(train, test)
    return K.knn_sweep(train, test, _sweep_ks(focus.n_users), focus=focus)


def q_lowest_k_better(spark, sf):
    return K.lowest_k_better(q_knn_sweep(spark, sf), BASELINE_MAE)


def q_mae_vs_baseline(spark, sf):
    train, test = _tt(spark, sf)
    focus = K.Focus(train, test)
    cos = _stored_mae(K.predict(train, test, focus=focus)).select(F.lit("cosine").alias("method"), "mae")
    jac = _stored_mae(K.predict(train, test, similarity="jaccard", focus=focus)).select(F.lit("jaccard").alias("method"), "mae")
    return cos.unionByName(jac).select(
        "method", "mae", F.lit(BASELINE_MAE).alias("baseline"),
        round_out(F.col("mae") - F.lit(BASELINE_MAE)).alias("diff"))


def _personal(spark, sf):
    return R.personal_from_part(spark, sf)


def q_predict_cold_user(spark, sf):
    # the personal user has no rating in the corpus: a cold user for every candidate
    ratings = _ratings(spark, sf)
    cands = R.personal_candidates(_personal(spark, sf)).select("user_id", "item_id")
    p = K.predict(ratings, cands, k=30, cold_user="global_mean")
    return p.select("user_id", "item_id", round_out("prediction").alias("prediction"))


def q_personal_ratings(spark, sf):
    return R.personal_rated(_personal(spark, sf))


def q_personal_candidates(spark, sf):
    personal = _personal(spark, sf)
    catalogue = personal.select(F.lit(R.PERSONAL_USER_ID).cast("long").alias("user_id"), "item_id", "title")
    return R.without_rated(catalogue, R.personal_rated(personal)).select("user_id", "item_id", "title")


def q_ratings_with_personal(spark, sf):
    return R.with_personal(R.ratings_from_tables(spark, sf), _personal(spark, sf))


def _recommend(k):
    def run(spark, sf):
        personal = _personal(spark, sf)
        data = R.with_personal(_ratings(spark, sf), personal)
        return K.recommend(data, R.personal_candidates(personal), n=TOP_N, k=k)
    return run


def _metrics(spark, sf):
    # one ratings table and one model for all answers
    train, test = _tt(spark, sf)
    focus = K.Focus(train, test)
    u = focus.n_users
    cos = _stored_mae(K.predict(train, test, focus=focus))
    jac = _stored_mae(K.predict(train, test, similarity="jaccard", focus=focus))
    both = cos.withColumn("method", F.lit("c")).unionByName(jac.withColumn("method", F.lit("j"))).agg(
        *[F.max(F.when(F.col("method") == m, F.col("mae"))).alias(m) for m in ("c", "j")])
    diff = both.select(round_out(F.col("c") - F.lit(BASELINE_MAE)).alias("cosine_minus_baseline"),
                       round_out(F.col("j") - F.col("c")).alias("jaccard_minus_cosine"))
    sums = materialize(ST.corated_sums(S.corated_counts(train)), "auto")
    sweep = materialize(K.knn_sweep(train, test, _sweep_ks(u), focus=focus), "auto")
    memory = ST.topk_bytes(train, _sweep_ks(u))
    per_k = lambda df, question, name, value: df.select(
        F.lit(question).alias("question"), F.concat(F.lit(name), F.col("k").cast("string")).alias("metric"),
        F.col(value).cast("double").alias("value"))
    return sinks.union_metrics([
        sinks.metric_rows("mae_cosine", cos, ["mae"]),
        sinks.metric_rows("mae_jaccard", jac, ["mae"]),
        sinks.metric_rows("differences", diff, diff.columns),
        sinks.metric_rows("corated_stats", ST.corated_stats(train, sums=sums),
                          ["n_pairs", "min_co", "max_co", "avg_co", "stddev_co"]),
        sinks.metric_rows("nonzero_bytes", ST.similarity_bytes(sums=sums), ["n_nonzero", "bytes"]),
        sinks.metric_rows("similarity_computation_count", ST.similarity_cost(train), ["n_users", "n_computations"]),
        per_k(sweep, "knn_sweep", "mae_k", "mae"),
        sinks.metric_rows("lowest_k", K.lowest_k_better(sweep, BASELINE_MAE), ["k", "diff"]),
        per_k(memory, "topk_bytes", "bytes_k", "bytes"),
        per_k(memory, "users_in_ram", "users_k", "max_users_in_ram"),
    ])


def q_metrics_report(spark, sf):
    path = new_folder(spark, "metrics")
    sinks.write_metrics(_metrics(spark, sf), path)
    return sinks.read_metrics(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_ratings": q_scan_ratings,
    "scan_ratings_tab": _through_text("\t"),
    "scan_ratings_separator": _through_text("::"),
    "personal_text": q_personal_text,
    "row_count_check": q_row_count_check,
    "holdout_split": q_holdout_split,
    "distinct_users": q_distinct_users,
    "avg_per_user": q_avg_per_user,
    "avg_per_item": q_avg_per_item,
    "global_avg": q_global_avg,
    "rating_deviations": q_rating_deviations,
    "user_norms": q_user_norms,
    "normalized_deviations": q_normalized_deviations,
    "dev_for_test_items": q_dev_for_test_items,
    "user_item_sets": q_user_item_sets,
    "user_vectors": q_user_vectors,
    "cosine_similarity": q_cosine_similarity,
    "jaccard_similarity": q_jaccard_similarity,
    "corated_counts": q_corated_counts,
    "corated_stats": q_corated_stats,
    "corated_nonzero_bytes": q_corated_nonzero_bytes,
    "similarity_computation_count": q_similarity_computation_count,
    "topk_bytes": q_topk_bytes,
    "knn_neighbours": q_knn_neighbours,
    "knn_neighbours_declared": q_knn_neighbours_declared,
    "knn_predictions": q_knn_predictions,
    "knn_predictions_repeated": q_knn_predictions_repeated,
    "knn_predictions_scale10": q_knn_predictions_scale10,
    "item_deviation_nonzero": q_item_deviation_nonzero,
    "mae_cosine": q_mae_cosine,
    "mae_jaccard": q_mae_jaccard,
    "mae_knn_k10": _mae_knn(10),
    "mae_knn_k100": _mae_knn(100),
    "mae_knn_k300": _mae_knn(300),
    "mae_knn_nonzero_k100": _mae_knn(100, "nonzero_dev"),
    "mae_knn_nonzero_k200": _mae_knn(200, "nonzero_dev"),
    "knn_sweep": q_knn_sweep,
    "lowest_k_better": q_lowest_k_better,
    "mae_vs_baseline": q_mae_vs_baseline,
    "predict_cold_user": q_predict_cold_user,
    "personal_ratings": q_personal_ratings,
    "personal_candidates": q_personal_candidates,
    "ratings_with_personal": q_ratings_with_personal,
    "recommend_top5_k30": _recommend(30),
    "recommend_top5_k300": _recommend(300),
    "metrics_report": q_metrics_report,
}
