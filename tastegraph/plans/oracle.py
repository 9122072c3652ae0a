"""Reference SQL for every registered query (DuckDB dialect).

The statements are an independent, plain-SQL statement of the same
definitions -- they share no code with the DataFrame implementation -- and
are used by the correctness check on the same Parquet tables. Column names
and types are chosen to equal the DataFrame results.
"""

from __future__ import annotations

# Fixed parameters, stated here again so that a change of the queries' own shows.
SWEEP = "10, 30, 50, 100, 200, 300, 400, 800"
BASELINE_MAE, NEIGHBOUR_K, PREDICTION_K, TOP_N = "1.3", 10, 100, 5
KS = f"""
ks AS (SELECT CAST(unnest([{SWEEP}]) AS INTEGER) AS k UNION SELECT CAST(count(DISTINCT user_id) - 1 AS INTEGER) FROM train)"""

BASE = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(max(ceil(l_quantity / 10)) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2),
flagged AS (
  SELECT user_id, item_id, rating,
         substr(md5(concat(CAST(user_id AS VARCHAR), ':', CAST(item_id AS VARCHAR))), 1, 2) < '33' AS is_test
  FROM ratings),
train AS (SELECT user_id, item_id, rating FROM flagged WHERE NOT is_test),
test AS (SELECT user_id, item_id, rating FROM flagged WHERE is_test),
personal AS (
  SELECT p_partkey AS item_id, p_name AS title,
         CASE WHEN p_partkey % 37 = 0 THEN CAST(1 + p_partkey % 5 AS DOUBLE) END AS rating
  FROM part),
data AS (
  SELECT user_id, item_id, rating FROM ratings
  UNION ALL
  SELECT CAST(-1 AS BIGINT), item_id, rating FROM personal WHERE rating IS NOT NULL),
cands AS (SELECT CAST(-1 AS BIGINT) AS user_id, item_id, title FROM personal WHERE rating IS NULL)"""


def _scale(x: str, a: str, low: int = 1, high: int = 5) -> str:
    return f"(CASE WHEN {x} > {a} THEN {high} - {a} WHEN {x} < {a} THEN {a} - {low} ELSE 1 END)"


def prep(src: str = "train", low: int = 1, high: int = 5, users: str = "count(DISTINCT user_id)") -> str:
    """Averages, deviations, normalised deviations and cosine pairs of ``src``."""
    return f"""
ua AS (SELECT user_id, avg(rating) AS avg_rating, count(*) AS n_ratings FROM {src} GROUP BY 1),
dev AS (
  SELECT s.user_id, s.item_id, s.rating, ua.avg_rating,
         (s.rating - ua.avg_rating) / {_scale('s.rating', 'ua.avg_rating', low, high)} AS dev
  FROM {src} s JOIN ua USING (user_id)),
sq AS (SELECT user_id, sum(dev * dev) AS sq FROM dev GROUP BY 1),
nd AS (
  SELECT d.user_id, d.item_id, CASE WHEN sq.sq > 0 THEN d.dev / sqrt(sq.sq) ELSE 0 END AS nd
  FROM dev d JOIN sq USING (user_id)),
nusers AS (SELECT {users} AS n FROM {src})"""


SIMS = """
sims AS (
  SELECT a.user_id, b.user_id AS other_id, round(sum(a.nd * b.nd), 10) AS sim
  FROM nd a JOIN nd b ON a.item_id = b.item_id AND a.user_id <> b.user_id
  WHERE a.nd <> 0 AND b.nd <> 0
  GROUP BY 1, 2
  HAVING round(sum(a.nd * b.nd), 10) <> 0)"""

JACCARD = """
cnt AS (SELECT user_id, count(*) AS n FROM train GROUP BY 1),
co AS (
  SELECT a.user_id, b.user_id AS other_id, count(*) AS n_co
  FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <> b.user_id
  GROUP BY 1, 2),
jac AS (
  SELECT co.user_id, co.other_id, round(CAST(n_co AS DOUBLE) / (ca.n + cb.n - n_co), 10) AS sim
  FROM co JOIN cnt ca ON ca.user_id = co.user_id JOIN cnt cb ON cb.user_id = co.other_id)"""


def ranked(sims: str = "sims") -> str:
    """Effective neighbour rank: positives first, then all zeros, then negatives."""
    return f"""
nb AS (
  SELECT user_id, other_id, sim,
         row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, other_id) AS eff_rank
  FROM {sims} WHERE sim > 0
  UNION ALL
  SELECT user_id, other_id, sim,
         (SELECT n FROM nusers) - 1 - count(*) OVER (PARTITION BY user_id)
         + row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, other_id) AS eff_rank
  FROM {sims} WHERE sim < 0)"""


def _finish(name: str, src: str, low: int = 1, high: int = 5) -> str:
    dh = "(CASE WHEN coalesce(den, 0) > 0 THEN num / den ELSE 0 END)"
    return f"""
{name} AS (
  SELECT *, avg_rating + {dh} * {_scale(f'avg_rating + {dh}', 'avg_rating', low, high)} AS prediction
  FROM {src})"""


def knn_pred(k: int, pairs: str = "test", weighting: str = "raters", extra: str = "t.rating",
             low: int = 1, high: int = 5) -> str:
    counted = "d.dev IS NOT NULL" + (" AND d.dev <> 0" if weighting == "nonzero_dev" else "")
    cols = f"t.user_id, t.item_id, {extra + ', ' if extra else ''}ua.avg_rating"
    return f"""
acc AS (
  SELECT {cols},
         sum(CASE WHEN {counted} THEN nb.sim * d.dev END) AS num,
         sum(CASE WHEN {counted} THEN abs(nb.sim) END) AS den
  FROM {pairs} t JOIN ua USING (user_id)
  LEFT JOIN nb ON nb.user_id = t.user_id AND nb.eff_rank <= {k}
  LEFT JOIN dev d ON d.user_id = nb.other_id AND d.item_id = t.item_id
  GROUP BY ALL),{_finish('pred', 'acc', low, high)}"""


def all_pred(selfs: str, sims: str) -> str:
    return f"""
allsims AS (SELECT user_id, other_id, sim FROM {sims} UNION ALL SELECT * FROM {selfs} WHERE sim <> 0),
contrib AS (
  SELECT t.user_id, t.item_id, sum(s.sim * d.dev) AS num, sum(abs(s.sim)) AS den
  FROM test t JOIN dev d ON d.item_id = t.item_id
  JOIN allsims s ON s.user_id = t.user_id AND s.other_id = d.user_id
  GROUP BY 1, 2),
acc AS (
  SELECT t.user_id, t.item_id, t.rating, ua.avg_rating, c.num, c.den
  FROM test t JOIN ua USING (user_id) LEFT JOIN contrib c USING (user_id, item_id)),{_finish('pred', 'acc')}"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") if i == 0 else c for i, c in enumerate(ctes))


MAE = "SELECT round(avg(abs(prediction - rating)), 9) AS mae, count(*) AS n FROM pred"
SELF_COS = "\nselfs AS (SELECT user_id, user_id AS other_id, round(sum(nd * nd), 10) AS sim FROM nd GROUP BY 1)"
SELF_JAC = ("\nselfs AS (SELECT DISTINCT user_id, user_id AS other_id, CAST(1.0 AS DOUBLE) AS sim "
            "FROM train)")


def _mae_cosine() -> str:
    return w(BASE, prep(), SIMS, SELF_COS, all_pred("selfs", "sims")) + "\n" + MAE


def _mae_jaccard() -> str:
    return w(BASE, prep(), JACCARD, SELF_JAC, all_pred("selfs", "jac")) + "\n" + MAE


def _mae_knn(k: int, weighting: str = "raters") -> str:
    return (w(BASE, prep(), SIMS, ranked(), knn_pred(k, weighting=weighting))
            + f"\nSELECT {k} AS k, round(avg(abs(prediction - rating)), 9) AS mae, count(*) AS n FROM pred")


def _sweep_cte() -> str:
    return KS + f""",
acc AS (
  SELECT ks.k, t.user_id, t.item_id, t.rating, ua.avg_rating,
         sum(CASE WHEN d.dev IS NOT NULL THEN nb.sim * d.dev END) AS num,
         sum(CASE WHEN d.dev IS NOT NULL THEN abs(nb.sim) END) AS den
  FROM test t JOIN ua USING (user_id) CROSS JOIN ks
  LEFT JOIN nb ON nb.user_id = t.user_id AND nb.eff_rank <= ks.k
  LEFT JOIN dev d ON d.user_id = nb.other_id AND d.item_id = t.item_id
  GROUP BY ALL),{_finish('pred', 'acc')},
sweep AS (SELECT k, round(avg(abs(prediction - rating)), 9) AS mae, count(*) AS n FROM pred GROUP BY k)"""


def _sweep() -> str:
    return w(BASE, prep(), SIMS, ranked(), _sweep_cte()) + "\nSELECT k, mae, n FROM sweep"


def _lowest_k() -> str:
    b = f"CAST({BASELINE_MAE} AS DOUBLE)"
    return (w(BASE, prep(), SIMS, ranked(), _sweep_cte())
            + f"""
SELECT {b} AS baseline, min(k) AS k, arg_min(mae, k) AS mae, round(arg_min(mae, k) - {b}, 9) AS diff
FROM sweep WHERE mae < {b}""")


def _corated() -> str:
    return """
corated AS (
  SELECT a.user_id, b.user_id AS other_id, count(*) AS n_co
  FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <= b.user_id
  GROUP BY 1, 2)"""


def _recommend(k: int) -> str:
    cands = "\ncpairs AS (SELECT user_id, item_id, title FROM cands)"
    return (w(BASE, prep("data"), SIMS, ranked(), cands, knn_pred(k, pairs="cpairs", extra="t.title"))
            + f"""
SELECT user_id, rank, item_id, title, score FROM (
  SELECT user_id, item_id, title, round(prediction, 9) AS score,
         row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 9) DESC, item_id) AS rank
  FROM pred) WHERE rank <= {TOP_N}""")


def _cold_user() -> str:
    # the personal user is absent from the corpus: no neighbours, global mean
    return w(BASE) + """
SELECT c.user_id, c.item_id, round(coalesce(ua.avg_rating, g.g), 9) AS prediction
FROM cands c LEFT JOIN (SELECT user_id, avg(rating) AS avg_rating FROM ratings GROUP BY 1) ua USING (user_id)
CROSS JOIN (SELECT avg(rating) AS g FROM ratings) g"""


def _stats_cte() -> str:
    return _corated() + """,
st AS (
  SELECT (SELECT count(DISTINCT user_id) FROM train) AS u, count(*) AS nz, min(n_co) AS mn, max(n_co) AS mx,
         sum(CAST(n_co AS DOUBLE)) AS s1, sum(CAST(n_co * n_co AS DOUBLE)) AS s2
  FROM corated),
corated_stats AS (
  SELECT CAST(u * (u + 1) // 2 AS BIGINT) AS n_pairs,
         CAST(CASE WHEN nz < u * (u + 1) // 2 THEN 0 ELSE mn END AS BIGINT) AS min_co,
         CAST(mx AS BIGINT) AS max_co,
         round(s1 / (u * (u + 1) // 2), 9) AS avg_co,
         round(sqrt(greatest(s2 / (u * (u + 1) // 2) - (s1 / (u * (u + 1) // 2)) ** 2, 0)), 9) AS stddev_co
  FROM st)"""


def _scale10() -> str:
    doubled = "\ntrain2 AS (SELECT user_id, item_id, rating * 2 AS rating FROM train)," \
              "\ntest2 AS (SELECT user_id, item_id, rating * 2 AS rating FROM test)"
    return (w(BASE, doubled, prep("train2", 0, 10), SIMS, ranked(), SELF_COS, knn_pred(PREDICTION_K, "test2", low=0, high=10),
              _all_named("cos", "selfs", "sims", "test2", 0, 10)) + """
SELECT 'k' AS method, round(avg(abs(prediction - rating)), 9) AS mae, count(*) AS n FROM pred
UNION ALL SELECT 'all', round(avg(abs(prediction - rating)), 9), count(*) FROM cos""")


def _metrics() -> str:
    return (w(BASE, prep(), SIMS, SELF_COS, ranked(), _sweep_cte(), _stats_cte(), JACCARD,
              "\nselfj AS (SELECT DISTINCT user_id, user_id AS other_id, CAST(1.0 AS DOUBLE) AS sim FROM train)",
              _all_named("cos", "selfs", "sims"), _all_named("jacp", "selfj", "jac"),
              "\ncm AS (SELECT round(avg(abs(prediction - rating)), 9) AS c FROM cos)",
              "\njm AS (SELECT round(avg(abs(prediction - rating)), 9) AS j FROM jacp)",
              "\nlow AS (SELECT min(k) AS k, arg_min(mae, k) AS mae FROM sweep WHERE mae < CAST(1.3 AS DOUBLE))",
              "\nnu AS (SELECT count(DISTINCT user_id) AS n FROM train)")
            + """
SELECT 'differences' AS question, 'cosine_minus_baseline' AS metric, round(c - CAST(1.3 AS DOUBLE), 9) AS value FROM cm
UNION ALL SELECT 'differences', 'jaccard_minus_cosine', round(j - c, 9) FROM cm, jm
UNION ALL SELECT 'nonzero_bytes', 'n_nonzero', CAST(count(*) AS DOUBLE) FROM corated
UNION ALL SELECT 'nonzero_bytes', 'bytes', CAST(count(*) * 8 AS DOUBLE) FROM corated
UNION ALL SELECT 'lowest_k', 'k', CAST(k AS DOUBLE) FROM low
UNION ALL SELECT 'lowest_k', 'diff', round(mae - CAST(1.3 AS DOUBLE), 9) FROM low
UNION ALL SELECT 'topk_bytes', 'bytes_k' || k, CAST(n * k * 8 AS DOUBLE) FROM ks, nu
UNION ALL SELECT 'users_in_ram', 'users_k' || k, round(1.7179860388e10 / (k * 8 * 3), 9) FROM ks, nu
UNION ALL
SELECT 'mae_cosine' AS question, 'mae' AS metric, round(avg(abs(prediction - rating)), 9) AS value FROM cos
UNION ALL
SELECT 'mae_jaccard', 'mae', round(avg(abs(prediction - rating)), 9) FROM jacp
UNION ALL
SELECT 'corated_stats', 'n_pairs', CAST(n_pairs AS DOUBLE) FROM corated_stats
UNION ALL SELECT 'corated_stats', 'min_co', CAST(min_co AS DOUBLE) FROM corated_stats
UNION ALL SELECT 'corated_stats', 'max_co', CAST(max_co AS DOUBLE) FROM corated_stats
UNION ALL SELECT 'corated_stats', 'avg_co', avg_co FROM corated_stats
UNION ALL SELECT 'corated_stats', 'stddev_co', stddev_co FROM corated_stats
UNION ALL
SELECT 'similarity_computation_count', 'n_users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM train
UNION ALL
SELECT 'similarity_computation_count', 'n_computations',
       CAST(count(DISTINCT user_id) * (count(DISTINCT user_id) - 1) // 2 + count(DISTINCT user_id) AS DOUBLE)
FROM train
UNION ALL
SELECT 'knn_sweep', 'mae_k' || CAST(k AS VARCHAR), CAST(mae AS DOUBLE) FROM sweep""")


def _all_named(name: str, selfs: str, sims: str, pairs: str = "test", low: int = 1, high: int = 5) -> str:
    return f"""
{name}_all AS (SELECT user_id, other_id, sim FROM {sims} UNION ALL SELECT * FROM {selfs} WHERE sim <> 0),
{name}_c AS (
  SELECT t.user_id, t.item_id, sum(s.sim * d.dev) AS num, sum(abs(s.sim)) AS den
  FROM {pairs} t JOIN dev d ON d.item_id = t.item_id
  JOIN {name}_all s ON s.user_id = t.user_id AND s.other_id = d.user_id
  GROUP BY 1, 2),
{name}_acc AS (
  SELECT t.user_id, t.item_id, t.rating, ua.avg_rating, c.num, c.den
  FROM {pairs} t JOIN ua USING (user_id) LEFT JOIN {name}_c c USING (user_id, item_id)),{_finish(name, name + '_acc', low, high)}"""


def oracle_sql() -> dict[str, str]:
    b = w(BASE)
    p = w(BASE, prep())
    return {
        "scan_ratings": b + "\nSELECT user_id, item_id, rating FROM ratings",
        "row_count_check": b + """
SELECT 'ratings' AS table_name, count(*) AS n_rows FROM ratings
UNION ALL SELECT 'train', count(*) FROM train
UNION ALL SELECT 'test', count(*) FROM test""",
        "holdout_split": b + "\nSELECT user_id, item_id, rating, is_test FROM flagged",
        "distinct_users": b + "\nSELECT DISTINCT user_id FROM train",
        "avg_per_user": p + "\nSELECT user_id, round(avg_rating, 9) AS avg_rating, n_ratings FROM ua",
        "avg_per_item": b + """
SELECT item_id, round(avg(rating), 9) AS avg_rating, count(*) AS n_ratings FROM train GROUP BY 1""",
        "global_avg": b + "\nSELECT round(avg(rating), 9) AS global_avg, count(*) AS n_ratings FROM train",
        "rating_deviations": p + """
SELECT user_id, item_id, rating, round(avg_rating, 9) AS avg_rating, round(dev, 9) AS dev FROM dev""",
        "user_norms": p + """
SELECT user_id, round(sqrt(sum(dev * dev)), 9) AS l2_norm, round(sum(abs(dev)), 9) AS l1_norm
FROM dev GROUP BY 1""",
        "normalized_deviations": p + "\nSELECT user_id, item_id, round(nd, 9) AS nd FROM nd",
        "dev_for_test_items": p + """
SELECT user_id, item_id, round(dev, 9) AS dev FROM dev
WHERE item_id IN (SELECT item_id FROM test)""",
        "user_item_sets": b + """
SELECT user_id, count(DISTINCT item_id) AS n_items, min(item_id) AS min_item, max(item_id) AS max_item,
       CAST(sum(item_id) AS BIGINT) AS sum_items
FROM train GROUP BY 1""",
        "user_vectors": p + """
SELECT user_id, count(*) AS n_entries, round(sqrt(sum(nd * nd)), 9) AS l2_norm,
       round(sum(nd), 9) AS sum_nd, round(sum(abs(nd)), 9) AS l1_norm
FROM nd GROUP BY 1""",
        "cosine_similarity": p + """
SELECT a.user_id, b.user_id AS other_id, round(sum(a.nd * b.nd), 10) AS sim
FROM nd a JOIN nd b ON a.item_id = b.item_id AND a.user_id <> b.user_id
GROUP BY 1, 2""",
        "jaccard_similarity": w(BASE, JACCARD) + "\nSELECT user_id, other_id, sim FROM jac",
        "corated_counts": w(BASE, _corated()) + "\nSELECT user_id, other_id, n_co FROM corated",
        "corated_stats": w(BASE, _stats_cte()) + "\nSELECT * FROM corated_stats",
        "corated_nonzero_bytes": w(BASE, _corated()) + """
SELECT count(*) AS n_nonzero, count(*) * 8 AS bytes FROM corated""",
        "similarity_computation_count": b + """
SELECT count(DISTINCT user_id) AS n_users,
       CAST(count(DISTINCT user_id) * (count(DISTINCT user_id) - 1) // 2 + count(DISTINCT user_id) AS BIGINT)
         AS n_computations
FROM train""",
        "topk_bytes": w(BASE, KS) + """
SELECT k, n AS n_users, CAST(n * k * 8 AS BIGINT) AS bytes, round(1.7179860388e10 / (k * 8 * 3), 9) AS max_users_in_ram
FROM ks, (SELECT count(DISTINCT user_id) AS n FROM train) u""",
        "scan_ratings_tab": b + "\nSELECT user_id, item_id, rating FROM ratings",
        "scan_ratings_separator": b + "\nSELECT user_id, item_id, rating FROM ratings",
        "personal_text": b + "\nSELECT item_id, title, rating FROM personal",
        "knn_neighbours_declared": w(BASE, prep(users="2 * count(DISTINCT user_id)"), SIMS, ranked()) + f"""
SELECT user_id, other_id, sim, eff_rank AS rank FROM nb WHERE eff_rank <= {NEIGHBOUR_K}""",
        "knn_predictions_repeated": w(BASE, prep(), SIMS, ranked(), knn_pred(PREDICTION_K)) + """
SELECT user_id, item_id, rating, round(prediction, 9) AS prediction FROM pred, (VALUES (1), (2)) twice""",
        "knn_predictions_scale10": _scale10(),
        "mae_knn_nonzero_k200": _mae_knn(200, "nonzero_dev"),
        "knn_neighbours": w(BASE, prep(), SIMS, ranked()) + f"""
SELECT user_id, other_id, sim, eff_rank AS rank FROM nb WHERE eff_rank <= {NEIGHBOUR_K}""",
        "knn_predictions": w(BASE, prep(), SIMS, ranked(), knn_pred(PREDICTION_K)) + """
SELECT user_id, item_id, rating, round(prediction, 9) AS prediction FROM pred""",
        "item_deviation_nonzero": w(BASE, prep(), SIMS, ranked(), knn_pred(PREDICTION_K, weighting="nonzero_dev"))
        + """
SELECT user_id, item_id, round(num / den, 9) AS dev_hat FROM pred WHERE den > 0""",
        "mae_cosine": _mae_cosine(),
        "mae_jaccard": _mae_jaccard(),
        "mae_knn_k10": _mae_knn(10),
        "mae_knn_k100": _mae_knn(100),
        "mae_knn_k300": _mae_knn(300),
        "mae_knn_nonzero_k100": _mae_knn(100, "nonzero_dev"),
        "knn_sweep": _sweep(),
        "lowest_k_better": _lowest_k(),
        "mae_vs_baseline": w(BASE, prep(), SIMS, SELF_COS, JACCARD,
                             "\nselfj AS (SELECT DISTINCT user_id, user_id AS other_id, CAST(1.0 AS DOUBLE) AS sim "
                             "FROM train)",
                             _all_named("cos", "selfs", "sims"), _all_named("jacp", "selfj", "jac")) + f"""
SELECT method, mae, CAST({BASELINE_MAE} AS DOUBLE) AS baseline, round(mae - CAST({BASELINE_MAE} AS DOUBLE), 9) AS diff
FROM (SELECT 'cosine' AS method, round(avg(abs(prediction - rating)), 9) AS mae FROM cos
      UNION ALL SELECT 'jaccard', round(avg(abs(prediction - rating)), 9) FROM jacp)""",
        "predict_cold_user": _cold_user(),
        "personal_ratings": b + """
SELECT CAST(-1 AS BIGINT) AS user_id, item_id, rating FROM personal WHERE rating IS NOT NULL""",
        "personal_candidates": b + "\nSELECT user_id, item_id, title FROM cands",
        "ratings_with_personal": b + "\nSELECT user_id, item_id, rating FROM data",
        "recommend_top5_k30": _recommend(30),
        "recommend_top5_k300": _recommend(300),
        "metrics_report": _metrics(),
    }
