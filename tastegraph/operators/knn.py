"""User-facing composite operators: predict, MAE, k sweep, recommend.

Each call builds one DataFrame plan from the training ratings:
averages -> deviations -> normalised vectors (materialised once) -> pair
similarities (only for the users that are asked about) -> neighbour ranks ->
weighted deviations -> predictions. The only values brought to the driver
are scalars (user count, global mean, hot-item count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import R_MAX, R_MIN, abs_error, round_out
from ..session import all_rows, is_stored, materialize, scalar
from .bounded import bounded_similarity, long_lists
from .neighbours import only_positive, rank_neighbours
from .pairs import join_partitions
from .predict import (
    all_item_deviation,
    finish_prediction,
    knn_item_deviation,
    predictions_for_ks,
    prepare_pairs,
    spread_ks,
)
from .similarity import (
    Prepared,
    cosine_similarity,
    global_average,
    jaccard_similarity,
    prepare,
)
from .user_tasks import USER_ROWS, can_list, deviations_by_lists, neighbours_by_lists


def count_users(ratings: DataFrame) -> int:
    return int(scalar(ratings.agg(F.countDistinct("user_id"))))


def global_mean_value(ratings: DataFrame) -> float:
    return float(scalar(global_average(ratings), "global_avg"))


# A requested-user list is broadcast to the self-join only up to this many users.
BROADCAST_USERS = 1_000_000
# The neighbour table of a focused request (requested users x k rows) is
# broadcast to the prediction joins up to this many rows.
NEIGHBOUR_BROADCAST_ROWS = 2_000_000
# Pairs of one user that one ranking task may hold. Above it (a user who
# shares items with millions of others) pairs are aggregated per (user, other)
# and a partial top-k per user runs before the shuffle by user.
PARTNERS_PER_TASK = 5_000_000
# Pair rows, or raters that the requests meet, of one user that a task may turn into arrays (`user_tasks`).
LISTED_PER_TASK = USER_ROWS
# Rows of the whole self-join from which on a search with bounds is worth its extra joins.
BOUNDED_PAIR_ROWS = 100_000_000


class Focus:
    """The part of the training table a request needs, decided before modelling.

    When fewer than half the users are asked about (one user's
    recommendations), the self-join is restricted to the requested users on
    its left side (broadcast below ``BROADCAST_USERS``). Only users who share
    an item with a requested user can then be partners, and every per-user
    quantity (mean, deviations, norm) depends only on that user's own ratings,
    so when that neighbourhood is under half the population the model is
    built on it alone (two semi-joins). Otherwise the whole table is modelled
    and no restriction is applied: it would only cost joins and stop Spark
    from reusing one shuffle for both sides of the self-join. ``n_users`` is
    always the whole population; a declared one may be larger than the users
    present, and a smaller one is refused, as negatives would get wrong ranks.
    """

    def __init__(self, train: DataFrame, pairs: DataFrame | None, cache: str = "auto",
                 r_min: float = R_MIN, r_max: float = R_MAX, n_users: int | None = None):
        self.pairs = _requested(pairs, cache) if pairs is not None else None
        # the input is read by the counts job, the focusing joins and the model
        train = _requested(train, cache)
        counts = train.agg(F.lit("train").alias("kind"), F.countDistinct("user_id").alias("n"))
        if self.pairs is not None:
            counts = counts.unionByName(self.pairs.agg(F.lit("pairs").alias("kind"),
                                                       F.countDistinct("user_id").alias("n")))
        got = {r["kind"]: int(r["n"] or 0) for r in all_rows(counts)}
        if n_users is not None and n_users < got["train"]:
            raise ValueError(f"{n_users} users declared, but {got['train']} are present")
        self.n_users = n_users if n_users is not None else got["train"]
        self.n_requested = got.get("pairs")
        self.users, self.train, self._met = None, train, None
        if self.pairs is not None and 2 * got["pairs"] <= got["train"]:
            users = self.pairs.select("user_id").distinct()
            users = F.broadcast(users) if got["pairs"] <= BROADCAST_USERS else users
            self.users = users
            items = train.join(users, "user_id", "left_semi").select("item_id").distinct()
            near = train.join(items, "item_id", "left_semi").select("user_id").distinct()
            # model only the neighbourhood when it is a small part of the population
            if 2 * scalar(near.agg(F.count(F.lit(1)))) <= got["train"]:
                self.train = materialize(train.join(near, "user_id", "left_semi"), cache)
        self.model = prepare(self.train, cache, r_min, r_max)

    def most_met(self, k: int | None) -> int:
        """The largest number of raters that one user's requests meet, at most ``k`` an item."""
        raters = F.col("raters") if k is None else F.least("raters", F.lit(k))
        met = self.pairs.join(self.model.items, "item_id").groupBy("user_id").agg(F.sum(raters).alias("n"))
        return int(scalar(met.agg(F.max("n"))) or 0)

    def all_met(self) -> int:
        """The number of raters that all requests meet, counted once."""
        if self._met is None:
            self._met = int(scalar(self.pairs.join(self.model.items, "item_id").agg(F.sum("raters"))) or 0)
        return self._met

    def requests(self, neighbours_broadcast: bool) -> DataFrame | None:
        """(user_id, n): requested pairs of each user, for dealing those of a user with very many to several tasks."""
        if neighbours_broadcast:  # no shuffle by user then
            return None
        return self.pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def _neighbours_for_lookup(f: Focus, nb: DataFrame, k: int) -> DataFrame:
    """Broadcast the neighbour table when its size is bounded by the request.

    A focused request ranks only the requested users, so the table has at
    most ``n_requested * k`` rows. Broadcasting it keeps the prediction joins
    from shuffling by user, which for one user's recommendations would put
    every candidate pair into one task (or k tasks).
    """
    return F.broadcast(nb) if _is_focused(f, k) else nb


def _is_focused(f: Focus, k: int) -> bool:
    return f.users is not None and f.n_requested * k <= NEIGHBOUR_BROADCAST_ROWS


def _requested(pairs: DataFrame, cache: str) -> DataFrame:
    """Materialise an input that several jobs read (user count, focusing, prediction).

    This also keeps a constant user id (one user's candidate list or rated
    rows) from being folded into the join conditions, which would turn the
    equi-joins on ``user_id`` into nested-loop products. An input marked as
    stored (a hold-out split of a materialised table) is used as it is:
    re-reading it costs no more than a copy.
    """
    if cache == "none" or is_stored(pairs):
        return pairs
    return materialize(pairs, cache)


def similarities(model: Prepared, train: DataFrame, users: DataFrame | None,
                 similarity: str = "cosine", for_ranking: bool = True, by_user: bool | None = None,
                 positive: bool = False) -> DataFrame:
    """Stored non-zero pair similarities for the left ``users`` (all when None).

    ``for_ranking``: other users only, shuffled by user for the ranking window
    when every user's partners fit one task (``partner_bound``), otherwise
    aggregated per pair so the top-k is cut per partition before the shuffle
    by user. Without ``for_ranking`` self pairs are included; ``by_user`` says whether
    the table is partitioned by user then. ``positive`` leaves out negative ones.
    """
    if similarity not in ("cosine", "jaccard"):
        raise ValueError("similarity must be 'cosine' or 'jaccard'")
    by_user = _fits_one_task(model, similarity) if for_ranking else by_user
    st = model.stats()
    n_parts = _pair_partitions(model, users, similarity)
    if similarity == "cosine":
        return cosine_similarity(nd=model.nd, users=users, n_hot=st["n_hot"], cluster_by_user=by_user,
                                 include_self=not for_ranking, n_parts=n_parts, positive=positive)
    rows = model.rows.select("user_id", "item_id", F.col("n_u").alias("n"))
    return jaccard_similarity(rows=rows, users=users, cluster_by_user=by_user, n_hot=st["n_hot_all"],
                              include_self=not for_ranking, n_parts=n_parts, keep_zero=False)


def _pair_partitions(model: Prepared, users: DataFrame | None, similarity: str) -> int | None:
    rows_out = model.stats()["pair_rows" if similarity == "cosine" else "pair_rows_all"]
    return join_partitions(model.rows, rows_out) if users is None else None


def _user_tasks(f: Focus, k: int | None, similarity: str) -> int | None:
    """Number of user partitions in which requests look up similarities, or None where a join by both users is to do it.

    All of a user's similarities, and of the raters that the user's requests meet, are in one task then.
    """
    n_parts = _pair_partitions(f.model, f.users, similarity)
    if n_parts is None or not _fits_one_task(f.model, similarity) or f.most_met(k) > PARTNERS_PER_TASK:
        return None
    return n_parts


def _list_tasks(f: Focus, k: int | None, similarity: str, users: DataFrame | None = None) -> int | None:
    """Number of user partitions in which similarities are made and looked up from lists, or None where joins are to do it.

    A user's lists are in one task then, and the requests meet no more raters than twice
    the self-join's rows. Where `ranked` searches with bounds, that makes fewer rows.
    """
    st = f.model.stats()
    n_parts = _pair_partitions(f.model, users, similarity)
    most = min(LISTED_PER_TASK, PARTNERS_PER_TASK)
    if n_parts is None or not can_list(f.model.rows) or f.model.partner_bound(similarity) > most:
        return None
    if k is not None and similarity == "cosine" and st["pair_rows"] > BOUNDED_PAIR_ROWS and long_lists(f.model.items) is not None:
        return None
    if f.pairs is not None:
        rows = st["pair_rows" if similarity == "cosine" else "pair_rows_all"]
        if not can_list(f.pairs) or f.most_met(None) > most or f.all_met() > 2 * rows:
            return None
    return n_parts


def _deviations_by_lists(f: Focus, pairs: DataFrame, ks: list[int] | None, similarity: str, weighting: str,
                         n_parts: int) -> DataFrame:
    dev = f.model.rows.select("user_id", "item_id", "rating", "dev")
    if weighting == "nonzero_dev":
        dev = dev.filter(F.col("dev") != 0)
    elif weighting != "raters":
        raise ValueError("weighting must be 'raters' or 'nonzero_dev'")
    elif ks:
        dev = dev.filter(F.col("dev").isNotNull())
    else:  # a rater without a deviation counts among all raters' weights
        dev = dev.withColumn("dev", F.coalesce("dev", F.lit(0.0)))
    positive = bool(ks) and only_positive(max(ks), f.n_users, f.model.partner_bound(similarity))
    return deviations_by_lists(f.model, pairs, dev, similarity, ks, f.n_users, positive, n_parts, f.all_met())


def _fits_one_task(model: Prepared, similarity: str) -> bool:
    return model.partner_bound(similarity) <= PARTNERS_PER_TASK


def ranked(f: Focus, users: DataFrame | None, k: int, similarity: str, cache: str = "auto") -> DataFrame:
    """Neighbours of the ``users`` up to effective rank k."""
    model = f.model
    n_parts = _list_tasks(f, k, similarity, users)
    if n_parts:
        positive = only_positive(k, f.n_users, model.partner_bound(similarity))
        return neighbours_by_lists(model, similarity, k, f.n_users, positive, n_parts)
    if similarity == "cosine" and users is None and model.stats()["pair_rows"] > BOUNDED_PAIR_ROWS:
        cut = long_lists(model.items)
        if cut is not None:
            sims = materialize(bounded_similarity(model.nd, k, cut, cache=cache), cache)
            return rank_neighbours(sims, k, f.n_users, model.partner_bound(similarity), cut_first=True)
    positive = only_positive(k, f.n_users, model.partner_bound(similarity))
    sims = similarities(model, f.train, users, similarity, positive=positive)
    cut_first = not _fits_one_task(model, similarity)
    bound = model.partner_bound(similarity)
    if cut_first and bound >= f.n_users - k:
        sims = materialize(sims, cache)  # read for the ranks and for the negatives' number
    return rank_neighbours(sims, k, f.n_users, bound, cut_first, filtered=True)


def _route(model: Prepared, k: int) -> str:
    """Which expansion paths can receive pairs: items with <= k raters go by item."""
    st = model.stats()
    if st["max_raters"] <= k:
        return "item"
    if st["min_raters"] > k:
        return "user"
    return "both"


def predict(train: DataFrame, pairs: DataFrame, k: int | None = None, similarity: str = "cosine",
            weighting: str = "raters", cold_user: str = "drop", n_users: int | None = None,
            r_min: float = R_MIN, r_max: float = R_MAX, cache: str = "auto",
            focus: Focus | None = None) -> DataFrame:
    """Predict a rating for every requested (user_id, item_id[, rating]) pair.

    ``k=None`` weights every rater of the item (the user itself included);
    otherwise the k best-ranked other users. ``n_users`` is the size of the
    user population the ranking runs over (default: distinct train users).
    ``focus`` is a model already built of the same ``train`` and ``pairs``.
    Returns the pair columns plus ``avg_rating, dev_hat, prediction``.
    """
    f = focus or Focus(train, pairs, cache, r_min, r_max, n_users)
    model, users = f.model, f.users
    global_avg = global_mean_value(train) if cold_user == "global_mean" else None
    pairs_avg = prepare_pairs(f.pairs, model.avg, cold_user, global_avg)
    listed = _list_tasks(f, k, similarity, users)
    if listed:
        wide = _deviations_by_lists(f, pairs_avg, None if k is None else [k], similarity, weighting, listed)
        if k is None:
            return finish_prediction(wide, "num", "den", r_min, r_max).drop("num", "den")
        return spread_ks(wide, [k], r_min, r_max).drop("k")
    if k is None:
        n_parts = _user_tasks(f, None, similarity)
        sims_all = similarities(model, f.train, users, similarity, for_ranking=False, by_user=n_parts is not None)
        wide = all_item_deviation(pairs_avg, sims_all, model.dev, weighting, model.stats()["hot_bucket"],
                                  model.stats()["n_hot_all"], n_parts)
        return finish_prediction(wide, "num", "den", r_min, r_max).drop("num", "den")
    nb = _neighbours_for_lookup(f, ranked(f, users, k, similarity, cache), k)
    return predictions_for_ks(pairs_avg, nb, model.dev, [k], weighting, model.item_raters(),
                              _route(model, k), r_min, r_max, f.requests(_is_focused(f, k)),
                              _user_tasks(f, k, similarity)).drop("k")


def knn_sweep_predictions(train: DataFrame, test: DataFrame, ks: list[int], similarity: str = "cosine",
                          weighting: str = "raters", cold_user: str = "drop", n_users: int | None = None,
                          r_min: float = R_MIN, r_max: float = R_MAX, cache: str = "auto",
                          focus: Focus | None = None) -> DataFrame:
    """(k, user_id, item_id, rating, avg_rating, dev_hat, prediction) for every k, one pass."""
    f = focus or Focus(train, test, cache, r_min, r_max, n_users)
    model = f.model
    global_avg = global_mean_value(train) if cold_user == "global_mean" else None
    pairs_avg = prepare_pairs(f.pairs, model.avg, cold_user, global_avg)
    listed = _list_tasks(f, max(ks), similarity, f.users)
    if listed:
        return spread_ks(_deviations_by_lists(f, pairs_avg, list(ks), similarity, weighting, listed), list(ks), r_min, r_max)
    nb = _neighbours_for_lookup(f, ranked(f, f.users, max(ks), similarity, cache), max(ks))
    return predictions_for_ks(pairs_avg, nb, model.dev, list(ks),
                              weighting, model.item_raters(), _route(model, max(ks)), r_min, r_max,
                              f.requests(_is_focused(f, max(ks))), _user_tasks(f, max(ks), similarity))


def item_deviation(train: DataFrame, pairs: DataFrame, k: int, weighting: str = "nonzero_dev",
                   similarity: str = "cosine", n_users: int | None = None, r_min: float = R_MIN,
                   r_max: float = R_MAX, cache: str = "auto") -> DataFrame:
    """(user_id, item_id, dev_hat) for requested pairs where the weighted mean is defined.

    Pairs with no weighted neighbour (0/0) are left out rather than set to 0.
    """
    f = Focus(train, pairs, cache, r_min, r_max, n_users)
    model = f.model
    listed = _list_tasks(f, k, similarity, f.users)
    if listed:
        wide = _deviations_by_lists(f, f.pairs.select("user_id", "item_id"), [k], similarity, weighting, listed)
    else:
        nb = _neighbours_for_lookup(f, ranked(f, f.users, k, similarity, cache), k)
        wide = knn_item_deviation(f.pairs.select("user_id", "item_id"), nb, model.dev, [k], weighting,
                                  model.item_raters(), _route(model, k), f.requests(_is_focused(f, k)),
                                  _user_tasks(f, k, similarity))
    return (wide.filter(F.col(f"den_{k}") > 0)
            .select("user_id", "item_id", (F.col(f"num_{k}") / F.col(f"den_{k}")).alias("dev_hat")))


def neighbours_table(train: DataFrame, k: int, similarity: str = "cosine", n_users: int | None = None,
                     r_min: float = R_MIN, r_max: float = R_MAX, cache: str = "auto") -> DataFrame:
    """(user_id, other_id, sim, rank): the k-NN graph of every training user."""
    nb = ranked(Focus(train, None, cache, r_min, r_max, n_users), None, k, similarity, cache)
    return nb.select("user_id", "other_id", "sim", F.col("eff_rank").cast("long").alias("rank"))


def mae(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(… , mae, n): mean absolute error of ``prediction`` against ``rating``."""
    aggs = [round_out(F.avg(abs_error("prediction", "rating"))).alias("mae"),
            F.count(F.lit(1)).alias("n")]
    return predictions.groupBy(*(by or [])).agg(*aggs)


def knn_sweep(train: DataFrame, test: DataFrame, ks: list[int], **kw) -> DataFrame:
    return mae(knn_sweep_predictions(train, test, ks, **kw), by=["k"])


def lowest_k_better(sweep: DataFrame, baseline: float) -> DataFrame:
    """One row: the smallest k whose MAE is below ``baseline`` (NULL when none)."""
    best = F.min(F.when(F.col("mae") < baseline, F.struct("k", "mae")))
    return (sweep.agg(best.alias("b"))
            .select(F.lit(baseline).alias("baseline"), F.col("b.k").alias("k"),
                    F.col("b.mae").alias("mae"),
                    round_out(F.col("b.mae") - F.lit(baseline)).alias("diff")))


def recommend(ratings: DataFrame, candidates: DataFrame, n: int = 5, k: int = 30,
              similarity: str = "cosine", weighting: str = "raters", cold_user: str = "drop",
              n_users: int | None = None, r_min: float = R_MIN, r_max: float = R_MAX, cache: str = "auto") -> DataFrame:
    """Top-n candidates per user by predicted score (score desc, item asc).

    ``candidates`` is (user_id, item_id[, title]); works for one user or all.
    The window keeps n rows per user (WindowGroupLimit prunes before sorting).
    """
    pred = predict(ratings, candidates, k, similarity, weighting, cold_user, n_users, r_min, r_max, cache)
    scored = pred.withColumn("score", round_out("prediction"))
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    keep = [c for c in candidates.columns if c not in ("user_id", "item_id")]
    return (scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", *keep, "score"))
