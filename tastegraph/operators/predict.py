"""Rating prediction from neighbours' normalised deviations.

For a requested pair (u, i) the item deviation is

    dev_hat(u, i) = sum_v s(u,v) * dev(v,i) / sum_v |s(u,v)|

over the neighbours v of u that rated i (``weighting="raters"``), or only
those whose deviation on i is non-zero (``weighting="nonzero_dev"``); it is 0
when the denominator is 0. The prediction is ``predict_rating(avg_u, dev_hat)``.

Two join orders are used, chosen by what bounds the work:

* k-NN (``k`` given): ``pairs -> neighbours of u (<= k each) -> lookup
  dev(v, i)``. Every requested pair expands to at most k rows whatever the
  item's popularity, and the lookup join is on the unique key (v, i), so a
  hot item or a hot user never multiplies rows quadratically. A whole k sweep
  shares one pass: each neighbour keeps its effective rank and the aggregate
  computes one conditional sum per k.
* all neighbours (``k=None``): ``pairs -> raters of i -> sim(u, v)``: the
  neighbour set is unbounded here, so the raters of the item bound the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import R_MAX, R_MIN, predict_rating, weighted_mean
from .pairs import HOT_BROADCAST_ROWS, HOT_BUCKET, hot_items, meet, salted, spread_out
from .spread import spread_join

# Requests of one user that one task expands through the user's k neighbours.
REQUESTS_PER_TASK = 100_000


def _with_user_avg(pairs: DataFrame, user_avg: DataFrame, cold_user: str,
                   global_avg: float | None) -> DataFrame:
    if cold_user == "drop":
        return pairs.join(user_avg.select("user_id", "avg_rating"), "user_id")
    if cold_user == "global_mean":
        if global_avg is None:
            raise ValueError("cold_user='global_mean' needs the global average")
        return (pairs.join(user_avg.select("user_id", "avg_rating"), "user_id", "left")
                .withColumn("avg_rating", F.coalesce(F.col("avg_rating"), F.lit(float(global_avg)))))
    raise ValueError("cold_user must be 'drop' or 'global_mean'")


def _weight(weighting: str):
    has_dev = F.col("dev").isNotNull()
    if weighting == "raters":
        return has_dev
    if weighting == "nonzero_dev":
        return has_dev & (F.col("dev") != 0)
    raise ValueError("weighting must be 'raters' or 'nonzero_dev'")


def _looked_up(want: DataFrame, d: DataFrame, keys: list[str], sims: DataFrame, found: list[str], n_parts: int) -> DataFrame:
    """(user_id, item_id, dev, *found): requests with the deviations of their item's raters, for raters in ``sims``.

    ``sims`` (user_id, other_id, *found) has one row a pair and lies in ``n_parts`` partitions by user. The
    requests, each with its raters as arrays, are brought there, and a pair's
    requests take its similarity in a window, so that ``sims`` is not shuffled again.
    """
    met = meet(want, d, keys, ["dev"], "all", False, own=["item_id"]).repartition(n_parts, "user_id")
    rows = spread_out(met, ["dev"], "all", own=["item_id"]).withColumnRenamed("b_dev", "dev")
    both = sims.select("user_id", "other_id", *found).unionByName(rows, allowMissingColumns=True)
    pair = Window.partitionBy("user_id", "other_id")
    known = both.select("user_id", "item_id", "dev", *[F.max(c).over(pair).alias(c) for c in found])
    return known.filter(F.col("item_id").isNotNull() & F.col(found[0]).isNotNull())


def knn_item_deviation(pairs: DataFrame, neighbours: DataFrame, dev: DataFrame, ks: list[int],
                       weighting: str = "raters", item_raters: DataFrame | None = None,
                       route: str = "both", requests: DataFrame | None = None, n_parts: int | None = None) -> DataFrame:
    """Per requested (user_id, item_id): ``num_<k>``/``den_<k>`` for each k in ``ks``.

    ``pairs`` carries any extra columns (rating, avg_rating...) which are kept,
    and so is every row of a repeated pair; the sums are computed once a pair.
    ``neighbours`` is (user_id, other_id, sim, eff_rank) with eff_rank <= max(ks).

    Each pair is expanded along the cheaper side: when its item has at most
    max(ks) raters, through the item's raters and a lookup of their rank for
    this user; otherwise through the user's neighbours and a lookup of their
    deviation on this item. Either way a pair costs at most
    min(raters of the item, k) rows. ``route`` ("item", "user" or "both")
    says which of the two can receive pairs (known from the item rater
    counts), so the plan holds only those. Without ``item_raters`` every pair
    goes through the user's neighbours. Left joins keep pairs that have no
    contribution at all (their sums are NULL). ``requests`` (user_id, n), n being
    at least the user's number of pairs, lets the pairs of a user with very many
    be dealt to several tasks, each with a copy of the user's neighbours. With
    ``n_parts`` the neighbours lie in so many partitions by user, and requests going through the
    item's raters look them up there.
    """
    requested, pairs = pairs, pairs.select("user_id", "item_id").distinct()
    nb = neighbours.select("user_id", "other_id", "sim", "eff_rank")
    d = dev.select(F.col("user_id").alias("other_id"), "item_id", "dev")

    def by_item(p):
        if n_parts:
            raters = dev.select("user_id", "item_id", "dev")
            if route == "both":  # the lists of the other items may be long
                raters = raters.join(item_raters.filter(F.col("m") <= max(ks)).select("item_id"), "item_id", "left_semi")
            return _looked_up(p, raters, ["item_id"], nb, ["sim", "eff_rank"], n_parts)
        return p.join(d, "item_id", "left").join(nb, ["user_id", "other_id"], "left")

    def by_user(p):
        met = p.join(nb, "user_id", "left") if requests is None else spread_join(
            p, nb, "user_id", "item_id", sizes=requests, n="n", how="left", most=REQUESTS_PER_TASK)
        return met.join(d, ["other_id", "item_id"], "left")

    if item_raters is None or route == "user":
        rows = by_user(pairs)
    elif route == "item":
        rows = by_item(pairs)
    else:
        routed = pairs.join(item_raters.select("item_id", "m"), "item_id", "left")
        few = F.coalesce(F.col("m"), F.lit(0)) <= max(ks)
        rows = by_item(routed.filter(few).drop("m")).unionByName(by_user(routed.filter(~few).drop("m")), allowMissingColumns=True)
    counted = _weight(weighting)
    aggs = []
    for k in ks:
        in_k = F.col("eff_rank") <= k
        aggs.append(F.sum(F.when(in_k & counted, F.col("sim") * F.col("dev"))).alias(f"num_{k}"))
        aggs.append(F.sum(F.when(in_k & counted, F.abs("sim"))).alias(f"den_{k}"))
    # every requested row gets its pair's sums, also rows that repeat a pair
    return requested.join(rows.groupBy("user_id", "item_id").agg(*aggs), ["user_id", "item_id"], "left")


def all_item_deviation(pairs: DataFrame, sims: DataFrame, dev: DataFrame, weighting: str = "raters",
                       hot_bucket: int = HOT_BUCKET, n_hot: int | None = None, n_parts: int | None = None) -> DataFrame:
    """Per requested (user_id, item_id): num/den over every rater of the item (no k).

    The requesters and the raters of a hot item are split into buckets, each
    bucket of the one meeting each of the other in a task of its own. With ``n_parts``
    ``sims`` lies in so many partitions by user, and the requests look it up there.
    """
    extra = [c for c in pairs.columns if c not in ("user_id", "item_id")]
    d = dev.select(F.col("user_id").alias("other_id"), "item_id", "dev")
    if weighting == "nonzero_dev":
        d = d.filter(F.col("dev") != 0)
    elif weighting != "raters":
        raise ValueError("weighting must be 'raters' or 'nonzero_dev'")
    want = pairs.select("user_id", "item_id").distinct()
    keys = ["item_id"]
    hot = hot_items(d, hot_bucket)
    n_hot = hot.count() if n_hot is None else n_hot
    if n_hot:
        want, d, keys = salted(want, d, hot, "user_id", "other_id", n_hot <= HOT_BROADCAST_ROWS)
    met = (_looked_up(want, d.withColumnRenamed("other_id", "user_id"), keys, sims, ["sim"], n_parts) if n_parts else
           want.join(d, keys).join(sims.select("user_id", "other_id", "sim"), ["user_id", "other_id"]))
    contrib = (met.groupBy("user_id", "item_id")
               .agg(F.sum(F.col("sim") * F.col("dev")).alias("num"),
                    F.sum(F.abs("sim")).alias("den")))
    return pairs.join(contrib, ["user_id", "item_id"], "left").select(
        "user_id", "item_id", *extra, "num", "den")


def finish_prediction(df: DataFrame, num: str, den: str, r_min: float = R_MIN,
                      r_max: float = R_MAX) -> DataFrame:
    dev_hat = weighted_mean(F.coalesce(F.col(num), F.lit(0.0)), F.coalesce(F.col(den), F.lit(0.0)))
    return (df.withColumn("dev_hat", dev_hat)
            .withColumn("prediction", predict_rating("avg_rating", "dev_hat", r_min, r_max)))


def prepare_pairs(pairs: DataFrame, user_avg: DataFrame, cold_user: str = "drop",
                  global_avg: float | None = None) -> DataFrame:
    return _with_user_avg(pairs, user_avg, cold_user, global_avg)


def predictions_for_ks(pairs_avg: DataFrame, neighbours: DataFrame, dev: DataFrame, ks: list[int],
                       weighting: str = "raters", item_raters: DataFrame | None = None,
                       route: str = "both", r_min: float = R_MIN, r_max: float = R_MAX,
                       requests: DataFrame | None = None, n_parts: int | None = None) -> DataFrame:
    """Long form (k, user_id, item_id, ..., prediction) for each k of a sweep."""
    wide = knn_item_deviation(pairs_avg, neighbours, dev, ks, weighting, item_raters, route, requests, n_parts)
    return spread_ks(wide, ks, r_min, r_max)


def spread_ks(wide: DataFrame, ks: list[int], r_min: float = R_MIN, r_max: float = R_MAX) -> DataFrame:
    """Predictions in long form of the sums ``num_<k>``/``den_<k>``."""
    extra = [c for c in wide.columns if not (c.startswith("num_") or c.startswith("den_"))]
    per_k = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"num_{k}").alias("num"), F.col(f"den_{k}").alias("den"))
        for k in ks])).alias("s")
    long = wide.select(*extra, per_k).select(*extra, "s.k", "s.num", "s.den")
    return finish_prediction(long, "num", "den", r_min, r_max).drop("num", "den")
