"""Top-k neighbour selection over a sparse similarity table.

The ranking is over *all* other users: a user without a common item has
similarity 0 and so ranks above every negative neighbour. With only the
stored (non-zero) pairs at hand, the effective rank of a pair (u, v) is

* positive sim: its rank among u's positive pairs (sim desc, v asc);
* negative sim: ``(U - 1 - n_neg(u)) + rank among u's negatives`` -- every
  positive and every zero (stored or implicit) comes first.

Zero-similarity pairs never carry weight and are not kept. Where no negative
can matter, positives use a plain ``row_number() <= k``, which Spark turns into
a WindowGroupLimit (top-k pruned before the sort). Otherwise both signs are
ranked in one window pass by (user, sign).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _rank_order():
    return [F.col("sim").desc(), F.col("other_id").asc()]


def only_positive(max_k: int, n_users: int, max_partners: int | None) -> bool:
    """Whether no negative pair can reach the top ``max_k``."""
    return max_partners is not None and max_partners < n_users - max_k


def rank_neighbours(sims: DataFrame, max_k: int, n_users: int,
                    max_partners: int | None = None, cut_first: bool = False, filtered: bool = False) -> DataFrame:
    """(user_id, other_id, sim, eff_rank) for every stored pair with eff_rank <= max_k.

    ``sims`` must not contain self pairs; ``n_users`` is the number of users
    the ranking runs over (distinct users of the training table).
    ``max_partners`` is an upper bound on any user's number of stored pairs
    (see ``Prepared.partner_bound``): when it is below ``n_users - max_k`` no
    negative pair can reach the top ``max_k`` and negatives are left out.
    ``cut_first`` is for users whose pairs may not fit one task: ``sims`` is read
    twice then (pass a stored table), and each sign is cut to ``max_k`` before
    the pairs of a user meet. ``filtered``: ``sims`` holds no zeros and, where negatives
    are left out, no negatives, so they aren't looked for again.
    """
    sims = sims.select("user_id", "other_id", "sim")
    if only_positive(max_k, n_users, max_partners):
        sims = sims if filtered else sims.filter(F.col("sim") > 0)
        w = Window.partitionBy("user_id").orderBy(*_rank_order())
        return (sims.withColumn("eff_rank", F.row_number().over(w))
                .filter(F.col("eff_rank") <= max_k))
    # both signs in one pass over the pairs, so that they are computed once
    w = Window.partitionBy("user_id", "negative").orderBy(*_rank_order())
    kept = sims if filtered else sims.filter(F.col("sim") != 0)
    ranked = (kept.withColumn("negative", F.col("sim") < 0)
              .withColumn("eff_rank", F.row_number().over(w)))
    if cut_first:
        # a rank among its sign above max_k is out either way: a cut on that alone lets Spark keep
        # max_k rows of each user and sign per partition before they meet; the negatives' number
        # comes from the stored pairs
        counts = sims.filter(F.col("sim") < 0).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_neg"))
        ranked = ranked.filter(F.col("eff_rank") <= max_k).join(counts, "user_id", "left")
    else:
        ranked = ranked.withColumn("n_neg", F.count(F.lit(1)).over(Window.partitionBy("user_id", "negative")))
    rank = F.when(F.col("negative"), F.lit(n_users - 1) - F.col("n_neg") + F.col("eff_rank")).otherwise(F.col("eff_rank"))
    return (ranked.withColumn("eff_rank", rank).filter(F.col("eff_rank") <= max_k)
            .select("user_id", "other_id", "sim", "eff_rank"))
