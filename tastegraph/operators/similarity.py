"""Per-user preprocessing and user-user similarities (cosine, Jaccard).

Similarities are computed only where two users share an item (the sparse pair
table); every other pair has similarity 0 by definition and is accounted for
analytically by the ranking (see ``neighbours``), never materialised.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ..functions import R_MAX, R_MIN, SIM_DECIMALS, jaccard, normalized_deviation, round_sim
from ..session import all_rows, materialize
from .pairs import HOT_BUCKET, _count_items, join_partitions, most_others, pair_aggregate
from .spread import spread_join


# What rounds to a similarity above 0. Filters test the unrounded value: a filter on the
# rounded one makes Spark round twice, which takes longer than the pair's aggregation.
LEAST_SIM = 0.5 * 10.0 ** -SIM_DECIMALS
# Different ratings up to which the model numbers them.
MAX_LEVELS = 256


def user_averages(ratings: DataFrame) -> DataFrame:
    """(user_id, avg_rating, n_ratings): partial sums map-side, one shuffle of partials."""
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("avg_rating"),
                                          F.count(F.lit(1)).alias("n_ratings"))


def item_averages(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.avg("rating").alias("avg_rating"),
                                          F.count(F.lit(1)).alias("n_ratings"))


def average_per(ratings: DataFrame, attribute: str) -> DataFrame:
    if attribute == "users":
        return user_averages(ratings)
    if attribute == "items":
        return item_averages(ratings)
    raise ValueError("attribute must be 'users' or 'items'")


def global_average(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.avg("rating").alias("global_avg"), F.count(F.lit(1)).alias("n_ratings"))


def deviations(ratings: DataFrame, user_avg: DataFrame | None = None,
               r_min: float = R_MIN, r_max: float = R_MAX) -> DataFrame:
    """(user_id, item_id, rating, avg_rating, dev) for every rating (inner join on user).

    The rows of a user with very many ratings are dealt to several tasks;
    ``user_avg`` should be stored, as it is read for the users' sizes first.
    """
    if user_avg is None:
        user_avg = materialize(user_averages(ratings))
    return (spread_join(ratings.select("user_id", "item_id", "rating"), user_avg.select("user_id", "avg_rating", "n_ratings"),
                        "user_id", "item_id").drop("n_ratings")
            .withColumn("dev", normalized_deviation("rating", "avg_rating", r_min, r_max)))


def user_norms(dev: DataFrame) -> DataFrame:
    """(user_id, l2_norm, l1_norm) of each user's deviation vector."""
    return dev.groupBy("user_id").agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("l2_norm"),
                                      F.sum(F.abs("dev")).alias("l1_norm"))


def normalized(dev: DataFrame) -> DataFrame:
    """(user_id, item_id, nd): deviations divided by the user's L2 norm.

    Users whose deviations are all 0 (norm 0) get nd = 0, i.e. similarity 0
    with everybody, instead of 0/0.
    """
    norms = materialize(dev.groupBy("user_id").agg(F.sum(F.col("dev") * F.col("dev")).alias("sq"),
                                                   F.count(F.lit(1)).alias("n_ratings")))
    return (spread_join(dev.select("user_id", "item_id", "dev"), norms, "user_id", "item_id")
            .select("user_id", "item_id",
                    F.when(F.col("sq") > 0, F.col("dev") / F.sqrt("sq")).otherwise(F.lit(0.0)).alias("nd")))


def preprocess(ratings: DataFrame, r_min: float = R_MIN, r_max: float = R_MAX):
    """(user averages, deviations, normalised deviations) of a rating table."""
    avg = materialize(user_averages(ratings))
    dev = deviations(ratings, avg, r_min, r_max)
    return avg, dev, normalized(dev)


def levels_of(rows: DataFrame) -> list[float] | None:
    """The ratings that occur, or None where they are more than ``MAX_LEVELS`` or one isn't a number."""
    got = [r[0] for r in all_rows(rows.select(F.col("rating").cast("double")).distinct().limit(MAX_LEVELS + 1))]
    return sorted(got) if len(got) <= MAX_LEVELS and all(r is not None and math.isfinite(r) for r in got) else None


def users_table(ratings: DataFrame, r_min: float, r_max: float, cache: str) -> DataFrame:
    """(user_id, avg_rating, n_u, sq), stored: one row a user, whose sizes tell which users' rows are to be dealt to several tasks."""
    dev = deviations(ratings, user_averages(ratings), r_min, r_max)
    return materialize(dev.groupBy("user_id").agg(F.first("avg_rating").alias("avg_rating"), F.count(F.lit(1)).alias("n_u"),
                                                  F.sum(F.col("dev") * F.col("dev")).alias("sq")), cache)


class Prepared:
    """User averages plus one per-rating table ``(user_id, item_id, rating, dev, nd, n_u)``.

    The per-rating table feeds the statistics job, both sides of the pair
    self-join and the deviation lookups of the prediction, so it is
    materialised once (``cache``: "auto", "table", "persist", "checkpoint" or "none";
    see ``session.materialize``). ``n_u`` is the user's number of ratings.

    ``by_item`` stores the table hash-partitioned by ``item_id``: the item
    self-join then reads both sides without an exchange. It is off by
    default: measured on local[8] it was slower at every step, it keeps AQE
    from splitting skewed self-join partitions, and a hot item would put all
    its rows in one partition.
    """

    def __init__(self, ratings: DataFrame, r_min: float = R_MIN, r_max: float = R_MAX,
                 cache: str = "auto", by_item: bool = False):
        per_user = users_table(ratings, r_min, r_max, cache)
        self.avg = per_user.select("user_id", "avg_rating", F.col("n_u").alias("n_ratings"))
        rated = spread_join(ratings.select("user_id", "item_id", "rating"), per_user, "user_id", "item_id", n="n_u")
        table = (rated.withColumn("dev", normalized_deviation("rating", "avg_rating", r_min, r_max))
                 .select("user_id", "item_id", "rating", "dev",
                         F.when(F.col("sq") > 0, F.col("dev") / F.sqrt("sq")).otherwise(F.lit(0.0)).alias("nd"),
                         "n_u"))
        if by_item:
            table = table.repartition("item_id")
        self.by_item = by_item
        self.rows = materialize(table, cache)
        self.cache = cache
        self.bounds, self.per_user = (r_min, r_max), per_user
        self._items = None
        self._stats = None
        self._levels = False

    @property
    def items(self) -> DataFrame:
        """(item_id, m, raters): similarity rows (nd != 0) and rating rows of each item, counted once and stored."""
        if self._items is None:
            nz = (F.col("nd") != 0).cast("int")
            self._items = materialize(self.rows.groupBy("item_id").agg(F.sum(nz).alias("m"), F.count(F.lit(1)).alias("raters")), self.cache)
        return self._items

    def levels(self) -> list[float] | None:
        """`levels_of` the table, looked up once."""
        if self._levels is False:
            self._levels = levels_of(self.rows)
        return self._levels

    @property
    def dev(self) -> DataFrame:
        return self.rows.select("user_id", "item_id", "dev")

    @property
    def nd(self) -> DataFrame:
        return self.rows.select("user_id", "item_id", "nd")

    def item_raters(self) -> DataFrame:
        return self.items.select("item_id", F.col("raters").alias("m"))

    def stats(self, pairs: DataFrame | None = None, hot_bucket: int = HOT_BUCKET) -> dict:
        """Scalars the plan depends on, computed in one job and remembered.

        ``n_users``: users in the table; ``n_hot``: items with more than
        ``hot_bucket`` similarity rows (nd != 0), ``n_hot_all`` with more than
        ``hot_bucket`` rating rows; ``partner_bound``: an upper
        bound on any user's number of non-zero similarity partners -- a user
        only shares items with the other raters of the items they rated, so
        sum over their items of (raters - 1) bounds their pairs
        (``partner_bound_all`` counts all rating rows, as Jaccard does);
        ``pair_rows``/``pair_rows_all``: output rows of the item self-join;
        ``min_raters``/``max_raters``: rating rows per item (for routing); ``n_rows``: rating rows;
        ``user_range``: smallest and largest user id, where these are whole numbers;
        ``n_requested``: distinct users of ``pairs`` when given.
        """
        if self._stats is None or (pairs is not None and "n_requested" not in self._stats):
            rows = self.rows.select("user_id", "item_id", (F.col("nd") != 0).cast("int").alias("nz"))
            items = self.items
            # the rows of a hot item are dealt to several tasks, and a user's sums are partial ones
            per_user = (spread_join(rows, items, "item_id", "user_id", n="raters").groupBy("user_id")
                        .agg(F.sum(F.when(F.col("nz") == 1, F.col("m") - 1)).alias("b"),
                             F.sum(F.col("raters") - 1).alias("c")))
            parts = [
                per_user.agg(F.lit("users").alias("kind"), F.count(F.lit(1)).alias("a"),
                             F.coalesce(F.max("b"), F.lit(0)).cast("long").alias("b")),
                per_user.agg(F.lit("all partners").alias("kind"), F.coalesce(F.max("c"), F.lit(0)).cast("long").alias("a"),
                             F.lit(0).cast("long").alias("b")),
                items.agg(F.lit("pairs").alias("kind"), F.sum(F.col("m") * F.col("m")).alias("a"),
                          F.sum(F.col("raters") * F.col("raters")).alias("b")),
                items.agg(F.lit("items").alias("kind"), F.sum((F.col("m") > hot_bucket).cast("long")).alias("a"),
                          F.sum((F.col("raters") > hot_bucket).cast("long")).alias("b")),
                items.agg(F.lit("raters").alias("kind"), F.min("raters").alias("a"), F.max("raters").alias("b")),
                items.agg(F.lit("rows").alias("kind"), F.sum("raters").alias("a"), F.sum("m").alias("b")),
            ]
            whole = isinstance(per_user.schema["user_id"].dataType, (IntegerType, LongType))
            if whole:
                parts.append(per_user.agg(F.lit("range").alias("kind"), F.min("user_id").cast("long").alias("a"),
                                          F.max("user_id").cast("long").alias("b")))
            if pairs is not None:
                parts.append(pairs.agg(F.lit("requested").alias("kind"), F.countDistinct("user_id").alias("a"),
                                       F.lit(0).cast("long").alias("b")))
            union = parts[0]
            for part in parts[1:]:
                union = union.unionByName(part)
            got = {r["kind"]: r for r in all_rows(union)}
            self._stats = {"n_users": int(got["users"]["a"]), "partner_bound": int(got["users"]["b"]),
                           "n_hot": int(got["items"]["a"] or 0), "n_hot_all": int(got["items"]["b"] or 0),
                           "hot_bucket": hot_bucket, "partner_bound_all": int(got["all partners"]["a"]),
                           "pair_rows": int(got["pairs"]["a"] or 0), "pair_rows_all": int(got["pairs"]["b"] or 0),
                           "min_raters": int(got["raters"]["a"] or 0), "max_raters": int(got["raters"]["b"] or 0),
                           "n_rows": int(got["rows"]["a"] or 0),
                           "user_range": (int(got["range"]["a"] or 0), int(got["range"]["b"] or 0)) if whole else None}
            if pairs is not None:
                self._stats["n_requested"] = int(got["requested"]["a"])
        return self._stats

    def partner_bound(self, similarity: str = "cosine") -> int:
        return self.stats()["partner_bound" if similarity == "cosine" else "partner_bound_all"]

    def n_users(self) -> int:
        return self.stats()["n_users"]


def prepare(ratings: DataFrame, cache: str = "auto", r_min: float = R_MIN, r_max: float = R_MAX,
            by_item: bool = False) -> Prepared:
    return Prepared(ratings, r_min, r_max, cache, by_item)


def cosine_similarity(ratings: DataFrame | None = None, nd: DataFrame | None = None,
                      users: DataFrame | None = None, keep_zero: bool = False,
                      cluster_by_user: bool | None = None, hot_bucket: int = HOT_BUCKET,
                      n_hot: int | None = None, include_self: bool = False,
                      n_parts: int | None = None, positive: bool = False) -> DataFrame:
    """(user_id, other_id, sim) over ordered pairs u != v sharing an item.

    ``sim`` is the dot product of normalised deviations, rounded to 10
    decimals so that values which are mathematically 0 come out exactly 0.
    With ``keep_zero=False`` rows with nd = 0 are left out of the join (they
    add 0 to every dot product) and pairs with sim = 0 are dropped: what
    remains is exactly the set of pairs that can carry weight.
    ``positive`` drops negative ones as well.
    ``include_self`` adds (u, u) pairs: 1 for users with a non-zero norm.
    ``cluster_by_user`` as in `pair_aggregate`; True leaves the result
    partitioned by the user. Of a large table (``ratings`` alone given) the pairs are summed
    in tasks from lists (`user_tasks`).
    """
    if nd is None:
        if users is None and not include_self and cluster_by_user is None:
            listed = _pairs_of_large(ratings, "cosine", keep_zero, positive, hot_bucket)
            if listed is not None:
                return listed
        nd = preprocess(ratings)[2]
    rows = nd.select("user_id", "item_id", "nd")
    if not keep_zero:
        rows = rows.filter(F.col("nd") != 0)
    pairs = pair_aggregate(rows, ["nd"], {"p": F.col("a_nd") * F.col("b_nd")}, {"dot": F.sum("p")},
                           left_users=users, pair="all" if include_self else "ne",
                           cluster_by_user=cluster_by_user, symmetric=True,
                           hot_bucket=hot_bucket, n_hot=None if keep_zero else n_hot, n_parts=n_parts)
    if not keep_zero:
        pairs = pairs.filter((F.col("dot") if positive else F.abs("dot")) >= LEAST_SIM)
    return pairs.select("user_id", "other_id", round_sim("dot").alias("sim"))


def jaccard_similarity(ratings: DataFrame | None = None, users: DataFrame | None = None,
                       cluster_by_user: bool | None = None, hot_bucket: int = HOT_BUCKET,
                       include_self: bool = False, rows: DataFrame | None = None,
                       n_hot: int | None = None, n_parts: int | None = None, keep_zero: bool = True) -> DataFrame:
    """(user_id, other_id, sim) = |A n B| / |A u B| for ordered pairs u != v sharing an item.

    ``include_self`` adds (u, u) pairs, whose similarity is 1. ``rows`` may
    give (user_id, item_id, n) directly (n = the user's number of items). A large table's
    pairs are counted from lists as in `cosine_similarity`.
    """
    if rows is None and users is None and not include_self and cluster_by_user is None:
        listed = _pairs_of_large(ratings, "jaccard", keep_zero, False, hot_bucket)
        if listed is not None:
            return listed
    if rows is None:
        counts = materialize(ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
        rows = spread_join(ratings.select("user_id", "item_id"), counts, "user_id", "item_id", n="n")
    pairs = pair_aggregate(rows, ["n"], {"n_a": F.col("a_n"), "n_b": F.col("b_n")},
                           {"n_co": F.count(F.lit(1)), "n_a": F.max("n_a"), "n_b": F.max("n_b")},
                           left_users=users, pair="all" if include_self else "ne",
                           cluster_by_user=cluster_by_user, symmetric=True,
                           hot_bucket=hot_bucket, n_hot=n_hot, n_parts=n_parts)
    share = jaccard("n_co", "n_a", "n_b")
    if not keep_zero:
        pairs = pairs.filter(share >= LEAST_SIM)
    return pairs.select("user_id", "other_id", round_sim(share).alias("sim"))


def _pairs_of_large(ratings: DataFrame, similarity: str, keep_zero: bool, positive: bool, hot_bucket: int) -> DataFrame | None:
    """Similarities made in user tasks, or None where the table is small, a user's rows don't fit one task, or lists can't hold it."""
    from . import user_tasks as U

    n_parts = join_partitions(ratings, _count_items(ratings, hot_bucket)[1]) if U.can_list(ratings) else None
    if n_parts is None:
        return None
    if most_others(ratings) > U.USER_ROWS:
        return None
    return U.pairs_by_lists(ratings, similarity, keep_zero, positive, hot_bucket, n_parts)


def corated_counts(ratings: DataFrame, hot_bucket: int = HOT_BUCKET, pair: str = "le") -> DataFrame:
    """(user_id, other_id, n_co) for unordered pairs u <= v (self included; without with ``pair="lt"``) with n_co > 0."""
    return pair_aggregate(ratings.select("user_id", "item_id"), [], {}, {"n_co": F.count(F.lit(1))},
                          pair=pair, hot_bucket=hot_bucket)
