"""Exact top-k similarities by an inverted index with upper bounds, for tables with very popular items.

Items with many raters make most rows of the item self-join and the least
telling ones. Here only the lists of the other items are joined at first; what a
pair can still gain from the long lists is bounded:

* by the norms of what is left of the two users' vectors (Cauchy-Schwarz);
* for one user against anybody, by the sum over the user's long items of
  ``|nd|`` times the largest ``|nd|`` of the item.

The k-th best lower bound of a user is a threshold that the user's k neighbours
reach. Pairs met whose upper bound is below it are left out; the others are
completed from the long lists by lookups, and nothing else needs them: a user
for whom even a pair met nowhere could reach the threshold (or who has no k
positive neighbours yet) is joined over all items instead. So the result holds
every pair that can be among a user's first k, with its exact similarity.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round_sim
from ..session import materialize, scalar
from .pairs import HOT_BUCKET, pair_aggregate
from .similarity import cosine_similarity
from .spread import spread_join

#: Similarities are rounded to 10 decimals; a pair this near the threshold is kept.
SLACK = 1e-9
# The long lists must make this share of the self-join's rows, of at most this share of the ratings.
LONG_PAIRS, LONG_ROWS = 0.75, 0.5


def long_lists(items: DataFrame) -> int | None:
    """Raters from which on an item's list is long, or None if leaving out long lists doesn't pay.

    ``items`` is (item_id, m). Lengths are grouped by powers of two, so at most 64
    rows come to the driver.
    """
    power = F.floor(F.log2("m")).cast("int")
    got = (items.filter("m > 0").groupBy(power.alias("power"))
           .agg(F.sum(F.col("m").cast("double")).alias("rows"), F.sum(F.col("m").cast("double") * F.col("m")).alias("pairs")).collect())
    n_rows, n_pairs = sum(r["rows"] for r in got), sum(r["pairs"] for r in got)
    held = made = 0.0
    for r in sorted(got, key=lambda r: -r["power"]):
        held, made = held + r["rows"], made + r["pairs"]
        if held > LONG_ROWS * n_rows:
            return None
        if made >= LONG_PAIRS * n_pairs:
            return 1 << r["power"]
    return None


class Bounds(NamedTuple):
    """Stored steps of a bounded search: rows with their item's list, pairs met with their bounds, and who is settled."""

    rows: DataFrame  # user_id, item_id, nd, long
    met: DataFrame  # user_id, other_id, p, low, high
    settled: DataFrame  # user_id, threshold: users whose first k are among the pairs met
    open_users: DataFrame  # user_id: the others asked for
    candidates: DataFrame  # user_id, other_id, p: pairs of settled users that can reach the threshold


def search_bounds(nd: DataFrame, k: int, cut: int, users: DataFrame | None = None, hot_bucket: int = HOT_BUCKET,
                  cache: str = "auto") -> Bounds:
    """The pairs met on the short lists, bounded, and what they settle for the ``users`` (all when None)."""
    rows = nd.select("user_id", "item_id", "nd").filter(F.col("nd") != 0)
    items = materialize(rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"), F.max(F.abs("nd")).alias("peak")), cache)
    rows = materialize(spread_join(rows, items, "item_id", "user_id", n="m")
                       .select("user_id", "item_id", "nd", (F.col("m") >= cut).alias("long"), "peak"), cache)
    rest = materialize(rows.filter("long").groupBy("user_id").agg(
        F.sqrt(F.sum(F.col("nd") * F.col("nd"))).alias("norm"), F.sum(F.abs("nd") * F.col("peak")).alias("reach")), cache)
    widest = float(scalar(rest.agg(F.max("norm"))) or 0.0)
    pairs = pair_aggregate(rows.filter(~F.col("long")), ["nd"], {"p": F.col("a_nd") * F.col("b_nd")}, {"p": F.sum("p")},
                           left_users=users, pair="ne", hot_bucket=hot_bucket, symmetric=True)
    other = rest.select(F.col("user_id").alias("other_id"), F.col("norm").alias("other_norm"), F.col("reach").alias("other_reach"))
    gain = F.coalesce(F.least(F.col("norm") * F.col("other_norm"), F.col("reach"), F.col("other_reach")), F.lit(0.0))
    none = F.col("norm").isNull() | F.col("other_norm").isNull()
    met = (pairs.join(rest, "user_id", "left").join(other, "other_id", "left")
           .withColumn("gain", F.when(none, F.lit(0.0)).otherwise(gain))
           .select("user_id", "other_id", "p", (F.col("p") - F.col("gain")).alias("low"), (F.col("p") + F.col("gain")).alias("high")))
    met = materialize(met, cache)
    first = Window.partitionBy("user_id").orderBy(F.col("low").desc())
    worst = (met.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)
             .groupBy("user_id").agg(F.min("low").alias("threshold"), F.count(F.lit(1)).alias("n")))
    unmet = F.coalesce(F.least(F.col("reach"), F.col("norm") * F.lit(widest)), F.lit(0.0))
    settled = (worst.filter((F.col("n") == k) & (F.col("threshold") > SLACK)).join(rest, "user_id", "left")
               .filter(unmet < F.col("threshold") - SLACK).select("user_id", "threshold"))
    settled = materialize(settled, cache)
    asked = users.select("user_id").distinct() if users is not None else rows.select("user_id").distinct()
    open_users = materialize(asked.join(settled, "user_id", "left_anti"), cache)
    candidates = (met.join(settled, "user_id").filter(F.col("high") >= F.col("threshold") - SLACK)
                  .select("user_id", "other_id", "p"))
    return Bounds(rows.drop("peak"), met, settled, open_users, materialize(candidates, cache))


def completions(b: Bounds) -> DataFrame:
    """(user_id, other_id, item_id, part): what the long lists add to each candidate."""
    held = b.rows.filter("long").select("user_id", "item_id", "nd")
    right = held.select(F.col("user_id").alias("other_id"), "item_id", F.col("nd").alias("other_nd"))
    return (b.candidates.select("user_id", "other_id").join(held, "user_id").join(right, ["other_id", "item_id"])
            .select("user_id", "other_id", "item_id", (F.col("nd") * F.col("other_nd")).alias("part")))


def bounded_similarity(nd: DataFrame, k: int, cut: int, users: DataFrame | None = None, hot_bucket: int = HOT_BUCKET,
                       cache: str = "auto") -> DataFrame:
    """(user_id, other_id, sim) of `cosine_similarity`, without pairs that can't be among a user's first ``k``."""
    b = search_bounds(nd, k, cut, users, hot_bucket, cache)
    n_open, n_settled = b.open_users.count(), b.settled.count()
    if n_open > n_settled:  # too few are settled to be worth two joins
        return cosine_similarity(nd=nd, users=users, hot_bucket=hot_bucket, cluster_by_user=False)
    added = completions(b).groupBy("user_id", "other_id").agg(F.sum("part").alias("added"))
    sims = (b.candidates.join(added, ["user_id", "other_id"], "left")
            .select("user_id", "other_id", round_sim(F.col("p") + F.coalesce("added", F.lit(0.0))).alias("sim"))
            .filter(F.col("sim") != 0))
    if n_open:
        sims = sims.unionByName(cosine_similarity(nd=nd, users=b.open_users, hot_bucket=hot_bucket, cluster_by_user=False))
    return sims
