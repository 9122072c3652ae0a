"""Item self-join: every (user, other user) pair that rated a common item.

This is the only quadratic step of the engine (an item with m raters yields
m*(m-1) pairs), so it is written to keep every task bounded:

* It is an equi-join on ``item_id`` -- never a cross join.
* Hot items (more than ``hot_bucket`` raters) are block-salted: their rater
  rows are split into ``s = ceil(m / hot_bucket)`` buckets by a hash of the
  user, the left copy of a row is replicated to every right bucket and the
  right copy to every left bucket, and the join key becomes
  ``(item, left bucket, right bucket)``. The m^2 pairs of one hot item are
  then spread over s^2 tasks of at most ``hot_bucket^2`` pairs each, while
  cold items keep one copy per side and, when there is no hot item at all,
  both sides are the same plan (no salting columns at all). The hot-item list is an aggregate with map-side partial
  counts; it is broadcast only after its row count is checked, otherwise it
  is shuffle-joined.
* An optional ``left_users`` restriction (left-semi join) keeps only the pairs
  whose left user is requested, e.g. the test users or the one user asking for
  recommendations.
* Per-pair values are reduced to what the aggregate needs *before* the
  shuffle, and a left row meets its item's raters as one list, which crosses the
  shuffle as arrays rather than as a row a pair. ``cluster_by_user`` shuffles by the
  left user only, so the pair aggregate, the per-user ranking window and the per-user
  counts that follow all run in that one stage without reshuffling.
* A task makes about ``PAIR_ROWS_PER_TASK`` pair rows on either side of that shuffle,
  so that neither spills, however many rows a byte of input makes.
* Where the aggregate is the same for (u, v) and (v, u), only pairs u < v are
  made and shuffled (``mirror`` gives the others afterwards).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import first_row, scalar

# Raters per bucket of a hot item: a block of the pair join then holds at most
# HOT_BUCKET^2 pairs. Items at or below it are joined unsalted.
HOT_BUCKET = 4096
# Join output rows that one task of the self-join should make.
PAIR_ROWS_PER_TASK = 3_000_000
# Pair rows of one user that one task may hold; where a user has more, pairs are dealt by both users.
OTHERS_PER_TASK = 5_000_000
# The hot-item list is broadcast only when it has at most this many rows.
HOT_BROADCAST_ROWS = 2_000_000


def join_partitions(df: DataFrame, pair_rows: int) -> int | None:
    """Partitions for a self-join of ``pair_rows`` output rows, or None if one task can make them all.

    Shuffle partitions are sized by the bytes that enter a join; a self-join on
    items makes many rows of few bytes.
    """
    want = -(-pair_rows // PAIR_ROWS_PER_TASK)
    return max(want, df.sparkSession.sparkContext.defaultParallelism) if want > 1 else None


def hot_items(rows: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(item_id, n_buckets) for items with more than ``hot_bucket`` raters."""
    return (rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))
            .filter(F.col("m") > hot_bucket)
            .select("item_id", F.ceil(F.col("m") / F.lit(hot_bucket)).cast("int").alias("n_buckets")))


def salted(left: DataFrame, right: DataFrame, hot: DataFrame, left_user: str, right_user: str,
           broadcast: bool = False) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of an item join with the rows of hot items dealt to buckets by user.

    A left row goes to its own bucket ``lb`` with every ``rb``, a right row to its
    own ``rb`` with every ``lb``, so each pair of rows meets once, under the
    returned join keys. Items that aren't in ``hot`` have one bucket.
    """
    hot = F.broadcast(hot) if broadcast else hot
    every = F.explode(F.sequence(F.lit(0), F.col("n_buckets") - 1))

    def side(df: DataFrame, user: str, own: str, other: str) -> DataFrame:
        dealt = (df.join(hot, "item_id", "left").withColumn("n_buckets", F.coalesce(F.col("n_buckets"), F.lit(1)))
                 .withColumn(own, F.pmod(F.xxhash64(user), F.col("n_buckets")).cast("int")))
        return dealt.select(*df.columns, own, every.alias(other))

    return side(left, left_user, "lb", "rb"), side(right, right_user, "rb", "lb"), ["item_id", "lb", "rb"]


def _pair_condition(kind: str, u: Column, v: Column) -> Column | None:
    if kind == "ne":
        return u != v
    if kind == "lt":
        return u < v
    if kind == "le":
        return u <= v
    if kind == "all":
        return None
    raise ValueError(f"unknown pair kind {kind!r}")


def _count_items(base: DataFrame, hot_bucket: int) -> tuple[int, int]:
    """Number of hot items and of the self-join's output rows: one aggregate action."""
    m = F.col("m").cast("double")
    sizes = first_row(base.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))
                      .agg(F.sum((F.col("m") > hot_bucket).cast("long")).alias("hot"), F.sum(m * m).alias("pairs")))
    return int(sizes["hot"] or 0), int(sizes["pairs"] or 0)


def most_others(base: DataFrame) -> int:
    """The largest number of pair rows that one user has in the self-join."""
    items = base.groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))
    return int(scalar(base.join(items, "item_id").groupBy("user_id").agg(F.sum("m").alias("n")).agg(F.max("n"))) or 0)


def _sides(base: DataFrame, values: list[str], left_users: DataFrame | None, hot_bucket: int, hot_broadcast_rows: int,
           n_hot: int, n_parts: int | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """The two sides of the item self-join and its keys."""
    hot = hot_items(base, hot_bucket)
    left = right = base
    if left_users is not None:
        # only the items of the requested users are joined; the other side keeps no others either
        left = base.join(left_users.select("user_id"), "user_id", "left_semi")
        right = base.join(left.select("item_id").distinct(), "item_id", "left_semi")
    keys = ["item_id"]
    if n_hot:
        if left_users is None:
            left, right, keys = salted(left, right, hot, "user_id", "user_id", n_hot <= hot_broadcast_rows)
        else:
            # the left rows of a hot item are the requested ones, so their number says how many
            # left buckets it has: the raters are copied to no more
            asked = (left.join(hot.select("item_id"), "item_id", "left_semi").groupBy("item_id")
                     .agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_bucket)).cast("int").alias("n_left")))
            both = hot.join(asked, "item_id")
            both = F.broadcast(both) if n_hot <= hot_broadcast_rows else both
            one = lambda c: F.coalesce(F.col(c), F.lit(1))
            every = lambda c: F.explode(F.sequence(F.lit(0), one(c) - 1))
            own = lambda c: F.pmod(F.xxhash64("user_id"), one(c)).cast("int")
            cols = ["user_id", "item_id", *values]
            left = left.join(both, "item_id", "left").select(*cols, own("n_left").alias("lb"), every("n_buckets").alias("rb"))
            right = right.join(both, "item_id", "left").select(*cols, own("n_buckets").alias("rb"), every("n_left").alias("lb"))
            keys = ["item_id", "lb", "rb"]
    if n_parts:
        left, right = left.repartition(n_parts, *keys), right.repartition(n_parts, *keys)
    return left, right, keys


def item_self_join(rows: DataFrame, values: list[str], left_users: DataFrame | None = None,
                   pair: str = "ne", hot_bucket: int = HOT_BUCKET,
                   hot_broadcast_rows: int = HOT_BROADCAST_ROWS, n_hot: int | None = None,
                   n_parts: int | None = None) -> DataFrame:
    """Join ``rows(user_id, item_id, *values)`` with itself on ``item_id``.

    Returns un-aggregated rows ``(user_id, other_id, a_<value>..., b_<value>...)``
    where ``a_`` are the left user's values and ``b_`` the other user's.
    ``n_hot`` (number of items above ``hot_bucket`` rows) is counted here
    unless the caller already knows it. ``n_parts`` sets the number of join
    partitions where the rows coming out, not the bytes going in, should size
    them (`join_partitions`); it is found by the same count.
    """
    base = rows.select("user_id", "item_id", *values)
    if n_hot is None:
        n_hot, pairs = _count_items(base, hot_bucket)
        if n_parts is None and left_users is None:
            n_parts = join_partitions(base, pairs)
    left, right, keys = _sides(base, values, left_users, hot_bucket, hot_broadcast_rows, n_hot, n_parts)
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    cond = _pair_condition(pair, F.col("a.user_id"), F.col("b.user_id"))
    if cond is not None:
        joined = joined.filter(cond)
    return joined.select(F.col("a.user_id").alias("user_id"), F.col("b.user_id").alias("other_id"),
                         *[F.col(f"a.{c}").alias("a_" + c) for c in values],
                         *[F.col(f"b.{c}").alias("b_" + c) for c in values])


def meet(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], pair: str, is_salted: bool,
         own: list[str] | None = None) -> DataFrame:
    """Each ``left`` row with what it meets in ``right`` under ``keys``, as arrays of one length.

    Returns (user_id, a_<value>..., other_id[], b_<value>[]...); with ``own``, these left columns
    as they are instead of the ``a_`` ones. Of "lt" and "le" pairs
    only the part of the sorted list from the left user on is kept. A list has at
    most the right rows of one key, which `salted` bounds.
    """
    cols = ["other_id", *["b_" + c for c in values]]
    others = F.collect_list(F.struct(F.col("user_id").alias("other_id"), *[F.col(c).alias("b_" + c) for c in values]))
    ordered = pair in ("lt", "le")
    lists = right.groupBy(*keys).agg((F.sort_array(others) if ordered else others).alias("others"))
    lists = lists.select(*keys, *[F.col("others")[c].alias(c) for c in cols])
    if own is None:
        own = ["a_" + c for c in values]
        left = left.select("user_id", *keys, *[F.col(c).alias("a_" + c) for c in values])
    met = left.join(lists, keys)
    if ordered:
        # under salted keys the left user isn't in the list
        start = (F.size(F.filter("other_id", lambda o: o < F.col("user_id"))) + 1 if is_salted
                 else F.array_position("other_id", F.col("user_id")).cast("int"))
        met = met.withColumn("start", start).filter((F.col("start") > 0) & (F.col("start") < F.size("other_id") + 1))
        for c in cols[1:] + cols[:1]:
            met = met.withColumn(c, F.slice(c, F.col("start"), F.size("other_id")))
    return met.select("user_id", *own, *cols)


def spread_out(met: DataFrame, values: list[str], pair: str, own: list[str] | None = None) -> DataFrame:
    """The rows of `meet`, one for each other user."""
    own = ["a_" + c for c in values] if own is None else own
    rows = met.select("user_id", *own, F.inline(F.arrays_zip("other_id", *["b_" + c for c in values])))
    cond = _pair_condition(pair, F.col("user_id"), F.col("other_id"))
    return rows if cond is None else rows.filter(cond)


def mirror(pairs: DataFrame) -> DataFrame:
    """Pairs u <= v as ordered pairs: (v, u) has the values of (u, v)."""
    values = [c for c in pairs.columns if c not in ("user_id", "other_id")]
    swapped = F.struct(F.col("other_id").alias("user_id"), F.col("user_id").alias("other_id"))
    same = F.struct("user_id", "other_id")
    both = F.when(F.col("user_id") == F.col("other_id"), F.array(same)).otherwise(F.array(same, swapped))
    return pairs.select(F.inline(both), *values)


def pair_aggregate(rows: DataFrame, values: list[str], row_exprs: dict[str, Column],
                   aggs: dict[str, Column], left_users: DataFrame | None = None, pair: str = "ne",
                   cluster_by_user: bool | None = None, hot_bucket: int = HOT_BUCKET,
                   n_hot: int | None = None, n_parts: int | None = None, symmetric: bool = False) -> DataFrame:
    """Self-join on item and aggregate per (user_id, other_id) pair.

    ``row_exprs`` are evaluated on each joined row (over ``a_*``/``b_*``); ``aggs``
    aggregate those per pair. ``cluster_by_user`` shuffles by the left user; None does so
    where the pairs of every user fit one task. With ``symmetric`` (u, v) and (v, u)
    have the same values, and pairs that needn't be clustered are made once.
    """
    base = rows.select("user_id", "item_id", *values)
    if n_hot is None:
        n_hot, made = _count_items(base, hot_bucket)
        if n_parts is None and left_users is None:
            n_parts = join_partitions(base, made)
    once = symmetric and left_users is None and not cluster_by_user and pair in ("ne", "all")
    if once:
        pair = {"ne": "lt", "all": "le"}[pair]
    # without the rows that can't join or compare, so that both sides are one plan and Spark shuffles it once
    base = base.filter(F.col("item_id").isNotNull())
    base = base if pair == "all" else base.filter(F.col("user_id").isNotNull())
    left, right, keys = _sides(base, values, left_users, hot_bucket, HOT_BROADCAST_ROWS, n_hot, n_parts)
    if not n_parts and left_users is None:
        left, right = left.repartition(*keys), right.repartition(*keys)
    met = meet(left, right, keys, values, pair, n_hot > 0)
    slim = ["user_id", "other_id", *[e.alias(n) for n, e in row_exprs.items()]]
    if cluster_by_user or (cluster_by_user is None and most_others(base) <= OTHERS_PER_TASK):
        met = met.repartition(n_parts, "user_id") if n_parts else met.repartition("user_id")
        pairs = spread_out(met, values, pair).select(*slim)
    else:
        pairs = spread_out(met, values, pair).select(*slim)
        pairs = pairs.repartition(n_parts, "user_id", "other_id") if n_parts else pairs
    out = pairs.groupBy("user_id", "other_id").agg(*[e.alias(n) for n, e in aggs.items()])
    return mirror(out) if once else out
