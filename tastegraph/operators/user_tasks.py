"""Similarities, ranks and looked-up sums of whole users, in tasks that hold a user's lists.

Spark joins each rating with its item's raters, and each requested pair with its item's raters, as
lists (`pairs.meet`), and shuffles both kinds once, by the left user. A task then
has everything that a user's similarities, neighbour ranks and weighted
deviations depend on: its pair rows are never rows of a shuffle, a hash table or
a sort of Spark's, but entries of numpy arrays, of which a task holds those of some users
at a time (``CHUNK_ROWS``, more only where one user has more). Callers keep
users with very many rows to the joins (`knn`).

A list entry is one number, of 4 bytes where they suffice: a user and which of the
ratings that occur. What it stands for (`Known`) a task works out from the stored table of users, which it
reads once, with the very steps of the model, so that the doubles are the same. Where ratings are of too many
kinds or users too many to hold, entries are an id and a double.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions import R_MAX, R_MIN, SIM_DECIMALS
from ..session import first_row, materialize, open_fs, ship, stored_folder
from .pairs import HOT_BROADCAST_ROWS, _sides, hot_items, meet, salted
from .similarity import LEAST_SIM, Prepared, levels_of, users_table

# List entries that a task turns into arrays at a time.
CHUNK_ROWS = 500_000
# Entries of a list that one row brings to a task, so that a batch of rows stays small.
LIST_LENGTH = 256
INT_MAX = 2 ** 31 - 1
# Pair rows of one user that a task may turn into arrays.
USER_ROWS = 2_000_000
# Lists are made, used and removed in groups of users, each with so many entries a rating of the table, or
# with so many in all where that is more, and in no more groups than this.
GROUP_ENTRIES_PER_RATING, GROUP_ENTRIES, MOST_GROUPS = 8, 30_000_000, 32
# Users that each Python worker holds with their means, norms and counts (at most 40 bytes each).
KNOWN_USERS = 10_000_000


def can_list(*frames: DataFrame) -> bool:
    """Whether users and items are whole numbers, which the arrays hold."""
    return all(isinstance(df.schema[c].dataType, (IntegerType, LongType)) for df in frames for c in ("user_id", "item_id"))


class Known(NamedTuple):
    """What the numbers of packed lists stand for: ``(user - low) * len(levels) + level``."""

    folder: str  # the stored table of users
    low: int
    high: int
    levels: list[float]  # the ratings that occur
    bounds: tuple[float, float]  # of the rating scale

    def number(self, of_rating: bool = True) -> Column:
        """The number of a rating, or the first of a user."""
        level = F.array_position(F.array(*[F.lit(r) for r in self.levels]), F.col("rating").cast("double")) - 1 if of_rating else F.lit(0)
        kind = "int" if (self.high - self.low + 1) * len(self.levels) <= INT_MAX else "long"
        return ((F.col("user_id").cast("long") - F.lit(self.low)) * F.lit(len(self.levels)) + level).cast(kind)

    def deviations(self, at: np.ndarray, level: np.ndarray) -> np.ndarray:
        """As `functions.normalized_deviation`, of users at places ``at`` of `_users_of`."""
        x, avg = np.array(self.levels)[level], _users_of(self.folder).avg[at]
        scale = np.where(x > avg, self.bounds[1] - avg, np.where(x < avg, avg - self.bounds[0], 1.0))
        return (x - avg) / scale

    def weights(self, at: np.ndarray, level: np.ndarray, similarity: str) -> np.ndarray:
        users = _users_of(self.folder)
        if similarity == "jaccard":
            return users.n[at]
        norm = users.norm[at]
        return np.divide(self.deviations(at, level), norm, out=np.zeros(len(at)), where=norm > 0)


class _UserTable(NamedTuple):
    ids: np.ndarray
    avg: np.ndarray
    norm: np.ndarray
    n: np.ndarray
    place: np.ndarray | None  # by id less the smallest, where few ids between are free

    def places(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids) if self.place is None else self.place[ids - self.ids[0]]


# The table last read by this worker, by its folder.
_HELD: dict[str, _UserTable] = {}


def _users_of(folder: str) -> _UserTable:
    if folder not in _HELD:
        files, path = open_fs(folder)
        table = pq.read_table(path, filesystem=files, columns=["user_id", "avg_rating", "sq", "n_u"]).sort_by("user_id")
        ids = table["user_id"].to_numpy().astype(np.int64)
        place = None
        if len(ids) and int(ids[-1]) - int(ids[0]) < 4 * len(ids):
            place = np.zeros(int(ids[-1] - ids[0]) + 1, np.int32)
            place[ids - ids[0]] = np.arange(len(ids))
        _HELD.clear()
        _HELD[folder] = _UserTable(ids, table["avg_rating"].to_numpy(), np.sqrt(table["sq"].to_numpy()),
                                   table["n_u"].to_numpy().astype(float), place)
    return _HELD[folder]


def known_users(model: Prepared) -> Known | None:
    """The packed form of a model's lists, or None where it doesn't have one."""
    st = model.stats()
    return _known(model.per_user, st["user_range"], st["n_users"], model.levels(), model.bounds)


def _known(per_user: DataFrame, user_range: tuple[int, int] | None, n_users: int, levels: list[float] | None,
           bounds: tuple[float, float]) -> Known | None:
    folder = stored_folder(per_user)
    if folder is None or user_range is None or n_users > KNOWN_USERS or not levels:
        return None
    low, high = user_range
    return Known(folder, low, high, levels, bounds) if (high - low + 1) * len(levels) < 2 ** 62 else None


def rating_lists(model: Prepared, similarity: str, n_parts: int, known: Known | None = None,
                 group: tuple[int, int] | None = None) -> DataFrame:
    """Each rating's item's raters: (user_id, item_id null, own, other_id[], value[]), or (own, item_id null, other_id[]) in numbers."""
    st = model.stats()
    value, n_hot = ("nd", st["n_hot"]) if similarity == "cosine" else ("n_u", st["n_hot_all"])
    rows = model.rows.filter(F.col("nd") != 0) if similarity == "cosine" else model.rows
    none = F.lit(None).cast(model.rows.schema["item_id"].dataType)
    if known is not None:
        met = _packed_ratings(rows, known, "ne", st["hot_bucket"], n_hot, n_parts, group)
        return met.select("own", none.alias("item_id"), "other_id")
    base = rows.select("user_id", "item_id", value).filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    left, right, keys = _sides(base, [value], None, st["hot_bucket"], HOT_BROADCAST_ROWS, n_hot, n_parts)
    met = meet(_of_group(left, group), right, keys, [value], "ne", n_hot > 0)
    return _listed(model, met.select("user_id", none.alias("item_id"), F.col("a_" + value).cast("double").alias("own"),
                                     "other_id", F.col("b_" + value).alias("value")))


def _packed_ratings(rows: DataFrame, known: Known, pair: str, hot_bucket: int, n_hot: int, n_parts: int,
                    group: tuple[int, int] | None = None) -> DataFrame:
    """(own, other_id[]): each rating with its item's raters; of "lt" pairs only those with larger numbers."""
    base = rows.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    base = base.select("user_id", "item_id", known.number().alias("number"))
    left, right, keys = _sides(base, ["number"], None, hot_bucket, HOT_BROADCAST_ROWS, n_hot, n_parts)
    others = F.collect_list("number")
    lists = right.groupBy(*keys).agg((F.sort_array(others) if pair == "lt" else others).alias("other_id"))
    met = _of_group(left, group).select(*keys, F.col("number").alias("own")).join(lists, keys)
    if pair == "lt":  # under salted keys the rating itself isn't in the list
        start = (F.size(F.filter("other_id", lambda o: o <= F.col("own"))) if n_hot
                 else F.array_position("other_id", F.col("own")).cast("int"))
        met = met.withColumn("start", start).filter(F.col("start") < F.size("other_id"))
        met = met.withColumn("other_id", F.slice("other_id", F.col("start") + 1, F.size("other_id")))
    return met.select("own", "other_id")


def request_lists(model: Prepared, pairs: DataFrame, dev: DataFrame, known: Known | None = None,
                  group: tuple[int, int] | None = None) -> DataFrame:
    """Each distinct requested pair's item's raters, with their ``dev``, in the form of `rating_lists`."""
    st = model.stats()
    want = _of_group(pairs.select("user_id", "item_id").distinct().filter(F.col("user_id").isNotNull()), group)
    raters = dev.filter(F.col("user_id").isNotNull())
    value = "dev" if known is None else "number"
    if known is not None:  # others have no similarities
        want = want.filter(F.col("user_id").between(known.low, known.high))
        raters = raters.withColumn("number", known.number())
    raters = raters.select(F.col("user_id").alias("other_id"), "item_id", value)
    keys = ["item_id"]
    if st["n_hot_all"]:
        hot = hot_items(model.rows, st["hot_bucket"])
        want, raters, keys = salted(want, raters, hot, "user_id", "other_id", st["n_hot_all"] <= HOT_BROADCAST_ROWS)
    if known is not None:
        lists = raters.groupBy(*keys).agg(F.collect_list("number").alias("other_id"))
        want = want.withColumn("own", known.number(of_rating=False)).drop("user_id")
        return want.join(lists, keys).select("own", "item_id", "other_id")
    met = meet(want, raters.withColumnRenamed("other_id", "user_id"), keys, ["dev"], "all", False, own=["item_id"])
    return _listed(model, met.select("user_id", "item_id", F.lit(None).cast("double").alias("own"), "other_id",
                                     F.col("b_dev").alias("value")))


def _of_group(rows: DataFrame, group: tuple[int, int] | None) -> DataFrame:
    """The rows of one group of users, dealt by another hash than partitions and buckets."""
    return rows if group is None else rows.filter(F.pmod(F.xxhash64("user_id", F.lit(1)), F.lit(group[1])) == group[0])


def _in_groups(make, entries: int, n_rows: int, n_parts: int, cache: str) -> DataFrame:
    """``make(group, n_parts)`` of all users; where the lists are many times the ratings, of one stored group after the other."""
    n = min(-(-entries // (GROUP_ENTRIES_PER_RATING * max(n_rows, 1))), -(-entries // GROUP_ENTRIES), MOST_GROUPS)
    if n <= 1:
        return make(None, n_parts)
    fewer = max(-(-n_parts // n), 1)
    return reduce(DataFrame.unionByName, [materialize(make((g, n), fewer), cache) for g in range(n)])


def _listed(model: Prepared, met: DataFrame) -> DataFrame:
    """Ids as 4 bytes where all fit: the lists are most of what is shuffled."""
    low, high = model.stats()["user_range"]
    ids = "array<int>" if -INT_MAX <= low and high <= INT_MAX else "array<long>"
    return met.withColumn("other_id", F.col("other_id").cast(ids)).withColumn("value", F.col("value").cast("array<double>"))


def _in_user_tasks(model: Prepared, lists: DataFrame, n_parts: int, known: Known | None = None) -> DataFrame:
    """The lists by user, the rows of a user side by side, no list longer than ``LIST_LENGTH``."""
    return _by_user(lists, n_parts, known, model.stats()["max_raters"])


def _by_user(lists: DataFrame, n_parts: int, known: Known | None, longest: int) -> DataFrame:
    ship(lists.sparkSession)
    by, order = ("user_id", "user_id") if known is None else (F.floor(F.col("own") / F.lit(len(known.levels))), "own")
    out = lists.repartition(n_parts, by).sortWithinPartitions(order)
    if longest <= LIST_LENGTH:
        return out
    arrays = [c for c in ("other_id", "value") if c in lists.columns]
    every = F.explode(F.sequence(F.lit(1), F.size("other_id"), F.lit(LIST_LENGTH))).alias("at")
    return out.select("*", every).select(*[F.slice(c, F.col("at"), LIST_LENGTH).alias(c) if c in arrays else c for c in lists.columns])


def _with_users(batches: Iterator[pa.RecordBatch], known: Known | None) -> Iterator[pa.RecordBatch]:
    """Rows of numbers with the columns of the others, but for the values."""
    for batch in batches:
        if known is None:
            yield batch
            continue
        user, level = np.divmod(batch.column("own").to_numpy().astype(np.int64), len(known.levels))
        names = batch.schema.names
        item = batch.column("item_id") if "item_id" in names else pa.nulls(len(batch), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(user + known.low), item, pa.array(level.astype(float)), batch.column("other_id")],
                                         ["user_id", "item_id", "own", "other_id"])


def _whole_users(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of some users at a time; a user's rows follow each other."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch.column("other_id").flatten())
        if n < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        users = table["user_id"].to_numpy()
        cut = int(np.searchsorted(users, users[-1]))
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut).combine_chunks()
            held = rest.to_batches()
            n = sum(len(b.column("other_id").flatten()) for b in held)
    if n:
        yield pa.Table.from_batches(held)


class _Users:
    """Similarities of the users of a table of lists, with the lists that requests brought."""

    def __init__(self, table: pa.Table, similarity: str, with_self: bool, positive: bool | None, known: Known | None = None):
        """``positive``: whether negative similarities are left out; None keeps zeros as well."""
        self.table = table.combine_chunks()
        lists = self.table["other_id"].combine_chunks()
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        other = lists.flatten().to_numpy().astype(np.int64)
        users = self.table["user_id"].to_numpy().astype(np.int64)
        new = np.concatenate([[True], users[1:] != users[:-1]])
        self.ids = users[new]
        own = self.table["own"].to_numpy()
        asked = np.repeat(self.table["item_id"].is_valid().to_numpy(), lengths)
        self.rows = np.repeat(np.arange(len(users)), lengths)
        if known is None:
            value = self.table["value"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        else:
            other, value, own = self._unpacked(known, other, asked, users, own, similarity)
        # one number a pair, in the order of (user, other)
        self.low, self.others = int(other.min()), None
        self.span = int(other.max()) - self.low + 1
        if self.span * len(self.ids) < 2 ** 62:
            key = other - self.low
        else:
            self.others, key = np.unique(other, return_inverse=True)
            self.span = len(self.others)
        key += np.repeat(np.cumsum(new) - 1, lengths) * self.span
        rated = ~asked if with_self else ~asked & (other != users[self.rows])
        self.asked_rows, self.asked_keys, self.asked_value = self.rows[asked], key[asked], value[asked]
        self._sum(key[rated], own[self.rows[rated]], value[rated], similarity, positive)

    def _unpacked(self, known: Known, number: np.ndarray, asked: np.ndarray, users: np.ndarray, own: np.ndarray,
                  similarity: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Other users, values and own values of packed lists."""
        other, level = np.divmod(number, len(known.levels))
        other += known.low
        table = _users_of(known.folder)
        at, value = table.places(other), np.empty(len(other))
        value[asked] = known.deviations(at[asked], level[asked])
        value[~asked] = known.weights(at[~asked], level[~asked], similarity)
        rating = np.flatnonzero(self.table["item_id"].is_null().to_numpy())
        mine = np.zeros(len(users))
        mine[rating] = known.weights(table.places(users[rating]), own[rating].astype(np.int64), similarity)
        return other, value, mine

    def _sum(self, key: np.ndarray, own: np.ndarray, value: np.ndarray, similarity: str, positive: bool | None) -> None:
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        if similarity == "cosine":
            sim = np.add.reduceat((own * value)[order], first) if len(key) else own
        else:
            n_co = np.diff(np.append(first, len(key)))
            sim = n_co / (own[order[first]] + value[order[first]] - n_co)
        # as Spark compares, a NaN is more than any number
        keep = slice(None) if positive is None else ~(sim < LEAST_SIM) if positive else ~(np.abs(sim) < LEAST_SIM)
        self.key, sim = key[first][keep], sim[keep]
        unit = 10.0 ** SIM_DECIMALS
        self.sim = np.copysign(np.floor(np.abs(sim) * unit + 0.5) / unit, sim) + 0.0  # half up, like round_sim; no -0.0

    def ranks(self, n_users: int) -> np.ndarray:
        """Effective ranks as in `neighbours.rank_neighbours`, which see."""
        user = self.key // self.span
        count = np.bincount(user, minlength=len(self.ids))
        order = np.lexsort((-np.where(np.isnan(self.sim), np.inf, self.sim), user))  # stable: ties by the smaller id
        negative = self.sim < 0
        n_neg = np.bincount(user[negative], minlength=len(self.ids))
        rank = np.empty(len(user), np.int64)
        rank[order] = np.arange(1, len(user) + 1) - (np.cumsum(count) - count)[user]
        return np.where(negative, n_users - 1 - n_neg[user] + rank - (count - n_neg)[user], rank)

    def pairs(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other = self.key[chosen] % self.span
        return self.ids[self.key[chosen] // self.span], other + self.low if self.others is None else self.others[other]

    def looked_up(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place of the pair, deviation) of the entries of requests' lists whose pair has a similarity."""
        if not len(self.key):
            return self.asked_rows[:0], self.asked_keys[:0], self.asked_value[:0]
        at = np.minimum(np.searchsorted(self.key, self.asked_keys), len(self.key) - 1)
        hit = self.key[at] == self.asked_keys
        return self.asked_rows[hit], at[hit], self.asked_value[hit]


def neighbours_by_lists(model: Prepared, similarity: str, k: int, n_users: int, positive: bool, n_parts: int) -> DataFrame:
    """(user_id, other_id, sim, eff_rank) for every pair with eff_rank <= k, of all users."""
    kind = model.rows.schema["user_id"].dataType
    schema = StructType([StructField("user_id", kind), StructField("other_id", kind), StructField("sim", DoubleType()),
                         StructField("eff_rank", LongType())])
    known, st = known_users(model), model.stats()
    ids = pa.int32() if isinstance(kind, IntegerType) else pa.int64()

    def run(batches):
        for table in _whole_users(_with_users(batches, known)):
            users = _Users(table, similarity, False, positive, known)
            rank = users.ranks(n_users)
            chosen = np.flatnonzero(rank <= k)
            user, other = (pa.array(x).cast(ids) for x in users.pairs(chosen))
            yield pa.RecordBatch.from_arrays([user, other, pa.array(users.sim[chosen], pa.float64()), pa.array(rank[chosen], pa.int64())],
                                             ["user_id", "other_id", "sim", "eff_rank"])

    def make(group, parts):
        return _in_user_tasks(model, rating_lists(model, similarity, parts, known, group), parts, known).mapInArrow(run, schema)
    entries = st["pair_rows" if similarity == "cosine" else "pair_rows_all"]
    if 2 * k * st["n_users"] > entries:  # the result is as large as the lists
        return make(None, n_parts)
    return _in_groups(make, entries, st["n_rows"], n_parts, model.cache)


def pairs_by_lists(ratings: DataFrame, similarity: str, keep_zero: bool, positive: bool, hot_bucket: int, n_parts: int) -> DataFrame | None:
    """(user_id, other_id, sim) of all pairs that share an item; (u, v) and (v, u) are made once. None where lists of numbers can't hold them.

    The pairs u < v of a user come one after the other and then the same the other way
    round, which files hold in fewer bytes than pairs by turns.
    """
    per_user, levels = users_table(ratings, R_MIN, R_MAX, "auto"), levels_of(ratings)
    u = first_row(per_user.agg(F.count(F.lit(1)).alias("n"), F.min("user_id").alias("low"), F.max("user_id").alias("high")))
    known = _known(per_user, (u["low"], u["high"]) if u["n"] else None, u["n"], levels, (R_MIN, R_MAX))
    if known is None:
        return None
    m = ratings.filter(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.count(F.lit(1)).alias("m"))
    most, n_hot = (int(x or 0) for x in first_row(m.agg(F.max("m"), F.sum((F.col("m") > hot_bucket).cast("long")))))
    kind = ratings.schema["user_id"].dataType
    schema = StructType([StructField("user_id", kind), StructField("other_id", kind), StructField("sim", DoubleType())])
    ids = pa.int32() if isinstance(kind, IntegerType) else pa.int64()

    def run(batches):
        for table in _whole_users(_with_users(batches, known)):
            users = _Users(table, similarity, False, None if keep_zero else positive, known)
            if not len(users.key):
                continue
            user, other = users.pairs(slice(None))
            first = np.flatnonzero(np.concatenate([[True], user[1:] != user[:-1]]))
            count = np.diff(np.append(first, len(user)))
            there = np.arange(len(user)) + np.repeat(first, count)
            back = there + np.repeat(count, count)
            out = [np.empty(2 * len(user), x.dtype) for x in (user, other, users.sim)]
            for column, a, b in zip(out, (user, other, users.sim), (other, user, users.sim), strict=True):
                column[there], column[back] = a, b
            yield pa.RecordBatch.from_arrays([pa.array(out[0]).cast(ids), pa.array(out[1]).cast(ids), pa.array(out[2])],
                                             ["user_id", "other_id", "sim"])
    lists = _packed_ratings(ratings, known, "lt", hot_bucket, n_hot, n_parts)
    return _by_user(lists, n_parts, known, most).mapInArrow(run, schema)


def deviations_by_lists(model: Prepared, pairs: DataFrame, dev: DataFrame, similarity: str, ks: list[int] | None,
                        n_users: int, positive: bool, n_parts: int, n_met: int = 0) -> DataFrame:
    """``pairs`` with ``num_<k>``/``den_<k>`` for each of ``ks``, or num/den over every rater without ``ks``.

    ``dev`` (user_id, item_id, rating, dev) has the raters that count. Sums are NULL where none is a neighbour.
    ``n_met`` is the number of raters that the requests meet.
    """
    names = [f"{c}_{k}" for k in ks for c in ("num", "den")] if ks else ["num", "den"]
    schema = StructType([*[StructField(c, model.rows.schema[c].dataType) for c in ("user_id", "item_id")],
                         *[StructField(n, DoubleType()) for n in names]])
    known, st = known_users(model), model.stats()

    def run(batches):
        for table in _whole_users(_with_users(batches, known)):
            users = _Users(table, similarity, not ks, positive, known)
            row, at, value = users.looked_up()
            sim = users.sim[at]
            rank = users.ranks(n_users)[at] if ks else None
            sums, used = [], np.zeros(len(table), bool)
            for k in ks or [None]:
                within = slice(None) if k is None else rank <= k
                used[row[within]] = True
                for weights in (sim * value, np.abs(sim)):
                    sums.append(np.bincount(row[within], weights[within], len(table)))
            rows = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([*[users.table[c].take(pa.array(rows)).combine_chunks() for c in ("user_id", "item_id")],
                                              *[pa.array(s[rows], pa.float64()) for s in sums]], ["user_id", "item_id", *names])

    def make(group, parts):
        lists = rating_lists(model, similarity, parts, known, group).unionByName(request_lists(model, pairs, dev, known, group))
        found = _in_user_tasks(model, lists, parts, known).mapInArrow(run, schema)
        # a long list's request comes in several rows; every requested row gets its pair's sums
        return found.groupBy("user_id", "item_id").agg(*[F.sum(n).alias(n) for n in names])
    entries = st["pair_rows" if similarity == "cosine" else "pair_rows_all"] + n_met
    return pairs.join(_in_groups(make, entries, st["n_rows"], n_parts, model.cache), ["user_id", "item_id"], "left")
