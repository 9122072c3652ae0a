"""A user's similarities, ranks and looked-up sums from lists, in one task, equal those made by joins."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastegraph.operators import knn as K
from tastegraph.operators import pairs as P
from tastegraph.operators import similarity as S
from tastegraph.operators import user_tasks as U
from tastegraph.session import materialize
from tastegraph.sources import ratings as R


def _rows(df, digits=9):
    return sorted((tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


@pytest.fixture
def by_lists(monkeypatch):
    """Turns the lists on for tables of any size, in small pieces, and says how often they were used."""
    def use():
        monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 5_000)
        monkeypatch.setattr(U, "LIST_LENGTH", 3)
        used = []
        for name in ("neighbours_by_lists", "deviations_by_lists"):
            real = getattr(U, name)
            monkeypatch.setattr(K, name, lambda *a, real=real: used.append(1) or real(*a))
        return used
    return use


@pytest.fixture
def odd(spark):
    """Ratings with equal users, one without a rating, users of equal ratings, repeated rows and rows without ids."""
    rows = [(u, i, None if (u, i) == (3, 4) else float(1 + (u // 2 * i * i) % 5)) for u in range(40) for i in range(25) if (u + 2 * i) % 3]
    rows += rows[::50] + [(90, i, 3.0) for i in range(25)] + [(None, 1, 2.0), (3, None, 4.0), (2 ** 40, 3, 1.0), (2 ** 40, 4, 5.0)]
    train = materialize(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), "table")
    asked = [(u, i, float(1 + i % 5)) for u in range(40) for i in range(25) if (u + 2 * i) % 3 == 0]
    asked += asked[::30] + [(7, 999, 1.0), (999, 3, 1.0), (90, 3, 2.0), (None, 3, 1.0), (7, None, 1.0), (2 ** 40, 5, 1.0)]
    return train, materialize(spark.createDataFrame(asked, "user_id long, item_id long, rating double"), "table")


@pytest.mark.parametrize("how", [{"k": None}, {"k": None, "similarity": "jaccard"}, {"k": 30, "weighting": "nonzero_dev"},
                                 {"k": 10, "cold_user": "global_mean"}])
def test_predictions_equal_those_of_joins(odd, by_lists, how):
    train, test = odd
    cols = ["user_id", "item_id", "rating", "prediction"]
    want = _rows(K.predict(train, test, **how).select(*cols))
    used = by_lists()
    assert _rows(K.predict(train, test, **how).select(*cols)) == want
    assert used


@pytest.mark.parametrize("chunk, similarity", [(1, "cosine"), (400, "jaccard")])
def test_sweeps_and_neighbours_equal_those_of_joins(odd, by_lists, monkeypatch, chunk, similarity):
    train, test = odd
    ks = [1, 2, 5, 40, 41]
    def answers():
        return [_rows(K.knn_sweep(train, test, ks, similarity=similarity)), _rows(K.item_deviation(train, test, 5, similarity=similarity)),
                *[_rows(K.neighbours_table(train, k, similarity=similarity, n_users=n)) for k, n in ((41, None), (2, 500))]]
    want = answers()
    used = by_lists()
    model = K.Focus(train, test).model
    batches = U._in_user_tasks(model, U.rating_lists(model, similarity, 2), 2).toArrow().to_batches()
    assert sum(map(len, batches)) and max(len(x) for b in batches for x in b.column("other_id").to_pylist()) <= 3
    monkeypatch.setattr(U, "CHUNK_ROWS", chunk)
    assert answers() == want
    assert len(used) == 4


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_a_users_rows_stay_together(monkeypatch, chunk):
    monkeypatch.setattr(U, "CHUNK_ROWS", chunk)
    users = np.repeat(np.arange(9), [1, 5, 2, 1, 1, 9, 1, 1, 4])
    table = pa.table({"user_id": users, "other_id": [[1] * (i % 4) for i in range(len(users))]})
    parts = list(U._whole_users(iter(table.to_batches(max_chunksize=2))))
    assert pa.concat_tables(parts).equals(table)
    seen = [set(p["user_id"].to_pylist()) for p in parts]
    assert all(not (a & b) for i, a in enumerate(seen) for b in seen[:i])
    assert chunk == 1000 or len(parts) > 1


def test_pairs_are_neither_aggregated_nor_ranked_as_rows(spark, monkeypatch):
    train, test = (materialize(df, "table") for df in R.train_test(spark, SF001))
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 20_000)
    for k in (None, 400):
        plan = K.mae(K.predict(train, test, k=k))._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Window" not in plan
        assert plan.count("inline(") == 0


def test_users_with_very_many_rows_keep_the_joins(spark, monkeypatch):
    train, test = R.train_test(spark, SF001)
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 20_000)
    f = K.Focus(train, test)
    assert K._list_tasks(f, 10, "cosine")
    named = K.Focus(train.withColumn("user_id", F.concat(F.lit("u"), "user_id")), None)
    assert named.model.stats()["user_range"] is None and not K._list_tasks(named, 10, "cosine")
    monkeypatch.setattr(K, "LISTED_PER_TASK", f.model.partner_bound() - 1)
    assert K._list_tasks(f, 10, "cosine") is None


def test_long_lists_of_wide_ids_keep_their_order():
    """Pairs whose numbers wouldn't fit 64 bits are numbered by rank instead."""
    ids = [-2 ** 62, 5, 2 ** 62]
    table = pa.table({"user_id": ids, "item_id": pa.array([None, None, 8], pa.int64()), "own": [0.5, 1.0, None],
                      "other_id": [ids, ids[1:], ids], "value": [[0.5, 1.0, -1.0], [1.0, 0.25], [1.0, 2.0, 3.0]]})
    users = U._Users(table, "cosine", False, False)
    user, other = users.pairs(np.arange(len(users.key)))
    assert list(zip(user.tolist(), other.tolist(), users.sim.tolist())) == [(ids[0], 5, 0.5), (ids[0], ids[2], -0.5), (5, ids[2], 0.25)]
    assert users.ranks(3).tolist() == [1, 2, 1] and len(users.looked_up()[0]) == 0


@pytest.fixture(params=[0, 2 ** 40])
def clean(spark, request):
    """Ratings that lists hold as numbers: of 4 bytes, or of 8 with a user far off; equal users, repeated rows, rows without ids."""
    far = request.param
    rows = [(u - 7, i, float(1 + (u // 2 * i * i) % 5)) for u in range(40) for i in range(25) if (u + 2 * i) % 3]
    rows += rows[::50] + [(90, i, 3.0) for i in range(25)] + [(None, 1, 2.0), (3, None, 4.0), (far, 3, 1.0), (far, 4, 5.0)]
    train = materialize(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), "table")
    asked = [(u - 7, i, float(1 + i % 5)) for u in range(40) for i in range(25) if (u + 2 * i) % 3 == 0]
    asked += asked[::30] + [(7, 999, 1.0), (-999, 3, 1.0), (90, 3, 2.0), (None, 3, 1.0), (7, None, 1.0), (far, 5, 1.0)]
    return train, materialize(spark.createDataFrame(asked, "user_id long, item_id long, rating double"), "table")


@pytest.mark.parametrize("groups", [1, 3])
def test_numbers_and_groups_give_what_joins_give(clean, by_lists, monkeypatch, groups):
    train, test = clean
    cols = ["user_id", "item_id", "prediction"]
    def answers():
        return [*[_rows(K.predict(train, test, **how).select(*cols)) for how in ({"k": None}, {"k": None, "similarity": "jaccard"},
                                                                                 {"k": 30, "weighting": "nonzero_dev"})],
                _rows(K.knn_sweep(train, test, [1, 5, 41], r_min=0.0, r_max=6.0)), _rows(K.neighbours_table(train, 2, n_users=500))]
    want = answers()
    used = by_lists()
    monkeypatch.setattr(U, "MOST_GROUPS", groups)
    monkeypatch.setattr(U, "GROUP_ENTRIES", 100)
    monkeypatch.setattr(U, "GROUP_ENTRIES_PER_RATING", 1)
    made = []
    real = U._packed_ratings
    monkeypatch.setattr(U, "_packed_ratings", lambda *a: made.append(a[-1]) or real(*a))
    assert answers() == want
    assert len(used) == 5 and set(made) == ({None} if groups == 1 else {(g, groups) for g in range(groups)})
    kind = U.rating_lists(K.Focus(train, test).model, "cosine", 2, U.known_users(K.Focus(train, test).model)).schema["other_id"].dataType
    assert kind.elementType.simpleString() == ("int" if train.agg(F.max("user_id")).first()[0] < 1000 else "bigint")


@pytest.mark.parametrize("hot_bucket", [P.HOT_BUCKET, 8])
def test_pair_tables_equal_those_of_joins(clean, monkeypatch, hot_bucket):
    train = clean[0]
    def answers(**how):
        return [_rows(S.cosine_similarity(train, keep_zero=True, **how)), _rows(S.cosine_similarity(train, **how)), _rows(S.jaccard_similarity(train, **how))]
    want = answers()
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 5_000)
    monkeypatch.setattr(U, "LIST_LENGTH", 3)
    monkeypatch.setattr(U, "CHUNK_ROWS", 400)
    monkeypatch.setattr(S, "pair_aggregate", None)  # pairs aren't made as rows
    assert answers(hot_bucket=hot_bucket) == want


def test_a_table_with_a_missing_rating_keeps_doubles(odd):
    model = K.Focus(odd[0], None).model
    assert model.levels() is None and U.known_users(model) is None


def test_an_entry_is_four_bytes_and_no_shuffle_stays(spark, monkeypatch):
    """What a query shuffles for a stored table or a count is removed when that is written."""
    train, test = (materialize(df, "table") for df in R.train_test(spark, SF001))
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    def shuffled():
        return {f for f in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    monkeypatch.setattr(P, "PAIR_ROWS_PER_TASK", 20_000)
    monkeypatch.setattr(U, "GROUP_ENTRIES", 100_000)
    monkeypatch.setattr(U, "GROUP_ENTRIES_PER_RATING", 1)
    before = shuffled()
    predicted = K.predict(train, test, k=10)
    assert "MapInArrow" not in predicted._jdf.queryExecution().executedPlan().toString()  # stored, a group after the other
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    lists = U.rating_lists(K.Focus(train, test).model, "cosine", 4, U.known_users(K.Focus(train, test).model))
    assert lists.schema.simpleString() == "struct<own:int,item_id:bigint,other_id:array<int>>"
