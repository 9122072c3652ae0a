"""I-Match: the contract's columns against a plain version, fingerprints, order over buckets, edge cases."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from conftest import SF001

from tastegraph.llm import imatch
from tastegraph.llm.common import Scratch


def edited(rows):
    """rows: (id, text) -> {(id, text): sha256 of its edited text}, next by descending id, null ids last."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for (i, t), (_, u) in zip(order, [*order[1:], *order[:1]]):
        t, u = t or "", u or ""
        k = len(t) // 3
        out[i] = hashlib.sha256((t[:len(t) - k] + u[:k]).encode()).hexdigest()
    return out


@pytest.mark.parametrize("ranges", [1, 3, 1000])
def test_table_against_sql(spark, monkeypatch, ranges):
    monkeypatch.setattr(imatch, "BUCKET_DOCS", 15)  # many buckets: the order goes on across them
    monkeypatch.setattr(imatch, "RANGES", ranges)  # and across the ranges that are cut into buckets
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = imatch.digest(docs)
    columns = sorted(got.columns)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({imatch.SQL})").fetchall()
    rnd = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    assert rnd(tuple(r[c] for c in columns) for r in got.collect()) == rnd(want)


def test_near_and_far(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("length(text) > 300")
    rows = imatch.digest(docs).collect()
    mean = lambda x: sum(x) / len(x)
    assert mean([r.near_edited for r in rows]) > 3 * mean([r.near_next for r in rows])
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))


def against_sql(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = imatch.digest(docs).collect()
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    want = db.sql(f"SELECT doc_id, fingerprint, edited_fingerprint, near_edited, near_next FROM ({imatch.SQL})").fetchall()
    rnd = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    assert rnd((r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got) == rnd(want)
    return {r.doc_id: r for r in got}


def test_a_third_near_copies(spark):
    """Words of a large group of near copies are above the band; the group's fingerprints tell it all the same."""
    rng = random.Random(3)
    vocabulary = [f"c{i % 20}" for i in range(600)] + [f"w{i}" for i in range(1500)]  # common words and others
    base = [f"b{i}" for i in range(200)]
    rows, members = [], []
    for i in range(300):
        if rng.random() < 0.35:
            text = list(base)
            text[rng.randrange(200)] = f"edit{i}"
            members.append(i)
        else:
            text = rng.choices(vocabulary, k=rng.randrange(50, 300))
        rows.append((i, " ".join(text)))
    got = against_sql(spark, rows)
    mean = lambda x: sum(x) / len(x)
    beside = [i for i in members if i - 1 in members]
    apart = [i for i in range(1, 300) if i not in members and i - 1 not in members]
    assert mean([got[i].near_edited for i in members]) > 0.4
    assert mean([got[i].near_next for i in beside]) > 0.7
    assert mean([got[i].near_next for i in apart]) < 0.15
    assert all(set(got[i].fingerprint.split()[49:]) != {"-"} for i in members)


def test_thirty_documents_and_copies(spark):
    """Small tables have a lexicon too, and copies count once for its frequencies."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(30)]
    got = against_sql(spark, rows)
    assert all(set(r.fingerprint.split()[1:]) != {"-"} for r in got.values())
    again = against_sql(spark, rows + [(100 + i, rows[0][1]) for i in range(40)])
    assert all(again[i].fingerprint == got[i].fingerprint for i in range(30))
    assert len({again[i].fingerprint for i in (0, *range(100, 140))}) == 1


def test_edge_cases(spark, odd_docs, no_docs):
    distinct = odd_docs.where("doc_id IS NULL OR doc_id <> 7").where("doc_id IS NOT NULL OR text IS NOT NULL")
    rows = [(r.doc_id, r.text) for r in distinct.collect()]
    out = imatch.digest(distinct).collect()
    assert len(out) == len(rows)
    want = edited(rows)
    assert {r.doc_id: r.edited_sha256 for r in out} == want
    assert {r.doc_id: r.n_chars for r in out} == {i: len(t or "") for i, t in rows}
    every = imatch.digest(odd_docs).collect()
    assert len(every) == odd_docs.count()
    assert len({r.fingerprint for r in every if r.n_chars == 0}) == 1  # equal texts, equal fingerprints
    assert len({r.fingerprint for r in every if r.doc_id == 7}) == 2
    assert imatch.digest(no_docs).count() == 0
    one = odd_docs.where("doc_id = 5")
    r = imatch.digest(one).first()
    assert r.near_next == 1.0 and r.n_chars == len(one.first().text)  # a single document is its own next


def test_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b d")], "doc_id long, text string")
    assert imatch.digest(docs).count() == 2


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = imatch.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "SinglePartition"))


@pytest.mark.parametrize("digits", ["0" * 128, "f" * 128, "3" * 128])
def test_masks(spark, digits):
    mask = spark.createDataFrame([(digits,)], "digits string").selectExpr(imatch.mask_sql("digits")).first()[0]
    assert mask == ((1 << len(imatch.RATES) * imatch.SUBSETS) - 1 if digits[0] == "0" else 0)


def test_buckets_grow_in_number_not_in_size(spark, monkeypatch):
    """Ids far from evenly spread, twice the ranges: each bucket has about BUCKET_DOCS documents, each but the copies once."""
    monkeypatch.setattr(imatch, "BUCKET_DOCS", 10)
    monkeypatch.setattr(imatch, "RANGES", 4)
    rows = [(i ** 3, f"text {i}") for i in range(400)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed, _ = imatch.neighbours(docs, "doc_id", "text", Scratch(spark, "buckets"))
    got = placed.collect()
    assert sorted(r.text for r in got if not r.copy) == sorted(t for _, t in rows)
    sizes = Counter(r.bucket for r in got if not r.copy)
    assert len(sizes) > 30 and max(sizes.values()) <= 20
    assert Counter(r.bucket for r in got if r.copy) == dict.fromkeys(sizes, 1)
