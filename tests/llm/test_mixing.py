"""Budgets against a step-by-step division, prefixes of epochs, edge cases."""

import random
import re

import duckdb
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tastegraph.llm import mixing


def divide(budget, children):
    """Shares of (name, weight, capacity) by filling up one round at a time."""
    share, open_, rest = {}, list(children), budget
    while open_:
        total = sum(w for _, w, _ in open_)
        full = [c for c in open_ if c[2] * total <= rest * c[1]]
        if not full:
            break
        # the fullest for its weight first, one at a time, as the rest changes with each
        name, w, cap = min(full, key=lambda c: (c[2] / c[1], c[0]))
        share[name] = cap
        rest -= cap
        open_ = [c for c in open_ if c[0] != name]
    total = sum(w for _, w, _ in open_)
    for name, w, _ in open_:
        share[name] = rest * w // total
    spare = rest - sum(share[n] for n, _, _ in open_)
    for name, w, _ in sorted(open_, key=lambda c: (-(rest * c[1] % total), c[0]))[:spare]:
        share[name] += 1
    return share


def test_fill(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for p in range(60):
        children = [(f"c{i}", rng.choice((1, 2, 5, 50)), rng.choice((0, 3, 40, 1000, 10**12))) for i in range(rng.randint(1, 7))]
        budget = rng.choice((0, 1, 7, 100, 999, 10**11, 10**13))
        rows += [(p, n, w, c, budget) for n, w, c in children]
        want |= {(p, n): s for n, s in divide(min(budget, sum(c[2] for c in children)), children).items()}
    df = spark.createDataFrame(rows, "p int, name string, weight long, capacity long, budget long")
    got = {(r.p, r.name): r.share for r in mixing.fill(df, ["p"], "name").collect()}
    assert got == want


def test_shortage_goes_to_siblings_first(spark):
    rows = [("web", "en", "a", 100, 1), ("web", "en", "b", 1000, 1), ("web", "fr", "a", 1000, 1), ("forum", "en", "a", 1000, 1)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long, docs long")
    weights = {"domain": {"": 1}, "lang": {"": 1}, "source": {"": 1}}
    got = {(r.domain, r.lang, r.source): r.share for r in mixing.budgets(leaves, 1600, weights, 1).collect()}
    # web/en/a gives 100 of its 200: its brother b takes the rest, not another language or domain
    assert got == {("web", "en", "a"): 100, ("web", "en", "b"): 300, ("web", "fr", "a"): 400, ("forum", "en", "a"): 800}


def test_prefixes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 7)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    chosen = mixing.choose(docs).collect()
    rows = mixing.leaves_of(docs).collect()
    total = sum(r.tokens for r in rows)
    taken = sum(r.whole * r.tokens + r.part for r in chosen)
    capacity = {}
    for r in rows:
        capacity[r.domain, r.lang, r.source] = capacity.get((r.domain, r.lang, r.source), 0) + mixing.EPOCHS * r.tokens
    assert taken == min(int(total * mixing.SHARE), sum(capacity.values()))
    cut = {}
    for r in chosen:
        leaf = r.domain, r.lang, r.source
        cut[leaf] = cut.get(leaf, 0) + (0 < r.part < r.tokens)
    assert max(cut.values()) == 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect()) == taken


def test_first_words(spark):
    df = spark.createDataFrame([("  a b\n\nc  ", 2), ("a b", 5), ("x", 1)], "t string, n long")
    assert [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()] == ["  a b", "a b", "x"]


def test_edge_cases(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.when(F.col("doc_id") > 3, F.col("lang")))
    out = mixing.mix(docs, share=5.0)  # more than there is: every document in every epoch, once
    rows = out.collect()
    assert out.columns == docs.columns
    distinct = {(r.doc_id, r.text) for r in docs.collect() if r.text and r.text.strip()}
    assert sorted(map(str, ((r.doc_id, r.text) for r in rows))) == sorted(map(str, list(distinct) * mixing.EPOCHS))
    assert mixing.mix(no_docs).count() == 0 and mixing.digest(no_docs).count() == 0


@pytest.mark.parametrize("share", [0.1, 1.3])
def test_budget_is_met(spark, share):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    total = sum(r.tokens for r in mixing.leaves_of(docs).collect())
    assert sum(r.whole * r.tokens + r.part for r in mixing.choose(docs, share=share).collect()) == int(total * share)


def test_repeated_rows_have_a_defined_choice(spark):
    """Of rows equal in id and text the smallest language and source counts, and that row's columns are returned."""
    rows = [(1, "a b c", "en", "src1", 5), (1, "a b c", "de", "src2", 6), (1, "a b c", "de", "src1", 7), (1, "a b c", "de", "src1", 8),
            (2, "d e", None, None, 1), (2, "d e", None, None, 1)]
    for n in (1, 4):
        docs = spark.createDataFrame(rows[::-1] if n == 4 else rows, "doc_id long, text string, lang string, source string, extra int").repartition(n)
        out = sorted(map(tuple, mixing.mix(docs, share=1.0, epochs=1).select("doc_id", "lang", "source", "extra").collect()), key=str)
        assert [r[:3] for r in out] == [(1, "de", "src1"), (2, None, None)]
        if n == 1:
            first = out
    assert out == first
    got = sorted((r.doc_id, r.lang, r.source) for r in mixing.digest(docs).collect())
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    assert sorted(set(got)) == sorted(set(db.sql(f"SELECT doc_id, lang, source FROM ({mixing.SQL})").fetchall()))
