"""Phrase collocations against a plain count of all word windows."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001

from tastegraph.llm import collocations as co
from tastegraph.llm import shingles

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, percent=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, min(5, len(w) - i) + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cands = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    dropped = set()
    for (lang, p), b in cands.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * b >= percent * f[lang, p[i:i + m]]:
                    dropped.add((lang, p[i:i + m]))
    out = {}
    for (lang, p), a in cands.items():
        if (lang, p) not in dropped:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((score, a, " ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    rows = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        rows += [(lang, i + 1, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(rows)


def sample(n, seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "Ünï", "x" * 5000, "über", "b", "c\td", "e", "f", "g!", "h."]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(words, weights=range(13, 0, -1), k=rng.randrange(30)))) for _ in range(n)]
    return rows + [("en", None), (None, None), ("en", ""), ("zz", "lonely words"), ("en", "rare pair, " * 40), ("fr", "a\n" * 50)]


def frame(spark, rows):
    return spark.createDataFrame([(t, 1, lang, 2, 3) for lang, t in rows], "text string, n int, lang string, gram int, lead int")


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("percent,top", [(100, 2000), (60, 7)])
def test_equal_to_brute_force(spark, percent, top):
    rows = sample(150)
    assert got(co.collocations(frame(spark, rows), 8, percent, top)) == brute(rows, 8, percent, top)


def test_routes_of_hot_leading_words_are_split(spark, monkeypatch):
    rows = sample(60)
    monkeypatch.setattr(co, "HOT_ROWS", 3)
    monkeypatch.setattr(co, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(co, "BUFFERED", 100)
    monkeypatch.setattr(co, "SLICE", 1000)
    assert got(co.collocations(frame(spark, rows), 6)) == brute(rows, 6)


def test_words_of_equal_hash_start_again(spark, monkeypatch):
    rows = sample(40)
    docs = frame(spark, rows)
    real, seeds = co._word_rows, []

    def clashing(seed):
        def same(batches):
            for b in real(0)(batches):
                yield b.set_column(2, "gram", pa.array([b"8 bytes."] * b.num_rows, pa.binary()))
        seeds.append(seed)
        return real(seed) if seed else same
    monkeypatch.setattr(co, "_word_rows", clashing)
    assert got(co.collocations(docs, 6)) == brute(rows, 6) and seeds == [0, 1]


def test_hashes_shared_within_a_task_are_told_apart(monkeypatch):
    monkeypatch.setattr(co, "span_hashes", lambda data, at, stop, seed: np.full(len(at), 7, np.uint64))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["one Two two"]})
    out = pa.Table.from_batches(list(co._word_rows(0)(iter([batch])))).to_pylist()
    assert sorted((r["word"], r["n"]) for r in out) == [("one", 1), ("two", 2)] and len({r["gram"] for r in out}) == 1


def test_seeds_give_other_hashes():
    data = np.frombuffer(b"one TWO two " + b"y" * 5000, np.uint8)
    at, stop = np.array([0, 4, 8, 12]), np.array([3, 7, 11, 5012])
    a, b = (shingles.span_hashes(data, at, stop, s) for s in (0, 1))
    assert a[1] == a[2] and b[1] == b[2] and not (a == b).any()


def test_quicksort_counts_every_prefix():
    rng = np.random.default_rng(1)
    rows = rng.integers(1, 4, (500, 4)).astype(np.uint64)
    rows[rng.random(500) < 0.3, 2:] = 0
    weights = rng.integers(1, 5, 500)
    want = Counter()
    for r, w in zip(rows.tolist(), weights.tolist()):
        for d in range(1, 5):
            if all(r[:d]):
                want[tuple(r[:d])] += w
    at, depth, size = co.multikey_counts(rows, weights, 12)
    out = [(tuple(rows[i, :d].tolist()), s) for i, d, s in zip(at, depth, size.tolist())]
    assert len(out) == len(set(out)) and dict(out) == {p: w for p, w in want.items() if w >= 12}


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert got(co.collocations(odd_docs, 2)) == brute(rows, 2)
    assert co.collocations(no_docs).collect() == []


def test_the_tables_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(co.digest(docs)) == brute(rows, 100)


def test_a_task_holds_little_of_a_large_batch():
    """12 MB of text in one batch; a slice, its words and what a task combines at a time take a bounded part."""
    rng = np.random.default_rng(6)
    words = np.array([f"word{i}" for i in range(3000)])
    texts = [" ".join(words[rng.integers(0, 3000, 15_000)]) for _ in range(100)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 100, "text": texts})
    every = np.full(64, 2**64 - 1, np.uint64)
    peaks = []
    for run in (co._word_rows(0), co._pair_rows(0, every), co._window_rows(0, every, every)):
        tracemalloc.start()
        try:
            assert sum(b.num_rows for b in run(iter([batch])))
            peaks.append(tracemalloc.get_traced_memory()[1] >> 20)
        finally:
            tracemalloc.stop()
    assert max(peaks) < 160, peaks  # MB
