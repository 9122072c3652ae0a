"""Near-duplicates against all pairs of whole shingle sets."""

import random
import re

import numpy as np
import pytest
from conftest import SF001

from tastegraph.llm import near_dup
from tastegraph.llm.common import Scratch
from tastegraph.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = WORD.findall(low)
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, words=4, percent=80):
    sets = [(i, shingles(t, words)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(i, s) for i, s in sets if s and i is not None]
    for k, (i, s) in enumerate(known):
        for j, t in known[:k]:
            if 100 * len(s & t) >= percent * len(s | t):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((str(i), len(s), str(None if i is None else find(i))) for i, s in sets)


def result(df, **args):
    out = near_dup.near_duplicates(df, **args).collect()
    for r in out:
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out)


@pytest.fixture(scope="module")
def families(spark):
    """A large group of near copies in a chain of edits, copies of texts, and one hot text."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows, text = [], list(base)
    for i in range(90):
        text = list(text if i % 3 else base)
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i * 7 % 1009, " ".join(text)))
    rows += [(2000 + i, " ".join(base)) for i in range(40)]
    rows += [(3000 + i, f"own {i} text with a few words {i * i}") for i in range(30)]
    return rows


def test_against_all_pairs(spark, families):
    df = spark.createDataFrame(families, "doc_id long, text string")
    assert result(df, words=4) == brute(families)
    assert result(df, words=5) == brute(families, 5)


def test_many_blocks_and_hot_keys_change_nothing(spark, families, monkeypatch):
    monkeypatch.setattr(near_dup, "HOT", 3)
    monkeypatch.setattr(near_dup, "UNIT_WEIGHT", 2000)
    df = spark.createDataFrame(families, "doc_id long, text string")
    assert result(df, words=4) == brute(families)


def test_counts_of_millions_are_exact():
    m = 671_089
    shared = np.arange(4 * m, dtype=np.uint64)
    a, b = np.append(shared, np.arange(1 << 40, (1 << 40) + m // 2, dtype=np.uint64)), np.append(
        shared, np.arange(1 << 50, (1 << 50) + m - m // 2, dtype=np.uint64))
    assert near_dup.links([a, b], None, 80) == [(0, 1)]  # exactly 80 %
    assert near_dup.links([a], [b[1:]], 80) == []


def test_a_large_group_moves_each_text_about_once(spark, monkeypatch):
    """Members are dealt to blocks with a copy of the smallest; only those left apart are compared again."""
    monkeypatch.setattr(near_dup, "UNIT_WEIGHT", 4000)
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(240):
        text = list(base)
        text[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(text)))
    # a second family, joined to the first by loose edges only, and one text between both
    other = base[:75] + [f"y{rng.randrange(5000)}" for _ in range(75)]
    rows += [(500 + i, " ".join(other[:-1] + [f"z{i}"])) for i in range(30)]
    seen = []
    real = near_dup.unit_links

    def counted(docs, units, *rest):
        seen.append((units.count(), units.select("component", "lo").distinct().count()))
        return real(docs, units, *rest)
    monkeypatch.setattr(near_dup, "unit_links", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, words=4) == brute(rows)
    moved, blocks = seen[0]
    assert blocks > 5 and moved < len(rows) + blocks


def test_parts_across_blocks_are_joined(spark, monkeypatch):
    """A chain in which few members are near the smallest: links between blocks are found in the second units."""
    monkeypatch.setattr(near_dup, "UNIT_WEIGHT", 1500)
    rng = random.Random(11)
    text = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        for _ in range(2):
            text[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), words=4) == brute(rows)


def test_a_hot_key_of_unlike_texts_is_parted_by_signatures(spark, monkeypatch):
    """Texts that share a passage share keys; they are compared by signatures before their texts are dealt to blocks."""
    monkeypatch.setattr(near_dup, "UNIT_WEIGHT", 4000)
    monkeypatch.setattr(near_dup, "SIGNATURES", 50)
    monkeypatch.setattr(near_dup, "HOT", 3)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"x{rng.randrange(10**9)}" for _ in range(60)])) for i in range(300)]
    for i in range(0, 300, 10):  # a near copy of every tenth
        words = rows[i][1].split(" ")
        words[50 + i % 40] = "edited"
        rows.append((1000 + i, " ".join(words)))
    seen = []
    real = near_dup.unit_links

    def counted(docs, units, *rest):
        seen.append(units.count())
        return real(docs, units, *rest)
    monkeypatch.setattr(near_dup, "unit_links", counted)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), words=4) == brute(rows)
    assert sum(seen) < 1.5 * len(rows)


def test_near_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 3, (12, 64))
    sig = np.where(rng.random((80, 64)) < 0.35, rng.integers(0, 3, (80, 64)), base[rng.integers(0, 12, 80)]).astype("<u2")
    for own, within in ((np.zeros(80, int), True), (np.repeat([0, 1], [33, 47]), False)):
        pairs = [(i, j) for i in range(80) for j in range(i + 1, 80)
                 if (within or own[i] != own[j]) and (sig[i] != sig[j]).sum() <= near_dup.DISTANCE]
        found = near_dup.near_forest(sig, own, within)
        assert len(found) == len(near_dup._forest(pairs)) and set(found) <= set(pairs)
        assert len(near_dup._forest(found)) == len(near_dup._forest(found + pairs))
    assert near_dup.near_forest(sig[:1], np.zeros(1, int), False) == []


def test_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    assert result(df, words=4) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_edge_cases(spark, odd_docs, no_docs):
    got = result(odd_docs, words=4)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert got == brute(rows)
    assert near_dup.near_duplicates(no_docs).count() == 0
    left = near_dup.keep_first(odd_docs)
    assert left.columns == odd_docs.columns and left.where("doc_id = 7").count() == 3


def test_pigeonhole_keys():
    """Signatures within the distance share a key, wherever they differ."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, 64).astype("<u2")
        b = a.copy()
        b[rng.choice(64, near_dup.DISTANCE, replace=False)] ^= 1
        x, y = near_dup.chunk_keys(np.stack([a, b]))
        assert (x == y).any()


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(500, 540)] + [
        (rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "cc"), "t").collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(x, x) == root[x] for x in root)
    empty = spark.createDataFrame([], "a long, b long")
    assert components(empty, Scratch(spark, "cc"), "e").count() == 0
