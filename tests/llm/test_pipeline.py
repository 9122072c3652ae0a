"""The pipeline against a version that holds everything in memory, stage by stage."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from public_tokenizers import path

from tokenizers import Tokenizer

from tastegraph.llm import langid, mixing

from .test_near_dup import shingles

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_language(rows, model):
    out = []
    for r in rows:
        if r["text"] and any(c.isalpha() for c in r["text"]):
            bits, sizes = model.text_bits(pa.array([r["text"]]))
            best = int(bits[0].argmin())
            if bits[0, best] < 8 * sizes[0] and 1 / np.exp2(bits[0, best] - bits[0]).sum() >= 0.5:
                out.append(r | {"lang": model.langs[best]})
    return out


def without_lines(rows):
    holders = defaultdict(set)
    key = lambda line: line.strip(STRIP).translate(LOWER)
    for r in rows:
        for line in r["text"].split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(r["doc_id"])
    return [r | {"text": "\n".join(x for x in r["text"].split("\n") if len(holders[key(x)]) < 5 or max(holders[key(x)]) == r["doc_id"])}
            for r in rows]


def without_copies(rows):
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return [r for r in rows if find(r["doc_id"]) == r["doc_id"]]


def mixed(rows):
    db = duckdb.connect()
    db.register("documents", pa.Table.from_pylist(rows))
    out = []
    for i, text, tokens, n in db.sql(f"WITH {mixing.sql()} SELECT doc_id, text, tokens, n FROM taken").fetchall():
        ends = [m.end() for m in re.finditer(mixing.WORD, text)]
        out.append((i, text if n == tokens else text[:ends[n - 1]]))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]


def test_stages_and_result(spark, rows):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.fit(docs)
    same = lambda df, want: sorted(map(str, (r.asDict() for r in df.collect()))) == sorted(map(str, want))
    steps = [f for _, f in corpus_pipeline.STAGES]
    want = by_language(rows, model)
    got = steps[0](spark, docs, SF001)
    assert got.columns == docs.columns and same(got, want)
    want = without_lines(want)
    got = steps[1](spark, got, SF001)
    assert got.columns == docs.columns and same(got, want)
    want = without_copies(want)
    got = steps[2](spark, got, SF001)
    assert got.columns == docs.columns and same(got, want)
    want = mixed(want)
    got = steps[3](spark, got, SF001)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)

    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    ids = Counter()
    for i, t in want:
        ids[i] += len(tok.encode(t, add_special_tokens=False).ids) + 1
    pieces = corpus_pipeline.run(spark, SF001).collect()
    n = Counter()
    for p in pieces:
        n[p.doc_id] += p.length
    assert n == ids
    whole = [p for p in pieces if p.length == p.doc_tokens]
    crc = {(i, zlib.crc32(np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes())) for i, t in want}
    assert whole and all((p.doc_id, p.ids_crc32) in crc for p in whole)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "MinHash near-dedup", "mixing", "packing"]


def test_empty_and_odd_tables(spark, odd_docs, no_docs, tmp_path):
    for name, df in (("odd", odd_docs), ("none", no_docs)):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert (len(rows) > 0) == (name == "odd")
