"""PPM code lengths against a byte-by-byte computation, held-out accuracy, edge cases."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tastegraph.llm import langid


@pytest.fixture(scope="module")
def table_(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def slow_bits(counts, lang, text):
    """Code length of a text in one language, by escaping with exclusion, straight from the counts."""
    tree = {}
    for g, order, gram, n in counts:
        if g == lang:
            tree.setdefault((order, gram >> 8), {})[gram & 255] = n

    def probability(context, byte, excluded):
        if context is None:
            return 1 / (256 - len(excluded))
        key = (len(context), int.from_bytes(context, "big"))
        low = context[1:] if context else None
        own = tree.get(key)
        if own is None:
            return probability(low, byte, excluded)
        n, d = sum(own.values()), len(own)
        # the lower contexts' probabilities are taken among the bytes this one has not seen
        if byte in own:
            return own[byte] / (n + d) if d < 256 else own[byte] / n
        rest = 1 - sum(probability(low, b, ()) for b in own)
        return d / (n + d) * probability(low, byte, ()) / rest

    data, total = langid.PAD + text.encode(), 0.0
    for i in range(3, len(data)):
        total -= math.log2(probability(data[i - 3:i], data[i], ()))
    return total


def test_code_lengths(spark, table_):
    some = table_.where("doc_id < 12")
    counts = [tuple(r) for r in langid.gram_counts(some.select("lang", "text")).collect()]
    model = langid.Model(counts)
    texts = ["The on ing.", "über 7 ×", "él\n\n niño", "x", "中文", ""]
    bits, sizes = model.text_bits(pa.array(texts))
    for t, row in zip(texts, bits):
        for lang, got in zip(model.langs, row):
            assert got == pytest.approx(slow_bits(counts, lang, t), rel=1e-5, abs=1e-4)
    assert sizes.tolist() == [len(t.encode()) for t in texts]


def test_probabilities_sum_to_one(spark, table_):
    model = langid.Model([tuple(r) for r in langid.gram_counts(table_.where("doc_id < 30").select("lang", "text")).collect()])
    p = np.exp2(-model.bits.astype(float)).reshape(-1, model.n_columns, len(model.langs))
    weight = np.ones(model.n_columns)
    weight[0] = (model.column == 0).sum()
    assert np.allclose((p * weight[None, :, None]).sum(axis=1), 1, atol=1e-4)


def test_long_text_in_windows(spark, table_, monkeypatch):
    model = langid.Model([tuple(r) for r in langid.gram_counts(table_.where("doc_id < 30").select("lang", "text")).collect()])
    text = pa.array(["The reading of the ändern " * 300])
    whole, _ = model.text_bits(text)
    monkeypatch.setattr(langid, "WINDOW", 1000)
    parts, _ = model.text_bits(text)
    assert np.allclose(whole, parts)


def test_held_out_accuracy(spark, table_):
    out = langid.digest(table_).collect()
    true = {r.doc_id: r.lang for r in table_.select("doc_id", "lang").collect()}
    assert len(out) == len(true)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.97 * len(held) > 20
    assert all(0 <= r.score <= 1 for r in out)


def test_edge_cases(spark, odd_docs, no_docs, table_):
    model = langid.fit(table_)
    rows = langid.score_rows(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by = {(r.row.doc_id, r.row.text): r for r in rows}
    for key in ((1, None), (2, ""), (None, None)):
        assert (by[key].lang_pred, by[key].score) == ("und", 0.0)
    assert by[3, "a\n\n b"].lang_pred in model.langs
    digits = spark.createDataFrame([(1, "123 !?", "en")], "doc_id long, text string, lang string")
    assert langid.score_rows(digits, model).first().lang_pred == "und"
    assert langid.digest(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.digest(unlabelled).collect()} == {"und"}


def test_accepted(spark, table_):
    model = langid.fit(table_)
    docs = spark.createDataFrame([(1, "中文字" * 30), (2, "the reading of the"), (3, "12 34"), (4, None)], "doc_id long, text string")
    assert [r.row.doc_id for r in langid.accepted(langid.score_rows(docs, model)).collect()] == [2]
    clean = table_.where("length(text) > 200")
    assert langid.accepted(langid.score_rows(clean, model)).count() >= 0.99 * clean.count()


def test_rare_language_and_long_texts(spark):
    """A language with one long text only is learned, and has a share of the contexts beside a frequent one."""
    rows = [(3 * i, "the reading of the thing and the other " * 40, "en") for i in range(300)]
    rows += [(9000, "мова та книга для читання " * 4000, "uk"), (9004, "мова книга", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").where(~langid.held_out(F.col("doc_id")))
    model = langid.fit(docs)
    assert model.langs == ["en", "uk"]
    assert {t[:3] for t in (r.text for r in langid.sample(docs, "doc_id", "text", "lang").where("lang = 'uk'").collect())} == {"мов"}
    out = langid.score_rows(spark.createDataFrame([(1, "книга для читання"), (2, "the thing")], "doc_id long, text string"), model)
    assert [r.lang_pred for r in out.orderBy("row.doc_id").collect()] == ["uk", "en"]


def test_many_languages_are_bounded(spark, monkeypatch):
    """With many languages the table stays below its bound, every language has contexts, and each is told."""
    monkeypatch.setattr(langid, "CELLS", 1 << 19)
    alphabet = [chr(0x4E00 + i) for i in range(400)]
    own = {f"l{i:02d}": alphabet[10 * i:10 * i + 10] for i in range(40)}
    rng = np.random.default_rng(3)
    rows = [(g, "".join(rng.choice(own[g], 300 if i else 30))) for i, g in enumerate(own) for _ in range(3)]
    labelled = spark.createDataFrame(rows, "lang string, text string")
    counts = langid.chosen(langid.gram_counts(labelled)).collect()
    model = langid.Model([tuple(r) for r in counts])
    small = (1 + 256) * model.n_columns * len(model.langs)  # contexts of at most one byte are always kept
    assert model.bits.size <= langid.CELLS + small
    assert {r.lang for r in counts if r.order == 3} == set(own)
    texts = ["".join(rng.choice(own[g], 40)) for g in model.langs]
    assert model.text_bits(pa.array(texts))[0].argmin(axis=1).tolist() == list(range(40))
