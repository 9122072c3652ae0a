"""The agenda's ids and their decoding against the sentencepiece library."""

import hashlib

import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor

from tastegraph.llm import pieces

MODEL = path("piece_bpe_32k.model")
LIB = SentencePieceProcessor(model_file=MODEL)
OWN = pieces.Agenda(MODEL)
ALPHABET = " \t\n\r\x00ab.theingéß▁　\xa0中文字日本語привет🙂👨‍👩‍👧́<s></s><0x0A>019"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(exclude_categories=["Cs"])), max_size=80), max_size=4))
def test_equal_to_the_library(texts):
    assert OWN.encode(texts) == (LIB.encode(texts) if texts else [])


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aehintrs ▁"), max_size=200))
def test_one_agenda_equals_its_cuts(text):
    normal = LIB.normalize([text])[0]
    assert OWN.merge(normal) == OWN.encode([text])[0] == LIB.encode(text)


def test_long_texts_and_a_table_that_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_CUTS", 5)
    own = pieces.Agenda(MODEL)
    texts = ["ab" * 30000, " " * 5000 + "x", "字" * 3000, " ".join(f"word{i % 11}s" for i in range(3000))]
    assert own.encode(texts) == LIB.encode(texts) and len(own.known) <= 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aehintrs▁éß中👍"), st.characters(exclude_categories=["Cs"])), min_size=1, max_size=24), max_size=40))
def test_rows_of_an_array_equal_single_agendas(strings):
    done = {s: list(x) for part in OWN.rows.merged(strings) for s, x in zip(*part)} if strings else {}
    assert done == {s: OWN.merge(s) for s in done}
    assert set(strings) - set(done) == {s for s in strings if any(c not in OWN.id for c in s)}


def test_new_words_of_a_slice_are_merged_together(monkeypatch):
    own = pieces.Agenda(MODEL)
    alone = []
    monkeypatch.setattr(own.known, "merge", lambda s: alone.append(s) or pieces.Agenda.merge(own, s))
    texts = [" ".join(f"{a}{b}{c}ment" for b in "xyzw") for a in ("tion", "res", "und") for c in ("al", "eo", "ung")]
    assert own.encode(texts) == LIB.encode(texts) and alone == []
    assert own.encode(["odd👩‍👧word"]) == LIB.encode(["odd👩‍👧word"]) and alone


def want(rows):
    out = []
    for i, t in rows:
        ids = LIB.encode(t or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((str(i), len(ids), sha(",".join(map(str, ids))), sha(LIB.decode(ids) if ids else "")))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert got(pieces.digest(odd_docs, MODEL)) == want([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert pieces.digest(no_docs, MODEL).collect() == []


def test_the_tables_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert got(pieces.digest(docs, MODEL)) == want([(r.doc_id, r.text) for r in docs.collect()])


def test_a_difference_from_the_library_ends_the_job(spark, odd_docs):
    class Wrong:
        sp = None

        def encode(self, texts):
            return [[5]] * len(texts)

    def wrong(p):
        out = Wrong()
        out.sp = SentencePieceProcessor(model_file=p)
        return out
    real, pieces.agenda = pieces.agenda, wrong
    try:
        with pytest.raises(Exception, match="differ from the library"):
            pieces.round_trip(odd_docs, MODEL).collect()
    finally:
        pieces.agenda = real
