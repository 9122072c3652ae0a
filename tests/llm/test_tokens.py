"""Token files and packing: whole ids against the tokenizers library, gapless cover, edge cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer, models

from tastegraph.llm import packing, token_files
from tastegraph.llm.common import Scratch
from tastegraph.llm.tokens import ChunkEncoder

FILES = {"bytes": "byte_bpe_50k.json", "words": "word_bpe_49k.json"}
ENCODERS = {k: ChunkEncoder(path(f), k) for k, f in FILES.items()}


def library(texts, kind):
    tok = Tokenizer.from_file(path(FILES[kind]))
    tok.encode_special_tokens = True
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def docs_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("kind", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(
    st.sampled_from(list("abcDE .,'\n\t\r-_12²éßñİ中́\u0085\u001c ")), st.characters(codec="utf-8"))), max_size=8))
def test_encoder_gives_the_library_ids(kind, texts):
    ids, counts = ENCODERS[kind].encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])][:len(texts)] == library(texts, kind) or not texts


def test_encoder_forgets_and_goes_on():
    enc = ChunkEncoder(path(FILES["words"]), "words")
    enc.n_ids = 12_000_000 - 1
    texts = ["the quick brown fox " * 5, "don't"]
    ids, counts = enc.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library(texts, "words")


def plain_library(texts, kind):
    """The stated call: the file as it is, without special tokens added."""
    tok = Tokenizer.from_file(path(FILES[kind]))
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("kind", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "end", " of", " ", "\n", "'", "1", "é", "中"]),
    max_size=8).map("".join), max_size=6))
def test_added_tokens_in_texts(kind, texts):
    ids, counts = ENCODERS[kind].encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])][:len(texts)] == plain_library(texts, kind) or not texts


def test_added_token_in_a_file_and_a_sequence(spark):
    rows = [(1, "end <|endoftext|> of"), (2, "plain"), (3, "<|startoftext|><|endoftext|>"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [t or "" for _, t in rows]
    want = [[*x, 2] for x in plain_library(texts, "bytes")]
    assert want[0] == [437, 220, 50256, 286, 2]
    got = sorted(token_files.digest(docs, path(FILES["bytes"])).collect(), key=lambda r: r.doc_id)
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in want]
    assert [r.start for r in got] == [sum(map(len, want[:i])) for i in range(len(want))]
    pieces = defaultdict(list)
    for r in packing.pack_documents(docs, path(FILES["words"])).collect():
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    packed = {d: [x for _, p in sorted(ps) for x in p] for d, ps in pieces.items()}
    assert packed == {d: [*x, 1] for (d, _), x in zip(rows, plain_library(texts, "words"))}


def check_files(df):
    out = token_files.digest(df, path(FILES["bytes"])).collect()
    want = docs_of(df)
    ids = {t: [*x, 2] for t, x in zip([t for _, t in want], library([t for _, t in want], "bytes"))}
    expected = sorted(((d is not None, d or 0), len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t in want)
    got = sorted(out, key=lambda r: r.start)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.n_tokens, r.ids_crc32) for r in got) == expected
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == sorted((d is not None, d or 0) for d, _ in want)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_token_files(spark, odd_docs, no_docs):
    check_files(spark.read.parquet(f"{SF001}/documents.parquet"))
    check_files(odd_docs)
    assert token_files.digest(no_docs, path(FILES["bytes"])).count() == 0


def test_blocks_round_trip_and_range_reads(tmp_path):
    rng = np.random.default_rng(3)
    for ids in (rng.integers(0, 50257, 5000), np.full(1024, 7), rng.integers(0, 2**32, 1500),
                np.where(rng.random(4000) < 0.02, 2**31 - 5, rng.integers(0, 9, 4000)), np.array([5])):
        ids = ids.astype(np.uint32)
        told = {}
        p = tmp_path / f"{len(ids)}-{ids[0]}.pfor"
        p.write_bytes(b"".join(token_files.file_chunks(iter([([9], ids, np.array([len(ids)]))]), told)))
        f = token_files.TokenFile(str(p))
        assert (f.ids(0, len(ids)) == ids).all() and told["n_ids"] == len(ids)
        for a, n in ((0, 1), (len(ids) // 2, 700), (len(ids) - 1, 5), (1020, 10)):
            assert (f.ids(a, n) == ids[a:a + n]).all()


def check_pieces(df):
    out = packing.pack_documents(df, path(FILES["words"])).collect()
    want = docs_of(df)
    ids = [[*x, 1] for x in library([t for _, t in want], "words")]
    expected = sorted((str(d), tuple(x)) for (d, _), x in zip(want, ids))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 > 0
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048 and (at & (at - 1) == 0)
    assert padding == 0
    if len({d for d, _ in want}) == len(want):
        got = sorted((str(d), tuple(x for _, p, _ in sorted(ps) for x in p)) for d, ps in pieces.items())
        assert got == expected
        assert all(n == sum(len(p) for _, p, _ in ps) for ps in pieces.values() for _, _, n in ps)
    assert sum(len(x) for x in ids) == sum(r.length for r in out)


def test_packing(spark, odd_docs, no_docs):
    check_pieces(spark.read.parquet(f"{SF001}/documents.parquet"))
    check_pieces(odd_docs)
    assert packing.digest(no_docs, path(FILES["words"])).count() == 0


def test_hilbert_keys_are_a_path():
    """Every cell once, and neighbours on the curve are neighbours in space."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_range_tails_are_powers_of_two():
    laid = list(packing._laid(iter([(1, np.arange(1500, dtype="<u2").tobytes()), (2, np.arange(1000, dtype="<u2").tobytes())]), 2048))
    lengths = defaultdict(int)
    for _, _, n, _, _, seq, _ in laid:
        lengths[seq] += n
    assert list(lengths.values()) == [2048, 256, 128, 64, 4]


def test_encoded_table_is_kept_once(spark, odd_docs):
    scratch = Scratch(spark, "t")
    kept = scratch.keep(packing.encode(odd_docs, path(FILES["words"]), "words", 1), "e")
    assert kept.count() == odd_docs.count()


def test_ids_beyond_16_bits_are_refused(tmp_path):
    for most in (65_535, 65_536):
        Tokenizer(models.WordLevel({"a": 0, "b": most}, "a")).save(str(tmp_path / f"{most}.json"))
    ChunkEncoder(str(tmp_path / "65535.json"), "words")
    with pytest.raises(ValueError, match="65535"):
        ChunkEncoder(str(tmp_path / "65536.json"), "words")
