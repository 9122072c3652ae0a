"""Packing along a space-filling curve: neighbouring documents fill sequences of fixed length.

A document's vector is its hashed token counts, projected to four dimensions by
fixed random signs and scaled to unit length. The Hilbert key of the four
coordinates orders the corpus: documents are range-sorted by (key, id, text
hash) and laid end to end within each range, cut at every 2048 ids. What is
left at a range's end is cut at powers of two (1024, 512, ...), which take no
padding, so no range needs to know another's length and nothing is padded.
Copies of one text share a key and are told apart by their ids, so a group of
copies spans as many ranges as it needs.

Edge cases
* a vocabulary with ids above 65,535: an error;
* null or empty text: the end id alone, one piece;
* a document longer than a sequence: cut, its pieces in order;
* rows with equal ids: each packed on its own;
* null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, text_slices, tidied

DIMENSIONS, BITS = 4, 15  # 60 bits of key
SEQUENCE = 2048
ENCODED = "doc long, key long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
PIECES_AT_ONCE = 2000


def hilbert_key(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of points [n, dimensions] with coordinates below 2**bits.

    Axes are turned into the curve's transposed form by undoing its rotations
    from the highest bit down, then Gray-decoded and interleaved.
    """
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(on, q - 1, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def projection(vocabulary: int = 1 << 16, seed: int = 17) -> np.ndarray:
    """Random signs of each token id's hash bucket; rows of one bucket are equal."""
    rng = np.random.default_rng(seed)
    buckets = rng.choice(np.array([-1, 1], np.float32), (4096, DIMENSIONS))
    return buckets[rng.integers(0, len(buckets), vocabulary)]


def document_keys(ids: np.ndarray, counts: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given all their ids and the number of ids of each."""
    sums = np.zeros((len(counts), DIMENSIONS))
    cut = np.concatenate([[0], np.cumsum(counts)])
    some = np.flatnonzero(counts)
    if len(some):
        sums[some] = np.add.reduceat(signs[ids], cut[some], axis=0, dtype=np.float64)
    unit = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1))[:, None]
    return hilbert_key(np.minimum((1 << BITS) - 1, ((unit + 1) / 2 * (1 << BITS)).astype(np.int64)))


def encode(docs: DataFrame, tokenizer: str, kind: str, end_id: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, n, ids as uint16) of every document, its end id included."""
    def run(batches):
        from tastegraph.llm.tokens import encoder

        enc, signs = encoder(tokenizer, kind), projection()
        for batch in batches:
            texts = batch.column(1)
            for a, b in text_slices(texts):
                ids, n = enc.encode(texts.slice(a, b - a).to_pylist())
                key = document_keys(ids, n, signs)
                out = np.full(len(ids) + len(n), end_id, "<u2")
                out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                cut = np.concatenate([[0], np.cumsum(n + 1)]) * 2
                data = out.tobytes()
                yield pa.RecordBatch.from_pydict({
                    "doc": batch.column(0).slice(a, b - a), "key": key, "n": n + 1,
                    "ids": pa.array([data[i:j] for i, j in zip(cut, cut[1:])], pa.binary())})

    return docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text")).mapInArrow(tidied(run), ENCODED)


def _cuts(rest: int) -> list[int]:
    """Lengths of the sequences that what is left at a range's end goes to: powers of two, largest first."""
    return [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _laid(docs: Iterator[tuple[int | None, bytes]], length: int):
    """Pieces (doc, start, ids, doc_tokens, sequence, offset) of documents laid end to end; sequences from 0."""
    sequence = offset = 0
    waiting: list[tuple] = []  # pieces of the sequence that isn't full
    for doc, data in docs:
        ids = np.frombuffer(data, "<u2")
        at = 0
        while at < len(ids):
            part = ids[at:at + length - offset]
            waiting.append((doc, at, part, len(ids)))
            at += len(part)
            offset += len(part)
            if offset == length:
                yield from _placed(waiting, sequence)
                waiting, offset, sequence = [], 0, sequence + 1
    for size in _cuts(offset):
        taken, room = [], size
        while room:
            doc, at, part, n = waiting.pop(0)
            taken.append((doc, at, part[:room], n))
            if len(part) > room:
                waiting.insert(0, (doc, at + room, part[room:], n))
            room -= len(taken[-1][2])
        yield from _placed(taken, sequence)
        sequence += 1


def _placed(pieces: list[tuple], sequence: int):
    offset = 0
    for doc, at, part, n in pieces:
        yield doc, at, len(part), part.astype("<u4").tobytes(), n, sequence, offset
        offset += len(part)


def pack(encoded: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """Pieces of PIECES from stored rows of ENCODED; ids are little-endian uint32."""
    order = ["key", "doc", "tie"]
    ranged = encoded.withColumn("tie", F.xxhash64("ids")).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        docs = ((d, i) for b in batches for d, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        laid = _laid(docs, length)
        while got := list(islice(laid, PIECES_AT_ONCE)):
            doc, at, size, ids, n, seq, offset = zip(*got)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc, pa.int64()), "start": pa.array(at, pa.int64()),
                "length": pa.array(size, pa.int64()), "ids": pa.array(ids, pa.binary()),
                "doc_tokens": pa.array(n, pa.int64()), "sequence_id": pa.array([base + s for s in seq], pa.int64()),
                "offset": pa.array(offset, pa.int64())})

    return ranged.select("doc", "ids").mapInArrow(tidied(run), PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, kind: str = "words", end_id: int = 1) -> DataFrame:
    """Encodes, orders and packs; the encoded documents are stored once, as ordering reads them twice."""
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.keep(encode(docs, tokenizer, kind, end_id), "encoded"))


def digest(docs: DataFrame, tokenizer: str, kind: str = "words", end_id: int = 1) -> DataFrame:
    out = pack_documents(docs, tokenizer, kind, end_id)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
