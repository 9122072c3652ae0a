"""Token ids as binary files: patched frame-of-reference blocks with an index of block starts.

A file holds the ids of a range of documents in ascending document order:

    b"PFOR0001"
    blocks, one for each 1024 ids (the last may be shorter):
        minimum uint32 | ids uint16 | width uint8 | 0 uint8 | exceptions uint16
        width x 32 uint32 words: the ids less the minimum, their low `width` bits, 32 lanes side by side
        exceptions: positions uint16 each, then whole differences uint32 each
    documents: id int64, id is null uint8, ids int64, as three columns
    index: file offset of each block, int64
    footer: blocks, documents, ids, offset of documents, offset of index, int64 each | b"PFOREND1"

The width of a block is that of its 90th percentile; larger differences are
exceptions. All numbers are little-endian. A task writes its file under another
name first and moves it when complete, and only files named by a finished
task's row are read, so a lost executor leaves nothing half-written in use.

Edge cases
* a vocabulary with ids above 65,535: an error;
* null or empty text: the end id alone;
* null document id: sorts first, kept as null;
* rows with equal ids: all kept, in order of their text's hash;
* an empty table writes no file and gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, text_slices, tidied, write_whole
from tastegraph.session import open_fs

BLOCK, LANES = 1024, 32
PERCENTILE = 0.9
HEAD, FOOT = b"PFOR0001", b"PFOREND1"
FILE_SCHEMA = "part int, path string, n_docs long, n_ids long, n_bytes long"
READ_BLOCKS = 512  # blocks decoded at a time


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits needed for each number below 2**32."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def pack_words(values: np.ndarray, width: int) -> np.ndarray:
    """Packs the low ``width`` bits of uint32 values [blocks, 1024] into words [blocks, width * 32]."""
    v = (values & np.uint32((1 << width) - 1)).reshape(len(values), BLOCK // LANES, LANES)
    out = np.zeros((len(values), width, LANES), np.uint32)
    for k in range(BLOCK // LANES):
        word, shift = divmod(k * width, 32)
        out[:, word] |= v[:, k] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= v[:, k] >> np.uint32(32 - shift)
    return out.reshape(len(values), -1)


def unpack_words(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of `pack_words`."""
    w = words.reshape(len(words), width, LANES)
    out = np.zeros((len(words), BLOCK // LANES, LANES), np.uint32)
    for k in range(BLOCK // LANES):
        word, shift = divmod(k * width, 32)
        out[:, k] = w[:, word] >> np.uint32(shift)
        if shift + width > 32:
            out[:, k] |= w[:, word + 1] << np.uint32(32 - shift)
    return (out & np.uint32((1 << width) - 1 if width < 32 else 0xFFFFFFFF)).reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of the ids, of which only the last may hold fewer than 1024."""
    n_blocks = -(-len(ids) // BLOCK)
    padded = np.full(n_blocks * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    padded[:len(ids)] = ids
    rows = padded.reshape(n_blocks, BLOCK)
    least = rows.min(axis=1)
    diff = rows - least[:, None]
    sizes = np.full(n_blocks, BLOCK)
    sizes[-1:] = len(ids) - (n_blocks - 1) * BLOCK
    mark = int(PERCENTILE * BLOCK)
    width = np.maximum(1, np.minimum(31, _bits(np.partition(diff, mark, axis=1)[:, mark])))
    out: list = [None] * n_blocks
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        words = pack_words(diff[which], w)
        for i, row in zip(which.tolist(), words):
            over = np.flatnonzero(diff[i, :sizes[i]] >> np.uint32(w))
            out[i] = b"".join((struct.pack("<IHBBH", least[i], sizes[i], w, 0, len(over)), row.tobytes(),
                               over.astype("<u2").tobytes(), diff[i, over].astype("<u4").tobytes()))
    return out


def decode_blocks(data: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks that start at the given offsets of ``data``."""
    heads = [struct.unpack_from("<IHBBH", data, s) for s in starts]
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in {h[2] for h in heads}:
        which = [i for i, h in enumerate(heads) if h[2] == w]
        words = np.stack([np.frombuffer(data, "<u4", w * LANES, starts[i] + 10) for i in which])
        out[which] = unpack_words(words, w)
    for i, (least, size, w, _, over) in enumerate(heads):
        if over:
            at = starts[i] + 10 + w * LANES * 4
            out[i, np.frombuffer(data, "<u2", over, at)] = np.frombuffer(data, "<u4", over, at + 2 * over)
        out[i] += np.uint32(least)
    if heads and heads[-1][1] < BLOCK:
        return out.reshape(-1)[:(len(heads) - 1) * BLOCK + heads[-1][1]]
    return out.reshape(-1)


def file_chunks(docs: Iterator[tuple[list, np.ndarray, np.ndarray]], told: dict) -> Iterator[bytes]:
    """The bytes of one file. docs: (document ids, ids, ids of each document), batch by batch."""
    yield HEAD
    at, index, names, counts = len(HEAD), [], [], []
    rest = np.zeros(0, np.uint32)
    for doc_ids, ids, n in docs:
        names += doc_ids
        counts.append(n)
        rest = np.concatenate([rest, ids])
        whole = len(rest) // BLOCK * BLOCK
        if whole:
            for block in encode_blocks(rest[:whole]):
                index.append(at)
                at += len(block)
                yield block
            rest = rest[whole:]
    for block in encode_blocks(rest) if len(rest) else []:
        index.append(at)
        at += len(block)
        yield block
    n = np.concatenate([*counts, np.zeros(0, np.int64)]).astype("<i8")
    null = np.fromiter((x is None for x in names), np.uint8, len(names))
    table = np.fromiter((x or 0 for x in names), "<i8", len(names)).tobytes() + null.tobytes() + n.tobytes()
    yield table
    yield np.asarray(index, "<i8").tobytes()
    yield struct.pack("<5q", len(index), len(names), int(n.sum()), at, at + len(table)) + FOOT
    told |= {"n_docs": len(names), "n_ids": int(n.sum())}


class TokenFile:
    """Reads one file: its documents, and any range of its ids through the index."""

    def __init__(self, uri: str):
        f, path = open_fs(uri)
        self.file = f.open_input_file(path)
        size = self.file.size()
        foot = self._at(size - 48, 48)
        if foot[40:] != FOOT or self._at(0, 8) != HEAD:
            raise ValueError(f"{uri} is not a token file")
        blocks, docs, self.n_ids, docs_at, index_at = struct.unpack("<5q", foot[:40])
        self.blocks_end = docs_at
        table = self._at(docs_at, 17 * docs)
        ids = np.frombuffer(table, "<i8", docs)
        null = np.frombuffer(table, np.uint8, docs, 8 * docs)
        self.doc_ids = [None if z else int(x) for x, z in zip(ids, null)]
        self.counts = np.frombuffer(table, "<i8", docs, 9 * docs)
        self.index = np.frombuffer(self._at(index_at, 8 * blocks), "<i8")

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """The ids [start, start + n), reading only the blocks that hold them."""
        n = max(0, min(n, self.n_ids - start))
        if not n:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-(start + n) // BLOCK)
        lo = int(self.index[a])
        hi = int(self.index[b]) if b < len(self.index) else self.blocks_end
        got = decode_blocks(self._at(lo, hi - lo), (self.index[a:b] - lo).tolist())
        return got[start - a * BLOCK:start - a * BLOCK + n]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(document, its start in the file, ids, crc32 of the ids), a few blocks of ids at a time."""
        step = READ_BLOCKS * BLOCK
        ends = np.cumsum(self.counts)
        begin = base = 0
        have = self.ids(0, step).astype("<u4")
        for doc, end in zip(self.doc_ids, ends.tolist()):
            crc, at = 0, begin
            while at < end:
                if at >= base + len(have):
                    base += len(have)
                    have = self.ids(base, step).astype("<u4")
                part = have[at - base:end - base]
                crc = zlib.crc32(part.tobytes(), crc)
                at += len(part)
            yield doc, begin, end - begin, crc
            begin = end

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, kind: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A lazy frame of FILE_SCHEMA whose tasks write one file for each range of ids. Store it before use."""
    ordered = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie").drop("tie")

    def write(batches):
        from tastegraph.llm.tokens import encoder

        enc, part = encoder(tokenizer, kind), TaskContext.get().partitionId()

        def encoded(first):
            for batch in chain([first], batches):
                texts = batch.column(1)
                for a, b in text_slices(texts):
                    ids, n = enc.encode(texts.slice(a, b - a).to_pylist())
                    out = np.full(len(ids) + len(n), end_id, np.uint32)
                    out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                    yield batch.column(0).slice(a, b - a).to_pylist(), out, n + 1

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        told: dict = {}
        path = f"{folder}/tokens-{part:06d}-{TaskContext.get().taskAttemptId()}.pfor"
        size = write_whole(path, file_chunks(encoded(first), told))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "path": [path], "n_docs": [told["n_docs"]],
            "n_ids": [told["n_ids"]], "n_bytes": [size]})

    return ordered.mapInArrow(tidied(write), FILE_SCHEMA)


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files named by stored rows of FILE_SCHEMA.

    The number of files is the number of writing tasks, so their starts are summed on the driver.
    """
    spark = files.sparkSession
    rows, base = [], 0
    for r in sorted(files.collect(), key=lambda r: r.part):
        rows.append((r.path, base))
        base += r.n_ids

    def read(batches):
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                file = TokenFile(path)
                got = list(file.documents())
                for i in range(0, len(got), 10_000):
                    doc, start, n, crc = zip(*got[i:i + 10_000])
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc, pa.int64()), "start": pa.array([base + s for s in start], pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})
                file.close()

    named = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))
    return named.mapInArrow(tidied(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame, tokenizer: str, kind: str = "bytes", end_id: int = 2) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "tokens")
    files = scratch.keep(write_tokens(docs, scratch.path("files"), tokenizer, kind, end_id), "manifest")
    return read_documents(files)
