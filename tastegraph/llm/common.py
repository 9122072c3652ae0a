"""Helpers shared by the operators: scratch tables in the shared folder, and URI file access from tasks."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.session import ensure_checkpoint_dir, new_folder, open_fs, ship

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def bound(value: Column, use) -> Column:
    """use(value), with the value computed once: a lambda variable can't be inlined into a loop over it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Scratch:
    """Intermediate tables of one operator call, in the shared folder named by ``spark.checkpoint.dir``.

    ``keep`` writes a frame as Parquet and reads it back, which cuts the lineage:
    a lost executor costs a re-read, not a re-run. ``drop`` removes tables whose
    last reader has run; what the returned frame still reads goes with
    `session.drop_tables`, at the latest when the program ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        if not ensure_checkpoint_dir(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        self.spark, self.uri = ship(spark), new_folder(spark, name)

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            f, p = open_fs(self.path(name))
            if f.get_file_info(p).type != pafs.FileType.NotFound:
                f.delete_dir(p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Returns memory that allocators keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidied(run):
    """A task function that gives memory back when its partition is done: Python workers live on between tasks,
    and what is kept adds up over the stages of a program."""
    def done(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return done


def text_slices(texts, target_chars: int = 1 << 19):
    """Row ranges of an Arrow string array, each of about ``target_chars`` bytes, or one row if that is longer."""
    n = len(texts)
    if not n:
        return
    sizes = [x or 0 for x in pc.binary_length(texts).to_pylist()]
    a, total = 0, 0
    for i, size in enumerate(sizes):
        if i > a and total + size > target_chars:
            yield a, i
            a, total = i, 0
        total += size
    yield a, n


def write_whole(uri: str, chunks) -> int:
    """Writes chunks of bytes to a file that is visible under its name only when complete; returns its size."""
    f, path = open_fs(uri)
    parent, _, name = path.rpartition("/")
    f.create_dir(parent, recursive=True)
    part = f"{parent}/_part-{uuid.uuid4().hex}"
    size = 0
    with f.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    f.move(part, f"{parent}/{name}")
    return size


MOST_BITS = 1 << 24  # of a filter; 2 MB on the driver and in each task, however much is put in


def filter_bits(values: DataFrame, n: int) -> np.ndarray:
    """A filter of the values of a long column, as 64-bit words: a join's other side can leave out rows before the shuffle.

    Its size is bounded: with very many values it lets more through, never less,
    so a join must follow.
    """
    bits = max(1 << 12, min(MOST_BITS, 1 << (8 * n).bit_length()))

    def words_of(batches):
        for batch in batches:
            at = _place(batch.column(0).to_numpy(zero_copy_only=False), bits)
            word, back = np.unique(at >> np.uint64(6), return_inverse=True)
            out = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(out, back, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_pydict({"word": word.astype(np.int64), "bits": out.view(np.int64)})

    rows = values.mapInArrow(words_of, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def may_hold(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False for values that are not in the filter."""
    at = _place(values, 64 * len(words))
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _place(values: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(32))) & np.uint64(bits - 1)
