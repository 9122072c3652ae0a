"""Corpus pipeline over `documents`: language ID, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept, written as Parquet and read back. All but the last return the columns of
`documents`.

1. language ID: documents without a language, told with a score under one half,
   or no shorter in any language than plain bytes, go; `lang` becomes the
   predicted language.
2. line dedup: lines of at least 40 characters found in at least 5 documents
   stay in the largest id only.
3. MinHash near-dedup: of documents linked by five-word shingles at a similarity
   of 0.8 or more, the smallest id of each group stays.
4. mixing: four fifths of the tokens, by the weights of `mixing.WEIGHTS`, in at
   most two epochs; a document may come twice, and the last of a leaf is cut.
5. packing: pieces of sequences of 2048 ids along the Hilbert curve.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import langid, line_dedup, mixing, near_dup, packing
from tastegraph.llm.common import Scratch, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = langid.accepted(langid.score_rows(docs, langid.fit(docs)))
    return kept.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_first(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Byte context trees, MinHash and token ids are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{i}")
        if i > 1:
            scratch.drop(f"stage{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
