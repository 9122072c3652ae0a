"""Registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from public_tokenizers import path as tokenizer_path

from tastegraph.llm import (
    ann, collocations, hard_negatives, html_extract, imatch, langid, line_dedup, mixing, near_dup, packing, pieces, token_files, warc,
)
from tastegraph.llm.common import table


def op1_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op2_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op4_pruned_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.digest(table(spark, sf_dir, "embeddings"))


def op5_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op7_hamming_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.digest(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.digest(table(spark, sf_dir, "documents"))


def op10_tree_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.digest(table(spark, sf_dir, "documents"))


def op12_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op13_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hierarchical_mix": op1_hierarchical_mix,
    "op2_hilbert_pack": op2_hilbert_pack,
    "op3_ppm_langid": op3_ppm_langid,
    "op4_pruned_graph_ann": op4_pruned_graph_ann,
    "op5_pfor_tokens": op5_pfor_tokens,
    "op6_line_dedup": op6_line_dedup,
    "op7_hamming_neardup": op7_hamming_neardup,
    "op8_warc": op8_warc,
    "op9_imatch": op9_imatch,
    "op10_tree_extract": op10_tree_extract,
    "op11_collocations": op11_collocations,
    "op12_piece_agenda": op12_piece_agenda,
    "op13_cover_tree_negatives": op13_cover_tree_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_hierarchical_mix": mixing.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op8_warc": warc.SQL,
    "op9_imatch": imatch.SQL,
    "op11_collocations": collocations.SQL,
    "op13_cover_tree_negatives": hard_negatives.SQL,
}
