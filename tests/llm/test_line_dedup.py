"""Line dedup against a plain version, bitmaps, hot lines, edge cases."""

import hashlib
from collections import defaultdict

import duckdb
from conftest import SF001
from pyspark.sql import functions as F

from tastegraph.llm import line_dedup

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    """rows: (id, text); each id counts as a document. Returns (id, lines, dropped, text)."""
    key = lambda line: line.strip(STRIP).translate(LOWER)
    rank = lambda i: (i is not None, i or 0)  # noqa: E731  null ids are smallest
    holders = defaultdict(set)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(map(rank, holders[key(x)])) == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


def result(df, **args):
    out = line_dedup.dedup_lines(df, **args)
    return sorted(str((r.doc_id, r._lines.n_lines, r._lines.n_dropped, r.text or "")) for r in out.collect())


def test_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(df) == brute(rows)
    assert result(df, min_chars=5, min_docs=2) == brute(rows, 5, 2)
    digests = {r.doc_id: r.kept_sha256 for r in line_dedup.digest(df).collect()}
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert digests == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def test_edge_cases(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(odd_docs) == brute(rows)
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "_lines"]
    same = odd_docs.where("doc_id < 4").select("doc_id", "text").collect()
    kept = {(r.doc_id, r.text) for r in out.where("doc_id < 4").collect()}
    assert kept == {(r.doc_id, r.text) for r in same}  # null stays null, empty stays empty
    assert line_dedup.dedup_lines(no_docs).count() == 0 and line_dedup.digest(no_docs).count() == 0


def test_hot_line_and_long_document(spark):
    hot = "a line that a third of all the documents hold, and then some"
    rows = [(i, f"{hot}\nown line of document number {i}, which nobody else has\n{hot}") for i in range(300)]
    rows.append((1000, "\n".join([hot if i % 70 == 3 else f"line {i}" for i in range(5000)])))
    rows += [(None, hot), (1, hot)]  # a null id, and an id that comes twice
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(df) == brute(rows)
    assert line_dedup.dedup_lines(df).where("doc_id = 1000").first()._lines.n_dropped == 0


def test_documents_are_told_by_their_ids(spark):
    line = "a line of at least forty characters that several rows hold"
    for rows in ([(7, f"{line}\n{i}") for i in range(4)] + [(8, line)], [(7, line)] * 4 + [(8, line)],
                 [(7, line)] * 4 + [(None, line), (None, f"{line}\nx")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert result(df) == brute(rows) and sum(r._lines.n_dropped for r in line_dedup.dedup_lines(df).collect()) == 0
    rows = [(i, line) for i in (7, 7, 8, 9, 10, None)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    values = ", ".join(f"({i}, '{t}')" for i, t in [(7, f"{line}\n{n}") for n in range(4)] + [(8, line)])
    sql = line_dedup.SQL.replace("FROM documents", f"FROM (VALUES {values}) AS d(doc_id, text)")
    assert sum(r[2] for r in duckdb.sql(sql).fetchall()) == 0


def test_clashing_names(spark):
    line = "a line of at least forty characters that several rows hold"
    names = ["doc_id", "text", "_lines", "__lines", "_row", "_doc", "_tid", "words", "h1", "place"]
    rows = [(i, line, *range(8)) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} int" for c in names[2:]))
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*names, "___lines"]
    got = sorted(tuple(r) for r in out.select(*names).collect())
    assert got == [(i, line if i == 5 else "", *range(8)) for i in range(6)]


def test_bitmaps_are_compressed(spark):
    line = "the same long line is held by six documents in all, at the end"
    rows = [(i, "\n".join(["x"] * 1000 + [line])) for i in range(6)]
    maps = line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc for r in maps) == [0, 1, 2, 3, 4]
    assert all(r.n_dropped == 1 and [tuple(w) for w in r.words] == [(1000 // 64, 1 << 1000 % 64)] for r in maps)


def test_hot_line_spans_ranges(spark):
    """Rows of one key are dealt by document too, so no task needs all of them."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one line of forty characters or more, for everybody").alias("text"))
    held = line_dedup.occurrences(line_dedup.line_hashes(docs, "doc_id", "text", 40))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = held.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1
