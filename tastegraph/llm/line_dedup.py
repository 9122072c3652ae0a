"""Line dedup: range-partitioned line hashes, streamed first occurrences, per-document keep bitmaps.

Every line long enough to count gets a 128-bit hash of its key (stripped, A-Z
lower-cased). The hashes are range-partitioned by (hash, document descending) and
sorted by position as well, so a key shared by a third of all documents spans as
many ranges as its rows need. A row's place in that stream of ranges tells the
first occurrences: each range reduces a key, as it streams past, to its first
place and its number of documents, so that of a key cut by the edges of ranges
one row for each range is carried over. The document at the first place keeps
the key's lines; the others' lines are marked in a bitmap. Text itself takes no part
in these shuffles; it is moved once, to meet its bitmap.

Only DataFrame functions are used.

Edge cases
* null or empty text: one empty line, nothing dropped;
* a document is an id: rows that share one, equal or not, count once, and keep or lose a key together;
* rows with a null id are one document, that sorts below all ids;
* an empty table gives an empty result; extra columns pass through `dedup_lines` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import LOWER, SPACES, UPPER, Scratch, ascii_lower, bound

WORD = 64  # lines per bitmap word


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_id(text: Column) -> Column:
    """With the document id this names a row; rows equal in both get equal bitmaps."""
    return F.xxhash64(text)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, tid, pos) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.select(docs[id_col].alias("doc"), text_id(docs[text_col]).alias("tid"),
                        F.posexplode(_lines(docs[text_col])).alias("pos", "line"))
    # no stripped line is longer than the line itself
    keyed = (lines.where(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
             .where(F.char_length("key") >= min_chars))
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
                        "doc", "tid", "pos")


def occurrences(hashed: DataFrame) -> DataFrame:
    """One row per (key hash, document) with the lines of that key and the row's place, streamed in range order."""
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last()]
    held = (hashed.repartitionByRange(*order).sortWithinPartitions(*order, "tid", "pos")
            .groupBy("h1", "h2", "doc").agg(F.collect_list(F.struct("tid", "pos")).alias("lines")))
    # ranges are numbered in order, and the rows of a range are grouped in order
    return held.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Bitmaps of the lines to drop, for documents that lose any.

    Keys of at least ``min_chars`` code points held by at least ``min_docs``
    documents lose their lines everywhere but in the largest id holding them.
    Returns (doc, tid, n_dropped, words): ``words`` is the compressed bitmap, an
    array of (word, bits) in order of word, in which a set bit is a dropped line
    and words of 64 kept lines are left out.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    # stored: finding the ranges, the first occurrences and their join each read the hashes, and none the text again
    held = occurrences(scratch.keep(line_hashes(docs, id_col, text_col, min_chars), "hashes"))
    first = (held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min_by("doc", "place").alias("keeper"))
             .where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"))
    # a stored table, so that both join sides are plain shuffles, which AQE can split at a hot key
    first = scratch.keep(first, "first")
    lost = held.join(first, ["h1", "h2"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    bits = (lost.select("doc", F.explode("lines").alias("line")).select("doc", "line.tid", "line.pos")
            .groupBy("doc", "tid", F.expr(f"cast(pos div {WORD} as int)").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits")))
    return bits.groupBy("doc", "tid").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))


def _dense(words: Column) -> Column:
    """The bitmap with its left-out words, so that a line finds its word by position."""
    def fill(w: Column, i: Column) -> Column:
        before = F.coalesce(F.get(words, i - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0).cast("long"), w["word"] - before - 1), F.array(w["bits"]))
    return F.flatten(F.transform(words, fill))


def kept_text(text: Column, words: Column) -> Column:
    """The lines whose bit is not set in the bitmap."""
    def of(dense: Column) -> Column:
        return F.array_join(F.filter(_lines(text), lambda _, i: F.coalesce(
            F.getbit(F.get(dense, F.floor(i / WORD).cast("int")), i % WORD) == 0, F.lit(True))), "\n")
    return bound(_dense(words), of)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents without their repeated lines, plus ``n_lines`` and ``n_dropped`` in a last column, a struct.

    It is named ``_lines``, with more underscores in front where a column has that name.
    """
    told = "_lines"
    while told in docs.columns:
        told = "_" + told
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
                       docs[id_col].alias("_doc"), text_id(docs[text_col]).alias("_tid"))
    met = rows.join(bitmaps, rows["_doc"].eqNullSafe(bitmaps["doc"]) & (rows["_tid"] == bitmaps["tid"]), "left")
    text = F.col("_row")[text_col]
    kept = kept_text(text, F.col("words"))
    n_lines = F.char_length(F.coalesce(text, F.lit(""))) - F.char_length(
        F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(""))) + 1
    return met.select(
        *[F.when(F.col("words").isNull(), text).otherwise(kept).alias(c) if c == text_col
          else F.col("_row")[c].alias(c) for c in docs.columns],
        F.struct(n_lines.cast("long").alias("n_lines"),
                 F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped")).alias(told))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of `dedup_lines` over documents."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "_lines.n_lines", "_lines.n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: Pieces of DuckDB SQL: {docs} is a table with doc_id and text.
LINES_SQL = f"""
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {{docs}})),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
          FROM lines),
hot AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND k.doc_id <> h.keeper AS dropped
           FROM keyed k LEFT JOIN hot h ON k.key = h.key),
kept_lines AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
                      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') AS text
               FROM marked GROUP BY doc_id)
"""
SQL = f"""WITH {LINES_SQL.format(docs="documents")}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept_lines"""
