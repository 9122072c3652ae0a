"""I-Match fingerprints: terms of a middle frequency band, sorted and hashed over random subsets of the lexicon.

Document frequencies are counted over distinct texts. The lexicon's band holds
the terms found in at least a thousandth and at most a twentieth of them (and in
two at least), so it has at most a thousand times as many terms as a text has on
average, whatever the corpus. Where near copies of one text make more than a
twentieth, its words are above the band; common terms, those above it, are kept
apart for that. The lexicon is broadcast only after its size has been counted.

Every term belongs to random subsets, told by hex digits of its SHA-256: a term of
the band at four rates, a common one at the first three. A fingerprint is 85 fields: the
hash of all of a text's terms in the band, of those in each subset, and of its
common terms in each subset ("-" if there are none). The likeness of two
fingerprints is 1 if the first fields agree, else the largest share, over the
rates, of agreeing subsets among those not empty in both. Low rates serve long
texts, high rates short. Common terms count only where the band says little of
either text: fewer than half of its subsets at the highest rate have any term.

Only DataFrame functions are used.

Edge cases
* null or empty text: no terms; a text without terms in the band has the hash of the text in its first field;
* repeated rows and copies count once for the frequencies;
* null ids come last in the order of documents; rows with equal ids are ordered by their text's hash;
* a single document is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, bound

LOW, HIGH = 0.001, 0.05  # band of document frequency, as shares of the documents
SUBSETS = 12  # of each rate
#: Hex digits that must be zero, and whether one more must be below 4: rates 1/16, 1/64, 1/256, 1/1024.
RATES = ((1, False), (1, True), (2, False), (2, True))
COMMON_RATES = 3  # the first of them, for common terms
THIN = SUBSETS // 2  # fewer fields of the highest rate with a term in the band say too little
BROADCAST_TERMS = 1_000_000
BUCKET_DOCS = 1000
RANGES = 1000  # of ids, whose bounds are told in the plan


def mask_sql(hex_digits: str) -> str:
    """SQL, for Spark and DuckDB alike: the subsets of a term as bits of a number, from its 128 hex digits."""
    cases, at, bit = [], 1, 0
    for zeros, more in RATES:
        for _ in range(SUBSETS):
            test = f"substr({hex_digits}, {at}, {zeros}) = '{'0' * zeros}'"
            if more:
                test += f" AND substr({hex_digits}, {at + zeros}, 1) IN ('0', '1', '2', '3')"
            cases.append(f"CASE WHEN {test} THEN {1 << bit} ELSE 0 END")
            at += zeros + more
            bit += 1
    return "CAST(" + " + ".join(cases) + " AS BIGINT)"


def terms(text: Column) -> Column:
    """The empty word, which stands for the text itself, and the distinct lower-case words of a text."""
    spaced = F.translate(F.lower(text), "\t\n\x0b\x0c\r", "     ")
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(spaced, " ")))


def distinct_texts(docs: DataFrame, text_col: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """(text) of the distinct texts, null being empty, and how many they are; only texts with copies are shuffled."""
    rows = docs.select(F.coalesce(docs[text_col], F.lit("")).alias("text"))
    keyed = rows.select("text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2"))
    copies = scratch.keep(keyed.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "copies")
    n_copied, spare = copies.agg(F.count(F.lit(1)), F.sum(F.col("c") - 1)).first()
    hint = F.broadcast if n_copied <= BROADCAST_TERMS else (lambda df: df)
    copied = hint(copies.select("t1", "t2"))
    once = keyed.join(copied, ["t1", "t2"], "left_anti").select("text")
    several = keyed.join(copied, ["t1", "t2"], "left_semi").groupBy("t1", "t2").agg(F.min("text").alias("text"))
    return once.unionByName(several.select("text")), docs.count() - int(spare or 0)


def lexicon(docs: DataFrame, text_col: str, scratch: Scratch, low: float = LOW, high: float = HIGH) -> tuple[DataFrame, int]:
    """(term, mask, common) of the terms in the band and above it, and of the empty word; and how many they are."""
    texts, n = distinct_texts(docs, text_col, scratch)
    found = (texts.select(F.explode(terms(F.col("text"))).alias("term"))
             .where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    band = found.where(F.col("df") >= max(2.0, low * n)).select("term", (F.col("df") > max(2.0, high * n)).alias("common"))
    digits = band.withColumn("digits", F.concat(F.sha2("term", 256), F.sha2(F.concat("term", F.lit("#")), 256)))
    kept = digits.select("term", F.expr(mask_sql("digits")).alias("mask"), "common")
    # a common term that is in no subset says nothing
    drawn = F.col("mask").bitwiseAND(F.lit((1 << COMMON_RATES * SUBSETS) - 1)) != 0
    kept = scratch.keep(kept.where(~F.col("common") | drawn), "lexicon")
    empty = docs.sparkSession.createDataFrame([("", 0, False)], "term string, mask long, common boolean")
    return kept.unionByName(empty), kept.count() + 1


def _hash(text: Column) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, 8)


def _of_subsets(found: Column, mask: Column) -> Column:
    return F.filter(found, lambda x: x["mask"].bitwiseAND(mask) != 0)


def by_rate(found: Column, rates: int = len(RATES)) -> Column:
    """The lexicon terms that are in any subset of each rate, so that a subset is picked from few."""
    masks = [sum(1 << b for b in range(i * SUBSETS, (i + 1) * SUBSETS)) for i in range(rates)]
    return F.array(*[_of_subsets(found, F.lit(m)) for m in masks])


def fingerprint(found: Column, whole: Column) -> Column:
    """found: array of (term, mask, common) in order; whole: the text's hash, which stands in if the band has no term."""
    joined = lambda a: F.array_join(F.transform(a, lambda x: x["term"]), " ")

    def field(rates: Column, k: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        own = joined(_of_subsets(F.get(rates, F.floor(k / SUBSETS).cast("int")), bit))
        return bound(own, lambda s: F.when(s == "", F.lit("-")).otherwise(_hash(s)))

    def subsets(terms_found: Column, rates: int) -> Column:
        each = F.sequence(F.lit(0), F.lit(rates * SUBSETS - 1))
        return bound(by_rate(terms_found, rates), lambda some: F.transform(each, lambda k: field(some, k)))

    def fields(terms_found: Column) -> Column:
        first = F.when(F.size(terms_found) > 0, _hash(joined(terms_found))).otherwise(whole)
        return F.concat(F.array(first), subsets(terms_found, len(RATES)))

    band, common = F.filter(found, lambda x: ~x["common"]), F.filter(found, lambda x: x["common"])
    return F.concat(bound(band, fields), bound(common, lambda c: subsets(c, COMMON_RATES)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, of two fingerprints as arrays of fields."""
    shares = []
    for level in range(len(RATES) + COMMON_RATES):
        x, y = (F.slice(c, 2 + level * SUBSETS, SUBSETS) for c in (a, b))
        pairs = F.zip_with(x, y, lambda p, q: F.when((p == "-") & (q == "-"), F.lit(0))
                           .when(p == q, F.lit(2)).otherwise(F.lit(1)))
        either = F.size(F.filter(pairs, lambda v: v > 0))
        same = F.size(F.filter(pairs, lambda v: v == 2))
        shares.append(F.when(either > 0, same / either).otherwise(F.lit(0.0)))
    told = [F.size(F.filter(F.slice(c, 2, SUBSETS), lambda v: v != "-")) for c in (a, b)]
    return (F.when(F.get(a, F.lit(0)) == F.get(b, F.lit(0)), F.lit(1.0))
            .when(F.least(*told) < THIN, F.greatest(*shares)).otherwise(F.greatest(*shares[:len(RATES)])))


def _numbers(values: list[int]) -> Column:
    """A list of numbers as one constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _passed(bounds: Column, most: int, value: Column) -> Column:
    """How many of at most ``most`` ascending bounds are at most the value, by halving; 0 for null."""
    steps = [1 << k for k in range(most.bit_length() - 1, -1, -1)]
    if not steps:
        return F.lit(0).cast("long")
    return F.aggregate(_numbers(steps), F.lit(0).cast("long"), lambda at, s: F.when(
        F.get(bounds, (at + s - 1).cast("int")) <= value, at + s).otherwise(at))


def _shares(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def neighbours(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> tuple[DataFrame, Window]:
    """Documents dealt to buckets of id ranges, with the next document's text.

    The buckets hold about BUCKET_DOCS documents, however many there are: at most
    RANGES ranges of equal size are told by bounds in the plan, and each is cut into
    buckets by bounds of its own, which a small table holds. Each bucket also gets,
    marked as a copy, the first document of the bucket that follows in descending
    order (the last bucket: that of the first), so that the order needs no task that
    sees all documents. Rows: (bucket, copy, doc, tid, text); the window orders a bucket.
    """
    ids = docs.select(docs[id_col].cast("long").alias("doc"))
    wanted = docs.count() // BUCKET_DOCS + 1
    ranges = min(RANGES, wanted)
    cuts = -(-wanted // ranges)  # buckets of a range
    least, marks = ids.agg(F.min("doc"), F.percentile_approx("doc", _shares(ranges) or [0.5])).first()
    bounds = sorted({x for x in marks or [] if x > least}) if ranges > 1 else []
    part = _passed(_numbers(bounds), len(bounds), F.col("doc")).alias("range")
    dealt = ids.select("doc", part)
    # a range's bounds are ids in it but its smallest, so that no bucket is empty
    own = F.filter("marks", lambda x: x > F.col("least")) if cuts > 1 else F.array().cast("array<bigint>")
    marked = dealt.groupBy("range").agg(F.min("doc").alias("least"), F.percentile_approx("doc", _shares(cuts) or [0.5]).alias("marks"))
    marked = scratch.keep(marked.select("range", F.coalesce(F.array_sort(F.array_distinct(own)), F.array().cast("array<bigint>")).alias("marks")), "ranges")
    hint = F.broadcast if wanted <= BROADCAST_TERMS else (lambda df: df)
    cut = _passed(F.col("marks"), cuts - 1, F.col("doc"))
    tops = (dealt.join(hint(marked), "range").select("range", cut.alias("cut"), "doc").groupBy("range", "cut").agg(F.max("doc").alias("top"))
            .groupBy("range").agg(F.array_sort(F.collect_list(F.struct("cut", "top"))).alias("tops")))
    places = scratch.keep(marked.join(tops, "range").select("range", "marks", F.col("tops.top").alias("tops")), "places")
    rows = docs.select(docs[id_col].cast("long").alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("tid", F.xxhash64("text")).withColumn("range", part).join(hint(places), "range").withColumn("cut", cut)
    is_head = F.get("tops", F.col("cut").cast("int")).eqNullSafe(F.col("doc"))
    bucket = F.col("range") * cuts + F.col("cut")
    following = F.when(F.col("range") == len(bounds), F.lit(0).cast("long")).otherwise((F.col("range") + 1) * cuts)
    follows = F.when(F.col("cut") < F.size("marks"), bucket + 1).otherwise(following)
    own_place, also = F.struct(bucket.alias("bucket"), F.lit(False).alias("copy")), F.struct(follows.alias("bucket"), F.lit(True).alias("copy"))
    placed = rows.select("doc", "tid", "text", F.explode(
        F.when(is_head, F.array(own_place, also)).otherwise(F.array(own_place))).alias("at"))
    order = Window.partitionBy("bucket").orderBy("copy", F.col("doc").desc_nulls_last(), "tid")
    return placed.select("at.bucket", "at.copy", "doc", "tid", "text"), order


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 low: float = LOW, high: float = HIGH) -> DataFrame:
    """The contract's columns: fingerprints of each text, of its edited text, and their likeness."""
    scratch = Scratch(docs.sparkSession, "imatch")
    lex, size = lexicon(docs, text_col, scratch, low, high)
    lex = F.broadcast(lex) if size <= BROADCAST_TERMS else lex
    placed, order = neighbours(docs, id_col, text_col, scratch)
    n_chars = F.char_length("text")
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    texts = (placed.withColumn("next", F.lead("text").over(order)).withColumn("row", F.row_number().over(order))
             .withColumn("n_chars", n_chars.cast("long"))
             .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
                                            F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut))))
    each = texts.select(
        "bucket", "row", F.struct("copy", "doc", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("sha")).alias("about"),
        F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text")),
                          F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")))).alias("t"))
    each = each.select("bucket", "row", "t.is_edited", "about", _hash(F.col("t.text")).alias("whole"),
                       F.posexplode(terms(F.col("t.text"))).alias("pos", "term"))
    # what is known of the text goes with its empty word only, so that the other words' rows are short
    each = each.select("bucket", "row", "is_edited", "term", F.when(F.col("pos") == 0, F.struct("about", "whole")).alias("text"))
    met = each.join(lex, "term")
    some = lambda edited: F.array_sort(F.collect_list(F.when(
        (F.col("is_edited") == F.lit(edited)) & (F.col("term") != ""), F.struct("term", "mask", "common"))))
    told = lambda edited: F.first(F.when(F.col("is_edited") == F.lit(edited), F.col("text")), ignorenulls=True)
    found = met.groupBy("bucket", "row").agg(some(False).alias("own"), told(False).alias("own_text"),
                                             some(True).alias("changed"), told(True).alias("changed_text"))
    found = found.select("bucket", "row", "own_text.about.*", "own", F.col("own_text.whole").alias("own_whole"),
                         "changed", F.col("changed_text.whole").alias("changed_whole"))
    # a copy's own fingerprint is only read by the document before it
    prints = found.select(
        "bucket", "row", "copy", "doc", "n_chars", "sha", fingerprint(F.col("own"), F.col("own_whole")).alias("a"),
        F.when(~F.col("copy"), fingerprint(F.col("changed"), F.col("changed_whole"))).alias("b"))
    again = Window.partitionBy("bucket").orderBy("row")
    prints = prints.withColumn("c", F.lead("a").over(again)).where(~F.col("copy"))
    return prints.select(
        F.col("doc").alias("doc_id"), "n_chars", F.col("sha").alias("edited_sha256"),
        F.array_join("a", " ").alias("fingerprint"), F.array_join("b", " ").alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"))


def digest(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)


def _likeness_sql(a: str, b: str) -> str:
    """Over rows (doc_id, k, fa, fb, fc) of fields, for the subsets of each rate."""
    shares = []
    for level in range(len(RATES) + COMMON_RATES):
        span = f"k BETWEEN {1 + level * SUBSETS} AND {(level + 1) * SUBSETS}"
        shares.append(f"coalesce(count(*) FILTER ({span} AND {a} = {b} AND {a} <> '-') / "
                      f"nullif(count(*) FILTER ({span} AND ({a} <> '-' OR {b} <> '-')), 0), 0.0)")
    told = ", ".join(f"count(*) FILTER (k BETWEEN 1 AND {SUBSETS} AND {x} <> '-')" for x in (a, b))
    return (f"CASE WHEN bool_or(k = 0 AND {a} = {b}) THEN 1.0 WHEN least({told}) < {THIN} THEN greatest({', '.join(shares)}) "
            f"ELSE greatest({', '.join(shares[:len(RATES)])}) END")


SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC) AS following, first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC) AS first_text,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id FROM documents),
e AS (SELECT *, substr(text, 1, n - n // 3) || substr(coalesce(following, first_text), 1, n // 3) AS edited FROM d),
x AS (SELECT doc_id, 0 AS v, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
w AS (SELECT doc_id, v, unnest(list_distinct(string_split(translate(lower(text), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '))) AS term FROM x),
one AS (SELECT min(doc_id) AS doc_id FROM d GROUP BY text),
lex AS (SELECT term, df > greatest(2, {HIGH} * (SELECT count(*) FROM one)) AS common, {mask_sql("digits")} AS mask
    FROM (SELECT term, count(*) AS df, sha256(term) || sha256(term || '#') AS digits FROM w JOIN one ON w.doc_id = one.doc_id
    WHERE v = 0 AND term <> '' GROUP BY term HAVING count(*) >= greatest(2, {LOW} * (SELECT count(*) FROM one)))),
k AS (SELECT unnest(generate_series(0, {(len(RATES) + COMMON_RATES) * SUBSETS})) AS k),
hit AS (SELECT doc_id, v, k, substr(md5(string_agg(w.term, ' ' ORDER BY w.term)), 1, 8) AS f
    FROM w JOIN lex ON w.term = lex.term JOIN k ON CASE WHEN common THEN k > {len(RATES) * SUBSETS} AND (mask >> greatest(k - {len(RATES) * SUBSETS + 1}, 0)) & 1 = 1
        ELSE k = 0 OR (k <= {len(RATES) * SUBSETS} AND (mask >> greatest(k - 1, 0)) & 1 = 1) END GROUP BY doc_id, v, k),
fields AS (SELECT x.doc_id, x.v, k.k, coalesce(f, CASE WHEN k.k = 0 THEN substr(md5(x.text), 1, 8) ELSE '-' END) AS f
    FROM x, k LEFT JOIN hit ON hit.doc_id = x.doc_id AND hit.v = x.v AND hit.k = k.k),
three AS (SELECT e.doc_id, e.n, e.edited, a.k, a.f AS fa, b.f AS fb, c.f AS fc FROM e JOIN fields a ON a.doc_id = e.doc_id AND a.v = 0
    JOIN fields b ON b.doc_id = e.doc_id AND b.v = 1 AND b.k = a.k JOIN fields c ON c.doc_id = e.next_id AND c.v = 0 AND c.k = a.k)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_chars, sha256(any_value(edited)) AS edited_sha256,
    string_agg(fa, ' ' ORDER BY k) AS fingerprint, string_agg(fb, ' ' ORDER BY k) AS edited_fingerprint,
    CAST({_likeness_sql('fa', 'fb')} AS DOUBLE) AS near_edited, CAST({_likeness_sql('fa', 'fc')} AS DOUBLE) AS near_next FROM three GROUP BY doc_id"""
