"""Mixing sources to target weights: budgets down a domain-language-source tree, prefixes of seeded epochs.

The corpus' token budget goes down the tree by weight. A node can't take more
than its documents give in EPOCHS passes; what it can't take goes to its
siblings by their weights, and only when all of them are full does their parent
take less, which the parent's siblings then share. All shares are whole tokens:
the arithmetic is on integers and what rounding leaves goes to the largest
remainders, then by name.

A leaf reads its documents in epochs, each in the order of a hash of seed, epoch
and id. Its budget takes whole epochs, and of the next one the prefix that makes
up the rest, the last document being cut to its first words. Documents are dealt
to buckets by that hash, about BUCKET_DOCS each; sums of buckets tell where the
prefix ends, and only that bucket is put in order, so no task sees a whole leaf.

Tokens are words between white space. Only DataFrame functions are used.

Edge cases
* null language or source: `und`, `unknown`; names without a weight: the level's default;
* null or empty text, or one without words: takes no part and is not returned;
* null ids hash as the empty string;
* rows equal in id and text are one document: that of the smallest language, then source, and of rows that
  differ in other columns only, the one whose other columns as JSON have the smallest hash;
* an empty table gives an empty result.
Tokens times the largest weight must stay below 2**63.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SEED, EPOCHS, SHARE = 17, 2, 0.8  # share of the corpus' tokens that is the budget
BUCKET_DOCS = 1000
BROADCAST_LEAVES = 100_000
#: Weights by level and name; "" is the default of a level.
WEIGHTS = {
    "domain": {"web": 50, "reference": 30, "forum": 20, "": 10},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10, "": 5},
    "source": {"src0": 20, "": 10},
}
DOMAINS = ("web", "reference", "forum")  # by the number in a source's name, modulo three
TREE = ("domain", "lang", "source")


def _weight(level: str, weights: dict) -> Column:
    return F.coalesce(*[F.when(F.col(level) == name, F.lit(w)) for name, w in weights[level].items() if name],
                      F.lit(weights[level][""])).cast("long")


def pick(docs: DataFrame, text_col: str = "text") -> Column:
    """Tells rows of one id and text apart by their other columns."""
    rest = [docs[c] for c in docs.columns if c != text_col]
    return F.xxhash64(F.to_json(F.struct(*rest)))


def leaves_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tid, domain, lang, source, pick, tokens) of documents that have any word, once each."""
    named = docs.select(docs[id_col].cast("long").alias("doc"), F.xxhash64(docs[text_col]).alias("tid"), pick(docs, text_col).alias("pick"),
                        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(docs["source"].cast("string"), F.lit("unknown")).alias("source"),
                        F.regexp_count(docs[text_col], F.lit(WORD)).cast("long").alias("tokens"))
    number = F.expr("coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) AS BIGINT), 0)")
    named = named.withColumn("domain", F.get(F.array(*map(F.lit, DOMAINS)), (number % len(DOMAINS)).cast("int")))
    first = F.min(F.struct("lang", "source", "pick", "domain", "tokens")).alias("first")
    return named.where("tokens > 0").groupBy("doc", "tid").agg(first).select("doc", "tid", *[f"first.{c}" for c in (*TREE, "pick", "tokens")])


def fill(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Shares of each parent's ``budget`` among its children, given their ``weight`` and ``capacity``, as ``share``.

    Children in order of capacity for their weight are full as long as the rest,
    shared by weight among those not yet passed, reaches their capacity.
    """
    order = Window.partitionBy(*parents, "budget").orderBy(F.col("capacity") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here_on = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parents, "budget")
    got = children.withColumn("rest", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    got = got.withColumn("open_weight", F.sum("weight").over(here_on))
    got = got.withColumn("full", F.expr("capacity * open_weight <= rest * weight"))
    # the rest and the weight of those that are not full are those of the first of them
    first = Window.partitionBy(*parents, "budget").orderBy(F.col("full"), F.col("capacity") / F.col("weight"), name)
    got = got.withColumn("r", F.first("rest").over(first)).withColumn("w", F.first("open_weight").over(first))
    got = got.withColumn("share", F.expr("CASE WHEN full THEN capacity ELSE (r * weight) div w END"))
    got = got.withColumn("over", F.expr("CASE WHEN full THEN -1 ELSE (r * weight) % w END"))
    got = got.withColumn("spare", F.least("budget", F.sum("capacity").over(whole)) - F.sum("share").over(whole))
    largest = Window.partitionBy(*parents, "budget").orderBy(F.col("over").desc(), name)
    got = got.withColumn("share", F.col("share") + F.when(F.row_number().over(largest) <= F.col("spare"), 1).otherwise(0))
    return got.drop("rest", "open_weight", "full", "r", "w", "over", "spare")


def budgets(leaves: DataFrame, budget: int, weights: dict = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, docs, share) of the leaves; leaves: those columns but share."""
    level = leaves.withColumn("capacity", F.col("tokens") * epochs)
    share = None
    for depth, name in enumerate(TREE):
        above = list(TREE[:depth])
        nodes = level.groupBy(*above, name).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(name, weights))
        nodes = (nodes.withColumn("budget", F.lit(budget).cast("long")) if share is None
                 else nodes.join(share.withColumnRenamed("share", "budget"), above))
        share = fill(nodes, above, name).select(*above, name, "share")
    return leaves.join(share, list(TREE))


def _order_key(epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), epoch.cast("string"), F.coalesce(F.col("doc").cast("string"), F.lit(""))).cast("binary"))


def choose(docs: DataFrame, share: float = SHARE, weights: dict = WEIGHTS, epochs: int = EPOCHS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tid, domain, lang, source, pick, tokens, whole, part): epochs taken whole, and words taken of the next."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.keep(leaves_of(docs, id_col, text_col), "documents")
    leaves = scratch.keep(rows.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    planned = budgets(leaves, int(total * share), weights, epochs)
    planned = planned.select(*TREE, F.expr("share div tokens").alias("whole"), F.expr("share % tokens").alias("rest"),
                             F.expr(f"docs div {BUCKET_DOCS} + 1").alias("buckets"))
    planned = scratch.keep(planned, "planned")
    few = leaves.count() <= BROADCAST_LEAVES
    join = lambda left, right: left.join(F.broadcast(right) if few else right, list(TREE))
    # the first 32 bits of the hash, scaled to the leaf's buckets: buckets are in the order of the hash
    dealt = join(rows, planned).withColumn("key", _order_key(F.col("whole")))
    dealt = dealt.withColumn("bucket", F.expr("shiftright(cast(conv(substr(key, 1, 8), 16, 10) AS BIGINT) * buckets, 32)"))
    sums = dealt.where("rest > 0").groupBy(*TREE, "bucket", "rest").agg(F.sum("tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.partitionBy(*TREE).orderBy("bucket"))
    edge = (sums.withColumn("upto", running).where("upto >= rest")
            .groupBy(*TREE).agg(F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "bucket").alias("edge")))
    edge = scratch.keep(edge.select(*TREE, "edge.bucket", "edge.left"), "edges").withColumnRenamed("bucket", "edge")
    marked = dealt.join(F.broadcast(edge) if few else edge, list(TREE), "left")
    columns = ["doc", "tid", *TREE, "pick", "tokens", "whole"]
    inner = marked.where("edge IS NULL OR bucket <> edge").select(
        *columns, F.when(F.col("bucket") < F.col("edge"), F.col("tokens")).otherwise(F.lit(0)).cast("long").alias("part"))
    before = Window.partitionBy(*TREE).orderBy("key", "doc", "tid").rowsBetween(Window.unboundedPreceding, -1)
    outer = marked.where("bucket = edge").withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select(
        *columns, F.expr("greatest(0, least(tokens, left - before))").alias("part"))
    return inner.unionByName(outer).where("whole > 0 OR part > 0")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), n.cast("int")), "")


def mix(docs: DataFrame, share: float = SHARE, weights: dict = WEIGHTS, epochs: int = EPOCHS,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents chosen, with all their columns: once for each whole epoch, and cut where the prefix ends."""
    # plain keys, so that the join's partitions serve the choice among equal rows too, and texts move once
    key = ["_null", "_id", "_tid", "_pick"]
    named = lambda doc: [doc.isNull().alias("_null"), F.coalesce(doc, F.lit(0).cast("long")).alias("_id")]
    taken = choose(docs, share, weights, epochs, id_col, text_col).select(
        *named(F.col("doc")), F.col("tid").alias("_tid"), F.col("pick").alias("_pick"),
        F.col("tokens").alias("_tokens"), F.col("whole").alias("_whole"), F.col("part").alias("_part"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *named(docs[id_col].cast("long")),
                       F.xxhash64(docs[text_col]).alias("_tid"), pick(docs, text_col).alias("_pick"))
    met = rows.join(taken, key).dropDuplicates(key)
    parts = F.concat(F.array_repeat(F.col("_tokens"), F.col("_whole").cast("int")),
                     F.when(F.col("_part") > 0, F.array("_part")).otherwise(F.array().cast("array<bigint>")))
    met = met.select("_row", "_tokens", F.explode(parts).alias("_n"))
    text = F.col("_row")[text_col]
    return met.select(*[F.when(F.col("_n") < F.col("_tokens"), first_words(text, F.col("_n"))).otherwise(text).alias(c)
                        if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch, taken): what each epoch takes of each document."""
    chosen = choose(docs.select("doc_id", "text", "lang", "source"))
    epochs = F.transform(F.sequence(F.lit(0), F.col("whole").cast("int")), lambda e: F.struct(
        e.alias("epoch"), F.when(e < F.col("whole"), F.col("tokens")).otherwise(F.col("part")).alias("taken")))
    return (chosen.select(F.col("doc").alias("doc_id"), *TREE, F.col("tokens").alias("n_tokens"), F.explode(epochs).alias("e"))
            .select("doc_id", *TREE, "n_tokens", "e.epoch", "e.taken").where("taken > 0"))


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items() if n)
    return f"CAST(CASE {cases} ELSE {WEIGHTS[level]['']} END AS BIGINT)"


def _fill_sql(depth: int) -> str:
    """Common table expressions share0, share1, share2 of the levels."""
    name, above = TREE[depth], TREE[:depth]
    keys = ", ".join(TREE[:depth + 1])
    part = f"PARTITION BY {', '.join(above)}" if above else ""
    source = "(SELECT CAST(floor(sum(tokens) * CAST({s} AS DOUBLE)) AS BIGINT) AS budget FROM leaves) b" if not depth else f"share{depth - 1} b"
    match = "" if not depth else " AND ".join(f"n.{k} = b.{k}" for k in above)
    source = source.format(s=SHARE)
    budget = "b.budget" if not depth else "b.share"
    on = "CROSS JOIN " + source if not depth else f"JOIN {source} ON {match}"
    cols = ", ".join(f"n.{k}" for k in TREE[:depth + 1])
    return f"""n{depth} AS (SELECT {cols}, n.capacity, n.weight, {budget} AS budget FROM (SELECT {keys}, CAST(sum(tokens) * {EPOCHS} AS BIGINT) AS capacity, {_weight_sql(name)} AS weight FROM leaves GROUP BY {keys}) n {on}),
o{depth} AS (SELECT *, budget - coalesce(sum(capacity) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM n{depth}),
f{depth} AS (SELECT *, capacity * open_weight <= rest * weight AS full_up FROM o{depth}),
g{depth} AS (SELECT *, first_value(rest) OVER ({part} ORDER BY full_up, capacity / weight, {name}) AS r, first_value(open_weight) OVER ({part} ORDER BY full_up, capacity / weight, {name}) AS w FROM f{depth}),
h{depth} AS (SELECT *, CASE WHEN full_up THEN capacity ELSE (r * weight) // w END AS base, CASE WHEN full_up THEN -1 ELSE (r * weight) % w END AS over_by FROM g{depth}),
i{depth} AS (SELECT *, least(budget, sum(capacity) OVER ({part})) - sum(base) OVER ({part}) AS spare, row_number() OVER ({part} ORDER BY over_by DESC, {name}) AS k FROM h{depth}),
share{depth} AS (SELECT {keys}, CAST(base + CASE WHEN k <= spare THEN 1 ELSE 0 END AS BIGINT) AS share FROM i{depth})"""


def sql(docs: str = "documents") -> str:
    """Common table expressions that end in ``taken``: (doc_id, domain, lang, source, tokens, text, epoch, n)."""
    cases = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DOMAINS))
    return f"""named AS (SELECT doc_id, text, coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens FROM {docs}
    QUALIFY row_number() OVER (PARTITION BY doc_id, text ORDER BY coalesce(lang, 'und'), coalesce(source, 'unknown')) = 1),
rows_ AS (SELECT *, CASE coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) AS BIGINT), 0) % {len(DOMAINS)} {cases} END AS domain FROM named WHERE tokens > 0),
leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows_ GROUP BY ALL),
{", ".join(_fill_sql(d) for d in range(3))},
plan AS (SELECT l.*, share // tokens AS whole, share % tokens AS rest FROM leaves l JOIN share2 USING (domain, lang, source)),
keyed AS (SELECT r.*, whole, rest, md5('{SEED}|' || whole || '|' || doc_id) AS key FROM rows_ r JOIN plan p USING (domain, lang, source)),
chosen AS (SELECT *, greatest(0, least(tokens, rest - coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS part FROM keyed),
epochs AS (SELECT *, unnest(generate_series(0, whole)) AS epoch FROM chosen),
taken AS (SELECT *, CASE WHEN epoch < whole THEN tokens ELSE part END AS n FROM epochs WHERE epoch < whole OR part > 0)"""


SQL = f"""WITH {sql()}
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS n_tokens, CAST(epoch AS INTEGER) AS epoch, CAST(n AS BIGINT) AS taken FROM taken"""
