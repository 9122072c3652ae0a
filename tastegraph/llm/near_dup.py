"""MinHash near-duplicates by a multi-index Hamming join, links confirmed on whole shingle sets.

1. Documents with equal shingle sets are one class, stood for by its smallest id.
2. A class has 64 MinHash values of 16 bits. Two sets of similarity 0.8 differ in
   32 or more of them with a probability below one in ten million.
3. Signatures that differ in at most 31 places differ in at most one place of some
   chunk of 4, by the pigeonhole principle over 16 chunks. So each chunk gives
   four keys, each leaving one place out: such signatures share a key.
4. Classes sharing a key whose signatures are near enough are candidates. A key
   shared by many classes doesn't pair them: its members are only joined to the
   smallest, which puts them in one group.
5. Groups of candidates (connected components) larger than a block are parted first:
   all their signatures are compared, a task taking two blocks of them, and only classes
   joined by near signatures stay together.
   Groups are dealt to blocks of bounded
   size; a task takes two blocks of a group with their texts, counts all
   intersections exactly as a matrix product, and returns a spanning forest of
   the true links, never all pairs.
6. The components of the true links are the result.

Edge cases
* null or empty texts, or texts without words: no shingles, linked with nothing;
* fewer words than a shingle: the whole sequence is the one shingle;
* rows with equal ids are one document for linking, and each is returned;
* null ids: linked with nothing, component null, kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, filter_bits, may_hold, text_slices, tidied
from tastegraph.llm.components import components
from tastegraph.llm.shingles import mix, shingle_sets

PLACES, BITS = 64, 16  # of a signature
CHUNKS, DISTANCE = 16, 31  # a chunk may have DISTANCE // CHUNKS errors
HOT = 16  # classes sharing a key; above, they are joined to the smallest only
UNIT_WEIGHT, DOCUMENT_WEIGHT = 120_000, 200  # shingles of a block, and what a document counts besides its own
SIGNATURES = 8192  # of a large group's block that are compared at a time
COLUMNS = 4096  # of the incidence matrix at a time
SIGNED = "doc long, n long, h1 long, h2 long, sig binary"

_rng = np.random.default_rng(11)
_A = _rng.integers(1, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, PLACES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """64 MinHash values of 16 bits of a non-empty set of 64-bit hashes."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 8192):
            least = np.minimum(least, (shingles[None, i:i + 8192] * _A[:, None] + _B[:, None]).min(axis=1))
    return (mix(least) & np.uint64((1 << BITS) - 1)).astype("<u2")


def signed(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """SIGNED of each document: shingles, 128-bit hash of the set, signature (null without shingles)."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for a, b in text_slices(texts):
                n, h1, h2, sig = [], [], [], []
                for s in shingle_sets(texts.slice(a, b - a), words):
                    n.append(len(s))
                    d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8")
                    h1.append(int(d[0]) if len(s) else None)
                    h2.append(int(d[1]) if len(s) else None)
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_pydict({
                    "doc": batch.column(0).slice(a, b - a), "n": pa.array(n, pa.int64()), "h1": pa.array(h1, pa.int64()),
                    "h2": pa.array(h2, pa.int64()), "sig": pa.array(sig, pa.binary())})

    return docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text")).mapInArrow(tidied(run), SIGNED)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), PLACES)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys [documents, keys]: for each chunk and each set of allowed errors, a hash of the chunk's other places."""
    width = PLACES // CHUNKS
    out = []
    with np.errstate(over="ignore"):
        for c in range(CHUNKS):
            places = range(c * width, (c + 1) * width)
            for left_out in combinations(places, DISTANCE // CHUNKS):
                h = np.full(len(signatures), c + 1, np.uint64)
                for p in places:
                    # which places are left out is part of the key
                    v = np.uint64(1 << 40) if p in left_out else signatures[:, p].astype(np.uint64)
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + v)
                out.append(h)
    return np.stack(out, axis=1).view(np.int64) if out else np.zeros((0, 0), np.int64)


def keys(classes: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """(key, rep): the keys of each class; only: a filter of the keys wanted."""
    shared = classes.sparkSession.sparkContext.broadcast(only)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                k = chunk_keys(_signatures(part.column(1)))
                key, rep = k.reshape(-1), np.repeat(part.column(0).to_numpy(), k.shape[1])
                if shared.value is not None:
                    wanted = may_hold(shared.value, key)
                    key, rep = key[wanted], rep[wanted]
                yield pa.RecordBatch.from_pydict({"key": key, "rep": rep})

    return classes.select("rep", "sig").mapInArrow(tidied(run), "key long, rep long")


def within_distance(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most DISTANCE places."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 5000):
                part = batch.slice(i, 5000)
                near = (_signatures(part.column(2)) != _signatures(part.column(3))).sum(axis=1) <= DISTANCE
                yield part.select(["a", "b"]).filter(pa.array(near))

    sig = classes.select("rep", "sig")
    met = (pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b"))
    return met.mapInArrow(run, "a long, b long")


def candidate_edges(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges whose components hold every pair of classes within the signature distance."""
    shared = scratch.keep(keys(classes).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("least"),
                                                   F.max("rep").alias("most")).where("n > 1"), "shared")
    # most keys belong to one class: the others are told by a filter, so that few rows are shuffled for the join
    several = shared.where("n > 2").select("key", "n", "least")
    only = filter_bits(several.select("key"), several.count())
    members = scratch.keep(keys(classes, only).join(several, "key"), "members")
    few = members.where(F.col("n") <= HOT).select("key", "rep")
    pairs = few.toDF("key", "a").join(few.toDF("key", "b"), "key").where("a < b").select("a", "b")
    two = shared.where("n = 2").select(F.col("least").alias("a"), F.col("most").alias("b"))
    pairs = scratch.keep(pairs.union(two).distinct(), "pairs")
    stars = members.where(F.col("n") > HOT).select(F.col("least").alias("a"), F.col("rep").alias("b"))
    return within_distance(pairs, classes).union(stars).where("a <> b").distinct()


def links(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """True links as index pairs: within a, or between a and b (b's indices follow a's).

    Intersections are counted exactly: products of incidence matrices, a few
    thousand shingles at a time, over the shingles that occur more than once.
    """
    sets = a + (b or [])
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    values, column = np.unique(flat, return_inverse=True)
    often = np.bincount(column) > 1
    at = np.cumsum(often) - 1
    on = often[column]
    row, column, n = row[on], at[column[on]], int(often.sum())
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    split = len(a) if b is not None else 0
    both = np.zeros((len(a), len(b) if b is not None else len(a)), np.int64)
    for lo in range(0, n, COLUMNS):
        i, j = np.searchsorted(column, (lo, lo + COLUMNS))
        x = np.zeros((len(sets), min(COLUMNS, n - lo)), np.float32)
        x[row[i:j], column[i:j] - lo] = 1
        both += (x[:len(a)] @ x[split:].T).astype(np.int64)  # exact: at most COLUMNS at a time
    either = size[:len(a), None] + size[None, split:] - both
    hit = (100 * both >= percent * either) & (both > 0)
    if b is None:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    return list(zip(i.tolist(), (j + split).tolist()))


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """As few of the pairs as join the same indices."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs:
        p, q = find(i), find(j)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((i, j))
    return out


def parted(classes: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    """The groups, with those larger than a block parted into what near signatures join; members near no other are left out.

    Members of a key that many classes share are in one group though most may be far from each other.
    A signature is compared with all of its group, so no pair within the distance is parted.
    """
    member = classes.select(F.col("rep").alias("node"), "n", "sig").join(groups, "node")
    large = member.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("n") + DOCUMENT_WEIGHT).alias("weight"))
    large = scratch.keep(large.where(F.col("weight") >= UNIT_WEIGHT).select(
        "component", F.expr(f"cast(size div {SIGNATURES} + 1 as int)").alias("blocks")), "large-groups")
    if not large.head(1):
        return groups
    own = F.expr("cast(pmod(xxhash64(node), blocks) as int)")
    dealt = (member.join(large, "component").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "sig"))
    unit = ["component", "lo", "hi"]
    dealt = dealt.repartition(*unit).sortWithinPartitions(*unit, "own", "node")

    def run(batches):
        def spanned(unit, parts):
            own, node = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in (3, 4))
            found = near_forest(np.concatenate([_signatures(p.column(5)) for p in parts]), own, unit[1] == unit[2])
            return _edges([(int(node[i]), int(node[j])) for i, j in found]) if found else None

        now, parts = None, []
        for batch in batches:
            head = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            first = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]).any(axis=1)])) if len(head) else []
            for a, b in zip(first, [*first[1:], len(head)]):
                if tuple(head[a]) != now:
                    if parts and (edges := spanned(now, parts)) is not None:
                        yield edges
                    now, parts = tuple(head[a]), []
                parts.append(batch.slice(a, b - a))
        if parts and (edges := spanned(now, parts)) is not None:
            yield edges

    near = scratch.keep(dealt.mapInArrow(tidied(run), "a long, b long"), "near")
    finer = components(near, scratch, "finer").select("node", "component")
    return scratch.keep(groups.join(large, "component", "left_anti").select("node", "component").unionByName(finer), "parted")


def near_forest(signatures: np.ndarray, own: np.ndarray, within: bool) -> list[tuple[int, int]]:
    """Index pairs that join the same rows as all pairs within DISTANCE do: pairs of one block, or between the two blocks."""
    n = len(signatures)
    part, out = np.arange(n), []
    split = int((own == own[0]).sum())  # rows are in order of their block
    for i in range(n - 1 if within else split if split < n else 0):
        start = i + 1 if within else split
        apart = start + np.flatnonzero(part[start:] != part[i])
        near = apart[(signatures[apart] != signatures[i]).sum(axis=1) <= DISTANCE]
        _, first = np.unique(part[near], return_index=True)  # one link to each part
        out += [(i, int(j)) for j in near[first]]
        if len(near):
            part[np.isin(part, part[near])] = part[i]
    return out


def dealt_members(classes: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component, n, blocks, block): the members of each group, dealt to blocks of bounded weight."""
    weighed = classes.select(F.col("rep").alias("node"), "n").join(groups, "node")
    total = weighed.groupBy("component").agg(F.sum(F.col("n") + DOCUMENT_WEIGHT).alias("weight"))
    total = scratch.keep(total.select("component", F.expr(f"cast(weight div {UNIT_WEIGHT} + 1 as int)").alias("blocks")), "weights")
    member = weighed.join(total, "component").withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    return scratch.keep(member.select("node", "component", "n", "blocks", "block"), "members-dealt")


def first_units(member: DataFrame) -> DataFrame:
    """(node, component, lo, hi, second): each block with its group's smallest node; hi is -1: all pairs within.

    So a text is moved once, and a group's smallest one once for each block.
    """
    own = member.select("node", "component", F.col("block").alias("lo"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    smallest = member.where("blocks > 1 and node = component").select("node", "component", "block", every.alias("lo")).where("lo <> block")
    return own.unionByName(smallest.drop("block")).withColumn("hi", F.lit(-1)).withColumn("second", F.lit(False))


def second_units(member: DataFrame, parts: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Units that compare what the first ones left apart, or None: every member with those outside its group's largest part.

    Members of one part need no more links between them. The others are few in a
    group of near copies; they are dealt to chunks, each of which meets every
    block.
    """
    spread = member.where("blocks > 1").join(parts.toDF("node", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    spread = scratch.keep(spread, "members-apart")
    sizes = spread.groupBy("component", "part").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("component").agg(F.max_by("part", "size").alias("largest"), F.count(F.lit(1)).alias("n_parts"))
    largest = scratch.keep(largest.where("n_parts > 1").select("component", "largest"), "largest-parts")
    if not largest.head(1):
        return None
    rest = spread.join(largest, "component").where("part <> largest")
    chunks = rest.groupBy("component").agg(F.expr(f"cast(sum(n + {DOCUMENT_WEIGHT}) div {UNIT_WEIGHT} + 1 as int)").alias("chunks"))
    chunks = scratch.keep(chunks, "chunks")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = spread.join(chunks, "component").select("node", "component", F.col("block").alias("lo"), upto("chunks").alias("hi"))
    right = rest.join(chunks, "component").withColumn("hi", F.expr("cast(pmod(xxhash64(node), chunks) as int)"))
    right = right.select("node", "component", upto("blocks").alias("lo"), "hi")
    return left.withColumn("second", F.lit(False)).unionByName(right.withColumn("second", F.lit(True)))


def confirmed_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, scratch: Scratch, words: int,
                    percent: int, id_col: str, text_col: str) -> DataFrame:
    """Edges (a, b) that span the true links within each group of (node, component)."""
    member = dealt_members(classes, groups, scratch)
    found = scratch.keep(unit_links(docs, first_units(member), member, words, percent, id_col, text_col), "links-1")
    if not member.where("blocks > 1").head(1):
        return found
    more = second_units(member, components(found, scratch, "parts-1"), scratch)
    if more is None:
        return found
    return found.unionByName(unit_links(docs, scratch.keep(more, "units-2"), more, words, percent, id_col, text_col))


def unit_links(docs: DataFrame, units: DataFrame, nodes: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Edges (a, b) that span the links within each unit, or between its first and second rows if hi isn't -1."""
    nodes = nodes.select("node").distinct()
    only = docs.sparkSession.sparkContext.broadcast(filter_bits(nodes, nodes.count()))

    def wanted(batches):  # leaves out most texts that are in no group, before they are shuffled
        for batch in batches:
            yield batch.filter(pa.array(may_hold(only.value, batch.column(0).to_numpy(zero_copy_only=False))))

    texts = docs.select(docs[id_col].cast("long").alias("node"), docs[text_col].alias("text")).where("node IS NOT NULL")
    texts = texts.mapInArrow(tidied(wanted), "node long, text string").join(units, "node")
    unit = ["component", "lo", "hi"]
    dealt = texts.select(*unit, "second", "node", "text").repartition(*unit).sortWithinPartitions(*unit, "second", "node")

    def run(batches):
        def spanned(unit, rows):
            nodes, second, sets = zip(*rows)
            split = sum(not x for x in second)
            if unit[2] == -1:
                found = links(list(sets), None, percent) if len(sets) > 1 else []
            else:
                found = links(list(sets[:split]), list(sets[split:]), percent) if 0 < split < len(sets) else []
            return [(nodes[i], nodes[j]) for i, j in _forest(found)]

        now, rows, out = None, [], []
        for batch in batches:
            texts = batch.column(5)
            for a, b in text_slices(texts):
                part = batch.slice(a, b - a)
                head = zip(*(part.column(i).to_pylist() for i in range(5)))
                for (c, lo, hi, second, node), s in zip(head, shingle_sets(part.column(5), words)):
                    if (c, lo, hi) != now:
                        if rows:
                            out += spanned(now, rows)
                        now, rows = (c, lo, hi), []
                    rows.append((node, second, s))
                if len(out) > 5000:
                    yield _edges(out)
                    out = []
        if rows:
            out += spanned(now, rows)
        if out:
            yield _edges(out)

    return dealt.mapInArrow(tidied(run), "a long, b long")


def _edges(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows)
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    if percent < 80:
        raise ValueError("the signature distance is set for similarities of 0.8 or more")
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = scratch.keep(signed(docs, words, id_col, text_col), "signed")
    classes = scratch.keep(rows.where("n > 0 and doc is not null").groupBy("h1", "h2").agg(
        F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    groups = parted(classes, components(candidate_edges(classes, scratch), scratch, "groups"), scratch)
    found = confirmed_links(docs, classes, groups, scratch, words, percent, id_col, text_col)
    parts = components(found, scratch, "parts")
    named = classes.select("h1", "h2", F.col("rep").alias("node")).join(parts, "node", "left")
    named = scratch.keep(named.select("h1", "h2", F.coalesce("component", "node").alias("component")), "named")
    met = rows.join(named, ["h1", "h2"], "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return met.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stand for their group; rows that share an id stay or go together."""
    gone = near_duplicates(docs, words, percent, id_col, text_col).where("not kept").select("doc_id").distinct()
    gone = gone.toDF("_gone")
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=4)
