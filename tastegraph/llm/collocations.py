"""Phrase collocations: word windows routed by their leading words and sorted by multikey three-way quicksort.

A suffix of a piece of text is read to a depth of at most five words. Three
passes over the text:

1. words are counted for each language;
2. pairs of adjacent frequent words are counted by a hash; two bit filters of at
   most 2 MB then tell which words and pairs may be frequent (they let more
   through when very full, and never less);
3. each position that may begin a frequent pair gives its window, cut before the
   first pair that can't be frequent. Equal windows of a task are one row with a
   count. Windows are routed by language and their two leading words; leading
   words with more than HOT_ROWS rows are routed by the whole window instead.

A task sorts its windows by multikey three-way quicksort, all partitions of a
round at once: each partition is split at a pivot word into smaller, equal and
greater; the equal one's size is the count of the phrase read so far, and it goes
on at the next word. A partition of fewer than ``min_count`` occurrences is
abandoned, unless its leading words are dealt to several tasks: then all its
sizes are emitted and summed. Counts of phrases are thus exact; scores are
computed in 38-digit decimals.

Words are told apart by 64-bit hashes, whose uniqueness is verified: the words of
a task are compared byte by byte with those of equal hash, and a frequent word
that shares its hash with any other word of its language makes all passes start
again with another seed.

Edge cases
* null text is empty; null lang counts as `und`, with the rows whose lang is that string;
* empty tables, texts without words and languages without candidates give no rows;
* ids play no part: repeated rows all count, extra columns are ignored;
* very long texts and words: a word is hashed whole, whatever its length;
* ties: score, then count, then the phrase's UTF-8 bytes, so the ranks are unique.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import LOWER, UPPER, Scratch, filter_bits, may_hold, text_slices, tidied
from tastegraph.llm.shingles import buffers, mix, span_hashes

MOST_WORDS = 5  # of a phrase
SLICE = 1 << 21  # bytes of text handled at a time
BUFFERED = 1 << 19  # pairs or windows that a task combines at a time
HOT_ROWS = 1 << 20  # rows with the same leading words that one task may sort
ROWS_PER_TASK = 1 << 19
BROADCAST_ROWS = 1_000_000

_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[0x41:0x5B] += 0x20


class Words:
    """The words of some rows: byte spans, hashes, language codes, and whether each follows another in its piece."""

    def __init__(self, texts: pa.Array, langs: list[str], seed: int):
        self.data, offsets = buffers(texts)
        kind = _BLANK[self.data] | _BREAK[self.data]
        first = np.zeros(len(self.data) + 1, bool)
        first[offsets] = True
        start, end = ~kind, ~kind
        start[1:] &= kind[:-1] | first[1:-1]
        end[:-1] &= kind[1:] | first[1:-1]
        self.at, self.stop = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.hash = span_hashes(self.data, self.at, self.stop, seed) | np.uint64(1)  # 0 ends a window
        self.row = np.searchsorted(offsets, self.at, "right") - 1
        codes = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
        self.langs = langs
        self.code = np.array([codes[x] for x in langs], np.uint64)[self.row]
        breaks = np.cumsum(_BREAK[self.data])[self.at] if len(self.at) else np.zeros(0, np.int64)
        self.follows = np.zeros(len(self.at), bool)
        self.follows[1:] = (self.row[1:] == self.row[:-1]) & (breaks[1:] == breaks[:-1])

    def keys(self) -> np.ndarray:
        return mix(self.hash + self.code)

    def pair_keys(self) -> np.ndarray:
        """Of each word with the next one."""
        with np.errstate(over="ignore"):
            return mix(mix(self.hash[:-1] + self.code[:-1]) * np.uint64(3) + self.hash[1:])

    def string(self, i: int) -> str:
        return _LOW[self.data[self.at[i]:self.stop[i]]].tobytes().decode()

    def same(self, other: np.ndarray) -> bool:
        """Whether every word has the bytes of the word numbered in ``other``."""
        size = self.stop - self.at
        if (size != size[other]).any():
            return False
        cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum() + SLICE // 8, SLICE // 8))
        for a, b in zip(cuts, [*cuts[1:], len(size)]):
            n = size[a:b]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            left, right = (self.data[np.repeat(x, n) + place] for x in (self.at[a:b], self.at[other[a:b]]))
            if (_LOW[left] != _LOW[right]).any():
                return False
        return True


def _slices(batches, seed: int):
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for a, b in text_slices(texts, SLICE):
            yield Words(texts.slice(a, b - a), langs[a:b], seed)


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of 64-bit numbers, one after the other in ``values``."""
    bounds = np.concatenate([[0], np.cumsum(8 * lengths)]).astype("<i8")
    array = pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                  [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values, "<u8"))])
    return array.cast(pa.binary())


def _word_rows(seed: int):
    def run(batches):
        for w in _slices(batches, seed):
            if not len(w.at):
                continue
            key = w.keys()
            _, first, back, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            if w.same(first[back]):
                langs, strings, h = [w.langs[i] for i in w.row[first].tolist()], [w.string(i) for i in first.tolist()], w.hash[first]
            else:  # two words with one hash: told apart by their strings
                every = Counter((w.langs[r], w.string(i), int(w.hash[i]), int(key[i])) for i, r in enumerate(w.row.tolist()))
                langs, strings, h, key = zip(*every)
                h, key, n = np.array(h, np.uint64), np.array(key, np.uint64), np.array(list(every.values()))
                first = slice(None)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "word": pa.array(strings, pa.string()),
                                              "gram": _binary(h, np.ones(len(h), np.int64)),
                                              "key": key[first].view(np.int64), "n": n.astype(np.int64)})
    return tidied(run)


def _pair_rows(seed: int, frequent: np.ndarray):
    def run(batches):
        held: list[np.ndarray] = []
        for w in _slices(batches, seed):
            some = may_hold(frequent, w.keys().view(np.int64))
            held.append(w.pair_keys()[w.follows[1:] & some[1:] & some[:-1]])
            if sum(map(len, held)) >= BUFFERED:
                yield _counted(held)
                held = []
        if held:
            yield _counted(held)
    return tidied(run)


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    key, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_pydict({"key": key.view(np.int64), "n": n.astype(np.int64)})


def _window_rows(seed: int, frequent: np.ndarray, pairs: np.ndarray):
    def run(batches):
        held: list[np.ndarray] = []
        names: dict[int, str] = {}
        for w in _slices(batches, seed):
            codes, first = np.unique(w.code, return_index=True)
            names |= {c: w.langs[r] for c, r in zip(codes.tolist(), w.row[first].tolist())}
            held.append(_windows(w, frequent, pairs))
            if sum(map(len, held)) >= BUFFERED:
                yield from _combined(held, names)
                held = []
        yield from _combined(held, names)
    return tidied(run)


def _windows(w: Words, frequent: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Rows of a language code and up to MOST_WORDS hashes, 0 after the last word."""
    some = may_hold(frequent, w.keys().view(np.int64))
    on = np.zeros(len(w.at) + MOST_WORDS, bool)  # whether a word and the next may be a frequent pair
    if len(w.at) > 1:
        on[:len(w.at) - 1] = w.follows[1:] & some[1:] & some[:-1]
        asked = np.flatnonzero(on)
        on[asked] = may_hold(pairs, w.pair_keys()[asked].view(np.int64))
    begin = np.flatnonzero(on)
    out = np.zeros((len(begin), MOST_WORDS + 1), np.uint64)
    out[:, 0], out[:, 1] = w.code[begin], w.hash[begin]
    alive = np.arange(len(begin))
    for k in range(1, MOST_WORDS):
        alive = alive[on[begin[alive] + k - 1]]
        out[alive, k + 1] = w.hash[begin[alive] + k]
    return out


def _lead(windows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(windows[:, 0] + windows[:, 1]) * np.uint64(3) + windows[:, 2])


def _combined(held: list[np.ndarray], names: dict[int, str]):
    """Batches of distinct windows with their counts."""
    if not sum(map(len, held)):
        return
    rows = np.concatenate(held)
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    n = np.diff(np.append(first, len(rows)))
    rows = rows[first]
    for a in range(0, len(rows), 1 << 16):
        part = rows[a:a + (1 << 16)]
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([names[c] for c in part[:, 0].tolist()], pa.string()), "lead": _lead(part).view(np.int64),
            "window": _binary(part[:, 1:][part[:, 1:] > 0], (part[:, 1:] > 0).sum(axis=1)), "n": n[a:a + (1 << 16)].astype(np.int64)})


def multikey_counts(rows: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, depth, size) of every prefix of the rows with a weight of at least ``least``, by three-way quicksort.

    ``rows`` holds one key a column, 0 after the last. Each round splits every
    partition left at its own pivot; partitions below ``least`` are abandoned.
    """
    found: list[tuple[np.ndarray, ...]] = []
    row = np.arange(len(rows))
    part = np.zeros(len(rows), np.int64)  # partition of each place, ascending
    depth = np.zeros(min(1, len(rows)), np.int64)
    rng = np.random.default_rng(0)
    while len(row):
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.append(first, len(row)))
        pivot_row = row[first + (rng.random(len(first)) * size).astype(np.int64)]
        pivot = rows[pivot_row, depth]
        key = rows[row, depth[part]]
        side = (key > pivot[part]).astype(np.int64) * 2 + (key == pivot[part])  # 0 smaller, 1 equal, 2 greater
        total = np.bincount(part * 3 + side, weights=weights[row], minlength=3 * len(first)).astype(np.int64)
        equal = total[1::3]
        hit = (equal >= least) & (pivot > 0)
        found.append((pivot_row[hit], depth[hit] + 1, equal[hit]))
        stays = total >= least
        stays[1::3] &= (pivot > 0) & (depth + 1 < rows.shape[1])
        name = np.cumsum(stays) - 1
        deeper = np.repeat(depth, 3) + np.tile([0, 1, 0], len(first))
        depth = deeper[stays]
        at = part * 3 + side
        keep = stays[at]
        part, row = name[at[keep]], row[keep]
        order = np.argsort(part, kind="stable")
        part, row = part[order], row[order]
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))


def _sort_rows(least: int):
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        windows = table.column("window").combine_chunks().cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(windows.buffers()[1], "<i8")[windows.offset:][:len(windows) + 1]) // 8
        flat = np.frombuffer(b"".join(windows.to_pylist()), "<u8")
        langs = table.column("lang").combine_chunks().dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
        rows = np.zeros((len(lengths), MOST_WORDS + 1), np.uint64)
        rows[:, 0] = code + 1
        rows[:, 1:][np.arange(MOST_WORDS) < lengths[:, None]] = flat
        n, hot = (table.column(c).to_numpy() for c in ("n", "hot"))
        for dealt in (False, True):
            mine = np.flatnonzero(hot == dealt)
            at, depth, size = multikey_counts(rows[mine], n[mine], 1 if dealt else least)
            at, depth, size = (x[depth > 2] for x in (mine[at], depth, size))
            for a in range(0, len(at), 1 << 16):
                i, d = at[a:a + (1 << 16)], depth[a:a + (1 << 16)] - 1
                words = rows[i, 1:]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([names[c] for c in code[i].tolist()], pa.string()),
                    "gram": _binary(words[np.arange(MOST_WORDS) < d[:, None]], d), "n": size[a:a + (1 << 16)]})
    return tidied(run)


def _part(gram: Column, first, words) -> Column:
    return F.substring(gram, (F.lit(1) + first * 8).cast("int"), (words * 8).cast("int"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def phrase_counts(docs: DataFrame, scratch: Scratch, min_count: int = 100, lang_col: str = "lang",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, gram, n), all of them, and phrases (lang, gram, n) of 2 to MOST_WORDS words found ``min_count`` times.

    A gram is the row of its words' 64-bit hashes; those of frequent words are unique within a language.
    """
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].alias("text")).where("text is not null")
    seed = 0
    while True:
        words = (texts.mapInArrow(_word_rows(seed), "lang string, word string, gram binary, key long, n long")
                 .groupBy("lang", "word", "gram", "key").agg(F.sum("n").alias("n")))
        words = scratch.keep(words, f"words-{seed}")
        shared = words.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
        if not shared.where((F.col("c") > 1) & (F.col("n") >= min_count)).head(1):
            break
        scratch.drop(f"words-{seed}")
        seed += 1
    often = words.where(F.col("n") >= min_count)
    frequent = filter_bits(often.select("key"), often.count())
    pairs = (texts.mapInArrow(_pair_rows(seed, frequent), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= min_count).select("key"))
    pairs = scratch.keep(pairs, "pairs")
    filters = frequent, filter_bits(pairs, pairs.count())
    windows = scratch.keep(texts.mapInArrow(_window_rows(seed, *filters), "lang string, lead long, window binary, n long"), "windows")
    hot = scratch.keep(windows.groupBy("lead").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > HOT_ROWS)
                       .select("lead", F.lit(True).alias("hot")), "hot")
    routed = windows.join(_small(hot), "lead", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    route = F.when(F.col("hot"), F.xxhash64("window")).otherwise(F.col("lead"))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), windows.count() // ROWS_PER_TASK + 1)
    sized = (routed.select("lang", "window", "n", "hot", route.alias("route")).repartition(tasks, "route")
             .mapInArrow(_sort_rows(min_count), "lang string, gram binary, n long"))
    grams = sized.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return words.select("lang", "word", "gram", "n"), scratch.keep(grams, "grams")


def collocations(docs: DataFrame, min_count: int = 100, percent: int = 100, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    A phrase found ``a`` times scores floor(1000 * a * n / (l * r)) at its lowest
    cut, ``l`` and ``r`` being the counts of its parts and ``n`` the language's
    words. Phrases inside a longer one with ``percent`` % of their count are dropped.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    words, grams = phrase_counts(docs, scratch, min_count, lang_col, text_col)
    counts = scratch.keep(words.where(F.col("n") >= min_count).select("lang", "gram", "n").unionByName(grams), "counts")
    totals = scratch.keep(words.groupBy("lang").agg(F.sum("n").alias("words")), "totals")
    size = lambda c: F.octet_length(c) / 8
    cut = grams.select("lang", "gram", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), (size("gram") - 1).cast("int"))).alias("k"))
    cut = cut.select("*", _part(F.col("gram"), F.lit(0), F.col("k")).alias("left"),
                     _part(F.col("gram"), F.col("k"), size("gram") - F.col("k")).alias("right"))
    met = (cut.join(counts.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"])
           .join(counts.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"])
           .join(_small(totals), "lang"))
    exact = lambda c: f"cast({c} as decimal(38, 0))"
    score = F.expr(f"(cast(1000 as decimal(38, 0)) * {exact('a')} * {exact('words')}) div ({exact('l')} * {exact('r')})")
    scored = (met.select("lang", "gram", "a", "words", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("lang", "gram", "a", "words").agg(F.min("cut").alias("cut")))
    inside = F.flatten(F.transform(F.sequence(F.lit(2), (size("gram") - 1).cast("int")), lambda n: F.transform(
        F.sequence(F.lit(0), (size("gram") - n).cast("int")), lambda i: _part(F.col("gram"), i, n))))
    longer = (grams.where(size("gram") > 2).select("lang", "n", F.explode(inside).alias("gram"))
              .groupBy("lang", "gram").agg(F.max("n").alias("longest")))
    kept = scored.join(longer, ["lang", "gram"], "left").where(
        F.col("longest").isNull() | (F.lit(100) * F.col("longest") < F.lit(percent) * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc())
    # with all that tie for the last place, as phrases are only spelt out for these
    near = scratch.keep(kept.withColumn("place", F.rank().over(best)).where(F.col("place") <= top), "near")
    spelt = near.select("lang", "gram", F.posexplode(F.transform(
        F.sequence(F.lit(0), (size("gram") - 1).cast("int")), lambda i: _part(F.col("gram"), i, F.lit(1)))).alias("pos", "one"))
    spelt = (spelt.join(words.select("lang", F.col("gram").alias("one"), "word"), ["lang", "one"])
             .groupBy("lang", "gram").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("spelt")))
    phrase = F.array_join(F.transform("spelt", lambda x: x["word"]), " ")
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    return (near.join(spelt, ["lang", "gram"]).withColumn("phrase", phrase)
            .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                    F.col("words").alias("n"), F.col("cut.score").alias("score")))


def digest(docs: DataFrame) -> DataFrame:
    return collocations(docs)


_CUTS = "\n    UNION ALL ".join(
    f"SELECT g.lang, g.phrase, g.a, {k} AS k, array_to_string(w[1:{k}], ' ') AS x, array_to_string(w[{k + 1}:], ' ') AS y FROM g WHERE len(w) > {k}"
    for k in range(1, MOST_WORDS))
SQL = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]'), lambda x: x <> '') AS w FROM pieces),
spans AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
seen AS (SELECT lang, unnest([w[i:j] for j in range(i, least(i + {MOST_WORDS - 1}, len(w)) + 1)]) AS w FROM spans),
f AS (SELECT lang, array_to_string(w, ' ') AS phrase, any_value(w) AS w, count(*) AS a FROM seen GROUP BY 1, 2 HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
g AS (SELECT * FROM f WHERE len(w) > 1),
cuts AS ({_CUTS}),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, p.a AS l, q.a AS r, t.n, 1000::HUGEINT * c.a * t.n // (p.a::HUGEINT * q.a) AS score
    FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y JOIN total t ON t.lang = c.lang),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (SELECT lang, a, len(w) AS m, w, unnest(range(2, len(w))) AS n FROM g WHERE len(w) > 2),
parts AS (SELECT lang, a, w, n, unnest(range(1, m - n + 2)) AS i FROM subs),
longer AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS longest FROM parts GROUP BY 1, 2),
kept AS (SELECT low.* FROM low LEFT JOIN longer o ON o.lang = low.lang AND o.phrase = low.phrase WHERE o.longest IS NULL OR 100 * o.longest < 100 * low.a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000"""
