"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a context tree of up to three bytes with frozen counts from a
bounded sample of labelled documents. In a context seen n times with d distinct
followers, a follower seen c times has probability c / (n + d); the escape
d / (n + d) goes to the followers of the next shorter context, of which those
already ruled out are excluded; below the empty context all 256 bytes are
alike. The probabilities of a context sum to one, so a text's sum of
-log2 is its exact code length in each language. The shortest wins; the score is
its posterior probability under equal priors.

As the statistics are frozen, the code lengths of every context and byte are a
table, and a whole text is scored by array lookups of its last three bytes.

Limits of the model, not of the data scored: SAMPLE_ROWS documents of at most
SAMPLE_BYTES bytes for each language, of longer ones, taken where a language has
too few others, the beginning; and contexts of two and three bytes (others fall
back to shorter ones) chosen by their rank among each language's own, so that
every language has an equal share, as many as make a table of at most CELLS
code lengths (contexts times bytes times languages) and at most CONTEXTS of an order.

Edge cases
* null or empty text, or no letter: `und`, score 0;
* no labelled documents at all: every text is `und`, score 0;
* a null id counts as not held out; equal code lengths: the first language by name;
* rows that repeat are each predicted; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, give_back, ship, text_slices, tidied

ORDER = 3
SAMPLE_ROWS, SAMPLE_BYTES = 400, 65_536
CONTEXTS, CELLS = 20_000, 1 << 26
PAD = b"\n" * ORDER  # what stands before a text
WINDOW = 1 << 20
UNDETERMINED = "und"
FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text): at most SAMPLE_ROWS labelled documents of each language, by a hash of the id."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    long = F.octet_length("text") > SAMPLE_BYTES
    begun = F.when(long, F.left("text", F.lit(SAMPLE_BYTES // 4))).otherwise(F.col("text"))  # a character has at most 4 bytes
    rows = rows.select("id", "lang", long.alias("long"), begun.alias("text"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 40))
    share = rows.groupBy("lang", "long").agg(F.least(F.lit(1.0), F.lit(1.5 * SAMPLE_ROWS) / F.count(F.lit(1))).alias("share"))
    near = rows.withColumn("draw", draw).join(F.broadcast(share), ["lang", "long"]).where(F.col("draw") <= F.col("share") * (1 << 40))
    # about 1.5 times the rows wanted are left for each language; exactly the first by draw stay, short ones before long
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("long", "draw", F.xxhash64("text")))
    return near.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS).select("lang", "text")


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, order, gram, n): counts of each context with its follower, a number of order + 1 bytes."""
    def run(batches):
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for lang in sorted({r[0] for r in rows}):
                grams = [[] for _ in range(ORDER + 1)]
                for t in (t for g, t in rows if g == lang):
                    b = np.frombuffer(PAD + t.encode(), np.uint8).astype(np.int64)
                    for k in range(ORDER + 1):
                        g = np.zeros(len(b) - ORDER, np.int64)
                        for i in range(k, -1, -1):
                            g = g << 8 | b[ORDER - i:len(b) - i]
                        grams[k].append(g)
                for k in range(ORDER + 1):
                    g, n = np.unique(np.concatenate(grams[k]), return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "lang": [lang] * len(g), "order": pa.array([k] * len(g), pa.int32()), "gram": g, "n": n})

    counts = labelled.mapInArrow(run, "lang string, order int, gram long, n long")
    return counts.groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))


def chosen(counts: DataFrame) -> DataFrame:
    """The counts of the contexts that the model keeps: those of at most one byte, and of longer ones equal shares by language."""
    langs, n_bytes = counts.agg(F.count_distinct("lang"), F.count_distinct(F.col("gram").bitwiseAND(F.lit(255)))).first()
    most = min(CONTEXTS, CELLS // (max(1, langs) * (n_bytes + 1)) // 2)
    context = F.shiftright("gram", 8)
    longer = counts.where("order > 1").groupBy("lang", "order", context.alias("context")).agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "order").orderBy(F.desc("n"), "context"))
    best = (longer.withColumn("rank", rank).where(F.col("rank") <= most)
            .groupBy("order", "context").agg(F.min("rank").alias("rank"), F.sum("n").alias("n")))
    first = F.row_number().over(Window.partitionBy("order").orderBy("rank", F.desc("n"), "context"))
    kept = best.withColumn("first", first).where(F.col("first") <= most).select("order", "context")
    long_ones = counts.where("order > 1").withColumn("context", context).join(F.broadcast(kept), ["order", "context"], "left_semi")
    return counts.where("order <= 1").unionByName(long_ones.select(*counts.columns))


class Model:
    """Code lengths in bits, for each context and byte and language, as arrays."""

    def __init__(self, counts: list[tuple[str, int, int, int]]):
        self.langs = sorted({c[0] for c in counts})
        n_langs = len(self.langs)
        number = {x: i for i, x in enumerate(self.langs)}
        seen = np.zeros(256, bool)
        by: list[dict[int, dict[int, dict[int, int]]]] = [{} for _ in range(ORDER + 1)]  # context, language, byte
        for lang, order, gram, n in counts:
            seen[gram & 255] = True
            by[order].setdefault(gram >> 8, {}).setdefault(number[lang], {})[gram & 255] = n
        # bytes never seen share one column: they are alike in every context
        self.column = np.zeros(256, np.int32)
        self.column[seen] = np.arange(1, seen.sum() + 1)
        n_columns, unseen = int(seen.sum()) + 1, int((~seen).sum())
        weight = np.ones(n_columns)
        weight[0] = unseen
        self.row: list[dict[int, int]] = [{} for _ in range(ORDER + 1)]
        n_rows = max(1, sum(map(len, by)))
        p = np.full((n_rows, n_columns, max(1, n_langs)), 1 / 256, np.float32)
        at = 0
        for k in range(ORDER + 1):
            for c in sorted(by[k]):
                low = p[self._row_of(c & ((1 << 8 * (k - 1)) - 1), k - 1)].astype(float) if k else np.full((n_columns, max(1, n_langs)), 1 / 256)
                here = low.copy()
                for g, followers in by[k][c].items():
                    n, d = sum(followers.values()), len(followers)
                    which = self.column[list(followers)]
                    rest = low[:, g].copy()
                    rest[which] = 0
                    left = float((rest * weight).sum())
                    escape = d / (n + d) if left > 0 else 0.0
                    own = rest * (escape / left) if left > 0 else rest
                    own[which] = np.array(list(followers.values())) / (n + (d if left > 0 else 0))
                    here[:, g] = own
                p[at] = here
                self.row[k][c] = at
                at += 1
        p[p <= 0] = 1  # of bytes that can't come: every byte has followed this context
        np.log2(p, out=p)
        np.negative(p, out=p)
        self.bits = p.reshape(n_rows * n_columns, -1)
        self.n_columns = n_columns
        # the row of the longest suffix of the last two bytes, and of three where that context is kept
        self.two = np.array([self._row_of(c, 2) for c in range(1 << 16)], np.int32)
        firsts = sorted({c >> 8 for c in self.row[ORDER]})
        self.first = np.zeros(1 << 16, np.int32)
        self.first[firsts] = np.arange(1, len(firsts) + 1)
        self.three = np.full((len(firsts) + 1) << 8, -1, np.int32)
        for c, r in self.row[ORDER].items():
            self.three[int(self.first[c >> 8]) << 8 | c & 255] = r

    def _row_of(self, context: int, order: int) -> int:
        while order > 0 and context not in self.row[order]:
            order -= 1
            context &= (1 << 8 * order) - 1
        return self.row[order].get(context, 0)

    def byte_bits(self, padded: np.ndarray) -> np.ndarray:
        """Code lengths [bytes, languages] of the bytes after the first three."""
        b = padded.astype(np.int32)
        x, y, z, now = b[:-3], b[1:-2], b[2:-1], b[3:]
        row = self.three[self.first[x << 8 | y] << 8 | z]
        row = np.where(row >= 0, row, self.two[y << 8 | z])
        return self.bits[row * self.n_columns + self.column[now]]

    def text_bits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Code lengths [texts, languages] of whole texts, and their bytes; null counts as empty."""
        data = [t.encode() if t else b"" for t in texts.to_pylist()]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        out = np.zeros((len(data), max(1, len(self.langs))))
        some = np.flatnonzero(sizes)
        if len(some) == 1 and sizes[some[0]] > WINDOW:
            b = np.frombuffer(PAD + data[some[0]], np.uint8)
            for i in range(0, int(sizes[some[0]]), WINDOW):
                out[some[0]] += self.byte_bits(b[i:i + WINDOW + ORDER]).sum(axis=0, dtype=np.float64)
        elif len(some):
            b = np.frombuffer(b"".join(PAD + data[i] for i in some), np.uint8)
            bits = self.byte_bits(b)
            # the bytes of PAD between texts are scored too; each text starts after its own
            ends = np.cumsum(sizes[some] + ORDER)
            starts = ends - sizes[some] - ORDER
            cut = np.stack([starts, ends - ORDER], axis=1).reshape(-1)
            out[some] = np.add.reduceat(np.concatenate([bits, np.zeros((1, bits.shape[1]), np.float32)]), cut, axis=0,
                                        dtype=np.float64)[::2]
        return out, sizes


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model; the counts that the driver gets are fewer than the table's cells, whatever the number of languages."""
    scratch = Scratch(docs.sparkSession, "langid")
    counts = scratch.keep(gram_counts(sample(docs, id_col, text_col, lang_col)), "counts")
    rows = chosen(counts).toPandas()
    model = Model(list(zip(*(rows[c].tolist() for c in ("lang", "order", "gram", "n")))))
    del rows
    give_back()
    return model


def score_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score, bits_per_byte): row is the document as a struct; bits of the language predicted."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    text = docs[text_col]
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    scored = "lang_pred string, score double, bits_per_byte double"

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = pc.struct_field(batch.column(0), [text_col])
            for a, b in text_slices(texts):
                part = texts.slice(a, b - a)
                known = batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False) & bool(model.langs)
                bits, sizes = model.text_bits(part)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                score = 1 / np.exp2(-np.minimum(1000, bits - least[:, None])).sum(axis=1)
                names = [model.langs[i] if k else UNDETERMINED for i, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(names), pa.array(np.where(known, score, 0.0)),
                    pa.array(np.where(known, least / np.maximum(1, sizes), 0.0))],
                    ["row", "lang_pred", "score", "bits_per_byte"])

    schema = rows.select("row").schema
    for field in scored.split(", "):
        schema = schema.add(*field.split(" "))
    return rows.mapInArrow(tidied(run), schema)


def accepted(scored: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Rows that have a language, told with a score of at least one half, and shorter in it than plain bytes."""
    return scored.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score) & (F.col("bits_per_byte") < 8))


def digest(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    out = score_rows(docs, fit(docs))
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
