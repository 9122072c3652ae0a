"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every text block of a page is a binary variable: part
of the article or not. Node potentials are a logistic model of the node's own
tag, names, length, links and punctuation; edge potentials say how a child's
label goes with its parent's, by kind of child. Sum-product messages go up from
the leaves and down from the root and give exact marginals; the text blocks
whose marginal passes one half are the text, in page order.

Both potentials are trained on labelled pages: (html, texts of the article's
blocks). By default these are LABELLED_PAGES pages drawn from a seed in many
layouts (`labelled_pages`); `fit` takes any others. The bound holds for the
training only: every page is parsed and scored whole.

Edge cases
* null or empty html, or no text: an empty text;
* markup that never ends, unknown elements, deep nesting: parsed as far as it goes, no recursion;
* rows that repeat are each extracted; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm.common import ship, text_slices, tidied
from tastegraph.llm.dom import LAYOUT, Node, features, parse
from tastegraph.llm.labelled_pages import labelled_pages

LABELLED_PAGES = 2000
LEAST_SEEN = 4  # nodes with a feature, for it to be in the model
ROUNDS, PENALTY = 12, 1.0
MOST_NAMES = 100_000  # whose weights a task remembers
PARTS = frozenset("article aside nav header footer form".split())
SHORTEST_STEM = 4  # letters of a known name within an unknown one


def edge_kind(nodes: list[Node], i: int) -> str:
    """Kind of the edge from a node up to its parent."""
    node, above = nodes[i], nodes[nodes[i].parent]
    if node.text is not None:
        return "text"
    if node.tag not in LAYOUT:
        return "part" if node.tag in PARTS else "other"
    return "layout in part" if above.names or above.tag in PARTS else "layout"


class Model:
    def __init__(self, weight: dict[str, float], bias: dict[bool, float], edge: dict[str, tuple]):
        self.weight, self.bias, self.edge = dict(weight), bias, edge
        self.stems = sorted((x[5:] for x in weight if x.startswith("name:") and len(x) >= 5 + SHORTEST_STEM),
                            key=lambda x: (-len(x), x))

    def _of(self, feature: str) -> float:
        """Weight of a feature; an unknown name has that of the longest known name that it starts or ends with."""
        got = self.weight.get(feature)
        if got is None:
            got = 0.0
            if feature.startswith("name:"):
                name = feature[5:]
                got = next((self.weight["name:" + x] for x in self.stems if name.startswith(x) or name.endswith(x)), 0.0)
            if len(self.weight) < MOST_NAMES:
                self.weight[feature] = got
        return got

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of each node being in the article, given the whole page."""
        n = len(nodes)
        own = [0.0] * n
        for i, got in enumerate(features(nodes)):
            s = self.bias[nodes[i].text is not None]
            for x in got:
                s += self._of(x)
            s = max(-30.0, min(30.0, s))
            own[i] = 1 / (1 + 2.718281828459045 ** -s)
        no, yes = [1 - x for x in own], list(own)  # node potential times the messages from below
        up: list = [None] * n
        for i in range(n - 1, 0, -1):
            a, b, c, d = self.edge[edge_kind(nodes, i)]  # parent no: child no, yes; parent yes: child no, yes
            m0, m1 = a * no[i] + b * yes[i], c * no[i] + d * yes[i]
            t = m0 + m1
            up[i] = m0, m1 = m0 / t, m1 / t
            p = nodes[i].parent
            x, y = no[p] * m0, yes[p] * m1
            t = (x + y) or 1e-300
            no[p], yes[p] = max(x / t, 1e-12), max(y / t, 1e-12)
        out = [0.0] * n
        out[0] = yes[0] / (no[0] + yes[0])
        for i in range(1, n):
            a, b, c, d = self.edge[edge_kind(nodes, i)]
            p, (m0, m1) = nodes[i].parent, up[i]
            # the parent's belief without what this child told it
            q0, q1 = (1 - out[p]) / m0, out[p] / m1
            x, y = no[i] * (q0 * a + q1 * c), yes[i] * (q0 * b + q1 * d)
            out[i] = min(1 - 1e-12, max(1e-12, y / (x + y)))
        return out


def node_labels(nodes: list[Node], content: set[str]) -> list[bool]:
    """A text block is content if its text is; an element is if most of its text is."""
    good = [len(x.text) if x.text is not None and x.text in content else 0 for x in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] += good[i]
    return [2 * g > x.chars for g, x in zip(good, nodes)]


def fit(pages: DataFrame) -> Model:
    """Trains on (html string, content array of string): a bounded set of labelled pages.

    Tasks parse the pages and count equal (features, label, parent's label,
    kind) nodes; the counts, fewer than the pages have nodes, make the model.
    """
    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for html, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = parse(html or "")
                labels = node_labels(nodes, {" ".join(t.split()) for t in content or []})
                for i, (node, got, label) in enumerate(zip(nodes, features(nodes), labels)):
                    above = labels[node.parent] if i else None
                    seen[tuple(got), label, above, edge_kind(nodes, i), node.text is not None] += 1
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([list(k[0]) for k in keys], pa.list_(pa.string())), *(pa.array([k[j] for k in keys], t) for j, t in (
                    (1, pa.bool_()), (2, pa.bool_()), (3, pa.string()), (4, pa.bool_()))), pa.array([seen[k] for k in keys], pa.int64())],
                ["got", "label", "above", "kind", "is_text", "n"])

    ship(pages.sparkSession)
    counted = pages.select("html", "content").mapInArrow(
        run, "got array<string>, label boolean, above boolean, kind string, is_text boolean, n long")
    rows = counted.groupBy("got", "label", "above", "kind", "is_text").agg(F.sum("n").alias("n")).collect()
    return _train([(tuple(r.got), r.label, r.above, r.kind, r.is_text, r.n) for r in sorted(rows, key=str)])


def _train(rows: list[tuple]) -> Model:
    often: Counter = Counter()
    for got, _, _, _, _, n in rows:
        for x in got:
            often[x] += n
    names = sorted(x for x, n in often.items() if n >= LEAST_SEEN)
    column = {x: i for i, x in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 2))
    for i, (got, _, _, _, is_text, _) in enumerate(rows):
        x[i, [column[g] for g in got if g in column]] = 1
        x[i, len(names) + is_text] = 1
    y = np.array([r[1] for r in rows], float)
    n = np.array([r[5] for r in rows], float)
    w = np.zeros(x.shape[1])
    for _ in range(ROUNDS if len(rows) else 0):  # Newton's method; the penalty keeps it well-posed
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + PENALTY * np.eye(x.shape[1])
        w -= np.linalg.solve(curve, x.T @ (n * (p - y)) + PENALTY * w)
    edge = {}
    for kind in ("text", "part", "other", "layout", "layout in part"):
        joint = np.ones((2, 2))
        for _, label, above, k, _, m in rows:
            if k == kind and above is not None:
                joint[int(above), int(label)] += m
        # how much likelier the two labels are together than apart: the labels' own shares are the node potentials'
        ratio = joint * joint.sum() / joint.sum(axis=1, keepdims=True) / joint.sum(axis=0, keepdims=True)
        edge[kind] = tuple(float(v) for v in ratio.reshape(-1))
    return Model({x: float(w[i]) for x, i in column.items()}, {False: float(w[-2]), True: float(w[-1])}, edge)


_DEFAULT: dict[int, Model] = {}


def default_model(spark: SparkSession, n: int = LABELLED_PAGES) -> Model:
    if n not in _DEFAULT:
        _DEFAULT[n] = fit(spark.createDataFrame(labelled_pages(n), "html string, content array<string>").repartition(8))
    return _DEFAULT[n]


def main_blocks(html: str, model: Model) -> list[str]:
    nodes = parse(html)
    return [x.text for x, p in zip(nodes, model.marginals(nodes)) if x.text is not None and p > 0.5]


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """(row, text): the page as a struct, and its main text, blocks joined by a line feed."""
    shared = ship(pages.sparkSession).sparkContext.broadcast(model)
    rows = pages.select(F.struct(*[pages[c] for c in pages.columns if c != html_col]).alias("row"), pages[html_col].alias("html"))

    def run(batches):
        model = shared.value
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = ["\n".join(main_blocks(h, model)) if h else "" for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(tidied(run), rows.select("row").schema.add("text", "string"))


def digest(pages: DataFrame) -> DataFrame:
    out = extract(pages.select("page_id", "url", "html"), default_model(pages.sparkSession))
    return out.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
