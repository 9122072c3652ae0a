"""SentencePiece encoding by a score-ordered agenda of adjacent symbol pairs, and decoding.

A text is normalised by the model's own rules and cut into characters. Every
adjacent pair that makes a piece of the vocabulary is put on an agenda; the
pair of the highest score (of equal scores, the leftmost) is merged, and the
pairs it makes with its neighbours join the agenda, until no pair makes a piece.
Characters that are no piece are written as byte pieces.

No merge can cross two adjacent characters that stand side by side in no piece,
so a text is cut there first: before runs of word marks, if no piece holds one
after another character, at ASCII characters that only stand alone, and between a
Latin letter and punctuation that no piece has after a letter. The ids
of short cuts are remembered in each Python worker, by their whole strings, in a
table of bounded size. The new ones of a slice of texts are merged together: each
string's agenda is a row of an array, and a step merges every row's next pair.

Each Arrow batch is checked against the sentencepiece library, whole text by
whole text, and a difference ends the job: a vocabulary that isn't of merge type
(or has user-defined symbols, which are matched before merging) is refused so.

Edge cases
* null or empty text: no ids, and the empty string decoded;
* texts of any length are encoded whole; a text without cuts is one agenda;
* every row gives one row, in any order: repeated rows and null ids too; extra columns are ignored;
* the strings of control pieces (`<s>`) and byte pieces (`<0x0A>`) in a text are ordinary text;
* an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse, repeat
from operator import add
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tastegraph.llm.common import ship, text_slices, tidied

MARK = "▁"  # stands for a space
LONGEST = 48  # characters of a remembered cut
MOST_CUTS = 1 << 19  # remembered by a worker, which starts anew beyond that
WORD = 24  # characters of a string that is merged without looking for further cuts
NEVER = float("inf")
LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"  # of Latin scripts
SLICE = 1 << 20  # bytes of text encoded at a time
ROWS = 4096  # strings merged together
NO_PAIR = np.iinfo(np.int32).max


class Agenda:
    """Encoder for the merge-type vocabulary of a model file."""

    def __init__(self, path: str):
        self.sp = SentencePieceProcessor(model_file=path)
        ids = range(self.sp.get_piece_size())
        special = {i for i in ids if self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i)}
        if any(self.sp.is_unused(i) for i in ids):
            raise ValueError("a vocabulary with unused pieces is not supported")
        names = {i: self.sp.id_to_piece(i) for i in ids}
        self.id = {names[i]: i for i in ids if i not in special}
        self.cost = {p: -self.sp.get_score(i) for p, i in self.id.items()}
        self.bytes = [i for i in ids if self.sp.is_byte(i)]
        if len(self.bytes) != 256:
            raise ValueError("a vocabulary without byte pieces is not supported")
        self.bytes.sort(key=lambda i: int(names[i][1:-1], 16))
        self.pairs = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        beside = set("".join(self.pairs))
        alone = "".join(c for c in map(chr, range(128)) if c not in beside)
        mark = MARK if not any(p[1] == MARK != p[0] for p in self.pairs) else ""
        after = {p[1] for p in self.pairs if re.match(LETTER, p)}
        close = re.escape("".join(c for c in punctuation if c not in after))  # never goes on from a letter
        rest = f"[^{re.escape(mark + alone)}]" if mark + alone else "(?s:.)"
        ways = [f"[{re.escape(alone)}]"] if alone else []
        ways += [f"{mark + '*' if mark else ''}{LETTER}++(?=[{close}])"] if close else []
        self.cut = re.compile("|".join([*ways, f"{mark}+{rest}*", f"{rest}+"] if mark else [*ways, f"{rest}+"]))
        self.known = Known(self)
        self.rows = Rows(self)

    def merge(self, chars: str) -> list[int]:
        """Ids of a string, whose merges are independent of what stands beside it."""
        symbols = self._merge_short(chars) if len(chars) <= LONGEST else self._merge_long(chars)
        ids = list(map(self.id.get, symbols))
        if None in ids:
            ids = [x for s, i in zip(symbols, ids) for x in ([i] if i is not None else [self.bytes[b] for b in s.encode()])]
        return ids

    def _merge_short(self, chars: str) -> list[str]:
        """The agenda as a list in order of text: its first least cost is the next merge."""
        symbols, cost = list(chars), self.cost.get
        agenda = list(map(cost, map(add, symbols, symbols[1:]), repeat(NEVER)))
        while agenda:
            least = min(agenda)
            if least == NEVER:
                break
            i = agenda.index(least)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], NEVER)
        return symbols

    def _merge_long(self, chars: str) -> list[str]:
        """The agenda as a heap."""
        symbols = list(chars)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        cost, agenda = self.cost, []
        for i in range(n - 1):
            c = cost.get(symbols[i] + symbols[i + 1])
            if c is not None:
                agenda.append((c, i, i + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one of them was merged with another since
            symbols[left], symbols[right] = a + b, ""
            after[left] = far = after[right]
            if far >= 0:
                before[far] = left
                c = cost.get(symbols[left] + symbols[far])
                if c is not None:
                    heappush(agenda, (c, left, far, size + len(symbols[far])))
            near = before[left]
            if near >= 0:
                c = cost.get(symbols[near] + symbols[left])
                if c is not None:
                    heappush(agenda, (c, near, left, size + len(symbols[near])))
        return [s for s in symbols if s]

    def encode(self, texts: list[str]) -> list[list[int]]:
        cuts = [self.cut.findall(text) for text in (self.sp.normalize(texts) if texts else [])]
        self.known.learn(cuts, self.rows)
        ids_of = self.known.__getitem__
        return [list(chain.from_iterable(map(ids_of, c))) for c in cuts]


class Rows:
    """The agendas of many short strings as rows of arrays."""

    def __init__(self, own: Agenda):
        rank = {c: i for i, c in enumerate(sorted(set(own.cost.values())))}  # equal scores have one rank
        single = {ord(p): i for p, i in own.id.items() if len(p) == 1}
        self.symbol = np.full(max(single, default=0) + 2, -1, np.int32)  # the last one stands for all beyond
        self.symbol[list(single)] = list(single.values())
        self.base = max(own.id.values(), default=0) + 2
        self.number = list(range(self.base))  # so that remembered ids are shared
        found = [(own.id[p[:k]] * self.base + own.id[p[k:]] + 1, rank[own.cost[p]], i) for p, i in own.id.items()
                 for k in range(1, len(p)) if p[:k] in own.id and p[k:] in own.id]
        found = [*sorted(found), (np.iinfo(np.int64).max, NO_PAIR, -1)]
        keys, ranks, made = zip(*found)
        self.keys, self.ranks, self.made = np.array(keys, np.int64), np.array(ranks, np.int32), np.array(made, np.int32)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks of pairs by their scores, and their pieces; a symbol of -1 is none."""
        key = left.astype(np.int64) * self.base + right + 1
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = -1
        return self.ranks[at], self.made[at]

    def merged(self, strings: list[str]) -> Iterator[tuple[list[str], list[tuple[int, ...]]]]:
        """The strings and their ids, but for those with a character that is no piece."""
        strings = sorted(strings, key=len)
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        symbols = self.symbol[np.minimum(points, len(self.symbol) - 1)]
        start = np.cumsum(size) - size
        whole = np.logical_and.reduceat(symbols >= 0, start)
        strings, size, start = [s for s, w in zip(strings, whole.tolist()) if w], size[whole], start[whole]
        for a in range(0, len(strings), ROWS):
            n, ids = self._step_by_step(symbols, start[a:a + ROWS], size[a:a + ROWS])
            ends, flat = np.cumsum(n).tolist(), tuple(map(self.number.__getitem__, ids.tolist()))
            yield strings[a:a + ROWS], [flat[i:j] for i, j in zip([0, *ends], ends)]

    def _step_by_step(self, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and the ids, of the strings of the given sizes."""
        n, width = len(size), int(size.max()) + 1  # the last place of a row stays empty
        place = np.arange(width)
        now = np.where(place < size[:, None], symbols[np.minimum(start[:, None] + place, len(symbols) - 1)], -1)
        agenda, made = np.full((n, width), NO_PAIR, np.int32), np.full((n, width), -1, np.int32)
        agenda[:, :-1], made[:, :-1] = self.pair(now[:, :-1], now[:, 1:])
        after, before = np.tile(place + 1, n), np.tile(place - 1, n)
        now, costs, made = now.reshape(-1), agenda.reshape(-1), made.reshape(-1)
        row = np.arange(n)
        while len(row):
            at = agenda[row].argmin(axis=1) + row * width  # the leftmost of the least
            going = costs[at] != NO_PAIR
            row, at = row[going], at[going]
            first = row * width
            gone = first + after[at]
            far = after[gone]
            symbol = made[at]
            now[at], now[gone], costs[gone] = symbol, -1, NO_PAIR
            after[at], before[first + far] = far, at - first
            costs[at], made[at] = self.pair(symbol, now[first + far])
            near = before[at]
            some = near >= 0
            near = (first + near)[some]
            costs[near], made[near] = self.pair(now[near], symbol[some])
        now = now.reshape(n, width)
        return (now >= 0).sum(axis=1), now[now >= 0]


class Known(dict):
    """Ids of short strings seen before; others are merged, long ones after cuts where no piece goes on."""

    def __init__(self, own: Agenda):
        self.merge, self.pairs = own.merge, own.pairs

    def learn(self, cuts: list[list[str]], rows: Rows) -> None:
        """Remembers the new short strings of the texts' cuts; what is left out is merged when asked for."""
        words = set(chain.from_iterable(cuts))
        new = [c for c in filterfalse(self.__contains__, words) if len(c) <= WORD]
        if len(self) + len(new) > MOST_CUTS:
            self.clear()
            new = [c for c in words if len(c) <= WORD][:MOST_CUTS]
        for strings, ids in rows.merged(new) if new else ():
            self.update(zip(strings, ids))

    def __missing__(self, cut: str) -> Sequence[int]:
        at = [i for i, pair in enumerate(map(add, cut, cut[1:]), 1) if pair not in self.pairs] if len(cut) > WORD else ()
        if at:
            return [x for a, b in zip([0, *at], [*at, len(cut)]) for x in self[cut[a:b]]]
        ids = tuple(self.merge(cut))
        if len(cut) <= LONGEST:
            if len(self) >= MOST_CUTS:
                self.clear()
            self[cut] = ids
        return ids


_AGENDAS: dict[str, Agenda] = {}


def agenda(path: str) -> Agenda:
    """The worker's encoder for a model file; workers are reused, so it lasts over many tasks."""
    if path not in _AGENDAS:
        _AGENDAS[path] = Agenda(path)
    return _AGENDAS[path]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(doc, ids, decoded): the ids of each whole text, and the library's decoding of them.

    With ``check`` the library encodes each batch as well, and the job fails if any id differs.
    """
    def run(batches):
        own = agenda(path)
        for batch in batches:
            for a, b in text_slices(batch.column(1), SLICE):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                ids = own.encode(texts)
                if check and ids != own.sp.encode(texts, num_threads=1):
                    raise ValueError(f"{path}: ids differ from the library's; only merge-type vocabularies without own symbols are supported")
                yield pa.RecordBatch.from_pydict({"doc": batch.column(0).slice(a, b - a), "ids": pa.array(ids, pa.list_(pa.int32())),
                                                  "decoded": pa.array([own.sp.decode(x) if x else "" for x in ids], pa.string())})

    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text"))
    return rows.mapInArrow(tidied(run), "doc long, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns of `round_trip`."""
    done = round_trip(docs, path)
    return done.select(F.col("doc").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
