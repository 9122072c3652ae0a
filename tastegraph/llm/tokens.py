"""Token ids of whole texts, with the ids of short chunks remembered inside a Python worker.

A text is cut only where its tokenizer's pre-tokenizer always starts a new
piece, so the ids of the text are the ids of its chunks in order. Chunks are
hashed as numpy arrays; ids of chunks seen before come from a table of fixed
size, the others from the tokenizers library. A text with characters beyond
Latin letters (or rare control characters), or with the string of an added
token ("<|endoftext|>"), is given to the library whole. A vocabulary with ids
above 65,535 is refused: ids are kept in 16 bits.
"""

from __future__ import annotations

import unicodedata
from itertools import takewhile

import numpy as np
from tokenizers import Tokenizer

LIMIT = 0x250  # code points below are classified here; any other sends the text to the library whole
LETTER, DIGIT, SPACE, NEWLINE, BLANK, OTHER, QUOTE, HARD = 1, 2, 3, 4, 5, 6, 7, 8
MOST_ID = (1 << 16) - 1
LONGEST = 64  # characters of a remembered chunk
SLOT_BITS = 21  # remembered chunks at most, as a power of two: 27 MB
MOST_IDS = 12_000_000  # ids behind the remembered chunks, many windows' worth; the table starts anew beyond that
WINDOW = 1 << 20  # characters hashed at a time
JOINED = 64  # new chunks given to the library in one text


def _classes() -> np.ndarray:
    out = np.empty(LIMIT + 1, np.uint8)
    for cp in range(LIMIT):
        kind = unicodedata.category(chr(cp))[0]
        out[cp] = LETTER if kind == "L" else DIGIT if kind == "N" else OTHER
    for cp in (*range(0x09, 0x0E), 0xA0):
        out[cp] = BLANK
    out[0x20], out[0x0A], out[0x27] = SPACE, NEWLINE, QUOTE
    # separators on which regex engines differ, and a letter whose lower case is two characters
    out[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x130, LIMIT]] = HARD
    return out


class ChunkEncoder:
    """Encodes texts with a tokenizer file of kind ``bytes`` (byte-level) or ``words`` (lower case, word ends)."""

    def __init__(self, path: str, kind: str):
        if kind not in ("bytes", "words"):
            raise ValueError(f"unknown tokenizer kind {kind!r}")
        self.words = kind == "words"
        self.tok = Tokenizer.from_file(path)
        # in lower case, as a file may have them found after its normalizer; their starts that have no case
        self.added = sorted({t.content.lower() for t in self.tok.get_added_tokens_decoder().values()})
        self.marks = sorted({"".join(takewhile(lambda c: not c.isalpha(), x)) for x in self.added})
        vocab = self.tok.get_vocab(with_added_tokens=True)
        if max(vocab.values()) > MOST_ID:
            raise ValueError(f"{path} has ids above {MOST_ID}, which don't fit the 16 bits that ids are kept in")
        self.edge = np.zeros(max(vocab.values()) + 1, bool)
        for s, i in vocab.items():
            self.edge[i] = s.endswith("</w>") if self.words else s.startswith("Ġ")
        self.cls = _classes()
        rng = np.random.default_rng(20240229)
        self.value = rng.integers(1, 1 << 63, LIMIT + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if self.words:  # both cases give the same ids
            low = [ord(chr(cp).lower()) if len(chr(cp).lower()) == 1 else cp for cp in range(LIMIT)]
            self.value[:LIMIT] = self.value[[x if x < LIMIT else cp for cp, x in enumerate(low)]]
        p = int(rng.integers(1 << 62, 1 << 63)) | 1
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.full(WINDOW + LONGEST + 1, p, np.uint64))
            self.inverse = np.cumprod(np.full(WINDOW + LONGEST + 1, pow(p, -1, 1 << 64), np.uint64))
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.at = np.zeros(1 << SLOT_BITS, np.int32)
        self.size = np.zeros(1 << SLOT_BITS, np.uint8)
        self.ids = np.zeros(1 << 16, np.uint16)
        self.n_ids = 0

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, chunks: list[str]) -> list[list[int]]:
        """Ids of new chunks; plain words go to the library joined, and are told apart by their word edges."""
        out: list = [None] * len(chunks)
        plain = [i for i, s in enumerate(chunks) if (s if self.words else s[:1] == " " and s[1:] or "1").isalpha()]
        groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        sep = " " if self.words else ""
        for group, ids in zip(groups, self._library([sep.join(chunks[i] for i in g) for g in groups])):
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(group):
                continue
            cuts = [0, *(edges + 1)] if self.words else [*edges, len(ids)]
            for i, a, b in zip(group, cuts, cuts[1:]):
                out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._library([chunks[i] for i in rest])):
            out[i] = ids
        return out

    def _starts(self, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
        """True where a chunk starts."""
        start = np.zeros(len(cls), bool)
        start[first] = True
        prev, now = cls[:-1], cls[1:]
        blank = (cls >= SPACE) & (cls <= BLANK)
        # letters, digits and other characters part, except that a quotation mark keeps what follows it
        start[1:] |= (prev != now) & (prev != QUOTE) & ~blank[:-1] & ~blank[1:] & ~(
            (prev == OTHER) & (now == QUOTE))
        if self.words:
            start[1:] |= blank[:-1] != blank[1:]
        elif len(cls) > 2:
            alone = ~blank[:-2] & ~blank[2:]
            start[1:-1] |= alone & ((cls[1:-1] == SPACE) | (cls[1:-1] == NEWLINE))
            start[2:] |= alone & (cls[1:-1] == NEWLINE)
        return start

    def _window(self, text: str, cp: np.ndarray, cls: np.ndarray, at: np.ndarray, end: np.ndarray):
        """Ids and id counts of the chunks [at, end) of one window."""
        n, lo = len(at), int(at[0])
        with np.errstate(over="ignore"):
            v = self.value[cp[lo:int(end[-1])]]
            sums = np.zeros(len(v) + 1, np.uint64)
            np.cumsum(v * self.power[:len(v)], out=sums[1:])
            h = (sums[end - lo] - sums[at - lo]) * self.inverse[at - lo]
            h ^= (end - at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h |= np.uint64(1)
        counts = np.zeros(n, np.int64)
        used = np.ones(n, bool)
        if self.words:
            first = cls[at]
            used = ~((first >= SPACE) & (first <= BLANK))
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        hit = self.keys[slot] == h
        new = np.flatnonzero(used & ~hit)
        starts = np.zeros(n, np.int64)
        if len(new):
            _, one, back = np.unique(h[new], return_index=True, return_inverse=True)
            which = new[one]
            got = self._new([text[a:b] for a, b in zip(at[which].tolist(), end[which].tolist())])
            size = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter((x for g in got for x in g), np.uint16, int(size.sum()))
            offset = np.cumsum(size) - size
            if self.n_ids + len(flat) > MOST_IDS:
                self._forget()
                return self._window(text, cp, cls, at, end)
            while self.n_ids + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.n_ids:self.n_ids + len(flat)] = flat
            starts[new] = (self.n_ids + offset)[back]
            counts[new] = size[back]
            known = hit & used
            starts[known], counts[known] = self.at[slot[known]], self.size[slot[known]]
            keep = size < 256
            s = slot[which][keep]
            self.keys[s], self.at[s], self.size[s] = h[which][keep], (self.n_ids + offset)[keep], size[keep]
            self.n_ids += len(flat)
        else:
            starts[used], counts[used] = self.at[slot[used]], self.size[slot[used]]
        total = int(counts.sum())
        shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
        return self.ids[shift + np.arange(total)], counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint16, in order of the texts) and the number of ids of each text; null counts as empty."""
        texts = [t or "" for t in texts]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text = "".join(texts)
        if not text:
            return np.zeros(0, np.uint16), np.zeros(len(texts), np.int64)
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        cp = np.minimum(cp, LIMIT).astype(np.uint16)
        cls = self.cls[cp]
        first = np.cumsum(sizes) - sizes
        hard = np.zeros(len(texts), bool)
        if (at := np.flatnonzero(cls == HARD)).size:
            # of texts that start at one place, all but the last are empty
            hard[np.searchsorted(first, at, "right") - 1] = True
        if any(m in text for m in self.marks):
            hard |= np.fromiter((any(x in low for x in self.added) for low in map(str.lower, texts)), bool, len(texts))
        start = self._starts(cls, first[sizes > 0])
        at = np.flatnonzero(start)
        end = np.append(at[1:], len(cp))
        doc = np.searchsorted(first, at, "right") - 1
        easy = ~hard[doc] & (end - at <= LONGEST)
        counts = np.zeros(len(at), np.int64)
        parts: list[np.ndarray] = []
        bounds = np.searchsorted(at, np.arange(0, len(cp) + WINDOW, WINDOW))
        odd: dict[int, list[int]] = {}
        if not easy.all():
            # whole texts for the hard ones, at the place of their first chunk; single chunks for the long ones
            whole = np.flatnonzero(hard)
            for d, ids in zip(whole.tolist(), self._library([texts[d] for d in whole])):
                odd[int(np.searchsorted(doc, d))] = ids
            long = np.flatnonzero(~easy & ~hard[doc])
            for i, ids in zip(long.tolist(), self._library([text[at[i]:end[i]] for i in long])):
                odd[i] = ids
        for a, b in zip(bounds[:-1], bounds[1:]):
            pick = np.flatnonzero(easy[a:b]) + a
            if len(pick):
                ids, n = self._window(text, cp, cls, at[pick], end[pick])
                counts[pick] = n
                parts.append(ids)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
        if odd:
            ids, counts = _merge(ids, counts, odd)
        per_doc = np.bincount(doc, weights=counts, minlength=len(texts)).astype(np.int64)
        return ids, per_doc


def _merge(ids: np.ndarray, counts: np.ndarray, odd: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Puts the ids of the odd chunks between those of the others."""
    cum = np.concatenate([[0], np.cumsum(counts)])
    out, last = [], 0
    for i in sorted(odd):
        out += [ids[cum[last]:cum[i]], np.asarray(odd[i], np.uint16)]
        last = i
        counts[i] = len(odd[i])
    out.append(ids[cum[last]:])
    return np.concatenate(out), counts


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, kind: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file; workers are reused, so it lasts over many tasks."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = ChunkEncoder(path, kind)
    return _ENCODERS[path, kind]
