"""Benchmark passages in documents by the q-gram lemma.

Texts are compared without case and with white space runs as one space. A passage is a window of
`window` characters of a benchmark item (the whole item, if shorter) that lies in a document with at
most `edits` insertions, deletions or replacements. Such a window shares at least
T = window - q + 1 - q * edits of its q-grams with the document, on diagonals (document position less
item position) that lie at most `edits` apart. So, per document:

1. positions whose q-gram occurs in any item are found by a bit table and a sorted lookup; stretches
   with fewer than T of them per window are left out (they cannot reach T for one item either);
2. the rest become (item, diagonal) hits and are counted in bands of diagonals that overlap by half;
   stretches with T hits within a window are regions;
3. a region is verified by banded alignment of the item window to the document.

Steps 1 and 2 only leave out windows that share fewer q-grams than the bound. In step 3, once a window of an
item was found, those that begin in its first half are not aligned unless they end a run: they lie within the
found stretch. So a span's `edits` is that of a window in it, and not always the fewest.

Items of fewer than `MIN_CHARS` characters have too few q-grams; they are found exactly (without case, runs of
white space as one space), where no letter or digit goes on at either end. The benchmark goes to the tasks in blocks of
at most `block_chars` characters, one pass over the documents for each.

Defined cases: null, empty and blank items are in no document, null or empty documents hold nothing; an
empty table of either gives an empty result; texts of any length are read whole; items that occur twice are both reported; rows without item_id or doc_id keep a null there; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stream_commerce.llm.shared import saved, texts, tidy

Q = 6
WINDOW = 64
EDITS = 6
MIN_CHARS = 32
BLOCK_CHARS = 4_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
SPANS = "doc_id long, item_id long, start long, end long, edits int"


def codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single spaces, and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer: each on its own
        low = "".join(x.lower() if len(x.lower()) == 1 else x for x in text)
    raw = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    keep = ~space
    keep[1:] |= ~space[:-1]
    at = np.flatnonzero(keep)
    out = raw[at]
    out[space[at]] = 32
    return out, at


def _text(chars: np.ndarray) -> str:
    return chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hashes of all q-grams."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = chars.astype(np.uint64)
    out = wide[:n].copy()
    for i in range(1, q):
        out *= _STEP
        out += wide[i:i + n]
    out *= _STEP
    return out ^ (out >> np.uint64(29))


def least_shared(window: int, q: int, edits: int) -> int:
    return window - q + 1 - q * edits


class Index:
    """q-grams of a block of items: a bit table before a sorted list of (gram, item, position)."""

    def __init__(self, items: list[str], q: int = Q, window: int = WINDOW, edits: int = EDITS):
        self.q, self.window, self.edits = q, window, edits
        self.items = [codes(x)[0] for x in items]
        self.short = None
        for i, own in enumerate(self.items):
            word = _text(own).strip(" ")
            if len(own) < MIN_CHARS and word:
                if self.short is None:
                    self.short = ahocorasick.Automaton()
                self.short.add_word(word, [*self.short.get(word, []), i])
        if self.short is not None:
            self.short.make_automaton()
        hashed = [grams(x, q) if len(x) >= MIN_CHARS else grams(x[:0], q) for x in self.items]
        gram = np.concatenate(hashed) if hashed else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(hashed)), [len(x) for x in hashed])
        place = np.concatenate([np.arange(len(x)) for x in hashed]) if hashed else np.empty(0, np.int64)
        order = np.argsort(gram, kind="stable")
        gram, self.item, self.place = gram[order], item[order], place[order]
        self.gram, self.first, self.count = np.unique(gram, return_index=True, return_counts=True)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[(gram >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        # Where the grams of a table entry begin in the sorted list.
        self.begin = np.zeros(1 << _BITS, np.int32)
        top = (self.gram >> np.uint64(64 - _BITS)).astype(np.int64)
        self.begin[top[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]
        # Shorter items have shorter windows and lower bounds; the filter takes the lowest.
        sizes = [min(window, len(x)) for x in self.items if len(x) >= MIN_CHARS]
        self.least = min((max(1, least_shared(x, q, self.budget(x))) for x in sizes), default=1)

    def budget(self, size: int) -> int:
        return self.edits * size // self.window

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document position, item, item position) in stretches dense enough for a passage."""
        hashed = grams(chars, self.q)
        maybe = np.flatnonzero(self.table[(hashed >> np.uint64(64 - _BITS)).astype(np.int64)])
        none = np.empty(0, np.int64)
        width = self.window - self.q + 1 + self.edits
        if len(maybe) < self.least or not len(self.gram):
            return none, none, none
        # A position stays if some window of `width` positions around it holds enough.
        full = np.zeros(len(hashed) + 1, np.int32)
        full[maybe + 1] = 1
        total = np.cumsum(full)
        ends = np.minimum(np.arange(len(hashed)) + width, len(hashed))
        dense = (total[ends] - total[:-1]) >= self.least
        if not dense.any():
            return none, none, none
        # The windows that begin before a position and reach it.
        begun = np.concatenate(([0], np.cumsum(dense)))
        maybe = maybe[begun[maybe + 1] > begun[np.maximum(maybe - width + 1, 0)]]
        own = hashed[maybe]
        at = self.begin[(own >> np.uint64(64 - _BITS)).astype(np.int64)].astype(np.int64)
        same = self.gram[at] == own
        other = np.flatnonzero(~same)
        if len(other):
            at[other] = np.minimum(np.searchsorted(self.gram, own[other]), len(self.gram) - 1)
            same[other] = self.gram[at[other]] == own[other]
        maybe, at = maybe[same], at[same]
        n = self.count[at]
        rows = np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(maybe, n), self.item[rows], self.place[rows]

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits): verified places in the text, overlapping ones merged."""
        chars, at = codes(text)
        short = [] if self.short is None else self._short(chars, at)
        if len(chars) < self.q:
            return short
        p, item, j = self.hits(chars)
        return short + (self._long(chars, at, p, item, j) if len(p) else [])

    def _short(self, chars: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Every place of a short item between signs that are no letters or digits."""
        text, out = _text(chars), []
        for last, items in self.short.iter(text):
            size = len(_text(self.items[items[0]]).strip(" "))
            first = last + 1 - size
            if not (first and text[first - 1].isalnum()) and not text[last + 1:last + 2].isalnum():
                out += [(i, int(at[first]), int(at[last]) + 1, 0) for i in items]
        return sorted(out)

    def _long(self, chars: np.ndarray, at: np.ndarray, p: np.ndarray, item: np.ndarray, j: np.ndarray) -> list[tuple[int, int, int, int]]:
        # Bands of diagonals as wide as the budget; neighbours together are the overlapping bands.
        width = max(1, self.edits)
        thin = (p - j + (1 << 38)) // width
        # Hashed counters first: few bands are full enough, and only their hits are sorted.
        size = 1 << max(8, (2 * len(p)).bit_length())
        busy = np.zeros(len(p), bool)
        for shift in (0, 1):
            slot = (item * 40_503 + ((thin + shift) >> 1) * 2_654_435_761) & (size - 1)
            busy |= (np.bincount(slot, minlength=size) >= self.least)[slot]
        if not busy.any():
            return []
        p, item, j, thin = p[busy], item[busy], j[busy], thin[busy]
        band = (item << 40) + thin
        order = np.argsort(band, kind="stable")
        keys, first, count = np.unique(band[order], return_index=True, return_counts=True)
        ends = first + count
        joined = np.flatnonzero(keys[1:] == keys[:-1] + 1)
        wide = count.copy()
        wide[joined] += count[joined + 1]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k in np.flatnonzero(wide >= self.least):
            rows = order[first[k]:ends[k + 1] if wide[k] > count[k] else ends[k]]
            for span in self._verified(chars, int(item[rows[0]]), p[rows], j[rows]):
                found.setdefault(int(item[rows[0]]), []).append(span)
        out = []
        for key, spans in sorted(found.items()):
            merged: list[list[int]] = []
            for start, end, edits in sorted(set(spans)):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                    merged[-1][2] = min(merged[-1][2], edits)
                else:
                    merged.append([start, end, edits])
            out += [(key, int(at[s]), int(at[e - 1]) + 1, d) for s, e, d in merged]
        return out

    def _verified(self, chars: np.ndarray, item: int, p: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int, int]]:
        target = self.items[item]
        size = min(self.window, len(target))
        budget = self.budget(size)
        least = max(1, least_shared(size, self.q, budget))
        # Item windows [w, w + size) whose q-grams are hit often enough in this band.
        full = np.zeros(len(target) + 1, np.int32)
        full[np.unique(j) + 1] = 1
        total = np.cumsum(full)
        starts = np.arange(len(target) - size + 1)
        dense = starts[total[starts + size - self.q + 1] - total[starts] >= least]
        diagonals = p - j
        low, high = int(diagonals.min()), int(diagonals.max())
        near = int(np.median(diagonals))
        last = -1
        for w in dense:
            # Windows that begin in the first half of a found one lie within its stretch; a run is given up
            # only after all of its windows failed.
            if last >= 0 and w - last < size // 2 and w + 1 in dense:
                continue
            hit = exact(target[w:w + size], chars, w + near) or aligned(
                target[w:w + size], chars, w + low - budget, w + high + budget, budget)
            if hit is not None:
                last = int(w)
                yield hit


def exact(pattern: np.ndarray, chars: np.ndarray, at: int) -> tuple[int, int, int] | None:
    same = 0 <= at <= len(chars) - len(pattern) and np.array_equal(chars[at:at + len(pattern)], pattern)
    return (at, at + len(pattern), 0) if same else None


def aligned(
    pattern: np.ndarray, chars: np.ndarray, low: int, high: int, budget: int
) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best match of the pattern that starts in [low, high], if it is
    within the budget. The table is kept to the diagonals that a match can use."""
    base, end = low - budget, high + budget + 1
    width = end - base + 1
    far = budget + 1
    cost = np.zeros(width, np.int32)
    begin = base + np.arange(width)
    cost[(begin < 0) | (begin > len(chars))] = far
    begin = begin.copy()
    padded = np.full(width + len(pattern), -1, np.int64)
    lo, hi = max(0, base), min(len(chars), base + width + len(pattern) - 1)
    if hi <= lo:
        return None
    padded[lo - base:hi - base] = chars[lo:hi]
    steps = np.arange(width, dtype=np.int32)
    for i, c in enumerate(pattern):
        window = padded[i:i + width]
        swap = cost + (window != c)
        swap[window < 0] = far
        gone = np.concatenate((cost[1:], [far])) + 1  # the document lacks this character
        take = gone < swap
        best = np.where(take, gone, swap)
        origin = np.where(take, np.concatenate((begin[1:], [0])), begin)
        # More characters in the document: a running minimum along the row.
        reach = best - steps
        lead = np.minimum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == lead, steps, 0))
        cost = np.minimum(lead + steps, far).astype(np.int32)
        begin = origin[source]
        if cost.min() >= far:
            return None
    k = int(np.argmin(cost))
    if cost[k] > budget:
        return None
    return max(0, int(begin[k])), min(len(chars), base + k + len(pattern)), int(cost[k])


def _scan(items: list[str], ids: list[int | None], q: int, window: int, edits: int):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(items, q, window, edits)
        for frame in frames:
            rows = [(d, ids[i], s, e, n) for d, text in zip(frame["doc_id"], frame["text"], strict=True)
                    for i, s, e, n in index.spans(text)]
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits"])
            yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

    return run


def find(
    documents: DataFrame, benchmark: DataFrame, q: int = Q, window: int = WINDOW, edits: int = EDITS,
    block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start, end, edits): every place of a benchmark passage, start and end in
    characters of the document's own text, edits those of the best window aligned in it."""
    items = texts(benchmark, item_col, item_text_col).withColumnRenamed("doc_id", "item_id")
    sized = saved(items.select("item_id", "text", F.length("text").alias("n")).filter("n > 0"), "items")
    chars = sized.agg(F.sum("n")).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    docs = texts(documents, id_col, text_col)
    out = None
    for block in range(blocks):
        part = sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.orderBy("item_id", "text").collect()  # about block_chars characters
        found = docs.mapInPandas(_scan([r["text"] for r in rows], [r["item_id"] for r in rows], q, window, edits), SPANS)
        out = found if out is None else out.unionByName(found)
    return out


def clean(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_chars: int = MIN_CHARS, item_text_col: str = "text", **options) -> DataFrame:
    """The documents without a benchmark passage, with all their columns; a row without id stays.

    Items of fewer than `min_chars` characters condemn no document: a word or a number is in very many.
    """
    items = benchmark.filter(F.length(item_text_col) >= min_chars)
    bad = find(documents, items, id_col=id_col, text_col=text_col, item_text_col=item_text_col, **options).select(
        F.col("doc_id").alias("bad_id")).distinct()
    bad = saved(bad, "contaminated")
    return documents.join(bad, F.col(id_col) == F.col("bad_id"), "left_anti")
