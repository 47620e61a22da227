"""Near-duplicate documents by SimHash fingerprints in a Gray-ordered hierarchical index.

A fingerprint has 64 bits: bit i is set if it is set in over half of the hashes of the text's word
shingles (repeats count). Two fingerprints link if at most two bits differ.

Equal fingerprints are one node. The upper nodes of the index are shared masked patterns: the bits are
cut into three parts, and fingerprints with at most two different bits agree in all bits of one of them,
so a node is (mask, masked bits) and every fingerprint lies under three. A node with more than `LIMIT`
fingerprints is cut again by the parts of its free bits, until all are small, so none grows with a hot
pattern. Below such a node fingerprints stand in the order of their Gray rank, neighbours differing
little. Runs of them form nodes that hold the bits all members agree in; a pair of nodes is dropped with
all pairs below it as soon as the differences known so far exceed the bound, each bit being compared
once, at the highest nodes that know it.

Each group returns a spanning forest of its links, at most one edge per member, so dense families do not
become all their pairs. The edges are contracted to components by joins.

Defined cases: a null or word-free text has the fingerprint 0 and is linked like any other; a text with
fewer words than a shingle is one shingle; rows that share a doc_id are one node; a row without doc_id gets
the smallest doc_id of its component, or null if nobody in it has one; an empty table gives an empty
result; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stream_commerce.llm.components import components
from stream_commerce.llm.shared import saved, texts

SIZE = 3
DISTANCE = 2
SEED = 42
BITS = 64
LIMIT = 20_000
FANOUT = 8
#: Nodes with so few free bits are not cut: they have at most 2^FREE fingerprints.
FREE = 13
_RUN = 1 << 16
_PAIRS = 1 << 15
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, size: int = SIZE) -> int:
    """Majority bits of the XXH64 hashes of all runs of `size` words, A-Z counting as a-z."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = (np.cumsum([len(x) + 1 for x in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    width = min(size, len(words))
    ones = np.zeros(BITS, np.int64)
    spans = list(zip(starts, ends[width - 1:], strict=False))
    for at in range(0, len(spans), _RUN):
        h = np.array([xxh64_intdigest(plain[s:e], SEED) for s, e in spans[at:at + _RUN]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans), bitorder="little").tobytes(), "little")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _prints(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = np.array([fingerprint(x, size) for x in frame["text"]], np.uint64)
            order = gray_rank(own) ^ np.uint64(1 << 63)  # so that signed numbers keep the order
            yield pd.DataFrame({"doc_id": frame["doc_id"], "print": own.view(np.int64), "gray": order.view(np.int64)})

    return run


def fingerprints(documents: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print, gray): fingerprint and Gray rank of every whole text, as signed longs."""
    return texts(documents, id_col, text_col).mapInPandas(_prints(size), "doc_id long, print long, gray long")


class Level:
    """Nodes of one height: the bits their members agree in, these bits' pattern, and their children."""

    def __init__(self, every: np.ndarray, some: np.ndarray, group: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.every, self.some, self.group, self.first, self.last = every, some, group, first, last
        self.mask = ~(every ^ some)


def build(prints: np.ndarray, group: np.ndarray) -> list[Level]:
    """Heights of the index over fingerprints sorted by (group, Gray rank), leaves first; a node never
    holds members of two groups, and each group has one node at the top."""
    leaf = np.arange(len(prints))
    levels = [Level(prints, prints, group, leaf, leaf + 1)]
    while True:
        now = levels[-1]
        begins = np.flatnonzero(np.concatenate(([True], now.group[1:] != now.group[:-1])))
        if len(begins) == len(now.group):
            return levels
        size = np.diff(np.concatenate((begins, [len(now.group)])))
        place = np.arange(len(now.group)) - np.repeat(begins, size)
        first = np.flatnonzero(place % FANOUT == 0)
        last = np.concatenate((first[1:], [len(now.group)]))
        levels.append(Level(np.bitwise_and.reduceat(now.every, first), np.bitwise_or.reduceat(now.some, first),
                            now.group[first], first, last))


def close_pairs(levels: list[Level], distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of leaves of one group with at most `distance` different bits, in blocks."""
    top = len(levels) - 1
    roots = np.arange(len(levels[top].group))
    none = np.zeros(len(roots), np.uint64)
    todo = [(top, roots, roots, np.zeros(len(roots), np.int64), none)]
    while todo:
        height, u, v, differ, known = todo.pop()
        if len(u) > _PAIRS:
            todo += [(height, *(x[at:at + _PAIRS] for x in (u, v, differ, known))) for at in range(0, len(u), _PAIRS)]
            continue
        if height == 0:
            yield u, v
            continue
        own, below = levels[height], levels[height - 1]
        n_u, n_v = own.last[u] - own.first[u], own.last[v] - own.first[v]
        size = n_u * n_v
        pair = np.repeat(np.arange(len(u)), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        i = own.first[u][pair] + k // n_v[pair]
        j = own.first[v][pair] + k % n_v[pair]
        # A node meets itself only to open; at the leaves a fingerprint does not meet itself.
        keep = np.flatnonzero(i < j if height == 1 else i <= j)
        i, j, pair = i[keep], j[keep], pair[keep]
        both = below.mask[i] & below.mask[j]
        fresh = (below.every[i] ^ below.every[j]) & both & ~known[pair]
        total = differ[pair] + np.bitwise_count(fresh)
        keep = np.flatnonzero(total <= distance)
        if len(keep):
            todo.append((height - 1, i[keep], j[keep], total[keep], (known[pair] | both)[keep]))


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the members of every pair one label, the smallest; a label is its own label."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _forest(prints: np.ndarray, node: np.ndarray, group: np.ndarray, distance: int) -> pd.DataFrame:
    label = np.arange(len(prints))
    if len(prints):
        for i, j in close_pairs(build(prints, group), distance):
            join_labels(label, i, j)
    linked = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"u": node[linked], "v": node[label[linked]]})


def _links(distance: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size < LIMIT:
                continue
            # All groups but the last are whole.
            joined = pd.concat(held, ignore_index=True)
            starts = _starts(joined)
            cut = int(starts[-1])
            if cut:
                yield _linked_groups(joined.iloc[:cut], distance)
            held, size = [joined.iloc[cut:]], len(joined) - cut
        if size:
            yield _linked_groups(pd.concat(held, ignore_index=True), distance)

    return run


def _starts(frame: pd.DataFrame) -> np.ndarray:
    mask, value = frame["mask"].to_numpy(), frame["value"].to_numpy()
    return np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))))


def _linked_groups(frame: pd.DataFrame, distance: int) -> pd.DataFrame:
    starts = _starts(frame)
    size = np.diff(np.concatenate((starts, [len(frame)])))
    several = np.repeat(size > 1, size)
    group = np.repeat(np.arange(len(starts)), size)[several]
    return _forest(frame["print"].to_numpy()[several].view(np.uint64), frame["node"].to_numpy()[several], group, distance)


def parts(mask: int, count: int) -> list[int]:
    """The mask with one of `count` even parts of its free bits added, for each part."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * k // count for k in range(count + 1)]
    return [mask | sum(1 << b for b in free[s:e]) for s, e in zip(cuts, cuts[1:], strict=False)]


def _long(x: int) -> Column:
    """64 bits as a signed long."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def _below(rows: DataFrame, masks: list[int], count: int) -> DataFrame:
    """Every row under each of the nodes that cut its own node's free bits into parts."""
    finer = F.create_map(*[x for m in masks for x in (
        _long(m), F.array(*[_long(p) for p in parts(m, count)]))])
    return rows.select("print", "gray", "node", F.explode(finer[F.col("mask")]).alias("mask")).withColumn(
        "value", F.col("print").bitwiseAND(F.col("mask")))


def links(nodes: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """Edges (u, v) between nodes (print, gray, node) with different fingerprints, enough to connect all
    that are linked."""
    count = distance + 1
    masks = [0]
    wide = nodes.withColumn("mask", F.lit(0).cast("long"))
    ready = None
    while True:
        wide = _below(wide, masks, count)
        masks = sorted({p for m in masks for p in parts(m, count)})
        big = saved(wide.groupBy("mask", "value").count().filter(F.col("count") > limit).select(
            F.col("mask").alias("m"), F.col("value").alias("w")), "hot-patterns")
        same = (F.col("mask") == F.col("m")) & (F.col("value") == F.col("w"))
        last = big.isEmpty() or all(BITS - m.bit_count() <= FREE for m in masks)
        small = wide if last else wide.join(big, same, "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        if last:
            break
        wide = saved(wide.join(big, same, "left_semi").select("print", "gray", "node", "mask"), "hot-prints")
    dealt = ready.repartition("mask", "value").sortWithinPartitions("mask", "value", "gray")
    return dealt.select("mask", "value", "print", "node").mapInPandas(_links(distance), "u long, v long")


def near_duplicates(
    documents: DataFrame, size: int = SIZE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = saved(fingerprints(documents, size, id_col, text_col), "fingerprints")
    classes = saved(rows.groupBy("print", "gray").agg(F.min("doc_id").alias("node")), "print-classes")
    named = classes.filter("node is not null")
    edges = links(named, distance, limit)
    # A doc_id with several fingerprints connects them.
    twice = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).filter(
        "low <> high").select(F.col("doc_id").alias("d"))
    own = classes.select(F.col("print").alias("p"), "node")
    several = rows.join(twice, F.col("doc_id") == F.col("d"), "left_semi").join(own, F.col("print") == F.col("p")).select(
        F.col("doc_id").alias("u"), F.col("node").alias("v"))
    found = components(edges.unionByName(several)).withColumnRenamed("node", "x")
    classed = own.join(found, F.col("node") == F.col("x"), "left").select("p", F.coalesce("component", "node").alias("component_id"))
    joined = rows.join(classed, F.col("print") == F.col("p"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
