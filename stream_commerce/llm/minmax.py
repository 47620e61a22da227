"""Near-duplicate documents by min-max hashing.

Each document becomes the set of its word shingles (64-bit hashes). Every permutation (an odd
multiplier and an offset modulo 2^64) gives two signature values, the smallest and the largest
hash, so 48 evaluations give 96 values in 24 bands of four. At similarity 0.8 all bands miss with
probability (1 - 0.8^4)^24 < 4e-6. Equal sets are one class before banding; candidate pairs of a
band are confirmed on the full sets, and links are contracted to components.

Defined cases: a null or word-free text has an empty set and is linked with nothing; a text with
fewer words than a shingle is one shingle; rows that share a doc_id are one node; a row without
doc_id is kept and gets no component; other columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stream_commerce.llm.components import linked
from stream_commerce.llm.shared import saved, texts, tidy

PERMUTATIONS = 48
ROWS = 4
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(n, _STEP, np.uint64))
    down = np.cumprod(np.full(n, np.uint64(pow(int(_STEP), -1, 2**64)), np.uint64))
    return up, down


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power_tables(1 << max(12, (n - 1).bit_length()))
    return up[:n], down


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 data, in order; A-Z count as a-z."""
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    solid = np.concatenate(([False], ~_SPACE[raw], [False]))
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(raw))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * up, dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; fewer words are one run."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    out = np.full(count, np.uint64(width))
    for i in range(width):
        out = mix(out * _STEP + words[i:i + count])
    return np.unique(out)


def _sets(texts_: pd.Series, size: int) -> Iterator[np.ndarray]:
    """Shingle sets of the texts; words are hashed for runs of texts at once."""
    held: list[bytes] = []
    room = 0

    def flush() -> Iterator[np.ndarray]:
        joined = b"\n".join(held)
        words = word_hashes(joined)
        counts = [len(x.split()) for x in held]
        at = 0
        for n in counts:
            yield shingle_set(words[at:at + n], size)
            at += n

    for text in texts_:
        data = text.encode("utf-8", "surrogatepass")
        held.append(data)
        room += len(data)
        if room > _CHUNK:
            yield from flush()
            held, room = [], 0
    yield from flush()


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return (rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, count, dtype=np.uint64))


def signature(hashes: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minimum and maximum under each permutation, next to each other."""
    out = np.empty((permutations, 2), np.uint64)
    for i, (a, b) in enumerate(zip(*_permutations(permutations), strict=True)):
        seen = hashes * a + b
        seen ^= seen >> np.uint64(32)
        out[i] = seen.min(), seen.max()
    return out


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per band; a band never holds both values of one permutation."""
    flat = np.concatenate((values[:, 0], values[:, 1]))
    flat = flat[: len(flat) // rows * rows].reshape(-1, rows)
    key = np.arange(len(flat), dtype=np.uint64)
    for i in range(rows):
        key = mix(key * _STEP + flat[:, i])
    return key.view(np.int64)


def _features(size: int, permutations: int, rows: int):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n, digest, keys = [], [], []
            for hashes in _sets(frame["text"], size):
                n.append(len(hashes))
                digest.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                keys.append(bands(signature(hashes, permutations), rows) if len(hashes) else [])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_shingles": n, "digest": digest, "bands": keys})

    return run


def _set_rows(size: int):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({
                "node": frame["doc_id"], "held": [x.view(np.int64) for x in _sets(frame["text"], size)]})

    return run


def near_duplicates(
    documents: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
    text_col: str = "text", permutations: int = PERMUTATIONS, rows: int = ROWS,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * common >= percent * united shingles; component_id is the
    smallest doc_id that links reach, kept marks it. Of rows repeating a doc_id all are marked alike.
    """
    docs = texts(documents, id_col, text_col)
    features = saved(docs.mapInPandas(
        _features(size, permutations, rows),
        "doc_id long, n_shingles long, digest binary, bands array<long>"), "minmax")
    filled = features.filter("n_shingles > 0 and doc_id is not null")
    classes = saved(filled.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = filled.join(classes.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d"))
                       & (F.col("doc_id") == F.col("rep")), "left_semi")
    keys = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("node"))
    copies = filled.select("doc_id", "digest").join(classes, "digest").filter("doc_id <> rep").select(
        F.col("doc_id").alias("u"), F.col("rep").alias("v"))

    def sets(nodes: DataFrame) -> DataFrame:
        own = nodes.select(F.col("node").alias("doc_id"))
        return docs.join(own, "doc_id", "left_semi").mapInPandas(
            _set_rows(size), "node long, held array<long>")

    found = linked(keys, sets, percent, copies)
    result = features.join(found.withColumnRenamed("node", "x"), F.col("doc_id") == F.col("x"), "left")
    component = F.coalesce("component", "doc_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_first(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
               percent: int = 80) -> DataFrame:
    """The rows of one document per group, with all their columns."""
    gone = near_duplicates(documents, size, percent, id_col, text_col).filter("not kept").select(
        F.col("doc_id").alias("gone_id")).distinct()
    return documents.join(saved(gone, "near-copies"), F.col(id_col) == F.col("gone_id"), "left_anti")
