"""Token ids in files coded by a static range asymmetric numeral system (rANS).

Layout below one folder:
  frequencies/  token, freq: the shared table, summing to 2^20
  blocks/shard=S/  one row per block: first (tokens of the shard before it), doc_ids, lengths,
      lanes, states, marks, words, crc32

A block holds whole documents. Its ids are dealt over interleaved lanes (id i to lane i mod lanes),
each a rANS state in [2^31, 2^63) that takes 32-bit words from one shared list, so a step codes one
id per lane at once. A block decodes on its own; `marks` and the states of each 256th step are
checkpoints from which a part of a block can be decoded alone; crc32 covers the block's ids. Shards
hold ascending ranges of doc_id; (shard, first) orders all blocks.

Frequencies are counted over all ids. Reading back checks every block's checksum.

Defined cases: a null text is empty and yields the end id only; rows that repeat a doc_id are written
next to each other, ordered by text; a null doc_id comes first; an empty table gives empty files.
Ids must be below 2^32 and at most 2^20 of them distinct.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stream_commerce.config import new_work_dir
from stream_commerce.llm.shared import saved, texts, tidy

BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 19
MARK_STEPS = 256
CACHE_PIECES = 200_000
_LOW = np.uint64(1 << 31)
_PIECE = re.compile(r"\s*\S+|\s+")
_SIGNS = ".,;:!?"
# A line break that comes before such a piece stays a token of its own.
_WORD = re.compile(r" ?\S+")
# Python counts these as white space, the tokenizer's pattern does not.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_caches: dict[str, tuple[object, dict[str, bytes]]] = {}


class Encoder:
    """Ids of a text as uint32 bytes, with a bounded memory of pieces seen before.

    The tokenizer never joins a character to white space that follows it, so a text is the
    concatenation of its pieces (white space and what follows), each coded once.
    """

    def __init__(self, path: str):
        # Spark gives each core a task; the library's own threads would contend for the same cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path not in _caches:
            from tokenizers import Tokenizer

            _caches[path] = Tokenizer.from_file(path), {}
        self.tokenizer, self.known = _caches[path]
        self.signs = dict(zip(_SIGNS, self._code(list(_SIGNS)), strict=True))
        self.line_break = self._ids(["\n"])[0]

    def _ids(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _code(self, pieces: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self._ids(pieces)]

    def _code_words(self, words: list[str]) -> list[bytes]:
        """The same for pieces without white space but one space in front, as lines of one text: the library
        takes longer to begin a text than to code a word."""
        if len(words) < 2 or len(self.line_break) != 1:
            return self._code(words)
        ids = self._ids(["\n".join(words) + "\n"])[0]
        ends = np.flatnonzero(ids == self.line_break[0])
        if len(ends) != len(words):
            return self._code(words)
        data, begin, found = ids.tobytes(), 0, []
        for end in ends.tolist():
            found.append(data[4 * begin:4 * end])
            begin = end + 1
        return found

    def __call__(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self._code([text])[0]
        pieces = _PIECE.findall(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            self._fill(pieces, found)
        return b"".join(found)

    def _fill(self, pieces: list[str], found: list[bytes | None]) -> None:
        """Code what is not known. A sign behind letters is coded apart, so that words are known with
        any sign; a full memory keeps the pieces that came first, the frequent ones."""
        known = self.known
        gaps: list[tuple[int, str, bytes]] = []
        for i, code in enumerate(found):
            if code is None:
                piece, sign = pieces[i], b""
                if piece[-1] in _SIGNS and piece[:-1].lstrip().isalpha():
                    piece, sign = piece[:-1], self.signs[piece[-1]]
                    code = known.get(piece)
                if code is None:
                    gaps.append((i, piece, sign))
                else:
                    found[i] = code + sign
        new = list({piece for _, piece, _ in gaps})
        if not new:
            return
        words = [x for x in new if _WORD.fullmatch(x)]
        own = dict(zip(words, self._code_words(words), strict=True))
        rest = [x for x in new if x not in own]
        if rest:
            own.update(zip(rest, self._code(rest), strict=True))
        for i, piece, sign in gaps:
            found[i] = own[piece] + sign
        if len(known) < CACHE_PIECES:
            known.update(x for x in own.items() if len(x[0]) < 64)


def _tokenise(path: str, end_id: int):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        shard, offset = TaskContext.get().partitionId(), 0
        try:
            for frame in (f[i:i + 500] for f in frames for i in range(0, len(f), 500)):
                ids = [encode(x) + end for x in frame["text"]]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                yield pd.DataFrame({
                    "shard": shard, "doc_id": frame["doc_id"].astype("Int64"),
                    "first": offset + np.cumsum(sizes) - sizes, "n_tokens": sizes, "ids": ids})
                offset += int(sizes.sum())
        finally:
            _caches.clear()  # the worker lives on, for other stages

    return run


def tokenise(documents: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, doc_id, first, n_tokens, ids): ids of whole texts; shards are ascending id ranges."""
    rows = texts(documents, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return rows.mapInPandas(_tokenise(path, end_id), "shard int, doc_id long, first long, n_tokens long, ids binary")


@tidy
def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(0, np.int64)
    for frame in frames:
        for at in range(0, len(frame), 500):  # counting widens the ids
            ids = np.frombuffer(b"".join(frame["ids"].iloc[at:at + 500]), "<u4")
            seen = np.bincount(ids, minlength=len(total))
            seen[: len(total)] += total
            total = seen
    token = np.flatnonzero(total)
    yield pd.DataFrame({"token": token, "n": total[token]})


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whole frequencies of at least one for each counted symbol, summing to 2^bits."""
    size = 1 << bits
    if len(counts) > size:
        raise ValueError(f"more than {size} different ids")
    share = counts / max(counts.sum(), 1) * (size - len(counts))
    freq = 1 + np.floor(share).astype(np.int64)
    if len(freq):
        rest = size - int(freq.sum())
        freq[np.argsort(-(share - np.floor(share)), kind="stable")[:rest]] += 1
    return freq


class Table:
    """Lookup arrays of the shared frequencies."""

    def __init__(self, token: np.ndarray, freq: np.ndarray):
        self.token = np.asarray(token, np.uint32)
        self.freq = np.asarray(freq, np.uint64)
        self.start = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.place = np.zeros(int(self.token.max()) + 1 if len(token) else 1, np.uint32)
        self.place[self.token] = np.arange(len(token))
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        """Symbol of each slot."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.token), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES) -> dict:
    lanes = int(np.clip(len(ids) // 64, 1, lanes))
    place = table.place[ids]
    freq, start = table.freq[place], table.start[place]
    state = np.full(lanes, _LOW)
    steps = -(-len(ids) // lanes)
    words, sizes, states = [], np.zeros(steps + 1, np.int64), {}
    top, bits = np.uint64(63 - BITS), np.uint64(BITS)
    for step in range(steps - 1, -1, -1):
        f, c = freq[step * lanes:(step + 1) * lanes], start[step * lanes:(step + 1) * lanes]
        x = state[: len(f)]
        full = np.flatnonzero(x >= f << top)
        if len(full):
            words.append(x[full].astype(np.uint32))
            x[full] >>= np.uint64(32)
        sizes[step + 1] = len(full)
        quotient = x // f
        x[:] = (quotient << bits) + (x - quotient * f) + c
        if step % MARK_STEPS == 0:
            states[step] = state.copy()
    marks = np.cumsum(sizes)[0:steps:MARK_STEPS]
    kept = [states[s] for s in sorted(states)]
    return {
        "lanes": lanes, "states": (np.concatenate(kept) if kept else state[:0]).tobytes(),
        "marks": [int(m) for m in marks], "words": (np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)).tobytes(),
        "crc32": zlib.crc32(ids.astype("<u4").tobytes()),
    }


def decode_part(n: int, mark: int, lanes: int, states: bytes, marks: list[int], words: bytes, table: Table) -> np.ndarray:
    """Ids from checkpoint `mark` to the next one, of a block of n ids."""
    state = np.frombuffer(states, np.uint64).reshape(-1, lanes)[mark].copy()
    words_, at = np.frombuffer(words, np.uint32), int(marks[mark])
    first = mark * MARK_STEPS * lanes
    out = np.empty(min(n, first + MARK_STEPS * lanes) - first, np.uint32)
    low, bits, mask = _LOW, np.uint64(BITS), np.uint64((1 << BITS) - 1)
    slots, freq, start = table.slots, table.freq, table.start
    for at_id in range(0, len(out), lanes):
        x = state[: min(lanes, len(out) - at_id)]
        slot = x & mask
        place = slots[slot]
        out[at_id:at_id + len(x)] = place
        x[:] = freq[place] * (x >> bits) + slot - start[place]
        short = np.flatnonzero(x < low)
        if len(short):
            x[short] = (x[short] << np.uint64(32)) | words_[at:at + len(short)]
            at += len(short)
    return table.token[out]


def decode_block(n: int, lanes: int, states: bytes, marks: list[int], words: bytes, crc32: int, table: Table) -> np.ndarray:
    parts = [decode_part(n, i, lanes, states, marks, words, table) for i in range(len(marks))]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc32:
        raise ValueError("a block does not match its checksum")
    return ids


BLOCK = ("shard int, first long, doc_ids array<long>, lengths array<long>, lanes int, states binary, "
         "marks array<long>, words binary, crc32 long")


def _blocks(token: np.ndarray, freq: np.ndarray):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(token, freq)
        held: list[tuple] = []
        size = 0

        def block() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(x[4] for x in held), "<u4")
            return pd.DataFrame([{
                "shard": held[0][0], "first": held[0][2], "doc_ids": [x[1] for x in held],
                "lengths": [x[3] for x in held], **encode_block(ids, table)}])

        for frame in frames:
            doc_ids = [None if pd.isna(x) else int(x) for x in frame["doc_id"]]
            for row in zip(frame["shard"], doc_ids, frame["first"], frame["n_tokens"], frame["ids"], strict=True):
                follows = held and row[0] == held[-1][0] and row[2] == held[-1][2] + held[-1][3]
                if held and (not follows or size >= BLOCK_TOKENS):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row[3]
        if held:
            yield block()

    return run


def write(documents: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, each with `end_id` after it, into files below `folder`."""
    spark = documents.sparkSession
    ids_folder = new_work_dir(spark, "token-ids")
    rows = tokenise(documents, path, end_id, id_col, text_col)
    rows.write.option("compression", "zstd").parquet(ids_folder)
    ids = spark.read.schema(rows.schema).parquet(ids_folder)
    # One row per different id, so at most the size of the vocabulary.
    counts = ids.select("ids").mapInPandas(_counts, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")).orderBy("token").toPandas()
    token = counts["token"].to_numpy(np.int64)
    freq = scaled(counts["n"].to_numpy(np.int64))
    spark.createDataFrame(pd.DataFrame({"token": token, "freq": freq}), "token long, freq long").coalesce(1).write.parquet(
        f"{folder}/frequencies")
    blocks = ids.mapInPandas(_blocks(token, freq), BLOCK)
    blocks.write.option("compression", "uncompressed").partitionBy("shard").parquet(f"{folder}/blocks")


def _decoded(token: np.ndarray, freq: np.ndarray, digest: bool):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(token, freq)
        for frame in frames:
            for b in frame.itertuples(index=False):
                lengths = np.asarray(b.lengths, np.int64)
                ids = decode_block(int(lengths.sum()), b.lanes, b.states, list(b.marks), b.words, b.crc32, table)
                ends = np.cumsum(lengths)
                data = ids.astype("<u4").tobytes()
                each = (data[4 * (e - n):4 * e] for e, n in zip(ends, lengths, strict=True))
                own = {"ids_crc32": [zlib.crc32(x) for x in each]} if digest else {"ids": list(each)}
                yield pd.DataFrame({
                    "shard": b.shard, "doc_id": pd.array(b.doc_ids, "Int64"), "first": b.first + ends - lengths,
                    "n_tokens": lengths, **own})

    return run


def _read(spark: SparkSession, folder: str, digest: bool) -> DataFrame:
    table = spark.read.parquet(f"{folder}/frequencies").orderBy("token").toPandas()
    blocks = spark.read.schema(BLOCK).parquet(f"{folder}/blocks").select(*[x.split()[0] for x in BLOCK.split(", ")])
    return blocks.mapInPandas(
        _decoded(table["token"].to_numpy(np.int64), table["freq"].to_numpy(np.int64), digest),
        "shard int, doc_id long, first long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, doc_id, first, n_tokens, ids) from the files, blocks decoded in parallel."""
    return _read(spark, folder, digest=False)


def summary(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files; start counts the ids of all documents before.

    Positions in a shard become positions in the corpus by one total per shard. Ids are digested where
    they are decoded, so one Python worker a task holds them.
    """
    digests = saved(_read(spark, folder, digest=True), "token-digests")
    totals = digests.groupBy("shard").agg(F.sum("n_tokens").alias("total")).orderBy("shard").collect()
    before, bases = 0, []
    for row in totals:
        bases.append((row["shard"], before))
        before += row["total"]
    base = spark.createDataFrame(bases, "shard int, base long")
    return digests.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
