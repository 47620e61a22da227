"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: the ordinary one on pieces of ordinary text, the
toxic one on the windows of toxic text that many toxic texts and no ordinary text of the sample has; it is
used with the ordinary content behind it. A text is cut into
overlapping windows, each compressed with both: a window is shorter under the toxic dictionary exactly
where it has toxic pieces, as both know ordinary text alike and search it alike. What windows save (the
largest saving, the mean of the three largest, the mean, the root of the sum) is calibrated to a
probability by logistic regression, so 0.5 is the threshold.

Labels come from a bounded sample: at most `MAX_TOXIC` and `MAX_ORDINARY` labelled texts, those with
the smallest hash of their id. Two thirds make the dictionaries, the others the calibration. Scoring reads whole texts and nothing else of a row.

Defined cases: a null or empty text has no windows and gets the score of savings 0; labels that are
null, or ids that are, teach nothing; a document labelled both ways counts for both; without labels of
either kind every score is their share (0.5 without any); rows that repeat are scored alike; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stream_commerce.llm.shared import texts, tidy

WINDOW = 64
GRAM = 5
SHARE = 0.006
MAX_TOXIC = 2000
MAX_ORDINARY = 6000
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 2_048
#: COVER's segments of the toxic dictionary: about a word, told apart by runs of six bytes.
TOXIC_SEGMENTS = {"k": 12, "d": 6}
#: The trainer takes no shorter samples.
LEAST = 8
_BATCH = 1 << 20
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def _plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACES)


def _words(text: str) -> list[bytes]:
    return [b" " + x + b" " for x in _plain(text).split()]


def _grams(words: list[bytes]) -> set[bytes]:
    return {w[i:i + GRAM] for w in words for i in range(len(w) - GRAM + 1)}


def toxic_windows(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """What the toxic dictionary is trained on: the parts of toxic texts' words, with repeats, whose runs of
    `GRAM` bytes many toxic texts have and no ordinary one; short parts with what is around them in the word."""
    cut = [_words(x) for x in toxic]
    spread = Counter(g for words in cut for g in _grams(words))
    least = max(3, int(np.ceil(SHARE * len(toxic))))
    only = {g for g, n in spread.items() if n >= least}
    for text in ordinary:
        only -= _grams(_words(text))
    found = []
    for w in (w for words in cut for w in words):
        i = 0
        while i <= len(w) - GRAM:
            if w[i:i + GRAM] not in only:
                i += 1
                continue
            end = i + 1
            while w[end:end + GRAM] in only:
                end += 1
            end += GRAM - 1
            first = max(0, min(i, end - LEAST))
            found.append(w[first:max(end, first + LEAST)].ljust(LEAST))
            i = end
    return found


def ordinary_windows(ordinary: list[str]) -> list[bytes]:
    """What the ordinary dictionary is trained on: every fourth run of twelve words."""
    pieces = []
    for text in ordinary:
        words = _plain(text).split()
        pieces += [b" ".join(words[i:i + 12]) + b" " for i in range(0, len(words), 48)]
    return pieces


def trained(pieces: list[bytes], size: int, **choice: int) -> bytes:
    """A dictionary trained on the pieces, or the pieces themselves, the commonest last (nearest), where they
    are too few or too alike to train on."""
    try:
        return zstandard.train_dictionary(size, pieces, **choice).as_bytes()
    except zstandard.ZstdError:
        common = sorted(Counter(pieces).items(), key=lambda x: (x[1], x[0]))
        return b"".join(x for x, _ in common)[-size:]


class Dictionaries:
    """The two dictionaries; savings of windows."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic, ordinary
        # Fixed tables and an exhaustive enough search, so that both dictionaries find the same
        # ordinary matches; shorter matches than a gram never count.
        params = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=16, hash_log=17, search_log=6, min_match=GRAM, target_length=64,
            strategy=zstandard.STRATEGY_LAZY2, write_content_size=0, write_dict_id=0, write_checksum=0)
        self.coders = []
        for content in (ordinary, toxic + ordinary):
            known = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=params)
            self.coders.append(zstandard.ZstdCompressor(dict_data=known, compression_params=params))

    def savings(self, data: bytes, places: np.ndarray) -> np.ndarray:
        sizes = []
        for coder in self.coders:
            packed = coder.multi_compress_to_buffer(zstandard.BufferWithSegments(data, places.tobytes()))
            sizes.append(np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed)))
        return sizes[0] - sizes[1]


def windows(size: int) -> np.ndarray:
    """(start, length) of windows that overlap by half and cover the whole text."""
    if size <= WINDOW:
        return np.array([[0, size]] if size else np.empty((0, 2)), np.uint64)
    starts = np.append(np.arange(0, size - WINDOW, WINDOW // 2), size - WINDOW)
    return np.column_stack((starts, np.full(len(starts), WINDOW))).astype(np.uint64)


def features(saved: np.ndarray) -> np.ndarray:
    if not len(saved):
        return np.zeros(4)
    top = np.sort(saved)[-3:]
    return np.array([top[-1], top.sum() / 3, saved.mean(), np.sqrt(np.maximum(saved, 0).sum())])


def text_features(series: pd.Series, known: Dictionaries) -> np.ndarray:
    out = np.zeros((len(series), 4))
    held: list[tuple[int, bytes]] = []

    def flush() -> None:
        places = [windows(len(x)) for _, x in held]
        at = 0
        for (_, x), place in zip(held, places, strict=True):
            place[:, 0] += np.uint64(at)
            at += len(x)
        if at:
            saved = known.savings(b"".join(x for _, x in held), np.concatenate(places))
            for (row, _), part in zip(held, np.split(saved, np.cumsum([len(x) for x in places])[:-1]), strict=True):
                out[row] = features(part)

    room = 0
    for row, text in enumerate(series):
        data = _plain(text)
        held.append((row, data))
        room += len(data)
        if room >= _BATCH:
            flush()
            held, room = [], 0
    flush()
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients (intercept first) by Newton steps with a small ridge."""
    x = np.column_stack((np.ones(len(x)), x))
    ridge = np.diag([1e-6] + [1e-3] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    def __init__(self, known: Dictionaries | None, beta: np.ndarray, share: float):
        self.known, self.beta, self.share = known, beta, share

    def __reduce__(self):
        # Compressors stay where they are made; tasks make their own from the contents.
        content = (self.known.toxic, self.known.ordinary) if self.known else None
        return _restored, (content, self.beta, self.share)

    def scores(self, series: pd.Series) -> np.ndarray:
        if self.known is None:
            return np.full(len(series), self.share)
        x = text_features(series, self.known)
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + x @ self.beta[1:], -30, 30)))


def _restored(content, beta, share) -> Model:
    return Model(Dictionaries(*content) if content else None, beta, share)


def _measure(toxic: bytes, ordinary: bytes):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Dictionaries(toxic, ordinary)
        for frame in frames:
            yield pd.DataFrame({"toxic": frame["toxic"], "x": list(text_features(frame["text"], known))})

    return run


def held_out(doc_id) -> F.Column:
    """Every fifth document by a hash of its id: never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> Model:
    """From `labels` (doc_id, toxic) of documents that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("label_id")))
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    if len(counts) < 2:
        return Model(None, np.zeros(5), share)
    order = (F.xxhash64("label_id"), "label_id")
    ids = usable.filter("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(
        usable.filter("toxic = 0").orderBy(*order).limit(max_ordinary))
    # At most max_toxic + max_ordinary ids.
    sample = texts(documents).join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).select(
        "toxic", "text", (F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(3)) == 0).alias("fitted"))
    # In a fixed order, since the trainer's choice depends on it.
    rows = sample.toPandas().sort_values(["toxic", "text"], kind="stable")
    apart = rows["fitted"] if set(rows.loc[rows["fitted"], "toxic"]) == set(rows.loc[~rows["fitted"], "toxic"]) == {0, 1} else None
    learnt = rows if apart is None else rows[~apart]
    toxic = learnt.loc[learnt["toxic"] == 1, "text"].tolist()
    ordinary = learnt.loc[learnt["toxic"] == 0, "text"].tolist()
    if not toxic or not ordinary:
        return Model(None, np.zeros(5), share)
    contents = (trained(toxic_windows(toxic, ordinary), TOXIC_BYTES, **TOXIC_SEGMENTS),
                trained(ordinary_windows(ordinary), ORDINARY_BYTES))
    measured = sample if apart is None else sample.filter("fitted")
    measured = measured.select("toxic", "text").repartition(16).mapInPandas(_measure(*contents), "toxic int, x array<double>").toPandas()
    y, x = measured["toxic"].to_numpy(np.float64), np.stack(measured["x"].to_numpy())
    order = np.lexsort((*x.T, y))  # sums in one order give one model, however the rows were dealt
    y, x = y[order], x[order]
    # Weighted back to the shares the labels have.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(Dictionaries(*contents), logistic(x, y, weight), share)


def _score(model: Model):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop(columns="text").assign(score=model.scores(frame["text"]))

    return run


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = texts(documents, id_col, text_col)
    scored = rows.mapInPandas(_score(model), "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows not predicted toxic, with all their columns; only texts go through Python."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model.scores(part.fillna("")))

    return documents.filter(scored(F.col(text_col).cast("string")) < 0.5)
