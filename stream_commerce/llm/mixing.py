"""Mixing to target weights with soft domain membership.

1. A labelled table gives the domain of some documents. Hashed character trigrams are counted per
   domain over all of them (distributed sums), which makes a multinomial model; a document's domain
   posteriors are the softmax of its mean log-likelihood per trigram, sharpened by `SHARPNESS`.
2. Every document i gets a rate r_i >= 0. With token counts t_i and posteriors p_ik the expected tokens
   of domain k are T_k = sum_i r_i t_i p_ik. Projected gradient descent minimises
       sum_k (T_k / B - w_k)^2 / s_k + RIDGE * sum_i t_i / B * (r_i - 1)^2
   with B all tokens, w the target weights and s the shares at rate 1. A step for a document needs only
   the K totals of the step before, so a pass over (t, p) replays the steps so far from the list of
   totals: no per-document state is kept, nothing but K sums per pass reaches the driver.
3. A rate becomes whole copies: its floor, and one more with the probability of its fraction, decided by
   a hash of the document.

Defined cases: null and empty texts have no tokens, even posteriors and rate 1; a document may repeat;
labels without document or domain count nothing; without labels, tokens or domains of weight every
rate is 1; targets are normalised, domains without a target get weight 0; other columns are kept
unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stream_commerce.llm.shared import saved, texts, tidy

BUCKETS = 4096
SHARPNESS = 40.0
RIDGE = 1e-3
STEPS = 40
TOLERANCE = 1e-4


def trigrams(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """(counts of hashed character trigrams, words) of a text, without case."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) < 3:
        return np.zeros(buckets), len(text.split())
    wide = data.astype(np.uint32)
    hashed = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77) ^ wide[2:] * np.uint32(0xC2B2AE3D))
    hashed = (hashed * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    words = int(np.count_nonzero(~space[1:] & space[:-1])) + int(not space[0])
    return np.bincount(hashed % buckets, minlength=buckets), words


def _domain_counts(buckets: int):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for frame in frames:
            for domain, text in zip(frame["domain"], frame["text"], strict=True):
                counts, _ = trigrams(text, buckets)
                total[domain] = total.get(domain, 0) + counts
        for domain, counts in total.items():
            bucket = np.flatnonzero(counts)
            yield pd.DataFrame({"domain": domain, "bucket": bucket, "n": counts[bucket].astype(np.int64)})

    return run


class Classifier:
    def __init__(self, domains: list[str], log: np.ndarray, sharpness: float = SHARPNESS):
        self.domains, self.log, self.sharpness = domains, log, sharpness

    def posterior(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        if not total:
            return np.full(len(self.domains), 1 / len(self.domains))
        mean = self.log @ counts / total * self.sharpness
        odds = np.exp(mean - mean.max())
        return odds / odds.sum()


def train(labelled: DataFrame, buckets: int = BUCKETS) -> Classifier:
    """From (domain, text); domains times buckets counts reach the driver."""
    sums = labelled.filter("domain is not null and text is not null").select("domain", "text").mapInPandas(
        _domain_counts(buckets), "domain string, bucket long, n long").groupBy("domain", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    domains = sorted(sums["domain"].unique())
    counts = np.ones((len(domains), buckets))
    for i, domain in enumerate(domains):
        own = sums[sums["domain"] == domain]
        counts[i, own["bucket"].to_numpy(np.int64)] += own["n"].to_numpy(np.float64)
    return Classifier(domains, np.log(counts / counts.sum(1, keepdims=True)) if len(domains) else counts)


def _classify(model: Classifier):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tokens, posteriors = [], []
            for text in frame["text"]:
                counts, words = trigrams(text, model.log.shape[1])
                tokens.append(words)
                posteriors.append(model.posterior(counts))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "mark": frame["mark"], "n_tokens": tokens, "posterior": posteriors})

    return run


def posteriors(documents: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, n_tokens, posterior); mark is a hash of the text, for rows that share an id."""
    rows = texts(documents, id_col, text_col).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return rows.mapInPandas(_classify(model), "doc_id long, mark long, n_tokens long, posterior array<double>")


class Fit:
    """Target weights, shares at rate 1, and the totals of each step so far."""

    def __init__(self, weights: np.ndarray, shares: np.ndarray, ridge: float = RIDGE):
        self.weights, self.shares, self.ridge = weights, shares, ridge
        self.totals: list[np.ndarray] = []

    def rates(self, p: np.ndarray) -> np.ndarray:
        """Rates after the steps so far: the same few sums for every document."""
        r = np.ones(len(p))
        for total in self.totals:
            slope = p @ ((total - self.weights) / self.shares) + self.ridge * (r - 1)
            r = np.maximum(0, r - slope)
        return r


def _totals(fit: Fit):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(fit.weights))
        for frame in frames:
            if len(frame):
                p, t = np.stack(frame["posterior"].to_numpy()), frame["n_tokens"].to_numpy(np.float64)
                total += (fit.rates(p) * t) @ p
        yield pd.DataFrame({"domain": np.arange(len(total)), "tokens": total})

    return run


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float] | float, steps: int = STEPS,
              tolerance: float = TOLERANCE, ridge: float = RIDGE) -> Fit | None:
    """The fit over (n_tokens, posterior), or None where every rate stays 1.

    `targets` are weights by domain, or an exponent that flattens the shares the documents have.
    """
    k = len(domains)

    def summed(fit: Fit) -> np.ndarray:
        out = np.zeros(k)
        for x in rows.select("n_tokens", "posterior").mapInPandas(
                _totals(fit), "domain int, tokens double").groupBy("domain").agg(F.sum("tokens").alias("tokens")).collect():
            out[x["domain"]] = x["tokens"]
        return out

    if not k:
        return None
    base = summed(Fit(np.ones(k), np.ones(k)))
    budget = base.sum()
    weights = (base / budget) ** targets if budget and not isinstance(targets, dict) else np.array(
        [max(0.0, targets.get(x, 0.0)) for x in domains] if isinstance(targets, dict) else np.zeros(k))
    if not budget or not weights.sum():
        return None
    fit = Fit(weights / weights.sum(), np.maximum(base / budget, 1e-9), ridge)
    total = base / budget
    for _ in range(steps):
        if np.abs(total - fit.weights).max() <= tolerance:
            break
        fit.totals.append(total)
        total = summed(fit) / budget
    return fit


def _rated(fit: Fit | None, domains: list[str]):
    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["doc_id", "mark", "n_tokens"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            if fit is None or not len(frame):
                best, p, rates = [None] * len(frame), 1.0, 1.0
            else:
                all_p = np.stack(frame["posterior"].to_numpy())
                top = all_p.argmax(1)
                best, p, rates = [domains[i] for i in top], all_p.max(1), fit.rates(all_p)
                rates = np.where(frame["n_tokens"] > 0, rates, 1.0)
            yield out.assign(domain=best, p=p, rate=rates)

    return run


def _copies(rate: Column, mark: Column, doc_id: Column) -> Column:
    chance = F.xxhash64(doc_id, mark, F.lit("copies")).bitwiseAND(F.lit(0xFFFFFFFF)) / float(1 << 32)
    return F.floor(rate + chance).cast("int")


def _fitted(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | float, id_col: str, text_col: str,
            **options) -> tuple[Classifier, Fit | None, DataFrame]:
    model = train(labelled)
    if model.domains:
        rows = posteriors(documents, model, id_col, text_col)
    else:
        rows = texts(documents, id_col, text_col).select(
            "doc_id", F.xxhash64("text").alias("mark"), F.lit(0).cast("long").alias("n_tokens"),
            F.array().cast("array<double>").alias("posterior"))
    rows = saved(rows, "posteriors")
    return model, fit_rates(rows, model.domains, targets, **options), rows


def rates(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | float, id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """(doc_id, mark, n_tokens, domain, p, rate, copies) for every document.

    `labelled` has (domain, text). domain and p are the likeliest domain and its posterior.
    """
    model, fit, rows = _fitted(documents, labelled, targets, id_col, text_col, **options)
    rated = rows.mapInPandas(
        _rated(fit, model.domains), "doc_id long, mark long, n_tokens long, domain string, p double, rate double")
    return rated.withColumn("copies", _copies(F.col("rate"), F.col("mark"), F.col("doc_id")))


def mixed(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | float, id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """The documents, each as often as its copies, with all their columns.

    A text is classified again where it stands instead of joining rates to it, which would shuffle
    all texts.
    """
    model, fit, _ = _fitted(documents, labelled, targets, id_col, text_col, **options)
    if fit is None:
        return documents
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            words, own = np.zeros(len(part), np.int64), np.zeros((len(part), len(model.domains)))
            for i, x in enumerate(part):  # counts of one text at a time
                counts, words[i] = trigrams(x, model.log.shape[1])
                own[i] = model.posterior(counts)
            yield pd.Series(np.where(words > 0, fit.rates(own), 1.0))

    names = documents.columns
    copies = _copies(rate(text), F.xxhash64(text), F.col(id_col).cast("long"))
    found = documents.select(F.struct(*names).alias("row"), F.array_repeat(F.lit(0), copies).alias("copies"))
    return found.select("row", F.explode("copies")).select("row.*")
