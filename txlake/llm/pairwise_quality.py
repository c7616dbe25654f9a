"""Quality scores by Bradley-Terry pairwise ranking.

A document's utility is linear in its features. In a preference pair the first document is
better with probability sigmoid(difference of utilities), so the weights are found by
logistic loss on feature differences, without an intercept. The utility threshold is a
quantile of the utilities of all labelled documents: the share that is labelled bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.line_features import base_counts, line_table
from txlake.llm.text import text_slices
from txlake.llm.working import stored

FOLDS = 5
SCORE_THRESHOLD = 0.3
TRAINING_DOCS = 5000
PAIRS = 40_000
#: Ranks of the threshold are exact for fewer labelled documents than this.
RANKS = 1_000_000

COLUMNS = "doc_id bigint, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Ranking:
    """Utility weights over standardised features, and the utility that scores ``at``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float
    at: float = SCORE_THRESHOLD

    def utility(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.scale @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        shifted = (self.utility(features) - self.threshold) / self.spread + np.log(self.at / (1 - self.at))
        return 1 / (1 + np.exp(-np.clip(shifted, -500, 500)))


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text; nothing but the text goes in."""
    n = len(offsets) - 1
    lines = line_table(data, offsets)
    counts = base_counts(data, offsets, lines)
    words = counts["n_words"]
    some = np.maximum(words, 1)
    by_line = np.stack(
        [
            np.bincount(lines.texts, weights=lines.n_words * column, minlength=n)[:n] / some
            for column in lines.features[:, 1:].T
        ],
        axis=1,
    )
    ratios = np.stack(
        [
            np.minimum(counts["n_symbols"] / some, 1),
            counts["n_repeat_words"] / some,
            counts["n_dup_lines"] / np.maximum(lines.n_lines, 1),
        ],
        axis=1,
    )
    length = np.log1p(words)
    steps = np.stack([words == 0, words < 10, words < 50, words < 200], axis=1)
    shares = np.concatenate([by_line, ratios], axis=1)
    return np.concatenate(
        [
            shares,
            shares > 0.05,
            shares > 0.3,
            steps,
            length[:, None],
            (counts["word_chars"] / some)[:, None].clip(0, 30),
        ],
        axis=1,
    ).astype(np.float64)


def fit_ranking(
    features: np.ndarray, quality: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3
) -> Ranking:
    """Learn from ``pairs`` preferences of a good over a bad document, by Newton steps.

    Without documents of both kinds all utilities are equal, above the threshold.
    """
    width = features.shape[1]
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), -1.0, 1.0)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale < 1e-9] = 1
    standard = (features - mean) / scale
    # Every document meets partners from all over the other side.
    count = max(pairs, len(good), len(bad))
    k = np.arange(count)
    winners = good[k % len(good)]
    losers = bad[(k + k // len(good) + k // len(bad)) % len(bad)]
    difference = standard[winners] - standard[losers]
    weights = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
        gradient = difference.T @ (1 - p) / count - ridge * weights
        curvature = (difference * (p * (1 - p))[:, None]).T @ difference / count
        step = np.linalg.solve(curvature + ridge * np.eye(width), gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    utility = standard @ weights
    # Quantile that leaves the labelled share of bad documents below, kinds weighed as found.
    ordered = np.sort(utility)
    cut = min(len(ordered) - 1, len(bad))
    threshold = float((ordered[max(0, cut - 1)] + ordered[cut]) / 2)
    spread = float(np.std(utility)) or 1.0
    return Ranking(mean, scale, weights, threshold, spread / 4)


def _fold(folds: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def train_ranking(
    docs: DataFrame,
    labels: DataFrame,
    training_docs: int = TRAINING_DOCS,
    folds: int = FOLDS,
) -> Ranking:
    """Learn from labelled documents outside fold 0 of crc32(doc_id as text) mod ``folds``.

    The weights come from at most ``training_docs`` documents, those whose id hashes
    smallest, so kinds keep their proportions; only their features come to the driver. The
    threshold comes from all labelled documents outside fold 0. A document counts once,
    however many rows have its id: with the least of their texts. Of conflicting labels of a
    document the smaller counts.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint"), "quality")
        .filter((_fold(folds) != 0) & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("bigint").alias("quality"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(training_docs)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                flat = text_features(data, offsets).astype("<f8")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([row.tobytes() for row in flat])],
                    names=["doc_id", "quality", "features"],
                )

    rows = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "quality")
        .mapInArrow(extract, "doc_id bigint, quality bigint, features binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    width = text_features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    features = np.array([np.frombuffer(r["features"], "<f8") for r in rows]).reshape(-1, width)
    ranking = fit_ranking(features, np.array([r["quality"] for r in rows]))
    return with_threshold(ranking, docs, known) if ranking.weights.any() else ranking


def with_threshold(ranking: Ranking, docs: DataFrame, known: DataFrame) -> Ranking:
    """Set threshold and spread by the utilities of all documents in ``known``.

    ``known`` has each ``doc_id`` once, with its ``quality``. Rows of one id count once, with
    the least utility.
    """

    def utilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, rows.stop - rows.start),
                        pa.array(ranking.utility(text_features(data, offsets))),
                    ],
                    names=["doc_id", "utility"],
                )

    found = stored(
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(utilities, "doc_id bigint, utility double")
        .groupBy("doc_id")
        .agg(F.min("utility").alias("utility"))
        .join(known, "doc_id"),
        "utilities",
    )
    count, bad, spread = found.agg(
        F.count(F.lit(1)), F.count_if(F.col("quality") == 0), F.stddev_pop("utility")
    ).first()
    cut = min(count - 1, bad)
    ranks = [(max(1, cut) - 0.5) / count, (cut + 0.5) / count]
    around = found.agg(F.percentile_approx("utility", ranks, RANKS)).first()[0]
    return replace(ranking, threshold=sum(around) / 2, spread=(spread or 1.0) / 4)


def score_quality(docs: DataFrame, ranking: Ranking, folds: int = FOLDS) -> DataFrame:
    """Score every row: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    A null text counts as empty and is scored as such. A null ``doc_id`` is in no fold and
    not held out. Repeated rows are scored each.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(2)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                scores = ranking.score(text_features(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(scores),
                        pa.array((scores >= ranking.at).astype(np.int32)),
                    ],
                    names=[c.split()[0] for c in COLUMNS.split(", ")],
                )

    return (
        docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
        .select("doc_id", F.coalesce(_fold(folds) == 0, F.lit(False)).alias("held_out"), "text")
        .mapInArrow(score, COLUMNS)
    )
