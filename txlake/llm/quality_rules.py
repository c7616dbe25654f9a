"""Quality rules: base rules on words, then line labelling with a conditional random field.

A linear-chain conditional random field labels every line content or boilerplate: each line
has features (how its words look, whether they repeat), each label weights for them, and
each pair of neighbouring labels a weight. Viterbi decoding finds the best label sequence;
a document is kept if enough of its words are in content lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.line_features import LINE_FEATURES, base_counts, line_table
from txlake.llm.text import text_slices

CONTENT_SHARE = 0.5
TRAINING_DOCS = 4000
#: Lines of a document that are learned from; 72 bytes each come to the driver.
TRAINING_DOC_LINES = 250
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COLUMNS = (
    "doc_id bigint, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
    + ", base_failed boolean, kept boolean, content_share double, n_content_lines bigint"
)


@dataclass(frozen=True)
class LineModel:
    """Weights of a two-label chain; label 1 is content.

    ``emission[f]`` is the weight of feature f for content (boilerplate has 0), ``change``
    the 2 x 2 weights of neighbouring labels (from, to), ``start`` those of a first line.
    """

    emission: np.ndarray
    change: np.ndarray
    start: np.ndarray


def _positions(n_lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For line 0, 1, ...: the texts that have it, and the row of that line in the table.

    Texts come in order of falling length, so those of a step are a prefix.
    """
    order = np.argsort(-n_lines, kind="stable")
    first = (np.cumsum(n_lines) - n_lines)[order]
    held = n_lines[order]
    step, alive = 0, int(np.count_nonzero(held))
    while alive:
        yield order[:alive], first[:alive] + step
        step += 1
        alive = int(np.searchsorted(-held, -step, side="left"))


def viterbi(scores: np.ndarray, n_lines: np.ndarray, model: LineModel) -> np.ndarray:
    """The best label of every line: 1 content, 0 boilerplate; ties go to content.

    ``scores`` are the emission scores of content, line after line, ``n_lines`` the number
    of lines of each text. All texts advance together, one line at a time.
    """
    labels = np.zeros(len(scores), np.int8)
    best = np.zeros((len(n_lines), 2))
    came: list[np.ndarray] = []
    steps = list(_positions(n_lines))
    for k, (texts, rows) in enumerate(steps):
        if k == 0:
            best[texts] = model.start
        else:
            through = best[texts][:, :, None] + model.change[None]
            back = (through[:, 1] >= through[:, 0]).astype(np.int8)
            came.append(back)
            best[texts] = through.max(axis=1)
        best[texts, 1] += scores[rows]
    state = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for k in range(len(steps) - 1, -1, -1):
        texts, rows = steps[k]
        labels[rows] = state[texts]
        if k:
            state[texts] = came[k - 1][np.arange(len(texts)), state[texts]]
    return labels


def _expected(
    scores: np.ndarray, n_lines: np.ndarray, model: LineModel
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: P(content) of each line, expected changes, expected first labels."""
    steps = list(_positions(n_lines))
    forward = np.zeros((len(scores), 2))
    backward = np.zeros((len(scores), 2))
    emitted = np.stack([np.zeros_like(scores), scores], axis=1)
    previous: np.ndarray | None = None
    for texts, rows in steps:
        if previous is None:
            forward[rows] = model.start + emitted[rows]
        else:
            through = forward[previous[: len(texts)]][:, :, None] + model.change[None]
            forward[rows] = np.logaddexp(through[:, 0], through[:, 1]) + emitted[rows]
        previous = rows
    changes = np.zeros((2, 2))
    for k in range(len(steps) - 1, 0, -1):
        rows, before = steps[k][1], steps[k - 1][1][: len(steps[k][1])]
        onward = model.change[None] + (emitted[rows] + backward[rows])[:, None, :]
        backward[before] = np.logaddexp(onward[:, :, 0], onward[:, :, 1])
    total = forward + backward
    log_z = np.logaddexp(total[:, 0], total[:, 1])
    content = np.exp(total[:, 1] - log_z)
    for k in range(1, len(steps)):
        rows, before = steps[k][1], steps[k - 1][1][: len(steps[k][1])]
        joint = (
            forward[before][:, :, None]
            + model.change[None]
            + (emitted[rows] + backward[rows])[:, None, :]
            - log_z[rows][:, None, None]
        )
        changes += np.exp(joint).sum(axis=0)
    first = steps[0][1] if steps else np.zeros(0, int)
    starts = np.array([np.sum(1 - content[first]), np.sum(content[first])])
    return content, changes, starts


def fit_lines(
    features: np.ndarray,
    labels: np.ndarray,
    n_lines: np.ndarray,
    rounds: int = 150,
    step: float = 0.3,
    ridge: float = 1e-3,
) -> LineModel:
    """Maximise the conditional likelihood of line labels, by gradient steps (Adam)."""
    n_features = features.shape[1]
    weights = np.zeros(n_features + 6)
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    first = (np.cumsum(n_lines) - n_lines)[n_lines > 0]
    seen_changes = np.zeros((2, 2))
    inner = np.ones(len(labels), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    np.add.at(seen_changes, (labels[at - 1], labels[at]), 1)
    seen_starts = np.bincount(labels[first], minlength=2)[:2]
    scale = 1 / max(1, len(labels))

    def model_of(w: np.ndarray) -> LineModel:
        return LineModel(w[:n_features], w[n_features : n_features + 4].reshape(2, 2), w[-2:])

    for k in range(1, rounds + 1):
        model = model_of(weights)
        content, changes, starts = _expected(features @ model.emission, n_lines, model)
        gradient = np.concatenate(
            [
                features.T @ (labels - content),
                (seen_changes - changes).ravel(),
                seen_starts - starts,
            ]
        )
        gradient = gradient * scale - ridge * weights
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights = weights + step * (moment / (1 - 0.9**k)) / (
            np.sqrt(square / (1 - 0.99**k)) + 1e-8
        )
    return model_of(weights)


def train_line_model(
    docs: DataFrame,
    labels: DataFrame,
    training_docs: int = TRAINING_DOCS,
    doc_lines: int = TRAINING_DOC_LINES,
) -> LineModel:
    """Learn the chain from the lines of labelled documents.

    The lines of a document of quality 1 count as content, those of quality 0 as
    boilerplate. At most ``training_docs`` documents of each quality are used, those whose
    id hashes smallest; only the features of their lines come to the driver. A document
    counts once, however many rows have its id, with the least of their texts, and with its
    first ``doc_lines`` lines. Without both kinds of label every line is content, so that
    the base rules alone decide.
    """
    hashed = F.xxhash64("doc_id")
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    bounded = [
        known.filter(F.col("quality") == kind).orderBy(hashed, "doc_id").limit(training_docs)
        for kind in (0, 1)
    ]
    chosen = bounded[0].union(bounded[1])
    sample = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
    )

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                lines = line_table(data, offsets)
                flat = lines.features.astype("<f4")
                cuts = np.append(0, np.cumsum(lines.n_lines))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, rows.stop - rows.start),
                        batch.column(2).slice(rows.start, rows.stop - rows.start).cast("int64"),
                        pa.array(
                            [
                                flat[a : min(b, a + doc_lines)].tobytes()
                                for a, b in zip(cuts, cuts[1:])
                            ],
                            pa.binary(),
                        ),
                    ],
                    names=["doc_id", "quality", "features"],
                )

    rows = (
        sample.select("doc_id", "text", "quality")
        .mapInArrow(table, "doc_id bigint, quality bigint, features binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    if {r["quality"] for r in rows} != {0, 1}:
        return LineModel(np.zeros(len(LINE_FEATURES)), np.zeros((2, 2)), np.zeros(2))
    parts = [
        np.frombuffer(r["features"], "<f4").reshape(-1, len(LINE_FEATURES)) for r in rows
    ]
    n_lines = np.array([len(p) for p in parts])
    marks = np.repeat([r["quality"] for r in rows], n_lines)
    return fit_lines(np.concatenate(parts).astype(float), marks, n_lines)


def _verdicts(
    data: np.ndarray, offsets: np.ndarray, model: LineModel, content_share: float
) -> dict[str, np.ndarray]:
    lines = line_table(data, offsets)
    found = base_counts(data, offsets, lines)
    labels = viterbi(lines.features @ model.emission, lines.n_lines, model)
    n = len(offsets) - 1
    words = found["n_words"]
    inside = np.bincount(lines.texts, weights=lines.n_words * labels, minlength=n)[:n]
    share = inside / np.maximum(words, 1)
    failed = (words < MIN_WORDS) | (
        100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * words
    )
    content = np.bincount(lines.texts, weights=labels, minlength=n)[:n].astype(np.int64)
    return found | {
        "base_failed": failed,
        "kept": ~failed & (share >= content_share),
        "content_share": share,
        "n_content_lines": content,
    }


def judge(
    docs: DataFrame, model: LineModel, content_share: float = CONTENT_SHARE
) -> DataFrame:
    """One row for each document: base counts, whether it fails them, and the verdict.

    A null text has no words and fails the base rules. Lines without a word are not
    labelled. Rows are judged one by one: repeated rows and null ids get their own row.
    Columns besides ``doc_id`` and ``text`` are ignored, whatever their names.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                found = _verdicts(data, offsets, model, content_share)
                ids = batch.column(0).slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(found[c]) for c in names[1:])], names=names
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(score, COLUMNS)


def quality_rules(
    docs: DataFrame, labels: DataFrame, content_share: float = CONTENT_SHARE
) -> DataFrame:
    """``judge`` with a line model that is learned from the labelled documents."""
    return judge(docs, train_line_model(docs, labels), content_share)


def keep_good(
    docs: DataFrame, model: LineModel, content_share: float = CONTENT_SHARE
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` keeps; no row is shuffled."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            for rows, data, offsets in text_slices(batch.column(at)):
                kept[rows] = _verdicts(data, offsets, model, content_share)["kept"]
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
