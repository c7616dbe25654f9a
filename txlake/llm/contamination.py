"""Benchmark decontamination: BM25 with block-max WAND over an inverted index of test items.

The index holds the test items; the training passages are the queries. A posting's impact
is the BM25 contribution of its word, divided by the score of the whole item against
itself, so that 1 means every word of an item occurs and one threshold fits all lengths.
Postings are in blocks with their largest impact, and block-max WAND skips whatever
cannot reach the threshold: first passages whose words cannot add up to it, then, from
pivot to pivot, items and blocks. All items above the threshold are retrieved, and an item
counts as leaked if enough of its word n-grams stand in the document, of its question or of
question and answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.text import NOT_ALNUM, shingles_of, text_slices, utf8, words_of
from txlake.llm.working import free_name

K1, B = 1.2, 0.75
THRESHOLD = 0.7
OVERLAP = 0.8
NGRAM = 5
BLOCK_POSTINGS = 32
RANGES = 64
SHARD_ITEMS = 20_000

FOUND = (
    "doc_id bigint, item_id bigint, score double, "
    "question_overlap double, answer_overlap double, item_overlap double"
)

_SENTENCE_END = re.compile(r"[.!?:]\s+(?=\S)|\n+(?=\S)")


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the answer is the last sentence or line.

    An item without several of them, or with more words in the last than before it, is all
    question.
    """
    cuts = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    if not cuts:
        return text, ""
    question, answer = text[: cuts[-1]], text[cuts[-1] :]
    return (question, answer) if len(question.split()) >= len(answer.split()) else (text, "")


@dataclass(frozen=True)
class ItemIndex:
    """Inverted index of one shard of items; ``terms`` are sorted word hashes."""

    item_ids: np.ndarray
    terms: np.ndarray
    bounds: np.ndarray  # the largest impact of each term
    first: np.ndarray  # postings of term t are first[t]:first[t + 1]
    items: np.ndarray
    impacts: np.ndarray
    range_max: np.ndarray  # the largest impact of each term in each of some ranges of items
    block_max: np.ndarray  # of each block of BLOCK_POSTINGS postings of a term
    first_block: np.ndarray
    grams: list[np.ndarray]  # n-gram hashes of each item, in order of the text
    sizes: np.ndarray  # words in each n-gram: less than usual in an item of fewer words
    in_question: np.ndarray  # how many of the n-grams lie in the question
    longest: int


def _folded(texts: list[str]) -> pa.Array:
    return pc.utf8_lower(pa.array([t or "" for t in texts], pa.string()))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of each word, and the number of words of each text."""
    data, offsets = utf8(_folded(texts))
    words, owners = words_of(data, offsets, NOT_ALNUM)
    return words, owners, np.bincount(owners, minlength=len(texts))[: len(texts)]


def build_item_index(item_ids: list[int], texts: list[str], ngram: int = NGRAM) -> ItemIndex:
    """Index the words of the questions, folded; items without a word match nothing."""
    n = len(texts)
    questions = [split_item(t or "")[0] for t in texts]
    all_words, all_owners, all_lengths = _words(texts)
    words, owners, lengths = _words(questions)
    terms, of_term = np.unique(words, return_inverse=True)
    pairs, counts = np.unique(of_term.astype(np.int64) * n + owners, return_counts=True)
    term, item = pairs // max(n, 1), pairs % max(n, 1)
    held = np.bincount(term, minlength=len(terms))
    idf = np.log1p((n - held + 0.5) / (held + 0.5))
    mean = max(1.0, lengths.mean()) if n else 1.0
    impact = idf[term] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[item] / mean))
    whole = np.bincount(item, weights=impact, minlength=n)
    impact = impact / whole[item]
    first = np.append(0, np.cumsum(held))
    blocks = -(-held // BLOCK_POSTINGS)
    first_block = np.append(0, np.cumsum(blocks))
    starts = np.concatenate(
        [np.arange(a, b, BLOCK_POSTINGS) for a, b in zip(first, first[1:], strict=False)]
        or [np.zeros(0, int)]
    ).astype(int)
    bounds = np.maximum.reduceat(impact, first[:-1]) if len(terms) else np.zeros(0)
    width = max(4, -(-n // RANGES))
    range_max = np.zeros((len(terms), -(-max(n, 1) // width)), np.float32)
    np.maximum.at(range_max, (term, item // width), impact.astype(np.float32))
    begin = np.append(0, np.cumsum(all_lengths))
    sizes = np.clip(all_lengths, 1, ngram)
    grams = [
        shingles_of(all_words[a:b], all_owners[a:b] * 0, 1, int(size))[0]
        for a, b, size in zip(begin, begin[1:], sizes, strict=False)
    ]
    return ItemIndex(
        np.array(item_ids, np.int64),
        terms,
        bounds,
        first,
        item,
        impact,
        range_max,
        np.maximum.reduceat(impact, starts) if len(starts) else np.zeros(0),
        first_block,
        grams,
        sizes,
        np.maximum(lengths - sizes + 1, np.minimum(lengths, 1)),
        int(lengths.max()) if n else 0,
    )


def search(index: ItemIndex, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """Block-max WAND: all items whose score for the query's terms reaches the threshold.

    ``query`` are different term numbers. Lists are kept in order of their current item.
    The pivot is the first list at which the bounds so far reach the threshold: no earlier
    item can. If the blocks around the pivot cannot either, the lists jump behind the
    nearest block end.
    """
    items, impacts, block_max = index.items, index.impacts, index.block_max
    slack = threshold - 1e-9
    lists = [
        [int(items[index.first[t]]), int(index.first[t]), int(index.first[t + 1]), t]
        for t in query.tolist()
    ]
    bounds = index.bounds
    found = []

    def block(entry: list) -> int:
        begin = int(index.first[entry[3]])
        return int(index.first_block[entry[3]]) + (entry[1] - begin) // BLOCK_POSTINGS

    def block_end(entry: list) -> int:
        """Position behind the block that an entry stands in."""
        begin = int(index.first[entry[3]])
        return min(entry[2], begin + ((entry[1] - begin) // BLOCK_POSTINGS + 1) * BLOCK_POSTINGS)

    def advance(entry: list, target: int) -> None:
        entry[1] += int(np.searchsorted(items[entry[1] : entry[2]], target))
        entry[0] = int(items[entry[1]]) if entry[1] < entry[2] else 1 << 62

    while True:
        lists.sort()
        while lists and lists[-1][0] == 1 << 62:
            lists.pop()
        total, pivot = 0.0, -1
        for k, entry in enumerate(lists):
            total += bounds[entry[3]]
            if total >= slack:
                pivot = k
                break
        if pivot < 0:
            return found
        item = lists[pivot][0]
        while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
            pivot += 1
        if lists[0][0] == item:
            if sum(block_max[block(e)] for e in lists[: pivot + 1]) >= slack:
                score = sum(float(impacts[e[1]]) for e in lists[: pivot + 1])
                if score >= slack:
                    found.append((item, score))
                target = item + 1
            else:
                # No item before the nearest end of these blocks, or the next list, can do.
                ends = [block_end(e) for e in lists[: pivot + 1]]
                target = min(int(items[end - 1]) + 1 for end in ends)
                if pivot + 1 < len(lists):
                    target = min(target, lists[pivot + 1][0])
                target = max(target, item + 1)
            for entry in lists[: pivot + 1]:
                advance(entry, target)
        else:
            for entry in lists[:pivot]:
                if entry[0] < item:
                    advance(entry, item)


def _candidates(
    index: ItemIndex, words: np.ndarray, owners: np.ndarray, threshold: float
) -> dict[tuple[int, int], float]:
    """(text, item) -> best score over the passages of the text.

    A passage has twice as many words as the longest item, and the next begins half a
    passage later, so that any run of words as long as an item lies in a passage whole.
    """
    if not len(index.terms) or not len(words):
        return {}
    step = max(index.longest, 1)
    at = np.searchsorted(index.terms, words)
    at[at == len(index.terms)] = 0
    hit = np.flatnonzero(index.terms[at] == words)
    term, owner = at[hit], owners[hit]
    first_word = np.searchsorted(owners, np.arange(owners[-1] + 2))
    cells = (np.diff(first_word) - 1) // step + 1
    first_cell = np.append(0, np.cumsum(cells))
    cell = first_cell[owner] + (hit - first_word[owner]) // step
    pair = np.unique(cell * len(index.terms) + term)  # each term once in each half passage
    cell, term = pair // len(index.terms), pair % len(index.terms)
    n_cells = int(first_cell[-1])
    begin = np.searchsorted(cell, np.arange(n_cells + 2))
    last = np.zeros(n_cells, bool)
    last[first_cell[1:] - 1] = True
    # The most that any item of a range can score in a passage: no passage below the
    # threshold in every range is searched.
    reach = np.zeros((n_cells + 1, index.range_max.shape[1]), np.float32)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        reach[some] = np.add.reduceat(index.range_max[term], begin[some], axis=0)
    passage = reach[:-1] + np.where(last[:, None], 0, reach[1:])
    live = np.flatnonzero(passage.max(axis=1) >= threshold - 1e-4)
    found: dict[tuple[int, int], float] = {}
    end = begin[live + np.where(last[live], 1, 2)]
    owner_of = np.searchsorted(first_cell, live, side="right") - 1
    for k, c in enumerate(live.tolist()):
        query = np.unique(term[begin[c] : end[k]])
        for item, score in search(index, query, threshold):
            key = int(owner_of[k]), item
            found[key] = max(score, found.get(key, 0.0))
    return found


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    ngram: int = NGRAM,
    shard_items: int = SHARD_ITEMS,
) -> DataFrame:
    """One row for each document and test item that leaked into it.

    An item leaked if at least ``overlap`` of the word n-grams of its question, or of the
    whole item, stand in the document. ``answer_overlap`` is the share of those that reach
    into the answer, null if there is none. Items are indexed in shards of at most
    ``shard_items``, which bounds what is sent to the executors at once; every document is
    searched in every shard. Null texts have no words. Rows that repeat an ``item_id`` count
    as items of their own; equal rows of the result appear once for each pair of rows. A
    null ``item_id`` stays null. Without documents or items there is no row. Long texts are
    searched whole, passage by passage; columns besides ids and texts do not matter.
    """
    shards = _shards(benchmark, shard_items)
    found = None
    for index, item_ids in shards:
        part = docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(
            _searcher(index, item_ids, threshold, overlap, ngram), FOUND
        )
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], FOUND)


def _shards(
    benchmark: DataFrame, shard_items: int
) -> Iterator[tuple[ItemIndex, list[int | None]]]:
    """Indexes of at most ``shard_items`` items, fetched one after the other, and their ids."""
    keyed = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    n = keyed.count()
    parts = max(1, -(-n // shard_items))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        rows = sorted(
            keyed.filter(shard == k).collect(),
            key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""),
        )
        if rows:
            texts = [r["text"] for r in rows]
            yield build_item_index(list(range(len(rows))), texts), [r["item_id"] for r in rows]


def _searcher(
    index: ItemIndex,
    item_ids: list[int | None],
    threshold: float,
    overlap: float,
    ngram: int,
):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            out: list[tuple] = []
            for rows, data, offsets in text_slices(pc.utf8_lower(batch.column(1))):
                n = len(offsets) - 1
                words, owners = words_of(data, offsets, NOT_ALNUM)
                by_text: dict[int, list[tuple[int, float]]] = {}
                for (text, item), score in _candidates(index, words, owners, threshold).items():
                    by_text.setdefault(text, []).append((item, score))
                if not by_text:
                    continue
                first = np.searchsorted(owners, np.arange(n + 1))
                for text, candidates in by_text.items():
                    own = words[first[text] : first[text + 1]]
                    held: dict[int, np.ndarray] = {}
                    for item, score in candidates:
                        size = int(index.sizes[item])
                        if size not in held:
                            held[size] = np.unique(shingles_of(own, own.astype(int) * 0, 1, size)[0])
                        there = np.isin(index.grams[item], held[size])
                        cut = int(index.in_question[item])
                        asked, answered = there[:cut], there[cut:]
                        if max(asked.mean(), there.mean()) >= overlap:
                            out.append(
                                (
                                    ids[rows.start + text].as_py(),
                                    item_ids[int(index.item_ids[item])],
                                    score,
                                    float(asked.mean()),
                                    float(answered.mean()) if len(answered) else None,
                                    float(there.mean()),
                                )
                            )
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[k], pa.int64() if k < 2 else pa.float64())
                    for k in range(6)
                ],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    return find


def drop_leaked(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, into which no test item leaked.

    Rows are matched by ``doc_id``; rows without one are kept.
    """
    leaked = leaks(docs, benchmark, **options).select("doc_id").distinct()
    key = free_name("id", docs.columns)
    kept = docs.withColumn(key, F.col("doc_id").cast("bigint")).join(
        leaked.withColumnRenamed("doc_id", key), key, "left_anti"
    )
    return kept.select(docs.columns)
