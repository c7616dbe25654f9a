"""Periodic runs of words, by uniting suffix classes in the order of falling LCP.

1. Only positions whose six words occur twice in their document can start a run of at least
   ``MIN_LENGTH`` words: a run of length l and period q begins with a suffix that shares
   l - q >= max(6, q) words with the suffix q words later. Documents without such a
   position have no run.
2. The suffixes of all other documents of a slice are sorted by doubling: ranks of 1, 2, 4,
   ... words, and only groups of equal rank are sorted again. The kept ranks give the
   longest common prefix (LCP) of neighbours in the order.
3. As in Kruskal's algorithm, neighbours are united by falling LCP, down to six words. A
   class is its ordered positions; the smaller class is put into the larger. Two positions
   that become neighbours in a class have exactly the LCP of that step in common: had they
   more, they would have been united before. If their distance d is at most that LCP, they
   seed a run: d is its smallest period (with a smaller one, a position between them would
   be in the class already), and it ends where the common words of the later position end.
4. Seeds of one run share period and end; the smallest position among them is its start.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.text import SPACE, mix, span_hashes, spans, text_slices

MIN_LENGTH = 12
#: The least LCP at the start of a run of that length: l - q, where l >= 2 q.
_SHARED = MIN_LENGTH // 2


@dataclass(frozen=True)
class Runs:
    """Runs in the order of documents, starts and periods; starts count within documents."""

    texts: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    periods: np.ndarray


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(words) - size + 1)
    value = words[:n]
    for k in range(1, size):
        value = mix(value) + words[k : k + n]
    return value


def _repeated_texts(words: np.ndarray, texts: np.ndarray, n_texts: int) -> np.ndarray:
    """Which texts have ``_SHARED`` words in a row at two places."""
    key = _window_hashes(words, _SHARED)
    own = texts[: len(key)]
    whole = own == texts[_SHARED - 1 :][: len(key)]
    key, own = key[whole], own[whole]
    order = np.argsort(mix(key + mix(own.astype(np.uint64))))
    key, own = key[order], own[order]
    found = np.zeros(n_texts, bool)
    found[own[1:][(key[1:] == key[:-1]) & (own[1:] == own[:-1])]] = True
    return found


def _changes(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _suffix_ranks(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of suffixes by 1, 2, 4, ... words, until no two are equal; and their order.

    A rank is the place of the first of its group, so sorting a group again leaves all other
    ranks as they are. Suffixes of different texts are never equal.
    """
    n = len(words)
    order = np.lexsort((words, texts))
    new = _changes(texts[order], words[order])
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels = [rank]
    end = np.searchsorted(texts, texts, side="right")
    size = 1
    while True:
        counts = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(counts[rank] > 1)
        if len(open_) == 0:
            break
        # A suffix that ends comes before those that go on.
        after = np.full(len(open_), -1, np.int64)
        inside = open_ + size < end[open_]
        after[inside] = rank[open_[inside] + size]
        by = np.lexsort((after, rank[open_]))
        at, group, next_ = open_[by], rank[open_[by]], after[by]
        in_group = np.arange(len(at)) - np.searchsorted(group, group, side="left")
        place = group + in_group
        new = _changes(group, next_)
        first = np.flatnonzero(new)
        rank = rank.copy()
        rank[at] = np.repeat(place[first], np.diff(np.append(first, len(at))))
        levels.append(rank)
        size *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def _common(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """The number of words that the suffixes at ``a`` and ``b``, of one text, share."""
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = np.flatnonzero((x < end[a]) & (y < end[b]))
        same = levels[k][x[inside]] == levels[k][y[inside]]
        shared[inside[same]] += 1 << k
    return shared


def _seeds(a: list[int], b: list[int], lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Unite ``a`` and ``b`` step by step; yields position, distance and LCP of seeds.

    The steps come by falling LCP. Each position moves into a larger class at most log n
    times.
    """
    held: dict[int, list[int]] = {}
    for x, y, shared in zip(a, b, lcp):
        large = held.setdefault(x, [x])
        small = held.setdefault(y, [y])
        if len(large) < len(small):
            large, small = small, large
        # Neighbours of one class have been neighbours before, with a longer LCP.
        places = [bisect_left(large, p) for p in small]
        for k, (p, at) in enumerate(zip(small, places)):
            if at and (k == 0 or places[k - 1] < at) and p - large[at - 1] <= shared:
                yield large[at - 1], p - large[at - 1], shared
            if at < len(large) and places[k + 1 : k + 2] != [at] and large[at] - p <= shared:
                yield p, large[at] - p, shared
        if places[0] == len(large):
            large.extend(small)
        elif len(small) == 1:
            large.insert(places[0], small[0])
        else:
            large.extend(small)
            large.sort()  # merges two ordered stretches
        for p in small:
            held[p] = large


def find_runs(
    words: np.ndarray, texts: np.ndarray, n_texts: int, min_length: int = MIN_LENGTH
) -> Runs:
    """All runs of at least ``min_length`` (12 or more) words of each text.

    ``words`` are hashes, text after text; ``texts`` says whose they are.
    """
    kept = _repeated_texts(words, texts, n_texts)[texts] if len(words) else np.zeros(0, bool)
    place = np.flatnonzero(kept)
    words, texts = words[place], texts[place]
    none = np.zeros(0, np.int64)
    if len(words) == 0:
        return Runs(none, none, none, none)
    order, levels = _suffix_ranks(words, texts)
    end = np.searchsorted(texts, texts, side="right")
    a, b = order[:-1], order[1:]
    same = texts[a] == texts[b]
    a, b = a[same], b[same]
    # Most neighbours share less: they differ in rank at four words already.
    if len(levels) > 2:
        close = levels[2][a] == levels[2][b]
        a, b = a[close], b[close]
    lcp = _common(a, b, levels, end)
    long = np.flatnonzero(lcp >= _SHARED)
    by = long[np.argsort(-lcp[long], kind="stable")]
    found = list(_seeds(a[by].tolist(), b[by].tolist(), lcp[by].tolist()))
    if not found:
        return Runs(none, none, none, none)
    at, period, shared = np.array(found, np.int64).T
    stop = at + period + shared
    by = np.lexsort((at, period, stop))
    at, period, stop = at[by], period[by], stop[by]
    first = _changes(period, stop)  # ends are places in all texts, so texts need not be told
    at, period, stop = at[first], period[first], stop[first]
    length = stop - at
    enough = length >= np.maximum(min_length, 2 * period)
    at, period, length = at[enough], period[enough], length[enough]
    own = texts[at]
    start = at - np.searchsorted(texts, own, side="left")
    by = np.lexsort((period, start, own))
    return Runs(own[by], start[by], length[by], period[by])


def _longest(runs: Runs, n_texts: int) -> np.ndarray:
    """The row of each text's longest run (ties: smallest start, then period), or -1."""
    by = np.lexsort((runs.periods, runs.starts, -runs.lengths, runs.texts))
    first = _changes(runs.texts[by]) if len(by) else np.zeros(0, bool)
    best = np.full(n_texts, -1, np.int64)
    best[runs.texts[by[first]]] = by[first]
    return best


def _repeating(ids: list[int | None], n_words: np.ndarray) -> np.ndarray:
    """For the word at each place, the place of the word that stands there instead.

    In one of ten documents, by the hash of the id, all words from some place on repeat.
    """
    source = np.arange(int(n_words.sum()))
    first = np.cumsum(n_words) - n_words
    for key, start, n in zip(ids, first.tolist(), n_words.tolist()):
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[start + a : start + n] = start + a + np.arange(n - a) % p
    return source


def _joined(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first_of_text: np.ndarray
) -> np.ndarray:
    """The bytes of words, in order, each but the first of a text behind a space."""
    size = ends - starts + ~first_of_text
    stop = np.cumsum(size)
    at = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - ends, size)
    out = data[np.maximum(at, 0)]
    out[(stop - size)[~first_of_text]] = 0x20
    return out


_COLUMNS = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, "
    "period bigint, exponent_milli bigint, runs string, collapsed {collapsed}"
)


def _slice_columns(
    ids: list[int | None], data: np.ndarray, offsets: np.ndarray, trial: bool
) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
    n = len(offsets) - 1
    starts, ends, texts = spans(SPACE[data], offsets)
    n_words = np.bincount(texts, minlength=n)[:n]
    hashes = span_hashes(data, starts, ends)
    if trial:
        source = _repeating(ids, n_words)
        starts, ends, hashes = starts[source], ends[source], hashes[source]
    runs = find_runs(hashes, texts, n)
    n_runs = np.bincount(runs.texts, minlength=n)[:n]
    best = _longest(runs, n)
    columns = [n_words, n_runs]
    columns += [
        np.append(c, 0)[best] for c in (runs.starts, runs.lengths, runs.periods)
    ]
    # What any run covers after its first period is dropped.
    first = np.cumsum(n_words) - n_words
    at = first[runs.texts] + runs.starts
    covered = np.zeros(len(starts) + 1, np.int64)
    np.add.at(covered, at + runs.periods, 1)
    np.add.at(covered, at + runs.lengths, -1)
    stay = np.cumsum(covered[:-1]) == 0
    own = texts[stay]
    heads = np.ones(len(own), bool)
    heads[1:] = own[1:] != own[:-1]
    kept = _joined(data, starts[stay], ends[stay], heads)
    sizes = np.bincount(
        own, weights=(ends - starts)[stay] + ~heads, minlength=n
    )[:n].astype(np.int64)
    lines = [
        f"{s},{l},{p}\n"
        for s, l, p in zip(runs.starts.tolist(), runs.lengths.tolist(), runs.periods.tolist())
    ]
    cuts = np.append(0, np.cumsum(n_runs)).tolist()
    listed = ["".join(lines[a:b]) for a, b in zip(cuts, cuts[1:])]
    return columns, listed, kept, np.append(0, np.cumsum(sizes))


def _scan(trial: bool, digests: bool):
    names = [c.split()[0] for c in _COLUMNS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                keys = batch.column(0).slice(rows.start, rows.stop - rows.start)
                columns, listed, kept, cuts = _slice_columns(
                    keys.to_pylist(), data, offsets, trial
                )
                none = columns[1] == 0
                start, length, period = columns[2:]
                with_run = [pa.array(c, mask=none) for c in (start, length, period)]
                milli = pa.array(1000 * length // np.maximum(period, 1), mask=none)
                texts = [kept[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                if digests:
                    listed = [hashlib.sha256(x.encode()).hexdigest() for x in listed]
                    texts = [hashlib.sha256(x).hexdigest() for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(columns[0]), pa.array(columns[1]), *with_run, milli,
                     pa.array(listed, pa.string()),
                     pa.array(texts, pa.string() if digests else pa.binary())],
                    names=names,
                )

    return scan


def periodic_runs(docs: DataFrame, trial: bool = False, digests: bool = False) -> DataFrame:
    """One row for each document: its runs, the longest of them, and its text without them.

    A run is a stretch of words that repeats with a smallest period q and is at least 12
    words and 2 q long; it cannot be extended. ``runs`` lists all of them, one
    ``start,length,period`` a line; ``collapsed`` has the words that are left if every run
    keeps its first q words, joined by spaces (as bytes). With ``digests`` both are SHA-256
    values, and no text leaves the task. ``trial`` first makes every tenth document, by the
    hash of its id, repeat itself from some word on.

    A null or empty text has no words and no runs; columns of the longest run are null then.
    Rows are judged one by one, so repeated rows and rows without id get their own, and the
    trial leaves the latter as they are. Columns besides ``doc_id`` and ``text`` do not
    matter. A document is held by one task, in about 16 bytes a word for each doubling of
    its longest repeat; nothing is shuffled. Words are compared by 64-bit hashes.
    """
    schema = _COLUMNS.format(collapsed="string" if digests else "binary")
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _scan(trial, digests), schema
    )
