"""Pack documents into sequences of a fixed number of tokens with little padding.

Documents are cut into full pieces of the sequence length and one remainder; only the
remainders have to be combined. What can be combined is decided on their histogram alone,
which has fewer entries than a sequence has tokens, however many documents there are:

* Minimum bin slack: the longest remainder left opens a sequence. A subset-sum dynamic
  programme over the other lengths, one bit per fill level, finds the multiset that fills
  the window closest to its capacity; how many of each length it takes is read back from
  the bitsets of the steps. The pattern is used as often as the counts allow.
* Every piece has a rank among the pieces of its length (partial ranks of its task plus
  a prefix sum over tasks), and the rank says which use of which pattern it belongs to.

So no ids move: one pass encodes, and the placement is computed on narrow rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.tokens import encoded_slices, vocabulary_path
from txlake.llm.working import stored

CAPACITY = 1024
END_ID = 0

PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
    "piece_id bigint, chunk bigint, rank_in_chunk bigint, ids binary, ids_crc32 bigint"
)


@dataclass(frozen=True)
class Pattern:
    """``uses`` sequences that each take ``counts[length]`` pieces of each length."""

    uses: int
    counts: dict[int, int]


def fullest(counts: Mapping[int, int], capacity: int) -> dict[int, int]:
    """The multiset with the longest length in it whose sum is closest to ``capacity``.

    Bit s of ``reached`` is set if some multiset of the lengths seen so far sums to s. The
    copies of a length are offered in lots of 1, 2, 4, ..., so that any number of them can
    be composed. Among equal sums, longer lengths are preferred.
    """
    first = max(counts)
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reached = 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        copies = min(counts[length] - (length == first), room // length)
        lot = 1
        while copies > 0:
            lot = min(lot, copies)
            steps.append((length, lot, reached))
            reached |= (reached << (lot * length)) & mask
            copies -= lot
            lot *= 2
        if reached >> room:
            break
    fill = reached.bit_length() - 1
    taken = Counter({first: 1})
    for length, lot, before in reversed(steps):
        if not before >> fill & 1:
            taken[length] += lot
            fill -= lot * length
    return dict(taken)


def plan_patterns(histogram: Mapping[int, int], capacity: int) -> list[Pattern]:
    """Minimum-bin-slack patterns that use up a histogram of lengths below ``capacity``.

    Every pattern exhausts at least one length, so there are fewer patterns than lengths.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    patterns = []
    while left:
        taken = fullest(left, capacity)
        uses = min(left[length] // n for length, n in taken.items())
        patterns.append(Pattern(uses, taken))
        for length, n in taken.items():
            left[length] -= n * uses
            if not left[length]:
                del left[length]
    return patterns


def cut_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode whole texts, append ``end_id`` and cut into pieces; one row for each piece.

    A null text counts as empty and so is one piece with the end id alone. ``chunk`` is
    the task and ``rank_in_chunk`` numbers its pieces of equal length. Rows that repeat a
    ``doc_id``, or have none, are documents of their own; other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        pieces = 0
        end = np.array([end_id], "u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part, encoded in encoded_slices(batch.column(1), vocabulary):
                rows = []
                for doc_id, data in zip(ids[part], encoded, strict=True):
                    data += end
                    n = len(data) // 4
                    for start in range(0, n, capacity):
                        piece = data[4 * start : 4 * (start + capacity)]
                        length = len(piece) // 4
                        rows.append(
                            (doc_id, start, length, n, (chunk << 40) + pieces, chunk,
                             seen[length], piece, zlib.crc32(piece))
                        )
                        seen[length] += 1
                        pieces += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column, pa.binary() if k == 7 else pa.int64())
                        for k, column in enumerate(zip(*rows, strict=True))
                    ],
                    names=[c.split()[0] for c in PIECES.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces; both count without gaps.

    Only the histogram of lengths comes to the driver, at most ``capacity`` numbers.
    """
    per_chunk = stored(
        pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")), "counts"
    )
    histogram = {
        row["length"]: row["n"]
        for row in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranked = pieces.join(
        per_chunk.select(
            "chunk", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
        ),
        ["chunk", "length"],
    ).withColumn("rank", F.col("before") + F.col("rank_in_chunk"))

    whole = histogram.pop(capacity, 0)
    slots: list[tuple[int, int, int, int, int]] = []
    used: Counter[int] = Counter()
    first_sequence = whole
    for pattern in plan_patterns(histogram, capacity):
        offset = 0
        for length, n in sorted(pattern.counts.items(), reverse=True):
            slots.append((length, used[length], n, first_sequence, offset))
            used[length] += n * pattern.uses
            offset += n * length
        first_sequence += pattern.uses
    slots.append((capacity, 0, 1, 0, 0))
    slots.sort()
    lengths, firsts, copies, sequences_from, offsets = (
        np.array(column, np.int64) for column in zip(*slots, strict=True)
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            # The slots of a length are in order of their first rank: find the last that fits.
            slot = np.searchsorted(lengths, length)
            high = np.searchsorted(lengths, length, side="right") - 1
            while np.any(slot < high):
                middle = (slot + high + 1) // 2
                fits = firsts[middle] <= rank
                slot, high = np.where(fits, middle, slot), np.where(fits, high, middle - 1)
            use, copy = np.divmod(rank - firsts[slot], copies[slot])
            keep = [c for c in batch.schema.names if c not in _RANKING]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array(sequences_from[slot] + use),
                    pa.array(offsets[slot] + copy * length),
                ],
                names=[*keep, "sequence_id", "offset"],
            )

    kept = [f for f in ranked.schema.fields if f.name not in _RANKING]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return ranked.mapInArrow(assign, f"{schema}, sequence_id bigint, offset bigint")


_RANKING = ("chunk", "rank_in_chunk", "before", "rank")


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> tuple[DataFrame, DataFrame]:
    """Encoded pieces with their ids, and where each piece goes (without ids)."""
    pieces = stored(
        cut_documents(docs, vocabulary or vocabulary_path(), capacity, end_id), "pieces"
    )
    return pieces, place(pieces.drop("ids"), capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``n_tokens``, ``ids`` (unsigned 32-bit).

    A sequence has at most ``capacity`` tokens, which bounds what a group collects.
    """
    parts = placed.select("piece_id", "sequence_id", "offset").join(
        pieces.select("piece_id", "length", "ids"), "piece_id"
    )
    grouped = parts.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
    )
    ids = F.aggregate("parts", F.lit(b""), lambda joined, part: F.concat(joined, part["ids"]))
    return grouped.select("sequence_id", "n_tokens", ids.alias("ids"))
