"""Token ids in binary shards, with a minimal perfect hash index over document keys.

The store is two tables in the shared folder:

* ``blocks``: documents in ascending order of ``doc_id``, cut into shards by ranges of it
  and each shard into blocks of whole documents. ``payload`` is the raw little-endian ids
  (16-bit where the vocabulary allows, else 32-bit); ``doc_ids``, ``copies`` and ``ends``
  say what stands where. Rows that repeat a ``doc_id`` are told apart by a copy number.
* ``index``: keys are dealt to buckets by hash. In each bucket a minimal perfect hash
  (hash, displace) maps its n keys to the slots 0..n-1 without storing them; a slot holds
  a 32-bit fingerprint of its key, the block, and where in the payload the ids are.

Access by key reads one bucket and one block, whatever the size of the store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.text import mix, utf8
from txlake.llm.tokens import encoded_slices, encoder, vocabulary_path
from txlake.llm.working import shuffle_partitions, stored, stored_buckets

END_ID = 2
BLOCK_IDS = 1 << 17
BUCKET_KEYS = 2000
#: Stands for a null doc_id, which sorts first. A document of that very id, the least of
#: all, is taken for one without.
NO_ID = -(1 << 63)

BLOCKS = (
    "shard bigint, block_id bigint, first_id bigint, n_ids bigint, id_bytes int, "
    "doc_ids array<bigint>, copies array<bigint>, ends array<bigint>, payload binary"
)
INDEX = (
    "bucket bigint, n_keys bigint, displacements binary, fingerprints binary, "
    "blocks binary, starts binary, lengths binary"
)
FOUND = "doc_id bigint, copy bigint, block_id bigint, start bigint, length bigint"


@dataclass(frozen=True)
class TokenStore:
    blocks: DataFrame
    index: DataFrame
    buckets: int


def key_hash(doc_ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """64 bits of a key; equal keys only have equal hashes by chance of 2**-64."""
    return mix(mix(doc_ids.astype(np.int64).view(np.uint64)) + copies.astype(np.uint64))


def _slot(hashes: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    seeds = displacement.astype(np.int64).view(np.uint64)
    return (mix(hashes + mix(seeds)) % np.uint64(n)).astype(np.int64)


def build_minimal_hash(hashes: np.ndarray, load: int = 4) -> np.ndarray:
    """Displacements of a minimal perfect hash of n different 64-bit hashes to 0..n-1.

    Keys fall into groups of about ``load``. Largest groups first, a group tries
    displacements 1, 2, ... until its keys fall into free slots of their own; a group of
    one key is given a free slot directly, written as -1 - slot.
    """
    n = len(hashes)
    groups = max(1, -(-n // load))
    group = (mix(hashes) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    firsts = np.cumsum(sizes) - sizes
    taken = np.zeros(n, bool)
    displacements = np.zeros(groups, np.int64)
    tries = np.arange(1, 65, dtype=np.int64)
    for g in np.argsort(-sizes, kind="stable"):
        size = int(sizes[g])
        if size <= 1:
            break
        keys = hashes[order[firsts[g] : firsts[g] + size]]
        base = 0
        while True:
            slots = _slot(keys[None, :], (base + tries)[:, None], n)
            ordered = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                displacements[g] = base + tries[k]
                taken[slots[k]] = True
                break
            base += len(tries)
    free = iter(np.flatnonzero(~taken).tolist())
    for g in np.flatnonzero(sizes == 1):
        displacements[g] = -1 - next(free)
    return displacements


def find_slots(hashes: np.ndarray, displacements: np.ndarray, n: int) -> np.ndarray:
    """The slot of each hash; any hash gets some slot, so compare fingerprints."""
    group = (mix(hashes) % np.uint64(len(displacements))).astype(np.int64)
    held = displacements[group]
    return np.where(held < 0, -1 - held, _slot(hashes, held, n))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xF1A6)) >> np.uint64(32)).astype("<u4")


def bucket_of(doc_id: Column, copy: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, copy), F.lit(buckets)).cast("bigint")


class _BlockWriter:
    """Cuts documents that come in order into blocks; a batch is cut by positions, not rows."""

    def __init__(self, id_bytes: int, block_ids: int) -> None:
        self._id_bytes, self._block_ids = id_bytes, block_ids
        self._shard, self._block, self._before = -1, 0, 0
        self._last: tuple[int, int] | None = None  # the last document and its copy number
        self._clear()

    def _clear(self) -> None:
        self._held = 0
        self._doc_ids: list[np.ndarray] = []
        self._copies: list[np.ndarray] = []
        self._ends: list[np.ndarray] = []
        self._parts: list[bytes] = []

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        shards, doc_ids = (np.asarray(batch.column(k)) for k in (0, 1))
        payload, offsets = utf8(batch.column(2))
        stops = offsets // self._id_bytes
        new_shard = np.append(True, shards[1:] != shards[:-1]) if len(shards) else []
        edges = [*np.flatnonzero(new_shard).tolist(), len(shards)]
        for first, last in zip(edges, edges[1:]):
            if int(shards[first]) != self._shard:
                yield from self.flush()
                self._shard, self._block, self._before = int(shards[first]), 0, 0
                self._last = None
            copies = self._copy_numbers(doc_ids[first:last])
            at = first
            while at < last:
                # A block takes documents until it has enough ids.
                wanted = stops[at] + self._block_ids - self._held
                end = min(last, max(at + 1, int(np.searchsorted(stops, wanted, side="left"))))
                self._doc_ids.append(doc_ids[at:end])
                self._copies.append(copies[at - first : end - first])
                self._ends.append(self._held + stops[at + 1 : end + 1] - stops[at])
                self._parts.append(payload[offsets[at] : offsets[end]].tobytes())
                self._held += int(stops[end] - stops[at])
                at = end
                if self._held >= self._block_ids:
                    yield from self.flush()

    def _copy_numbers(self, doc_ids: np.ndarray) -> np.ndarray:
        """0, 1, ... for consecutive rows of one document, also across batches."""
        new = np.append(True, doc_ids[1:] != doc_ids[:-1])
        first = np.flatnonzero(new)
        rank = np.arange(len(doc_ids)) - np.repeat(first, np.diff(np.append(first, len(doc_ids))))
        if self._last is not None and self._last[0] == int(doc_ids[0]):
            size = int(first[1]) if len(first) > 1 else len(doc_ids)
            rank[:size] += self._last[1] + 1
        self._last = int(doc_ids[-1]), int(rank[-1])
        return rank

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self._parts:
            return
        listed = [
            pa.array([np.concatenate(c).astype(np.int64)], pa.list_(pa.int64()))
            for c in (self._doc_ids, self._copies, self._ends)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([self._shard], pa.int64()),
                pa.array([(self._shard << 32) + self._block], pa.int64()),
                pa.array([self._before], pa.int64()),
                pa.array([self._held], pa.int64()),
                pa.array([self._id_bytes], pa.int32()),
                *listed,
                pa.array([b"".join(self._parts)], pa.binary()),
            ],
            names=[c.split()[0] for c in BLOCKS.split(", ")],
        )
        self._before += self._held
        self._block += 1
        self._clear()


def write_blocks(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = END_ID,
    shards: int | None = None,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode and write all documents; the ``blocks`` table, bucketed by ``block_id``.

    Shards are ranges between quantiles of ``doc_id``, so texts are encoded where they are
    read and only their ids are shuffled. A document is never cut; a longer one than
    ``block_ids`` is a block of its own.
    """
    spark = docs.sparkSession
    shards = shards or shuffle_partitions(spark)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text"
    )
    cuts = keyed.select("doc_id").approxQuantile(
        "doc_id", [k / shards for k in range(1, shards)], 0.2 / shards
    )
    bounds = np.unique(np.array(cuts or [], np.float64))
    id_bytes = 2 if encoder(vocabulary).size <= 1 << 16 else 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], f"<u{id_bytes}").tobytes()
        for batch in batches:
            ids = np.asarray(batch.column(0))
            shard = np.searchsorted(bounds, ids.astype(np.float64), side="right")
            for rows, encoded in encoded_slices(batch.column(1), vocabulary):
                narrow = (np.frombuffer(e, "u4").astype(f"<u{id_bytes}") for e in encoded)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[rows], pa.int64()),
                        pa.array(ids[rows], pa.int64()),
                        pa.array([e.tobytes() + end for e in narrow], pa.binary()),
                    ],
                    names=["shard", "doc_id", "ids"],
                )

    def layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _BlockWriter(id_bytes, block_ids)
        for batch in batches:
            yield from writer.add(batch)
        yield from writer.flush()

    encoded = keyed.mapInArrow(encode, "shard bigint, doc_id bigint, ids binary")
    ordered = encoded.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", "doc_id"
    )
    return stored_buckets(
        ordered.mapInArrow(layout, BLOCKS), "token_blocks", "block_id", shards, "uncompressed"
    )


def _directories(blocks: DataFrame) -> DataFrame:
    """The blocks, for what is read beside payloads: little of each file, so by few tasks."""
    return blocks.coalesce(shuffle_partitions(blocks.sparkSession))


def entries(blocks: DataFrame) -> DataFrame:
    """Where each document is, from the directories of the blocks; reads no payload."""
    return _directories(blocks).select(
        "block_id",
        F.inline(
            F.arrays_zip(
                F.col("doc_ids").alias("doc_id"),
                F.col("copies").alias("copy"),
                F.col("ends").alias("end"),
                F.concat(
                    F.array(F.lit(0).cast("bigint")),
                    F.slice("ends", F.lit(1), F.size("ends") - 1),
                ).alias("start"),
            )
        ),
    ).select("doc_id", "copy", "block_id", "start", (F.col("end") - F.col("start")).alias("length"))


def build_index(blocks: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The ``index`` table and its number of buckets; every document is in it."""
    listed = entries(blocks)
    keys = _directories(blocks).agg(F.sum(F.size("doc_ids"))).first()[0] or 0
    buckets = max(1, -(-keys // bucket_keys))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        held = {c: rows.column(c).to_numpy() for c in rows.schema.names}
        hashes = key_hash(held["doc_id"], held["copy"])
        n = len(hashes)
        displacements = build_minimal_hash(hashes)
        slots = find_slots(hashes, displacements, n)
        where = np.empty(n, np.int64)
        where[slots] = np.arange(n)
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()], pa.int64()),
                "n_keys": pa.array([n], pa.int64()),
                "displacements": [displacements.astype("<i8").tobytes()],
                "fingerprints": [fingerprint(hashes)[where].tobytes()],
                "blocks": [held["block_id"][where].astype("<i8").tobytes()],
                "starts": [held["start"][where].astype("<i8").tobytes()],
                "lengths": [held["length"][where].astype("<i8").tobytes()],
            }
        )

    index = (
        listed.withColumn("bucket", bucket_of(F.col("doc_id"), F.col("copy"), buckets))
        .groupBy("bucket")
        .applyInArrow(build, INDEX)
    )
    return stored(index, "token_index"), buckets


def lookup(store: TokenStore, keys: DataFrame) -> DataFrame:
    """Where the ids of each key (``doc_id``, ``copy``) are; unknown keys give no row.

    A key that is not in the store passes the fingerprint with a chance of 2**-32.
    """
    dealt = keys.select("doc_id", "copy").withColumn(
        "bucket", bucket_of(F.col("doc_id"), F.col("copy"), store.buckets)
    )

    names = [c.split()[0] for c in FOUND.split(", ")]

    def find(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        columns = [np.zeros(0, np.int64)] * len(names)
        if asked.num_rows and held.num_rows:
            row = held.slice(0, 1).to_pylist()[0]
            doc_ids, copies = (asked.column(c).to_numpy() for c in ("doc_id", "copy"))
            hashes = key_hash(doc_ids, copies)
            slots = find_slots(
                hashes, np.frombuffer(row["displacements"], "<i8"), row["n_keys"]
            )
            known = np.frombuffer(row["fingerprints"], "<u4")[slots] == fingerprint(hashes)
            slots = slots[known]
            columns = [
                doc_ids[known],
                copies[known],
                *(np.frombuffer(row[c], "<i8")[slots] for c in ("blocks", "starts", "lengths")),
            ]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return (
        dealt.groupBy("bucket").cogroup(store.index.groupBy("bucket")).applyInArrow(find, FOUND)
    )


def read_ids(store: TokenStore, found: DataFrame, checksums: bool = False) -> DataFrame:
    """Read the payload at each place ``lookup`` found.

    One row for each: ``doc_id``, ``copy``, ``shard``, ``start`` within the shard,
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit), or with ``checksums`` their
    ``ids_crc32``, so that ids that are only checked do not leave the task. The places asked for in a block
    are gathered per block, which bounds them; payloads stay where they are.
    """
    asked = found.groupBy("block_id").agg(
        F.collect_list(F.struct("doc_id", "copy", "start", "length")).alias("asked")
    )
    met = store.blocks.select("block_id", "shard", "first_id", "id_bytes", "payload").join(
        asked, "block_id"
    )

    last = "ids_crc32 bigint" if checksums else "ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                width, before = row["id_bytes"].as_py(), row["first_id"].as_py()
                payload = memoryview(row["payload"].as_buffer())
                places = row["asked"].values
                doc_ids, copies, starts, lengths = (
                    places.field(c) for c in ("doc_id", "copy", "start", "length")
                )
                held = np.frombuffer(payload, f"<u{width}").astype("<u4", copy=False)
                ids = [
                    zlib.crc32(held[s : s + n]) if checksums else held[s : s + n].tobytes()
                    for s, n in zip(starts.to_pylist(), lengths.to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        copies,
                        pa.array(np.full(len(ids), row["shard"].as_py())),
                        pa.array(np.asarray(starts) + before, pa.int64()),
                        lengths,
                        pa.array(ids, pa.int64() if checksums else pa.binary()),
                    ],
                    names=["doc_id", "copy", "shard", "start", "n_tokens", last.split()[0]],
                )

    return met.mapInArrow(
        read, f"doc_id bigint, copy bigint, shard bigint, start bigint, n_tokens bigint, {last}"
    )


def shard_starts(blocks: DataFrame) -> DataFrame:
    """The number of ids before each shard; one row for each shard."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = _directories(blocks).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    return totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def write_tokens(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID
) -> TokenStore:
    """Encode whole texts (null: empty), append ``end_id`` to each, write blocks and index."""
    blocks = write_blocks(docs, vocabulary or vocabulary_path(), end_id)
    index, buckets = build_index(blocks)
    return TokenStore(blocks, index, buckets)


def keys_of(docs: DataFrame) -> DataFrame:
    """The keys of a table of documents: each ``doc_id`` with a number for each copy."""
    return (
        docs.groupBy(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "doc_id",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy"),
        )
    )
