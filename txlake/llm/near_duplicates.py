"""Similarity join on word shingles with banded MinHash and exact verification.

1. Texts with the same word sequence are one class; everything below sees one text each.
2. A signature has ``trees`` prefixes of min-hashes. Texts that agree on a whole prefix in
   some tree are candidates. Prefixes are shortened from ``longest`` until a pair at the
   threshold meets in some tree with the target probability; more similar pairs are likelier.
3. Tree nodes are groups of candidates. Groups of more than ``BLOCK`` texts are cut into
   blocks, and pairs of blocks are groups of their own, so no task holds a whole group.
   Within a group, signatures estimate the similarity; what is far below the threshold is
   no edge. Only a spanning forest of the edges leaves a task.
4. All links lie within components of these edges. In each component the shingle sets are
   compared exactly, block pair by block pair, with matrix products over shared shingles.
   What leaves a task is, for each text, the list of its links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from txlake.llm.components import components
from txlake.llm.text import mix, sequence_hashes, shingles_of, text_slices, words_of
from txlake.llm.working import free_name, stored

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 40
LONGEST = 12
RECALL = 0.9999
BLOCK = 256
VERIFY_BLOCK = 128

#: An estimate from n one-byte min-hashes misses by more than this many deviations with a
#: chance below one in a million.
_DEVIATIONS = 5.0
_SHARED_COLUMNS = 1 << 15


def prefix_length(
    trees: int = TREES,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    longest: int = LONGEST,
) -> int:
    """Shorten the prefix until a pair at the threshold is found often enough."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _signatures(
    shingles: np.ndarray, owners: np.ndarray, n_texts: int, functions: int
) -> np.ndarray:
    """Min-hashes of each text as unsigned 32-bit; texts without shingles get all ones."""
    rng = np.random.default_rng(20240229)
    masks = rng.integers(0, 1 << 32, functions, dtype=np.uint32)
    factors = rng.integers(0, 1 << 31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.full((n_texts, functions), 0xFFFFFFFF, np.uint32)
    if not len(shingles):
        return out
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    held = owners[first]
    for f in range(functions):
        mixed = (values ^ masks[f]) * factors[f]
        mixed ^= mixed >> np.uint32(15)
        out[held, f] = np.minimum.reduceat(mixed, first)
    return out


SIGNED = "doc_id bigint, class_a bigint, class_b bigint, keys array<bigint>, signature binary"


def sign(
    docs: DataFrame, trees: int = TREES, depth: int | None = None, size: int = SHINGLE_WORDS
) -> DataFrame:
    """For each row: its class (128 bits of the word sequence), tree keys and signature.

    ``keys`` are hashes of (tree, prefix); a text without words has none. ``signature`` has
    one byte of each min-hash.
    """
    depth = depth or prefix_length(trees)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                n = rows.stop - rows.start
                words, owners = words_of(data, offsets)
                classes = [sequence_hashes(words, owners, n, seed).view("i8") for seed in (1, 2)]
                shingles, of = shingles_of(words, owners, n, size)
                minima = _signatures(shingles, of, n, trees * depth)
                parts = minima.reshape(n, trees, depth).astype(np.uint64)
                keys = np.broadcast_to(np.arange(trees, dtype=np.uint64), (n, trees))
                for k in range(depth):
                    keys = mix(keys ^ (parts[:, :, k] << np.uint64(20)))
                some = np.bincount(of, minlength=n)[:n] > 0
                listed = keys.view("i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, n),
                        pa.array(classes[0]),
                        pa.array(classes[1]),
                        pa.array(
                            [k if s else k[:0] for k, s in zip(listed, some, strict=True)],
                            pa.list_(pa.int64()),
                        ),
                        pa.array([s.tobytes() for s in minima.astype(np.uint8)], pa.binary()),
                    ],
                    names=[c.split()[0] for c in SIGNED.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(signed, SIGNED)


def block_pairs(df: DataFrame, node: Column, size: Column, block: int) -> DataFrame:
    """Deal each member of a group to pairs of blocks, so that every two members meet.

    Adds ``low`` and ``high``, the blocks of a pair, and ``own``, the member's block. A
    group of up to ``block`` members is one block. Otherwise there are k blocks by hash and
    a member is in k of the k (k + 1) / 2 pairs.
    """
    blocks = F.ceil(size / block).cast("bigint")
    own = F.pmod(F.xxhash64(node), blocks)
    dealt = df.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    )
    return dealt.withColumns(
        {"low": F.least("own", "other"), "high": F.greatest("own", "other")}
    ).drop("other")


def by_group(
    batches: Iterator[pa.RecordBatch], keys: int
) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal values in the first ``keys`` columns, as one table each."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in range(keys)]
        changed = np.zeros(batch.num_rows, bool)
        changed[0] = True
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        cuts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(column[a].item() for column in columns)
            if held and key != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def spanning_edges(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(near)
    left = np.ones(n, bool)
    edges = []
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            reached = np.flatnonzero(near[at] & left)
            left[reached] = False
            edges += [(at, int(k)) for k in reached]
            queue += reached.tolist()
    return edges


def _estimated_edges(least: float) -> Callable:
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for _, group in by_group(batches, 1):
            ids = np.asarray(group.column("doc_id"))
            if len(ids) < 2:
                continue
            signatures = np.array(
                [np.frombuffer(s, np.uint8) for s in group.column("signature").to_pylist()]
            )
            near = np.zeros((len(ids), len(ids)), bool)
            for k in range(len(ids) - 1):
                same = (signatures[k + 1 :] == signatures[k]).mean(axis=1)
                near[k, k + 1 :] = same >= least
            near |= near.T
            for x, y in spanning_edges(near):
                a.append(int(ids[x]))
                b.append(int(ids[y]))
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
        )

    return edges


def candidate_edges(signed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Edges between texts whose signatures met in a tree and agree enough."""
    forest = signed.select("doc_id", F.explode("keys").alias("key"))
    nodes = forest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = block_pairs(forest.join(nodes, "key"), F.col("doc_id"), F.col("n"), BLOCK)
    # The same texts meet in many trees: equal groups are compared once. A group has at
    # most two blocks, which bounds the list.
    groups = (
        members.groupBy("key", "low", "high")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
        .filter(F.size("ids") > 1)
        .select("ids")
        .distinct()
        .select(F.xxhash64("ids").alias("group_id"), F.explode("ids").alias("doc_id"))
    )
    n = TREES * prefix_length()
    spread = (threshold * (1 - threshold) / n) ** 0.5
    least = threshold - _DEVIATIONS * spread
    return (
        groups.join(signed.select("doc_id", "signature"), "doc_id")
        .select("group_id", "doc_id", "signature")
        .repartition("group_id")
        .sortWithinPartitions("group_id")
        .mapInArrow(_estimated_edges(least), "a bigint, b bigint")
        .distinct()
    )


def shingle_sets(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Replace ``text`` by ``shingles``: the sorted different shingle hashes, 64 bits each."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index("text"))
            for rows, data, offsets in text_slices(column):
                n = rows.stop - rows.start
                words, owners = words_of(data, offsets)
                shingles, of = shingles_of(words, owners, n, size)
                cuts = np.searchsorted(of, np.arange(n + 1))
                sets = [
                    np.unique(shingles[a:b]).tobytes()
                    for a, b in zip(cuts, cuts[1:], strict=False)
                ]
                part = batch.slice(rows.start, n)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), pa.array(sets, pa.binary())],
                    names=[*(f.name for f in kept), "shingles"],
                )

    return docs.mapInArrow(hashed, f"{schema}, shingles binary")


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """The Jaccard similarity of every two different sets of one group, exactly.

    Only values that several sets share are counted, some columns of the incidence matrix
    at a time.
    """
    n = len(sets)
    values = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(values) else new
    owners, column = owners[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    common = np.zeros((n, n))
    width = int(column.max()) + 1 if len(column) else 0
    for first in range(0, width, _SHARED_COLUMNS):
        a, b = np.searchsorted(column, [first, first + _SHARED_COLUMNS])
        held = np.zeros((n, min(_SHARED_COLUMNS, width - first)), np.float32)
        held[owners[a:b], column[a:b] - first] = 1
        common += held @ held.T
    sizes = np.array([len(s) for s in sets], float)
    union = sizes[:, None] + sizes[None, :] - common
    return common / np.maximum(union, 1)


LINKS = "doc_id bigint, links array<bigint>, forest array<bigint>"


def _verified_links(threshold: float) -> Callable:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("links", pa.list_(pa.int64())),
                ("forest", pa.list_(pa.int64())),
            ]
        )
        for (_, low, high), group in by_group(batches, 3):
            ids = np.asarray(group.column("doc_id"))
            own = np.asarray(group.column("own"))
            sets = [np.frombuffer(s, "<u8") for s in group.column("shingles").to_pylist()]
            near = similarities(sets) >= threshold - 1e-12
            np.fill_diagonal(near, False)
            if low != high:
                near &= own[:, None] != own[None, :]
            tree: dict[int, list[int]] = {}
            for x, y in spanning_edges(near):
                tree.setdefault(x, []).append(int(ids[y]))
            for k in np.flatnonzero(near.any(axis=1)).tolist():
                out.append(
                    {"doc_id": ids[k], "links": ids[near[k]], "forest": tree.get(k, [])}
                )
            if len(out) > 2000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return verify


def verified_links(
    docs: DataFrame, nodes: DataFrame, edges: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """The links of every text within a component of candidate edges, by exact similarity.

    ``nodes`` says in which document a text is (``copy_of``) and which it is there (its
    class). Rows of one text, from different block pairs, list different links; ``forest``
    are links of a spanning forest.
    """
    groups = components(edges)
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    members = (
        groups.join(sizes, "label")
        .join(nodes, "node")
        .select("node", "label", "n", F.col("copy_of").alias("doc_id"), *_CLASS)
    )
    # A document may have several rows, and texts: only the one of the class is meant.
    held = members.select("doc_id", "node", "label", "n", *[F.col(c).alias(f"of_{c}") for c in _CLASS])
    texts = with_class(docs.join(held, "doc_id")).filter(
        reduce(Column.__and__, [F.col(c) == F.col(f"of_{c}") for c in _CLASS])
    )
    # Texts of a class have the same words, so any of them does.
    texts = texts.groupBy(F.col("node").alias("doc_id"), "label", "n").agg(
        F.min("text").alias("text")
    )
    dealt = block_pairs(shingle_sets(texts), F.col("doc_id"), F.col("n"), VERIFY_BLOCK)
    return (
        dealt.select("label", "low", "high", "own", "doc_id", "shingles")
        .repartition("label", "low", "high")
        .sortWithinPartitions("label", "low", "high")
        .mapInArrow(_verified_links(threshold), LINKS)
        .withColumnRenamed("doc_id", "node")
    )


_CLASS = ("class_a", "class_b")


def with_class(docs: DataFrame, names: tuple[str, str] = _CLASS) -> DataFrame:
    """``docs`` with the class of each row's word sequence; null if it has no word."""
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, *(StructField(n, LongType()) for n in names)])

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(at)):
                n = rows.stop - rows.start
                words, owners = words_of(data, offsets)
                none = np.bincount(owners, minlength=n)[:n] == 0
                part = batch.slice(rows.start, n)
                hashes = [
                    pa.array(sequence_hashes(words, owners, n, seed).view("i8"), mask=none)
                    for seed in (1, 2)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *hashes], names=[*batch.schema.names, *names]
                )

    return docs.mapInArrow(classed, schema)


@dataclass(frozen=True)
class Groups:
    """``rows``: each row with a ``doc_id``, and the class of its words (null without any).

    ``nodes`` has each class once: ``node``, the least document that has it (``copy_of``),
    its group (``label`` and its least document ``class_id``) and its number of links.
    """

    rows: DataFrame
    nodes: DataFrame


def find_groups(docs: DataFrame, threshold: float = THRESHOLD) -> Groups:
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stored(sign(ids.filter("doc_id is not null")), "signatures")
    worded = signed.filter(F.size("keys") > 0)
    # Numbered and written: both sides of joins are shuffled, so a hot class can be split.
    classes = stored(
        worded.groupBy(*_CLASS)
        .agg(F.min("doc_id").alias("copy_of"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    # All rows of a class have one signature; the first row's is read.
    alone = (
        worded.join(classes.withColumnRenamed("copy_of", "doc_id"), ["doc_id", *_CLASS])
        .select(F.col("node").alias("doc_id"), "keys", "signature")
        .dropDuplicates(["doc_id"])
    )
    edges = stored(candidate_edges(alone, threshold), "candidates")
    links = stored(verified_links(ids, classes, edges, threshold), "links")
    joined = components(links.select(F.col("node").alias("a"), F.explode("forest").alias("b")))
    counts = links.groupBy("node").agg(F.sum(F.size("links")).alias("n_links"))
    labelled = stored(
        classes.join(joined, "node", "left")
        .join(counts, "node", "left")
        .select(
            *_CLASS, "node", "copy_of", F.coalesce("label", "node").alias("label"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        ),
        "labelled",
    )
    least = labelled.groupBy("label").agg(F.min("copy_of").alias("class_id"))
    nodes = stored(labelled.join(least, "label"), "nodes")
    has_words = F.size("keys") > 0
    rows = signed.select(
        "doc_id", *[F.when(has_words, F.col(c)).alias(c) for c in _CLASS]
    )
    return Groups(rows, nodes)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: its class and its number of links.

    Words are runs of characters other than ASCII white space, as they are written. A text
    of one to four words has one shingle, all its words. Two texts are linked if their sets
    of shingles have a Jaccard similarity of ``threshold`` or more.

    ``copy_of`` is the smallest ``doc_id`` with the same words, ``class_id`` the smallest in
    the connected group, ``n_links`` the number of other texts (each counted once, however
    many copies it has) that the row's text is linked to. Texts without a word, null
    included, are linked to nothing and are no copies of each other. Rows that repeat a
    ``doc_id`` with other words are texts of their own, so each row has its own result; rows
    without ``doc_id`` take no part, and their class is null. Other columns are ignored.
    """
    found = find_groups(docs, threshold)
    nodes = found.nodes.select(*_CLASS, "copy_of", "class_id", "n_links")
    rows = found.rows.join(nodes, list(_CLASS), "left")
    without = docs.filter(F.col("doc_id").cast("bigint").isNull()).select(
        *[F.lit(None).cast("bigint").alias(c) for c in ("doc_id", "copy_of", "class_id")],
        F.lit(0).cast("bigint").alias("n_links"),
    )
    return rows.select(
        "doc_id",
        F.coalesce("copy_of", "doc_id").alias("copy_of"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    ).union(without)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, of which each group keeps one.

    It is a row of the group's smallest ``doc_id``; of several such texts or equal rows, one
    stays. Rows without ``doc_id``, and rows without a word, all stay.
    """
    found = find_groups(docs, threshold)
    firsts = (
        found.nodes.filter("copy_of = class_id")
        .groupBy("label")
        .agg(F.min_by(F.struct("copy_of", *_CLASS), "node").alias("first"))
        .select("first.*")
    )
    names = [free_name(n, docs.columns) for n in _CLASS]
    key = free_name("id", docs.columns)
    keyed = with_class(docs, (names[0], names[1])).withColumn(key, F.col("doc_id").cast("bigint"))
    apart = F.col(key).isNull() | F.col(names[0]).isNull()
    kept = firsts.toDF(key, *names)
    return (
        keyed.filter(~apart)
        .join(kept, [key, *names], "left_semi")
        .dropDuplicates([key, *names])
        .select(docs.columns)
        .union(keyed.filter(apart).select(docs.columns))
    )
