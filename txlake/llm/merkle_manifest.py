"""Merkle manifest of a dataset: digests of rows, a digest of the whole, and proofs.

1. Every row is a leaf: the SHA-256 of its fields. The texts are read once; all that follows
   works on digests.
2. Leaves are ranked within their tree (a language) by a range-partitioned sort. Row numbers
   within a range and the sizes of the ranges before give ranks, so no task holds a tree.
3. Runs of ``FANOUT`` nodes become their parent's digest, until one node is left. This is
   done by blocks of ``FANOUT ** BLOCK_LEVELS`` nodes, a task at a time, and then for the
   tops of the blocks, so a tree of any size takes a few rounds. Each block keeps records
   from a digest to the digests of its children. Equal subtrees have one record.
4. The digests of all trees, in the order of their names, are the leaves of one more tree.
5. A proof is found by descent: from the root, each digit of a leaf's rank selects a child
   of the current digest's record, and the children that are not selected are collected.
   Segments come root first; a proof has them in reverse. Requests of a block descend
   together, below the path that their block's top got in the round before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.working import shuffle_partitions, stored

FANOUT = 8
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TREE = "lang"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RECORD = "tree bigint, block bigint, digest string, children array<string>, top boolean"
_PATH = "tree bigint, idx bigint, digest string, root string, subroot string, path array<array<string>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: one row for each document, with its tree and rank (``idx``).

    ``trees`` and ``top`` are the rounds of records, lowest first, of the trees and of the
    tree over them; ``subroots`` has one row for each tree. A block of records covers
    ``block_levels`` levels.
    """

    leaves: DataFrame
    subroots: DataFrame
    trees: list[DataFrame]
    top: list[DataFrame]
    block_levels: int = BLOCK_LEVELS


def sized(value: Column) -> Column:
    """``-`` for null, else the UTF-8 size, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[sized(v) for v in fields.values()]), 256)


def folded_text(key: Column, text: Column) -> tuple[Column, Column]:
    """Which rows the trial tampers with, and their text with ``A-Z`` in lower case."""
    chosen = F.crc32(key.cast("string").cast("binary")) % 3 == 0
    return F.coalesce(chosen, F.lit(False)), F.translate(text, _UPPER, _UPPER.lower())


def ranked(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``position``, the place of each row in the order of ``keys``, nulls first.

    Rows with equal keys get places next to each other, and may lie in several ranges, so
    neither a frequent key nor a repeated row fills a task.
    """
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col("__row")]
    placed = stored(
        df.withColumn("__row", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(df.sparkSession), *order)
        .withColumn("__range", F.spark_partition_id()),
        "ranges",
    )
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # One row for each range: their number is a setting, whatever the table's size.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy("__range").orderBy(*order)
    return (
        placed.join(F.broadcast(offsets), "__range")
        .withColumn("position", F.col("__offset") + F.row_number().over(inside) - 1)
        .drop("__offset", "__row")
    )


def _parents(digests: list[str]) -> tuple[list[str], list[list[str]]]:
    runs = [digests[k : k + FANOUT] for k in range(0, len(digests), FANOUT)]
    return [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs], runs


Group = Callable[..., pa.Table]


def _build_block(block_levels: int) -> Group:
    def build(key: tuple, nodes: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        nodes = nodes.sort_by("idx")
        digests = nodes.column("digest").to_pylist()
        left = nodes.column("n")[0].as_py()
        records: dict[str, list[str]] = {}
        for _ in range(block_levels):
            if left == 1:
                break
            digests, runs = _parents(digests)
            records.update(zip(digests, runs))
            left = -(-left // FANOUT)
        held = list(records)
        return pa.table(
            {
                "tree": pa.array([tree] * len(held), pa.int64()),
                "block": pa.array([block] * len(held), pa.int64()),
                "digest": pa.array(held, pa.string()),
                "children": pa.array(list(records.values()), pa.list_(pa.string())),
                "top": pa.array([d == digests[0] for d in held], pa.bool_()),
            }
        )

    return build


def _block_of(block_levels: int) -> Column:
    return F.floor(F.col("idx") / FANOUT**block_levels).cast("bigint").alias("block")


def grow(
    nodes: DataFrame, block_levels: int = BLOCK_LEVELS
) -> tuple[DataFrame, list[DataFrame]]:
    """Records of the trees over ``nodes`` (``tree, idx, digest, n``), round by round.

    ``n`` is the number of nodes of the tree. Returns also ``tree, digest`` of all roots.
    """
    spark = nodes.sparkSession
    rounds: list[DataFrame] = []
    roots = nodes.filter("n = 1").select("tree", "digest")
    left = nodes.filter("n > 1")
    while not left.isEmpty():
        records = stored(
            left.withColumn("block", _block_of(block_levels))
            .groupBy("tree", "block")
            .applyInArrow(_build_block(block_levels), _RECORD),
            "records",
        )
        rounds.append(records)
        top = records.filter("top")
        tops = stored(
            # The largest block number of a tree tells how many nodes are left of it.
            top.join(top.groupBy("tree").agg((F.max("block") + 1).alias("n")), "tree")
            .select("tree", F.col("block").alias("idx"), "digest", "n"),
            "tops",
        )
        roots = roots.union(tops.filter("n = 1").select("tree", "digest"))
        left = tops.filter("n > 1")
    return roots, rounds


def build_manifest(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The leaves and records of all rows of ``docs``.

    A leaf is made of the columns ``FIELDS``; others, whatever their names, do not matter.
    Rows without ``doc_id`` come first in their tree; rows with equal ``doc_id`` stand in
    the order of their digests, so that equal rows are interchangeable. A null language has
    a tree of its own. An empty table has neither leaves nor a root.
    """
    columns = {name: F.col(name) for name in FIELDS}
    tampers, folded = folded_text(columns["doc_id"], columns["text"])
    digests = stored(
        docs.select(*FIELDS).select(
            TREE,
            "doc_id",
            leaf_digest(columns).alias("leaf"),
            F.when(tampers, leaf_digest(columns | {"text": folded})).alias("tampered"),
        ),
        "leaves",
    )
    placed = stored(ranked(digests, TREE, "doc_id", "leaf"), "ranked")
    # Which trees a range holds: at most one row more than there are ranges and trees.
    parts = placed.groupBy("__range", TREE).agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("n")
    )
    trees = ranked(
        parts.groupBy(TREE).agg(F.min("first").alias("first"), F.sum("n").alias("n")), TREE
    ).select(F.col(TREE).alias("__tree"), "first", "n", F.col("position").alias("tree"))
    # Joined by range and tree, not by tree alone: a frequent language has many ranges.
    named = stored(
        parts.select("__range", F.col(TREE).alias("__lang")).join(
            trees, F.col("__lang").eqNullSafe(F.col("__tree"))
        ),
        "trees",
    ).withColumnRenamed("__range", "__part")
    leaves = stored(
        placed.join(
            named,
            (F.col("__range") == F.col("__part")) & F.col(TREE).eqNullSafe(F.col("__lang")),
        ).select(
            "doc_id",
            TREE,
            "leaf",
            "tampered",
            "tree",
            (F.col("position") - F.col("first")).alias("idx"),
            "n",
        ),
        "placed",
    )
    nodes = leaves.select("tree", "idx", F.col("leaf").alias("digest"), "n")
    roots, rounds = grow(nodes, block_levels)
    subroots = stored(roots, "subroots")
    _, top = grow(_tree_nodes(subroots, "digest"), block_levels)
    return Manifest(leaves, subroots, rounds, top, block_levels)


def _tree_nodes(subroots: DataFrame, *columns: str) -> DataFrame:
    """All trees as the leaves of the one tree over them."""
    return subroots.select(
        F.lit(0).cast("bigint").alias("tree"),
        F.col("tree").alias("idx"),
        *columns,
        F.lit(subroots.count()).cast("bigint").alias("n"),
    )


Path = tuple[str, list[list[str]]]


def _descend(records: dict[str, list[str]], top: str, idx: int, levels: int) -> Path:
    """From ``top``, by the digits of ``idx``: the node reached and what was not selected.

    The segments come root first. A segment is the run without the selected child.
    """
    path = []
    at = top
    for level in range(levels - 1, -1, -1):
        run = records[at]
        digit = idx // FANOUT**level % FANOUT
        path.append(run[:digit] + run[digit + 1 :])
        at = run[digit]
    return at, path


def _levels(n: int, most: int) -> int:
    """How many levels a block has in a tree of ``n`` nodes."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


Step = tuple[dict, Path, tuple]


def _requests(both: pa.Table, wanted: pa.Table, block_levels: int) -> Iterator[Step]:
    """Each request of a block with its whole path, root first, and its block's roots."""
    if wanted.num_rows == 0:
        return
    records, above = _split(both)
    held = dict(zip(records.column("digest").to_pylist(), records.column("children").to_pylist()))
    top = above.slice(0, 1).to_pylist()[0]
    for row in wanted.to_pylist():
        levels = _levels(row["n"], block_levels)
        at, path = _descend(held, top["digest"], row["idx"] % FANOUT**block_levels, levels)
        yield row, (at, top["path"] + path), (top["root"], top["subroot"])


def _joined(records: DataFrame, above: DataFrame) -> DataFrame:
    """Records of a round with the path to the block's top as rows of the same group."""
    left = records.select("tree", "block", "digest", "children", *_no("root", "subroot"), *_no_path())
    right = above.select(
        "tree", F.col("idx").alias("block"), "digest", F.lit(None).cast("array<string>").alias("children"),
        "root", "subroot", "path",
    )
    return left.union(right)


def _no(*names: str) -> list[Column]:
    return [F.lit(None).cast("string").alias(n) for n in names]


def _no_path() -> list[Column]:
    return [F.lit(None).cast("array<array<string>>").alias("path")]


def _split(both: pa.Table) -> tuple[pa.Table, pa.Table]:
    is_record = both.column("children").is_valid()
    return both.filter(is_record), both.filter(pc.invert(is_record))


def _below(both: pa.Table, wanted: pa.Table, block_levels: int) -> pa.Table:
    rows = [
        {"tree": row["tree"], "idx": row["idx"], "digest": at, "root": roots[0],
         "subroot": roots[1], "path": path}
        for row, (at, path), roots in _requests(both, wanted, block_levels)
    ]
    strings = pa.list_(pa.list_(pa.string()))
    return pa.Table.from_pylist(
        rows,
        pa.schema(
            [("tree", pa.int64()), ("idx", pa.int64()), ("digest", pa.string()),
             ("root", pa.string()), ("subroot", pa.string()), ("path", strings)]
        ),
    )


def _answered(
    records: DataFrame,
    above: DataFrame,
    wanted: DataFrame,
    function: Callable[[pa.Table, pa.Table, int], pa.Table],
    schema: str,
    block_levels: int,
) -> DataFrame:
    """``function`` of each block's records, the path to its top and its requests."""
    return (
        _joined(records, above)
        .groupBy("tree", "block")
        .cogroup(wanted.withColumn("block", _block_of(block_levels)).groupBy("tree", "block"))
        .applyInArrow(lambda key, both, asked: function(both, asked, block_levels), schema)
    )


def _down(
    rounds: list[DataFrame], start: DataFrame, wanted: DataFrame, block_levels: int
) -> DataFrame:
    """Descend all rounds but the lowest, to the tops of those blocks that have requests."""
    paths = start
    for k in range(len(rounds) - 1, 0, -1):
        # Which blocks of the lower rounds are asked for, and how many nodes this round has.
        scale = FANOUT ** (block_levels * k)
        asked = wanted.select(
            "tree",
            F.floor(F.col("idx") / scale).cast("bigint").alias("idx"),
            F.floor((F.col("n") + (scale - 1)) / scale).cast("bigint").alias("n"),
        ).distinct()
        paths = stored(
            _answered(rounds[k], paths, asked, _below, _PATH, block_levels), "paths"
        )
    return paths


def _tree_paths(manifest: Manifest) -> DataFrame:
    """For each tree, the path from the root of all to its own root."""
    subroots = manifest.subroots
    if not manifest.top:  # a single tree, or none
        return subroots.select(
            "tree",
            F.lit(0).cast("bigint").alias("idx"),
            "digest",
            F.col("digest").alias("root"),
            F.col("digest").alias("subroot"),
            F.array().cast("array<array<string>>").alias("path"),
        )
    root = manifest.top[-1].filter("top").select("digest")
    start = root.select(
        F.lit(0).cast("bigint").alias("tree"),
        F.lit(0).cast("bigint").alias("idx"),
        "digest",
        F.col("digest").alias("root"),
        F.lit(None).cast("string").alias("subroot"),
        F.array().cast("array<array<string>>").alias("path"),
    )
    wanted, size = _tree_nodes(subroots), manifest.block_levels
    paths = _down(manifest.top, start, wanted, size)
    found = _answered(manifest.top[0], paths, wanted, _below, _PATH, size)
    return stored(
        found.select(
            F.col("idx").alias("tree"),
            F.lit(0).cast("bigint").alias("idx"),
            "digest",
            "root",
            F.col("digest").alias("subroot"),
            "path",
        ),
        "tree_paths",
    )


def fold(leaf: str, digits: list[int], proof: list[list[str]]) -> str:
    """The root that ``leaf`` leads to: at each level the digest goes among its siblings."""
    for digit, siblings in zip(digits, proof):
        run = siblings[:digit] + [leaf] + siblings[digit:]
        leaf = hashlib.sha256("".join(run).encode()).hexdigest()
    return leaf


def _digits(idx: int, levels: int) -> list[int]:
    return [idx // FANOUT**k % FANOUT for k in range(levels)]


_AUDIT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)
_PROOF = (
    "doc_id bigint, leaf string, subroot string, root string, digits array<int>, "
    "proof array<array<string>>"
)


def _proved(rows: Iterator[Step]) -> Iterator[tuple[dict, str, tuple, list[int], list]]:
    for row, (at, path), roots in rows:
        proof = path[::-1]
        # Rank digits within the tree, then those of the tree among all trees.
        inner = row["levels"]
        digits = _digits(row["idx"], inner) + _digits(row["tree"], len(proof) - inner)
        yield row, at, roots, digits, proof


def _audit(both: pa.Table, wanted: pa.Table, block_levels: int) -> pa.Table:
    out: dict[str, list] = {c.split()[0]: [] for c in _AUDIT.split(", ")}
    for row, at, (root, subroot), digits, proof in _proved(_requests(both, wanted, block_levels)):
        folded = fold(row["tampered"] or at, digits, proof)
        flat = "".join(d for segment in proof for d in segment)
        values = (
            row["doc_id"], at, subroot, root,
            hashlib.sha256(flat.encode()).hexdigest(), folded, folded == root,
        )
        for held, value in zip(out.values(), values):
            held.append(value)
    return pa.table(
        {
            name: pa.array(held, {"doc_id": pa.int64(), "verified": pa.bool_()}.get(name, pa.string()))
            for name, held in out.items()
        }
    )


def _prove(both: pa.Table, wanted: pa.Table, block_levels: int) -> pa.Table:
    rows = [
        {"doc_id": row["doc_id"], "leaf": at, "subroot": subroot, "root": root,
         "digits": digits, "proof": proof}
        for row, at, (root, subroot), digits, proof in _proved(_requests(both, wanted, block_levels))
    ]
    return pa.Table.from_pylist(
        rows,
        pa.schema(
            [("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
             ("root", pa.string()), ("digits", pa.list_(pa.int32())),
             ("proof", pa.list_(pa.list_(pa.string())))]
        ),
    )


def _answer(manifest: Manifest, wanted: DataFrame, function, schema: str) -> DataFrame:
    # A level above n nodes leaves ceil(n / FANOUT).
    depth = sum(((F.col("n") > FANOUT**k).cast("int") for k in range(21)), F.lit(0))
    wanted = wanted.select(
        F.col("doc_id").cast("bigint"), "leaf", "tampered", "tree", "idx", "n", depth.alias("levels")
    )
    size = manifest.block_levels
    blocks = _down(manifest.trees, _tree_paths(manifest), wanted, size)
    if manifest.trees:
        lowest = manifest.trees[0]
    else:  # every tree is a single leaf
        lowest = manifest.leaves.sparkSession.createDataFrame([], _RECORD)
    return _answered(lowest, blocks, wanted, function, schema, size)


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """The proofs of ``leaves`` (rows of ``manifest.leaves``; all by default).

    ``proof`` has the siblings level by level, from the leaf to the root, and ``digits`` the
    place of the node among them; ``fold`` recomputes the root from both.
    """
    return _answer(manifest, manifest.leaves if leaves is None else leaves, _prove, _PROOF)


def audit(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """Each leaf with its roots, the digest of its proof, and whether it still verifies.

    Proofs are folded where they are found, so they are not moved. The leaf that is folded
    is the tampered one where there is one.
    """
    return _answer(manifest, manifest.leaves if leaves is None else leaves, _audit, _AUDIT)
