"""The Merkle manifest against a plain recursive tree, and DuckDB."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from compare import assert_same

import __spark_entry__ as contract
from txlake.llm.merkle_manifest import audit, build_manifest, fold, prove

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx int"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def sized(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, at):
    """The root of ``nodes`` and the siblings on the way of node ``at``."""
    proof = []
    while len(nodes) > 1:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        proof += [d for k, d in enumerate(run) if k != at % 8]
        nodes = [digest(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], proof


def refold(nodes, at, leaf):
    return climb([*nodes[:at], leaf, *nodes[at + 1 :]], at)[0]


def expected(rows):
    trees = {}
    for row in rows:
        leaf = digest(*map(sized, row[:5]))
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf, row))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    held = {name: sorted(trees[name], key=lambda x: x[:3]) for name in names}
    subroots = [climb([x[2] for x in held[name]], 0)[0] for name in names]
    found = []
    for k, name in enumerate(names):
        leaves = [x[2] for x in held[name]]
        for at, (_, _, leaf, row) in enumerate(held[name]):
            subroot, inner = climb(leaves, at)
            root, outer = climb(subroots, k)
            changed = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = None if row[4] is None else row[4].translate(LOWER)
                changed = digest(*map(sized, (*row[:4], text)))
            folded = refold(subroots, k, refold(leaves, at, changed))
            found.append(
                (row[0], leaf, subroot, root, digest(*inner, *outer), folded, folded == root)
            )
    return sorted(found, key=repr)


def rows_of(n, n_langs, seed=3):
    draw = random.Random(seed)
    rows = [
        (draw.choice([None, draw.randrange(n)]) if k % 50 == 0 else k, f"s{k % 3}",
         None if k % 3 == 0 else f"l{draw.randrange(n_langs)}", k, f"Text {k} É", "clash", 1)
        for k in range(n)
    ]
    rows += [(7, None, "l0", None, None, None, None), (9, "", "", 0, "", None, None)]
    return rows + [(5, "s", None, 4, "Same", "t", 2)] * (n // 3)  # a third is one row


@pytest.mark.parametrize(
    "n, n_langs, block_levels", [(0, 1, 4), (1, 1, 4), (150, 20, 1), (150, 90, 2), (6000, 2, 4)]
)
def test_manifest(spark, n, n_langs, block_levels):
    rows = rows_of(n, n_langs) if n > 1 else [(4, "s", "en", 1, "A", "t", 1)][:n]
    found = audit(build_manifest(spark.createDataFrame(rows, SCHEMA), block_levels)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(rows)


def test_proofs_fold_to_the_root(spark, sample):
    manifest = build_manifest(sample)
    asked = manifest.leaves.filter("doc_id % 7 = 0")
    proofs = prove(manifest, asked).collect()
    assert len(proofs) == asked.count() > 20
    for row in proofs:
        assert fold(row["leaf"], row["digits"], row["proof"]) == row["root"]
        assert fold(digest(row["leaf"]), row["digits"], row["proof"]) != row["root"]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    name, at = "op13_merkle_manifest", f"/root/testdata/{sf}"
    found = contract.queries()[name](spark, at)
    assert assert_same(found, contract.oracle_sql()[name], at) > 0
