"""Personal data: base rules against plain patterns, the chain by held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest

import __spark_entry__ as contract
from txlake.llm import personal_data as pii
from txlake.llm.personal_data import find_personal_data, labelled_table, mask_personal_data, train_tagger

SF = "/root/testdata/sf0.001"
KINDS = ("email", "ip", "card", "phone")


@pytest.fixture(scope="module")
def tagger(spark):
    return train_tagger(labelled_table(spark))


def check_digit(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_base(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and check_digit(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(found)


def listed(found):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def expected(text):
    found = plain_base(text or "")
    counts = [sum(k == kind for _, k, _ in found) for kind in range(4)]
    return (*counts, hashlib.sha256(listed(found).encode()).hexdigest())


def test_base_rules(spark, tagger):
    draw = random.Random(4)
    pieces = ["a@b.c", "@", ".", "a", "-", "1.2.3.4", "300.1.2.3", "+", "4111111111111111", " ", "(", ")",
              "+1 (017) 555-7713", "7", "12", "é", "\n", "x@y", "%", " ", "4111 1111 1111 1111"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(25))) for _ in range(3000)]
    texts += ["".join(p) for p in product(["a", "@", "b.c", "."], repeat=5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:6] for r in find_personal_data(docs, tagger).collect()}
    assert got == {k: expected(t) for k, t in enumerate(texts)}


def test_query_and_secrets(spark, sample, tagger):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in find_personal_data(docs, tagger).collect()}
    secrets = 0
    for row in docs.collect():
        text, found = row["text"] or "", got[row["doc_id"]]
        assert tuple(found)[1:6] == expected(text)
        spans = [tuple(s.split(":")) for s in found["spans"].split(",") if s]
        # The base stays, in order, among the others.
        base = listed(plain_base(text)).split(",")
        assert not base[0] or set(base) <= set(found["spans"].split(","))
        assert [(int(a), (*KINDS, "secret").index(k)) for k, a, _ in spans] == sorted(
            (int(a), (*KINDS, "secret").index(k)) for k, a, _ in spans
        )
        for m in re.finditer(r"\b[0-9a-fA-F]{40}\b", text):
            assert ("secret", str(m.start()), str(m.end())) in spans
            secrets += 1
        if not re.search(r"[0-9@]", text):
            assert not spans
    assert secrets > 10
    found = contract.queries()["op12_personal_data"](spark, SF)
    assert found.count() == sample.count()


def test_held_out_lines(spark, tagger):
    right = wrong = missed = 0
    for row in labelled_table(spark, 600, seed=5).collect():
        raw = row["text"].encode()
        data = np.frombuffer(raw, np.uint8)
        found = pii.tagged_spans(data, np.array([0, len(data)]), tagger) if raw else []
        got = {(pii.KINDS[k], len(raw[:a].decode()), len(raw[:b].decode())) for a, k, b in found}
        want = {(m["kind"], m["start"], m["end"]) for m in row["marks"]}
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    f1 = 2 * right / (2 * right + wrong + missed)
    print(f"F1 {f1:.3f} of {right + missed} held-out spans")
    assert f1 > 0.95


def test_viterbi_is_the_best_labelling():
    """Against all labellings of short chains."""
    draw = np.random.default_rng(3)
    n = len(pii.LABELS)
    may_follow, may_start = pii._allowed()
    tagger = pii.Tagger(
        np.zeros((len(pii.CONTEXT), len(pii.FEATURES), n)),
        np.where(may_follow, draw.normal(size=(n, n)), pii._NEVER),
        np.where(may_start, draw.normal(size=n), pii._NEVER),
    )
    lengths = np.array([3, 0, 1, 2, 3])
    scores = draw.normal(size=(lengths.sum(), n))
    got = pii.viterbi(scores, lengths, tagger).tolist()
    at = 0
    for size in lengths.tolist():
        own = scores[at : at + size]

        def total(path):
            return sum(
                own[k][x] + (tagger.start[x] if k == 0 else tagger.change[path[k - 1], x])
                for k, x in enumerate(path)
            )

        assert tuple(got[at : at + size]) == max(product(range(n), repeat=size), key=total)
        at += size


def test_odd_rows(spark, odd_docs, no_docs, tagger):
    clash = odd_docs.withColumnRenamed("chunk", "spans")
    rows = find_personal_data(clash, tagger).collect()
    assert len(rows) == odd_docs.count() and not any(r["n_email"] for r in rows)
    assert find_personal_data(no_docs, tagger).count() == 0
    assert mask_personal_data(clash, tagger).columns == clash.columns
    long = "plain words " * 9000 + "é 1.2.3.4 " + "more " * 9000
    docs = spark.createDataFrame([(1, long, "x"), (2, "to a@b.cd, ok", "y"), (3, None, "z")], "doc_id long, text string, spans string")
    masked = {r["doc_id"]: r["text"] for r in mask_personal_data(docs, tagger).collect()}
    assert masked == {1: long.replace("1.2.3.4", "<ip>"), 2: "to <email>, ok", 3: None}
    at = long.index("1.2")
    assert find_personal_data(docs, tagger).filter("doc_id = 1").first()["spans"] == f"ip:{at}:{at + 7}"
    nothing = train_tagger(labelled_table(spark).limit(0))
    assert find_personal_data(docs, nothing).agg({"n_added": "sum"}).first()[0] == 0
