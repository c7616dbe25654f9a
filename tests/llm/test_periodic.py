"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
from txlake.llm.periodic_runs import find_runs, periodic_runs

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_length=12):
    """(start, length, period) of every maximal stretch, by trying each period."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            stop = at
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            # Stretches of a smaller period came first.
            if stop + q - at >= 2 * q and (at, stop + q) not in found:
                found[at, stop + q] = q
            at = stop
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(min_length, 2 * q))


def repeating(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text, trial=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = repeating(doc_id, words) if trial else words
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, l, q in runs for i in range(s + q, s + l)}
    lines = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def random_words(draw):
    kind = draw.randrange(4)
    n = draw.randrange(60)
    if kind == 0:
        return draw.choices("ab", k=n)
    if kind == 1:  # Fibonacci words have runs of many periods
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    words = draw.choices("abcde", k=n)
    for _ in range(3):
        p, at = draw.randint(1, 9), draw.randrange(n + 1)
        words[at:at] = draw.choices("abcdef", k=p) * draw.randint(2, 6)
    return words


def test_find_runs():
    draw = random.Random(1)
    texts = [random_words(draw) for _ in range(400)]
    owners = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    hashes = np.array([ord(w) for t in texts for w in t], np.uint64)
    found = find_runs(hashes, owners, len(texts))
    got = list(zip(*(x.tolist() for x in (found.texts, found.starts, found.lengths, found.periods))))
    assert got == [(k, *run) for k, t in enumerate(texts) for run in brute_runs(t)]
    assert len(got) > 300


def test_odd_rows(spark, odd_docs, no_docs):
    shown = [c for c in periodic_runs(no_docs).columns if c != "n_words"]
    for trial in (True, False):
        rows = periodic_runs(odd_docs, trial, digests=True).select(shown).collect()
        texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] != 6]
        assert Counter(tuple(r) for r in rows if r["doc_id"] != 6) == Counter(
            expected(d, t, trial) for d, t in texts
        )
        assert [tuple(r)[1:5] for r in rows if r["doc_id"] == 6] == [(1, 0, 30_000, 1)]
    assert periodic_runs(no_docs).count() == 0
    plain = periodic_runs(odd_docs).filter("doc_id = 6").first()
    assert bytes(plain["collapsed"]) == b"word" and plain["runs"] == "0,30000,1\n"


@pytest.mark.parametrize("times", [1, 40])
def test_query(spark, sample, times):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    if times == 1:
        found = contract.queries()["op11_periodic_runs"](spark, SF)
        small = [(d, t) for d, t in rows if len(t or "") < 6000]
    else:  # long texts with a hot word
        draw = random.Random(2)
        small = [(k, " ".join(draw.choices(["x", "x", "y", "z"], k=50 * times))) for k in range(30)]
        docs = spark.createDataFrame(small, "doc_id long, text string")
        found = periodic_runs(docs, trial=True, digests=True).drop("n_words")
    got = {r[0]: tuple(r) for r in found.collect()}
    assert {d: got[d] for d, _ in small} == {d: expected(d, t) for d, t in small}
    assert times > 1 or len(got) == len(rows)
