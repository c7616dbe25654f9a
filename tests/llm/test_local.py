"""Parts without Spark, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from txlake.llm import contamination, packing, run_index, token_store
from txlake.llm.html_extraction import Weights, best_region, main_text
from txlake.llm.near_duplicates import prefix_length, similarities
from txlake.llm.pairwise_quality import fit_ranking
from txlake.llm.quality_rules import LineModel, viterbi
from txlake.llm.tokens import Encoder, vocabulary_path


def test_encoder_equals_library():
    encoder = Encoder(vocabulary_path(), kept_words=50)
    rng = random.Random(1)
    texts = ["", " ", "a  b", "it's don't's.", "foo\nbar,& baz", "x <|endoftext|> y", "\xa0a"]
    texts += ["".join(rng.choice("ab é'!1 \n\tZ.&") for _ in range(rng.randrange(14)))
              for _ in range(2000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = encoder._tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "u4").tolist() == want, text


@pytest.mark.parametrize("bits", [0, 3, 64])
def test_encoder_tells_words_with_one_hash_apart(monkeypatch, bits):
    """Also words that were learned in an earlier batch, and after words were forgotten."""
    from txlake.llm import tokens

    hashes, mix = tokens.span_hashes, tokens.mix
    mask = np.uint64((1 << bits) - 1)
    monkeypatch.setattr(tokens, "span_hashes", lambda *a: hashes(*a) & mask)
    monkeypatch.setattr(tokens, "mix", lambda x: mix(x) & mask)
    encoder = Encoder(vocabulary_path(), kept_words=40)
    rng = random.Random(5)
    for _ in range(30):
        texts = [" ".join(rng.choice(["é", "a\nb", "cat,", "w"]) * rng.randrange(1, 6) + str(rng.randrange(30))
                          for _ in range(rng.randrange(1, 30))) for _ in range(20)]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            want = encoder._tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "u4").tolist() == want, text
        assert len(encoder._known) <= 40 + 600


def test_patterns_use_up_the_histogram():
    rng = random.Random(2)
    for _ in range(100):
        held = {rng.randrange(1, 64): rng.randrange(1, 6) for _ in range(rng.randrange(12))}
        used: Counter[int] = Counter()
        for pattern in packing.plan_patterns(held, 64):
            assert sum(k * n for k, n in pattern.counts.items()) <= 64
            for length, n in pattern.counts.items():
                used[length] += n * pattern.uses
        assert used == Counter(held)


def test_fullest_is_closest():
    rng = random.Random(3)
    for _ in range(50):
        items = [rng.randrange(1, 40) for _ in range(8)]
        longest = max(items)
        rest = sorted(items)
        rest.remove(longest)
        sums = {0}
        for item in rest:
            sums |= {s + item for s in sums}
        best = max(s for s in sums if s <= 64 - longest)
        taken = packing.fullest(Counter(items), 64)
        assert sum(k * n for k, n in taken.items()) == best + longest


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
def test_minimal_hash_is_a_permutation(n):
    hashes = token_store.key_hash(np.arange(n) * 7 - 3, np.zeros(n, int))
    slots = token_store.find_slots(hashes, token_store.build_minimal_hash(hashes), max(n, 1))
    assert sorted(slots.tolist()) == list(range(n))


def test_matching_statistics_and_classes():
    rng = random.Random(5)
    for _ in range(5):
        held = sorted({"".join(rng.choice("ab\0") for _ in range(rng.randrange(30, 60)))
                       for _ in range(10)})
        matrix = np.zeros((len(held), 60), np.uint8)
        for k, text in enumerate(held):
            matrix[k, : len(text)] = list(text.encode())
        lengths = np.array([len(t) for t in held])
        index = run_index.build_run_index(matrix, lengths, 30)
        asked = ["".join(rng.choice("abc\0") for _ in range(20)) + held[0][3:33], held[-1]]
        queries = np.zeros((2, 60), np.uint8)
        for k, text in enumerate(asked):
            queries[k, : len(text)] = list(text.encode())
        matched, rows = run_index.matching_statistics(index, queries, np.array([len(a) for a in asked]))
        for k, text in enumerate(asked):
            for at in range(len(text)):
                n = 0
                while at + n < len(text) and any(text[at : at + n + 1] in h for h in held):
                    n += 1
                assert matched[k, at] == n
                if n:
                    string, offset = run_index.locate(index, int(rows[k, at]))
                    assert held[string][offset : offset + n] == text[at : at + n]


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(7)
    words = [f"w{k}" for k in range(50)]
    texts = [" ".join(rng.choices(words, [1 / (k + 1) for k in range(50)], k=rng.randrange(3, 25)))
             for _ in range(200)]
    index = contamination.build_item_index(list(range(200)), texts)
    for _ in range(30):
        query = np.unique(rng.sample(range(len(index.terms)), rng.randrange(1, 25)))
        scores = np.zeros(200)
        for t in query:
            some = slice(index.first[t], index.first[t + 1])
            np.add.at(scores, index.items[some], index.impacts[some])
        for threshold in (0.3, 0.7):
            found = {item for item, _ in contamination.search(index, query, threshold)}
            assert found == set(np.flatnonzero(scores >= threshold - 1e-9).tolist())


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(8)
    model = LineModel(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
    n_lines = np.array([3, 0, 5, 1])
    scores = rng.normal(size=9)
    labels = viterbi(scores, n_lines, model)
    at = 0
    for n in n_lines:
        def score(path, at=at):
            total = model.start[path[0]] + sum(scores[at + k] for k in range(len(path)) if path[k])
            return total + sum(model.change[a, b] for a, b in zip(path, path[1:], strict=False))

        if n:
            paths = [[(p >> k) & 1 for k in range(n)] for p in range(1 << n)]
            assert labels[at : at + n].tolist() == max(paths, key=score)
        at += n


def test_best_region_is_the_largest_sum():
    rng = random.Random(9)
    for _ in range(100):
        scores = [rng.randrange(-5, 6) for _ in range(12)]
        first, end = best_region(scores)
        sums = [sum(scores[a:b]) for a in range(12) for b in range(a, 13)]
        assert sum(scores[first:end]) == max(0, *sums)


def test_main_text():
    page = (
        "<html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<header>Site</header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use</div>"
        "<article><h1>Title &amp; more</h1><p>First  <b>bold</b>\ntext here.<p>1 &lt; 2"
        "<aside>beside</aside></article><section id=comments><p>I like it</p></section>"
        "<footer>&copy; us</footer><form><label>mail</label></form></bo"
    )
    assert main_text(page, Weights({})) == "Title & more\nFirst bold text here.\n1 < 2"
    for empty in (None, "", "<p>", "<!-- x", "<script>x"):
        assert main_text(empty, Weights({})) == ""


def test_similarities_are_exact():
    rng = np.random.default_rng(10)
    sets = [np.unique(rng.integers(0, 30, n).astype(np.uint64)) for n in (0, 3, 10, 30)]
    got = similarities(sets)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            if a == b:
                continue
            union = len(np.union1d(x, y))
            assert got[a, b] == pytest.approx(len(np.intersect1d(x, y)) / max(union, 1))
    assert 1 - (1 - 0.8 ** prefix_length()) ** 40 >= 0.9999


def test_ranking_separates_and_survives_one_kind():
    x = np.array([[0.0], [0.1], [0.9], [1.0]])
    scores = fit_ranking(x, np.array([0, 0, 1, 1])).score(x)
    assert (scores >= 0.3).tolist() == [False, False, True, True]
    assert (fit_ranking(x, np.ones(4)).score(x) >= 0.3).all()
