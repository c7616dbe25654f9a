"""Counts and features of texts and their lines, vectorised over a batch."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from txlake.llm.text import SPACE, mix, span_hashes, spans

#: The characters that the base rules count as symbols.
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[*b"#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[[*b"!?"]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".!?:;\"')"]] = True
_MARKUP = np.zeros(256, bool)
_MARKUP[[*b"{}[]()=_/\\~^`@+"]] = True

LINE_FEATURES = (
    "bias",
    "symbols",
    "some_symbols",
    "many_symbols",
    "upper",
    "mostly_upper",
    "digits",
    "shouts",
    "many_shouts",
    "markup",
    "repeated_word",
    "many_repeated",
    "short",
    "long",
    "ends_sentence",
    "odd_word_length",
    "few_distinct",
    "duplicate",
)


@dataclass(frozen=True)
class Lines:
    """The lines with a word of a batch of texts, in order; ``texts`` says whose they are."""

    texts: np.ndarray
    n_lines: np.ndarray
    n_words: np.ndarray
    duplicate: np.ndarray
    features: np.ndarray
    word_hashes: np.ndarray
    word_texts: np.ndarray


def _per_span(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=total[1:])
    return (total[ends] - total[starts]).astype(np.int64)


def _repeats(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (group, value) pairs: is there an equal one earlier, and is there any other?"""
    keys = mix(values + mix(groups.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    earlier, other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:][same]] = True
    other[order[1:][same]] = True
    other[order[:-1][same]] = True
    return earlier, other


def line_table(data: np.ndarray, offsets: np.ndarray) -> Lines:
    n_texts = len(offsets) - 1
    space = SPACE[data]
    starts, ends, texts = spans(space, offsets)
    hashes = span_hashes(data, starts, ends)
    # Whole lines, with the white space in them, are what is compared.
    line_starts, line_ends, line_texts = spans(data == 10, offsets)
    of_word = np.searchsorted(line_starts, starts, side="right") - 1
    n_words = np.bincount(of_word, minlength=len(line_starts))
    held = np.flatnonzero(n_words)
    rank = np.cumsum(n_words > 0) - 1
    of_word = rank[of_word]
    line_starts, line_ends, line_texts = line_starts[held], line_ends[held], line_texts[held]
    n_words = n_words[held]
    n = len(held)
    duplicate, _ = _repeats(line_texts, span_hashes(data, line_starts, line_ends))

    chars = np.maximum(1, _per_span(~space & ((data & 0xC0) != 0x80), line_starts, line_ends))
    letters = _per_span(_LETTER[data], line_starts, line_ends)
    symbols = _per_span(_SYMBOLS[data], line_starts, line_ends) / n_words
    upper = _per_span(_UPPER[data], line_starts, line_ends) / np.maximum(1, letters)
    digits = _per_span(_DIGIT[data], line_starts, line_ends) / chars
    shouts = _per_span(_SHOUT[data], line_starts, line_ends) / n_words
    markup = _per_span(_MARKUP[data], line_starts, line_ends) / n_words
    first_word = np.searchsorted(of_word, np.arange(n))
    last_word = first_word + n_words - 1
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    repeated = np.bincount(of_word, weights=again, minlength=n)[:n] / n_words
    seen, _ = _repeats(of_word, hashes)
    distinct = 1 - np.bincount(of_word, weights=seen, minlength=n)[:n] / n_words
    last_bytes = data[ends[last_word] - 1] if n else np.zeros(0, np.uint8)
    word_length = chars / n_words
    features = np.stack(
        [
            np.ones(n),
            np.minimum(symbols, 1),
            symbols > 0.1,
            symbols > 0.5,
            np.minimum(upper, 1),
            upper > 0.6,
            np.minimum(4 * digits, 1),
            np.minimum(shouts, 1),
            shouts > 0.3,
            np.minimum(markup, 1),
            np.minimum(repeated, 1),
            repeated > 0.3,
            n_words < 4,
            n_words > 15,
            _STOP[last_bytes],
            (word_length < 2) | (word_length > 14),
            (distinct < 0.3) & (n_words > 10),
            duplicate,
        ],
        axis=1,
    ).astype(np.float64)
    n_lines = np.bincount(line_texts, minlength=n_texts)[:n_texts]
    return Lines(line_texts, n_lines, n_words, duplicate, features, hashes, texts)


def base_counts(data: np.ndarray, offsets: np.ndarray, lines: Lines) -> dict[str, np.ndarray]:
    """Exact counts of each text: words, their characters, symbols, repeated lines and words."""
    n = len(offsets) - 1
    words, texts = lines.word_hashes, lines.word_texts
    inside = ~SPACE[data] & ((data & 0xC0) != 0x80)
    window = np.flatnonzero(texts[:-2] == texts[2:]) if len(texts) > 2 else np.zeros(0, int)
    value = mix(mix(words[window]) + words[window + 1] if len(window) else words[:0])
    if len(window):
        value = mix(value + words[window + 2])
    _, again = _repeats(texts[window], value)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[window[again] + k] = True
    return {
        "n_words": np.bincount(texts, minlength=n)[:n],
        "word_chars": _per_span(inside, offsets[:-1], offsets[1:]),
        "n_symbols": _per_span(_SYMBOLS[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": np.bincount(lines.texts, weights=lines.duplicate, minlength=n)[
            :n
        ].astype(np.int64),
        "n_repeat_words": np.bincount(texts, weights=covered, minlength=n)[:n].astype(np.int64),
    }
