"""Personal data: base rules, and a conditional random field over the shapes of words.

A linear-chain conditional random field labels every word with the kind of personal data
that it begins or continues, or with none. A word's features tell its shape (digits, signs,
lengths, checks) and whether it is a cue (``phone``, ``token``); its score takes those of the
words around it, too. Weights are learned from a small labelled table. Viterbi decoding
finds the best labels of all lines of a batch at once, word by word, in numpy.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm.text import SPACE, span_hashes, spans, text_slices

#: The kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
LABELS = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))

TRAINING_ROWS = 1500
#: A line is cut into chains before the first plain word of every block of so many words.
CHAIN_WORDS = 512
#: Words whose features a word's score takes.
CONTEXT = (-2, -1, 0, 1, 2)
_NEVER = -40.0

#: The base patterns.
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(rb"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def _table(chars: bytes) -> np.ndarray:
    held = np.zeros(256, bool)
    held[[*chars]] = True
    return held


_DIGITS = b"0123456789"
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_IN_EMAIL = _table(_LETTERS + _DIGITS + b"._%+-@")
_IN_NUMBER = _table(_DIGITS + b" ().+-")
_IS_DIGIT = _table(_DIGITS)
#: Signs that words of prose do not have, besides those at their ends.
_ODD = _table(_DIGITS + b"@+=_/\\:<>[]{}~^()-\"")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_EDGE = b"\"'`.,;:!?#*$%&|<>[]{}=~^"


def luhn(digits: bytes) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = (c - 48) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits_of(found: bytes) -> bytes:
    return bytes(c for c in found if 48 <= c <= 57)


def _small_parts(found: bytes) -> bool:
    return all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in found.split(b"."))


def _is_card(found: bytes) -> bool:
    digits = _digits_of(found)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _is_phone(found: bytes) -> bool:
    return 9 <= len(_digits_of(found)) <= 15


_NUMBERS = ((1, _IP, _small_parts), (2, _CARD, _is_card), (3, _PHONE, _is_phone))


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost matches in a run of characters that an email or the ``@`` may have.

    All of them but ``@`` may stand before it, so a match begins where the last one, or the
    ``@`` before, ended. Every ``@`` is looked at once, so the time is linear.
    """
    free = 0
    at = run.find(b"@")
    while at >= 0:
        if at > free and (found := _DOMAIN.match(run, at)):
            yield free, found.end()
            free = found.end()
        # The part before a next @ cannot reach over this one.
        free = max(free, at + 1)
        at = run.find(b"@", free)


def _runs_around(
    inside: np.ndarray, hits: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of hits of each stretch of ``inside``, within texts, that has one."""
    outside = np.flatnonzero(~inside)
    k = np.searchsorted(outside, hits)
    text = np.searchsorted(offsets, hits, side="right") - 1
    starts = np.maximum(np.append(-1, outside)[k] + 1, offsets[text])
    ends = np.minimum(np.append(outside, len(inside))[k], offsets[text + 1])
    new = np.ones(len(hits), bool)
    new[1:] = starts[1:] != starts[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[first], np.diff(np.append(first, len(hits)))


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, kind and end of what the base patterns find, in bytes of the slice.

    Matches lie within stretches of the characters that they are made of, so only those
    stretches are searched that have an ``@``, or the four digits that every other kind has.
    """
    found = []
    at = np.flatnonzero(data == 64)
    if len(at):
        for a, b, _ in zip(*(x.tolist() for x in _runs_around(_IN_EMAIL[data], at, offsets))):
            found += [(a + s, 0, a + e) for s, e in _emails(data[a:b].tobytes())]
    at = np.flatnonzero(_IS_DIGIT[data])
    if len(at):
        runs = _runs_around(_IN_NUMBER[data], at, offsets)
        for a, b, n in zip(*(x.tolist() for x in runs)):
            if n < 4:
                continue
            run = data[a:b].tobytes()
            for kind, pattern, right in _NUMBERS:
                for m in pattern.finditer(run):
                    if right(m.group()):
                        found.append((a + m.start(), kind, a + m.end()))
    return sorted(found)


#: Words that tell what comes next, by meaning.
_CUES = (
    ("secret", "token key secret password passwd apikey bearer credential passwort clave"),
    ("phone", "phone tel telephone call fax mobile ring cell telefon teléfono téléphone"),
    ("email", "mail email e-mail contact write mailto correo"),
    ("ip", "ip host server address node router ping"),
    ("card", "card visa mastercard payment credit charged tarjeta carte karte"),
    ("at", "at"),
    ("dot", "dot"),
    (
        "count",
        "version page chapter section order invoice isbn year item part figure table no "
        "number id step level line about volume license",
    ),
)
_SHAPES = (
    "bias",
    "plain",
    "upper_initial",
    "digit",
    "digits_1_3",
    "digits_4_8",
    "digits_9_11",
    "digits_12_19",
    "digits_20_up",
    "no_letter",
    "letters_and_digits",
    "hex_16_up",
    "core_16_up",
    "mail_sign",
    "mail_shape",
    "four_parts",
    "four_small_parts",
    "plus",
    "round",
    "square",
    "hyphen",
    "date_or_time",
    "quote",
    "equals",
    "colon",
    "slash",
    "groups_of_four",
    "check_digit",
    "cased_mix",
)
FEATURES = (*_SHAPES, *(f"cue_{name}" for name, _ in _CUES))
_BIT = {name: np.int64(1 << k) for k, name in enumerate(FEATURES)}


def _hash_words(texts: list[str]) -> np.ndarray:
    held = [t.encode() for t in texts]
    ends = np.cumsum([len(t) for t in held])
    data = np.frombuffer(b"".join(held), np.uint8)
    return span_hashes(data, ends - [len(t) for t in held], ends)


def _cue_table() -> tuple[np.ndarray, np.ndarray]:
    listed = [(w, _BIT[f"cue_{name}"]) for name, text in _CUES for w in text.split()]
    hashes = _hash_words([w for w, _ in listed])
    order = np.argsort(hashes)
    return hashes[order], np.array([b for _, b in listed])[order]


_CUE_HASHES, _CUE_BITS = _cue_table()
_STRICT_DATE = re.compile(rb"\d{1,4}[-/]\d{1,2}[-/]\d{1,4}|\d{1,2}:\d\d(:\d\d)?")
_FOURS = re.compile(rb"\d{4}([- .]?\d{4}){0,3}")
_MAIL_SHAPE = re.compile(rb"[\w.%+-]+@[\w-]+(\.[\w-]+)+")
_HEX = re.compile(rb"[0-9a-f]+|[0-9A-F]+")


def _shape(word: bytes) -> int:
    """The features of a word with an odd sign."""
    core = word.strip(_EDGE)
    digits = _digits_of(core)
    n, letters = len(digits), any(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in core)
    parts = core.split(b":")[0].split(b".") if core.count(b".") == 3 else []
    four = len(parts) == 4 and all(p.isdigit() for p in parts)
    on = {
        "digit": n > 0,
        "digits_1_3": 1 <= n <= 3,
        "digits_4_8": 4 <= n <= 8,
        "digits_9_11": 9 <= n <= 11,
        "digits_12_19": 12 <= n <= 19,
        "digits_20_up": n >= 20,
        "no_letter": n > 0 and not letters,
        "letters_and_digits": n > 0 and letters,
        "hex_16_up": len(core) >= 16 and n > 0 and _HEX.fullmatch(core) is not None and letters,
        "core_16_up": len(core) >= 16,
        "mail_sign": b"@" in word,
        "mail_shape": _MAIL_SHAPE.fullmatch(core) is not None,
        "four_parts": four,
        "four_small_parts": four and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        "plus": word.startswith(b"+"),
        "round": b"(" in word or b")" in word,
        "square": b"[" in word or b"]" in word,
        "hyphen": b"-" in core,
        "date_or_time": _STRICT_DATE.fullmatch(core) is not None,
        "quote": b'"' in word,
        "equals": b"=" in word,
        "colon": b":" in word,
        "slash": b"/" in word or b"\\" in word,
        "groups_of_four": _FOURS.fullmatch(core) is not None,
        "check_digit": 12 <= n <= 19 and luhn(digits),
        "cased_mix": n > 0 and core != core.lower() and core != core.upper(),
    }
    return sum(int(_BIT[name]) for name, holds in on.items() if holds)


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The features of each word, as the bits of a number."""
    code = np.full(len(starts), _BIT["bias"])
    if len(starts) == 0:
        return code
    first = data[starts]
    code[(first >= 65) & (first <= 90)] |= _BIT["upper_initial"]
    total = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_ODD[data], out=total[1:])
    odd = total[ends] > total[starts]
    code[~odd] |= _BIT["plain"]
    # Cues are compared in lower case, without one sign at the end (``phone:``).
    last = data[ends - 1]
    bare = ends - ((ends - starts > 1) & np.isin(last, list(b".,;:=!?")))
    hashes = span_hashes(_LOWER[data], starts, bare)
    at = np.minimum(np.searchsorted(_CUE_HASHES, hashes), len(_CUE_HASHES) - 1)
    cue = _CUE_HASHES[at] == hashes
    code[cue] |= _CUE_BITS[at[cue]]
    code[cue] &= ~_BIT["plain"]
    rows = np.flatnonzero(odd)
    if len(rows):
        shapes: dict[bytes, int] = {}
        bits = []
        for a, b in zip(starts[rows].tolist(), ends[rows].tolist()):
            word = data[a:b].tobytes()
            if word not in shapes:
                shapes[word] = _shape(word)
            bits.append(shapes[word])
        code[rows] |= np.array(bits, np.int64)
    return code


def _matrix(codes: np.ndarray) -> np.ndarray:
    return ((codes[:, None] >> np.arange(len(FEATURES))) & 1).astype(float)


def _around(codes: np.ndarray, line: np.ndarray, step: int) -> np.ndarray:
    """The features of the word ``step`` places on in the same line, 0 beyond its ends."""
    out = np.zeros_like(codes)
    n = len(codes)
    if abs(step) >= n:
        return out if step else codes
    here, there = (slice(0, n - step), slice(step, n)) if step >= 0 else (slice(-step, n), slice(0, n + step))
    out[here] = np.where(line[here] == line[there], codes[there], 0)
    return out


@dataclass(frozen=True)
class Tagger:
    """Weights of the chain: ``emission[c, f, l]`` for feature f, at place c of the context,
    of label l; ``change[k, l]`` for neighbouring labels; ``start[l]`` for a chain's first."""

    emission: np.ndarray
    change: np.ndarray
    start: np.ndarray

    def scores(self, codes: np.ndarray, line: np.ndarray) -> np.ndarray:
        """The score of each label for each word."""
        total = np.zeros((len(codes), len(LABELS)))
        held, at = np.unique(codes, return_inverse=True)
        features = np.vstack([_matrix(held), np.zeros(len(FEATURES))])  # none beyond the ends
        places = np.arange(len(codes))
        for c, step in enumerate(CONTEXT):
            other = places + step
            inside = (other >= 0) & (other < len(codes))
            other = np.where(inside, other, 0)
            inside &= line[other] == line
            total += (features @ self.emission[c])[np.where(inside, at[other], len(held))]
        return total


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Which labels may follow each other, and begin: a part continues its own kind alone."""
    n = len(LABELS)
    change = np.ones((n, n), bool)
    start = np.ones(n, bool)
    for k, label in enumerate(LABELS):
        if label.startswith("I-"):
            start[k] = False
            for j, before in enumerate(LABELS):
                change[j, k] = before[2:] == label[2:] and before != "O"
    return change, start


def _steps(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For word 0, 1, ...: the chains that have it, longest first, and the rows of it."""
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    held = -lengths[order]
    for k in range(int(lengths.max(initial=0))):
        alive = int(np.searchsorted(held, -k, side="left"))
        yield order[:alive], first[:alive] + k


def viterbi(scores: np.ndarray, lengths: np.ndarray, tagger: Tagger) -> np.ndarray:
    """The best labels of all chains; ties go to the label that comes first."""
    labels = np.zeros(len(scores), np.int8)
    best = np.zeros((len(lengths), len(LABELS)))
    came: list[np.ndarray] = []
    steps = list(_steps(lengths))
    by_next = np.ascontiguousarray(tagger.change.T)
    for k, (chains, rows) in enumerate(steps):
        if k == 0:
            best[chains] = tagger.start + scores[rows]
            continue
        through = best[chains][:, None, :] + by_next[None]
        back = through.argmax(axis=2)
        came.append(back.astype(np.int8))
        best[chains] = np.take_along_axis(through, back[:, :, None], 2)[:, :, 0] + scores[rows]
    state = best.argmax(axis=1)
    for k in range(len(steps) - 1, -1, -1):
        chains, rows = steps[k]
        labels[rows] = state[chains]
        if k:
            state[chains] = came[k - 1][np.arange(len(chains)), state[chains]]
    return labels


def _expected(
    scores: np.ndarray, lengths: np.ndarray, tagger: Tagger
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Forward-backward with scaled probabilities: P(label) of words, expected changes and
    starts, and the logarithm of the sum over all labellings."""
    steps = list(_steps(lengths))
    top = scores.max(axis=1)
    emitted = np.exp(scores - top[:, None])
    change, start = np.exp(tagger.change), np.exp(tagger.start)
    forward = np.zeros_like(scores)
    backward = np.ones_like(scores)
    scale = np.ones(len(scores))
    for k, (_, rows) in enumerate(steps):
        came = start if k == 0 else forward[steps[k - 1][1][: len(rows)]] @ change
        now = came * emitted[rows]
        scale[rows] = now.sum(axis=1)
        forward[rows] = now / scale[rows][:, None]
    changes = np.zeros_like(change)
    for k in range(len(steps) - 1, 0, -1):
        rows = steps[k][1]
        before = steps[k - 1][1][: len(rows)]
        onward = emitted[rows] * backward[rows] / scale[rows][:, None]
        backward[before] = onward @ change.T
        changes += (forward[before].T @ onward) * change
    marginal = forward * backward
    first = steps[0][1] if steps else np.zeros(0, int)
    return marginal, changes, marginal[first].sum(axis=0), float(np.sum(np.log(scale) + top))


def fit(
    codes: np.ndarray,
    labels: np.ndarray,
    lengths: np.ndarray,
    rounds: int = 150,
    step: float = 0.15,
    ridge: float = 3e-4,
) -> Tagger:
    """Maximise the conditional likelihood of the labels of all chains, by Adam steps."""
    n_labels, n_features = len(LABELS), len(FEATURES)
    line = np.repeat(np.arange(len(lengths)), lengths)
    features = np.hstack([_matrix(_around(codes, line, c)) for c in CONTEXT])
    gold = np.eye(n_labels)[labels]
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    inner = np.ones(len(labels), bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((n_labels, n_labels))
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    seen_starts = np.bincount(labels[first], minlength=n_labels)
    may_follow, may_start = _allowed()
    sizes = [features.shape[1] * n_labels, n_labels**2]
    weights = np.zeros(sum(sizes) + n_labels)
    moment, square = np.zeros_like(weights), np.zeros_like(weights)

    def tagger_of(w: np.ndarray) -> Tagger:
        emission, change, start = np.split(w, np.cumsum(sizes))
        return Tagger(
            emission.reshape(len(CONTEXT), n_features, n_labels),
            np.where(may_follow, change.reshape(n_labels, n_labels), _NEVER),
            np.where(may_start, start, _NEVER),
        )

    for k in range(1, rounds + 1):
        tagger = tagger_of(weights)
        scores = features @ tagger.emission.reshape(-1, n_labels)
        marginal, changes, starts, _ = _expected(scores, lengths, tagger)
        gradient = np.concatenate(
            [
                (features.T @ (gold - marginal)).ravel(),
                ((seen - changes) * may_follow).ravel(),
                (seen_starts - starts) * may_start,
            ]
        )
        gradient = gradient / max(1, len(labels)) - ridge * weights
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights = weights + step * (moment / (1 - 0.9**k)) / (
            np.sqrt(square / (1 - 0.99**k)) + 1e-8
        )
    return tagger_of(weights)


def label_words(text: str, marked: Iterable[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the words of ``text``; marks are kind, start, end."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = spans(SPACE[data], np.array([0, len(data)]))
    labels = np.zeros(len(starts), np.int64)
    for kind, a, b in marked:
        a, b = len(text[:a].encode()), len(text[:b].encode())
        inside = np.flatnonzero((starts < b) & (ends > a))
        labels[inside] = LABELS.index(f"I-{kind}")
        labels[inside[:1]] = LABELS.index(f"B-{kind}")
    return word_features(data, starts, ends), labels


def train_tagger(labelled: DataFrame, rows: int = TRAINING_ROWS) -> Tagger:
    """Learn from a labelled table: ``text`` (one line) and ``marks`` (kind, start, end).

    It is meant to be small: at most ``rows`` rows, those whose text hashes smallest, come
    to the driver. Null texts and marks count as empty. From an empty table every word is
    learned to be nothing, so that the base rules alone decide.
    """
    chosen = (
        labelled.select(F.coalesce("text", F.lit("")).alias("text"), "marks")
        .orderBy(F.xxhash64("text"), "text")
        .limit(rows)
        .collect()
    )
    parts = [
        label_words(r["text"], [(m["kind"], m["start"], m["end"]) for m in r["marks"] or []])
        for r in chosen
    ]
    if not any(len(codes) for codes, _ in parts):
        may_follow, may_start = _allowed()
        emission = np.zeros((len(CONTEXT), len(FEATURES), len(LABELS)))
        emission[CONTEXT.index(0), 0, 0] = 1.0
        return Tagger(
            emission, np.where(may_follow, 0, _NEVER), np.where(may_start, 0, _NEVER)
        )
    codes = np.concatenate([c for c, _ in parts])
    labels = np.concatenate([m for _, m in parts])
    return fit(codes, labels, np.array([len(c) for c, _ in parts]))


MARKS = "array<struct<kind: string, start: int, end: int>>"


class _Writer:
    """Draws labelled lines: made-up prose with personal data and with things like it."""

    def __init__(self, seed: int) -> None:
        self.draw = random.Random(seed)

    def number(self, n: int, first: str = "0123456789") -> str:
        return self.draw.choice(first) + "".join(self.draw.choices("0123456789", k=n - 1))

    def word(self) -> str:
        parts = "the in on re er an ti es en nd at or un ch ei qu ou le la os ió ñ é ü ß tion".split()
        made = "".join(self.draw.choices(parts, k=self.draw.randint(1, 4)))
        return made.capitalize() if self.draw.random() < 0.15 else made

    def name(self) -> str:
        return "".join(self.draw.choices("abcdefghijklmnopqrstuvwxyz", k=self.draw.randint(2, 9)))

    def email(self) -> str:
        end = self.draw.choice(["com", "org", "net", "example.com", "co.uk", "de"])
        user = self.draw.choice([self.name(), f"{self.name()}.{self.number(2)}", f"{self.name()}_{self.name()}"])
        host = self.draw.choice([self.name(), f"mail{self.number(1)}"])
        at, dot = self.draw.choice(
            [("@", ".")] * 5 + [(" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", "."), (" at ", ".")]
        )
        return f"{user}{at}{host}{dot}{end}"

    def ip(self) -> str:
        parts = ".".join(str(self.draw.randrange(256)) for _ in range(4))
        return parts + self.draw.choice(["", "", "", f":{self.number(4, '123456')}"])

    def card(self) -> str:
        digits = self.number(15, "3456")
        digits += next(d for d in "0123456789" if luhn((digits + d).encode()))
        gap = self.draw.choice(["", "", " ", "-", "."])
        return gap.join(digits[k : k + 4] for k in range(0, 16, 4))

    def phone(self) -> str:
        a, b, c = self.number(3), self.number(3), self.number(4)
        return self.draw.choice(
            [f"+1 ({a}) 555-{c}", f"+1 ({a}) 555-{c}", f"({a}) {b}-{c}", f"+{self.number(2, '34')} {a} {b}{c}",
             f"+1-{a}-{b}-{c}", f"{a}-{b}-{c}", f"00{self.number(2, '34')} {a} {c}{b}"]
        )

    def secret(self) -> str:
        length = self.draw.choice([32, 40, 40, 40, 64])
        made = "".join(self.draw.choices("0123456789abcdef", k=length))
        mixed = "".join(self.draw.choices("abcdefghkmnpqrstuvwxyzABCDEFGHKLMN23456789", k=24)) + "7qR"
        return self.draw.choice([made, made, made.upper(), mixed])

    def other(self) -> str:
        n = self.number
        return self.draw.choice(
            [f"version {n(1)}.{n(1)}.", "the Apache License, Version 2.0.", "under CC BY-NC 4.0.",
             f"in {n(4, '12')}", f"{n(2)},{n(3)}", f"{n(1)}.{n(2)}", f"page {n(2)}", f"chapter {n(1)}.{n(1)}.{n(1)}",
             f"20{n(2)}-0{n(1)}-1{n(1)}", f"1{n(1)}:{n(2, '012345')}", f"{n(2)}-{n(2)}", f"A{n(1)}", f"x{n(2)}",
             f"#{n(2)}", f"http://{self.name()}.org/{self.name()}", f"@{self.name()}", f"{self.word()}-{self.word()}",
             f"ISBN 978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"size = {n(2)}", f"{self.word()}={self.word()}",
             f"order {n(16)}1"[: self.draw.choice([12, 14, 18])], f'"{self.word()}"', f"({self.word()})",
             f"({n(1)})", f"id {n(6)}", f"{n(5)}", "at the dot", f"call {self.word()}", f"the key {self.word()}",
             f"the token is {self.word()}", f"mail to {self.word()}", f"{n(1)}.{n(1)}.{n(1)}", f"{n(3)} %",
             f"+{n(1)}", f"- {self.word()}", f"| {self.word()} |", f"{n(3)}.{n(3)}.{n(3)}"]
        )

    def line(self) -> tuple[str, list[tuple[str, int, int]]]:
        cues = {
            "email": ["mail: ", "contact ", "write to "],
            "ip": ["host ", "from ip ", "server: "],
            "card": ["card ", "visa: ", "credit card no. "],
            "phone": ["phone: ", "tel. ", "call "],
            "secret": ['token = "', 'key: "', "password ", 'secret="'],
        }
        junk = self.draw.choice([""] * 6 + ["###", "!!", "***", "%%%"])
        shout = self.draw.random() < 0.05
        text, marks = "", []
        for _ in range(self.draw.randint(1, 4)):
            text += "".join(self.word() + junk + " " for _ in range(self.draw.randint(0, 5)))
            if self.draw.random() < 0.45:
                text += self.other() + junk + " "
            elif self.draw.random() < 0.85:
                kind = self.draw.choice(KINDS)
                likely = 0.85 if kind == "secret" else 0.4
                cue = self.draw.choice(cues[kind]) if self.draw.random() < likely else ""
                made = getattr(self, kind)()
                text += cue
                marks.append((kind, len(text), len(text) + len(made)))
                text += made + ('"' if cue.endswith('"') else self.draw.choice(["", "", ".", ","]))
                text += junk + " "
        # Upper case may change the length of some letters; only lines that keep it shout.
        if shout and len(text.upper()) == len(text):
            text = text.upper()
        return text, marks


def labelled_table(spark: SparkSession, rows: int = TRAINING_ROWS, seed: int = 11) -> DataFrame:
    """A small labelled table, drawn from rules: ``text`` and ``marks``."""
    writer = _Writer(seed)
    return spark.createDataFrame([writer.line() for _ in range(rows)], f"text string, marks {MARKS}")


#: What a span of each kind keeps of the signs around it.
_KEPT_EDGE = {
    "email": re.compile(rb"[^A-Za-z0-9]*(.*?)[^A-Za-z0-9]*", re.S),
    "ip": re.compile(rb"[^0-9A-Fa-f]*(.*?)[^0-9A-Fa-f]*", re.S),
    "card": re.compile(rb"[^0-9]*(.*?)[^0-9]*", re.S),
    "phone": re.compile(rb"[^0-9+(]*(.*?)[^0-9]*", re.S),
    "secret": re.compile(rb"(?:[A-Za-z_]+[=:])?[\"'`(<\[{=:]*(.*?)[\"'`.,;:!?#*$%&|<>\[\]{}()=]*", re.S),
}

#: What a span that the chain adds must have at least.
_LEAST = {
    "email": re.compile(rb".*(@|(\bat\b.*(\.|\bdot\b))).*", re.S | re.I),
    "ip": re.compile(rb"([^0-9A-Fa-f]*[0-9A-Fa-f]){4}.*", re.S),
    "card": re.compile(rb"([^0-9]*[0-9]){12}.*", re.S),
    "phone": re.compile(rb"([^0-9]*[0-9]){7}.*", re.S),
    "secret": re.compile(rb"(?=.*[0-9]).{12,}", re.S),
}


def _chains(codes: np.ndarray, texts: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The lengths of chains: lines, cut before plain words where they are long."""
    n = len(codes)
    new = np.ones(n, bool)
    new[1:] = (line[1:] != line[:-1]) | (texts[1:] != texts[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    if size.max(initial=0) > CHAIN_WORDS:
        place = np.arange(n) - np.repeat(first, size)
        plain = np.flatnonzero((codes & _BIT["plain"] != 0) & (place >= CHAIN_WORDS))
        own = np.stack([np.cumsum(new)[plain], place[plain] // CHAIN_WORDS])
        cut = np.ones(len(plain), bool)
        cut[1:] = np.any(own[:, 1:] != own[:, :-1], axis=0)
        new[plain[cut]] = True
        size = np.diff(np.append(np.flatnonzero(new), n))
    return size


def _line_numbers(data: np.ndarray, starts: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """A number for the line of each word, different also between texts."""
    breaks = np.flatnonzero(data == 10)
    return np.searchsorted(breaks, starts) + texts


def tagged_spans(
    data: np.ndarray, offsets: np.ndarray, tagger: Tagger
) -> list[tuple[int, int, int]]:
    """Start, kind and end of what the chain finds, in bytes of the slice."""
    starts, ends, texts = spans(SPACE[data], offsets)
    codes = word_features(data, starts, ends)
    line = _line_numbers(data, starts, texts)
    lengths = _chains(codes, texts, line)
    labels = viterbi(tagger.scores(codes, line), lengths, tagger)
    begins = np.flatnonzero(labels % 2 == 1)
    found = []
    for k in begins.tolist():
        last = k
        while last + 1 < len(labels) and labels[last + 1] == labels[k] + 1:
            last += 1
        kind = int(labels[k]) // 2
        a, b = int(starts[k]), int(ends[last])
        kept = _KEPT_EDGE[KINDS[kind]].fullmatch(data[a:b].tobytes())
        if _LEAST[KINDS[kind]].fullmatch(kept.group(1)):
            found.append((a + kept.start(1), kind, a + kept.end(1)))
    return found


def all_spans(
    data: np.ndarray, offsets: np.ndarray, tagger: Tagger
) -> np.ndarray:
    """One column a span: text, start, end, kind, added, in code points; by text, start and kind.

    Base spans stay; what the chain finds is added where no base span is touched.
    """
    base = base_spans(data, offsets)
    # Spans of the base overlap each other at most between kinds.
    busy = np.zeros(len(data) + 1, np.int32)
    for a, _, b in base:
        busy[a] += 1
        busy[b] -= 1
    taken = np.append(0, np.cumsum(np.cumsum(busy)[:-1] > 0))
    added = [x for x in tagged_spans(data, offsets, tagger) if taken[x[2]] == taken[x[0]]]
    rows = np.array([(*x, 0) for x in base] + [(*x, 1) for x in added], np.int64).reshape(-1, 4)
    point = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    text = np.searchsorted(offsets, rows[:, 0], side="right") - 1
    before = point[offsets[text]]
    table = np.stack(
        [text, point[rows[:, 0]] - before, point[rows[:, 2]] - before, rows[:, 1], rows[:, 3]]
    )
    return table[:, np.lexsort((table[2], table[3], table[1], table[0]))]


COLUMNS = (
    "doc_id bigint, "
    + ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    + ", base_sha256 string, spans string, n_added bigint"
)


def find_personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """One row for each document: counts of base spans, their digest, and all spans.

    ``spans`` lists ``kind:start:end`` in code points, by start and then by kind; the digest
    is that of the same list of base spans alone. ``n_added`` counts the others. A null or
    empty text has none. Rows are judged one by one, so repeated rows and rows without id
    get their own; columns besides ``doc_id`` and ``text`` do not matter. Long texts are
    read whole; their lines are decoded in chains of about 512 words, cut before plain words.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                table = all_spans(data, offsets, tagger)
                counts = np.zeros((len(BASE_KINDS), n), np.int64)
                base = table[4] == 0
                np.add.at(counts, (table[3][base], table[0][base]), 1)
                every: list[list[str]] = [[] for _ in range(n)]
                plain: list[list[str]] = [[] for _ in range(n)]
                for text, a, b, kind, extra in table.T.tolist():
                    mark = f"{KINDS[kind]}:{a}:{b}"
                    every[text].append(mark)
                    if not extra:
                        plain[text].append(mark)
                digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in plain]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, rows.stop - rows.start),
                        *(pa.array(c) for c in counts),
                        pa.array(digests, pa.string()),
                        pa.array([",".join(x) for x in every], pa.string()),
                        pa.array(np.bincount(table[0][~base], minlength=n)[:n]),
                    ],
                    names=names,
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, COLUMNS)


def mask_personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced by ``<kind>``.

    Spans that overlap become one, named after the first. Null texts stay null; other
    columns are unchanged.
    """
    at = docs.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for rows, data, offsets in text_slices(batch.column(at)):
                stop: dict[int, int] = {}
                out: dict[int, list[str]] = {}
                for text, a, b, kind, _ in all_spans(data, offsets, tagger).T.tolist():
                    row = rows.start + text
                    end = stop.get(row, 0)
                    if a >= end:
                        out.setdefault(row, []).append(f"{texts[row][end:a]}<{KINDS[kind]}>")
                    stop[row] = max(end, b)
                for row, parts in out.items():
                    texts[row] = "".join(parts) + texts[row][stop[row] :]
            columns = [batch.column(k) for k in range(batch.num_columns)]
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, docs.schema)
