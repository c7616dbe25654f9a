"""Token ids of whole texts by a public byte-level BPE vocabulary, with a word cache.

The vocabulary cuts a text into pieces before it merges bytes, and a single space between
two other characters always begins a new piece. So a text without runs of white space is
the sequence of its words, and the ids of a word can be kept and used again. A single line
feed between two other characters is a piece of its own, and so is a run of punctuation
behind a letter. All other texts are encoded whole. The merges are always those of the
tokenizers library.
"""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from txlake.llm.text import mix, slices, span_hashes, spans, utf8

BYTE_BPE = "byte_bpe_50k.json"
#: Words whose ids a worker keeps, at most: some 70 bytes each.
KEPT_WORDS = 900_000
#: Parts of words that it keeps besides, in each of two generations: some 200 bytes each.
KEPT_PARTS = 50_000
BATCH_BYTES = 3 << 20

#: Fixed value: what the byte-level vocabulary writes for a leading space.
_SPACE_MARK = "\u0120"
#: ASCII punctuation but the apostrophe, which can begin a contraction.
_PUNCTUATION = string.punctuation.replace("'", "")
#: Letters up to here are letters for every library; later ones depend on its tables.
_LAST_LETTER = "\u024f"


def vocabulary_path(name: str = BYTE_BPE) -> str:
    """Where the public vocabulary file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_marks() -> dict[int, str]:
    """Byte value -> the character that stands for it in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others for U+0100 onwards.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _is_letters(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) <= _LAST_LETTER)


class _Words(dict):
    """A mapping from words, as bytes, that learns a word when it is first asked for."""

    def __init__(self, learn: Callable[[str], bytes], older: dict | None = None) -> None:
        super().__init__()
        self._learn = learn
        self._older = older or {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._learn(word.decode())
        self[word] = ids
        return ids

    def younger(self) -> _Words:
        """A new mapping that still knows this one's words, but not older ones."""
        self._older = {}
        return _Words(self._learn, self)


class _KnownWords:
    """Ids of words by the hash of a word and its place, in arrays.

    Hashes are sorted, so the words of a batch are looked up at once. An entry also has the
    word's length, place, first and last eight bytes, so that another word with its hash is
    told apart.
    """

    def __init__(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._entries = np.zeros(0, np.int32)
        self._marks = np.zeros((3, 1024), np.uint64)
        self._starts = np.zeros(1025, np.int64)
        self.ids = np.zeros(4096, "u4")

    def __len__(self) -> int:
        return len(self._keys)

    def find(self, keys: np.ndarray, marks: np.ndarray) -> np.ndarray | None:
        """The entry of each of ``keys``, -1 if there is none; None if a mark is not its own."""
        at = np.searchsorted(self._keys, keys)
        at[at == len(self._keys)] = 0
        if not len(self._keys):
            return np.full(len(keys), -1)
        entries = np.where(self._keys[at] == keys, self._entries[at], -1)
        known = entries >= 0
        if not np.array_equal(self._marks[:, entries[known]], marks[:, known]):
            return None
        return entries

    def add(self, keys: np.ndarray, marks: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """New entries for ``keys``, which are sorted and not known."""
        n, more = len(self), len(keys)
        while n + more > self._marks.shape[1]:
            self._marks = np.concatenate([self._marks, np.zeros_like(self._marks)], axis=1)
            self._starts = np.append(self._starts, np.zeros(len(self._starts) - 1, np.int64))
        flat = np.frombuffer(b"".join(ids), "u4")
        ends = self._starts[n] + np.cumsum(np.fromiter(map(len, ids), np.int64, more) // 4)
        while more and ends[-1] > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self._starts[n] : self._starts[n] + len(flat)] = flat
        self._starts[n + 1 : n + more + 1] = ends
        self._marks[:, n : n + more] = marks
        entries = np.arange(n, n + more)
        at = np.searchsorted(self._keys, keys)
        self._keys = np.insert(self._keys, at, keys)
        self._entries = np.insert(self._entries, at, entries.astype(np.int32))
        return entries

    def places(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each entry begin, and how many there are."""
        starts = self._starts[entries]
        return starts, self._starts[entries + 1] - starts


class Encoder:
    """Encodes texts to unsigned 32-bit ids in native order, without special tokens.

    The ids of at most ``kept_words`` words, and of the words of one batch more, are kept;
    then they are learned anew. Parts of words are kept in two generations.
    """

    def __init__(
        self, path: str, kept_words: int = KEPT_WORDS, kept_parts: int = KEPT_PARTS
    ) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._kept_words, self._kept_parts = kept_words, kept_parts
        self._known = _KnownWords()
        self._words = _Words(self._learn)
        self._tails = _Words(self._whole)
        self.size = self._tokenizer.get_vocab_size()
        self._marks = _byte_marks()
        self._merge = self._tokenizer.model.tokenize
        self._added = tuple(
            t.content for t in self._tokenizer.get_added_tokens_decoder().values()
        )

    def _whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str, before: str = _SPACE_MARK) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._marks)
        return array("I", [t.id for t in self._merge(before + word)]).tobytes()

    def _head(self, word: str) -> bytes:
        """The ids of a word at the beginning of a line."""
        return self._letters(word, "") if _is_letters(word) else self._whole(word)

    def _learn(self, word: str) -> bytes:
        """The ids of a word behind a space."""
        if _is_letters(word):
            return self._letters(word)
        letters = word.rstrip(_PUNCTUATION)
        if len(letters) < len(word) and _is_letters(letters):
            return self._words[letters.encode()] + self._tails[word[len(letters) :].encode()]
        return self._whole(f" {word}")

    @staticmethod
    def _regular(text: str) -> bool:
        """True if every run of white space is one space or one line feed, and inside."""
        if text[0].isspace() or text[-1].isspace():
            return False
        pieces = text.split()
        gaps = len(text) - len("".join(pieces))
        return gaps == len(pieces) - 1 == text.count(" ") + text.count("\n")

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > self._kept_words:
            self._known = _KnownWords()
        if len(self._tails) > self._kept_parts:
            self._tails.clear()
        if len(self._words) > self._kept_parts:
            self._words = self._words.younger()
        regular = [
            bool(t) and self._regular(t) and not any(a in t for a in self._added) for t in texts
        ]
        parts = iter(self._gather([t.encode() for t, r in zip(texts, regular, strict=True) if r]))
        return [
            next(parts) if r else self._whole(t) if t else b""
            for t, r in zip(texts, regular, strict=True)
        ]

    def _gather(self, texts: list[bytes]) -> list[bytes]:
        """The ids of regular texts."""
        if not texts:
            return []
        offsets = np.append(0, np.cumsum([len(t) for t in texts]))
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts, ends, owners = spans((data == 32) | (data == 10), offsets)
        # Where a word stands decides what comes before it: nothing, a line feed, a space.
        before = data[np.maximum(starts - 1, 0)]
        place = np.where(starts == offsets[owners], 0, np.where(before == 10, 1, 2))
        keys = mix(span_hashes(data, starts, ends) + place.astype(np.uint64))
        order = np.argsort(keys)
        keys = keys[order]
        new = np.append(True, keys[1:] != keys[:-1])
        first, keys = order[new], keys[new]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        marks = _word_marks(data, starts, ends, place)
        known = self._known
        entries = known.find(keys, marks[:, first])
        if entries is None or not np.array_equal(marks, marks[:, first[which]]):
            return [self._whole(t.decode()) for t in texts]  # two words with one hash
        unknown = np.flatnonzero(entries < 0)
        asked = first[unknown]
        raw = data.tobytes()
        ids = [
            self._placed(raw[a:b].decode(), p)
            for a, b, p in zip(
                starts[asked].tolist(), ends[asked].tolist(), place[asked].tolist(), strict=True
            )
        ]
        entries[unknown] = known.add(keys[unknown], marks[:, asked], ids)
        begin, lengths = known.places(entries)
        n = lengths[which]
        stops = np.cumsum(n)
        at = np.repeat(begin[which] - (stops - n), n)
        out = known.ids[at + np.arange(len(at))].tobytes()
        last = np.searchsorted(owners, np.arange(len(texts)), side="right") - 1
        cuts = [0, *(4 * stops[last]).tolist()]
        return [out[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _placed(self, word: str, place: int) -> bytes:
        """The ids of a word behind a space (2), a line feed (1) or nothing (0)."""
        if place == 2:
            return self._learn(word)
        return self._tails[b"\n"] + self._head(word) if place else self._head(word)


def _word_marks(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray
) -> np.ndarray:
    """Of each word: its length and place, its first and its last eight bytes.

    That is the whole word up to sixteen bytes.
    """
    lengths = ends - starts
    padded = np.append(data, np.zeros(8, np.uint8))
    views = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    shift = (8 * np.maximum(8 - lengths, 0)).astype(np.uint64)
    heads = np.ascontiguousarray(views[starts]).view("<u8").ravel() << shift
    tails = np.ascontiguousarray(views[np.maximum(ends - 8, starts)]).view("<u8").ravel() << shift
    return np.stack([(4 * lengths + place).astype(np.uint64), heads, tails])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    return Encoder(path)


def encoded_slices(
    column: pa.Array, vocabulary: str, limit: int = BATCH_BYTES
) -> Iterator[tuple[slice, list[bytes]]]:
    """Rows of a column, some megabytes of text at a time, and their ids; null is empty."""
    encode = encoder(vocabulary).encode
    for rows in slices(utf8(column)[1], limit):
        texts = column.slice(rows.start, rows.stop - rows.start).to_pylist()
        yield rows, encode([t or "" for t in texts])
