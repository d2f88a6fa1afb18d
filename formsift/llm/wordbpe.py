"""Byte-pair merging with a heap over a linked list, for the vocabulary with word ends.

A text falls into words by the tokenizer file's own rules (special strings, normal form, split pattern, byte symbols),
and merging never looks across words, so each distinct word is merged once per worker and looked up after that.
Texts of common Latin letters only are split by the same rules over the bytes of many texts at once; every other text
goes through the file's own normaliser and splitter. In the first kind a word is known by a 64-bit hash.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cached_property

import numpy as np

from formsift.llm.base import held
from formsift.llm.words import span_hashes

#: Letters whose lower case is one character, that no normal form changes and that are letters for the split pattern.
LATIN = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
_OTHER = re.compile(f"[^\t\n\v\f\r\x20-\x7e{LATIN}]|<\\|")
#: Bytes of words and their values that a worker remembers; beyond that it begins anew.
REMEMBERED_BYTES = 32 << 20


class Remembered:
    """Numbers worked out for words before, in arrays: sorted keys, and where in one pool a key's numbers are."""

    def __init__(self, most: int = REMEMBERED_BYTES):
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, dtype=np.uint64)
        self.begin = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int32)
        self.pool = np.empty(1 << 12, dtype=np.uint32)
        self.used = 0

    def put(self, keys: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        """Adds keys, in ascending order, that are not there yet."""
        if self.used + len(values) > len(self.pool):
            pool = np.empty(max(2 * len(self.pool), self.used + len(values)), dtype=np.uint32)
            pool[: self.used] = self.pool[: self.used]
            self.pool = pool
        self.pool[self.used : self.used + len(values)] = values
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, self.used + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, at, sizes)
        self.used += len(values)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, in ascending order, that are not there. Too much remembered is forgotten before."""
        if 20 * len(self.keys) + 4 * len(self.pool) > self.most:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        there = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        there[inside] = self.keys[at[inside]] == keys[inside]
        return np.flatnonzero(~there)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the numbers of each key begin, and how many they are; all keys are there."""
        at = np.searchsorted(self.keys, keys)
        return self.begin[at], self.size[at].astype(np.int64)


def bytes_to_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Bytes that print as themselves stand for themselves, the others in order for characters from 256 on.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def merged(symbols: list[str], ranks: dict[tuple[str, str], tuple[int, str]]) -> tuple[int, list[str]]:
    """Pops the adjacent pair of lowest rank, the leftmost of several, until none has a rank.

    The list is linked by places; a heap entry is stale when a symbol at its places has changed since.
    Returns the number of merges and the symbols that are left.
    """
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    left: list[str | None] = list(symbols)
    heap = []
    for i in range(n - 1):
        found = ranks.get((left[i], left[i + 1]))
        if found:
            heap.append((found[0], i, left[i], left[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if left[i] != a or j >= n or left[j] != b:
            continue
        new = ranks[a, b][1]
        left[i], left[j] = new, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            found = ranks.get((new, left[k]))
            if found:
                heapq.heappush(heap, (found[0], i, new, left[k]))
        h = before[i]
        if h >= 0:
            found = ranks.get((left[h], new))
            if found:
                heapq.heappush(heap, (found[0], h, left[h], new))
        merges += 1
    return merges, [s for s in left if s is not None]


#: Classes of bytes in texts of Latin letters only: white space, letter, digit, other.
SPACE, LETTER, DIGIT, MARK = range(4)
_CLASS = np.full(256, MARK, dtype=np.uint8)
_CLASS[[32, 9, 10, 11, 12, 13]] = SPACE
_CLASS[97:123] = _CLASS[128:] = LETTER
_CLASS[48:58] = DIGIT
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def word_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin in lower-cased bytes, and which bytes belong to words.

    A run of letters, one digit, or a run of other marks is a word. An apostrophe that begins a run of marks takes the
    letters of an ending that follow it, and what is left of them begins a word of its own.
    """
    kind = _CLASS[data]
    first = np.ones(len(data), dtype=bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    first &= kind != SPACE
    for at in np.flatnonzero((data == 39) & first).tolist():
        after = data[at + 1 : at + 3].tobytes()
        ending = next((e for e in _ENDINGS if after.startswith(e)), None)
        if ending:
            first[at + 1] = False
            end = at + 1 + len(ending)
            if end < len(data) and kind[end] == LETTER:
                first[end] = True
    return np.flatnonzero(first), kind != SPACE


class WordBpe:
    """One tokenizer file in a worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        own = Tokenizer.from_file(path)
        self.own = own
        self.normalise = own.normalizer.normalize_str
        self.split = own.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        self.end = model["end_of_word_suffix"]
        # the last symbol of every word ends in the mark of a word's end
        self.last = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
        self.last[[i for symbol, i in model["vocab"].items() if symbol.endswith(self.end)]] = True
        self.special = {t["content"] for t in whole["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        letters = bytes_to_symbols()
        self.symbol = {chr(c): "".join(letters[b] for b in chr(c).encode()) for c in range(0x180)}
        self.counts = Remembered()
        self.known = Remembered()

    @cached_property
    def ranks(self) -> dict[tuple[str, str], tuple[int, str]]:
        """Rank and result of each pair that merges; only counting needs them."""
        with open(self.path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        return {(a, b): (i, a + b) for i, (a, b) in enumerate(map(tuple, merges))}

    def merged_count(self, symbols: str) -> int:
        """Tokens of a word given as byte symbols: its initial symbols minus the merges; no ids are made."""
        initial = [*symbols[:-1], symbols[-1] + self.end]
        return len(initial) - merged(initial, self.ranks)[0]

    def other_count(self, text: str) -> int:
        """Tokens of any text, by the file's own rules for words."""
        total = 0
        for part in self.cut.split(text):
            if part in self.special:
                total += 1
            elif part:
                total += sum(self.merged_count(word) for word, _ in self.split(self.normalise(part)))
        return total

    def new_counts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts = [self.merged_count("".join(map(self.symbol.__getitem__, w))) for w in words]
        return np.ones(len(words), dtype=np.int32), np.array(counts, dtype=np.uint32)

    def new_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all of them, from the library."""
        ids = np.array(self.own.encode(" ".join(words), add_special_tokens=False).ids, dtype=np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        return np.diff(ends, prepend=0).astype(np.int32), ids

    def counts_of(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        plain = [not _OTHER.search(t) for t in texts]
        which, begin, _, at = looked_up([t for t, p in zip(texts, plain, strict=True) if p], self.counts, self.new_counts)
        sums = np.concatenate([[0], np.cumsum(self.counts.pool[begin].astype(np.int64)[which])])
        own = iter((sums[at[1:]] - sums[at[:-1]]).tolist())
        return [next(own) if p else self.other_count(t) for t, p in zip(texts, plain, strict=True)]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        plain = [not _OTHER.search(t) for t in texts]
        which, begin, size, at = looked_up([t for t, p in zip(texts, plain, strict=True) if p], self.known, self.new_ids)
        sizes = size[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.known.pool[np.repeat(begin[which] - ends[:-1], sizes) + np.arange(ends[-1])]
        own = iter([ids[ends[a] : ends[b]].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)])
        return [next(own) if p else self.other_ids(t) for t, p in zip(texts, plain, strict=True)]

    def other_ids(self, text: str) -> bytes:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def looked_up(texts: list[str], known: Remembered, make) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which of the distinct words every word of the texts is, their places and sizes in the pool, and each text's first word."""
    raw = [t.lower().encode() for t in texts]
    if not any(raw):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(b"\n".join(raw), dtype=np.uint8)
    begin = np.cumsum([0, *(len(r) + 1 for r in raw)])
    starts, inside = word_starts(data)
    hashes, lengths = span_hashes(data, starts, inside)
    words, example, which = np.unique(hashes, return_index=True, return_inverse=True)
    new = known.missing(words)
    if len(new):
        spans = zip(starts[example[new]].tolist(), lengths[example[new]].tolist(), strict=True)
        known.put(words[new], *make([data[a : a + n].tobytes().decode() for a, n in spans]))
    return which, *known.places(words), np.searchsorted(starts, begin)


def word_bpe(path: str) -> WordBpe:
    return held(("word_bpe", path), lambda: WordBpe(path))
