"""Token ids of whole texts, by the ``tokenizers`` and ``sentencepiece`` libraries with public vocabularies."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np

from orderloom.llm import kernels as K

#: Words in each of the two generations of a worker's cache; bounds its memory, not its results.
CACHE_WORDS = 600_000
#: Bytes of the longest word that is looked up by numbers: three of 64 bits, the last byte for the length.
SHORT_BYTES = 23
#: A space before white space or the end: there a text may not be cut into words.
_UNSAFE = re.compile(r" (?:\s|$)")
#: 1 for ASCII letters and digits, 2 for ASCII signs, 3 for the space, 0 for all others: also other white space, control characters.
_CLASSES = bytes(0 if i > 127 or not chr(i).isprintable() else 1 if chr(i).isalnum() else 3 if i == 32 else 2 for i in range(256))
_MASKS = np.array([[(1 << 8 * min(max(n - first, 0), 8)) - 1 for n in range(SHORT_BYTES + 1)] for first in (0, 8, 16)], K.U64)
_LENGTHS = np.arange(SHORT_BYTES + 1, dtype=K.U64) << K.U64(56)
_SEEDS = K.random_words(13, 3) | K.U64(1)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_keys(joined: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The 1 to SHORT_BYTES bytes of each word and their number, as three numbers: equal only for equal words.

    ``joined`` goes on for 24 bytes after the last start.
    """
    eight = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,))
    key = np.stack([eight[starts + first] & mask[sizes] for first, mask in zip((0, 8, 16), _MASKS)])
    key[2] |= _LENGTHS[sizes]
    return key


class KnownWords:
    """Words with their ids: short ones in an open-addressed table of keys, others in a dict.

    A word's place is the position of its first id times 2**32, plus the number of its ids.
    """

    def __init__(self, kind: np.dtype):
        self.longer: dict[bytes, int] = {}
        self._ids, self._used = np.zeros(1 << 12, kind), 0
        self._table, self._short = np.zeros((1 << 12, 4), K.U64), 0

    def __len__(self) -> int:
        return self._short + len(self.longer)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (K.mix(key[0] * _SEEDS[0] + key[1] * _SEEDS[1] + key[2] * _SEEDS[2]) & K.U64(len(self._table) - 1)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Place of each short word, 0 for unknown ones."""
        places, left, at = np.zeros(key.shape[1], K.U64), np.arange(key.shape[1]), self._slots(key)
        while len(at):
            rows = self._table[at]
            same = (rows[:, 0] == key[0]) & (rows[:, 1] == key[1]) & (rows[:, 2] == key[2])
            places[left[same]] = rows[same, 3]
            on = np.flatnonzero(~same & (rows[:, 2] != 0))
            left, at, key = left[on], (at[on] + 1) & (len(self._table) - 1), key[:, on]
        return places

    def insert(self, key: np.ndarray, places: np.ndarray) -> None:
        """Different short words, all unknown so far."""
        rows = np.column_stack([*key, places])
        self._short += len(rows)
        if self._short > 0.6 * len(self._table):
            rows = np.concatenate([self._table[self._table[:, 2] != 0], rows])
            self._table = np.zeros((1 << (2 * self._short).bit_length(), 4), K.U64)
        at = self._slots(rows[:, :3].T)
        while len(at):
            free = self._table[at, 2] == 0
            self._table[at[free]] = rows[free]  # of several for one slot the last stays
            on = np.flatnonzero((self._table[at, :3] != rows[:, :3]).any(axis=1))
            rows, at = rows[on], (at[on] + 1) & (len(self._table) - 1)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keep the ids of words, one after the other; gives their places."""
        ends = self._used + np.cumsum(sizes, dtype=np.int64)
        if self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids[: self._used], np.zeros(self._used + 2 * len(ids), self._ids.dtype)])
        self._ids[self._used : self._used + len(ids)] = ids
        self._used += len(ids)
        return ((ends - sizes) << 32 | sizes).astype(K.U64)

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids at the places, one after the other, and the number of each."""
        sizes = (places & K.U64(0xFFFFFFFF)).astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.repeat((places >> K.U64(32)).astype(np.int64) - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self._ids[at], sizes


class ByteBpe:
    """Byte-level BPE whose word pattern starts a new word at every space before a non-space
    and at every ASCII sign after an ASCII letter or digit.

    Such a text is encoded word by word, and each different word once; every other
    text is encoded as it stands. Both give the library's ids for the whole text.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.cache_words = cache_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Ids of tokens that start with a space: no other token of a word does.
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.opens[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("\u0120")]] = True
        self._new, self._old = KnownWords(self.kind), KnownWords(self.kind)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Encode words, those with a space before them many in one call; gives their places."""
        texts = [w.decode() for w in words]
        spaced = np.array([t[0] == " " for t in texts], bool)
        run, alone = [t for t in texts if t[0] == " "], self._encode([t for t in texts if t[0] != " "])
        ids = np.array(list(chain.from_iterable(self._encode(["".join(run[i : i + 64]) for i in range(0, len(run), 64)]))), self.kind)
        sizes = np.diff(np.flatnonzero(self.opens[ids]), append=len(ids))
        if len(sizes) != len(run):
            raise ValueError("a word holds more than one space")
        places = np.zeros(len(words), K.U64)
        places[spaced] = self._new.add(ids, sizes)
        places[~spaced] = self._new.add(np.array(list(chain.from_iterable(alone)), self.kind), np.array([len(i) for i in alone], np.int64))
        return places

    def _short(self, joined: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of words of at most SHORT_BYTES."""
        key = word_keys(joined, starts, sizes)
        places = self._new.find(key)
        missing = np.flatnonzero(places == 0)
        if len(missing):
            missing = missing[np.lexsort(key[:, missing])]
            first = np.r_[True, (key[:, missing[1:]] != key[:, missing[:-1]]).any(axis=0)]
            once = missing[first]
            found = self._old.find(key[:, once])
            kept = found != 0
            found[kept] = self._new.add(*self._old.ids(found[kept]))
            new = once[~kept]
            found[~kept] = self._learn([joined[a : a + n] for a, n in zip(starts[new].tolist(), sizes[new].tolist())])
            self._new.insert(key[:, once], found)
            places[missing] = found[np.cumsum(first) - 1]
        return places

    def _longer(self, words: list[bytes]) -> np.ndarray:
        """Places of words of more than SHORT_BYTES."""
        known, missing = self._new.longer, set(words).difference(self._new.longer)
        kept = [w for w in missing if w in self._old.longer]
        ids = self._old.ids(np.array([self._old.longer[w] for w in kept], K.U64))
        known.update(zip(kept, self._new.add(*ids).tolist(), strict=True))
        new = list(missing.difference(kept))
        known.update(zip(new, self._learn(new).tolist(), strict=True))
        return np.array([known[w] for w in words], K.U64)

    def _by_words(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if len(self._new) > self.cache_words:
            self._old, self._new = self._new, KnownWords(self.kind)
        parts = [t.encode() for t in texts]
        joined = b"".join([*parts, bytes(24)])
        classes = np.frombuffer(joined.translate(_CLASSES), np.uint8)[:-24]
        texts_at = np.r_[0, np.cumsum([len(p) for p in parts])]
        opens = classes == 3
        opens[1:] |= (classes[1:] == 2) & (classes[:-1] == 1)
        opens[texts_at[:-1]] = True
        starts = np.flatnonzero(opens)
        sizes = np.diff(starts, append=len(classes))
        short, longer = np.flatnonzero(sizes <= SHORT_BYTES), np.flatnonzero(sizes > SHORT_BYTES)
        places = np.zeros(len(starts), K.U64)
        places[short] = self._short(joined, starts[short], sizes[short])
        if len(longer):
            places[longer] = self._longer([joined[a : a + n] for a, n in zip(starts[longer].tolist(), sizes[longer].tolist())])
        ids, counts = self._new.ids(places)
        cuts = np.r_[0, np.cumsum(counts)][np.searchsorted(starts, texts_at)] * self.kind.itemsize
        found, cuts = ids.tobytes(), cuts.tolist()
        return [found[a:b] for a, b in zip(cuts, cuts[1:])]

    def _splits(self, text: str) -> bool:
        return text[:1] not in ("", " ") and _UNSAFE.search(text) is None and not any(s in text for s in self.special)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``kind``."""
        splits = [self._splits(t) for t in texts]
        split = iter(self._by_words([t for t, s in zip(texts, splits) if s]))
        whole = iter(self._encode([t for t, s in zip(texts, splits) if not s]))
        return [next(split) if s else np.array(next(whole), self.kind).tobytes() for s in splits]


@lru_cache(maxsize=4)
def byte_bpe(path: str, cache_words: int = CACHE_WORDS) -> ByteBpe:
    """One tokenizer per worker, file and size of its memory of words."""
    return ByteBpe(path, cache_words)
