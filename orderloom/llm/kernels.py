"""Array code on the bytes of many texts at once: words, hashes of spans, shingles, local minima."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Text bytes worked on at once.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit number over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * U64(0x9E3779B97F4A7C15))


_BYTE = random_words(1, 256)
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            _powers[i] = np.cumprod(np.r_[U64(1), np.full(max(n, CHUNK_BYTES) - 1, base)])
    return _powers[0], _powers[1]


class SpanHash:
    """Prefix polynomial hashes modulo 2**64: the hash of any span in constant time."""

    def __init__(self, raw: np.ndarray):
        powers, self._inverse = _tables(len(raw) + 1)
        self._prefix = np.zeros(len(raw) + 1, U64)
        np.cumsum(_BYTE[raw] * powers[: len(raw)], out=self._prefix[1:])

    def plain(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._prefix[end] - self._prefix[start]) * self._inverse[start]

    def spans_from(self, start: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """``plain`` of the spans from ``start``, by their lengths."""
        before, inverse = self._prefix[start], self._inverse[start]
        return lambda length: (self._prefix[start + length] - before) * inverse

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.plain(start, end) + (np.asarray(end) - start).astype(U64))

    def sliding(self, width: int) -> np.ndarray:
        """Hash of every span of ``width`` bytes, by start."""
        n = len(self._prefix) - 1
        if n < width:
            return np.zeros(0, U64)
        return mix((self._prefix[width:] - self._prefix[: n + 1 - width]) * self._inverse[: n + 1 - width])


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after the other, and the n + 1 bounds; a null is empty."""
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds.astype(np.int64) - int(bounds[0])


def lowered(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def is_space(raw: np.ndarray) -> np.ndarray:
    """ASCII white space."""
    return _SPACE[raw]


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words between ASCII white space, and the n + 1 bounds of each text's words."""
    solid = np.zeros(len(raw) + 2, bool)
    np.logical_not(_SPACE[raw], out=solid[1:-1])
    opens = solid[1:-1] & ~solid[:-2]
    closes = solid[1:-1] & ~solid[2:]
    inner = bounds[(bounds > 0) & (bounds < len(raw))]  # no word runs over the end of a text
    opens[inner] |= solid[1:-1][inner]
    closes[inner - 1] |= solid[1:-1][inner - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds)


def owners(bounds: np.ndarray) -> np.ndarray:
    """Index of the text that each item lies in."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(word: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words each and their bounds; a text of fewer words is one shingle."""
    n = np.diff(bounds)
    kept = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    owner = owners(bounds)
    at = np.flatnonzero(np.arange(len(word)) - bounds[:-1][owner] < kept[owner])
    last = bounds[1:][owner[at]]
    total = np.zeros(len(at), U64)
    for j, factor in enumerate(random_words(2, width) | U64(1)):
        place = np.minimum(at + j, max(len(word) - 1, 0))
        total += np.where(at + j < last, word[place] * factor, U64(0))
    total = mix(total + np.minimum(last - at, width).astype(U64))
    return total, np.r_[0, np.cumsum(kept)]


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, of = words(raw, bounds)
    return SpanHash(raw)(starts, ends), of


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, with new bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return (np.concatenate(parts) if parts else values[:0]), np.r_[0, np.cumsum([len(p) for p in parts], dtype=np.int64)]


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """best() over each ``width`` values in a row, by start."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def local_minima(values: np.ndarray, width: int, inside: np.ndarray | None = None) -> np.ndarray:
    """True where a value is the least of some ``width`` values in a row; all ties count.

    Depends on the values around only, so equal stretches of at least ``width``
    values have equal minima. Shorter inputs have none. ``inside`` tells of each
    start whether the values from there count; values are then above 0.
    """
    n = len(values)
    if n < width:
        return np.zeros(n, bool)
    least = _slide(values, width, np.minimum)
    if inside is not None:
        least = np.where(inside[: len(least)], least, values.dtype.type(0))
    padded = np.zeros(len(least) + 2 * (width - 1), values.dtype)
    padded[width - 1 : width - 1 + len(least)] = least
    return _slide(padded, width, np.maximum)[:n] == values
