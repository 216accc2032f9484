"""Quality by tokenizer fertility: how well public vocabularies fit a text.

Three measures, each with a band per script: characters per token of a byte-level vocabulary,
the entropy of its tokens, and the share of bytes for which a vocabulary of pieces falls back on byte pieces.
Word salad, symbol noise and repeated words fall outside; plain rules on words come first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import kernels as K
from orderloom.llm.tokens import CACHE_WORDS, byte_bpe
from orderloom.session import cut

#: Words of a window that must not come twice.
WINDOW = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Band:
    """What a text may measure: characters per token, bits per token relative to the most its number of
    tokens allows, byte-fallback pieces over bytes of words."""

    least_chars: float
    most_chars: float
    least_entropy: float
    most_fallback: float


#: Characters per token may also fall below the median of the text's language by this much: a share, and for
#: short texts, whose few tokens scatter, a share over the root of their number.
BELOW, BELOW_SHORT = 0.05, 0.5


#: By script of most letters. Alphabets a vocabulary was not made for take more tokens a character, so their bands lie lower.
BANDS = {
    "latin": Band(1.3, 7.0, 0.45, 0.05),
    "greek": Band(0.5, 4.0, 0.4, 0.2),
    "cyrillic": Band(0.5, 4.0, 0.4, 0.1),
    "hebrew": Band(0.4, 3.0, 0.4, 0.9),
    "arabic": Band(0.4, 3.0, 0.4, 0.9),
    "indic": Band(0.25, 2.0, 0.35, 0.95),
    "cjk": Band(0.25, 2.0, 0.4, 0.9),
    "hangul": Band(0.25, 2.0, 0.4, 0.95),
    "other": Band(0.2, 7.0, 0.3, 1.0),
}
_SCRIPTS = list(BANDS)
#: Script of a character by its first UTF-8 byte; marks, symbols and digits have none.
_LEAD = np.full(256, len(_SCRIPTS), np.int64)
for _script, _spans in {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)), "greek": ((0xCE, 0xCF),), "cyrillic": ((0xD0, 0xD4),),
    "hebrew": ((0xD6, 0xD7),), "arabic": ((0xD8, 0xDB),), "indic": ((0xE0, 0xE0),), "cjk": ((0xE3, 0xE9),),
    "hangul": ((0xEA, 0xED),), "other": ((0xE1, 0xE1), (0xF0, 0xF4)),
}.items():
    for _a, _b in _spans:
        _LEAD[_a : _b + 1] = _SCRIPTS.index(_script)


class Fallbacks:
    """Byte-fallback pieces of words with a space before them; each different word that is not ASCII is encoded once."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self._known: dict[str, int] = {}

    def count(self, texts: list[str]) -> np.ndarray:
        words = [[] if t.isascii() else [w for w in t.split() if not w.isascii()] for t in texts]
        if len(self._known) > CACHE_WORDS // 2:
            self._known.clear()
        missing = list(set(chain.from_iterable(words)).difference(self._known))
        for word, ids in zip(missing, self.model.encode(missing, num_threads=1)):
            self._known[word] = int(self.is_byte[ids].sum())
        return np.array([sum(map(self._known.__getitem__, w)) for w in words], np.int64)


@lru_cache(maxsize=4)
def fallbacks(path: str) -> Fallbacks:
    return Fallbacks(path)


def repeated_words(word: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text the words in windows that come twice or more in it, each word once; ``word``: hashes of all words."""
    n = np.diff(bounds)
    window, starts = K.shingles(word, bounds, WINDOW)
    text = K.owners(starts)
    full = n[text] >= WINDOW  # a shorter text has one window, which is none here
    window, text, at = window[full], text[full], (np.arange(len(text)) - starts[text] + bounds[text])[full]
    if not len(at):
        return np.zeros(len(n), np.int64)
    order = np.lexsort((window, text))
    same = (window[order][1:] == window[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = at[order[np.r_[same, False] | np.r_[False, same]]]
    edges = np.zeros(len(word) + 1, np.int64)
    edges[twice] += 1
    edges[twice + WINDOW] -= 1
    return _per_text(np.cumsum(edges[:-1]) > 0, bounds)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags)][bounds])


def _entropy(ids: np.ndarray) -> float:
    """Bits per token over the most that so many tokens can have; 1 for fewer than two."""
    if len(ids) < 2:
        return 1.0
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(share * np.log2(share)).sum() / np.log2(len(ids)))


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\v\f\r")]
    return len(lines) - len(set(lines))


def measure(column: pa.Array, ids: list[np.ndarray], fallback: np.ndarray) -> list[np.ndarray | list]:
    """The columns of all texts, from their token ids and byte-fallback pieces."""
    raw, bounds = K.utf8(column)
    word, of = K.word_hashes(raw, bounds)
    n = np.diff(of)
    points, blank = (raw & 0xC0) != 0x80, K.is_space(raw)
    chars, word_chars = _per_text(points, bounds), _per_text(points & ~blank, bounds)
    repeated = repeated_words(word, of)
    lines = [_repeated_lines(raw[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    scripts = np.stack([_per_text(_LEAD[raw] == i, bounds) for i in np.unique(_LEAD[raw])] or [np.zeros(len(n), np.int64)])
    present = np.unique(_LEAD[raw]) if len(raw) else np.array([len(_SCRIPTS)])
    scripts[present == len(_SCRIPTS)] = 0
    named = [_SCRIPTS[present[i]] if k else "other" for i, k in zip(scripts.argmax(0).tolist(), scripts.max(0).tolist())]
    size = np.array([len(i) for i in ids], np.int64)
    per_token, entropy = chars / np.maximum(size, 1), np.array([_entropy(i) for i in ids], float)
    share = fallback / np.maximum(_per_text(~blank, bounds), 1)
    failed = (n < 10) | (100 * repeated > 20 * n)
    bands = [BANDS[s] for s in named]
    fits = [
        b.least_chars <= c <= b.most_chars and e >= b.least_entropy and f <= b.most_fallback
        for b, c, e, f in zip(bands, per_token, entropy, share)
    ]
    kept = ~failed & np.array(fits, bool)
    return [n, word_chars, _per_text(_SYMBOL[raw], bounds), lines, repeated, failed, kept, size, named, per_token, entropy, share]


_COLUMNS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_tokens", pa.int64()), ("script", pa.string()), ("chars_per_token", pa.float64()), ("token_entropy", pa.float64()), ("fallback_share", pa.float64()),
]


def _measured(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, parts = byte_bpe(byte_path), fallbacks(piece_path)
        for batch in K.chunks(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [np.frombuffer(i, tokens.kind) for i in tokens.ids(texts)]
            columns = measure(batch.column("text"), ids, parts.count(texts))
            arrays = [pa.array(c, k) for c, (_, k) in zip(columns, _COLUMNS)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("lang"), *arrays], ["doc_id", "lang", *(n for n, _ in _COLUMNS)])

    return run


def fertility(docs: DataFrame, byte_vocabulary: str, piece_vocabulary: str) -> DataFrame:
    """Measures and verdict of each row of ``docs`` (doc_id, text, lang), measured where it is read.

    Words lie between ASCII white space. word_chars are code points in words, n_symbols characters of #*$%&|<>,
    n_dup_lines lines with a word that equal an earlier line, n_repeat_words the words in five-word windows found twice or more.
    base_failed: fewer than 10 words, or more than a fifth of them repeated. kept: not base_failed, the
    three measures lie in the band of the script that most letters belong to, and characters per token are not far
    below the median of all documents of the same lang (same script where lang is null). fallback_share is byte-fallback pieces
    over bytes of words.

    A null text counts as empty and fails; a null doc_id is carried along; repeated rows are judged alike; other
    columns are ignored; no rows give no rows.
    """
    schema = (
        "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, n_tokens long, script string, chars_per_token double, token_entropy double, fallback_share double"
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    measured = cut(texts.mapInArrow(_measured(byte_vocabulary, piece_vocabulary), schema), "fertility")
    kind = F.struct("lang", F.when(F.col("lang").isNull(), F.col("script")).alias("script"))
    rows = measured.withColumn("_kind", F.to_json(kind))
    medians = rows.filter("n_tokens > 0").groupBy("_kind").agg(F.percentile_approx("chars_per_token", 0.5, 1000).alias("median_chars"))
    judged = rows.join(medians, "_kind", "left")
    low = F.col("median_chars") * (1 - F.lit(BELOW) - F.lit(BELOW_SHORT) / F.sqrt(F.greatest("n_tokens", F.lit(1))))
    kept = F.col("kept") & F.coalesce(F.col("chars_per_token") >= low, F.lit(True))
    return judged.withColumn("kept", kept).drop("_kind", "lang")
