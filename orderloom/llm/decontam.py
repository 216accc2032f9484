"""Benchmark decontamination: n-gram seeds find candidates, local alignment scores them.

Every word n-gram of an item is a seed, however many documents hold it: in a copy with words replaced any of them may be the
only one left. A document with a seed of an item and with enough of the item's words is aligned with the item around
the seed by Smith-Waterman on words, so copies with words replaced, dropped or added still score.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import kernels as K

#: Words of a seed.
SEED_WORDS = 3
#: Items that are looked for at once; a larger benchmark takes several passes over the documents.
BLOCK_ITEMS = 50_000
MATCH, MISMATCH, GAP = 2, -1, 1
#: Score over the score of a perfect copy at which a document holds the item.
THRESHOLD = 0.5
LEAKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
        ]
    )
)
_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]))


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, bounds = K.utf8(column)
    return K.word_hashes(K.lowered(raw), bounds)


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Best local score and the place in ``words`` of its last word; gaps cost alike, row by row of the table."""
    steps = np.arange(1, len(words) + 1) * GAP
    above = np.zeros(len(words) + 1, np.int64)
    best, last = 0, -1
    for word in item:
        row = np.maximum(above[:-1] + np.where(words == word, MATCH, MISMATCH), above[1:] - GAP)
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + steps) - steps, 0)
        above[1:] = row
        if len(row) and row.max() > best:
            best, last = int(row.max()), int(row.argmax())
    return best, last


def aligned(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Score, first and last word of the best local alignment."""
    best, last = align(item, words)
    if not best:
        return 0, 0, -1
    _, back = align(item[::-1], words[: last + 1][::-1])
    return best, last - back, last


@dataclass
class Items:
    """A block of test items: their words, and each gram with the items and places that hold it."""

    ids: list[int]
    words: list[np.ndarray]

    def __post_init__(self):
        self.bounds = np.r_[0, np.cumsum([len(w) for w in self.words])]
        self.vocabulary, self.numbers = np.unique(np.concatenate(self.words), return_inverse=True)
        grams, of = K.shingles(np.concatenate(self.words), self.bounds, SEED_WORDS)
        order = np.argsort(grams, kind="stable")
        self.keys, first = np.unique(grams[order], return_index=True)
        self.gram_bounds = np.r_[first, len(grams)]
        owner = K.owners(of)
        self.item, self.place = owner[order], (np.arange(len(grams)) - of[owner])[order]

    def holding(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each item and place that holds one of ``grams`` (places in keys): which of them, and the place in item and place."""
        return _spread(self.gram_bounds[grams], self.gram_bounds[grams + 1])

    def shared(self, items: np.ndarray, words: np.ndarray) -> np.ndarray:
        """How many words of each of ``items`` are among ``words``: no alignment with them matches more."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        present = np.zeros(len(self.vocabulary), bool)
        present[at[self.vocabulary[at] == words]] = True
        of, place = _spread(self.bounds[items], self.bounds[items + 1])
        return np.bincount(of, present[self.numbers[place]], len(items))


def _spread(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of ranges one after the other, each with the index of its range."""
    of = np.repeat(np.arange(len(first)), end - first)
    starts = np.cumsum(end - first) - (end - first)
    return of, np.arange(len(of)) - starts[of] + first[of]


def _leaks_of(words: np.ndarray, places: np.ndarray, grams: np.ndarray, items: Items, threshold: float) -> list[dict]:
    """Items that one document holds; ``places`` in the document and ``grams``, as places in the items' keys, of its seeds.

    A score of the threshold takes that share of matches, so items of which the text, or the text around the seeds,
    has fewer words are not aligned.
    """
    single = np.unique(grams)
    near = np.unique(items.item[items.holding(single)[1]])
    sizes = items.bounds[near + 1] - items.bounds[near]
    near = near[items.shared(near, words) >= threshold * sizes - 1e-9]
    if not len(near):
        return []
    of, held = items.holding(grams)
    mine = np.isin(items.item[held], near)
    spans = defaultdict(list)
    for i, start in zip(items.item[held][mine].tolist(), (places[of] - items.place[held])[mine].tolist()):
        size = len(items.words[i])
        first = start - size // 2
        spans[i].append((max(0, first), min(len(words), first + 2 * size)))
    out = []
    for i, found in spans.items():
        best, item = (0, 0, -1), items.words[i]
        merged: list[list[int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            if np.isin(item, words[a:b]).sum() < threshold * len(item) - 1e-9:
                continue
            score, first, last = aligned(item, words[a:b])
            best = max(best, (score, a + first, a + last))
        share = best[0] / (MATCH * len(item))
        if best[0] and share >= threshold:
            out.append({"item_id": items.ids[i], "score": share, "first_word": best[1], "last_word": best[2]})
    return sorted(out, key=lambda x: x["item_id"])


def mark_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a column leaks: the items of ``benchmark`` (item_id, text) each text holds, by item_id, with score
    (alignment score over that of a perfect copy, at least ``threshold``) and first and last word of the passage.

    A-Z count as lower case, words lie between ASCII white space. The benchmark is a stated set of queries:
    it is taken in blocks of BLOCK_ITEMS; each block costs one pass that aligns where the text is read. Texts are never shuffled.

    Null and empty texts, and items without text, words or item_id, match nothing; an item of
    fewer words than a seed is found only in texts that are as short, not inside longer ones.
    Repeated rows and items are judged alike; a column named leaks is replaced, all others are kept;
    no rows give no rows, and without items nothing leaks.
    """
    named = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna()
    blocks = max(1, -(-named.count() // BLOCK_ITEMS))
    docs = docs.drop("leaks").withColumn("text", F.col("text").cast("string"))
    out = docs.withColumn("leaks", F.array().cast(LEAKS))
    schema = T.StructType([*docs.schema.fields, T.StructField("leaks", LEAKS)])
    for block in range(blocks):
        rows = named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        words = [w for w in (_words(pa.array([r["text"]]))[0] for r in rows)]
        if any(map(len, words)):
            items = Items([r["item_id"] for r, w in zip(rows, words) if len(w)], [w for w in words if len(w)])
            out = out.mapInArrow(_marker(items, threshold), schema)
    return out


def _marker(items: Items, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text"):
            word, of = _words(batch.column("text"))
            gram, bounds = K.shingles(word, of, SEED_WORDS)
            at = np.minimum(np.searchsorted(items.keys, gram), len(items.keys) - 1)
            found = np.flatnonzero(items.keys[at] == gram)
            cuts = np.searchsorted(found, bounds)
            leaks = batch.column("leaks").to_pylist()
            for doc in np.flatnonzero(np.diff(cuts)).tolist():
                mine = found[cuts[doc] : cuts[doc + 1]]
                new = _leaks_of(word[of[doc] : of[doc + 1]], mine - bounds[doc], at[mine], items, threshold)
                if new:
                    leaks[doc] = sorted(leaks[doc] + new, key=lambda x: x["item_id"])
            columns = [*(batch.column(c) for c in batch.schema.names if c != "leaks"), pa.array(leaks, _LEAKS)]
            yield pa.record_batch(columns, [*(c for c in batch.schema.names if c != "leaks"), "leaks"])

    return run
