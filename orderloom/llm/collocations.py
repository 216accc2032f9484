"""Phrases that stand together more often than their parts, by partitioned mining of frequent phrases.

A phrase that occurs s times in a language occurs at least its share of s times in one of the shards, whatever the shards
are. So every shard is mined completely at that lowered support, word count by word count, the locally frequent
phrases are united, and one more pass counts exactly these over everything. A shard is a part of the rows and is
mined by many tasks: the number of shards does not grow with the data, or the lowered support would fall to 1 and prune nothing.

What a level passes on to the next one is a bit table of fixed size over hashes. It may let too much pass, never too
little; phrases themselves are grouped by their text at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import kernels as K
from orderloom.llm.scratch import Scratch
from orderloom.operators.ranking import top_per_key

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
#: Shards of the mining; at most MIN_COUNT / 3, so that a local support of 1 or 2 cannot come about in shards of equal size.
SHARDS = 6
#: Bits of a table of frequent phrases: 2 to this power, 8 MB, whatever the data.
TABLE_BITS = 26
#: Text bytes counted before rows are sent.
CHUNK_BYTES = 4 << 20
#: Rows sent to Spark at once.
SENT_ROWS = 1 << 17
UNKNOWN = "und"
# What ends a piece, and what stands between words.
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(10, 14)]] = True
_BLANKS = _BREAKS.copy()
_BLANKS[[9, 32]] = True
_BLANK_BYTES = np.flatnonzero(_BLANKS).astype(np.uint8).tobytes()
# As tables of bytes.translate: lower case, blanks as spaces, breaks as ones.
_LOWERED = K.lowered(np.arange(256, dtype=np.uint8)).tobytes()
_SPACED = np.where(_BLANKS, 32, np.arange(256)).astype(np.uint8).tobytes()
_MARKED = _BREAKS.tobytes()
_FACTORS = K.random_words(41, LONGEST) | K.U64(1)
_SHARD_SEEDS = K.random_words(42, SHARDS)
_BUCKET = 1 << 15  # bits in one value of Spark's bitmap functions


class BitTable:
    """Which hashes occur, up to hashes that agree in their upper bits."""

    def __init__(self, words: np.ndarray, bits: int = TABLE_BITS):
        self.words, self.shift = words, K.U64(64 - bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = (keys >> self.shift).astype(np.int64)
        return (self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_table(keys: DataFrame, key: Column, bits: int = TABLE_BITS) -> BitTable:
    """The table of 64-bit hashes; what reaches the driver is 2**bits bits at most."""
    place = F.shiftrightunsigned(key, 64 - bits)
    parts = keys.groupBy(F.shiftright(place, 15).alias("bucket")).agg(F.bitmap_construct_agg(place.bitwiseAND(_BUCKET - 1)).alias("bitmap"))
    words = np.zeros(max(1 << bits, _BUCKET) >> 3, np.uint8)
    for row in parts.toLocalIterator():
        words[row.bucket * (_BUCKET >> 3) :][: _BUCKET >> 3] = np.frombuffer(row.bitmap, np.uint8)
    return BitTable(words, bits)


class Pieces:
    """The words of some texts with exact numbers, and which of them follow each other in a piece."""

    def __init__(self, batch: pa.RecordBatch):
        raw, bounds = K.utf8(batch.column("text"))
        whole = raw.tobytes()
        starts, ends, of = K.words(np.frombuffer(whole.translate(_SPACED), np.uint8), bounds)
        doc = K.owners(of)
        # Words of one piece share the number of breaks before them; the text counts as a break too.
        self.piece = np.searchsorted(np.flatnonzero(np.frombuffer(whole.translate(_MARKED), bool)), starts) + doc
        sizes = ends - starts
        letters = whole.translate(_LOWERED, _BLANK_BYTES)
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        texts = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        encoded = texts.dictionary_encode()
        self.names = encoded.dictionary
        self.word = encoded.indices.to_numpy().astype(np.int64)
        langs = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy().astype(np.int64)[doc]
        self.shard = batch.column("shard").to_numpy().astype(np.int64)[doc]
        name_raw, name_bounds = K.utf8(self.names)
        lang_raw, lang_bounds = K.utf8(self.langs)
        self.hashes = K.SpanHash(name_raw)(name_bounds[:-1], name_bounds[1:])
        self.lang_hashes = K.SpanHash(lang_raw)(lang_bounds[:-1], lang_bounds[1:])

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the ``n`` words from each place on, with the language."""
        total = self.lang_hashes[self.lang[at]] + K.U64(n)
        for j in range(n):
            total = total + self.hashes[self.word[at + j]] * _FACTORS[j]
        return K.mix(total)

    def follow(self, at: np.ndarray, n: int) -> np.ndarray:
        """Places of ``at`` from which ``n`` words lie in one piece."""
        at = at[at + n <= len(self.word)]
        return at[self.piece[at] == self.piece[at + n - 1]]


def _first_and_counts(at: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different combination of ``keys``, and how many there are; exact, number by number."""
    number, span = np.zeros(len(at), np.int64), 1
    for key in keys if len(at) else []:
        width = int(key.max()) + 1
        if span * width >= 1 << 62:
            _, number = np.unique(number, return_inverse=True)
            span = len(at)
        number, span = number * width + key, span * width
    _, number = np.unique(number, return_inverse=True)
    counts = np.bincount(number) if len(at) else np.zeros(0, np.int64)
    first = np.zeros(len(counts), np.int64)
    first[number] = at
    return first, counts


def _sent(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.record_batch(columns, names)
    for first in range(0, whole.num_rows, SENT_ROWS):
        yield whole.slice(first, SENT_ROWS)


def _mined(n: int, below: BitTable | None):
    """Counts of the phrases of ``n`` words whose two parts of n - 1 words are frequent in their shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text", CHUNK_BYTES):
            pieces = Pieces(batch)
            at = pieces.follow(np.arange(len(pieces.word)), n)
            for part in (0, 1) if below else ():
                at = at[below.has(pieces.keys(at + part, n - 1) ^ _SHARD_SEEDS[pieces.shard[at]])]
            group = pieces.lang[at] * SHARDS + pieces.shard[at]
            first, counts = _first_and_counts(at, [group, *(pieces.word[at + j] for j in range(n))])
            langs = pieces.langs.take(pa.array(pieces.lang[first]))
            shards = pa.array(pieces.shard[first].astype(np.int32))
            yield from _sent([langs, shards, pa.array(pieces.keys(first, n).view(np.int64)), pa.array(counts)], ["lang", "shard", "key", "n"])

    return run


def _counted(united: list[BitTable]):
    """Counts of all candidate phrases, with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text", CHUNK_BYTES):
            pieces = Pieces(batch)
            for n, table in enumerate(united, 1):
                at = pieces.follow(np.arange(len(pieces.word)), n)
                at = at[table.has(pieces.keys(at, n))]
                first, counts = _first_and_counts(at, [pieces.lang[at], *(pieces.word[at + j] for j in range(n))])
                words = [pieces.names.take(pa.array(pieces.word[first + j])) for j in range(n)]
                phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if n > 1 else words[0]
                langs = pieces.langs.take(pa.array(pieces.lang[first]))
                texts = phrase.cast(pa.large_string()).cast(pa.string())
                yield from _sent([langs, texts, pa.array(np.full(len(first), n, np.int32)), pa.array(counts)], ["lang", "phrase", "words", "f"])

    return run


def _summed(counts: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Sums of counts that are summed per chunk already: most keys of a task occur in one chunk only, so a second
    map in front of the shuffle would take a task's memory and hardly save a row."""
    return counts.repartition(*keys).groupBy(*keys).agg(F.sum(n).alias(n))


def frequent_phrases(scratch: Scratch, docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of up to ``longest`` words with f >= min_count, (lang, n) words of each language)."""
    shard = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(SHARDS)).cast("int").alias("shard")
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("string").alias("doc_id"))
    texts = texts.select("text", "lang", shard)
    seeds = F.array(*(F.lit(int(x)) for x in _SHARD_SEEDS.view(np.int64)))
    below, united, totals, shares = None, [], None, None
    for n in range(1, longest + 1):
        counts = texts.mapInArrow(_mined(n, below), "lang string, shard int, key long, n long")
        summed = _summed(counts, ["lang", "shard", "key"], "n")
        if n == 1:
            summed = scratch.cut(summed, "words")
            by_shard = scratch.cut(summed.groupBy("lang", "shard").agg(F.sum("n").alias("words")), "shares")
            totals = by_shard.groupBy("lang").agg(F.sum("words").alias("n"))
            # c occurrences in a shard are its share of min_count or more: c * all words >= min_count * words of the shard.
            shares = by_shard.join(totals.withColumnRenamed("n", "all_words"), "lang")
        wide = "decimal(20,0)"
        enough = F.col("n").cast(wide) * F.col("all_words").cast(wide) >= F.lit(min_count).cast("decimal(10,0)") * F.col("words").cast(wide)
        frequent = scratch.cut(summed.join(shares, ["lang", "shard"]).filter(enough).select("shard", "key"), f"frequent-{n}")
        # A shard's own table for the next level, and the union of all shards' phrases for the last pass.
        below = bit_table(frequent, F.col("key").bitwiseXOR(F.element_at(seeds, F.col("shard") + 1)))
        united.append(bit_table(frequent, F.col("key")))
    counted = texts.mapInArrow(_counted(united), "lang string, phrase string, words int, f long")
    exact = _summed(counted, ["lang", "phrase", "words"], "f").filter(F.col("f") >= min_count)
    return scratch.cut(exact, "frequent"), totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, inside_percent: int = 80) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` (doc_id, text, lang). A-Z are lower-cased; ``.,;:!?`` and line ends cut a text into pieces, blanks and tabs a piece
    into words. a is how often the phrase occurs, n how many words the language has. Its weakest cut gives l and r, the
    occurrences of both parts, and score = floor(2000000 a / (l + r)). A phrase inside a longer frequent one
    that has ``inside_percent`` of its occurrences is left out.

    A null lang is ``und``; null and empty texts and those of separators alone have no words; repeated rows count each; a
    null doc_id only decides the shard; other columns are ignored; ties go by a, then by the phrase's bytes; no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    found, totals = frequent_phrases(scratch, docs, min_count, longest)
    wide = "decimal(20,0)"
    word = F.split("phrase", " ", -1)
    candidates = found.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice(word, F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.slice(word, F.col("k") + 1, F.col("words") - F.col("k"))).alias("rest"),
    )
    left = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    product, parts = F.col("a").cast(wide) * F.lit(2_000_000).cast("decimal(7,0)"), F.col("l").cast(wide) + F.col("r").cast(wide)
    scores = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumns({"_product": product, "_parts": parts})
    scores = scores.withColumn("score", F.expr("_product div _parts"))
    weakest = scores.groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut"))
    # Phrases of two words or more inside a longer one, with the longer one's count.
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.concat_ws(" ", F.slice(word, i, n))),
    ))
    inside = candidates.filter("words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    longest_one = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    hidden = F.col("longer").cast(wide) * F.lit(100).cast("decimal(3,0)") >= F.col("a").cast(wide) * F.lit(inside_percent).cast("decimal(3,0)")
    kept = weakest.join(longest_one, ["lang", "phrase"], "left").filter(~F.coalesce(hidden, F.lit(False)))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = top_per_key(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
