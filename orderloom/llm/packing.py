"""Packing by powers of two: a document is cut into pieces whose lengths are the powers of its binary length.

Pieces of one length form a bucket, so each sequence is one piece: none crosses
documents and none is padded.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm import kernels as K
from orderloom.llm.tokens import CACHE_WORDS, byte_bpe
from orderloom.session import cut

_KINDS = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("_task", pa.int32()), ("_place", pa.int64()),
]


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as whole ``longest`` ones, then falling powers of two."""
    return [longest] * (n // longest) + [1 << i for i in reversed(range(longest.bit_length() - 1)) if n & (1 << i)]


def _pieces(path: str, end_id: int, longest: int, with_ids: bool, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tokens, placed = TaskContext.get().partitionId(), byte_bpe(path, cache_words), Counter()
        for batch in K.chunks(batches, "text"):
            out = []
            encoded = tokens.ids([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoded):
                ids = np.append(np.frombuffer(raw, tokens.kind), end_id).astype("<u4").tobytes()
                start, n = 0, len(ids) // 4
                for length in binary_lengths(n, longest):
                    piece = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, length, zlib.crc32(piece), n, piece if with_ids else None, task, placed[length]))
                    placed[length] += 1
                    start += length
            columns = list(zip(*out)) or [[] for _ in _KINDS]
            yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(columns, _KINDS)], [n for n, _ in _KINDS])

    return run


def pack_by_powers(
    docs: DataFrame, vocabulary: str, end_id: int = 0, longest: int = 1024, with_ids: bool = True, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and the piece's ids.

    ``docs`` (doc_id, text) is encoded whole, ``end_id`` is put after each document.
    ``longest`` is a power of two. sequence_id counts from 0, bucket after bucket from the longest;
    offset is always 0. ids are little-endian unsigned 32-bit integers, null unless ``with_ids``.
    ``cache_words`` bounds what a worker remembers of words it has encoded; it changes no result.

    Documents are encoded where they are read and written once with their place among the task's pieces of that length;
    the places of all tasks then follow from one count per task and length.

    A null or empty text is its end id alone; a null doc_id is carried along; repeated
    rows are documents of their own; other columns are ignored; no rows give no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, _task int, _place long"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = cut(texts.mapInArrow(_pieces(vocabulary, end_id, longest, with_ids, cache_words), schema), "pieces")
    counts = pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.desc("length"), "_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return pieces.join(bases, ["length", "_task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_base") + F.col("_place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids",
    )
