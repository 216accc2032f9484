"""Token ids on disk: blocks of raw ids, each with a minimal perfect hash index from document key to place.

A block holds consecutive documents in doc_id order. Its index maps each key to one of
n slots without gaps; the slot holds the key's fingerprint, the offset of its first id and their
number, so a key is found, or known to be absent, with one look.

Block row: task, block, first_key, last_key, n_docs, n_tokens, id_bytes, keys, pilots, prints, offsets, lengths, payload.
Keys are (doc_id, how many earlier documents of the block have it). Pilots, prints, offsets and
lengths are little-endian arrays (int32, uint64, uint64, uint64); the payload is the ids one after
the other, ``id_bytes`` each. Blocks are Parquet rows, so any store that Spark writes to will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm import kernels as K
from orderloom.llm.tokens import byte_bpe

#: A block is closed once its ids reach this many bytes.
BLOCK_BYTES = 4 << 20
#: Keys per bucket of the hash.
BUCKET_KEYS = 4
#: Keys that one call of ``lookup`` takes.
MAX_KEYS = 10_000
_SEEDS = K.random_words(11, 4)
BLOCK = pa.schema(
    [
        ("task", pa.int32()), ("block", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()),
        ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("id_bytes", pa.int32()), ("keys", pa.list_(pa.int64())),
        ("pilots", pa.binary()), ("prints", pa.binary()), ("offsets", pa.binary()), ("lengths", pa.binary()), ("payload", pa.binary()),
    ]
)
_SQL_BLOCK = (
    "task int, block int, first_key long, last_key long, n_docs long, n_tokens long, id_bytes int, keys array<long>, "
    "pilots binary, prints binary, offsets binary, lengths binary, payload binary"
)


def hashed(ids: np.ndarray, absent: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """64-bit hash of keys; ``absent`` marks a null doc_id, ``repeat`` counts earlier equal ones."""
    return K.mix(K.mix(ids.astype(np.int64).view(K.U64) ^ _SEEDS[0]) + repeat.astype(K.U64) * _SEEDS[1] + absent.astype(K.U64) * _SEEDS[2])


def _slot(hashes: np.ndarray, pilot: np.ndarray | int, n: int) -> np.ndarray:
    return K.mix(hashes ^ (np.asarray(pilot).astype(K.U64) * _SEEDS[3])) % K.U64(n)


def perfect_hash(hashes: np.ndarray) -> np.ndarray:
    """A pilot per bucket that sends different hashes to different slots of 0 to n - 1.

    Full buckets come first. A bucket of one key takes a free slot outright: pilot -1 - slot.
    """
    n = len(hashes)
    if len(np.unique(hashes)) < n:
        raise ValueError("two keys have one 64-bit hash")
    buckets = max(1, -(-n // BUCKET_KEYS))
    bucket = (hashes >> K.U64(32)) % K.U64(buckets)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=K.U64))
    sizes = np.diff(bounds)
    pilots, used = np.zeros(buckets, "<i4"), np.zeros(n, bool)
    tries = np.arange(64)
    for b in np.argsort(-sizes, kind="stable").tolist():
        own = hashes[order[bounds[b] : bounds[b + 1]]]
        if len(own) < 2:
            break
        first = 0
        while True:
            slots = np.sort(_slot(own[None, :], (first + tries)[:, None], n).astype(np.int64), axis=1)
            good = ~used[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
            if good.any():
                i = int(good.argmax())
                pilots[b], used[slots[i]] = first + i, True
                break
            first += len(tries)
    free = np.flatnonzero(~used)
    alone = np.flatnonzero(sizes == 1)
    pilots[alone] = -1 - free
    return pilots


def slots(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    pilot = pilots[((hashes >> K.U64(32)) % K.U64(len(pilots))).astype(np.int64)].astype(np.int64)
    return np.where(pilot < 0, -1 - pilot, _slot(hashes, np.maximum(pilot, 0), n).astype(np.int64))


def _repeats(ids: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """How many equal keys come before each; equal keys stand together."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (absent[1:] != absent[:-1])
    at = np.arange(len(ids))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _block(task: int, number: int, keys: list[int | None], parts: list[bytes], width: int) -> pa.RecordBatch:
    absent = np.array([k is None for k in keys])
    ids = np.array([k or 0 for k in keys], np.int64)
    lengths = np.array([len(p) // width for p in parts], "<u8")
    hashes = hashed(ids, absent, _repeats(ids, absent))
    pilots = perfect_hash(hashes)
    at = slots(hashes, pilots, len(keys))
    prints, offsets, sizes = (np.zeros(len(keys), "<u8") for _ in range(3))
    prints[at], offsets[at], sizes[at] = K.mix(hashes + _SEEDS[2]), np.r_[0, np.cumsum(lengths)[:-1]], lengths
    named = [k for k in keys if k is not None]
    row = (
        task, number, min(named, default=None), max(named, default=None), len(keys), int(lengths.sum()), width, keys,
        *(x.tobytes() for x in (pilots, prints, offsets, sizes)), b"".join(parts),
    )
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, BLOCK)], schema=BLOCK)


def _blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tokens, number, keys, parts, size = TaskContext.get().partitionId(), byte_bpe(path), 0, [], [], 0
        end = np.array([end_id], tokens.kind).tobytes()
        for batch in K.chunks(batches, "text"):
            keys += batch.column("doc_id").to_pylist()
            encoded = [ids + end for ids in tokens.ids([t or "" for t in batch.column("text").to_pylist()])]
            parts += encoded
            size += sum(map(len, encoded))
            if size >= BLOCK_BYTES:
                yield _block(task, number, keys, parts, tokens.kind.itemsize)
                number, keys, parts, size = number + 1, [], [], 0
        if keys:
            yield _block(task, number, keys, parts, tokens.kind.itemsize)

    return run


def write_store(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode whole texts, ``end_id`` after each, and write them in ascending doc_id order to blocks under ``path``.

    One shuffle of the texts by ranges of (doc_id, place in the input); encoding happens behind it.
    A null or empty text is its end id alone. Null doc_ids come first; equal doc_ids keep the order of the input, may
    lie in several blocks and are told apart by their count within the block. Other columns are ignored. No rows give no blocks.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_place")]
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("_place"))
    dealt = texts.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_place")
    dealt.mapInArrow(_blocks(vocabulary, end_id), _SQL_BLOCK).write.option("compression", "zstd").parquet(path)


class _Index:
    """One block's index and payload."""

    def __init__(self, row: dict):
        self.n, self.kind = row["n_docs"], np.dtype(f"<u{row['id_bytes']}")
        self.pilots = np.frombuffer(row["pilots"], "<i4")
        self.prints, self.offsets, self.lengths = (np.frombuffer(row[c], "<u8") for c in ("prints", "offsets", "lengths"))
        self.payload = np.frombuffer(row["payload"], self.kind)

    def find(self, ids: np.ndarray, absent: np.ndarray, repeat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, and whether the fingerprint there is the key's."""
        hashes = hashed(ids, absent, repeat)
        at = slots(hashes, self.pilots, self.n)
        return at, self.prints[at] == K.mix(hashes + _SEEDS[2])

    def ids(self, slot: int) -> np.ndarray:
        return self.payload[int(self.offsets[slot]) : int(self.offsets[slot] + self.lengths[slot])]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        index = _Index(row)
        absent = np.array([k is None for k in row["keys"]])
        ids = np.array([k or 0 for k in row["keys"]], np.int64)
        at, found = index.find(ids, absent, _repeats(ids, absent))
        if not found.all():
            raise ValueError("a key of the block is not in its index")
        crc = [zlib.crc32(index.ids(s).astype("<u4").tobytes()) for s in at.tolist()]
        n = len(ids)
        yield pa.record_batch(
            [
                pa.array(np.full(n, row["task"], np.int32)), pa.array(np.full(n, row["block"], np.int32)), pa.array(row["keys"], pa.int64()),
                pa.array(index.offsets[at].astype(np.int64)), pa.array(index.lengths[at].astype(np.int64)), pa.array(crc, pa.int64()),
            ],
            ["task", "block", "doc_id", "offset", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, each read through its block's index."""
    blocks = spark.read.schema(_SQL_BLOCK).parquet(path)
    before = Window.orderBy("task", "block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("task", "block", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_base"))
    rows = blocks.mapInArrow(_digests, "task int, block int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    joined = rows.join(bases, ["task", "block"])
    return joined.select("doc_id", (F.col("_base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def _found(keys: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            index, out = _Index(row), []
            asked = np.array([k for k in keys if row["first_key"] <= k <= row["last_key"]], np.int64)
            repeat = 0
            while len(asked):  # the next of equal keys, until there is none
                at, found = index.find(asked, np.zeros(len(asked), bool), np.full(len(asked), repeat))
                out += [(int(k), index.ids(s).tolist()) for k, s in zip(asked[found], at[found].tolist())]
                asked, repeat = asked[found], repeat + 1
            yield pa.record_batch([pa.array([k for k, _ in out], pa.int64()), pa.array([v for _, v in out], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return run


def lookup(spark: SparkSession, path: str, keys: Sequence[int]) -> DataFrame:
    """doc_id, ids of the documents with these ids; absent keys give no row.

    Only blocks whose key range holds a key are read (Parquet statistics skip the
    rest); in a block each key costs one look.
    """
    keys = sorted(set(keys))
    if len(keys) > MAX_KEYS:
        raise ValueError(f"at most {MAX_KEYS} keys a call")
    blocks = spark.read.schema(_SQL_BLOCK).parquet(path)
    if keys:
        blocks = blocks.filter((F.col("last_key") >= keys[0]) & (F.col("first_key") <= keys[-1]))
        blocks = blocks.filter(F.exists(F.lit(keys), lambda k: k.between(F.col("first_key"), F.col("last_key"))))
    else:
        blocks = blocks.limit(0)
    return blocks.mapInArrow(_found(keys), "doc_id long, ids array<long>")
