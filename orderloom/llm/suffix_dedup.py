"""Exact substring deduplication: bytes covered by a string of 50 that starts in an earlier document too.

Seeds: in every 50 bytes the least hash among the 16-byte spans marks one, wherever the 50 bytes stand, so equal
strings share a seed at the same place. Seeds meet by hash. The context of a seed is all that a 50-byte string around it can
cover. Equal contexts settle at once: all but the smallest document's are covered. Where contexts differ, their right and
reversed left sides are suffix sorted (``suffix_sort``) and the common extensions tell which strings are shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import kernels as K
from orderloom.llm.parcels import from_planes, gathered, packed, planes, unpacked
from orderloom.llm.suffix_sort import Suffixes
from orderloom.llm.scratch import Scratch
from orderloom.session import cut

LENGTH = 50
SEED = 16
#: Seed starts within a string; a context reaches this many bytes less one to either side of its seed.
REACH = LENGTH - SEED + 1
#: Text whose seeds make up one bucket.
BUCKET_BYTES = 8 << 20
#: Contexts of a bucket that are sorted together, about.
BUCKET_CONTEXTS = 40_000
#: A seed with more contexts than this is not sorted in one task: its strings are matched one by one.
HOT_CONTEXTS = 500_000
_RECORD = np.dtype([("key", "<u8"), ("ctx_low", "<u4"), ("ctx_high", "<u2"), ("doc", "<u2"), ("at", "<u4"), ("size", "u1"), ("left", "u1")])
_SPAN = np.dtype([("doc", "<u2"), ("at", "<u4"), ("size", "u1")])


def _seeds(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """key, context hash, text, start and size of the context, and bytes of it before the seed, of each seed."""
    spans = K.SpanHash(raw)
    keys = spans.sliding(SEED)
    text = K.owners(bounds)[: len(keys)]
    inside = np.arange(len(keys)) + SEED <= bounds[text + 1]
    keys[~inside] = K.U64(2**64 - 1)
    at = np.flatnonzero(K.local_minima(keys, REACH) & inside)
    text = text[at]
    low, high = np.maximum(at - REACH + 1, bounds[text]), np.minimum(at + LENGTH, bounds[text + 1])
    whole = high - low >= LENGTH
    at, text, low, high = at[whole], text[whole], low[whole], high[whole]
    # The place of the seed counts: contexts at a text's ends may be shifted against each other.
    context = K.mix(spans(low, high) + (at - low).astype(K.U64))
    return keys[at], context, text, low - bounds[text], high - low, at - low


def _sender(buckets: int):
    """Per gathered chunk and bucket: the documents, their seeds, and spans already known to be covered.

    Of equal contexts in the chunk only the smallest document's goes out, so copies are combined before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches):
            found, offset = [], 0
            for batch in table.to_batches():
                raw, bounds = K.utf8(batch.column("text"))
                key, context, text, at, size, left = _seeds(raw, bounds)
                found.append((key, context, text + offset, at, size, left))
                offset += batch.num_rows
            key, context, text, at, size, left = map(np.concatenate, zip(*found))
            ids, marks = (np.asarray(table.column(c)) for c in ("doc_id", "mark"))
            order = np.lexsort((ids[text], context, key))
            key, context, text, at, size, left = (x[order] for x in (key, context, text, at, size, left))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
            least = ids[text][np.flatnonzero(new)][np.cumsum(new) - 1] if len(new) else ids[:0]
            out = ids[text] == least
            records = np.zeros(out.sum(), _RECORD)
            records["key"], records["doc"], records["at"], records["size"] = key[out], text[out], at[out], size[out]
            records["left"] = left[out]
            records["ctx_low"], records["ctx_high"] = context[out] & K.U64(2**32 - 1), (context[out] >> K.U64(32)) & K.U64(2**16 - 1)
            done = np.zeros((~out).sum(), _SPAN)
            done["doc"], done["at"], done["size"] = text[~out], at[~out], size[~out]
            bucket = (records["key"] % K.U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            rows = []
            for b in full.tolist():
                mine = records[order[cuts[b] : cuts[b + 1]]]
                mine = mine[np.lexsort((mine["at"], mine["doc"]))]
                used, mine["doc"] = np.unique(mine["doc"], return_inverse=True)
                rows.append((b, planes(ids[used]), marks[used].tobytes(), packed(mine), b""))
            if len(done):
                used, done["doc"] = np.unique(done["doc"], return_inverse=True)
                rows.append((int(ids[used[0]]) % buckets, planes(ids[used]), marks[used].tobytes(), b"", packed(done)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), *[pa.binary()] * 4]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "ids", "marks", "seeds", "done"])

    return run


_FOUND = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("key", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("left", pa.int64()), ("hot", pa.bool_())])
_SQL_FOUND = "doc_id long, mark long, key long, at long, size long, left long, hot boolean"


def _meeting(hot_contexts: int):
    """Covered contexts (key null) and contexts to compare (with key) of one bucket."""

    def met(table: pa.Table) -> pa.Table:
        seeds, spans = [], []
        for ids, marks, sent, done in zip(*(table.column(c).to_pylist() for c in ("ids", "marks", "seeds", "done"))):
            ids, marks = from_planes(ids, np.int64), np.frombuffer(marks, np.int64)
            for raw, kind, to in ((sent, _RECORD, seeds), (done, _SPAN, spans)):
                if raw:
                    rows = unpacked(raw, kind)
                    to.append((rows, ids[rows["doc"]], marks[rows["doc"]]))
        parts = []
        if spans:
            rows, ids, marks = map(np.concatenate, zip(*spans))
            spans.clear()
            parts.append((ids, marks, np.zeros(len(ids), np.int64), np.ones(len(ids), bool), rows["at"], rows["size"], np.zeros(len(ids), "u1"), np.zeros(len(ids), bool)))
        if seeds:
            rows, ids, marks = map(np.concatenate, zip(*seeds))
            seeds.clear()
            context = rows["ctx_low"].astype(K.U64) | rows["ctx_high"].astype(K.U64) << K.U64(32)
            order = np.lexsort((ids, context, rows["key"]))
            rows, ids, marks, context = rows[order], ids[order], marks[order], context[order]
            new_key = np.ones(len(rows), bool)
            new_key[1:] = rows["key"][1:] != rows["key"][:-1]
            new = new_key.copy()
            new[1:] |= context[1:] != context[:-1]
            least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            run = np.cumsum(new_key) - 1
            several = np.bincount(run, weights=new)[run] > 1
            covered = ids > least
            kept = covered | several
            hot = np.bincount(run, weights=several & ~covered)[run] > hot_contexts
            parts.append((ids[kept], marks[kept], rows["key"][kept].view(np.int64), covered[kept], rows["at"][kept], rows["size"][kept], rows["left"][kept], hot[kept]))
        if not parts:
            return _FOUND.empty_table()
        ids, marks, keys, null, at, size, left, hot = map(np.concatenate, zip(*parts))
        numbers = (pa.array(x, pa.int64()) for x in (at, size, left))
        return pa.table([pa.array(ids), pa.array(marks), pa.array(keys, mask=null), *numbers, pa.array(hot)], schema=_FOUND)

    return met


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of contexts to compare; ``wanted``: their key, at, size, left and whether the seed is hot."""
    for batch in K.chunks(batches, "text"):
        raw, bounds = K.utf8(batch.column("text"))
        wanted = batch.column("wanted")
        key, at, size, left = (np.asarray(pc.struct_field(wanted.flatten(), n)) for n in ("key", "at", "size", "left"))
        hot = pc.struct_field(wanted.flatten(), "hot")
        text = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(wanted)))
        ids, marks = (np.asarray(batch.column(c))[text] for c in ("doc_id", "mark"))
        ends = np.r_[0, np.cumsum(size)]
        flat = raw[np.repeat(bounds[text] + at - ends[:-1], size) + np.arange(ends[-1])]
        data = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])
        yield pa.record_batch(
            [pa.array(x) for x in (key, ids, marks, at, left)] + [data, hot],
            ["key", "doc_id", "mark", "at", "left", "context", "hot"],
        )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of LENGTH bytes around the seed of each context, by hash."""
    for batch in batches:
        key, ids, marks, at, left = (np.asarray(batch.column(c)) for c in ("key", "doc_id", "mark", "at", "left"))
        raw, bounds = K.utf8(batch.column("context"))
        spans = K.SpanHash(raw)
        for j in range(REACH):
            first = bounds[:-1] + left - (REACH - 1) + j
            x = np.flatnonzero((first >= bounds[:-1]) & (first + LENGTH <= bounds[1:]))
            string = spans(first[x], first[x] + LENGTH).view(np.int64)
            place = at[x] + left[x] - (REACH - 1) + j
            yield pa.record_batch([pa.array(v) for v in (key[x], string, ids[x], marks[x], place)], ["key", "string", "doc_id", "mark", "at"])


def _compared_seeds(table: pa.Table) -> pa.Table:
    """``_compared`` of some seeds, sorted by key."""
    key, ids, marks, at, left = (np.asarray(table.column(c)) for c in ("key", "doc_id", "mark", "at", "left"))
    raw, bounds = K.utf8(table.column("context").chunk(0))
    start, size = bounds[:-1], np.diff(bounds)
    groups = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
    right = size - left - SEED
    sides = []
    for mirrored in (False, True):
        suffixes = Suffixes(np.ascontiguousarray(raw[::-1]), len(raw) - start - left, left) if mirrored else Suffixes(raw, start + left + SEED, right)
        order = suffixes.sort(groups)
        shared = suffixes.neighbours(order, groups)
        shared[groups[:-1]] = -1
        sides.append((order, shared))
    shared_windows = np.zeros((len(key), REACH + 1), bool)
    alike = [np.empty(len(key), np.int64), np.empty(len(key), np.int64)]
    for j in range(REACH):  # the window that ends j bytes behind the seed
        for (order, shared), n, name in zip(sides, (j, REACH - 1 - j), alike):
            name[order] = np.cumsum(shared < n)
        several = [np.bincount(name)[name] > 1 for name in alike]  # a side that no other context has shares nothing
        rows = np.flatnonzero((right >= j) & (left >= REACH - 1 - j) & several[0] & several[1])
        name = alike[0][rows] * (len(key) + 1) + alike[1][rows]
        order = np.lexsort((ids[rows], name))
        rows, name = rows[order], name[order]
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        least = ids[rows][np.flatnonzero(new)][np.cumsum(new) - 1]
        shared_windows[rows[ids[rows] > least], j] = True
    edge = np.diff(np.pad(shared_windows, ((0, 0), (1, 0))).astype(np.int8), axis=1)
    x, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)  # one past the last, in the same order
    return pa.table(
        [pa.array(ids[x]), pa.array(marks[x]), pa.array(at[x] + left[x] - (REACH - 1) + first), pa.array(last - first - 1 + LENGTH)],
        ["doc_id", "mark", "at", "size"],
    )


def _compared(table: pa.Table) -> pa.Table:
    """Spans of contexts that a context of the same seed in a smaller document shares; spans may overlap.

    Whole seeds are compared, about CHUNK_BYTES of contexts at once: the arrays stay small however many contexts a bucket has.
    """
    table = table.sort_by("key").combine_chunks()
    key, size = np.asarray(table.column("key")), np.asarray(pc.binary_length(table.column("context")), np.int64)
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    part = (np.cumsum(size) - size)[heads] // K.CHUNK_BYTES
    cuts = [*heads[np.flatnonzero(np.r_[True, part[1:] != part[:-1]])].tolist(), len(key)]
    return pa.concat_tables([_compared_seeds(table.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])


def _spans_of(text_bytes: int, spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[list[int]] = []
    for a, b in sorted((s["at"], s["at"] + s["size"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, text_bytes)) for a, b in out]


_RESULT = [
    ("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("n_spans", "long", pa.int64()),
    ("kept_sha256", "string", pa.string()), ("kept_text", "string", pa.string()),
]


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in K.chunks(batches, "text"):
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist()):
            raw = (text or "").encode()
            gone = _spans_of(len(raw), spans)
            parts = [raw[a:b] for (_, a), (b, _) in zip([(0, 0), *gone], [*gone, (len(raw), 0)])]
            kept = b"".join(parts)
            readable = "".join(p.decode("utf-8", "ignore") for p in parts)
            rows.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), readable))
        columns = list(zip(*rows)) or [()] * len(_RESULT)
        others = [c for c in batch.schema.names if c != "__spans"]
        arrays = [pa.array(c, k) for c, (_, _, k) in zip(columns, _RESULT)]
        yield pa.record_batch([*(batch.column(c) for c in others), *arrays], [*others, *(n for n, _, _ in _RESULT)])


def covered_spans(docs: DataFrame, hot_contexts: int = HOT_CONTEXTS, cut=cut) -> DataFrame:
    """doc_id, mark (xxhash64 of the text) and spans (at, size in UTF-8 bytes; they may overlap) to remove.

    Three shuffles: seeds by hash (about one in 17 bytes, copies combined in each task); the texts of documents
    that have contexts to compare, by document; those contexts by hash. The strings around a seed with more than ``hot_contexts``
    contexts are matched by their hash, the smallest document of each found with partial aggregates.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("string"))
    texts = texts.filter(f"doc_id IS NOT NULL AND octet_length(text) >= {LENGTH}")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    sent = texts.mapInArrow(_sender(buckets), "bucket long, ids binary, marks binary, seeds binary, done binary")
    met = cut(sent.groupBy("bucket").applyInArrow(_meeting(hot_contexts), _SQL_FOUND), "seeds")
    wanted = met.filter("key IS NOT NULL").groupBy("doc_id", "mark").agg(F.collect_list(F.struct("key", "at", "size", "left", "hot")).alias("wanted"))
    keyed = met.filter("key IS NOT NULL")
    hot = keyed.filter("hot").limit(1).count()
    contexts = texts.join(wanted, ["doc_id", "mark"]).mapInArrow(
        _contexts, "key long, doc_id long, mark long, at long, left long, context binary, hot boolean"
    )
    if hot:
        contexts = cut(contexts, "contexts")
    groups = max(1, -(-keyed.count() // BUCKET_CONTEXTS))
    sorted_ = contexts.filter("NOT hot").groupBy(F.pmod("key", F.lit(groups)).alias("_bucket"))
    compared = sorted_.applyInArrow(_compared, "doc_id long, mark long, at long, size long")
    if hot:
        strings = contexts.filter("hot").mapInArrow(_strings, "key long, string long, doc_id long, mark long, at long")
        least = strings.groupBy("key", "string").agg(F.min("doc_id").alias("least"))
        later = strings.join(least, ["key", "string"]).filter("doc_id > least")
        compared = compared.union(later.select("doc_id", "mark", "at", F.lit(LENGTH).cast("long").alias("size")))
    spans = met.filter("key IS NULL").select("doc_id", "mark", "at", "size").union(compared)
    return spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("at", "size")).alias("spans"))


def remove_repeats(docs: DataFrame, keep: Sequence[str] = (), hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """doc_id, text, n_bytes, n_removed, n_spans, kept_sha256 and kept_text for each row of ``docs`` (doc_id, text), and
    the columns named in ``keep``.

    A byte of the UTF-8 text goes if a string of LENGTH bytes around it also starts in a document with a smaller doc_id; overlaps
    count, all strings are judged on the input. n_spans counts maximal removed runs, kept_sha256 is of the bytes that are
    left; kept_text leaves out characters that are cut.

    A null text is empty; shorter texts than LENGTH lose nothing. A row without doc_id neither removes nor loses
    bytes; rows that repeat a doc_id do not remove each other's. Columns not named are left out; no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    spans = cut(covered_spans(docs, hot_contexts, scratch.cut), "spans").toDF("__doc", "__mark", "__spans")
    scratch.drop()
    keep = [c for c in keep if c not in ("doc_id", "text", *(n for n, _, _ in _RESULT))]
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *keep)
    same = (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__mark"))
    joined = texts.join(spans, same, "left").select(*texts.columns, "__spans")
    schema = T.StructType([*texts.schema.fields, *(T.StructField(n, T._parse_datatype_string(k)) for n, k, _ in _RESULT)])
    return joined.mapInArrow(_cleaned, schema)
