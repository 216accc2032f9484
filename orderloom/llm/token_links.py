"""Alignment of two tokenizers: the tokens of both that cover common bytes, and the cuts where both end.

A text with its leading space is cut into segments at the spaces where neither tokenizer can join
what stands before and behind. Equal segments of a chunk are encoded and merged once. All segments of a chunk move forward in lockstep:
one state vector holds a pointer to the current token of either side, each step emits one link and perhaps a cut of
every segment that is not done, and finished ones are taken out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import kernels as K
from orderloom.llm.scratch import Scratch

#: Text bytes that are aligned at once.
CHUNK_BYTES = 8 << 20
#: Id pairs that are sent to every worker as one table of 16 bytes each; more of them are joined instead.
TABLE_PAIRS = 4_000_000
#: Text bytes of a group of documents where counts are joined.
GROUP_BYTES = 8 << 20
_SPACES = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}"
#: Texts in which some space is no place to cut: one at the start or end, or before white space.
_UNSAFE = rf"^ | (?:[{_SPACES}]|$)"
_CUT = re.compile(r"(?<! ) (?=\S)")
_PAIR_SIDE = 32  # bits of either id in a pair's code


class Tokenizers:
    """A byte-level BPE (A) and a sentence-piece model (B), with the number of bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_size, self.b_size = self.a.get_vocab_size(), self.b.get_piece_size()
        # One character of a byte-level token stands for one byte.
        self.a_bytes, self.a_opens = np.zeros(self.a_size, np.int64), np.zeros(self.a_size, bool)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i], self.a_opens[i] = len(token), token.startswith("Ġ")
        pieces = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b_size)]
        self.b_bytes = np.array([len(p) for p in pieces], np.int64)
        self.b_pieces = np.array(pieces, object)
        #: Decimal ids, filled up with zero bytes.
        self.decimals = np.arange(max(self.a_size, self.b_size)).astype("S10").view(np.uint8).reshape(-1, 10)

    def encode_a(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word with a space before it, and their bounds."""
        plain = [w for w in words if " " not in w]
        runs = [" " + " ".join(plain[k : k + 64]) for k in range(0, len(plain), 64)]
        found = self.a.encode_batch_fast(runs, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int64)
        bounds = np.r_[np.flatnonzero(self.a_opens[ids]), len(ids)] if len(ids) else np.zeros(1, np.int64)
        if len(bounds) != len(plain) + 1:
            raise ValueError("a word of byte-level tokens does not begin with the only space in it")
        if len(plain) == len(words):
            return ids, bounds
        rest = [" " + w for w in words if " " in w]
        others = (e.ids for e in self.a.encode_batch_fast(rest, add_special_tokens=False))
        parts = iter(np.split(ids, bounds[1:-1]) if plain else [])
        return _flat([next(others) if " " in w else next(parts) for w in words])

    def encode_b(self, words: list[str]) -> list[list[int]]:
        return self.b.encode(words, num_threads=1) if words else []


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """One pair per worker and files."""
    return Tokenizers(a_path, b_path)


def _flat(parts: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter(chain.from_iterable(parts), np.int64, int(sizes.sum())), np.r_[0, np.cumsum(sizes)]


def _ends(sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes from the start of its segment."""
    upto = np.r_[0, np.cumsum(sizes)]
    return upto[1:] - np.repeat(upto[bounds[:-1]], np.diff(bounds))


def lockstep(a_ends: np.ndarray, a_of: np.ndarray, b_ends: np.ndarray, b_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links of all segments at once: (token of A, token of B, bounds of each segment's links, cut after A, cut after B).

    Tokens are places in the flat arrays; ``a_of`` and ``b_of`` bound each segment's. Both sides of a segment
    end at the same byte, or it has no tokens on either side.
    """
    most = np.diff(a_of) + np.diff(b_of)  # a link ends a token of one side or both
    place = np.r_[0, np.cumsum(most)][:-1]
    left, right = np.full(int(most.sum()), -1), np.full(int(most.sum()), -1)
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    live = np.flatnonzero((np.diff(a_of) > 0) & (np.diff(b_of) > 0))
    state = np.stack([a_of[live], b_of[live], place[live], a_of[live + 1]])
    while state.shape[1]:
        a, b, at, stop = state
        left[at], right[at] = a, b
        x, y = a_ends[a], b_ends[b]
        cut = x == y
        a_cut[a[cut]], b_cut[b[cut]] = True, True
        state = np.stack([a + (x <= y), b + (y <= x), at + 1, stop])
        if cut.any():
            done = state[0] >= stop
            if done.any():
                state = state[:, ~done]
    used = left >= 0
    bounds = np.r_[0, np.cumsum(used)][np.r_[place, len(left)]]
    return left[used], right[used], bounds, a_cut, b_cut


def _spelled(digits: np.ndarray, closing: np.ndarray, end: bytes) -> np.ndarray:
    """Rows of digits, each with a comma behind it or ``end`` where ``closing``; unused bytes are 0."""
    return np.concatenate([digits, np.where(closing, end[0], ord(",")).astype(np.uint8)[:, None]], axis=1)


class Segments:
    """Different segments of a chunk, aligned. ``valid`` tells where the bytes of both tokenizations are the segment's."""

    def __init__(self, tools: Tokenizers, words: list[str]):
        self.tools = tools
        self.a, self.a_of = tools.encode_a(words)
        self.b, self.b_of = _flat(tools.encode_b(words))
        texts = [b" " + w.encode() for w in words]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        whole = np.r_[0, np.cumsum(tools.b_bytes[self.b])][self.b_of]
        a_whole = np.r_[0, np.cumsum(tools.a_bytes[self.a])][self.a_of]
        self.valid = (np.diff(whole) == sizes) & (np.diff(a_whole) == sizes)
        joined = b"".join(tools.b_pieces[self.b].tolist())
        cuts = whole.tolist()
        self.valid &= np.fromiter((joined[x:y] == t for x, y, t in zip(cuts, cuts[1:], texts)), bool, len(texts))
        if not self.valid.all():
            keep_a, keep_b = (np.repeat(self.valid, np.diff(of)) for of in (self.a_of, self.b_of))
            self.a, self.b = self.a[keep_a], self.b[keep_b]
            self.a_of, self.b_of = (np.r_[0, np.cumsum(np.where(self.valid, np.diff(of), 0))] for of in (self.a_of, self.b_of))
        left, right, self.links_of, self.a_cut, self.b_cut = lockstep(
            _ends(tools.a_bytes[self.a], self.a_of), self.a_of, _ends(tools.b_bytes[self.b], self.b_of), self.b_of
        )
        self.pairs = (self.a[left] << _PAIR_SIDE) | self.b[right]

    def totals(self) -> list[np.ndarray]:
        """Tokens of A, tokens of B, groups and links of each segment."""
        groups = np.diff(np.r_[0, np.cumsum(self.a_cut)][self.a_of])
        return [np.diff(self.a_of), np.diff(self.b_of), groups, np.diff(self.links_of)]

    def spelled(self) -> pa.Array:
        """Each segment's groups as text, every group closed by a semicolon."""
        digits = self.tools.decimals
        rows = np.concatenate([_spelled(digits[self.a], self.a_cut, b"|"), _spelled(digits[self.b], self.b_cut, b";")])
        # Tokens in order of group, A before B; the sort is stable.
        group = np.r_[np.cumsum(self.a_cut) - self.a_cut, np.cumsum(self.b_cut) - self.b_cut]
        side = np.r_[np.zeros(len(self.a), np.int64), np.ones(len(self.b), np.int64)]
        order = np.argsort(2 * group + side, kind="stable")
        rows = rows[order]
        sizes = np.count_nonzero(rows, axis=1)
        raw = rows[rows != 0]
        tokens_of = self.a_of + self.b_of
        bounds = np.r_[0, np.cumsum(sizes)][tokens_of]
        return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])

    def rated(self, counts: np.ndarray, best: np.ndarray) -> list[np.ndarray]:
        """Links whose count is the best of their B id, and the sum of counts, of each segment."""
        return [np.diff(np.r_[0, np.cumsum(x)][self.links_of]) for x in (best.astype(np.int64), counts)]


def _cut_by_hand(text: str) -> list[str]:
    """Segments of " " + text, each without its leading space."""
    whole = " " + text
    at = [0, *(m.start() for m in _CUT.finditer(whole, 1)), len(whole)]
    return [whole[x + 1 : y] for x, y in zip(at, at[1:])]


class Chunk:
    """The segments of some texts: the different ones, and for each text which of them it consists of."""

    def __init__(self, tools: Tokenizers, column: pa.Array):
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        plain, by_hand = np.flatnonzero(filled & ~odd), np.flatnonzero(filled & odd)
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        parts = [_cut_by_hand(t) for t in texts.take(pa.array(by_hand)).to_pylist()]
        sizes = np.r_[pc.list_value_length(lists).to_numpy(zero_copy_only=False), np.array([len(p) for p in parts], np.int64)]
        values = pa.concat_arrays([lists.flatten(), pa.array(list(chain.from_iterable(parts)), pa.large_string())])
        encoded = values.dictionary_encode()
        self.codes = encoded.indices.to_numpy().astype(np.int64)
        self.segments = Segments(tools, encoded.dictionary.to_pylist())
        #: Texts with segments, and the bounds of theirs in ``codes``; the others have no tokens.
        self.rows, self.bounds = np.r_[plain, by_hand], np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.n = len(column)
        #: Texts that both tokenizers leave as they are.
        self.valid = np.zeros(self.n, bool)
        bad = self._sums(~self.segments.valid) > 0
        self.valid[self.rows[~bad]] = True

    def _sums(self, values: np.ndarray) -> np.ndarray:
        upto = np.r_[0, np.cumsum(values[self.codes], dtype=np.int64)]
        return np.diff(upto[self.bounds])

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of the segments' values over each text, 0 where it has no tokens."""
        out = np.zeros(self.n, np.int64)
        out[self.rows] = self._sums(values)
        out[~self.valid] = 0
        return out

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair codes and how many links hold them."""
        usable = np.repeat(self.valid[self.rows], np.diff(self.bounds))
        times = np.bincount(self.codes[usable], minlength=len(self.segments.valid))
        weight = np.repeat(times, np.diff(self.segments.links_of))
        codes, back = np.unique(self.segments.pairs, return_inverse=True)
        sums = np.zeros(len(codes), np.int64)
        np.add.at(sums, back, weight)
        return codes[sums > 0], sums[sums > 0]

    def digests(self) -> list[str]:
        out = [""] * self.n
        spelled = self.segments.spelled()
        step = max(1, len(self.rows) // 8)
        for first in range(0, len(self.rows), step):  # a part of the texts at a time bounds the memory
            bounds = self.bounds[first : first + step + 1]
            taken = spelled.take(pa.array(self.codes[bounds[0] : bounds[-1]]))
            ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1]
            raw = memoryview(taken.buffers()[2] or b"")
            for row, x, y in zip(self.rows[first : first + step].tolist(), ends[bounds[:-1] - bounds[0]].tolist(), ends[bounds[1:] - bounds[0]].tolist()):
                if self.valid[row]:
                    out[row] = hashlib.sha256(raw[x : y - 1]).hexdigest()
        return out


_COUNTED = "pair long, n long"
_KINDS = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
]
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PairTable:
    """Corpus-wide counts of id pairs and the highest count of each B id."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
        order = np.argsort(pairs)
        self.pairs, self.counts, self.best = pairs[order], counts[order], best[order]

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(pairs):
            return np.zeros(0, np.int64), np.zeros(0, bool)
        different, back = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.pairs, different)
        at = np.minimum(at, max(len(self.pairs) - 1, 0))
        known = self.pairs[at] == different  # pairs of texts without tokens need no count
        return np.where(known, self.counts[at], 0)[back], (known & self.best[at])[back]


def _rows(chunk: Chunk, ids: pa.Array, table: PairTable) -> pa.RecordBatch:
    counts, best = table(chunk.segments.pairs)
    values = [*chunk.segments.totals(), *chunk.segments.rated(counts, best)]
    columns = [ids, *(pa.array(chunk.per_text(v)) for v in values), pa.array(chunk.digests(), pa.string())]
    return pa.record_batch(columns, [n for n, _ in _KINDS])


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, n): how many links of all texts hold the ids a and b linked. Counted per chunk before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(a_path, b_path)
        for batch in K.chunks(batches, "text", CHUNK_BYTES):
            codes, sums = Chunk(tools, batch.column("text")).counted()
            yield pa.record_batch([pa.array(codes), pa.array(sums)], ["pair", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, _COUNTED).groupBy("pair").agg(F.sum("n").alias("n"))
    low = F.lit((1 << _PAIR_SIDE) - 1)
    return counted.select(F.shiftright("pair", _PAIR_SIDE).alias("a"), F.col("pair").bitwiseAND(low).alias("b"), "n")


def _by_table(texts: DataFrame, rated: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every worker holds the counts."""
    found = rated.toArrow()
    pair, n, best = (found.column(c).to_numpy() for c in ("pair", "n", "best"))
    held = texts.sparkSession.sparkContext.broadcast((pair, n, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, table = tokenizers(a_path, b_path), PairTable(*held.value)
        for batch in K.chunks(batches, "text", CHUNK_BYTES):
            yield _rows(Chunk(tools, batch.column("text")), batch.column("doc_id"), table)

    return texts.mapInArrow(run, _RESULT)


def _by_join(scratch: Scratch, texts: DataFrame, rated: DataFrame, a_path: str, b_path: str, group_bytes: int) -> DataFrame:
    """Documents are dealt to groups of about ``group_bytes``; a group meets only the counts of the pairs it holds."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = int(size // group_bytes) + 1
    placed = texts.withColumn("_place", F.monotonically_increasing_id())
    dealt = scratch.cut(placed.withColumn("_group", F.pmod(F.xxhash64("_place"), F.lit(groups))), "grouped").drop("_place")

    def held(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(a_path, b_path)
        for batch in K.chunks(batches, "text", CHUNK_BYTES):
            codes = np.unique(Chunk(tools, batch.column("text")).segments.pairs)
            yield pa.record_batch([pa.array(np.full(len(codes), key[0].as_py())), pa.array(codes)], ["_group", "pair"])

    def rows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        tools = tokenizers(a_path, b_path)
        table = PairTable(*(right.column(c).to_numpy() for c in ("pair", "n", "best")))
        parts = [_rows(Chunk(tools, b.column("text")), b.column("doc_id"), table) for b in K.chunks(left.to_batches(), "text", CHUNK_BYTES)]
        return pa.Table.from_batches(parts, pa.schema(_KINDS))

    wanted = dealt.groupBy("_group").applyInArrow(held, "_group long, pair long").distinct()
    met = scratch.cut(wanted.join(rated, "pair"), "met")
    return dealt.groupBy("_group").cogroup(met.groupBy("_group")).applyInArrow(rows, _RESULT)


def token_links(docs: DataFrame, a_path: str, b_path: str, table_pairs: int = TABLE_PAIRS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Per document: tokens of A and B, groups, links, links that are best for their B id, sum of the links' counts, and the groups' hash.

    A encodes a space and the text, B the text. The links are all pairs of an A token and a B token that overlap in bytes. A pair's count is
    its number of links in the whole table. It is the best of its B id if no pair with that id has a higher count.

    The texts are read twice: to count pairs, then to look counts up. Up to ``table_pairs`` different pairs are sent to the workers as one
    table; with more, groups of documents are joined with the counts they need. Both give the same rows.

    A null or empty text, and one whose bytes either tokenizer changes, has zeros and an empty hash. A null doc_id is carried along,
    repeated rows count each for themselves, other columns are ignored; no rows give no rows. A text without a place to cut is one segment, however long.
    """
    scratch = Scratch(docs.sparkSession, "token-links")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = pair_counts(texts, a_path, b_path)
    stored = scratch.cut(counts, "pairs")
    highest = stored.groupBy("b").agg(F.max("n").alias("_highest"))
    pair = F.shiftleft("a", _PAIR_SIDE).bitwiseOR(F.col("b")).alias("pair")
    rated = stored.join(highest, "b").select(pair, "n", (F.col("n") == F.col("_highest")).alias("best"))
    if stored.count() <= table_pairs:
        found = _by_table(texts, rated, a_path, b_path)
        scratch.drop()
        return found
    # What the groups read stays in the shared folder until the caller has written the result.
    return _by_join(scratch, texts, rated, a_path, b_path, group_bytes)
