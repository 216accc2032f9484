"""Toxicity of a text: logistic regression over hashed word n-grams and skip-grams, learned by FTRL-proximal.

Words are runs of ASCII letters, digits and bytes above 127, lower-cased in ASCII. Features are the presence of words, pairs of
neighbours, triples, and pairs with one or two words left out between them. Each weight has a learning rate of its
own, which falls with the gradients it has seen, and the L1 term keeps most weights at exactly 0: what is left is sent to the workers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import kernels as K
from orderloom.llm.scratch import Scratch

#: Labelled documents that weights are fitted on, about; they are chosen by a hash.
SAMPLE_DOCS = 12_000
#: Hashed features: 2 to this power.
BITS = 20
EPOCHS = 4
#: Learning rate and its smoothing, strengths of the L1 and L2 terms.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 12.0, 0.0
#: The rarer label weighs more, by this power of how much rarer it is.
BALANCE = 0.5
THRESHOLD = 0.7
#: (words, step) of each kind of feature: n-grams have step 1, skip-grams leave step - 1 words out.
GRAMS = [(1, 1), (2, 1), (3, 1), (2, 2), (2, 3)]
_KIND_SEEDS = K.random_words(31, len(GRAMS))
_PLACE_FACTORS = K.random_words(32, 3) | K.U64(1)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text, repeats included, and their n + 1 bounds."""
    raw, bounds = K.utf8(column)
    raw = K.lowered(raw)
    blank = np.where(_WORD[raw], raw, np.uint8(32))
    word, of = K.word_hashes(blank, bounds)
    owner, last = K.owners(of), np.repeat(of[1:], np.diff(of))
    at, values = [], []
    for (n, step), seed in zip(GRAMS, _KIND_SEEDS):
        here = np.flatnonzero(np.arange(len(word)) + (n - 1) * step < last)
        total = np.full(len(here), seed)
        for j in range(n):
            total = total + word[here + j * step] * _PLACE_FACTORS[j]
        at.append(owner[here])
        values.append(K.mix(total) >> K.U64(64 - bits))
    owner = np.concatenate(at)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(values)[order].astype(np.uint32), np.r_[0, np.cumsum(np.bincount(owner, minlength=len(column)))].astype(np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """The learner's state: the sum of adjusted gradients and of their squares, per coordinate. The last one is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1 = np.full((1 << bits) + 1, l1)
        self.l1[-1] = 0.0  # the bias is not drawn to 0

    def weights(self, at) -> np.ndarray:
        z, n, l1 = self.z[at], self.n[at], self.l1[at]
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int, weight: float = 1.0) -> None:
        """One example: the coordinates that are 1 in it, each once, the bias among them."""
        w = self.weights(at)
        g = weight * (sigmoid(w.sum()) - label)
        before = self.n[at]
        after = before + g * g
        self.z[at] += g - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[at] = after


class Weights:
    """The weights that are not 0, dense in memory."""

    def __init__(self, at: np.ndarray, values: np.ndarray, bits: int = BITS):
        self.at, self.values, self.bits = at, values, bits
        self._dense = None

    def __getstate__(self):
        return self.__dict__ | {"_dense": None}

    def scores(self, column: pa.Array) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros((1 << self.bits) + 1)
            self._dense[self.at] = self.values
        found, bounds = features(column, self.bits)
        owner = K.owners(bounds)
        known = self._dense[found] != 0
        # A feature counts once per text; only those with a weight are looked at.
        key = np.unique((owner[known].astype(np.int64) << self.bits) | found[known])
        value = self._dense[key & ((1 << self.bits) - 1)]
        total = np.bincount(key >> self.bits, value, minlength=len(column)) + self._dense[-1]
        return sigmoid(total)


def labels_per_document(labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, label 0 or 1): the more frequent label of a doc_id, 1 in a tie; rows without either are left out."""
    rows = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("_label")).dropna()
    return rows.groupBy("doc_id").agg((F.avg(F.when(F.col("_label") > 0, 1).otherwise(0)) >= 0.5).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, bits: int = BITS) -> Weights:
    """Weights from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label 0 or 1) names; rows with a null are left out.

    Of more than ``sample_docs`` labelled rows about that many are taken, by a hash of doc_id and text before anything is
    shuffled. Equal texts are one example, with their more frequent label. So the one task that learns, example
    after example in the order of another hash, holds a bounded sample.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).dropna()
    total = rows.select("doc_id").join(labels, "doc_id").count()
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(place < sample_docs / max(total, 1)).join(labels, "doc_id")
    matched = chosen.groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text"):
            found, bounds = features(batch.column("text"), bits)
            parts = [np.unique(found[a:b]).tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.record_batch([batch.column("turn"), batch.column("label"), pa.array(parts, pa.binary())], ["turn", "label", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [x for b in batches for x in zip(b.column("label").to_pylist(), b.column("features").to_pylist())]
        model = Ftrl(bits)
        toxic = sum(label for label, _ in examples)
        weight = {0: 1.0, 1: ((len(examples) - toxic) / toxic) ** BALANCE if 0 < toxic < len(examples) else 1.0}
        for _ in range(EPOCHS):
            for label, raw in examples:
                model.learn(np.append(np.frombuffer(raw, np.uint32), np.uint32(1 << bits)), label, weight[label])
        w = model.weights(np.arange((1 << bits) + 1))
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(at), pa.array(w[at])], ["at", "weight"])

    turn = F.xxhash64(F.lit(7), "text").alias("turn")
    encoded = scratch.cut(matched.select(turn, "label", "text").mapInArrow(encode, "turn long, label int, features binary"), "examples")
    in_order = encoded.coalesce(1).sortWithinPartitions("turn", "label").select("label", "features")
    found = in_order.mapInArrow(learn, "at long, weight double").toArrow()
    scratch.drop()
    return Weights(found.column("at").to_numpy(), found.column("weight").to_numpy(), bits)


_KINDS = [("score", "double", pa.float64()), ("predicted", "int", pa.int32())]


def scored(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on); columns of these names are replaced.

    A null text, an empty one and one without words get the score of the bias alone; so does every text if nothing was learned, and
    without any labels that is 0.5. A null doc_id is carried along, repeated rows are scored alike, no rows give no rows. Nothing is shuffled.
    """
    docs = docs.drop(*(n for n, _, _ in _KINDS)).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T._parse_datatype_string(k)) for n, k, _ in _KINDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text"):
            scores = weights.scores(batch.column("text"))
            arrays = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.record_batch([*batch.columns, *arrays], [*batch.schema.names, *(n for n, _, _ in _KINDS)])

    return docs.mapInArrow(run, schema)
