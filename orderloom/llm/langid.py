"""Language of a text: one interpolated Kneser-Ney character model per language.

Texts are read as lower-case letters with one space between words. Discounted probabilities and
back-off weights lie in arrays sorted by 64-bit n-gram hash, one per language and order. The language with the least
cross-entropy per character wins; a text that is too unlike even that one's own documents is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import kernels as K

ORDER = 5
#: Labelled documents per language that a model is fitted on, about; they are chosen by a hash of doc_id.
SAMPLE_DOCS = 600
#: One in this many of them is kept out of the counts and calibrates the rejection.
HELD_PART = 5
#: Standard deviations, between documents and within one, above the mean at which a text is rejected.
DEVIATIONS = 6.0
#: Nats per character that a text may always lie above the mean.
SLACK = 1.2
UNKNOWN = "und"
_FACTORS = K.random_words(21, ORDER) | K.U64(1)
_ORDERS = K.random_words(22, ORDER + 1)
#: Slots of a worker's table of n-grams it has scored before.
_SLOTS = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def has_letter(text) -> F.Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, ORDER - 1 spaces before each; n + 1 bounds; the number of letters in each."""
    pad = "\0" * (ORDER - 1)
    joined = "".join(pad + t.lower() for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = [len(t.lower()) + ORDER - 1 for t in texts]
    bounds = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    letter = _letters()[points]
    start = np.zeros(len(points) + 1, bool)
    start[bounds] = True
    kept = letter | (points == 0)
    kept[1:] |= letter[:-1] & ~start[1:-1]  # the first of other characters stands for a space
    out = np.where(letter, points, 32)[kept]
    return out, np.r_[0, np.cumsum(kept)][bounds], np.diff(np.r_[0, np.cumsum(letter)][bounds])


def _keys(points: np.ndarray) -> list[np.ndarray]:
    """For k = 0 to ORDER: the unmixed hash of the k characters that end at each place."""
    spread, out = K.mix(points.astype(K.U64) + K.U64(1)), [np.zeros(len(points), K.U64)]
    for k in range(ORDER):
        shifted = np.zeros(len(points), K.U64)
        shifted[k:] = spread[: len(points) - k] * _FACTORS[k]
        out.append(out[-1] + shifted)
    return out


def _gram_keys(grams: list[str]) -> np.ndarray:
    """Hashes of n-grams of one order, as ``_keys`` has them."""
    if not grams:
        return np.zeros(0, K.U64)
    points = np.array([list(map(ord, g)) for g in grams], np.uint32)
    spread = K.mix(points.astype(K.U64) + K.U64(1))
    return K.mix((spread[:, ::-1] * _FACTORS[: points.shape[1]]).sum(1, dtype=K.U64) + _ORDERS[points.shape[1]])


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], values[order].astype(np.float32)


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    known, values = table
    if not len(known):
        return np.full(len(keys), missing, np.float32)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], np.float32(missing))


class KneserNey:
    """One language: per order the discounted probabilities of n-grams and the back-off weights of contexts."""

    def __init__(self, grams: dict[str, int], alphabet: int):
        self.floor = 1.0 / (alphabet + 1)
        self.grams, self.backoff = [], []
        counts = Counter(grams)
        tables = []
        for k in range(ORDER, 0, -1):  # below the top, a gram counts its different left neighbours
            tables.append(counts)
            counts = Counter(g[1:] for g in counts)
        for counts in reversed(tables):
            ones, twos = (sum(1 for c in counts.values() if c == n) for n in (1, 2))
            discount = ones / (ones + 2 * twos) if ones else 0.5
            total, followers = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                followers[g[:-1]] += 1
            names = list(counts)
            share = np.array([(counts[g] - discount) / total[g[:-1]] for g in names], float)
            contexts = list(total)
            weight = np.array([discount * followers[h] / total[h] for h in contexts], float)
            self.grams.append(_sorted(_gram_keys(names), np.maximum(share, 0)))
            self.backoff.append(_sorted(_gram_keys(contexts) if len(contexts[0]) else K.mix(np.array([_ORDERS[0]])), weight))

    def log_probability(self, keys: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        """keys[k]: hash of the last k characters; before[k]: of the k characters in front of the last."""
        p = np.full(len(keys[0]), self.floor, np.float32)
        for k in range(1, ORDER + 1):
            weight = _found(self.backoff[k - 1], K.mix(before[k - 1] + _ORDERS[k - 1]), 1.0)
            p = _found(self.grams[k - 1], K.mix(keys[k] + _ORDERS[k]), 0.0) + weight * p
        return np.log(p)


class Models:
    """All languages, and what their own documents measure: mean and deviations of the cross-entropy."""

    def __init__(self, grams: dict[str, dict[str, int]]):
        alphabet = len({c for g in grams.values() for gram in g for c in gram})
        self.names = sorted(grams)
        self.models = [KneserNey(grams[n], alphabet) for n in self.names]
        self.limits = {n: (0.0, float("inf"), 0.0) for n in self.names}
        self._slots = None

    def __getstate__(self):
        return self.__dict__ | {"_slots": None}

    def _scores(self, points: np.ndarray) -> np.ndarray:
        """Log-probability of each character in each language."""
        if self._slots is None:
            self._slots = (np.zeros(_SLOTS, K.U64), np.zeros((_SLOTS, len(self.names)), np.float32))
        held, values = self._slots
        keys = _keys(points)
        whole = K.mix(keys[ORDER] + _ORDERS[ORDER])
        slot = (whole & K.U64(_SLOTS - 1)).astype(np.int64)
        new = np.flatnonzero(held[slot] != whole)
        out = values[slot]
        if len(new):
            _, first, back = np.unique(whole[new], return_index=True, return_inverse=True)
            at = new[first]
            mine = [k[at] for k in keys]
            last = K.mix(points[at].astype(K.U64) + K.U64(1))
            inverse = [K.U64(pow(int(f), -1, 1 << 64)) for f in _FACTORS]
            before, total = [np.zeros(len(at), K.U64)], np.zeros(len(at), K.U64)
            for k in range(1, ORDER):  # the same characters, one place nearer
                total = total + (mine[k + 1] - mine[k]) * inverse[k] * _FACTORS[k - 1]
                before.append(total)
            scores = np.stack([m.log_probability(mine, before) for m in self.models], axis=1)
            out[new] = scores[back]
            held[slot[at]], values[slot[at]] = whole[at], scores
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per character and language, their variance within the text, and characters of each text."""
        points, bounds, letters = characters(texts)
        scores = -self._scores(points)
        pads = np.arange(len(points)) - np.repeat(bounds[:-1], np.diff(bounds)) < ORDER - 1
        scores[pads] = 0
        n = np.maximum(np.diff(bounds) - (ORDER - 1), 0)
        sums, squares = (np.add.reduceat(x, bounds[:-1], axis=0, dtype=float) for x in (scores, scores**2))
        mean = sums / np.maximum(n, 1)[:, None]
        return mean, np.maximum(squares / np.maximum(n, 1)[:, None] - mean**2, 0), np.where(letters > 0, n, 0)

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None, bool]]:
        """Language, score, nats per character and whether the text is rejected."""
        if not self.names or not texts:
            return [(UNKNOWN, 0.0, None, True)] * len(texts)
        mean, _, n = self.entropies(texts)
        best = mean.argmin(1)
        out = []
        for row, i, size in zip(mean, best.tolist(), n.tolist()):
            if not size:
                out.append((UNKNOWN, 0.0, None, True))
                continue
            weight = np.exp(-(row - row[i]) * min(size, 20))
            middle, between, within = self.limits[self.names[i]]
            limit = middle + SLACK + DEVIATIONS * (between**2 + within**2 / size) ** 0.5
            out.append((self.names[i], float(1 / weight.sum()), float(row[i]), bool(row[i] > limit)))
        return out


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in K.chunks(batches, "text"):
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            points, _, letters = characters([text])
            line = "".join(map(chr, points.tolist()))
            if letters[0]:
                counts.update((lang, line[i : i + ORDER]) for i in range(len(line) - ORDER + 1))
        yield pa.record_batch(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(counts.values(), pa.int64())],
            ["lang", "gram", "n"],
        )


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Models:
    """Models from ``labelled`` (doc_id, text, lang), rows without text, lang or doc_id left out.

    Documents are counted per language over all rows; about ``sample_docs`` of each, by a hash of doc_id, are
    read for n-grams, so what reaches the driver is bounded by them.
    """
    rows = labelled.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string")).dropna()
    rows = rows.filter(has_letter("text"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not totals:
        return Models({})
    share = F.create_map(*(x for k, n in totals.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / n)))))
    chosen = rows.withColumn("_place", place / share[F.col("lang")]).filter("_place < 1")
    held = F.col("_place") >= 1 - 1 / HELD_PART
    counted = chosen.filter(~held | F.lit(max(totals.values()) < HELD_PART)).select("lang", "text").mapInArrow(_grams, "lang string, gram string, n long")
    grams: dict[str, dict[str, int]] = {}
    for r in counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toLocalIterator():
        grams.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    models = Models(grams)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text"):
            mean, variance, n = models.entropies(batch.column("text").to_pylist())
            at = [models.names.index(x) if x in models.names else 0 for x in batch.column("lang").to_pylist()]
            pick = np.arange(len(at)), at
            yield pa.record_batch([batch.column("lang"), pa.array(mean[pick]), pa.array(variance[pick]), pa.array(n.astype(float))], ["lang", "mean", "variance", "n"])

    measured = chosen.filter(held).select("lang", "text").mapInArrow(calibrate, "lang string, mean double, variance double, n double")
    # Long documents tell how documents differ, all characters how much one of them does.
    summary = measured.groupBy("lang").agg(
        F.median("mean").alias("middle"), F.percentile("mean", 0.95).alias("high"), F.avg("variance").alias("variance")
    )
    for r in summary.collect():
        if r["lang"] in models.limits:
            models.limits[r["lang"]] = (r["middle"], max(r["high"] - r["middle"], 0.02), r["variance"] ** 0.5)
    return models


_KINDS = [("lang_pred", "string", pa.string()), ("score", "double", pa.float64()), ("nats", "double", pa.float64()), ("rejected", "boolean", pa.bool_())]


def identified(docs: DataFrame, models: Models) -> DataFrame:
    """All columns of ``docs`` with lang_pred, score (0 to 1), nats (per character) and rejected; columns of these names are replaced.

    A null text or one without letters is ``und``, score 0, rejected; so is every text if nothing was learned. Nothing is shuffled.
    A null doc_id is carried along, repeated rows are judged alike, ties go to the first language by name,
    no rows give no rows.
    """
    docs = docs.drop(*(n for n, _, _ in _KINDS)).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T._parse_datatype_string(k)) for n, k, _ in _KINDS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.chunks(batches, "text"):
            found = models.predict([t or "" for t in batch.column("text").to_pylist()])
            columns = list(zip(*found)) or [()] * len(_KINDS)
            arrays = [pa.array(c, k) for c, (_, _, k) in zip(columns, _KINDS)]
            yield pa.record_batch([*batch.columns, *arrays], [*batch.schema.names, *(n for n, _, _ in _KINDS)])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id and the columns that ``identified`` adds."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return identified(texts, models).drop("text")
