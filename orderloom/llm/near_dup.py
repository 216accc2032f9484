"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is that of its five-word shingles. The signature is sorted in
several orders, one per tree, each starting at another of its values. Documents
that share the first values of an order form a region. In a small region all
pairs that agree in ALIKE of the deeper values are candidates; in a crowded one the depth grows until the longest common prefix
singles out the neighbours, and a hub stands for the rest. Candidates are
confirmed on full sets. Crowded regions that still hold several components
are then compared exactly, block by block, so nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import kernels as K
from orderloom.llm.components import connected_components
from orderloom.llm.scratch import Scratch
from orderloom.session import cut as keep_table

SHINGLE_WORDS = 5
#: Trees, values of the signature that open a tree's order, and length of a signature. Two documents at
#: similarity 0.75 share no region with probability (1 - 0.75**3)**32, about 3e-8.
TREES, ROOT_DEPTH, VALUES = 32, 3, 128
#: Bytes of the order that follow the root in a row, one for each further value.
DEEP = 13
#: Up to this many documents, every pair of a region is a candidate.
SMALL = 8
#: Neighbours on each side in a crowded region of one tree.
BESIDE = 1
#: Candidates agree in so many of the DEEP values; at similarity 0.75 a pair in one region does with probability 0.92,
#: which would leave a chance of 2e-7 that no tree proposes it if trees were independent; they share values, and the
#: simulation in the second review found about 3.7e-6 (22 of 6 million).
ALIKE = 8
#: Documents of a crowded region that meet in one task.
BLOCK = 2000


def _sets_of(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    raw, bounds = K.utf8(batch.column(text))
    word, of = K.word_hashes(K.lowered(raw), bounds)
    return K.distinct(*K.shingles(word, of, SHINGLE_WORDS))


def _least(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The signatures of sets that have at least one value."""
    masks, factors = K.random_words(3, VALUES), K.random_words(4, VALUES) | K.U64(1)
    out = np.empty((len(bounds) - 1, VALUES), "<u4")
    for i in range(VALUES):
        out[:, i] = np.minimum.reduceat((values ^ masks[i]) * factors[i], bounds[:-1]) >> K.U64(32)
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in K.chunks(batches, "text"):
        values, bounds = _sets_of(batch, "text")
        size = np.diff(bounds)
        full = size > 0
        used = np.r_[0, np.cumsum(size[full])]
        marks = [np.zeros(len(size), np.int64) for _ in range(2)]
        signature = np.full(len(size), None, object)
        if full.any():
            for seed, mark in enumerate(marks):
                mark[full] = np.add.reduceat(K.mix(values ^ K.random_words(5 + seed, 1)), used[:-1]).view(np.int64)
            signature[full] = [row.tobytes() for row in _least(values, used)]
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(size.astype(np.int64)), *map(pa.array, marks), pa.array(signature, pa.binary())],
            ["doc_id", "n_shingles", "mark_a", "mark_b", "signature"],
        )


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, size and 128-bit mark of each document's set, and its signature (null without words)."""
    schema = "doc_id long, n_shingles long, mark_a long, mark_b long, signature binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_signed, schema)


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree: the hash of the root values, and the values that follow, a byte each."""
    seeds = K.random_words(7, TREES)
    for batch in batches:
        for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
            values = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u4").reshape(-1, VALUES)
            ids = part.column("rep")
            for tree in range(TREES):
                order = (np.arange(ROOT_DEPTH + DEEP) + tree * (VALUES // TREES)) % VALUES
                key = np.full(len(values), seeds[tree])
                for i in order[:ROOT_DEPTH]:
                    key = K.mix(key ^ values[:, i])
                deep = np.ascontiguousarray((values[:, order[ROOT_DEPTH:]] & 255).astype(np.uint8))
                yield pa.record_batch(
                    [pa.array(key.view(np.int64)), pa.array([r.tobytes() for r in deep], pa.binary()), ids],
                    ["region", "deep", "rep"],
                )


def _hub(deep: np.ndarray) -> int:
    """Row that agrees most with the commonest value at each place."""
    common = np.array([np.bincount(c, minlength=256).argmax() for c in deep.T], np.uint8)
    return int((deep == common).sum(1).argmax())


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) from rows in order; (region, null) for each crowded or cut region.

    State between batches is the open region's last rows and its hub only.
    """
    last: tuple | None = None  # region, rows so far, ids and deep values of up to SMALL last rows, and the hub's
    first = True
    for batch in batches:
        region, ids = np.asarray(batch.column("region")), np.asarray(batch.column("rep"))
        deep = np.frombuffer(b"".join(batch.column("deep").to_pylist()), np.uint8).reshape(-1, DEEP)
        a, b, crowded = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []

        def propose(names_a, deep_a, names_b, deep_b) -> None:
            near = ((deep_a == deep_b).sum(1) >= ALIKE) & (names_a != names_b)
            a.append(np.broadcast_to(names_a, near.shape)[near])
            b.append(np.broadcast_to(names_b, near.shape)[near])

        cuts = np.r_[0, np.flatnonzero(region[1:] != region[:-1]) + 1, len(region)]
        sizes = np.diff(cuts)
        # Most regions hold one document; only the others and those at a batch's ends need a look.
        for i in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == len(sizes) - 1)):
            lo, hi = cuts[i], cuts[i + 1]
            names, values, seen, hub = ids[lo:hi], deep[lo:hi], 0, None
            if last and last[0] == region[lo]:
                _, seen, tail, tail_values, hub = last
                names, values = np.r_[tail, names], np.concatenate([tail_values, values])
            total, old = seen + hi - lo, len(names) - (hi - lo)
            if total > SMALL:
                if seen <= SMALL:
                    crowded.append(region[lo])
                if hub is None:
                    middle = _hub(values)
                    hub = names[middle], values[middle]
                propose(names, values, np.full(len(names), hub[0]), hub[1])
            for step in range(1, min(len(names) - 1, BESIDE if total > SMALL else SMALL) + 1):
                start = max(0, old - step)
                propose(names[start:-step], values[start:-step], names[start + step :], values[start + step :])
            last = (region[lo], total, names[-SMALL:], values[-SMALL:], hub)
            if first:
                crowded.append(region[lo])  # may go on from the partition before
                first = False
        x, y = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
        yield pa.record_batch([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
        yield pa.record_batch([pa.array(np.array(crowded, np.int64)), pa.nulls(len(crowded), pa.int64())], ["a", "b"])
    if last:
        yield pa.record_batch([pa.array([last[0]], pa.int64()), pa.nulls(1, pa.int64())], ["a", "b"])


def _exact_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in K.chunks(batches, "text"):
        values, bounds = _sets_of(batch, "text")
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
        yield pa.record_batch([batch.column("rep"), lists], ["rep", "shingles"])


def _linked(a: str, b: str, percent: int) -> str:
    """SQL: whether two arrays without repeats reach ``percent`` similarity."""
    both = f"size(array_intersect({a}, {b}))"
    return f"100L * {both} >= {percent}L * (size({a}) + size({b}) - {both})"


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left, right = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
    fits = F.expr(f"100L * least(size(_a), size(_b)) >= {percent}L * greatest(size(_a), size(_b))")
    joined = pairs.hint("merge").join(left, "a").hint("merge").join(right, "b")
    return joined.filter(fits).filter(_linked("_a", "_b", percent)).select("a", "b")


def _compared(percent: int):
    """Links between components within a crowded block pair, found by counting shared shingles."""

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, parts, side = (np.asarray(table.column(c)) for c in ("rep", "component", "side"))
        lists = table.column("shingles").combine_chunks()
        values, bounds = np.asarray(lists.values), np.asarray(lists.offsets).astype(np.int64)
        values = values[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        size, parts = np.diff(bounds), parts.copy()
        names, code = np.unique(values, return_inverse=True)
        owner = K.owners(bounds)
        order = np.argsort(code, kind="stable")
        posting = np.r_[0, np.cumsum(np.bincount(code, minlength=len(names)))]
        by_code = owner[order]
        shared = np.diff(posting) > 1
        a, b = [], []
        for x in np.flatnonzero(side == 1):
            own = code[bounds[x] : bounds[x + 1]]
            own = own[shared[own]]
            if 100 * len(own) < percent * size[x]:
                continue  # no set here can hold enough of this one
            both = np.bincount(np.concatenate([by_code[posting[c] : posting[c + 1]] for c in own.tolist()]), minlength=len(ids))
            near = np.flatnonzero((100 * both >= percent * (size + size[x] - both)) & (parts != parts[x]))
            for y in near:
                if parts[y] != parts[x]:
                    a.append(ids[x])
                    b.append(ids[y])
                    parts[parts == parts[y]] = parts[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _crowded_links(rows: DataFrame, comps: DataFrame, sets: DataFrame, percent: int, cut) -> DataFrame:
    """Links across components within crowded regions (region, rep); exact.

    Regions that share documents, over all trees, make up a family. In it the documents outside the largest component meet
    all others, in pairs of blocks of at most BLOCK documents a side; each set is sent once per block, not once per tree.
    """
    least = rows.groupBy("region").agg(F.min("rep").alias("least"))
    # A document is in one region per tree at most: its regions' least documents are one family, named by the first.
    tied = cut(rows.join(least, "region").groupBy("rep").agg(F.array_sort(F.collect_set("least")).alias("least")), "tied")
    ties = tied.select(F.col("least")[0].alias("a"), F.explode("least").alias("b")).distinct()
    named = connected_components(ties, cut).toDF("first", "family")
    families = tied.withColumn("first", F.col("least")[0]).join(named, "first").select("rep", "family")
    families = families.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    rows = cut(families.select("rep", "family", F.coalesce("component", "rep").alias("component")), "families")
    per = rows.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("family").agg(
        F.max_by("component", F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")
    )
    rows = rows.join(cut(top.filter("parts > 1"), "mixed"), "family")
    blocks = F.ceil(F.col("all") / BLOCK).cast("int")
    place, every = F.pmod(F.xxhash64("rep"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    # Side 1 asks and goes to all blocks that are asked, side 0 is asked by all blocks.
    asks = rows.filter("component <> top").select("family", "rep", "component", place.alias("x"), every.alias("y"), F.lit(1).alias("side"))
    asked = rows.select("family", "rep", "component", every.alias("x"), place.alias("y"), F.lit(0).alias("side"))
    both = asks.union(asked).groupBy("family", "x", "y", "rep", "component").agg(F.max("side").alias("side"))
    both = both.join(sets, "rep")
    return both.groupBy("family", "x", "y").applyInArrow(_compared(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Lower-cases A-Z and takes words between ASCII white space. Two documents are
    linked if 100 * intersection >= ``percent`` * union of their sets of five-word
    shingles; a document of fewer words is one shingle. component_id is the smallest
    doc_id reachable over links, kept tells whether it is the document's own.

    Null, empty or blank texts have an empty set and are linked with nothing. Rows with
    equal sets are one class, whose smallest doc_id stands for it; a row takes the component
    of its text's class, also where rows repeat a doc_id. A row without doc_id takes its
    class's component and is kept only if the class has no doc_id at all. Other columns
    are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "near-duplicates")
    cut = scratch.cut
    signs = cut(signed(docs), "signatures")
    worded = signs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut(worded.groupBy("mark_a", "mark_b").agg(F.min("doc_id").alias("rep")), "classes")
    key = ["mark_a", "mark_b", "rep"]
    chosen = classes.join(worded.withColumnRenamed("doc_id", "rep"), key).dropDuplicates(key).select("rep", "signature")
    trees = cut(chosen, "chosen").mapInArrow(_planted, "region long, deep binary, rep long")
    found = cut(
        trees.repartitionByRange(parts, "region", "deep", "rep").sortWithinPartitions("region", "deep", "rep")
        .mapInArrow(_beside, "a long, b long"),
        "neighbours",
    )
    pairs = cut(found.filter("a < b").distinct(), "pairs")
    regions = cut(found.filter("b IS NULL").select(F.col("a").alias("region")).distinct(), "open")

    # The texts are shuffled once, for all sets that are needed. These joins are sort-merge joins at every size:
    # ids and pairs grow with the input, and a plan that changes with them would hide what a larger one costs.
    crowded = cut(trees.select("region", "rep").join(regions, "region", "left_semi"), "crowded")
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(crowded.select("rep")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string")).join(wanted.hint("merge"), "rep", "left_semi")
    sets = cut(texts.distinct().mapInArrow(_exact_sets, "rep long, shingles array<long>"), "sets")

    links = cut(_confirmed(pairs, sets, percent), "links")
    comps = connected_components(links, cut)
    more = cut(_crowded_links(crowded, comps, sets, percent, cut), "links")
    if more.limit(1).count():
        comps = connected_components(links.union(more), cut)
    named = cut(
        classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select("mark_a", "mark_b", F.coalesce("component", "rep").alias("_component")),
        "named",
    )
    done = signs.join(named.filter("_component IS NOT NULL"), ["mark_a", "mark_b"], "left")
    component = F.coalesce("_component", "doc_id")
    result = keep_table(
        done.select(
            "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
        ),
        "components",
    )
    scratch.drop()
    return result
