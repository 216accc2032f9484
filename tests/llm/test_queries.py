"""The registered queries: against their SQL, or brute force on the smallest tables; and the pipeline."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from brute import components, repeated_words, repeats, words
from oracle import compare
from orderloom.llm.queries import QUERIES, SHARDS, SQL

NUMBERS = set(range(1, 14))


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r for r in documents.collect()}


@pytest.fixture(scope="module")
def result(spark, folder):
    held = {}

    def run(number):
        if number not in held:
            name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
            held[number] = QUERIES[name](spark, folder).collect()
        return held[number]

    return run


def test_each_operator_has_one_query():
    assert Counter(int(n[2:].split("_")[0]) for n in QUERIES) == Counter(NUMBERS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, folder, name):
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) is None


def ids_of(text, end):
    from tokenizers import Tokenizer

    from orderloom.llm.tokens import vocabulary

    ids_of.known = getattr(ids_of, "known", None) or Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return np.array([*ids_of.known.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_op2(result, texts):
    rows = {r.doc_id: r for r in result(2)}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        n, again = len((texts[i].text or "").encode().split()), repeated_words(texts[i].text)
        assert (r.n_words, r.n_repeat_words, r.base_failed) == (n, again, n < 10 or 100 * again > 20 * n)


def test_op3(result, texts):
    rows = {r.doc_id: r for r in result(3)}
    assert rows.keys() == texts.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [i for i, r in rows.items() if r.held_out]
    assert sum(rows[i].lang_pred == texts[i].lang for i in held) >= 0.97 * len(held)


def test_op4(result, texts):
    rows = sorted(result(4), key=lambda r: r.doc_id)
    sizes = [len((texts[r.doc_id].text or "").encode()) + 16 for r in rows]
    assert [r.doc_id for r in rows] == sorted(texts) and [r.size for r in rows] == sizes
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id].text or "").encode()) and r.law == "bytes" and r.grown_shard is None for r in rows)
    middle = np.cumsum(sizes) * 2 - np.array(sizes)
    assert [r.shard for r in rows] == (middle * SHARDS // (2 * sum(sizes))).tolist()
    assert all([r.slot for r in rows if r.shard == s] == list(range(sum(r.shard == s for r in rows))) for s in range(SHARDS))


def test_op5(result, texts):
    want, sizes = components([(i, r.text) for i, r in texts.items()])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result(5)} == {i: (sizes[i], c, c == i) for i, c in want.items()}


def test_op6(result, texts):
    want = {i: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, (n, gone, runs, kept) in repeats([(i, r.text) for i, r in texts.items()]).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result(6)} == want


def test_op7(spark, result, texts, folder):
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in result(7)}
    for i, r in texts.items():
        w = b" ".join(words(r.text))
        assert all(((i, k) in found) for k, item in items.items() if b" ".join(item) in w)
    assert all(0.5 <= r.score <= 1 for r in result(7)) and len(found) < 0.1 * len(texts)


def test_op8(result, texts):
    start = 0
    for r in sorted(result(8), key=lambda r: r.doc_id):
        ids = ids_of(texts[r.doc_id].text, 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(result(8)) == len(texts)


def test_op9_finds_every_exact_passage(result, texts):
    seen, want = set(), set()
    for i in sorted(texts):
        w = words(texts[i].text)
        own = {tuple(w[p : p + 50]) for p in range(len(w) - 49)}
        want |= {i} if own & seen else set()
        seen |= own
    assert want <= {r.doc_id for r in result(9)}


def test_op10(result, texts):
    pieces = sorted(result(10), key=lambda r: (r.doc_id, r.start))
    docs = {}
    for r in pieces:
        ids = docs.setdefault(r.doc_id, [ids_of(texts[r.doc_id].text, 0), 0])
        assert r.start == ids[1] and r.doc_tokens == len(ids[0]) and r.length & (r.length - 1) == 0 and r.length <= 1024
        assert r.ids_crc32 == zlib.crc32(ids[0][r.start : r.start + r.length].tobytes())
        ids[1] += r.length
    assert docs.keys() == texts.keys() and all(len(ids) == n for ids, n in docs.values())
    assert sorted(r.sequence_id for r in pieces) == list(range(len(pieces)))


def test_pipeline(spark, folder, documents):
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == documents.columns and after.dtypes == documents.dtypes
        path = corpus_pipeline.cut(after, name)
        seen.append((name, docs, path))
        docs = path
    steps = {name: (before.collect(), after.collect()) for name, before, after in seen}
    before, after = steps["near_duplicates"]
    want, _ = components([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {i for i, c in want.items() if i == c}
    before, after = steps["repeated_strings"]
    left = repeats([(r.doc_id, r.text) for r in before])
    assert {r.doc_id: r.text.encode() for r in after if left[r.doc_id][1] == 0} == {r.doc_id: r.text.encode() for r in before if left[r.doc_id][1] == 0}
    assert all(len(r.text.encode()) <= len(left[r.doc_id][3]) for r in after) and all(r.n_chars == len(r.text) for r in after if left[r.doc_id][1])
    before, after = steps["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    by_doc = Counter()
    for r in after:
        by_doc[r.doc_id] += r.length
    assert all(by_doc[r.doc_id] == len(ids_of(r.text, 0)) for r in before)


def test_pipeline_of_odd_rows(spark, folder, documents):
    rows = [(None, "the and of with that", None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", 0), (2, "", None, "s", 0), (3, "the of and " * 20_000, "en", None, 5)]
    odd = documents.limit(60).union(spark.createDataFrame(rows, documents.schema))
    for source in (odd, documents.limit(0)):
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut(stage(spark, docs, folder), name)
        assert docs.count() >= (0 if source is not odd else 1)


def test_pipeline_sends_small_batches(spark, folder):
    text = "ten letters " * 400
    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", f"concat(id, ' {text}') AS text")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    try:
        for _, stage in corpus_pipeline.STAGES[3:4]:
            stage(spark, docs, folder)
        sent = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.set(name, before)
    assert sum(sent) > 16 << 20 and max(sent) < 1.5 * corpus_pipeline.BATCH_BYTES
