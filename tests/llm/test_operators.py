"""Each operator against a brute-force version, and its defined results for odd rows."""

import hashlib
import math
import random
import time
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import components, make, repeated_words, repeats, words
from orderloom.llm import kernels as K
from orderloom.llm import langid, suffix_dedup, token_store
from orderloom.llm.components import connected_components
from orderloom.llm.decontam import aligned, mark_leaks
from orderloom.llm.fertility import fertility
from orderloom.llm.near_dup import near_duplicates
from orderloom.llm.packing import binary_lengths, pack_by_powers
from orderloom.llm.passages import compact_windows, repeated_passages
from orderloom.llm.scratch import Scratch
from orderloom.llm.shards import byte_shards
from orderloom.llm.suffix_dedup import remove_repeats
from orderloom.llm.suffix_sort import Suffixes
from orderloom.llm.tokens import ByteBpe, vocabulary
from orderloom.llm.url_rules import UrlRule, host_and_path, host_rule, judge_urls, word_rule
from orderloom.session import cut, new_folder

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(VOCABULARY) for _ in range(n)]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(BPE)).encode(text, add_special_tokens=False).ids


# --- shared code


def test_words_do_not_run_over_texts():
    raw, bounds = K.utf8(pa.array(["ab c", None, "d", "", " e\tf\x0bg "]))
    starts, ends, of = K.words(raw, bounds)
    found = [bytes(raw[a:b]) for a, b in zip(starts, ends)]
    assert [found[a:b] for a, b in zip(of, of[1:])] == [[b"ab", b"c"], [], [b"d"], [], [b"e", b"f", b"g"]]


def test_local_minima_are_those_of_every_window():
    values = np.random.default_rng(1).integers(1, 30, 300).astype(K.U64)
    want = {i + int(j) for i in range(300 - 6) for j in np.flatnonzero(values[i : i + 7] == values[i : i + 7].min())}
    assert set(np.flatnonzero(K.local_minima(values, 7))) == want


def test_ids_by_words_are_the_librarys():
    odd = ["", "a  b", " a", "a ", "\n a", "x \n y", "<|endoftext|> hi", "don't  go\t\tnow\r\n ok", "日本 テスト 1 !!", "\0a b", " ", "a\u3000 b", "é " * 50]
    texts = odd + [" ".join(prose(i, 50)) for i in range(5)]
    bpe = ByteBpe(vocabulary(BPE))
    for _ in range(2):
        assert [np.frombuffer(i, bpe.kind).tolist() for i in bpe.ids(texts)] == [library_ids(t) for t in texts]


def test_ids_of_words_with_signs_nulls_and_any_length_are_the_librarys():
    from tokenizers import Tokenizer

    rng, library = random.Random(5), Tokenizer.from_file(vocabulary(BPE))
    letters = ["a", "b", "Z", "7", "é", "日", "´", "\0", "\x1f", "\x7f", "\n", " ", " ", " ", ",", ".", "_", "'", "'s", "'ll", "<|", "|>", "\U0001f600"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    texts += [f"x {'y' * n} {'y' * n}\0 {'é' * n}, {'é' * n}" for n in range(1, 30)] + [" ".join(prose(i, 50)) for i in range(5)]
    bpe = ByteBpe(vocabulary(BPE), cache_words=40)
    for _ in range(2):
        for first in range(0, len(texts), 100):
            part = texts[first : first + 100]
            assert [np.frombuffer(i, bpe.kind).tolist() for i in bpe.ids(part)] == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_a_word_is_encoded_once_whatever_sign_follows():
    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.given = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.given += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    bpe = ByteBpe(vocabulary(BPE))
    bpe.tokenizer = Counted(bpe.tokenizer)
    for sign in ",.;:!?)]":
        bpe.ids(["".join(f"{w}{sign} " for w in VOCABULARY) + "end"])
    assert bpe.tokenizer.given < 2 * sum(len(w) + 1 for w in VOCABULARY)


def test_components_of_a_chain_and_loops(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(5, 5), (3, 4), (4, 3), (None, 3)]
    found = {r.node: r.component for r in connected_components(make(spark, links, "a long, b long")).collect()}
    assert found == {**{i: 10 for i in range(10, 61)}, 5: 5, 3: 3, 4: 3}


# --- 1


def test_url_rules(spark):
    rules = [host_rule("allow", "com", "/"), host_rule("block", "example.com", "/en/"), host_rule("block", "example.com", "/e"), UrlRule("any", "block", "z+q", ())]
    urls = ["http://A.Example.COM/en/x?y#z", "https://example.com/elf", "http://example.com", "http://notexample.com/en/", "nothing", None, "x://", "http://cheap-pills.org/a", "http://spills.org/a", "ftp://zzq.net"]
    rows = make(spark, [(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[0])], "page_id long, url string").withColumn("host", F.lit("clash"))
    done = judge_urls(rows, rules)
    assert done.count() == 12 and done.filter("page_id = 0").distinct().count() == 1
    assert [(r.host, r.path, r.rule, r.verdict) for r in done.filter("page_id IS NOT NULL").dropDuplicates().orderBy("page_id").collect()] == [
        ("a.example.com", "/en/x", "example.com/en/", "block"), ("example.com", "/elf", "example.com/e", "block"), ("example.com", "", None, "allow"),
        ("notexample.com", "/en/", "com/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("cheap-pills.org", "/a", None, "block"), ("spills.org", "/a", None, "allow"), ("zzq.net", "", "any", "block"),
    ]
    assert judge_urls(rows.limit(0), rules).count() == 0
    assert judge_urls(rows, []).filter("rule IS NOT NULL").count() == 0


def test_only_candidates_run(spark):
    rules = [word_rule("block", f"token{i}") for i in range(500)]
    rows = make(spark, [(1, "http://token7.org/")], "page_id long, url string")
    assert judge_urls(rows, [], rules).first().n_candidates == 1
    assert host_and_path("a://B?c://d") == ("b", "")


# --- 2


def test_fertility(spark):
    texts = {
        1: " ".join(prose(1, 60)), 2: "one two three four five " * 12, 3: None, 4: "", 5: "a b", 6: "x # y\nx # y\n \nx # y " + " ".join(prose(2, 20)),
        7: "Ελληνικά γράμματα " * 3 + "είναι εδώ για δοκιμή και τίποτε άλλο σήμερα", 8: "ab" * 40_000 + " c" * 30, 9: "\x00\u2028 \u3000z",
    }
    rows = make(spark, [*((k, v, None) for k, v in texts.items()), (1, texts[1], None)], "doc_id long, text string, lang string").withColumn("kept", F.lit(1))
    done = fertility(rows, vocabulary(BPE), vocabulary(PIECES))
    assert done.count() == 10
    found = by_id(done)
    for i, text in texts.items():
        w = (text or "").encode().split()
        lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
        repeated = repeated_words(text)
        row = found[i]
        assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), repeated), i
        assert row.n_symbols == sum((text or "").count(c) for c in "#*$%&|<>") and row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (len(w) < 10 or 100 * repeated > 20 * len(w)) and not (row.base_failed and row.kept)
        assert row.n_tokens == len(library_ids(text or ""))
    assert found[1].kept and found[7].script == "greek" and found[7].kept and found[6].n_dup_lines == 1
    assert not found[2].kept
    assert fertility(rows.limit(0), vocabulary(BPE), vocabulary(PIECES)).count() == 0


# --- 3


def test_kneser_ney_sums_to_one():
    text = "aab abba baab "
    points, _, _ = langid.characters([text])
    line = "".join(map(chr, points))
    grams = {}
    for i in range(len(line) - langid.ORDER + 1):
        grams[line[i : i + langid.ORDER]] = grams.get(line[i : i + langid.ORDER], 0) + 1
    models = langid.Models({"x": grams})
    for context in ("aab", "zz", "ab ab"):
        following = [context + c for c in "ab z"]
        total = 0.0
        for f in following:
            points, _, _ = langid.characters([f + "z"])
            at = np.array([ord(c) for c in ("    " + f)], np.uint32)
            total += math.exp(models._scores(at)[-1, 0])
        assert 0.95 < total <= 1.0 + 1e-6


def test_language(spark, documents):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    models = langid.fit(documents.filter(~held))
    done = langid.identify(documents.filter(held), models).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in done) >= 0.97 * len(done)
    assert all(0 <= r.score <= 1 for r in done) and sum(r.rejected for r in done) <= 1
    odd = make(spark, [(1, None), (2, ""), (3, "12 34!"), (4, "ξεσκεπάζω την ψυχοφθόρα βδελυγμία " * 5), (None, "the and of"), (5, "the " * 100_000)])
    found = by_id(langid.identified(odd.withColumn("score", F.lit("clash")), models))
    assert [(found[i].lang_pred, found[i].rejected, found[i].score) for i in (1, 2, 3)] == [("und", True, 0.0)] * 3
    assert found[4].rejected and found[4].lang_pred in models.names and found[5].lang_pred == "en" and found[None].lang_pred == "en"
    assert langid.identify(odd.limit(0), models).count() == 0
    nothing = langid.fit(make(spark, [(1, "abc", None), (2, None, "en"), (None, "abc", "en")], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


# --- 4


def test_byte_shards(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(50) if i % 3 else 7, rng.randrange(1, 900)) for i in range(600)] + [(None, 5)]
    df = make(spark, rows, "doc_id long, n long").withColumn("_shard_row", F.lit("clash")).withColumn("slot", F.lit("clash"))
    done = byte_shards(df, 9, F.col("n"), ["doc_id"]).collect()
    total, most = sum(n for _, n in rows), max(n for _, n in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n) for r in done) == sorted((d is not None, d or 0, n) for d, n in rows)
    ends = []
    for shard in range(9):
        mine = sorted((r for r in done if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 9) <= most
        ends += [(-1 if r.doc_id is None else r.doc_id) for r in mine]
    assert ends == sorted(ends)
    assert byte_shards(df.limit(0), 9, F.col("n"), ["doc_id"]).count() == 0


# --- 5


def test_near_duplicates_are_the_components(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want, sizes = components(rows)
    found = by_id(near_duplicates(documents))
    assert {i: (r.component_id, r.n_shingles, r.kept) for i, r in found.items()} == {i: (c, sizes[i], c == i) for i, c in want.items()}


def test_near_duplicates_in_a_crowd(spark):
    """A family around one text, some of it linked through the middle only, in one crowded region of many trees."""
    base, rng, rows = prose(1, 120), random.Random(5), []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i * 3 + 1, " ".join(text)))
    rows += [(1000 + i, " ".join(base)) for i in range(60)]
    want, sizes = components(rows)
    assert len(set(want.values())) > 1
    found = by_id(near_duplicates(make(spark, rows)))
    assert {i: r.component_id for i, r in found.items()} == want


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, None), (6, ""), (7, " \n"), (8, "a b"), (9, "A  B"), (3, "a b"), (3, "a b"), (None, "a b"), (None, "alone"), (10, "x " * 50_000), (11, None)]
    done = near_duplicates(make(spark, rows).withColumn("signature", F.lit("clash")).withColumn("component_id", F.lit("clash")))
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in done.collect())
    want = [
        (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 3, False), (9, 1, 3, False), (3, 1, 3, True), (3, 1, 3, True),
        (None, 1, 3, False), (None, 1, None, True), (10, 1, 10, True), (11, 0, 11, True),
    ]
    assert got == sorted(map(str, want))
    assert near_duplicates(make(spark, [])).count() == 0


# --- 6


def test_suffix_sort_orders_each_group():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    start = rng.integers(0, 3900, 300)
    length = rng.integers(0, 60, 300)
    groups = np.r_[0, 1, 1, 5, 120, 300]
    s = Suffixes(raw, start, length)
    order = s.sort(groups)
    text = [bytes(raw[a : a + n]) for a, n in zip(start, length)]
    for a, b in zip(groups, groups[1:]):
        assert [text[i] for i in order[a:b]] == sorted(text[a:b])
        shared = s.neighbours(order, groups)[a:b]
        for i, n in enumerate(shared[1:], a + 1):
            x, y = text[order[i - 1]], text[order[i]]
            assert n == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


def test_equal_suffixes_are_merged_once(monkeypatch):
    words = [b"the same beginning, and one end", b"the same beginning, and another", b"the same b", b""]
    raw = np.frombuffer(b"".join(words), np.uint8)
    which = np.random.default_rng(5).integers(0, 4, 2000)
    sizes = np.array(list(map(len, words)))
    s = Suffixes(raw, (np.cumsum(sizes) - sizes)[which], sizes[which])
    asked, common = [], Suffixes.common
    monkeypatch.setattr(Suffixes, "common", lambda self, x, y: asked.append(len(x)) or common(self, x, y))
    order = s.sort(np.array([0, 900, 2000]))
    for a, b in ((0, 900), (900, 2000)):
        assert order[a:b].tolist() == sorted(range(a, b), key=lambda i: (words[which[i]], i))
    assert sum(asked) < 100


def test_suffixes_with_zero_bytes_are_ordered():
    words = [b"a\0", b"a", b"a\0\0\0\0\0\0\0\0b", b"a\0\0\0\0\0\0\0\0", b"", b"\0", b"a\0\0\0\0\0\0\0", b"a"]
    sizes = np.array(list(map(len, words)))
    s = Suffixes(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert s.sort(np.array([0, 8])).tolist() == sorted(range(8), key=lambda i: (words[i], i))


def test_contexts_of_a_bucket_are_compared_in_parts(monkeypatch):
    rng = np.random.default_rng(6)
    n = 600
    texts = [bytes(rng.integers(97, 99, 84, np.uint8)) if i % 3 else b"x" * 84 for i in range(n)]
    key = rng.integers(0, 40, n)
    table = pa.table({"key": key, "doc_id": np.arange(n), "mark": np.arange(n), "at": np.zeros(n, int), "left": np.full(n, 34), "context": pa.array(texts, pa.binary())})
    rows = lambda t: sorted(zip(*(t[c].to_pylist() for c in t.column_names)))
    whole = rows(suffix_dedup._compared(table))
    sizes, init = [], K.SpanHash.__init__
    monkeypatch.setattr(K.SpanHash, "__init__", lambda self, raw: sizes.append(len(raw)) or init(self, raw))
    monkeypatch.setattr(K, "CHUNK_BYTES", 8000)
    assert rows(suffix_dedup._compared(table)) == whole != []
    assert max(sizes) < 8000 + 84 * np.bincount(key).max() and sum(sizes) == 2 * 84 * n


@pytest.mark.parametrize("seed, hot", [(0, 10**6), (1, 10**6), (2, 10**6), (2, 3), (3, 0)])
def test_repeats_are_removed(spark, seed, hot):
    rng = random.Random(seed)
    phrases = [" ".join(prose(100 + i, rng.randrange(3, 25))) for i in range(12)]
    rows = []
    for i in range(120):
        parts = [rng.choice(phrases) if rng.random() < 0.5 else "".join(rng.choice("abé日 ") for _ in range(rng.randrange(70))) for _ in range(rng.randrange(6))]
        rows.append((i * 2, rng.choice(["", " ", "-"]).join(parts)))
    rows += [(501, "ab" * 300), (502, "ab" * 200), (503, None), (504, ""), (505, "short"), (506, "x" * 49), (507, "x" * 49)]
    found = by_id(remove_repeats(make(spark, rows).repartition(5), hot_contexts=hot))
    for i, (size, gone, runs, kept) in repeats(rows).items():
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, gone, runs, hashlib.sha256(kept).hexdigest()), i


def test_repeats_of_odd_rows(spark):
    line = "the very same sentence stands in more than one of these documents, word for word"
    rows = [(4, line), (4, line), (4, line + " and more"), (None, line), (2, "x " + line), (9, line * 2)]
    done = remove_repeats(make(spark, rows).withColumn("spans", F.lit(1)).withColumn("n_removed", F.lit("clash")), keep=["spans", "n_removed"])
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in done.collect())
    n = len(line)
    assert got == sorted([("4", n, n), ("4", n, n), ("4", n + 9, n), ("None", n, 0), ("2", n + 2, 0), ("9", 2 * n, 2 * n)])
    assert remove_repeats(make(spark, [])).count() == 0


# --- 7


def brute_align(a, b):
    best, table = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_scores():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 20)), rng.integers(0, 5, rng.integers(0, 40))
        score, first, last = aligned(a, b)
        assert score == brute_align(a.tolist(), b.tolist())
        assert not score or score == brute_align(a.tolist(), b[first : last + 1].tolist())


def test_leaks(spark):
    items = {i: prose(1000 + i, 30) for i in range(20)}
    edited = [w if k % 7 else f"other{k}" for k, w in enumerate(items[3])]
    dropped = [w for k, w in enumerate(items[4]) if k % 8]
    rows = [
        (1, " ".join(prose(1, 200))), (2, " ".join(prose(2, 90) + items[1] + prose(3, 90))), (3, " ".join(prose(4, 50) + edited)), (4, " ".join(dropped + prose(5, 60)).upper()),
        (5, " ".join(items[5][:6] + prose(6, 100))), (6, None), (7, ""), (8, " ".join(items[1] + prose(7, 3000) + items[2])), (None, " ".join(items[6])), (2, " ".join(items[1])),
        *((100 + i, " ".join(items[7] + prose(200 + i, 20))) for i in range(60)),
    ]
    bench = make(spark, [*((i, " ".join(w)) for i, w in items.items()), (50, None), (None, "a b c"), (51, " "), (1, " ".join(items[1]))], "item_id long, text string")
    marked = mark_leaks(make(spark, rows).withColumn("leaks", F.lit("clash")).withColumn("item_id", F.lit("other")), bench)
    got = sorted((str(r.doc_id), sorted({x.item_id for x in r.leaks})) for r in marked.collect() if r.leaks)
    assert got == sorted([("2", [1]), ("2", [1]), ("3", [3]), ("4", [4]), ("8", [1, 2]), ("None", [6]), *((str(100 + i), [7]) for i in range(60))])
    two = [x for r in marked.filter("doc_id = 8").collect() for x in r.leaks if x.item_id == 2]
    assert (two[0].first_word, two[0].last_word, two[0].score) == (3030, 3059, 1.0)
    assert mark_leaks(make(spark, []), bench).count() == 0
    assert mark_leaks(make(spark, rows), bench.limit(0)).filter("size(leaks) > 0").count() == 0


def test_leaks_in_many_documents(spark):
    """Edited and truncated copies that stand in many documents; the item's other grams stand in none."""
    item, other = prose(1100, 35), prose(1101, 40)
    edited = [w if k % 7 else f"other{k}" for k, w in enumerate(item)]
    sparse = [w if k % 4 else f"other{k}" for k, w in enumerate(other)]
    rows = [(i, " ".join(prose(400 + i, 30) + edited + prose(500 + i, 30))) for i in range(60)]
    rows += [(100 + i, " ".join(item[:21] + prose(600 + i, 40))) for i in range(60)]
    rows += [(200 + i, " ".join(prose(700 + i, 40) + sparse)) for i in range(60)] + [(300, " ".join(item)), (301, " ".join(other))]
    marked = mark_leaks(make(spark, rows), make(spark, [(1, " ".join(item)), (2, " ".join(other))], "item_id long, text string"))
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in marked.collect()}
    assert got == {**{i: [1] for i in range(60)}, **{100 + i: [1] for i in range(60)}, **{200 + i: [2] for i in range(60)}, 300: [1], 301: [2]}


# --- 8


def test_perfect_hash():
    for n in (1, 2, 3, 17, 1000):
        hashes = K.random_words(n, n)
        at = token_store.slots(hashes, token_store.perfect_hash(hashes), n)
        assert sorted(at.tolist()) == list(range(n))


def test_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_BYTES", 400)
    rows = [(i * 3, " ".join(prose(i, i % 40))) for i in range(150)] + [(None, "none"), (None, None), (9, "again"), (9, ""), (-5, "é\u3000日本"), (7, "w " * 60_000)]
    path = new_folder(spark, "store")
    token_store.write_store(make(spark, rows).withColumn("keys", F.lit(1)).repartition(3), path, vocabulary(BPE), 2)
    found = sorted(token_store.read_digests(spark, path).collect(), key=lambda r: r.start)
    want = sorted((d is not None, d or 0, len(library_ids(t or "")) + 1, zlib.crc32(np.array([*library_ids(t or ""), 2], "<u4").tobytes())) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == want
    assert [r.start for r in found] == np.r_[0, np.cumsum([r.n_tokens for r in found])[:-1]].tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)
    looked = sorted((r.doc_id, r.ids) for r in token_store.lookup(spark, path, [9, -5, 8, 10**9]).collect())
    assert looked == sorted((d, [*library_ids(t or ""), 2]) for d, t in rows if d in (9, -5))
    assert token_store.lookup(spark, path, []).count() == 0
    empty = new_folder(spark, "store")
    token_store.write_store(make(spark, []), empty, vocabulary(BPE), 2)
    assert token_store.read_digests(spark, empty).count() == 0


# --- 9


def test_compact_windows_are_those_of_the_definition():
    rng = np.random.default_rng(8)
    bounds = np.r_[0, 3, 3, 60, 64, 200]
    values = rng.integers(1, 25, 200).astype(K.U64)
    got = set(zip(*(x.tolist() for x in compact_windows(values, bounds, 6))))
    want = set()
    for t, (a, b) in enumerate(zip(bounds, bounds[1:])):
        v = values[a:b].tolist()
        for c in range(len(v)):
            first = next((i + 1 for i in range(c - 1, -1, -1) if v[i] <= v[c]), 0)
            last = next((i - 1 for i in range(c + 1, len(v)) if v[i] < v[c]), len(v) - 1)
            if last - first + 1 >= 6:
                want.add((t, c, first, last))
    assert got == want


def test_stretches_of_pairs_by_counting_places():
    """Where two hash functions cover a place, and how far their windows move it."""
    from orderloom.llm.passages import AGREE, TOKENS, _regions

    rng = np.random.default_rng(4)
    for _ in range(200):
        met = [
            (pair, int(rng.integers(0, 4)), int(rng.integers(0, 300)), int(rng.integers(0, 300)), int(rng.integers(TOKENS, 120)))
            for pair in range(int(rng.integers(0, 5))) for _ in range(int(rng.integers(1, 10)))
        ]
        expected = []
        for pair in sorted({m[0] for m in met}):
            mine = [m[1:] for m in met if m[0] == pair]
            covered = [len({by for by, at, _, size in mine if at <= x < at + size}) >= AGREE for x in range(500)]
            edges = [x for x in range(1, 500) if covered[x] != covered[x - 1]]
            edges = [0, *edges] if covered[0] else edges
            for a, b in zip(edges[::2], edges[1::2]):
                moved = [other - at for _, at, other, size in mine if at < b and at + size > a]
                first = max(0, a + min(moved))
                if b - a >= TOKENS:
                    expected.append((pair, a, b - a, first, b + max(moved) - first))
        columns = np.array(met, np.int64).reshape(-1, 5).T
        assert [tuple(map(int, r)) for r in zip(*_regions(*columns))] == expected


def test_records_in_planes_come_back():
    from orderloom.llm import parcels

    kind = np.dtype([("a", "<u8"), ("b", "<u2"), ("c", "u1")])
    for n in (0, 1, 1000):
        rows = np.frombuffer(np.random.default_rng(n).bytes(n * kind.itemsize), kind)
        assert (parcels.unpacked(parcels.packed(rows), kind) == rows).all()
        assert (parcels.from_planes(parcels.planes(rows["a"]), np.uint64) == rows["a"]).all()


def test_passages(spark):
    passage, rows = prose(77, 60), []
    for i in range(1, 41):
        rows.append((i, " ".join(prose(i + 500, 80 + i) + passage + prose(i + 900, 70))))
    edited = passage[:20] + ["changed"] + passage[21:]
    rows += [(50, " ".join(prose(51, 90) + edited + prose(52, 90))), (60, " ".join(prose(61, 400))), (61, " ".join(prose(62, 100) + passage[:40] + prose(63, 100)))]
    rows += [(70, None), (71, ""), (None, " ".join(passage)), (72, " ".join(passage * 2)), (72, " ".join(prose(64, 200)))]
    done = repeated_passages(make(spark, rows).withColumn("other_id", F.lit("clash")).repartition(3))
    found = done.collect()
    assert {r.doc_id for r in found} == {*range(2, 41), 50, 72}
    texts = dict(rows)
    for r in found:
        assert r.other_id < r.doc_id and r.similarity >= 0.75 and r.last_word - r.first_word >= 49
        if r.doc_id <= 50 and r.other_id <= 50:
            a, b = words(texts[r.doc_id])[r.first_word : r.last_word + 1], words(texts[r.other_id])[r.other_first : r.other_last + 1]
            x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
            assert abs(len(x & y) / len(x | y) - r.similarity) < 1e-9
    assert repeated_passages(make(spark, [])).count() == 0


def test_passages_drop_tables_that_are_read(spark, monkeypatch):
    """Meetings take the most disk, and are gone before the texts are shuffled."""
    from orderloom.llm.scratch import Scratch

    held, cut = [], Scratch.cut
    monkeypatch.setattr(Scratch, "cut", lambda self, df, label: held.append((label, sorted(self._paths))) or cut(self, df, label))
    passage = prose(77, 60)
    rows = [(i, " ".join(prose(i + 500, 80) + passage)) for i in range(3)]
    assert {r.doc_id for r in repeated_passages(make(spark, rows)).collect()} == {1, 2}
    assert held == [("meetings", []), ("regions", ["meetings"]), ("stretches", ["regions"])]


def test_passages_do_not_depend_on_partitions(spark):
    """A family of variants in one chunk, in another a document that repeats a later one of them."""
    rows, rng = [], random.Random(9)
    for f in range(30):
        passage = prose(3000 + f, 60)
        for i in range(4):
            mine = [w if i == 2 or rng.random() > 0.08 else f"x{rng.randrange(10**6)}" for w in passage]
            rows.append((100 * f + i, " ".join(prose(4000 + 10 * f + i, 50) + mine + prose(5000 + 10 * f + i, 50))))
        rows.append((100 * f + 50, " ".join(prose(6000 + f, 60) + passage + prose(7000 + f, 40))))
    together = make(spark, rows).coalesce(1)
    apart = make(spark, rows).repartition(7)
    split = make(spark, rows).filter("doc_id % 100 < 50").coalesce(1).union(make(spark, rows).filter("doc_id % 100 = 50").coalesce(1))
    want, *others = (sorted(map(tuple, repeated_passages(df).collect())) for df in (together, apart, split))
    assert want and others == [want, want]


def test_passages_name_every_earlier_document(spark):
    """First and last of a family hold the same passage, those between variants; each pair that is alike is found."""
    rows, rng = [], random.Random(5)
    for f in range(60):
        passage = prose(13000 + f, 60)
        for i in range(8):
            mine = [w if i in (0, 7) or rng.random() > 0.07 else f"y{rng.randrange(10**6)}" for w in passage]
            rows.append((10 * f + i, " ".join(prose(20000 + 10 * f + i, 60) + mine + prose(30000 + 10 * f + i, 40))))
    common = prose(12999, 60)
    rows += [(1000 + i, " ".join(prose(41000 + i, 50 + i) + common + prose(42000 + i, 30))) for i in range(12)]
    found = {(r.doc_id, r.other_id) for r in repeated_passages(make(spark, rows)).collect()}
    assert {(10 * f + 7, 10 * f) for f in range(60)} <= found
    assert {(1000 + i, 1000 + j) for i in range(12) for j in range(i)} <= found
    sets = {i: {tuple(w) for w in zip(*(t.split()[60 + k : 116 + k] for k in range(5)))} for i, t in rows if i < 1000}
    alike = {(i, j) for i in sets for j in sets if j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(alike & found) >= 0.95 * len(alike)


def test_every_window_meets_those_of_earlier_documents(monkeypatch):
    from orderloom.llm import passages as P

    rng = np.random.default_rng(11)
    monkeypatch.setattr(P, "PAIRS_AT_ONCE", 7)
    for n, block in ((0, 4), (1, 4), (40, 1000), (200, 1000), (200, 4), (200, 16)):
        monkeypatch.setattr(P, "BLOCK", block)
        key, ids, by, at, before, behind = (rng.integers(0, top, n) for top in (4, 30, 2, 500, 90, 90))
        rows = []
        for x in range(n):
            for y in range(n):
                left, right = min(before[x], before[y]), min(behind[x], behind[y])
                if (key[x], by[x]) == (key[y], by[y]) and ids[y] < ids[x] and left + right + 1 >= P.TOKENS:
                    rows.append(tuple(map(int, (ids[x], ids[y], by[x], at[x] - left, at[y] - left, left + right + 1))))
        chains = P._chains(key.astype(np.uint64), ids, by, at, before, behind)
        assert len(chains) == n  # no two of these windows lie in one another
        assert n < 2 or rows
        parcels = [(P.unpacked(P.packed(c), P._CHAIN), split) for c, split in P._blocks(chains)]
        met = [tuple(map(int, r)) for c, split in parcels for part in P._met(c, split) for r in part]
        assert sorted(met) == sorted(rows)


def test_a_word_that_stands_many_times_meets_as_one():
    """Windows of a repeated token lie in one another: all places and shifts they meet at are kept."""
    from orderloom.llm import passages as P

    step, windows = 3, []
    for doc, (start, many) in enumerate([(5, 40), (0, 60)]):
        values = np.full(start + many * step, 9, np.uint64)
        values[start::step] = 1
        _, at, first, last = compact_windows(values, np.array([0, len(values)]), P.TOKENS)
        windows += [(1, doc, 0, a, a - f, e - a) for a, f, e in zip(at.tolist(), first.tolist(), last.tolist())]
    key, ids, by, at, before, behind = np.array(windows).T
    chains = P._chains(key.astype(np.uint64), ids, by, at, before, behind)
    assert len(chains) == 2 and len(windows) > 50
    rows = np.concatenate([r for c, split in P._blocks(chains) for r in P._met(c, split)])
    starts, shifts, ends = rows[:, 3], rows[:, 4] - rows[:, 3], rows[:, 3] + rows[:, 5]
    for x in windows:
        for y in windows:
            left, right = min(x[4], y[4]), min(x[5], y[5])
            if y[1] < x[1] and left + right + 1 >= P.TOKENS:
                assert starts.min() <= x[3] - left and x[3] + right < ends.max() and shifts.min() <= y[3] - x[3] <= shifts.max()
    assert len(rows) == 2


def test_pairs_that_go_over_batches_are_one():
    import pyarrow as pa

    from orderloom.llm import passages as P

    rows = np.array([(i, j, by, 5 * by, 5 * by + j, 70) for i in range(3) for j in range(i) for by in range(3)])
    table = pa.table([pa.array(c, f.type) for c, f in zip(rows.T, P._PAIR)], schema=P._PAIR)
    want, *others = ([r for b in P._paired(iter(table.to_batches(n))) for r in b.to_pylist()] for n in (100, 1, 2, 4))
    key = lambda r: sorted(r.items())
    assert len(want) == 6 and all(sorted(o, key=key) == sorted(want, key=key) for o in others)
    assert list(P._paired(iter([]))) == []


def test_pairs_that_share_too_little_hold_no_passage():
    from orderloom.llm import passages as P

    rng = np.random.default_rng(3)
    for percent in (75, 90, 100):
        pairs = []
        for _ in range(150):
            mine = rng.integers(0, 2**63, int(rng.integers(0, 120))).astype(np.uint64)
            theirs = np.where(rng.random(len(mine)) < rng.choice([0.1, 0.2, 0.5]), mine ^ np.uint64(1 << 40), mine)
            pairs.append((mine, theirs[: int(rng.integers(0, 121))]))
        (a, b), (x, y) = ((np.concatenate(side), np.r_[0, np.cumsum([len(s) for s in side])]) for side in zip(*pairs))
        shared = P._shared(a, b, x, y)
        assert shared.tolist() == [int(np.isin(m, t).sum()) for m, t in pairs]
        found = [bool(P.verified(m, t, percent)) for m, t in pairs]
        assert any(found) and all(n >= P._least_shared(percent) for n, f in zip(shared, found) if f)


# --- 10


def test_binary_lengths():
    for n in range(0, 5000, 7):
        pieces = binary_lengths(n, 1024)
        assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 1024 for p in pieces) and pieces == sorted(pieces, reverse=True)


def test_packing(spark):
    rows = [(i, " ".join(prose(i, i * 9))) for i in range(60)] + [(None, "x"), (3, "repeat"), (4, None), (5, ""), (6, "w " * 40_000)]
    done = pack_by_powers(make(spark, rows).withColumn("length", F.lit("clash")).repartition(3), vocabulary(BPE)).collect()
    assert sorted(r.sequence_id for r in done) == list(range(len(done)))
    lengths = [r.length for r in sorted(done, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True) and {r.offset for r in done} == {0}
    want = {(d, tuple([*library_ids(t or ""), 0])) for d, t in rows}
    docs = {}
    for r in sorted(done, key=lambda r: r.start):
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    rebuilt = {(d, tuple(np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist())) for (d, n), parts in docs.items() if sum(p.length for p in parts) == n}
    assert rebuilt <= want and len(rebuilt) >= len({(d, len(i)) for d, i in want}) - 1
    assert pack_by_powers(make(spark, []), vocabulary(BPE)).count() == 0
    with pytest.raises(ValueError):
        pack_by_powers(make(spark, rows), vocabulary(BPE), longest=1000)


def test_a_written_table_leaves_no_shuffle_files(spark):
    dirs = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled() -> set[Path]:
        return {p for d in dirs for p in Path(d).rglob("shuffle_*.data")}

    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    scratch = Scratch(spark, "cleanup")
    rows = spark.range(2000).groupBy((F.col("id") % 100).alias("k")).count()
    tables = [scratch.cut(rows, "counts"), cut(rows, "counts")]
    until = time.time() + 10
    while shuffled() - before and time.time() < until:  # Spark drops them beside the job
        time.sleep(0.1)
    assert not shuffled() - before
    assert [t.agg(F.sum("count")).first()[0] for t in tables] == [2000, 2000]
    assert spark.conf.get(key) == setting
    scratch.drop()
