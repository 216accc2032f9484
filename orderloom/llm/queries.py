"""The registered query of each operator: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import langid, token_store, toxicity
from orderloom.llm.collocations import collocations
from orderloom.llm.decontam import mark_leaks
from orderloom.llm.fertility import fertility
from orderloom.llm.near_dup import near_duplicates
from orderloom.llm.packing import pack_by_powers
from orderloom.llm.passages import repeated_passages
from orderloom.llm.shards import byte_shards, text_bytes
from orderloom.llm.suffix_dedup import remove_repeats
from orderloom.llm.token_links import token_links
from orderloom.llm.tokens import vocabulary
from orderloom.llm.url_rules import SPAM_WORDS, host_rule, judge_urls
from orderloom.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    host_rule("allow", "com", "/"),
    host_rule("block", "example.com", "/en/"),
    host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"),
    host_rule("block", "net", "/fr/"),
]
SHARDS = 40
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(_table(spark, folder, "pages"), URL_RULES).drop("n_candidates")


def op2_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return fertility(_table(spark, folder, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECE_BPE))


def op3_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    models = langid.fit(docs.filter(~held))
    return langid.identify(docs, models).select("doc_id", held.alias("held_out"), "lang_pred", "score", "nats", "rejected")


def op4_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    rows = docs.select("doc_id", text_bytes().alias("_bytes"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"))
    dealt = byte_shards(rows, SHARDS, F.col("_bytes") + 16, ["doc_id"])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_minhash_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op6_suffix_sort(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_table(spark, folder, "documents")).drop("text", "kept_text")


def op7_seed_align(spark: SparkSession, folder: str) -> DataFrame:
    marked = mark_leaks(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op8_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "token-store")
    token_store.write_store(_table(spark, folder, "documents"), path, vocabulary(BYTE_BPE), end_id=2)
    return token_store.read_digests(spark, path)


def op9_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(_table(spark, folder, "documents"))


def op10_power_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_by_powers(_table(spark, folder, "documents"), vocabulary(BYTE_BPE), with_ids=False).drop("ids")


def op11_son_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents"))


def op12_ftrl_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    labels = toxicity.labels_per_document(_table(spark, folder, "labels"))
    weights = toxicity.fit(docs.filter(~held), labels)
    return toxicity.scored(docs.select("doc_id", "text"), weights).select("doc_id", held.alias("held_out"), "score", "predicted")


def op13_lockstep(spark: SparkSession, folder: str) -> DataFrame:
    return token_links(_table(spark, folder, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECE_BPE))


_SPAM = "|".join(SPAM_WORDS)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL: dict[str, str] = {
    "op1_url_rules": rf"""
        WITH rests AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
        ), hosts AS (
            SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
        ), rules(host, path, action) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                   ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        )
        SELECT h.page_id, h.host, h.path, r.host || r.path AS rule,
            coalesce(r.action, CASE WHEN regexp_matches(h.host, '(^|[^a-z0-9])({_SPAM})($|[^a-z0-9])') THEN 'block' ELSE 'allow' END) AS verdict
        FROM hosts h LEFT JOIN rules r
            ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
        QUALIFY row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1
    """,
    # The checksum is spelled out from the rule of its table; 3988292384 is its polynomial.
    "op4_byte_shards": rf"""
        WITH steps AS (
            SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM (SELECT unnest(range(0, 256)) AS i)
        ), rule AS (SELECT list(c ORDER BY i) AS crc FROM steps),
        sized AS (
            SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
                   list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes
            FROM documents
        ), summed AS (
            SELECT doc_id, size, bytes, SUM(size) OVER (ORDER BY doc_id) AS upto, SUM(size) OVER () AS everything FROM sized
        ), dealt AS (
            SELECT doc_id, size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) AS text_crc32,
                   CAST((2 * upto - size) * {SHARDS} // (2 * everything) AS INTEGER) AS shard
            FROM summed, rule
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM dealt
    """,
    "op5_minhash_forest": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
        ), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n_a, y.n AS n_b, COUNT(*) AS n
            FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM pairs WHERE 100 * n >= 75 * (n_a + n_b - n) UNION ALL SELECT b, a FROM pairs WHERE 100 * n >= 75 * (n_a + n_b - n)
        ), reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        )
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN (SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY 1) USING (doc_id)
    """,
    "op11_son_phrases": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), totals AS (SELECT lang, SUM(len(w)) AS n FROM words GROUP BY lang),
        f AS (
            SELECT lang, phrase, COUNT(*) AS f, len(string_split(phrase, ' ')) AS k
            FROM (SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase FROM words)
            GROUP BY lang, phrase HAVING COUNT(*) >= 30
        ), candidates AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        cuts AS (SELECT lang, phrase, a, w, unnest(range(1, len(w))) AS c FROM candidates),
        scores AS (
            SELECT c.lang, c.phrase, c.a, c.c, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.c], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.c + 1:], ' ')
        ), weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        inside AS (
            SELECT lang, MAX(a) AS longer, phrase FROM (
                SELECT lang, a, unnest(flatten(list_transform(range(2, len(w)), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase
                FROM candidates WHERE len(w) > 2)
            GROUP BY lang, phrase
        ), ranked AS (
            SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
            FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
            WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST(80 AS HUGEINT) * w.a
        )
        SELECT r.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
    """,
}

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_rules, op2_fertility, op3_kneser_ney, op4_byte_shards, op5_minhash_forest, op6_suffix_sort, op7_seed_align,
        op8_token_store, op9_compact_windows, op10_power_packing, op11_son_phrases, op12_ftrl_toxicity, op13_lockstep,
    )
}
