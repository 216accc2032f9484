"""From raw documents to packed training sequences: each stage reads what the one before has written."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import langid
from orderloom.llm.decontam import mark_leaks
from orderloom.llm.near_dup import near_duplicates
from orderloom.llm.packing import pack_by_powers
from orderloom.llm.suffix_dedup import remove_repeats
from orderloom.llm.tokens import vocabulary
from orderloom.session import cut

#: Words that a worker remembers while packing: it may still hold what the earlier stages left.
CACHE_WORDS = 120_000

#: Most that is sent to a worker at once, about; Spark's own limit of 10,000 rows is some 20 MB of documents, held on both sides.
BATCH_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """``stage`` with batches of BATCH_BYTES; the setting stays, since the result is computed later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, folder)

    return run


@bounded
def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language a model recognises, with all their columns; rejected ones go."""
    models = langid.fit(docs)
    return langid.identified(docs, models).filter("NOT rejected").select(*docs.columns)


@bounded
def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Near duplicates (0.75 on five-word shingles): the smallest doc_id of each group stays.

    Rows that repeat the kept doc_id stay; rows without doc_id stay unless a document with one has the same words.
    """
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs.doc_id.eqNullSafe(F.col("__kept")), "left_semi")


@bounded
def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the byte strings of 50 that an earlier document has; a character that is cut goes as a whole.

    A document of which nothing is left goes; n_chars becomes the new length. An empty or null text stays as it is.
    """
    cleaned = remove_repeats(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text")])
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    out = cleaned.filter("n_removed = 0 OR length(trim(kept_text)) > 0").withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


@bounded
def without_test_items(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    marked = mark_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    return marked.filter(F.size("leaks") == 0).select(*docs.columns)


@bounded
def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 1024 ids with their ids, one sequence each."""
    return pack_by_powers(docs, vocabulary("byte_bpe_50k.json"), cache_words=CACHE_WORDS)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_strings", without_repeats),
    ("decontamination", without_test_items),
    ("packing", packed),
]

#: No SQL: language models, tokenizers and alignments are not SQL-expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, folder), name)
    return docs
