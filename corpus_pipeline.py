"""A training corpus from raw documents: five stages, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's documents.  All but the last return the columns of ``documents``.  Every stage takes
NULLs in any column, empty and very long texts, repeated rows, extra columns and empty tables as its operator
does (see there).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, contamination, jaccard, quality, repeats
from sievework.session import configure, scratch_path
from sievework.workload.catalog import Tables, query


#: Passages of over 50 words that repeat go, however few bytes they have.
PASSAGE_WORDS = 51


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    configure(spark)
    return quality.judge(docs, docs.columns).where("kept").select("d.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 75 % or more: that with the smallest doc_id."""
    configure(spark)
    return jaccard.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words, or of 400 bytes or more, that occur elsewhere; documents with no word left go."""
    configure(spark)
    cut = repeats.without_repeats(docs, docs.columns, with_text=True, n_words=PASSAGE_WORDS)
    left = cut.where("n_removed = 0 or kept_text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    changed = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("d.n_chars")).cast("long")}
    return left.select(*[changed.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 75 % of the shingles of every benchmark item."""
    configure(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    # Rows are told apart by id and text, so a NULL or repeated id does not take other documents along.
    row = F.xxhash64(F.col("doc_id"), F.col("text"))
    hits = contamination.contained_items(docs.select(row.alias("doc_id"), "text"), items)
    return docs.join(hits.select(F.col("doc_id").alias("__hit")).distinct(), row == F.col("__hit"), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, lang, source, n_tokens and digests of its ids and of the text decoded from them."""
    configure(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode_documents(docs, path, keep=("doc_id", "lang", "source"))
    return bpe.decode_documents(encoded, path).select(
        "doc_id", "lang", "source", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_passages),
          ("benchmark decontamination", decontaminated), ("BPE encoding and decoding", token_ids)]

#: SQL cannot express the stages 2, 3 and 5; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, over the whole table of documents."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def _pipeline(t: Tables) -> DataFrame:
    return run(t.spark, t.folder)


query("pipeline", _pipeline, ORACLE_SQL)
