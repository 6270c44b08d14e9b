"""Benchmark decontamination: containment search with size-partitioned MinHash sketches.

A test item is short and a document long, so their Jaccard similarity says little; what
counts is the share of the item's shingles that the document contains.  Items are put into
size partitions (powers of two).  The sketch of an item is its k smallest shingle hashes,
where k follows from the upper size of its partition: an item contained to 75 % can miss
a quarter of its shingles at most, so k > upper / 4 leaves at least one sketch value in
the document.  A partition also gives the smallest document that can contain its items.
Candidates are then checked on the whole shingle sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.columns import shingle_set
from sievework.session import through_storage

PERCENT = 75


def item_sketches(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item_id, text, item_set, least, sketch): ``sketch`` the k smallest hashes, ``least`` the shared shingles needed."""
    sets = items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.array_sort(shingle_set(F.col("text").cast("string"))).alias("item_set")).where("size(item_set) > 0")
    n = F.size("item_set")
    upper = F.least(n.cast("long") * 2, F.pow(F.lit(2), F.ceil(F.log2(n + 1))).cast("long"))  # end of the size partition
    missing = F.floor(upper * (100 - percent) / 100)
    return sets.select("item_id", "item_set", F.ceil(n * percent / 100).cast("int").alias("least"),
                       F.slice("item_set", F.lit(1), F.least(n, (missing + 1).cast("int"))).alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared): items of which a document holds ``percent`` % or more.

    Needs doc_id, text and item_id, text.  NULL, empty and white-space texts have no shingles
    and match nothing; fewer than five words are one shingle, so such an item only matches a
    document of just these words.  Documents are told apart by id and text, so those with a NULL or repeated id are
    searched one by one; repeated rows of a table give one result; items with a NULL id are searched like any other; extra columns are not read; an empty table gives an
    empty result.  Whole texts are searched.
    """
    sketches = through_storage(item_sketches(items, percent), "item-sketches")
    probes = sketches.select("item_id", "least", F.explode("sketch").alias("h"))
    # No sketch value lies above this one, so larger hashes of documents need not be looked up.
    limits = sketches.agg(F.max(F.array_max("sketch")).alias("top"), F.min("least").alias("least")).first()
    if limits["top"] is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item_shingles int, n_shared int")
    number, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    narrow = docs.select(F.struct(F.xxhash64(number, text).alias("h1"), F.hash(number, text).alias("h2")).alias("row"),
                         number.alias("doc_id"), text.alias("text"))
    sets = narrow.select("row", shingle_set(F.col("text")).alias("doc_set"))
    looked_up = (sets.where(F.size("doc_set") >= limits["least"])
                 .select("row", F.size("doc_set").alias("n"),
                         F.explode(F.filter("doc_set", lambda h: h <= F.lit(limits["top"]))).alias("h")))
    # Spark broadcasts the sketches if their measured size allows, else both sides are shuffled by hash.
    pairs = (looked_up.join(probes, "h").where("n >= least").select("row", "item_id").distinct())
    pairs = through_storage(pairs, "containment-candidates")
    texts = narrow.join(pairs.select("row").distinct(), "row", "left_semi")
    full = texts.select("row", "doc_id", shingle_set(F.col("text")).alias("doc_set"))
    shared = F.size(F.array_intersect("item_set", "doc_set"))
    return (pairs.join(full, "row").join(sketches.select("item_id", "item_set", "least"),
                                            pairs["item_id"].eqNullSafe(sketches["item_id"]))
            .select("doc_id", pairs["item_id"], F.size("item_set").alias("n_item_shingles"), shared.alias("n_shared"), "least")
            .where("n_shared >= least").drop("least").distinct())
