"""Few small rows that stand for much work are not put into one task."""

import public_tokenizers

from sievework.llm import token_files, warc


def test_files_and_blocks_are_read_back_by_many_tasks(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "concat('text number ', id) as text")
    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://h', id % 40, '.example/', id) as url", "concat('<p>', id % 900, '</p>') as html")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        manifest, directory = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), 2), warc.write_archives(pages)
    finally:
        spark.conf.set(name, "true")
    files, blocks = manifest.count(), directory.count()
    assert files > 1 and blocks > 1
    tokens, captures = token_files.read_token_files(manifest), warc.read_captures(directory)
    assert tokens.rdd.getNumPartitions() == files and captures.rdd.getNumPartitions() == min(blocks, spark.sparkContext.defaultParallelism)
    assert tokens.count() == 200 and captures.count() == 3000
