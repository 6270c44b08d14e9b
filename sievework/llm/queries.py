"""The queries of the corpus operators, each over its whole table, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import bpe, chat, contamination, jaccard, licenses, line_quality, oracles, quality, repair, repeats, sharding, spelling, token_files, warc
from sievework.workload.catalog import Tables, query


def op1_packed_token_files(t: Tables) -> DataFrame:
    manifest = token_files.write_token_files(t.documents, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(manifest)


def op2_partenum_jaccard(t: Tables) -> DataFrame:
    return jaccard.similar_components(t.documents).select("doc_id", "n_shingles", "component_id")


def op3_lexicon_bpe(t: Tables) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe.decode_documents(bpe.encode_documents(t.documents, path), path)
    return decoded.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op4_capture_index(t: Tables) -> DataFrame:
    return warc.read_captures(warc.write_archives(t.pages))


def op6_suffix_array_repeats(t: Tables) -> DataFrame:
    cut = repeats.without_repeats(t.documents, ["doc_id"])
    return cut.select("d.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_license_dictionaries(t: Tables) -> DataFrame:
    return licenses.scan_licenses(t.documents)


def op10_adaptive_quality(t: Tables) -> DataFrame:
    judged = quality.judge(t.documents, ["doc_id"])
    return judged.select("d.doc_id", *[F.col(f"m.{c}").alias(c) for c in quality.MEASURES], "base_failed", "kept")


def op8_balanced_shards(t: Tables) -> DataFrame:
    return sharding.shard_rows(t.documents)


def op5_chat_snapshots(t: Tables) -> DataFrame:
    return chat.render(t.conversations)


def op7_benchmark_containment(t: Tables) -> DataFrame:
    return contamination.contained_items(t.documents, t.benchmark)


def op11_line_field(t: Tables) -> DataFrame:
    return line_quality.score_documents(t.documents, line_quality.training_field(t.documents, t.labels))


def op12_conversation_repair(t: Tables) -> DataFrame:
    return repair.repair(repair.damaged(t.conversations))


def op13_bloom_variants(t: Tables) -> DataFrame:
    return spelling.spelling_groups(t.documents)


query("op1_packed_token_files", op1_packed_token_files, None)
query("op2_partenum_jaccard", op2_partenum_jaccard, oracles.JACCARD)
query("op3_lexicon_bpe", op3_lexicon_bpe, None)
query("op4_capture_index", op4_capture_index, None)
query("op5_chat_snapshots", op5_chat_snapshots, oracles.SNAPSHOTS)
query("op6_suffix_array_repeats", op6_suffix_array_repeats, None)
query("op7_benchmark_containment", op7_benchmark_containment, oracles.CONTAINMENT)
query("op8_balanced_shards", op8_balanced_shards, None)
query("op9_license_dictionaries", op9_license_dictionaries, None)
query("op10_adaptive_quality", op10_adaptive_quality, oracles.QUALITY)
query("op11_line_field", op11_line_field, None)
query("op12_conversation_repair", op12_conversation_repair, oracles.REPAIR)
query("op13_bloom_variants", op13_bloom_variants, oracles.SPELLING)
