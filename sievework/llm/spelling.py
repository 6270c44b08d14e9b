"""Spelling variants: words one letter apart, found by probing generated edits against Bloom filters.

1. Words are counted in slices of each task and summed by Spark.
2. Every word of the vocabulary sets a few bits of one 64-bit block of the Bloom filter of its shard: its
   length and a slice of its hash.  A shard holds a bounded number of words, whatever the corpus has.
3. Filters are broadcast in rounds of a bounded number of bytes (one round up to about 16 million words).  Each word's
   edits are generated as hashes only, from the hash of the word, and probed; a spelling is written out for positives only.
4. Positives meet the vocabulary in an exact join, which drops false positives.
5. Forms are followed to their roots by pointer doubling.  A form has ten times the occurrences of its word, so
   a chain has no more links than the largest count has digits.

An edit between two words is generated once: replacements from the smaller word, deletions from the longer
one.  The letters tried are all that the vocabulary contains.  No word, neighbour or candidate is capped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.columns import plain_columns
from sievework.llm.scratch import Scratch

#: Letters of a word (fixed by the result contract).
LETTERS = "A-Za-zÀ-ÿ"
MIN_LETTERS, MIN_COUNT = 7, 2
#: One run in this many loses a letter (fixed by the result contract).
DAMAGE = 31
#: A form occurs at least this many times as often as its variant (fixed by the result contract).
RATIO = 10
#: Longer texts are read in pieces of about this many characters, cut between words.
PIECE_CHARS = 1 << 22
#: Distinct words a task holds before it hands its counts on.
HELD_WORDS = 200_000
#: Words of one shard, 64-bit blocks a word, and bytes of filters that are broadcast at once.
SHARD_WORDS, BLOCKS_A_WORD, ROUND_BYTES = 1 << 17, 0.5, 64 << 20
#: Lengths from here on share one class of shards.
LONG = 64
#: Hashes probed at once.
PROBES = 1 << 19

_LOWER = {c: c + 32 for c in range(65, 91)}
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_U = np.uint64


def _runs(text: str, run: re.Pattern, other: re.Pattern) -> Iterator[list[str]]:
    at = 0
    while at < len(text):
        cut = other.search(text, at + PIECE_CHARS)
        end = cut.start() if cut and at + PIECE_CHARS < len(text) else len(text)
        yield run.findall(text, at, end)
        at = end


def _damaged(run: str, prefix: int, damage: int) -> str:
    """``run`` in lower case, less the letter that the checksum of document and run names."""
    if not run.islower():
        run = run.lower() if run.isascii() else run.translate(_LOWER)
    if damage:
        h = zlib.crc32(run.encode(), prefix)
        if h % damage == 0:
            k = h % len(run)
            return run[:k] + run[k + 1:]
    return run


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all words with enough letters and occurrences; needs doc_id and text.

    NULL texts have no words; a NULL doc_id counts as the empty string in the checksum.
    ``damage`` = 0 leaves the words as they are.
    """
    pattern = f"[{LETTERS}]{{{min_letters},}}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, other, held = re.compile(pattern), re.compile(f"[^{LETTERS}]"), Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                prefix = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                for found in _runs(text.as_py() or "", run, other):
                    for r, n in Counter(found).items():
                        word = _damaged(r, prefix, damage)
                        if len(word) >= min_letters:
                            held[word] += n
                    if len(held) > HELD_WORDS:
                        yield handed()
        if held:
            yield handed()

    texts = plain_columns(docs, {"doc_id": "string", "text": "string"}).where("text is not null")
    counted = texts.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- hashes ---------------------------------------------------------------------------------------------------------

def _powers(n: int) -> np.ndarray:
    """P^0, P^1, ... modulo 2^64."""
    out = np.full(n, _P, dtype=_U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _letters(words: list[str], length: int) -> np.ndarray:
    """Code points, a row a word; all words have ``length`` letters."""
    return np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length).astype(_U)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _bits(h: np.ndarray) -> np.ndarray:
    """Four bits of a block, from a mixed hash."""
    y, one = h * _U(0x94D049BB133111EB), _U(1)
    return (one << (y >> _U(58))) | (one << ((y >> _U(52)) & _U(63))) | (one << ((y >> _U(46)) & _U(63))) | (one << ((y >> _U(40)) & _U(63)))


def _slice(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(n)) >> _U(32)


def _block(h: np.ndarray, n: int) -> np.ndarray:
    return ((h & _U(0xFFFFFFFF)) * _U(n)) >> _U(32)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


class Shards:
    """How lengths are cut into shards: slices and blocks a slice, by class of length."""

    def __init__(self, counts: dict[int, int], shard_words: int = SHARD_WORDS):
        self.slices = {c: -(-n // shard_words) for c, n in counts.items()}
        self.blocks = {c: max(16, int(-(-n // self.slices[c]) * BLOCKS_A_WORD)) for c, n in counts.items()}

    def rounds(self, limit: int) -> list[list[tuple[int, int]]]:
        """Shards in groups of at most ``limit`` bytes of filters (one shard at least)."""
        out, held = [[]], 0
        for c in sorted(self.slices):
            for s in range(self.slices[c]):
                if out[-1] and held + 8 * self.blocks[c] > limit:
                    out.append([])
                    held = 0
                out[-1].append((c, s))
                held += 8 * self.blocks[c]
        return out


def _filters(vocabulary: DataFrame, shards: Shards) -> DataFrame:
    """(cls, slice, bits): the Bloom filter of every shard, made by one task from the hashes of its words."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["word"].tolist()
            for length, at in _by_length(words):
                powers, cls = _powers(length), min(length, LONG)
                for part in np.array_split(at, max(1, len(at) * length // PROBES)):
                    h = _mixed((_letters([words[k] for k in part], length) * powers).sum(axis=1, dtype=_U))
                    yield pd.DataFrame({"cls": cls, "slice": _slice(h, shards.slices[cls]).astype(np.int64), "h": h.view(np.int64)})

    def built(key: tuple, hashes: pd.DataFrame) -> pd.DataFrame:
        h, n = hashes["h"].to_numpy().view(_U), shards.blocks[key[0]]
        blocks = np.zeros(n, dtype=_U)
        np.bitwise_or.at(blocks, _block(h, n).astype(np.int64), _bits(h))
        return pd.DataFrame({"cls": [key[0]], "slice": [key[1]], "bits": [blocks.tobytes()]})

    return (vocabulary.select("word").mapInPandas(hashed, "cls long, slice long, h long")
            .groupBy("cls", "slice").applyInPandas(built, "cls long, slice long, bits binary"))


class _Probe:
    """Membership in the filters of one round."""

    def __init__(self, shards: Shards, filters: dict[tuple[int, int], bytes]):
        self.shards, self.bases, parts, at = shards, {}, [], 0
        for (c, s), bits in filters.items():
            self.bases.setdefault(c, np.full(shards.slices[c], -1, dtype=np.int64))[s] = at
            parts.append(np.frombuffer(bits, dtype=_U))
            at += len(parts[-1])
        self.blocks = np.concatenate(parts) if parts else np.empty(0, _U)

    def __call__(self, length: int, h: np.ndarray) -> np.ndarray:
        """Indices of the (flat) hashes of words of ``length`` that may be in the vocabulary."""
        c = min(length, LONG)
        if c not in self.bases:
            return np.empty(0, np.int64)
        h = _mixed(h)
        base = self.bases[c][_slice(h, self.shards.slices[c]).astype(np.int64)]
        bits = _bits(h)
        there = self.blocks[np.maximum(base, 0) + _block(h, self.shards.blocks[c]).astype(np.int64)]
        return np.flatnonzero(((there & bits) == bits) & (base >= 0))


def _edits(words: list[str], length: int, alphabet: np.ndarray, probe: _Probe, min_letters: int) -> Iterator[tuple[int, str]]:
    """(index of the word, spelling) of the edits that may be words."""
    powers = _powers(length)
    step = max(1, PROBES // max(length, len(alphabet)))
    for first in range(0, len(words), step):
        part = words[first:first + step]
        codes = _letters(part, length)
        terms = codes * powers
        h = terms.sum(axis=1, dtype=_U)
        for i in range(length):
            row, letter = np.nonzero(alphabet[None, :] > codes[:, i][:, None])
            new = alphabet[letter]
            for k in probe(length, h[row] + (new - codes[row, i]) * powers[i]):
                w = part[row[k]]
                yield first + int(row[k]), w[:i] + chr(int(new[k])) + w[i + 1:]
        if length > min_letters:
            before = np.zeros(len(part), dtype=_U)
            for i in range(length):
                row = np.arange(len(part)) if i == 0 else np.flatnonzero(codes[:, i] != codes[:, i - 1])
                rest = (h - before - terms[:, i]) * _U(_P_INVERSE)
                for k in probe(length - 1, (before + rest)[row]):
                    w = part[row[k]]
                    yield first + int(row[k]), w[:i] + w[i + 1:]
                before = before + terms[:, i]


def near_words(vocabulary: DataFrame, min_letters: int = MIN_LETTERS, shard_words: int = SHARD_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``vocabulary`` (word, n) one letter apart."""
    spark = vocabulary.sparkSession
    scratch = Scratch(spark)
    cls = F.least(F.length("word"), F.lit(LONG)).cast("long")
    counts = {r[0]: r[1] for r in vocabulary.groupBy(cls).count().collect()}  # at most LONG rows
    schema = "word string, near string, near_n long"
    if not counts:
        return spark.createDataFrame([], schema)
    used = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()  # letters of LETTERS at most
    alphabet = np.array(sorted(ord(r.c) for r in used if r.c), dtype=_U)
    shards = Shards(counts, shard_words)
    filters = scratch.store(_filters(vocabulary, shards), "spelling-filters")
    positives = None
    for wanted in shards.rounds(round_bytes):
        here = spark.createDataFrame(wanted, "cls long, slice long")
        sent = spark.sparkContext.broadcast({(r.cls, r.slice): bytes(r.bits) for r in filters.join(F.broadcast(here), ["cls", "slice"]).collect()})

        def probed(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            probe = _Probe(shards, sent.value)
            for batch in batches:
                words, ns = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                for length, at in _by_length(words):
                    own = [words[k] for k in at]
                    found, spelled = [], []
                    for k, spelling in _edits(own, length, alphabet, probe, min_letters):
                        found.append(k)
                        spelled.append(spelling)
                    yield pa.RecordBatch.from_arrays([pa.array(spelled, pa.string()), pa.array([own[k] for k in found], pa.string()),
                                                      pa.array(ns[at[found]] if found else [], pa.int64())], ["candidate", "word", "n"])

        spread = vocabulary.repartition(max(spark.sparkContext.defaultParallelism, -(-sum(counts.values()) // 50_000)), "word")
        part = scratch.store(spread.mapInArrow(probed, "candidate string, word string, n long"), "spelling-positives")
        positives = part if positives is None else positives.unionByName(part)
        sent.unpersist()
    exact = positives.join(vocabulary.select(F.col("word").alias("candidate"), F.col("n").alias("candidate_n")), "candidate")
    both = F.array(F.struct(F.col("word"), F.col("candidate").alias("near"), F.col("candidate_n").alias("near_n")),
                   F.struct(F.col("candidate").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    pairs = scratch.store(exact.select(F.inline(both)), "spelling-pairs")
    scratch.drop("spelling-filters", "spelling-positives")
    return pairs


def _roots(forms: DataFrame, largest: int, ratio: int, scratch: Scratch) -> DataFrame:
    """(word, root) of every (word, form): forms followed to the last."""
    roots = scratch.store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    longest, reach = 0, 1
    while largest >= ratio:
        largest, longest = largest // ratio, longest + 1
    while reach < longest:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = scratch.store(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots", replace=True)
        reach *= 2
    return roots


def spelling_groups(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, damage: int = DAMAGE, ratio: int = RATIO,
                    shard_words: int = SHARD_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Needs doc_id and text; other columns may have any name.  NULL and empty texts have no words, very long texts are
    read in pieces, repeated rows count again, ties between forms go to the smaller word in code-point order, and an
    empty table gives no rows.  A word without a near word has n_near 0; without a form it is its own root.
    """
    scratch = Scratch(docs.sparkSession)
    vocabulary = scratch.store(word_counts(docs, min_letters, min_count, damage), "spelling-words")
    pairs = near_words(vocabulary, min_letters, shard_words, round_bytes)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best"))
    fits = -F.col("best.m") >= ratio * F.col("n")
    known = scratch.store(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "spelling-forms")
    largest = known.agg(F.max("n")).first()[0] or 0
    roots = _roots(known.where("form is not null"), largest, ratio, scratch)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
