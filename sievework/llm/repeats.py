"""Removal of byte passages that occur more than once in the corpus, found by suffix arrays.

A string of ``length`` bytes (400 if nothing else is said) chooses one of its 64-byte grams, that with the smallest hash, as its
anchor; equal strings choose the same gram at the same place.  So every start of such a string
belongs to one anchor, and equal strings meet in the group of their anchor's hash, wherever they are.
The starts of an anchor are cut by their distance from it; all starts of one cut share a core
of at least 310 bytes (all three sizes follow from the length), and only equal cores have to be compared.  A group of equal cores becomes one text, its
suffix array is built in linear time, and neighbours with a common prefix of ``length`` bytes
are repeats.  Passages counted in words are found the same way in the codes of the words, eight bytes each.

Equal segments are counted before anything else, so a group of many copies is one segment in
the suffix array.  A core with more segments than ``SEGMENTS`` is compared by counting the
hashes of its single strings, which Spark combines before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.jaccard import _BYTE, _STEP, _STEP_BACK, mixed
from sievework.llm.suffixes import repeated_starts
from sievework.session import through_storage

LENGTH = 400
#: Bytes of the code of a word.
CODE = 8
#: Most segments of one suffix array (about 1 MB); cores with more are counted string by string.
SEGMENTS = 2000
#: Different segments that one task compares, about.
PARTS_A_TASK = 10_000
#: Bytes of text worked on at a time.
CHUNK = 1 << 21
_POSITION = np.uint64(CHUNK * 4 - 1)


def gram_of(length: int) -> int:
    """Bytes of an anchor's gram: 64 for 400 bytes and above, less for shorter strings."""
    return max(1, min(64, length * 4 // 25))


def cut_of(length: int) -> int:
    """Starts of an anchor are cut into classes of so many distances: 90 for 400 bytes."""
    return max(1, length * 9 // 40)


def chunks(texts: list[bytes], size: int = CHUNK, length: int = LENGTH) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """(pieces, rows, offsets): all texts in runs of about ``size`` bytes; a long text is cut so that each start is in one piece."""
    pieces, rows, offsets, held = [], [], [], 0
    for row, text in enumerate(texts):
        for a in range(0, max(1, len(text) - length + 1), size):
            piece = text[a:a + size + length - 1]
            if held and held + len(piece) > size:
                yield pieces, rows, offsets
                pieces, rows, offsets, held = [], [], [], 0
            pieces.append(piece)
            rows.append(row)
            offsets.append(a)
            held += len(piece)
    if pieces:
        yield pieces, rows, offsets


class _Hashed:
    """A run of pieces with hashes of all their substrings."""

    def __init__(self, pieces: list[bytes]):
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(self.data)
        power, self.back = np.full(n, _STEP, np.uint64), np.full(n, _STEP_BACK, np.uint64)
        power[:1] = self.back[:1] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(self.back, out=self.back)
        power *= _BYTE[self.data]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(power, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def anchors(pieces: list[bytes], length: int = LENGTH) -> tuple[_Hashed, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, piece, anchor, first start, last start, hash of the gram) of each anchor; places are within the run."""
    gram = gram_of(length)
    window = length - gram + 1
    hashed = _Hashed(pieces)
    n = len(hashed.data)
    none = np.empty(0, np.int64)
    if n < length:
        return hashed, none, none, none, none, none.view(np.uint64)
    sizes = np.fromiter(map(len, pieces), np.int64, count=len(pieces))
    end = np.cumsum(sizes)
    at = np.arange(n - gram + 1)
    key = (hashed.of(at, at + gram) & ~_POSITION) | at.astype(np.uint64)
    m = len(key)
    blocks = np.concatenate([key, np.full(-m % window, 2**64 - 1, np.uint64)]).reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:m - window + 1], ahead[window - 1:m]) & _POSITION
    piece = np.repeat(np.arange(len(pieces)), sizes)[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + length <= end[piece])
    anchor = least[start].astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1) != 0)
    lo, hi = start[first], start[np.append(first[1:], len(start))[:len(first)] - 1]
    anchor = anchor[first]
    return hashed, piece[lo], anchor, lo, hi, hashed.of(anchor, anchor + gram)


def _segments(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per anchor of every text: gram, content (of all its strings), node, node2, lo, hi, anchor."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, node2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for k in range(0, batch.num_rows, 500):
                texts = [x or b"" for x in batch.column(2).slice(k, 500).cast(pa.large_binary()).to_pylist()]
                for pieces, rows, offsets in chunks(texts, length=length):
                    h, piece, anchor, lo, hi, gram = anchors(pieces, length)
                    sizes = np.fromiter(map(len, pieces), np.int64, count=len(pieces))
                    shift = (np.array(offsets) - (np.cumsum(sizes) - sizes))[piece]
                    content = mixed(h.of(lo, hi + length) + mixed((anchor - lo).astype(np.uint64)))
                    row = np.array(rows)[piece] + k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram.view(np.int64)), pa.array(content.view(np.int64)), pa.array(node[row]), pa.array(node2[row]),
                         *[pa.array((x + shift).astype(np.int32)) for x in (lo, hi, anchor)]],
                        names=["gram", "content", "node", "node2", "lo", "hi", "anchor"])

    return docs.select("node", "node2", "text").mapInArrow(
        work, "gram long, content long, node long, node2 int, lo int, hi int, anchor int")


_PARTS = pa.schema([("core", pa.int64()), ("part", pa.int64()), ("gram", pa.int64()), ("content", pa.int64()), ("offset", pa.int32()),
                    ("starts", pa.int32()), ("core_at", pa.int32()), ("data", pa.binary())])


def _parts(wanted: DataFrame, length: int = LENGTH) -> DataFrame:
    """Segments (a list ``segs`` per text) cut by the distance of their starts from the anchor, with their bytes."""
    cut = cut_of(length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segs = batch.column(1)
            for row in range(batch.num_rows):
                text = batch.column(0).slice(row, 1).cast(pa.large_binary())[0].as_py() or b""
                out = []
                for s in segs[row].as_py():
                    lo, hi, anchor = s["lo"], s["hi"], s["anchor"]
                    for c in range((anchor - hi) // cut, (anchor - lo) // cut + 1):
                        a, b = max(lo, anchor - c * cut - cut + 1), min(hi, anchor - c * cut)  # starts [a, b]
                        # Bytes that every start of this class has: from its last start to the end of its first.
                        core = text[anchor - c * cut:anchor - c * cut - cut + 1 + length]
                        out.append({"core": _hash(core, c), "part": _hash(text[a:b + length], anchor - a), "gram": s["gram"],
                                    "content": s["content"], "offset": a - lo, "starts": b - a + 1, "core_at": anchor - c * cut - a, "data": text[a:b + length]})
                yield pa.RecordBatch.from_pylist(out, schema=_PARTS)

    return wanted.select("text", "segs").mapInArrow(
        work, "core long, part long, gram long, content long, offset int, starts int, core_at int, data binary")


def _hash(data: bytes, seed: int) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(data, seed=seed) - (1 << 63)


def _by_suffix_array(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(core, part, a, b): starts [a, b) of a part that begin a repeated string; whole cores in one partition, sorted.

    The parts of a core share its bytes at one place of their strings, so the core is one letter of the array's text: what
    is left of a string of ``length`` bytes are ``cut`` letters.
    """
    cut = cut_of(length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns])

        def solved(core: int, held: list[tuple]) -> list[dict]:
            found = repeated_starts([x[4] for x in held], [x[2] for x in held], cut, [(x[3], x[3] + length - cut + 1) for x in held])
            out = []
            for x, marks in zip(held, found):
                edge = np.flatnonzero(np.diff(np.array([False, *marks, False]).astype(np.int8)))
                out += [{"core": core, "part": x[1], "a": int(a), "b": int(b)} for a, b in zip(edge[0::2], edge[1::2])]
            return out

        schema = pa.schema([("core", pa.int64()), ("part", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])
        out, held, now = [], [], None
        for r in rows():
            if r[0] != now and held:
                out += solved(now, held)
                held = []
                if len(out) > 5000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            now = r[0]
            held.append(r)
        if held:
            out += solved(now, held)
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    # Little data, but much work for each row: with a number given, Spark does not put partitions together.
    tasks = max(parts.sparkSession.sparkContext.defaultParallelism, -(-parts.count() // PARTS_A_TASK))
    return (parts.select("core", "part", "starts", "core_at", "data").repartition(tasks, "core").sortWithinPartitions("core", "part")
            .mapInArrow(work, "core long, part long, a int, b int"))


def _by_counting(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for cores with many parts: single strings are hashed and counted."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for core, part, starts, data in zip(*[c.to_pylist() for c in batch.columns]):
                hashes = [_hash(data[k:k + length], 7) for k in range(starts)]
                yield pa.RecordBatch.from_arrays([pa.array([core] * starts, pa.int64()), pa.array([part] * starts, pa.int64()),
                                                  pa.array(range(starts), pa.int32()), pa.array(hashes, pa.int64())],
                                                 names=["core", "part", "a", "string"])
    strings = parts.select("core", "part", "starts", "data").mapInArrow(work, "core long, part long, a int, string long")
    strings = through_storage(strings, "counted-strings")
    repeated = strings.groupBy("core", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return strings.join(repeated, ["core", "string"], "left_semi").select("core", "part", "a", (F.col("a") + 1).alias("b"))


def repeat_spans(docs: DataFrame, length: int = LENGTH, coded: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """(node, node2, start, end): bytes covered by repeated strings, per text; spans may overlap.  ``docs`` has node, node2, text.

    ``coded`` puts other bytes in place of the texts: of all rows, and again of those whose segments are compared, so they are never stored.
    """
    segments = through_storage(_segments(coded(docs), length), "segments")
    grams = segments.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    shared = through_storage(segments.join(grams, "gram", "left_semi"), "shared-segments")
    one = F.min(F.struct("node", "node2", "lo", "hi", "anchor")).alias("one")
    kinds = through_storage(shared.groupBy("gram", "content").agg(F.count(F.lit(1)).alias("n"), one), "kinds-of-segments")
    # Segments that occur twice are repeats as a whole.
    whole = shared.join(kinds.where("n > 1").select("gram", "content"), ["gram", "content"], "left_semi")
    whole = whole.select("node", "node2", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    several = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram")
    open_kinds = kinds.join(several, "gram", "left_semi")
    per_text = open_kinds.groupBy("one.node", "one.node2").agg(
        F.collect_list(F.struct("gram", "content", "one.lo", "one.hi", "one.anchor")).alias("segs"))  # segments of one text
    parts = through_storage(_parts(coded(docs.join(per_text, ["node", "node2"])), length), "segment-parts")
    counted = through_storage(parts.groupBy("core", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("gram", "content", "offset")).alias("one"), F.max("starts").alias("starts")), "kinds-of-parts")
    twice = counted.where("n > 1").select("core", "part", F.lit(0).alias("a"), F.col("starts").alias("b"))
    crowd = counted.groupBy("core").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    chosen = (counted.join(crowd, "core").select("core", "part", F.col("one.gram").alias("gram"), F.col("one.content").alias("content"),
                                                 F.col("one.offset").alias("offset"), "k"))
    compared = through_storage(parts.join(chosen, ["core", "part", "gram", "content", "offset"])
                               .dropDuplicates(["core", "part"]).select("core", "part", "starts", "core_at", "data", "k"), "compared-parts")
    marks = (_by_suffix_array(compared.where(F.col("k") <= SEGMENTS), length).unionByName(twice)
             .unionByName(_by_counting(compared.where(F.col("k") > SEGMENTS), length)))
    placed = (parts.select("core", "part", "gram", "content", "offset").join(marks, ["core", "part"])
              .select("gram", "content", (F.col("offset") + F.col("a")).alias("a"), (F.col("offset") + F.col("b")).alias("b")).distinct())
    placed = through_storage(placed, "repeats-of-segments")
    some = shared.join(placed, ["gram", "content"]).select("node", "node2", (F.col("lo") + F.col("a")).alias("start"),
                                                           (F.col("lo") + F.col("b") - 1 + length).alias("end"))
    return through_storage(whole.unionByName(some).distinct(), "repeat-spans")


def _coded(docs: DataFrame) -> DataFrame:
    """``docs`` with the 64-bit hashes of the words, one behind the other, as text."""
    columns, at = docs.columns, docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                codes = [b"".join(xxhash.xxh3_64_digest(w) for w in (x or b"").split()) for x in part.column(at).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()) if i == at else c for i, c in enumerate(part.columns)], names=columns)

    return docs.mapInArrow(work, T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in docs.schema.fields]))


def word_spans(docs: DataFrame, n_words: int) -> DataFrame:
    """(node, node2, start, end): numbers of the words covered by passages of ``n_words`` words that occur more than once."""
    length = n_words * CODE
    found = repeat_spans(docs, length, _coded)
    # Only strings that begin with a whole code are passages.
    first, last = F.ceil(F.col("start") / CODE), F.floor((F.col("end") - length) / CODE)
    return (found.select("node", "node2", first.cast("int").alias("start"), (last + n_words).cast("int").alias("end"))
            .where(F.col("end") - F.col("start") >= n_words))


_CUT_ARROW = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_text", pa.string())])


def without_repeats(docs: DataFrame, keep: list[str], with_text: bool = False, length: int = LENGTH, n_words: int | None = None) -> DataFrame:
    """``keep`` columns as struct ``d``, n_bytes, n_removed, n_spans and the kept bytes of every row.

    Needs doc_id and text.  Strings of ``length`` bytes that repeat go, and with ``n_words`` also passages
    of so many words, whatever their bytes and the white space between the words.  NULL text counts as empty and
    texts below these sizes keep all; a
    NULL doc_id is a value like others; repeated rows are copies of each other, so all of
    them lose their repeated bytes; extra columns may have any name; an empty table gives an empty result.
    Strings are judged on the input as it is.  ``with_text`` adds kept_text (NULL where the
    text was NULL): characters cut by a removal are left out.
    """
    text = F.col("text").cast("string")
    tagged = docs.select(F.xxhash64(F.lit(1), F.col("doc_id"), text).alias("node"), F.hash(F.lit(2), F.col("doc_id"), text).alias("node2"),
                         text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("d"))
    texts = tagged.select("node", "node2", "text")
    spans = repeat_spans(texts, length).withColumn("of_words", F.lit(False))
    if n_words:
        spans = spans.unionByName(word_spans(texts, n_words).withColumn("of_words", F.lit(True)))
    per_text = spans.groupBy("node", "node2").agg(F.collect_list(F.struct("start", "end", "of_words")).alias("spans"))  # spans of one text
    rows = tagged.join(per_text, ["node", "node2"], "left").select("d", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 500):
                batch, out = big.slice(k, 500), []
                texts = batch.column(1).cast(pa.large_binary()).to_pylist()
                for data, found in zip(texts, batch.column(2).to_pylist()):
                    kept, removed, n = _kept(data or b"", _in_bytes(data or b"", found or []))
                    as_text = kept.decode("utf-8", "ignore") if with_text and data is not None else None
                    out.append({"n_bytes": len(data or b""), "n_removed": removed, "n_spans": n, "kept": None if with_text else kept,
                                "kept_text": as_text})
                done = pa.RecordBatch.from_pylist(out, schema=_CUT_ARROW)
                yield pa.RecordBatch.from_arrays([batch.column(0), *done.columns], names=["d", *_CUT_ARROW.names])

    added = "n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"
    schema = docs.sparkSession.createDataFrame([], added).schema
    full = rows.select("d").schema.add(schema[0])
    for field in schema.fields[1:]:
        full = full.add(field)
    return rows.mapInArrow(cut, full)


def _in_bytes(data: bytes, spans: list[dict]) -> list[dict]:
    """The spans with those counted in words as bytes: from the first byte of their first word to the last of their last."""
    if not any(s["of_words"] for s in spans):
        return spans
    places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    return [{"start": places[s["start"]][0], "end": places[s["end"] - 1][1]} if s["of_words"] else s for s in spans]


def _kept(data: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    """(bytes outside the spans, number of bytes inside, number of maximal runs)."""
    parts, at, removed, runs, until = [], 0, 0, 0, -1
    for s in sorted((s["start"], s["end"]) for s in spans):
        if s[0] > until:
            runs += 1
            parts.append(data[at:s[0]])
            removed, until, at = removed + s[1] - s[0], s[1], s[1]
        elif s[1] > until:
            removed, until, at = removed + s[1] - until, s[1], s[1]
    parts.append(data[at:])
    return b"".join(parts), removed, runs
