"""Byte-level BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Frequent words are counted over all documents, encoded once, and compiled into a minimal
acyclic automaton: equal suffixes share their states, and the numbers on the arcs of a path
add up to the word's place in a table of ids.  The file is sent to every executor, where all
Python workers map the same pages into memory.  Words outside the lexicon are merged pair
by pair, exactly as the merge list says.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.columns import free_name
from sievework.llm.store import open_store
from sievework.llm.units import UnitEncoder, pieces
from sievework.session import scratch_path, through_storage

#: Words of the lexicon; it stays below a few MB whatever the corpus.
LEXICON_WORDS = 65_536
#: Units and pre-tokens whose ids a worker remembers besides the lexicon.
MEMO_UNITS = 80_000
MEMO_PIECES = 50_000
#: Longer pre-tokens are merged with a heap.
HEAP_FROM = 64

# The white space of Unicode, and the pre-token pattern of byte-level BPE vocabularies.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return out | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """The merges and token bytes of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.token_bytes: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.rank = {pair: r for pair, (r, _) in self.merge.items()}
        self.made = {r: new for r, new in self.merge.values()}
        self.no_rank = len(spec["model"]["merges"])
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = added
        self.token_bytes |= {i: t.encode() for t, i in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pre_token = regex.compile(PRE_TOKEN)
        self.memo: dict[str, list[int]] = {}

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank, leftmost first, is merged until none is left."""
        ids = [self.first[b] for b in word]
        if len(ids) > HEAP_FROM:
            return self._merged_by_heap(ids)
        # Only the two pairs beside a merge change, so ranks are looked up once and kept.
        rank, none = self.rank.get, self.no_rank
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            k = ranks.index(least)
            ids[k:k + 2] = [self.made[least]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), none)
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), none)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n and (m := self.merge.get((ids[k], ids[after[k]]))) is not None:
                heapq.heappush(heap, (m[0], k, m[1], ids[k], ids[after[k]]))

        for k in range(n):
            offer(k)
        while heap:
            _, k, new, left, right = heapq.heappop(heap)
            j = after[k]
            if not alive[k] or j >= n or ids[k] != left or ids[j] != right:
                continue
            ids[k], alive[j], after[k] = new, False, after[j]
            if after[j] < n:
                before[after[j]] = k
            offer(before[k])
            offer(k)
        return [x for x, a in zip(ids, alive) if a]

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens become their ids."""
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            for piece in self.pre_token.findall(part):
                ids = self.memo.get(piece)
                if ids is None:
                    if len(self.memo) >= MEMO_PIECES:
                        self.memo.clear()
                    ids = self.memo[piece] = self.merged(piece.encode())
                out += ids
        return out


# --- the lexicon -------------------------------------------------------------------------

_LEXICON_HEAD = struct.Struct("<8sqqqq")
_MAGIC = b"SWLEX1\0\0"


class _Builder:
    """Minimal automaton of words added in ascending order of bytes: finished suffixes are looked up and shared."""

    def __init__(self):
        self.arcs: list[list[tuple[int, int]]] = [[]]
        self.final = [False]
        self.seen: dict[tuple, int] = {}
        self.path = [0]
        self.word = b""

    def add(self, word: bytes) -> None:
        common = 0
        while common < min(len(word), len(self.word)) and word[common] == self.word[common]:
            common += 1
        self._finish(common)
        for b in word[common:]:
            self.arcs.append([])
            self.final.append(False)
            self.arcs[self.path[-1]].append((b, len(self.arcs) - 1))
            self.path.append(len(self.arcs) - 1)
        self.final[self.path[-1]] = True
        self.word = word

    def _finish(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self.path.pop()
            key = (self.final[state], tuple(self.arcs[state]))
            same = self.seen.setdefault(key, state)
            if same != state:
                b, _ = self.arcs[self.path[-1]][-1]
                self.arcs[self.path[-1]][-1] = (b, same)

    def close(self) -> None:
        self._finish(0)


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of a lexicon: header, arc keys (state * 256 + byte), arc targets, arc numbers, final flags, id offsets, ids."""
    entries = sorted(entries)
    build = _Builder()
    for word, _ in entries:
        build.add(word)
    build.close()
    order, number = [0], {0: 0}  # states in the order of their first visit
    for s in order:
        for _, t in build.arcs[s]:
            if t not in number:
                number[t] = len(order)
                order.append(t)
    counts: dict[int, int] = {}

    def count(s: int) -> int:  # words that can be completed from s
        stack = [s]
        while stack:
            at = stack[-1]
            open_arcs = [t for _, t in build.arcs[at] if t not in counts]
            if open_arcs:
                stack += open_arcs
            else:
                counts[at] = build.final[at] + sum(counts[t] for _, t in build.arcs[at])
                stack.pop()
        return counts[s]

    count(0)
    keys, targets, numbers = [], [], []
    for s in order:
        passed = int(build.final[s])
        for b, t in build.arcs[s]:
            keys.append(number[s] * 256 + b)
            targets.append(number[t])
            numbers.append(passed)
            passed += counts[t]
    ids = [np.array(i, dtype="<u4") for _, i in entries]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]) if ids else np.zeros(1)
    flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
    finals = np.array([build.final[s] for s in order], dtype="<i8")
    return b"".join([_LEXICON_HEAD.pack(_MAGIC, len(keys), len(order), len(entries), len(flat)),
                     np.array(keys, "<i8").tobytes(), np.array(targets, "<i8").tobytes(), np.array(numbers, "<i8").tobytes(),
                     finals.tobytes(), offsets.astype("<i8").tobytes(), flat.tobytes()])


class Lexicon:
    """A lexicon file mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype=np.uint8, mode="r")
        magic, arcs, states, words, ids = _LEXICON_HEAD.unpack(bytes(data[:_LEXICON_HEAD.size]))
        if magic != _MAGIC:
            raise ValueError("not a lexicon")
        at = _LEXICON_HEAD.size

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = data[at:at + n * np.dtype(kind).itemsize].view(kind)
            at += n * np.dtype(kind).itemsize
            return out

        self.keys, self.targets, self.numbers = take(arcs, "<i8"), take(arcs, "<i8"), take(arcs, "<i8")
        self.final, self.offsets, self.ids = take(states, "<i8"), take(words + 1, "<i8"), take(ids, "<u4")

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, or -1; all words walk through the automaton together, one byte at a time."""
        found = np.full(len(words), -1, dtype=np.int64)
        if not words or not len(self.keys):
            return found
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        start = np.cumsum(length) - length
        state, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at, depth = np.flatnonzero(length > 0), 0
        while len(at):
            key = state[at] * 256 + data[start[at] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            at, arc = at[ok], arc[ok]
            state[at] = self.targets[arc]
            place[at] += self.numbers[arc]
            depth += 1
            ended = length[at] == depth
            done = at[ended]
            done = done[self.final[state[done]] == 1]
            found[done] = place[done]
            at = at[~ended]
        return found

    def ids_at(self, place: int) -> np.ndarray:
        return self.ids[self.offsets[place]:self.offsets[place + 1]]


# --- on Spark ----------------------------------------------------------------------------


def frequent_words(docs: DataFrame, text: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """Space-led words, counted over all whole texts: all above the lowest count that leaves at most ``limit`` of them.

    Counts are compared by their logarithm in steps of a sixteenth, so that at most a thousand
    numbers and then the words themselves come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                words = pc.list_flatten(pc.split_pattern(batch.column(0).slice(start, 1000), " "))
                yield pa.RecordBatch.from_arrays(pc.value_counts(words).flatten(), names=["word", "n"])

    # Texts are counted where they are read; what is shuffled are different words of some texts.
    counted = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).mapInArrow(count, "word string, n long")
    counts = counted.groupBy("word").agg(F.sum("n").alias("n"))
    usable = counts.where(r"n > 1 and word <> '' and octet_length(word) <= 64 and not word rlike '[\\x00-\\x20]'")
    stored = through_storage(usable.select("word", F.floor(F.log2("n") * 16).cast("int").alias("step")), "word-counts")
    room, least = limit, None
    for r in sorted(stored.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r["n"]
        if room < 0:
            break
        least = r["step"]
    if least is None:
        return []
    return sorted(" " + r["word"] for r in stored.where(F.col("step") >= least).select("word").collect())  # at most ``limit``


def build_lexicon(spark: SparkSession, words: list[str], tokenizer_path: str) -> str:
    """Compile words with their ids, store the file in the shared folder and send it to the executors; returns its name."""
    model = ByteBpe(tokenizer_path)
    data = compile_lexicon({w.encode(): model.encode(w) for w in words}.items())
    uri = scratch_path(spark, "lexicon")
    fs, path = open_store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(data)
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


_WORKERS: dict[tuple[str, str], tuple[ByteBpe, UnitEncoder]] = {}


def _worker(tokenizer_path: str, lexicon: str) -> tuple[ByteBpe, UnitEncoder]:
    """Model and unit encoder of this Python worker, made once."""
    if (tokenizer_path, lexicon) not in _WORKERS:
        from pyspark import SparkFiles
        model, known = ByteBpe(tokenizer_path), Lexicon(SparkFiles.get(lexicon))

        def encode(units: list[str]) -> list[np.ndarray]:
            places = known.find([u.encode() for u in units]).tolist()
            return [known.ids_at(p) if p >= 0 else np.array(model.encode(u), dtype=np.uint32) for u, p in zip(units, places)]

        _WORKERS.clear()
        _WORKERS[tokenizer_path, lexicon] = model, UnitEncoder(encode, MEMO_UNITS)
    return _WORKERS[tokenizer_path, lexicon]


def encode_documents(docs: DataFrame, tokenizer_path: str, lexicon: str | None = None, text: str = "text",
                     keep: tuple[str, ...] = ("doc_id",), ids_name: str = "ids") -> DataFrame:
    """``keep`` columns and the ids of every whole text, as little-endian unsigned 32-bit numbers in one binary value.

    NULL and empty texts have no ids; repeated rows and ids and NULLs in other columns pass through;
    the names in ``keep`` and ``ids_name`` must differ.  Texts of any length are encoded
    whole, in slices cut where no pre-token can cross.  An empty table gives an empty result.
    ``lexicon`` is the name returned by ``build_lexicon``; by default it is made from ``docs``.
    """
    spark = docs.sparkSession
    lexicon = lexicon or build_lexicon(spark, frequent_words(docs, text), tokenizer_path)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(ids_name))
    n_keep = len(keep)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, units = _worker(tokenizer_path, lexicon)
        for batch in batches:
            column = batch.column(n_keep)
            for start in range(0, max(1, batch.num_rows), 1000):
                part = batch.slice(start, 1000)
                texts = [x or b"" for x in column.slice(start, 1000).cast(pa.large_binary()).to_pylist()]
                packed = [b""] * len(texts)
                for group in pieces(texts):
                    ids, counts = units.ids_of([p for _, p in group])
                    ends = np.cumsum(counts)
                    for (row, _), a, b in zip(group, (ends - counts).tolist(), ends.tolist()):
                        packed[row] += ids[a:b].astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], pa.array(packed, pa.binary())],
                                                 names=[*keep, ids_name])

    schema = source.select(*[F.col(f"`{c}`") for c in keep], F.lit(b"").alias(ids_name)).schema
    return source.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds ``text``: the bytes of the tokens as UTF-8; bytes that are no UTF-8 become U+FFFD.  Special tokens are kept."""
    name = free_name(encoded, text)
    n_columns, at = len(encoded.columns), encoded.columns.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_table(tokenizer_path)
        for batch in batches:
            out = []
            for packed in batch.column(at).to_pylist():
                out.append(_decoded(packed or b"", table))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             names=[f"c{i}" for i in range(n_columns)] + ["text"])

    shaped = encoded.toDF(*[f"c{i}" for i in range(n_columns)])
    schema = shaped.withColumn("text", F.lit("")).schema
    return shaped.mapInArrow(decode, schema).toDF(*encoded.columns, name)


_TABLES: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if path not in _TABLES:
        tokens = ByteBpe(path).token_bytes
        every = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        size = np.array([len(t) for t in every], dtype=np.int64)
        _TABLES[path] = np.frombuffer(b"".join(every), np.uint8), np.cumsum(size) - size, size
    return _TABLES[path]


def _decoded(packed: bytes, table: tuple[np.ndarray, np.ndarray, np.ndarray], step: int = 1 << 18) -> str:
    data, first, size = table
    ids, parts = np.frombuffer(packed, "<u4"), []
    for k in range(0, len(ids), step):
        some = ids[k:k + step]
        n = size[some]
        until = np.cumsum(n)
        parts.append(data[np.repeat(first[some] - (until - n), n) + np.arange(int(until[-1]))].tobytes())
    return b"".join(parts).decode("utf-8", "replace")
