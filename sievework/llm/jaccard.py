"""Exact self-join of five-word shingle sets at a Jaccard similarity of 75 %, by PartEnum signatures.

Sizes fall into bands (powers of two).  A band partitions the domain of shingle hashes; the
signature of a partition is a hash of the shingles of the set in it.  Two sets of a band
that reach the threshold differ in few shingles, hence in few partitions: with at most k
partitions that differ, the k + 1 smallest signatures of either set contain one that both share
(a set whose size lets it meet the next band enumerates the partitions of that band, too).
Any order of the signatures will do, as long as all sets use the same: rare ones come first.

All signatures of all sets are counted once, in ranges of their hashes: tasks write them as packed
blocks, a range is sorted as one array, and only signatures that at least two sets have go
back to their blocks.  A set with more than k signatures of its own meets no other and is done with;
that is most sets of most tables.  The others keep their k + 1 rarest signatures, less those of their own.

Sets that share one of these are compared: all pairs of a small group at once, a larger group with one
centre at a time and only across components not yet joined, so a large group of near copies
costs a comparison per member and not one per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.components import connected_components
from sievework.llm.scratch import Scratch
from sievework.llm.units import pieces
from sievework.session import through_storage

WORDS = 5
#: Sets below this size have one partition per shingle; from here on bands double.
FIRST_BAND = 64
#: Shingles per partition of the largest sets of a band; fewer if some set fills too few partitions.
FILL = 1.9
#: Larger groups of a signature are compared with one centre first.
FREQUENT = 16
#: Groups with more pairs than this go on with one centre after the first round, too, and most rounds of that.
CROWD, STAR_ROUNDS = 1 << 22, 6
#: Signatures in a packed block, and sets and bands in it, which are numbered in 16 bits.
BLOCK, BLOCK_ROWS = 1 << 20, 60_000
#: Bytes of text whose signatures are sorted as one range; a signature is known by its range and 32 further bits.
RANGE_TEXT = 1 << 23
#: Bits that tell tasks which texts may be wanted.
MET_BITS = 1 << 23
#: Ranges of signatures, and sets to be compared, are shuffled in so many slices, one after the other, which bounds the disk that they take.
SLICES = 4
#: Shingles that need no slice of their own: small tables take fewer slices, as every slice costs the start of its jobs.
SLICE_SHINGLES = 1 << 24

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACES = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every bit of the input changes half of the output."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of all texts, number of words of each), A-Z in lower case."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1))  # starts and ends take turns
    starts, ends = edge[0::2], edge[1::2]
    power = np.full(len(data), _STEP, dtype=np.uint64)
    back = np.full(len(data), _STEP_BACK, dtype=np.uint64)
    power[0] = back[0] = 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    limits = np.cumsum(lengths + 1)
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    return hashes, counts


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than five words are one shingle, no words none."""
    held: list[np.ndarray] = []
    at = 0
    for group in pieces(texts):
        hashes, counts = word_hashes([p for _, p in group])
        ends = np.cumsum(counts)
        for (row, _), a, b in zip(group, (ends - counts).tolist(), ends.tolist()):
            if row != at:
                yield _set_of(held)
                held, at = [], row
            held.append(hashes[a:b])
    if texts:
        yield _set_of(held)


def _set_of(parts: list[np.ndarray]) -> np.ndarray:
    w = parts[0] if len(parts) == 1 else np.concatenate(parts)
    n = len(w)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < WORDS:
        whole = np.uint64(n)
        with np.errstate(over="ignore"):
            for k in range(n):
                whole = mixed(np.array([whole * _STEP + w[k]], dtype=np.uint64))[0]
        return np.array([whole], dtype=np.uint64)
    s = w[:n - 4] * _PLACES[0]
    for k in range(1, WORDS):
        s = s + w[k:n - 4 + k] * _PLACES[k]
    return np.unique(mixed(s))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the set."""
    a, b = (mixed(s ^ c).sum(dtype=np.uint64) for c in (np.uint64(0x1234567), np.uint64(0xABCDEF0123)))
    return int(a.view(np.int64)), int(b.view(np.int64))


def parities(s: np.ndarray) -> bytes:
    """Whether an odd number of hashes fall into each of 2^i classes, at least two per hash and 64: sets differ in no fewer hashes than in classes."""
    classes = 1 << max(6, (2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8) & 1, bitorder="little").tobytes()


class Parities:
    """``parities`` of many sets, to find pairs that cannot reach the threshold."""

    def __init__(self, held: list[bytes]):
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        self.kind, self.row, self.tables = np.log2(np.maximum(lengths, 1)).astype(np.int64), np.zeros(len(held), np.int64), {}
        for kind in np.unique(self.kind).tolist():
            of = np.flatnonzero(self.kind == kind)
            self.row[of] = np.arange(len(of))
            self.tables[kind, kind] = np.frombuffer(b"".join([held[x] for x in of]), "<u8").reshape(len(of), -1)

    def _table(self, kind: int, to: int) -> np.ndarray:
        """The sets of a kind with the classes of a smaller one: halves are added up."""
        if (kind, to) not in self.tables:
            wide = self._table(kind, to + 1)
            half = wide.shape[1] // 2
            self.tables[kind, to] = wide[:, :half] ^ wide[:, half:]
        return self.tables[kind, to]

    def near(self, i: np.ndarray, j: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Whether sets i and j, of ``total`` hashes together, may differ in a seventh of these or less."""
        out = np.ones(len(i), bool)
        both = self.kind[i] << 8 | self.kind[j]
        for kinds in np.unique(both).tolist():
            x, y = kinds >> 8, kinds & 255
            a, b, of = self._table(x, min(x, y)), self._table(y, min(x, y)), np.flatnonzero(both == kinds)
            step = max(1, (1 << 20) // a.shape[1])
            for k in range(0, len(of), step):
                at = of[k:k + step]
                out[at] = 7 * np.bitwise_count(a[self.row[i[at]]] ^ b[self.row[j[at]]]).sum(axis=1, dtype=np.int64) <= total[at]
        return out


def _band(n: int) -> int:
    return 0 if n < FIRST_BAND else (n // FIRST_BAND).bit_length()


def _ordered(x: np.ndarray) -> np.ndarray:
    """Ascending as signed numbers, which is how Spark orders them."""
    return np.sort(x.view(np.int64)).view(np.uint64)


def _band_signatures(s: np.ndarray, band: int, fill: float) -> np.ndarray:
    """Signatures of the occupied partitions of a band, in ascending order."""
    if band == 0:
        return _ordered(mixed(s ^ _STEP))
    partitions = np.uint64(max(1, int(FIRST_BAND * 2**band / fill)))
    part = ((s >> np.uint64(32)) * partitions) >> np.uint64(32)  # ascending, as s is
    first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
    content = np.add.reduceat(mixed(s), first)
    return _ordered(mixed(content + mixed(part[first] * np.uint64(64) + np.uint64(band))))


def signatures(s: np.ndarray, fill: float = FILL) -> list[tuple[np.ndarray, int]]:
    """(all signatures, k) for each band in which the set can meet others; k partitions differ at most.

    Sizes a and b at 75 % differ in (a + b) / 7 shingles at most, and b <= a * 4 / 3.
    """
    n = len(s)
    if n == 0:
        return []
    band, most = _band(n), n * 4 // 3
    top = FIRST_BAND * 2**band - 1
    out = [(_band_signatures(s, band, fill), (n + min(top, most)) // 7)]
    if most > top:
        out.append((_band_signatures(s, band + 1, fill), (n + most) // 7))
    return out


_FACTS = ("node long, doc_id long, n long, fp1 long, fp2 long, bits binary, sizes array<int>, most array<int>, short boolean, th long, th2 int, "
          "block long, place int, sig int, packed binary")


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Some rows of (node, doc_id, text, ...) at a time, with their shingle sets."""
    for big in batches:
        for start in range(0, big.num_rows, 500):
            batch = big.slice(start, 500)
            yield batch, list(shingle_sets([x or b"" for x in batch.column(2).cast(pa.large_binary()).to_pylist()]))


def _facts(docs: DataFrame, fill: float, bits: int) -> DataFrame:
    """A row of measures for every row of (node, doc_id, text, th, th2), and the signatures of all rows in packed blocks.

    Measures: size, fingerprint, parities; numbers of signatures and of partitions that differ at most, per band; the block that
    holds the signatures, and the first of the row's places in it.  The other rows have ``sig``, a range of 2^bits, and the signatures of a block
    in it, packed: 32 bits of each, then the place of each in 16 bits.
    """
    names = [x.split()[0] for x in _FACTS.split(", ")]
    types = {"doc_id": pa.int64(), "bits": pa.binary(), "sizes": pa.list_(pa.int32()), "most": pa.list_(pa.int32()), "short": pa.bool_(), "th2": pa.int32(),
             "place": pa.int32(), "sig": pa.int32(), "packed": pa.binary()}

    def rows(n_rows: int, /, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(x, pa.nulls(n_rows, types.get(x, pa.int64()))) for x in names], names=names)

    def packed(block: int, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sigs = np.concatenate(found) if found else np.empty(0, np.uint64)
        part = (sigs >> np.uint64(64 - bits)).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        low = (sigs >> np.uint64(32 - bits)).astype("<u4")[order]
        place = np.repeat(np.arange(len(found), dtype="<u2"), [len(x) for x in found])[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=1 << bits))])
        held = np.flatnonzero(np.diff(ends))
        if len(held):
            parts = [low[ends[x]:ends[x + 1]].tobytes() + place[ends[x]:ends[x + 1]].tobytes() for x in held]
            yield rows(len(held), block=pa.array(np.full(len(held), block)), sig=pa.array(held, pa.int32()), packed=pa.array(parts, pa.binary()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, found, held = None, [], 0
        for batch, sets in _texts(batches):
            if block is None:
                block = batch.column(0)[0].as_py()
            prints, bits_, sizes, most, places = [], [], [], [], []
            for s in sets:
                places.append(len(found))
                prints.append(fingerprint(s))
                bits_.append(parities(s))
                own = signatures(s, fill)
                found += [x for x, _ in own]
                sizes.append(np.array([len(x) for x, _ in own], np.int32))
                most.append(np.array([k for _, k in own], np.int32))
            held += sum(int(x.sum()) for x in sizes)
            yield rows(len(sets), node=batch.column(0), doc_id=batch.column(1), th=batch.column(3), th2=batch.column(4),
                       n=pa.array([len(s) for s in sets], pa.int64()), fp1=pa.array([x for x, _ in prints], pa.int64()), fp2=pa.array([x for _, x in prints], pa.int64()),
                       bits=pa.array(bits_, pa.binary()), sizes=_lists(sizes, pa.int32()), most=_lists(most, pa.int32()),
                       short=pa.array([bool((x <= k).any()) for x, k in zip(sizes, most)]), block=pa.array([block] * len(sets), pa.int64()), place=pa.array(places, pa.int32()))
            if held >= BLOCK or len(found) >= BLOCK_ROWS:
                yield from packed(block, found)
                block, found, held = None, [], 0
        if block is not None:
            yield from packed(block, found)

    return docs.select("node", "doc_id", "text", "th", "th2").mapInArrow(work, _FACTS)


def _sets(docs: DataFrame) -> DataFrame:
    """(node, items): the shingle hashes of every row of (node, doc_id, text)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _texts(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["node", "items"])
    return docs.select("node", "doc_id", "text").mapInArrow(work, "node long, items binary")


def _unpacked(blobs: pa.ChunkedArray, *kinds: str) -> list[np.ndarray]:
    """The columns of packed rows, one after the other; and the number of entries of each row."""
    width, columns, counts = sum(np.dtype(x).itemsize for x in kinds), [[] for _ in kinds], []
    for blob in blobs:
        buffer = blob.as_buffer()
        counts.append(buffer.size // width)
        at = 0
        for column, kind in zip(columns, kinds):
            column.append(np.frombuffer(buffer, kind, counts[-1], at))
            at += column[-1].nbytes
    return [*(np.concatenate(x) if x else np.empty(0, k) for x, k in zip(columns, kinds)), np.array(counts, np.int64)]


def _shared(blocks: DataFrame) -> DataFrame:
    """Of packed signatures those that occur more than once: 32 bits, place, and the logarithm of how often, rounded up."""
    def work(table: pa.Table) -> pa.Table:
        low, place, counts = _unpacked(table["packed"], "<u4", "<u2")
        order = np.sort((low.astype(np.uint64) << np.uint64(32)) | np.arange(len(low), dtype=np.uint64))
        at, value = (order & np.uint64(0xFFFFFFFF)).astype(np.int64), order >> np.uint64(32)
        first = np.flatnonzero(np.diff(value, prepend=value[:1] + np.uint64(1)))
        often = np.diff(first, append=len(value))
        grade = np.zeros(len(low), np.uint8)
        grade[at] = np.repeat(np.ceil(np.log2(often)).astype(np.uint8), often)
        out, ends = [], np.concatenate([[0], np.cumsum(counts)])
        for a, b in zip(ends[:-1], ends[1:]):
            keep = np.flatnonzero(grade[a:b]) + a
            out.append(low[keep].tobytes() + place[keep].tobytes() + grade[keep].tobytes())
        return pa.table({"block": table["block"], "sig": table["sig"], "packed": pa.array(out, pa.binary())})
    return blocks.groupBy("sig").applyInArrow(work, "block long, sig int, packed binary")


def _first(facts: DataFrame, shared: DataFrame) -> DataFrame:
    """(node, sig, n, own): of each set and band the first k + 1 signatures, rare ones first, without those that no other set has.

    ``own`` is the share of these, in 255ths: the less of it a set has, the more of it others have, too.
    """
    def work(sets: pa.Table, packed: pa.Table) -> pa.Table:
        low, place, grade, counts = _unpacked(packed["packed"], "<u4", "<u2", "u1")
        sig = np.repeat(packed["sig"].to_numpy().astype(np.int64), counts) << 32 | low.astype(np.int64)
        bands = pc.list_value_length(sets["most"]).to_numpy().astype(np.int64)
        start = np.repeat(sets["place"].to_numpy().astype(np.int64), bands)
        where = start + np.arange(len(start)) - np.repeat(np.cumsum(bands) - bands, bands)
        room = np.zeros(max(int(where.max(initial=0)), int(place.max(initial=0))) + 1, np.int64)  # of sets that are not asked for: none
        node, size, share = room.copy(), room.copy(), room.copy()
        node[where], size[where] = np.repeat(sets["node"].to_numpy(), bands), np.repeat(sets["n"].to_numpy(), bands)
        own = pc.list_flatten(sets["sizes"]).to_numpy() - np.bincount(place, minlength=len(room))[where]
        first = pc.list_flatten(sets["most"]).to_numpy() + 1
        room[where], share[where] = first - own, 255 * own // np.maximum(first, 1)
        keep = room[place] > 0
        sig, place, grade = sig[keep], place[keep].astype(np.int64), grade[keep]
        order = np.lexsort((sig, place << 8 | grade))
        sig, place = sig[order], place[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        keep = rank < room[place]
        return pa.table({"node": node[place[keep]], "sig": sig[keep], "n": size[place[keep]], "own": share[place[keep]]})
    asked = facts.select("block", "node", "n", "place", "sizes", "most").groupBy("block")
    return asked.cogroup(shared.groupBy("block")).applyInArrow(work, "node long, sig long, n long, own long")


def _candidates(rows: DataFrame, last: bool) -> DataFrame:
    """Pairs (a, b) to be compared of the rows (node, sig, n, comp, before, order, bits), and rows to go on with (sig is not NULL; a is the node).

    Small groups of a signature give all pairs of different components that may reach the threshold by their sizes.  Others meet one centre, the first in
    ``order``, and are gone on with: then (``before`` is their number of components, and there are ``bits``) all pairs are taken that may reach it by their
    parities, too, unless the group is a crowd and its last centre joined something.  In the ``last`` round crowds give all such pairs.
    """
    def pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return rest(both[:, 0], both[:, 1], None, None, None)

    def rest(a, b, sig, n, before) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()) if x is None else pa.array(x, pa.int64()) for x in (a, b, sig, n, before)],
                                          names=["a", "b", "sig", "n", "before"])

    def groups(sig, node, n, comp, before, bits) -> Iterator[pa.RecordBatch]:
        """The rows of whole groups, in order of their signatures; the first row of each is its centre."""
        first = np.flatnonzero(np.diff(sig, prepend=sig[:1] - 1))
        size = np.diff(first, append=len(sig))
        of = np.repeat(np.arange(len(first)), size)
        order = np.lexsort((comp, of))
        parts = np.flatnonzero((np.diff(of[order], prepend=-1) != 0) | (np.diff(comp[order], prepend=-1) != 0))
        members = np.diff(parts, append=len(sig))
        n_parts = np.bincount(of[order][parts], minlength=len(first))
        cross = (size * size - np.bincount(of[order][parts], members * members, minlength=len(first)).astype(np.int64)) // 2
        again = before[first] > 0
        whole = (n_parts > 1) & ((cross <= FREQUENT * FREQUENT // 2) | last | again & ((cross <= CROWD) | (n_parts >= before[first])))
        star = (n_parts > 1) & ~whole
        can = lambda i, j: (comp[i] != comp[j]) & (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j]))
        i = np.flatnonzero(star[of])
        if len(i):
            yield rest(node[i], None, sig[i], n[i], n_parts[of[i]])
            j = first[of[i]]
            met = can(i, j)
            yield pairs(node[i[met]], node[j[met]])
        i, out, held, lag, end = np.flatnonzero(whole[of]), [], 0, 0, np.repeat(first + size, size)
        known = Parities(bits.tolist()) if len(i) and before[0] > 0 else None
        while len(i):
            lag += 1
            i = i[i + lag < end[i]]
            met = i[can(i, i + lag)]
            if known is not None:
                met = met[known.near(met, met + lag, n[met] + n[met + lag])]
            out.append((node[met], node[met + lag]))
            held += len(met)
            if held > 1 << 20 or not len(i):
                yield pairs(*map(np.concatenate, zip(*out)))
                out, held = [], 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            kept = now if kept is None else [np.concatenate(x) for x in zip(kept, now)]
            end = int(np.searchsorted(kept[0], kept[0][-1]))  # the last group may go on
            if end >= 1 << 16 or end and len(kept[0]) - end > end:
                yield from groups(*(x[:end] for x in kept))
                kept = [x[end:] for x in kept]
        if kept is not None:
            yield from groups(*kept)

    placed = rows.repartition("sig").sortWithinPartitions("sig", "order", "node").select("sig", "node", "n", "comp", "before", "bits")
    return placed.mapInArrow(work, "a long, b long, sig long, n long, before long")


def _slice(column: str, k: int, of: int) -> Column:
    """Rows of the k-th slice by the hash of a column."""
    return F.lit(True) if of == 1 else F.pmod(F.xxhash64(column), F.lit(of)) == k


def _near(pairs: DataFrame) -> DataFrame:
    """Pairs whose parities allow the threshold."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                known, i = Parities(batch.column(0).to_pylist() + batch.column(1).to_pylist()), np.arange(batch.num_rows)
                batch = batch.filter(pa.array(known.near(i, i + batch.num_rows, batch.column(2).to_numpy())))
            yield pa.RecordBatch.from_arrays(batch.columns[2:], names=["total", "a", "b"])
    return pairs.select("bits_a", "bits_b", "total", "a", "b").mapInArrow(work, "total long, a long, b long")


def _with_hashes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` that may have a th of ``wanted``: those of equal last bits."""
    words = wanted.select(F.col("th").bitwiseAND(F.lit((MET_BITS >> 6) - 1)).alias("w"), F.expr("shiftleft(1L, cast(shiftrightunsigned(th, 58) as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(MET_BITS >> 6, np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th = batch.column(0).to_numpy()
            met = table[th & (len(table) - 1)].view(np.uint64) >> (th.view(np.uint64) >> np.uint64(58)) & np.uint64(1)
            yield batch.filter(pa.array(met.astype(bool)))

    return docs.mapInArrow(work, docs.schema)


def _similar(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with set_a and set_b that reach the threshold, by the exact intersection."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                keep.append(100 * both >= 75 * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])
    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(work, "a long, b long")


class _Join:
    """The state of one self-join: facts of all rows, equal sets, components found, pairs already compared."""

    def __init__(self, docs: DataFrame):
        text = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        self.bits = min(16, max(4, (text // RANGE_TEXT).bit_length()))
        docs = docs.withColumns({"th": F.xxhash64("text"), "th2": F.hash("text")})
        self.docs, self.fill, self.scratch = docs, FILL, Scratch(docs.sparkSession)
        while True:
            stored = self.scratch.store(_facts(docs, self.fill, self.bits), "set-facts", replace=True)
            rows = stored.where("sig is null")
            self.n_rows, self.shingles, short = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("short"), F.lit(False))).first()
            if not short:
                break
            self.fill /= 2  # a set fills too few partitions: halve the partitions' size
            if self.fill < 0.01:
                raise RuntimeError("shingle hashes are not spread evenly")
        self.slices = max(1, min(SLICES, -(-self.shingles // SLICE_SHINGLES)))
        self.blocks = stored.where("sig is not null").select("block", "sig", "packed")
        self.facts = self.scratch.store(rows.drop("short", "sig", "packed"), "facts")
        light = self.facts.where("n > 0").select("node", "n", "fp1", "fp2")
        groups = light.groupBy("n", "fp1", "fp2").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1")
        self.copies = self.scratch.store(light.join(groups, ["n", "fp1", "fp2"]).where("node <> b")
                                         .select(F.col("node").alias("a"), "b"), "equal-sets")
        self.known = self.sets = self.tested = self.roots = None

    def first_signatures(self) -> DataFrame:
        """(node, sig, n): what is left of the first signatures of each set; of equal sets those of one."""
        shared = None
        for k in range(self.slices):
            part = self.scratch.store(_shared(self.blocks.where(_slice("sig", k, self.slices))), "shared")
            shared = part if shared is None else shared.unionByName(part)
        self.scratch.drop("set-facts")
        asked = self.facts.where("n > 0").join(self.copies.select(F.col("a").alias("node")), "node", "left_anti")
        rows = self.scratch.store(_first(asked, shared), "first")
        self.scratch.drop("shared")
        return rows

    def with_components(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("comp", F.col("node"))
        return rows.join(self.roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")

    def load(self, nodes: DataFrame) -> None:
        """Measures and sets of the given nodes, computed anew from their texts, for all comparisons.

        Texts are found by id and hashes and meet the nodes before they become sets, so sets are shuffled by the joins that
        compare them only.  Of repeated rows one is enough.
        """
        keys = ["key", "th", "th2"]
        key = F.coalesce(F.col("doc_id"), F.lit(-1)).alias("key")
        self.known = self.scratch.store(nodes.join(self.facts, "node").select("node", "n", "bits", key, "th", "th2"), "known")
        texts = (_with_hashes(self.docs.select(*keys[1:], key, "doc_id", "text"), self.known).join(self.known.select("node", *keys), keys)
                 .dropDuplicates([*keys, "node"]))
        self.sets = self.scratch.store(_sets(texts), "sets")

    def compare(self, pairs: DataFrame) -> None:
        """Compare the pairs (a < b) not compared before, and join the components of those that are similar."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = self.scratch.store(pairs, "pairs")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        side = lambda x: self.known.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
        near = self.scratch.store(_near(pairs.join(side("a"), "a").join(side("b"), "b").withColumn("total", F.col("n_a") + F.col("n_b"))), "near-pairs")
        moved = near.agg(F.sum("total")).first()[0]
        if moved is None:
            return
        # A set is shuffled once for each of its pairs, and few large sets may have most of the shingles: a slice moves about half of all of them.
        slices, found = max(1, -(-self.slices * moved // (4 * self.shingles))), None
        for k in range(slices):
            loaded = (near.where(_slice("a", k, slices))
                      .join(self.sets.where(_slice("node", k, slices)).select(F.col("node").alias("a"), F.col("items").alias("set_a")), "a")
                      .join(self.sets.select(F.col("node").alias("b"), F.col("items").alias("set_b")), "b"))
            part = self.scratch.store(_similar(loaded), "links")
            found = part if found is None else found.unionByName(part)
        self.scratch.drop("near-pairs")
        if found.isEmpty():
            return
        if self.roots is not None:
            found = found.unionByName(self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.roots = self.scratch.store(connected_components(found), "roots", replace=True)

    def run(self) -> None:
        left = self.first_signatures().withColumns({"before": F.lit(0).cast("long"), "bits": F.lit(None).cast("binary"), "comp": F.col("node"), "order": F.col("own")})
        for k in range(STAR_ROUNDS + 1):
            if k:
                left = self.with_components(left).join(self.known.select("node", "bits"), "node").withColumn("order", F.xxhash64("node", F.lit(k)))
            found = self.scratch.store(_candidates(left, k == STAR_ROUNDS), "candidates")
            pairs = found.where("sig is null").select("a", "b")
            left = found.where("sig is not null").select(F.col("a").alias("node"), "sig", "n", "before")
            if self.sets is None:
                if found.isEmpty():
                    break
                self.scratch.drop("first")
                self.load(found.select(F.col("a").alias("node")).unionByName(found.where("b is not null").select(F.col("b").alias("node"))).distinct())
            self.compare(pairs)
            if left.isEmpty():
                break
        self.roots = self._with_copies()
        self.scratch.drop("candidates", "pairs", "known", "sets")

    def _with_copies(self) -> DataFrame:
        """Roots of all nodes that have links, equal sets among them."""
        equal = self.copies.select(F.col("a").alias("node"), F.col("b").alias("rep")).unionByName(self.copies.select(F.col("b").alias("node"), F.col("b").alias("rep")).distinct())
        if self.roots is None:
            return self.scratch.store(equal.withColumnRenamed("rep", "root"), "roots")
        all_ = equal.join(self.roots.withColumnRenamed("node", "rep"), "rep", "left").select("node", F.coalesce("root", "rep").alias("root"))
        return self.scratch.store(all_.unionByName(self.roots.select("node", "root")).distinct(), "all-roots")


def similar_components(docs: DataFrame) -> DataFrame:
    """(node, doc_id, n_shingles, component_id) of every row: component_id is the smallest doc_id of its component.

    Needs doc_id and text.  NULL, empty and white-space texts have the empty set and link with nothing;
    below five words the whole sequence is one shingle.  A NULL doc_id is a document; its component has the
    smallest id that is not NULL, or NULL.  Repeated rows are linked to each other; repeated ids with
    other texts are documents of their own.  Extra columns are not read; an empty table gives an
    empty result.  ``node`` is a number of the row within this call.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    join = _Join(rows)
    join.run()
    facts = join.facts.select("node", "doc_id", F.col("n").alias("n_shingles"))
    joined = through_storage(facts.join(join.roots, "node", "left"), "rooted")
    least = joined.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return joined.join(least, "root", "left").select("node", "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the row with the smallest doc_id (any one of repeated rows)."""
    # Rows are found again by id and text, so the table is not stored once more.
    key = {"key": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), "key_null": F.col("doc_id").isNull(),
           "th": F.xxhash64(F.col("text").cast("string")), "th2": F.hash(F.col("text").cast("string"))}
    rows = docs.select(F.monotonically_increasing_id().alias("node"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    join = _Join(rows)
    join.run()
    members = join.facts.join(join.roots, "node").select("node", "root", "doc_id", F.coalesce("doc_id", F.lit(-1)).alias("key"), F.col("doc_id").isNull().alias("key_null"), "th", "th2")
    best = members.groupBy("root").agg(F.min(F.struct("key_null", "doc_id", "node")).alias("best"))
    judged = members.join(best, "root").groupBy(*key).agg(F.max(F.col("node") == F.col("best.node")).alias("stays"), F.count(F.lit(1)).alias("copies"))
    judged = through_storage(judged, "judged")
    named = docs.select(*[c.alias(x) for x, c in key.items()], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    # Of repeated rows that stay, one.
    once = named.join(judged.where("not stays or copies > 1"), list(key), "left_anti").select("d")
    repeated = named.join(judged.where("stays and copies > 1"), list(key), "left_semi").groupBy(*key).agg(F.first("d").alias("d")).select("d")
    return once.unionByName(repeated).select("d.*")
