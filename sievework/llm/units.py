"""Texts as numbers of repeated units, so that work per word is done once per distinct word and batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about this many bytes; longer texts are cut between words.
SLICE_BYTES = 1 << 20
#: Distinct units remembered between slices: the last so many, and those used since the so many before.
MEMO_UNITS = 400_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


_LETTER, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[*b".,;:!?"]] = True


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Positions that no token crosses: where ASCII white space begins after other text, or a mark (.,;:!?) follows an ASCII letter.

    This holds for tokenizers that first part words at white space and letters from other characters.
    After the white-space characters beyond ASCII (U+0085, U+00A0, U+1680, U+2000 to U+200A,
    U+2028, U+2029, U+202F, U+205F, U+3000; here by their UTF-8 bytes) no unit starts.
    """
    space = _SPACE[data]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    p1, p2, p3 = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    other = (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))
    other |= (p3 == 0xE2) & (p2 == 0x80) & ((p1 <= 0x8A) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))
    other |= (p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)
    other |= ((p3 == 0xE1) & (p2 == 0x9A) | (p3 == 0xE3) & (p2 == 0x80)) & (p1 == 0x80)
    starts = np.zeros(len(data), dtype=bool)
    starts[at[~other]] = True
    starts[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    return np.flatnonzero(starts)


def pieces(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """Groups of (row, piece) of about ``limit`` bytes; a text above it is cut where a unit starts."""
    group, held = [], 0
    for row, text in enumerate(texts):
        if len(text) <= limit:
            if group and held + len(text) > limit:
                yield group
                group, held = [], 0
            group.append((row, text))
            held += len(text)
            continue
        if group:
            yield group
            group, held = [], 0
        cuts = unit_starts(np.frombuffer(text, dtype=np.uint8))
        at = 0
        while at < len(text):
            k = np.searchsorted(cuts, at + limit)
            end = int(cuts[k]) if k < len(cuts) else len(text)
            yield [(row, text[at:end])]
            at = end
    if group:
        yield group


class UnitEncoder:
    """Ids of texts from ids of their distinct units.  ``encode(units)`` gives the ids of each unit."""

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], memo: int = MEMO_UNITS):
        self.encode, self.limit, self.memo, self.older = encode, memo, {}, {}

    def ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        data = b"".join(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        if not data:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        raw = np.frombuffer(data, dtype=np.uint8)
        ends = np.cumsum(lengths)
        begins = np.zeros(len(raw), dtype=bool)
        begins[unit_starts(raw)] = True
        begins[(ends - lengths)[lengths > 0]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = units.dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        _, place, held = coded.dictionary.buffers()
        place = np.frombuffer(place, np.int64)[coded.dictionary.offset:][:len(coded.dictionary) + 1].tolist()
        held = held.to_pybytes()
        distinct = [held[a:b] for a, b in zip(place, place[1:])]
        if len(self.memo) > self.limit:
            self.memo, self.older = {}, self.memo
        memo, older, new = self.memo, self.older, []
        for u in distinct:
            if u not in memo:
                if u in older:
                    memo[u] = older[u]
                else:
                    new.append(u)
        if new:
            memo.update(zip(new, map(np.ndarray.tobytes, self.encode([u.decode() for u in new]))))
        packed = [memo[u] for u in distinct]
        flat = np.frombuffer(b"".join(packed), dtype=np.uint32)
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        first = np.cumsum(sizes) - sizes
        n = sizes[at]
        until = np.cumsum(n)
        ids = flat[np.repeat(first[at] - (until - n), n) + np.arange(int(until[-1]))]
        before = np.concatenate([[0], until])
        counts = before[np.searchsorted(starts, ends)] - before[np.searchsorted(starts, ends - lengths)]
        return ids, counts
