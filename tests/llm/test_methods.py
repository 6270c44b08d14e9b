"""The parts of the corpus operators that run without Spark, against exhaustive versions."""

import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from sievework.llm import bpe, jaccard, licenses, repeats, token_files, units  # noqa: E402
from sievework.llm.suffixes import common_prefixes, repeated_starts, suffix_array  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(1, 3), max_size=40))
@settings(max_examples=300, deadline=None)
def test_suffix_array_is_sorted(s):
    order = suffix_array(s)
    assert order == sorted(range(len(s)), key=lambda i: s[i:])
    for x, shared in enumerate(common_prefixes(s, order)[1:], 1):
        a, b = s[order[x - 1]:], s[order[x]:]
        assert a[:shared] == b[:shared] and (shared in (len(a), len(b)) or a[shared] != b[shared])


@given(st.lists(st.binary(min_size=4, max_size=30).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_repeated_starts(strings):
    starts = [max(0, len(s) - 3) for s in strings]
    every = [s[i:i + 4] for s, n in zip(strings, starts) for i in range(n)]
    assert repeated_starts(strings, starts, 4) == [[every.count(s[i:i + 4]) > 1 for i in range(n)] for s, n in zip(strings, starts)]


def test_each_string_has_one_anchor_and_equal_strings_the_same():
    rng = random.Random(1)
    shared = bytes(rng.choice(b"abcd ") for _ in range(700))
    texts = [bytes(rng.choice(b"abcd ") for _ in range(300)) + shared, shared + b"tail" * 50, b"short", b"a" * 2000]
    seen: dict[bytes, set] = {}
    for pieces, rows, offsets in repeats.chunks(texts, 1000):
        _, piece, anchor, lo, hi, gram = repeats.anchors(pieces)
        begin = np.cumsum([0, *map(len, pieces)])
        starts = [0] * len(pieces)
        for k, p in enumerate(piece):
            for s in range(lo[k], hi[k] + 1):
                starts[p] += 1
                seen.setdefault(b"".join(pieces)[s:s + 400], set()).add((int(gram[k]), int(anchor[k] - s)))
        assert starts == [max(0, len(b) - 399) for b in pieces]
        assert len(begin) == len(pieces) + 1
    assert len(seen) >= 301 and all(len(x) == 1 for x in seen.values())


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_packed_ids(bits):
    ids = np.random.default_rng(0).integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == (1001 * bits + 7) // 8
    assert (token_files.unpack(packed, bits, 1001) == ids).all()


def test_token_file_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 49_408, n, dtype=np.uint32) for n in (0, 5, 20_000, 1, 8191, 0, 700_000)]
    import pyarrow as pa
    with pa.OSFile(str(tmp_path / "f"), "wb") as sink:
        w = token_files.TokenWriter(sink, 16, 2)
        for k, d in enumerate(docs):
            w.begin(None if k == 0 else k)
            w.add(d)
            w.end()
        w.close()
    with pa.memory_map(str(tmp_path / "f")) as source:
        f = token_files.TokenFile(source, source.size())
        assert f.doc_ids.tolist()[1:] == [1, 2, 3, 4, 5, 6] and not f.has_id[0]
        for k in (6, 2, 0, 4):
            assert f.document(k).tolist() == [*docs[k].tolist(), 2]


def text_pieces():
    return st.lists(st.sampled_from(["a", "B", " ", "\n", "é", " ", "́", "'s", "12", "漢", " ", "!", "\x85", "<|endoftext|>", "\x1f", "\x01", "the ", " of"]),
                    max_size=40).map("".join)


@given(st.lists(text_pieces(), max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoders_equal_the_library(texts):
    from tokenizers import Tokenizer
    for path, own in (("byte_bpe_50k.json", MODEL.encode), ("word_bpe_49k.json", None)):
        whole = Tokenizer.from_file(public_tokenizers.path(path)) if path not in LIBRARY else LIBRARY[path]
        LIBRARY[path] = whole
        encoder = units.UnitEncoder(lambda us: [np.array(own(u), dtype=np.uint32) for u in us]) if own else token_files.tokenizer(public_tokenizers.path(path))[1]
        got = [[] for _ in texts]
        for group in units.pieces([t.encode() for t in texts], 30):
            ids, counts = encoder.ids_of([p for _, p in group])
            ends = np.cumsum(counts)
            for (row, _), a, b in zip(group, ends - counts, ends):
                got[row] += ids[a:b].tolist()
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


LIBRARY: dict = {}
MODEL = bpe.ByteBpe(BYTE_BPE)


def test_lexicon(tmp_path):
    words = [" the", " then", " other", " mother", " brother", "é", " <|endoftext|>"]
    (tmp_path / "lex").write_bytes(bpe.compile_lexicon((w.encode(), MODEL.encode(w)) for w in words))
    known = bpe.Lexicon(str(tmp_path / "lex"))
    places = known.find([w.encode() for w in [*words, " th", "", " them", "zzz"]]).tolist()
    assert places[-4:] == [-1] * 4
    assert [known.ids_at(p).tolist() for p in places[:-4]] == [MODEL.encode(w) for w in words]
    assert len(known.final) < sum(len(w.encode()) for w in words)  # suffixes are shared
    (tmp_path / "none").write_bytes(bpe.compile_lexicon([]))
    assert bpe.Lexicon(str(tmp_path / "none")).find([b"a"]).tolist() == [-1]


def test_long_words_are_merged_alike():
    rng = random.Random(2)
    for _ in range(50):
        word = "".join(rng.choice("etaoinshr") for _ in range(200)).encode()
        short, bpe.HEAP_FROM = MODEL.merged(word), 10**9
        try:
            assert MODEL.merged(word) == short
        finally:
            bpe.HEAP_FROM = 64


def test_similar_sets_share_a_first_signature():
    """No pair at the threshold may be lost, across bands and at their edges."""
    rng = np.random.default_rng(4)
    for n in [1, 2, 3, 4, 7, 20, 47, 48, 49, 63, 64, 65, 95, 96, 97, 127, 128, 400, 1000, 3000]:
        for _ in range(15):
            common = rng.integers(0, 2**64, n, dtype=np.uint64)
            spare = n // 3
            cut = int(rng.integers(0, spare + 1))
            a = np.unique(np.concatenate([common, rng.integers(0, 2**64, cut, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, rng.integers(0, 2**64, spare - cut, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            assert 100 * both >= 75 * (len(a) + len(b) - both)
            first = [{int(x) for sigs, k in jaccard.signatures(s) for x in sigs[:k + 1]} for s in (a, b)]
            assert first[0] & first[1]
            assert all(len(sigs) > k for s in (a, b) for sigs, k in jaccard.signatures(s))


def test_parities_keep_similar_pairs():
    """Sets at the threshold stay, also where their sizes have different numbers of classes; unlike ones go."""
    rng = np.random.default_rng(5)
    held, pairs, unlike = [], [], []
    for n in [1, 3, 7, 16, 31, 32, 33, 48, 64, 100, 128, 129, 400, 1000, 4096]:
        for _ in range(10):
            common, cut = rng.integers(0, 2**64, n, dtype=np.uint64), int(rng.integers(0, n // 3 + 1))
            a = np.unique(np.concatenate([common, rng.integers(0, 2**64, cut, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, rng.integers(0, 2**64, n // 3 - cut, dtype=np.uint64)]))
            pairs.append((len(held), len(held) + 1, len(a) + len(b)))
            unlike.append((len(held), len(held) + 2, len(a) + n, n))
            held += [jaccard.parities(a), jaccard.parities(b), jaccard.parities(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)))]
    known = jaccard.Parities(held)
    assert known.near(*np.array(pairs).T).all()
    far = np.array([x[:3] for x in unlike if x[3] >= 100]).T
    assert not known.near(*far).any()


def test_shingle_sets():
    texts = ["", " ", "a", "A b", "one two three four five", "One two three four five six", "x " * 50, "É é"]
    got = [len(s) for s in jaccard.shingle_sets([t.encode() for t in texts])]
    assert got == [len(brute.shingles(t)) for t in texts]
    assert [s.tolist() for s in jaccard.shingle_sets([b"A B"])] == [s.tolist() for s in jaccard.shingle_sets([b"a\n b "])]


def licenses_of(text: str) -> list[tuple[str, bool]]:
    return [(r["license"], r["exact"]) for r in licenses.Scanner(licenses.TEMPLATES).scan(1, text)]


def test_words_that_decide_a_licence():
    t = licenses.TEMPLATES
    for name, text in t.items():
        assert licenses_of("Some prose here. " * 5 + text + "\nprose again about x") == [(name, True)]
    assert licenses_of("This work is licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License.") == []
    assert licenses_of("This work is licensed under the GNU General Public License, version 1.") == []
    assert licenses_of("Released under the License.") == []
    library = t["LGPL-2.1-or-later header"].replace("This program", "This library").replace("this program", "this library")
    assert licenses_of(library) == [("LGPL-2.1-or-later header", False)]


def test_every_notice_is_found():
    t = licenses.TEMPLATES
    assert licenses_of("Copyright 2020 Very Long Company Holding Name Ltd Paris London, all rights reserved.") == [("All rights reserved", True)]
    assert licenses_of("// SPDX-License-Identifier: MIT OR Apache-2.0\nint x;") == [("SPDX MIT OR Apache-2.0", True)]
    assert licenses_of(t["ISC"]) == [("ISC", True)] and licenses_of(t["CC0-1.0 statement"]) == [("CC0-1.0 statement", True)]
    assert licenses_of(t["MIT"] + "\n" + t["MIT"]) == [("MIT", True)] * 2
    assert licenses_of("Released under the MIT License. " * 2) == [("MIT statement", True)] * 2
    assert licenses_of(t["MIT"][:-9] + "WORK. " + t["Apache-2.0 header"]) == [("MIT", False), ("Apache-2.0 header", True)]
