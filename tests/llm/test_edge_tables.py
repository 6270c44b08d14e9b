"""Every corpus operator on rows with NULLs, empty and very long texts, ties, repeats and clashing columns, and on empty tables."""

import base64
import hashlib
import random
import struct
import sys
import zlib
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from sievework.llm import bpe, chat, contamination, jaccard, licenses, quality, repeats, sharding, token_files, warc  # noqa: E402

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
#: Extra columns whose names operators might use for themselves.
CLASH = {"node": 1, "rank": "x", "h": 2.0, "n": 3, "d": "d", "ids": "i", "start": 4, "kept": True, "part": 5, "key": "k", "sig": 6, "m": 7}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{k}` {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'long'}"
    for k, v in CLASH.items())


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edge_texts() -> list[tuple]:
    rng = random.Random(3)
    base, passage = sentence(rng, 200), sentence(rng, 90)
    near = base.split()
    near[100] = "changed"
    long = sentence(rng, 60_000)
    texts = [(1, base), (2, " ".join(near)), (3, base), (3, base), (None, base.upper().replace("É", "é")), (4, None), (5, ""), (6, " \n\t "),
             (7, "one two three"), (8, "One TWO three"), (9, long), (10, long[:200_000]), (11, sentence(rng, 40) + " " + passage + " " + sentence(rng, 40)),
             (12, passage + "\n" + sentence(rng, 50)), (13, "word " * 500), (14, "é" * 450), (15, "<|endoftext|> a\x00b 　 c <|startoftext|>"),
             (16, "Released under the MIT License."), (None, None), (17, sentence(rng, 30) + " ### $$$ %%% " * 20),
             (18, "x" * 30_000), (2**40, "Tie tie tie. tie\ntie\ntie")]
    return [(i, t, lang, source, None) for (i, t), lang, source in zip(texts, ["en", None, "de"] * 9, ["a", "a", None, "b"] * 9)]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(*r, *CLASH.values()) for r in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_token_files(edge, none):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(WORD_BPE)
    got = token_files.read_token_files(token_files.write_token_files(edge, WORD_BPE, 2)).collect()
    want = Counter()
    for i, t, *_ in edge_texts():
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        want[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at, order = 0, sorted(got, key=lambda r: r.start)
    for r in order:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert token_files.read_token_files(token_files.write_token_files(none, WORD_BPE, 2)).count() == 0


def test_jaccard_join(edge, none):
    rows = edge_texts()
    sets, roots = brute.similar_groups([r[1] for r in rows])
    least = {k: min((rows[j][0] for j, x in enumerate(roots) if x == k and rows[j][0] is not None), default=None) for k in set(roots)}
    want = Counter((r[0], len(s), least[k]) for r, s, k in zip(rows, sets, roots))
    assert bag(jaccard.similar_components(edge), "doc_id", "n_shingles", "component_id") == want
    assert jaccard.similar_components(none).count() == 0
    kept = jaccard.one_per_group(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len(set(roots))
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= {1, 4, 5, 6, 7, 9, 10}


def test_bpe_round_trip(edge, none):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(BYTE_BPE)
    decoded = bpe.decode_documents(bpe.encode_documents(edge, BYTE_BPE), BYTE_BPE)
    want = Counter()
    for i, t, *_ in edge_texts():
        ids = whole.encode(t or "", add_special_tokens=False).ids
        want[i, struct.pack(f"<{len(ids)}I", *ids), whole.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, bytes(r.ids), r.text) for r in decoded.collect()) == want
    assert bpe.encode_documents(none, BYTE_BPE).count() == 0


def pages_frame(spark):
    pages = [(5, "http://a.example.com/x?q=1#f", "<p>same</p>"), (2, "https://User@A.example.com:80", "<p>same</p>"), (9, None, None), (3, "", ""),
             (7, "no url at all", "é" * 10), (None, "http://b.example/", "<p>same</p>"), (None, "http://c.example/", "only here"),
             (2, "https://User@A.example.com:80", "<p>same</p>"), (11, "http://a.example.com/x?q=1", "z" * 3_000_000), (12, "http://ü.example/\r\nX: y", "t")]
    return pages, spark.createDataFrame([(*p, 1, "k", "s") for p in pages], "page_id long, url string, html string, part int, key string, sha1 string")


def test_warc_archives(spark):
    pages, frame = pages_frame(spark)
    directory = warc.write_archives(frame)
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h in pages:
        data, origin = (h or "").encode(), first.get(h or "")
        again = origin is not None and origin != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), digest, "revisit" if again else "response", origin if again else None] += 1
    assert bag(warc.read_captures(directory), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want
    found = warc.look_up(directory, "http://a.example.com/x?q=1")
    assert sorted(x["page_id"] for x in found) == [5, 11]
    assert warc.look_up(directory, "http://nowhere.example/") == []
    assert [x["page_id"] for x in warc.look_up(directory, "http://ü.example/\r\nX: y")] == [12]
    empty = spark.createDataFrame([], frame.schema)
    assert warc.read_captures(warc.write_archives(empty)).count() == 0


def test_capture_key(spark):
    cases = {"http://www.Example.com:8080/a/b?c=d#e": "com,example,www)/a/b?c=d", "https://x.org": "org,x)/", "mailto:x": ")mailto:x", None: ")"}
    frame = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r.url: r.key for r in frame.select("url", warc.capture_key(F.col("url")).alias("key")).collect()} == cases


def test_chat_snapshots(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"),
            (3, 0, "user", "a"), (3, 1, "assistant", "b"), (3, 2, "user", "c"), (4, 0, "user", None), (5, 0, "user", ""), (5, 1, None, "x"),
            (6, 0, "user", "dup"), (6, 0, "user", "dup"), (7, 0, "user", "dup"), (None, 0, "user", "a"), (8, None, "user", "a"),
            (9, 2000, "user", "late"), (9, 0, "user", "z")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, slice int, h1 string")
    got = chat.render(frame).collect()
    assert {(r.conv_id, r.n_turns, r.n_copies) for r in got} == {(2, 3, 2), (4, 1, 1), (5, 2, 1), (6, 2, 1), (7, 1, 1), (9, 2, 1)}
    two = "".join(r.segment for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position))
    assert two == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert [r.segment for r in got if r.conv_id == 5 and r.turn == 1] == ["<|im_start|>\nx<|im_end|>\n"]
    assert sorted((r.turn, r.position) for r in got if r.conv_id == 9) == [(0, 0), (2000, 1)]
    assert chat.render(spark.createDataFrame([], frame.schema)).count() == 0


def test_repeated_passages(edge, none):
    rows = edge_texts()
    want = Counter((r[0], *x) for r, x in zip(rows, brute.without_repeats([r[1] for r in rows])))
    got = repeats.without_repeats(edge, ["doc_id"])
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.select("d.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()) == want
    assert repeats.without_repeats(none, ["doc_id"]).count() == 0


def test_contained_items(spark, edge, none):
    rng = random.Random(3)
    sentence(rng, 200)
    passage = sentence(rng, 90)
    items = spark.createDataFrame([(1, passage, "x"), (2, None, "x"), (3, "", "x"), (4, "ONE two Three", "x"), (5, sentence(random.Random(99), 30), "x"),
                                   (None, passage, "x"), (1, passage, "x")], "item_id long, text string, h string")
    got = bag(contamination.contained_items(edge, items), "doc_id", "item_id")
    assert got == Counter({(11, 1): 1, (12, 1): 1, (11, None): 1, (12, None): 1, (7, 4): 1, (8, 4): 1})
    assert contamination.contained_items(none, items).count() == 0
    assert contamination.contained_items(edge, items.where("item_id = 99")).count() == 0


def test_shards(edge, none):
    got = sharding.shard_rows(edge).collect()
    rows = edge_texts()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert sharding.shard_rows(none).count() == 0


def test_equal_texts_share_a_shard(spark):
    frame = spark.createDataFrame([(i, f"text {i // 4}") for i in range(400)], "doc_id long, text string")
    where = {}
    for r in sharding.shard_rows(frame).collect():
        where.setdefault(r.doc_id // 4, set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 25  # 15 cuts, and moves for which there was no room


def test_groups_that_fit_a_shard_stay_whole(spark):
    """Groups of 33 %, 10 %, 5 %, 1 % and few rows among unlinked ones; a shard has 6.25 % of the rows."""
    sizes = [2640, 800, 400, 400, 80, 80, 80] + [3] * 200
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)]
    texts += [f"single {k}" for k in range(8000 - len(texts))]
    random.Random(5).shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, where = sharding.shard_rows(frame).collect(), {}
    assert sorted(r.doc_id for r in got) == list(range(8000)) and set(Counter(r.shard for r in got).values()) == {500}
    assert len({(r.shard, r.slot) for r in got}) == 8000 and max(r.slot for r in got) == 499
    for r in got:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert {t: len(s) for t, s in where.items() if len(s) > 1} == {"group 0": 6, "group 1": 2}


def test_quality(edge, none):
    got = quality.judge(edge, ["doc_id"]).select("d.doc_id", *[f"m.{c}" for c in quality.MEASURES], "base_failed", "kept").collect()
    want = Counter()
    for i, t, *_ in edge_texts():
        m = brute.quality_measures(t)
        want[i, *m, m[0] < 10 or 100 * m[4] > 20 * m[0]] += 1
    assert Counter((r[0], *r[1:6], r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} >= {1, 2, 11, 12}
    assert quality.judge(none, none.columns).count() == 0


def test_licenses(spark, edge, none):
    assert [(r.doc_id, r.license, r.exact) for r in licenses.scan_licenses(edge).collect()] == [(16, "MIT statement", True)]
    assert licenses.scan_licenses(none).count() == 0
    changed = licenses.TEMPLATES["MIT"].replace("free of charge", "for a fee").replace("sublicense,", "")
    long = "Prose about nothing at all. " * 2000
    frame = spark.createDataFrame([(1, long + changed + "\n" + long), (2, "A licence is needed to fish here."), (3, licenses.TEMPLATES["Apache-2.0 header"])],
                                  "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(frame).collect()}
    assert set(got) == {1, 3}
    assert (got[1].license, got[1].exact, got[1].words_missing, got[1].words_added) == ("MIT", False, 4, 3)
    assert got[1].start == len(long) and got[1].differences == "-free -of -charge +for +a +fee -sublicense"
    assert got[3].license == "Apache-2.0 header" and got[3].exact


def test_jaccard_join_with_frequent_signatures(spark):
    """A passage most documents share, a group of near copies around the threshold, and documents of shared passages only."""
    rng = random.Random(8)
    common, other, origin = sentence(rng, 60), [sentence(rng, 40) for _ in range(4)], sentence(rng, 150).split()
    texts = [common + " " + sentence(rng, rng.randint(40, 160)) for _ in range(60)]
    for _ in range(60):
        near = list(origin)
        for _ in range(rng.randint(0, 8)):
            near[rng.randrange(150)] = sentence(rng, 1)
        texts.append(" ".join(near))
    texts += [" ".join(rng.sample(other, 3)) + " " + sentence(rng, rng.randint(1, 30)) for _ in range(50)]
    sets, roots = brute.similar_groups(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(frame).collect()}
    assert got == {k: (len(s), r) for k, (s, r) in enumerate(zip(sets, roots))}


def test_contained_items_of_documents_without_id(spark):
    rng = random.Random(31)
    item, other = sentence(rng, 30), sentence(rng, 30)
    docs = spark.createDataFrame([(None, f"a {item} b"), (None, other), (5, item), (5, f"c {other} d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = bag(contamination.contained_items(docs, items), "doc_id", "item_id")
    assert got == Counter({(None, 1): 1, (None, 2): 1, (5, 1): 1, (5, 2): 1})


def test_slices_of_signatures_and_pairs_lose_no_link(spark, monkeypatch):
    """Tables above a slice's size are worked on in slices: signatures, reordering and comparisons give the same components."""
    passage = " ".join(f"p{k}" for k in range(60))
    own = [" ".join(f"w{k}x{j}" for j in range(90)) + " " + passage for k in range(40)]
    texts = own + [t + " extra" for t in own[:12]] + own[:5]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "SLICE_SHINGLES", 1)
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    used = []
    monkeypatch.setattr(jaccard, "_slice", lambda column, k, of, f=jaccard._slice: used.append((column, of)) or f(column, k, of))
    found = {r.doc_id: r.component_id for r in jaccard.similar_components(table).collect()}
    assert found == {k: k if k < 40 else (k - 40) % 52 if k < 52 else k - 52 for k in range(len(texts))}
    assert ("sig", jaccard.SLICES) in used
    kept = sorted(r.doc_id for r in jaccard.one_per_group(table.unionByName(table.where("doc_id < 3"))).collect())
    assert kept == list(range(40))


def test_crowds_of_unlike_sets_make_few_pairs(spark, monkeypatch):
    """Sets of shared passages only, and sets with a passage of all: few pairs are compared, and a set without a partner leaves no signature."""
    rng = random.Random(12)
    passages, common = [sentence(rng, 40) for _ in range(20)], sentence(rng, 40)
    texts = [" ".join(rng.sample(passages, 4)) for _ in range(200)] + [sentence(rng, 120) + " " + common for _ in range(100)]
    origin = sentence(rng, 150).split()
    for _ in range(60):
        near = list(origin)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(150)] = sentence(rng, 1)
        texts.append(" ".join(near))
    rows, tables, store = Counter(), [], jaccard.Scratch.store

    def counted(self, df, label, replace=False):
        table = store(self, df, label, replace)
        rows[label] += table.count()
        tables.append(label)
        return table

    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard.Scratch, "store", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(frame).collect()}
    sets, roots = brute.similar_groups(texts)
    assert got == {k: (len(s), r) for k, (s, r) in enumerate(zip(sets, roots))}
    assert rows["near-pairs"] < 2_000
    assert len(tables) < 40
