"""The stages of the corpus pipeline one after the other, each against plain Python on what the one before kept."""

import hashlib
import random
import struct
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402


import corpus_pipeline  # noqa: E402
from sievework.llm import repeats  # noqa: E402
from test_edge_tables import SCHEMA, CLASH, edge_texts, sentence  # noqa: E402


def test_stages(spark, tmp_path):
    rng = random.Random(12)
    item, shared = sentence(rng, 40), sentence(rng, 80)
    more = [(100 + k, sentence(rng, 60), "en", "a", 5) for k in range(30)]
    more += [(200 + k, sentence(rng, 60) + " " + shared + " " + sentence(rng, 60), "en", "a", 5) for k in range(3)]
    more += [(300, sentence(rng, 50) + " " + item + " " + sentence(rng, 50), "de", None, 5)]
    rows = [(*r, *CLASH.values()) for r in edge_texts() + more]
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, SCHEMA)
    columns, texts = docs.columns, [(r[0], r[1]) for r in rows]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage-{k}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns, name
            got = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        if k == 0:
            bad = [t for t in texts if (m := brute.quality_measures(t[1]))[0] < 10 or 100 * m[4] > 20 * m[0]]
            assert not set(bad) & set(got) and not got - Counter(texts)
            assert {i for i, _ in got} >= {100 + k for k in range(30)} | {200, 201, 202, 300, 1, 2, 11, 12}
        if k == 1:
            _, roots = brute.similar_groups([t for _, t in texts])
            groups = {}
            for (i, t), root in zip(texts, roots):
                groups.setdefault(root, []).append((i is None, i or 0, t))
            want = Counter((None if least[0] else least[1], least[2]) for least in (min(g) for g in groups.values()))
            assert got == want
        if k == 2:
            want = Counter()
            for (i, t), (_, removed, _, kept) in zip(texts, brute.without_repeats([t for _, t in texts])):
                left = kept.decode("utf-8", "ignore")
                if not removed or brute.words(left):
                    want[i, left] += 1
            assert got == want
            assert any(shared[100:300] in (t or "") for _, t in texts) and not any(shared[100:300] in t for _, t in got)
        if k == 3:
            assert got == Counter(t for t in texts if t[0] != 300)
        if k < 4:
            texts = sorted(got.elements(), key=str)
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in texts:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), brute.sha256((t or "").encode())] += 1
    assert Counter(tuple(r) for r in docs.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage-{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{k}"))
        assert docs.count() == 0


def test_passages_are_counted_in_words(spark, tmp_path):
    """51 short words repeat with under 400 bytes, and go; 50 words that repeat stay."""
    rng = random.Random(21)
    passage, short = sentence(rng, 2000).split(), sentence(rng, 50)
    passage = " ".join([w for w in passage if len(w) <= 5][:51])
    assert len(passage.encode()) < 400
    ends = [sentence(rng, 60) for _ in range(8)]
    texts = [f"{ends[0]} A {passage} B {ends[1]}", f"{ends[2]} C {passage.replace(' ', '  ', 3)} D {ends[3]}", f"{ends[4]} E {short} F {ends[5]}",
             f"{ends[6]} G {short} H {ends[7]}"]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, str(tmp_path)).collect()}
    assert got == {0: f"{ends[0]} A  B {ends[1]}", 1: f"{ends[2]} C  D {ends[3]}", 2: texts[2], 3: texts[3]}


def test_texts_and_their_codes_are_not_stored(spark, monkeypatch):
    """The third stage's two searches store what they found, not a further copy of all texts or of the codes of their words."""
    stored, store = [], repeats.through_storage
    monkeypatch.setattr(repeats, "through_storage", lambda df, label: stored.append((label, df.columns)) or store(df, label))
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.createDataFrame([(k, f"a{k} b{k} {passage} c{k}") for k in range(3)] + [(3, "other words")], "doc_id long, text string")
    got = {r.d.doc_id: r.kept_text for r in repeats.without_repeats(docs, ["doc_id"], with_text=True, n_words=51).collect()}
    assert [got[k].split() for k in range(4)] == [[f"a{k}", f"b{k}", f"c{k}"] for k in range(3)] + [["other", "words"]]
    assert stored and not [label for label, columns in stored if "text" in columns]
