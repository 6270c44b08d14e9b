"""Line fields, conversation repair and spelling variants against brute force, on edge tables."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_edge_tables import CLASH, SCHEMA, edge_texts  # noqa: E402

from sievework.llm import line_quality, repair, spelling  # noqa: E402

CLASHING = ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'long'}"
                     for k, v in CLASH.items())


# --- repair ---------------------------------------------------------------------------------------------------------

def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if h == 4 else role
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def repaired(rows):
    """Counts, cost, audit and text of one conversation's rows, by trying every list of edits (with shared tails)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        kinds.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    legal = re.compile(r"(s?(ua)+)?")
    start = re.compile(r"s?|s?(ua)*u?")

    @lru_cache(None)
    def best(i, initials, inserts):
        """Cheapest (cost, audit, lines) from row i on; initials: the last two roles stand for all before."""
        found = []
        if i == len(rows):
            if legal.fullmatch(initials):
                found.append((0, "", ()))
        else:
            _, _, role, text = rows[i]
            tries = [("D", initials, 4, None)]
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 if kinds[i] == "truncated" else 0
                tries += [("K", initials + role[:1], more, role + ":" + text)] if role[:1] else []
                tries += [("R", initials + r[0], 3 + more, r + ":" + text) for r in ("user", "assistant")]
            for letter, after, paid, line in tries:
                if start.fullmatch(after):
                    cost, audit, lines = best(i + 1, short(after), 0)
                    found.append((cost + paid, letter + audit, ((line,) if line is not None else ()) + lines))
        if inserts < 3:
            for r in ("user", "assistant"):
                if start.fullmatch(initials + r[0]):
                    cost, audit, lines = best(i, short(initials + r[0]), inserts + 1)
                    found.append((cost + 3, "I" + audit, (r + ":",) + lines))
        return min(found, default=(10**9, "", ()))

    def short(initials):
        while initials.endswith("uaua"):
            initials = initials[:-2]
        while initials.endswith("uauau"):
            initials = initials[:-3] + "u"
        return initials

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    kinds = Counter(kinds)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations():
    rng, rows = random.Random(5), []
    texts = ["Hello there.", "Why?", "no end", "  ", "", None, "Again!", "x ", "ends. \n", "été?"]
    for conv in [*range(60), None, 2**40]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3, -2]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "Üb"]), rng.choice(texts)))
    rows += [(500, None, "user", "Only undated.")] * 3 + [(501, 1, "user", "Long. " * 40_000), (501, 2, "assistant", "word " * 40_000)]
    rows += [(502, t, ["user", "assistant"][t % 2], f"Turn {t % 50}.") for t in range(400)]
    rows += [r for r in rows[:20]]
    return rows


@pytest.mark.parametrize("block_rows, batch", [(repair.BLOCK_ROWS, 10_000), (7, 3)])
def test_repair(spark, block_rows, batch):
    rows = conversations()
    df = spark.createDataFrame([(*r, *CLASH.values()) for r in rows], "conv_id long, turn long, role string, text string, " + CLASHING)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r.conv_id: tuple(r)[1:] for r in repair.repair(repair.damaged(df), block_rows).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    by = defaultdict(list)
    for r in damaged(rows):
        by[r[0]].append(r)
    want = {c: repaired(by[c]) for c in {r[0] for r in rows}}
    assert got == want


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damaged(none)).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Hi.")], none.schema)
    assert [tuple(r) for r in repair.repair(repair.damaged(one)).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repair(repair.as_logged(one)).first().audit == "KI"


# --- spelling -------------------------------------------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def spelled(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    others = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(others[w]), counts[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("shard_words, round_bytes", [(spelling.SHARD_WORDS, spelling.ROUND_BYTES), (40, 2000)])
def test_spelling(spark, monkeypatch, shard_words, round_bytes):
    rng = random.Random(8)
    monkeypatch.setattr(spelling, "PIECE_CHARS", 500)  # not seen by workers that import the module, but by the driver's own use
    bases = ["".join(rng.choice("abcéÉßz") for _ in range(rng.randint(7, 10))) for _ in range(30)] + ["aaaaaaaa", "w" * 70, "w" * 71, "w" * 70 + "v", "hundred", "hundreds"]
    rows = []
    for k in range(150):
        words = []
        for _ in range(40):
            w = rng.choice(bases[:6] if rng.random() < 0.7 else bases)
            if rng.random() < 0.15:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcéx") + w[i + 1:], w[:i] + rng.choice("abcé") + w[i:]])
            words.append(w.upper() if rng.random() < 0.05 and w.isascii() else w)
        rows.append((k, rng.choice([" ", "-", "\n", "1"]).join(words)))
    rows += [(None, "hundred hundred"), (7, None), (8, ""), (9, "hundred " * 3000), (9, "hundred " * 3000), (10, "×÷×÷×÷× ÀÀÀÀÀÀÀ ÀÀÀÀÀÀÀ ààààààà")]
    docs = spark.createDataFrame([(*r, None, None, None, *CLASH.values()) for r in rows], SCHEMA)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(docs, shard_words=shard_words, round_bytes=round_bytes).collect()}
    want = spelled(rows)
    assert got == want
    assert any(f for f, *_ in want.values()) and any(n > 3 for *_, n, _ in want.values())


def test_pieces_of_a_text():
    text, run, other = "abcdefgh ijklmno-" * 50 + "x" * 40, re.compile("[a-z]{7,}"), re.compile("[^a-z]")
    kept, spelling.PIECE_CHARS = spelling.PIECE_CHARS, 23
    try:
        assert list(itertools.chain(*spelling._runs(text, run, other))) == run.findall(text)
    finally:
        spelling.PIECE_CHARS = kept


def test_spelling_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spelling.spelling_groups(none).count() == 0
    assert spelling.spelling_groups(none.union(spark.createDataFrame([(1, None, None, None, None, *CLASH.values())], SCHEMA))).count() == 0


# --- lines ----------------------------------------------------------------------------------------------------------

def test_marginals_and_gradient():
    rng = np.random.default_rng(1)
    counts = np.array([4, 1, 6])
    x, y = rng.normal(size=(11, line_quality.WIDTH)), (rng.random(11) > 0.4).astype(float)
    weights, moves = rng.normal(size=line_quality.WIDTH) * 0.2, rng.normal(size=(2, 2))

    def likelihood(w, m):
        total, odds, at = 0.0, [], 0
        for n in counts:
            e = x[at:at + n] @ w
            scores = {s: sum(e[t] for t in range(n) if s[t]) + sum(m[s[t], s[t + 1]] for t in range(n - 1)) for s in itertools.product((0, 1), repeat=int(n))}
            z = np.logaddexp.reduce(list(scores.values()))
            total += scores[tuple(int(v) for v in y[at:at + n])] - z
            odds += [np.logaddexp.reduce([v for s, v in scores.items() if s[t]]) - np.logaddexp.reduce([v for s, v in scores.items() if not s[t]]) for t in range(n)]
            at += n
        return total, np.array(odds)
    e, mask = line_quality._padded(x @ weights, counts)
    assert np.allclose(line_quality.marginals(e, mask, moves)[0][mask], likelihood(weights, moves)[1])
    of_weights, of_moves = line_quality._gradient(x, y, counts, weights, moves)
    for k in range(5):
        step = np.eye(line_quality.WIDTH)[k] * 1e-5
        assert np.isclose(of_weights[k], (likelihood(weights + step, moves)[0] - likelihood(weights - step, moves)[0]) / 2e-5, atol=1e-4)
    for i, j in itertools.product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[i, j] = 1e-5
        assert np.isclose(of_moves[i, j], (likelihood(weights, moves + step)[0] - likelihood(weights, moves - step)[0]) / 2e-5, atol=1e-4)


def test_lines_do_not_depend_on_their_neighbours_in_a_batch():
    texts = [t.encode() for t in ["One line.\n\n \nTwo lines.\nOne line.", "", "  \n", "a | b | c", "É!! Ü!! É!! Ü!!", "x " * 300_000, "one\n" * 3] * 2]
    x, lengths, counts = line_quality.describe(texts)
    assert counts.tolist() == [3, 0, 0, 1, 1, 1, 3] * 2 and len(x) == len(lengths) == 18
    for k, t in enumerate(texts):
        alone = line_quality.describe([t])
        at = counts[:k].sum()
        assert np.allclose(alone[0], x[at:at + counts[k]]) and alone[2][0] == counts[k]
    own = dict(zip(line_quality.OWN, x[2, 1:]))
    assert own["earlier_line"] == 1 and own["ended"] == 1 and x[2, -1] == 1 and x[0, -2] == 1


def test_held_out_accuracy_and_edges(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    field = line_quality.training_field(docs, labels)
    got = line_quality.score_documents(docs, field).join(labels, "doc_id").where("held_out").collect()
    bad = [r for r in got if r.quality == 0]
    assert len(got) > 80 and sum(r.predicted == r.quality for r in got) >= 0.97 * len(got) and sum(r.predicted == 0 for r in bad) >= 0.8 * len(bad)
    rows = [(*r, *CLASH.values()) for r in edge_texts()]
    edge = spark.createDataFrame(rows, SCHEMA)
    scored = line_quality.score_documents(edge, field).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert Counter((r.doc_id, r.held_out) for r in scored) == Counter((r[0], zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 1) for r in rows)
    by_id = defaultdict(set)
    for r in scored:
        by_id[r.doc_id].add(r.score)
    assert len(by_id[3]) == 1 and by_id[4] == by_id[5] == by_id[6] == {field.without_lines}
    none = line_quality.training_field(docs, labels.where("false"))
    assert {r.score for r in line_quality.score_documents(edge.where("doc_id < 4"), none).collect()} == {0.5}
    assert line_quality.score_documents(edge.where("false"), none).count() == 0
    same = line_quality.training_field(docs, labels.where("quality = 1"))
    assert line_quality.score_documents(docs, same).where("score < 0.9").count() == 0
    # Labels that are held out change nothing.
    turned = labels.withColumn("quality", F.when(line_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(line_quality.training_field(docs, turned).weights, field.weights)
