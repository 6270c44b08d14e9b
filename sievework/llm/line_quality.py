"""Document quality from lines: a linear-chain conditional random field labels every line good or bad.

Lines are described by what they look like and by what the lines before and after look like; transitions tie
neighbouring labels together.  The field is fitted on the driver to a bounded sample of labelled documents.  Labels
are known per document only: lines start with the label of their document, and lines of bad documents that look good are
turned over between rounds of fitting (the worst line of a bad document stays bad).  Every document of the table
is then scored where it lies: forward-backward marginals, weighted by the length of the lines, are its quality, and a
logistic curve fitted to the same sample turns that into a probability of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.columns import plain_columns

#: Rows of the labelled sample: sequences of at most so many lines each (about 50 MB on the driver at most).
TRAIN_SEQUENCES, SEQUENCE_LINES = 4096, 64
#: Texts are described in pieces of about this many bytes, cut between lines; a longer line counts as several.
PIECE_BYTES = 1 << 20
#: Rounds of fitting with lines of bad documents turned over in between, steps a round, and the ridge penalty.
ROUNDS, STEPS, RIDGE = 2, 80, 1e-3
#: Share of rows whose labels are never used: checksum of the id modulo FOLDS is HELD_OUT (fixed by the result contract).
FOLDS, HELD_OUT = 3, 1

OWN = ("log_length", "upper", "symbols", "exclamations", "bars", "digits", "word_length", "adjacent_repeats", "repeated_words", "repeated_pairs",
       "ended", "earlier_line", "few_words", "lower_start")
#: Bias, own features, those of the line before and after, first and last line.
WIDTH = 1 + 3 * len(OWN) + 2

_KIND = {name: np.zeros(256, dtype=bool) for name in ("space", "upper", "letter", "symbol", "digit", "shout", "bar")}
_KIND["space"][[9, 10, 11, 12, 13, 32]] = True
_KIND["upper"][65:91] = True
_KIND["letter"][[*range(65, 91), *range(97, 123), *range(0xC2, 0x100)]] = True  # a lead byte stands for a letter
_KIND["symbol"][[*b"#*$%&|<>"]] = True
_KIND["digit"][48:58] = True
_KIND["shout"][33] = True
_KIND["bar"][124] = True


def _groups(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(row, piece) of whole lines, in groups of about ``PIECE_BYTES``."""
    group, held = [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE_BYTES:
                end = text.rfind(b"\n", at, at + PIECE_BYTES) + 1
                end = end if end > at else at + PIECE_BYTES
            if group and held + end - at > PIECE_BYTES:
                yield group
                group, held = [], 0
            group.append((row, text[at:end]))
            held += end - at
            at = end
    if group:
        yield group


def _unique_a_line(line: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each line."""
    key = np.sort((line.astype(np.uint64) << np.uint64(40)) ^ value)
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)


def _described(data: bytes, starts: np.ndarray, ends: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Own features of the lines [start, end) of ``data``; every line has a character that is no white space.

    ``earlier``: whether the line occurs before in its text.
    """
    raw, n = np.frombuffer(data, dtype=np.uint8), len(starts)
    length = (ends - starts).astype(np.float64)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64).astype(np.float64)
    space = _KIND["space"][raw]
    upper = _KIND["upper"][raw]
    upper[:-1] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    begins = ~space
    begins[1:] &= space[:-1]
    begins[starts[~space[starts]]] = True
    at = np.flatnonzero(begins)
    word_line = np.searchsorted(starts, at, side="right") - 1
    words = np.bincount(word_line, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    offsets = np.append(at, len(raw)).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    # A unit is a word with the white space behind it; the last of a line has its line end as well.
    ids = coded.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
    same_line = word_line[1:] == word_line[:-1]
    adjacent = np.bincount(word_line[1:][same_line & (ids[1:] == ids[:-1])], minlength=n)
    pair_line = word_line[1:][same_line]
    pairs = np.bincount(pair_line, minlength=n)
    pair = ((ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(24))[same_line]
    letters = np.maximum(count(_KIND["letter"][raw]), 1)
    # The last character of each line that is no white space.
    solid = np.flatnonzero(~space)
    last = raw[solid[np.searchsorted(solid, ends) - 1]]
    first = raw[solid[np.searchsorted(solid, starts)]]
    columns = [np.log1p(length) / 8, count(upper) / letters, np.minimum(1, 5 * count(_KIND["symbol"][raw]) / length), np.minimum(1, count(_KIND["shout"][raw]) / some),
               np.minimum(1, count(_KIND["bar"][raw]) / some), count(_KIND["digit"][raw]) / length, np.minimum(2, count(~space) / some / 10), adjacent / some,
               1 - _unique_a_line(word_line, ids, n) / some, 1 - _unique_a_line(pair_line, pair, n) / np.maximum(pairs, 1),
               np.isin(last, [*b".!?"]), earlier, words < 4, (first >= 97) & (first <= 122)]
    out = np.column_stack(columns)
    out[:, 9][pairs == 0] = 0
    return out


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, number of lines of each text); lines of white space only are left out."""
    own, lengths, rows = [], [], []
    seen, now = set(), -1
    for group in _groups(texts):
        data = b"\n".join(piece for _, piece in group)
        raw = np.frombuffer(data, dtype=np.uint8)
        breaks = np.flatnonzero(raw == 10)
        starts, ends = np.append(0, breaks + 1), np.append(breaks, len(raw))
        solid = np.concatenate([[0], np.cumsum(~_KIND["space"][raw])])
        keep = solid[ends] > solid[starts]
        starts, ends = starts[keep], ends[keep]
        if not len(starts):
            continue
        until = np.cumsum([len(piece) + 1 for _, piece in group])
        row = np.array([r for r, _ in group])[np.searchsorted(until, starts, side="right")]
        earlier = np.zeros(len(starts))
        for k, (r, a, b) in enumerate(zip(row.tolist(), starts.tolist(), ends.tolist())):
            if r != now:
                seen, now = set(), r
            line = hash(data[a:b].strip())
            earlier[k] = line in seen
            seen.add(line)
        own.append(_described(data, starts, ends, earlier))
        lengths.append(ends - starts)
        rows.append(row)
    if not own:
        return np.empty((0, WIDTH)), np.empty(0), np.zeros(len(texts), np.int64)
    own, lengths, rows = np.concatenate(own), np.concatenate(lengths).astype(np.float64), np.concatenate(rows)
    n, k = own.shape
    joined = (rows[1:] == rows[:-1])[:, None]
    x = np.zeros((n, WIDTH))
    x[:, 0] = 1
    x[:, 1:k + 1] = own
    x[1:, k + 1:2 * k + 1] = own[:-1] * joined
    x[:-1, 2 * k + 1:3 * k + 1] = own[1:] * joined
    x[:, -2] = np.append(1, ~joined)
    x[:, -1] = np.append(~joined, 1)
    return x, lengths, np.bincount(rows, minlength=len(texts))


@dataclass
class Field:
    """Weights of the features (log-odds of good), scores of transitions (from, to), curve of the document's quality, score without lines."""

    weights: np.ndarray
    moves: np.ndarray
    curve: tuple[float, float]
    without_lines: float


def _padded(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequences x longest) of values that lie one sequence after the other, and the mask of filled places."""
    mask = np.arange(max(1, counts.max(initial=0)))[None, :] < counts[:, None]
    out = np.zeros(mask.shape)
    out[mask] = values
    return out, mask


def marginals(e: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-odds of good, forward part, backward part) per line, from emissions ``e`` (sequences x lines) by forward-backward.

    Log-odds of the two states are carried; they say all that two scaled values would.
    """
    n = e.shape[1]
    fore, back = np.zeros_like(e), np.zeros_like(e)
    fore[:, 0] = e[:, 0]
    for t in range(1, n):
        live = mask[:, t]
        x = fore[live, t - 1]
        fore[live, t] = e[live, t] + np.logaddexp(moves[0, 1], x + moves[1, 1]) - np.logaddexp(moves[0, 0], x + moves[1, 0])
    for t in range(n - 2, -1, -1):
        live = mask[:, t + 1]
        x = e[live, t + 1] + back[live, t + 1]
        back[live, t] = np.logaddexp(moves[1, 0], x + moves[1, 1]) - np.logaddexp(moves[0, 0], x + moves[0, 1])
    return fore + back, fore, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _gradient(x: np.ndarray, y: np.ndarray, counts: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of labels ``y`` a line: observed less expected features and transitions."""
    e, mask = _padded(x @ weights, counts)
    odds, fore, back = marginals(e, mask, moves)
    of_weights = x.T @ (y - _sigmoid(odds[mask]))
    labels, _ = _padded(y, counts)
    both = mask[:, 1:]
    a, b = fore[:, :-1][both], (e + back)[:, 1:][both]
    joint = np.stack([np.full_like(a, moves[0, 0]), moves[0, 1] + b, moves[1, 0] + a, moves[1, 1] + a + b])
    joint = np.exp(joint - joint.max(axis=0, initial=-np.inf, keepdims=True))
    expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
    one, two = labels[:, :-1][both], labels[:, 1:][both]
    observed = np.array([[((1 - one) * (1 - two)).sum(), ((1 - one) * two).sum()], [(one * (1 - two)).sum(), (one * two).sum()]])
    return of_weights, observed - expected


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, lengths: np.ndarray, empty: tuple[int, int] = (0, 0)) -> Field:
    """The field for sequences of ``counts`` lines each, with a label (0 or 1) a sequence; ``empty``: (rows, of label 1) without lines."""
    n, ones = len(labels) + empty[0], labels.sum() + empty[1]
    prior = float((ones + 1) / (n + 2))
    without = (empty[1] + 2 * prior) / (empty[0] + 2)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), (0.0, float(np.log(prior / (1 - prior)))), without)
    first, of = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)
    truth = labels[of].astype(np.float64)
    y, weights, moves = truth.copy(), np.zeros(WIDTH), np.zeros((2, 2))
    for turn in range(ROUNDS):
        theta, m, v = np.concatenate([weights, moves.ravel()]), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
        for step in range(1, STEPS + 1):
            of_weights, of_moves = _gradient(x, y, counts, theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
            g = np.concatenate([of_weights, of_moves.ravel()]) / len(y) - RIDGE * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + 0.2 * (1 - step / (STEPS + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        weights, moves = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        e, mask = _padded(x @ weights, counts)
        odds = marginals(e, mask, moves)[0][mask]
        if turn < ROUNDS - 1:
            worst = np.zeros(len(y), dtype=bool)
            worst[first + np.array([odds[a:a + k].argmin() for a, k in zip(first, counts)])] = True
            y = np.where(truth == 1, 1.0, np.where(worst, 0.0, odds > 0))
    q = _logit(np.bincount(of, _sigmoid(odds) * lengths) / np.bincount(of, lengths))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the logistic curve
        p = _sigmoid(a * q + b)
        w, r = p * (1 - p) + 1e-9, labels - p
        h = np.array([[(w * q * q).sum() + 1e-3, (w * q).sum()], [(w * q).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [(r * q).sum() - 1e-3 * a, r.sum() - 1e-3 * b])
        a, b = a + np.clip(da, -1, 1), b + np.clip(db, -1, 1)
    return Field(weights, moves, (max(float(a), 1e-3), float(b)), without)


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def score_texts(texts: list[bytes], field: Field) -> np.ndarray:
    """Probability of label 1 per text."""
    out = np.full(len(texts), field.without_lines)
    x, lengths, counts = describe(texts)
    cuts = np.cumsum(counts)[:-1]
    emissions, lengths = np.split(x @ field.weights, cuts), np.split(lengths, cuts)
    order = np.argsort(counts, kind="stable")
    # Sequences of like lengths are worked on together; padding at most doubles them.
    for group in np.split(order, np.flatnonzero(np.diff(np.frexp(counts[order])[1])) + 1):
        n = counts[group]
        if not len(group) or not n.max():
            continue
        e, mask = _padded(np.concatenate([emissions[k] for k in group]), n)
        good = _sigmoid(marginals(e, mask, field.moves)[0])
        weight, _ = _padded(np.concatenate([lengths[k] for k in group]), n)
        a, b = field.curve
        out[group] = _sigmoid(a * _logit((good * weight).sum(axis=1) / weight.sum(axis=1)) + b)
    return out


def held_out(doc_id) -> F.Column:
    """Whether labels of the id must not be learned from; a NULL id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def training_field(docs: DataFrame, labels: DataFrame, sequences: int = TRAIN_SEQUENCES) -> Field:
    """The field fitted to at most ``sequences`` sequences of labelled documents that are not held out, picked by a hash of the row.

    The share of rows picked follows their number, so only about as many texts as are used get described.
    Of several labels of an id the smallest counts; NULL labels are left out.
    """
    marks = plain_columns(labels, {"doc_id": "long", "quality": "int"}).where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    open_rows = plain_columns(docs, {"doc_id": "long", "text": "string"}).where(~held_out(F.col("doc_id")))
    n = max(1, open_rows.select("doc_id").join(marks, "doc_id").count())
    picked = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(min(1.0, sequences / n) * (1 << 30))
    rows = open_rows.where(picked).join(marks, "doc_id").select("quality", F.coalesce("text", F.lit("")).alias("text"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, (qualities, texts) = [], [c.to_pylist() for c in batch.columns]
            x, lengths, counts = describe([t.encode() for t in texts])
            for quality, n, end in zip(qualities, counts.tolist(), np.cumsum(counts).tolist()):
                for k in range(end - n, max(end, end - n + 1), SEQUENCE_LINES):
                    until = min(end, k + SEQUENCE_LINES)
                    out.append((quality, until - k, x[k:until].astype(np.float32).tobytes(), lengths[k:until].tobytes()))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()),
                                              pa.array(columns[3], pa.binary())], ["quality", "n", "x", "lengths"])
    told = rows.mapInArrow(described, "quality int, n int, x binary, lengths binary")
    sample = told.orderBy(F.xxhash64("x", "lengths", "quality"), "quality").limit(sequences).collect()  # bounded by its two parameters
    full = [r for r in sample if r.n]
    bare = [r for r in sample if not r.n]
    x = np.frombuffer(b"".join(r.x for r in full), np.float32).reshape(-1, WIDTH).astype(np.float64)
    return fit(x, np.array([r.n for r in full], dtype=np.int64), np.array([r.quality for r in full]), np.frombuffer(b"".join(r.lengths for r in full), np.float64),
               (len(bare), sum(r.quality for r in bare)))


def score_documents(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; needs doc_id and text.

    The text alone decides the score.  Empty, blank and NULL texts get the smoothed share of label 1 among labelled
    texts like them; very long texts are described piece by piece; repeated rows get equal scores; extra columns may have
    any name; an empty table gives no rows.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score_texts(texts, field))], ["doc_id", "held_out", "score"])
    rows = plain_columns(docs, {"doc_id": "long", "text": "string"}).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
