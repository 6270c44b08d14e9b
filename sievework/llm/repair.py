"""Repair of conversation structure at the least cost, streamed in the order of turns.

Rows are damaged, marked and partitioned by conversation, then sorted by turn inside each partition.  A task reads
them in Arrow batches and carries the state of the conversation it is in from batch to batch: per state of the
wanted pattern the least cost, the rank of its edits in ASCII order, and a running digest of the repaired text.  What
a row does to the costs depends on its role, its fault and the differences between the costs only, so there
are few such steps; each is worked out once, and a row's backpointers are the number of its step.  Backpointers of
giant conversations are written to the shared folder in blocks and read back from the end.

The states are those of ``(s?(ua)+)?`` over role initials: nothing yet, after s, after u, after a; it may end at
the first and the last.  Every edit leads from a state to one state, so two edit lists of the same
cost differ at some letter and their order never changes later: ranks are enough.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievework.llm.columns import plain_columns
from sievework.llm.store import attempt_name, open_store
from sievework.session import scratch_path

#: Costs of the edits, and what an undeleted truncated row adds (fixed by the result contract).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, S, U, A = range(4)
#: The role a state expects next, as (state after it, role); only a kept row can be a system row.
NEXT = {START: (U, "user"), S: (U, "user"), U: (A, "assistant"), A: (U, "user")}
INITIALS = {"s": 0, "u": 1, "a": 2}
OK, MUST_GO, CUT_SHORT = range(3)
#: Backpointers of this many rows stay in memory; a longer conversation writes them to the shared folder.
BLOCK_ROWS = 1 << 20
#: Characters that part words, and marks that end a sentence (fixed by the result contract).
_BLANK, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): every row as the checksum of ``conv_id:turn`` damages it; copies is 0 for a dropped row.

    A NULL is one space wherever a string is needed; the turn itself stays NULL.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return plain_columns(conversations, {"conv_id": dict(conversations.dtypes)["conv_id"], "turn": "long", "role": "string", "text": "string"}).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def as_logged(conversations: DataFrame) -> DataFrame:
    """The same columns without damage, for real logs."""
    space = F.lit(" ")
    return plain_columns(conversations, {"conv_id": dict(conversations.dtypes)["conv_id"], "turn": "long", "role": "string", "text": "string"}).select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with blank, ended and seen: whether role and text occur at an earlier turn of the conversation.

    First turns are combined before the shuffle; only texts that occur at several turns are joined.
    """
    mark = F.sha2(F.concat_ws("\x00", F.col("role"), F.col("text")), 256)
    rows = rows.withColumn("mark", F.when((F.col("copies") > 0) & F.col("text").rlike(_BLANK), mark))
    first = (rows.where("mark is not null").groupBy("conv_id", "mark")
             .agg(F.max(F.col("turn").isNull()).alias("undated"), F.min("turn").alias("first"), F.max("turn").alias("last"))
             .where("(undated and last is not null) or first < last")
             .select(F.col("conv_id").alias("f_conv"), F.col("mark").alias("f_mark"), F.when(~F.col("undated"), F.col("first")).alias("first")))
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("mark") == F.col("f_mark")), "left")
    return joined.select("conv_id", "turn", "role", "text", "copies", F.col("mark").isNull().alias("blank"), F.col("text").rlike(_ENDED).alias("ended"),
                         (F.col("f_mark").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))).alias("seen"))


class _Steps:
    """What a row does to (costs, ranks), each case worked out once.  A step is (added cost, costs, ranks, per state (from, inserts, letter))."""

    def __init__(self):
        self.known, self.steps = {}, []

    def of(self, row: int, state: tuple) -> int:
        at = self.known.get((row, state))
        if at is None:
            at = self.known[row, state] = len(self.steps)
            self.steps.append(self._step(row, *state))
        return at

    @staticmethod
    def _step(row: int, costs: tuple, ranks: tuple) -> tuple:
        initial, fault = divmod(row, 3)
        extra = TRUNCATED if fault == CUT_SHORT else 0
        found = {}
        for begun in range(4):
            if costs[begun] is None:
                continue
            state, cost = begun, costs[begun]
            for inserts in range(4):
                ends = [("D", state, DELETE)]
                if fault != MUST_GO:
                    expected = NEXT[state][0]
                    ends.append(("R", expected, REROLE + extra))
                    if initial == INITIALS["s"] and state == START:
                        ends.append(("K", S, extra))
                    elif initial == (INITIALS["u"] if expected == U else INITIALS["a"]):
                        ends.append(("K", expected, extra))
                for letter, end, paid in ends:
                    better = (cost + paid, ranks[begun], "I" * inserts + letter, begun, inserts, letter)
                    if end not in found or better < found[end]:
                        found[end] = better
                state, cost = NEXT[state][0], cost + INSERT
        order = sorted(found, key=lambda e: found[e][1:3])
        least = min(f[0] for f in found.values())
        return (least, (tuple(found[e][0] - least if e in found else None for e in range(4)), tuple(order.index(e) if e in found else 0 for e in range(4))),
                tuple(found[e][3:6] if e in found else None for e in range(4)))


def _ending(costs: tuple, ranks: tuple) -> tuple[int, int, int]:
    """(cost, state, inserts) of the best way to end after the last row."""
    best = None
    for begun in range(4):
        if costs[begun] is None:
            continue
        state, cost = begun, costs[begun]
        for inserts in range(4):
            if state in (START, A):
                # Edits with the same cost so far and no further letter come first; ranks order the others.
                one = (cost, ranks[begun], inserts, begun)
                best = one if best is None or one < best else best
            state, cost = NEXT[state][0], cost + INSERT
    return best[0], best[3], best[2]


class _Conversation:
    """The state carried through one conversation."""

    def __init__(self, conv_id, steps: _Steps, folder: str, block_rows: int):
        self.conv_id, self.steps, self.folder, self.block_rows = conv_id, steps, folder, block_rows
        self.state, self.cost = ((0, None, None, None), (0, 0, 0, 0)), 0
        self.texts = (hashlib.sha256(), None, None, None)
        self.empty = [True] * 4
        self.numbers, self.blocks = array("I"), []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns = self.before = None
        self.distinct, self.last_initial = 0, None

    def _saved(self) -> None:
        fs, path = open_store(attempt_name(self.folder, "backpointers"))
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path) as out:
            out.write(self.numbers.tobytes())
        self.blocks.append((fs, path))
        self.numbers = array("I")

    def row(self, turn, role: str, text: str, copies: int, blank: bool, ended: bool, seen: bool) -> None:
        if turn is not None:
            if self.turns is None:
                self.turns, self.distinct = (turn, turn), 1
            elif turn != self.turns[1]:
                self.turns, self.distinct = (self.turns[0], turn), self.distinct + 1
        same = (turn, role, text)
        repeated = same == self.before
        self.before = same
        initial = INITIALS.get(role[:1], 3)
        for k in range(copies):
            fault = "blank" if blank else "duplicate" if seen or repeated or k else None if ended else "truncated"
            if fault:
                self.counts[fault] += 1
            if self.last_initial is not None and (self.last_initial + role[:1]) not in ("su", "ua", "au"):
                self.counts["illegal"] += 1
            self.last_initial = role[:1]
            self._step(initial, CUT_SHORT if fault == "truncated" else MUST_GO if fault else OK, role, text)

    def _step(self, initial: int, fault: int, role: str, text: str) -> None:
        number = self.steps.of(initial * 3 + fault, self.state)
        added, self.state, back = self.steps.steps[number]
        self.cost += added
        self.numbers.append(number)
        if len(self.numbers) >= self.block_rows:
            self._saved()
        texts, empty = [], []
        for end in range(4):
            if back[end] is None:
                texts.append(None)
                empty.append(True)
                continue
            begun, inserts, letter = back[end]
            if not inserts and letter == "D":
                texts.append(self.texts[begun])  # digests are never changed in place
                empty.append(self.empty[begun])
                continue
            told, state = [], begun
            for _ in range(inserts):
                state, who = NEXT[state]
                told.append(who + ":")
            if letter != "D":
                told.append((role if letter == "K" else NEXT[state][1]) + ":" + text)
            digest = self.texts[begun].copy()
            digest.update(("" if self.empty[begun] else "\n").encode() + "\n".join(told).encode())
            texts.append(digest)
            empty.append(False)
        self.texts, self.empty = tuple(texts), empty

    def result(self) -> tuple:
        cost, state, inserts = _ending(*self.state)
        digest = self.texts[state].copy()
        told, at = [], state
        for _ in range(inserts):
            at, who = NEXT[at]
            told.append(who + ":")
        if told:
            digest.update(("" if self.empty[state] else "\n").encode() + "\n".join(told).encode())
        pieces = [b"I" * inserts]
        for numbers in self._backwards():
            letters = bytearray()
            for number in reversed(numbers):
                begun, inserts, letter = self.steps.steps[number][2][state]
                letters += letter.encode() + b"I" * inserts
                state = begun
            letters.reverse()
            pieces.append(bytes(letters))
        audit = b"".join(reversed(pieces)).decode()
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (self.conv_id, gaps, *self.counts.values(), self.cost + cost, audit, digest.hexdigest())

    def _backwards(self) -> Iterator[array]:
        yield self.numbers
        for fs, path in reversed(self.blocks):
            with fs.open_input_stream(path) as saved:
                numbers = array("I")
                numbers.frombytes(saved.read())
            yield numbers
            fs.delete_file(path)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation of ``rows`` (as ``damaged`` or ``as_logged`` gives them): counts of faults, cheapest edits and repaired text's digest.

    NULL turns come first; rows of one turn are ordered by role and text.  NULL is a conversation of its own.
    Conversations whose rows were all dropped, or have none, give zeros, no edits and the digest of no text.  Equal
    rows are duplicates; extra columns are ignored; an empty table gives no rows.  A conversation is read by one task
    in batches, because its audit and its digest follow its order; memory is one batch, four digests and a bounded
    block of backpointers, and its audit of a letter a row.
    """
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(RESULT)])
    arrow, folder = to_arrow_schema(schema), scratch_path(rows.sparkSession, "repair")

    def told(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, now, done = _Steps(), None, []
        for batch in batches:
            for c, turn, role, text, copies, blank, ended, seen in zip(*[column.to_pylist() for column in batch.columns]):
                if now is None or c != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(c, steps, folder, block_rows)
                if copies:
                    now.row(turn, role, text, copies, blank, ended, seen)
            if done:
                yield told(done)
                done = []
        if now is not None:
            yield told([now.result()])

    ordered = _marked(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copies")
    return ordered.mapInArrow(streamed, schema)
