"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Law ``rows``: at the end the shards' row counts differ by one at most.  All steps are
DataFrame joins and aggregations on (id, size, hash) rows; texts are read once.

The labels are wishes.  Groups of equal texts are then placed as wholes: the large ones (at most
``shards * LARGE``) are packed one by one, the small ones follow in the order of their labels, and
unlinked rows make way: they fill what the groups leave free.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.columns import numbered
from sievework.session import through_storage

ROUNDS = 4
#: A group of over 1 / LARGE of a shard is packed by itself.
LARGE = 64
#: Places in the order of rows: large groups that share a shard with others have its number; behind them come the
#: large groups that are cut, one place each, then small groups, then unlinked rows.
_SMALL, _SINGLE = 1 << 30, (1 << 30) + 1


def _bucket(c: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def text_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between equal texts: every document and the smallest node of its text, never all pairs."""
    hubs = nodes.groupBy("fingerprint").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (nodes.join(hubs, "fingerprint").where("node <> b").select(F.col("node").alias("a"), "b"))


def _quotas(requests: dict[tuple[int, int], int], load: list[int], room: int) -> dict[tuple[int, int], int]:
    """How many of the requested moves each pair of shards may make; no shard ends above ``room``.

    Opposite requests are exchanged first; what is left fills free room, then room that
    accepted moves have opened.  The tables have one cell per pair of shards.
    """
    granted = {p: min(n, requests.get((p[1], p[0]), 0)) for p, n in requests.items()}
    load = list(load)
    moved = True
    while moved:
        moved = False
        for (i, j), n in sorted(requests.items(), key=lambda x: -x[1]):
            more = min(n - granted[i, j], max(0, room - load[j]))
            if more > 0:
                granted[i, j] += more
                load[i], load[j], moved = load[i] - more, load[j] + more, True
    return granted


def propagate(nodes: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS, slack: float = 0.25) -> DataFrame:
    """(node, label): labels after ``rounds`` rounds of moves towards the most frequent label among neighbours.

    Nodes without links keep their first label.  In each round a node asks for the label that
    most of its neighbours have (the smallest of equals); in even rounds only neighbours with
    smaller ids count, so that two linked nodes do not swap places for ever.  Requests are counted per pair of
    shards, quotas are set from the counts, and the requests with the smallest hashes are
    granted: cuts on a 1,024-step histogram of the hash, so no list is ranked in one task.
    """
    labels = nodes.select("node", _bucket(F.col("node"), shards).alias("label"))
    both = through_storage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    total = nodes.count()
    room = int(total / shards * (1 + slack)) + 1
    for k in range(rounds):
        heard = both.where("b < a") if k % 2 == 0 else both
        # Votes are counted per (node, label) first, so a hub with many links is summed in parts.
        votes = (heard.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a", "label").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("a").agg(F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("best"))
                 .select(F.col("a").alias("node"), (-F.col("best.l")).alias("wish")))
        step = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1024)).cast("int")
        state = through_storage(labels.join(votes, "node", "left").withColumn("step", step), "labels")
        asked = (state.where("wish <> label").groupBy("label", "wish", "step").agg(F.count(F.lit(1)).alias("n"))
                 .collect())  # at most shards * shards * 1,024 counts
        load = {r["label"]: r["n"] for r in state.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        requests: dict[tuple[int, int], int] = {}
        for r in asked:
            requests[r["label"], r["wish"]] = requests.get((r["label"], r["wish"]), 0) + r["n"]
        granted = _quotas(requests, [load.get(i, 0) for i in range(shards)], room)
        upto = [-1] * (shards * shards)
        for i, j in requests:
            so_far = 0
            for s, n in sorted((r["step"], r["n"]) for r in asked if (r["label"], r["wish"]) == (i, j)):
                so_far += n
                if so_far > granted[i, j]:
                    break
                upto[i * shards + j] = s
        allowed = F.array(*[F.lit(x) for x in upto])[F.col("label") * shards + F.col("wish")]
        labels = state.select("node", F.when(F.col("wish").isNotNull() & (F.col("step") <= allowed), F.col("wish"))
                              .otherwise(F.col("label")).alias("label"))
    return through_storage(labels, "labels-final")


def _packed(sizes: list[int], wishes: list[int | None], room: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, rows) pieces of every group, the sizes descending; one piece wherever one shard has room for all of it.

    A group that no shard can take fills the shards with most room, so that it ends in as few as possible.
    """
    room, out = list(room), []
    for n, wish in zip(sizes, wishes):
        pieces, left = [], n
        while left:
            fits = [i for i, r in enumerate(room) if r >= left and i not in [x for x, _ in pieces]]
            if fits:
                to = wish if wish in fits and not pieces else min(fits, key=lambda i: (room[i], i))
            else:
                to = max(range(len(room)), key=lambda i: (room[i], -i))
            take = min(left, room[to])
            pieces.append((to, take))
            room[to], left = room[to] - take, left - take
        out.append(pieces)
    return out


def _pack(sizes: list[int], wishes: list[int], room: list[int]) -> list[list[tuple[int, int]]]:
    """The packing with the wished shards, or the tightest one if that cuts fewer groups."""
    both = [_packed(sizes, w, room) for w in (wishes, [None] * len(sizes))]
    return min(both, key=lambda pieces: sum(map(len, pieces)))


def _lookup(rank: Column, intervals: list[tuple[int, int, int]]) -> Column:
    """Struct (shard, slot) of a rank by (first rank, shard, first slot) intervals: a tree of comparisons."""
    if len(intervals) == 1:
        first, shard, slot = intervals[0]
        return F.struct(F.lit(shard).cast("int").alias("shard"), (rank - F.lit(first) + F.lit(slot)).cast("long").alias("slot"))
    half = len(intervals) // 2
    return F.when(rank < F.lit(intervals[half][0]), _lookup(rank, intervals[:half])).otherwise(_lookup(rank, intervals[half:]))


def _ends(room: list[int], rows: int, singles: int, first: int, groups: DataFrame) -> list[int]:
    """How many of the ``rows`` of small groups lie in the shards up to each one; a cut moves behind the group it would part.

    ``groups`` has lo (first rank) and n.  Every shard holds back its share of room for unlinked
    rows, so that there is room for the rest of a group.
    """
    spare, nominal = singles // len(room), []
    for r in room:
        nominal.append(min(rows, (nominal[-1] if nominal else 0) + r - min(r, spare)))
    cuts = sorted({x for x in nominal if 0 < x < rows})
    parted = groups.where(reduce(lambda a, b: a | b, [(F.col("lo") < first + c) & (F.col("lo") + F.col("n") > first + c) for c in cuts],
                                 F.lit(False))).collect() if cuts else []  # one group per cut at most
    ends, start = [], 0
    for r, x in zip(room, nominal):
        behind = next((g["lo"] + g["n"] - first for g in parted if g["lo"] < first + x < g["lo"] + g["n"]), x)
        start = max(start, min(behind, start + r))
        ends.append(start)
    return ends


def shard_rows(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Needs doc_id and text.  NULL text counts as empty; NULL or repeated ids and repeated rows
    keep one row each; extra columns are not read; an empty table gives an empty result.
    A group of equal texts is cut where no shard has room for all of it beside the larger ones,
    and then into as few shards as have the room.  A small group (up to 1 / ``LARGE`` of a shard) is
    cut only at one of ``shards - 1`` borders, and only where unlinked rows are too few to make way.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("h1"),
                        F.hash(text).alias("h2"))
    facts = through_storage(facts.select("doc_id", "size", "text_crc32", F.struct("size", "text_crc32", "h1", "h2").alias("fingerprint"),
                                         F.monotonically_increasing_id().alias("node")), "shard-facts")
    labels = propagate(facts, text_links(facts), shards, rounds)
    n = facts.count()
    room = [-(-(s + 1) * n // shards) + (-s * n // shards) for s in range(shards)]  # row counts of the shards

    by_label = (facts.join(labels, "node").groupBy("fingerprint", "label").agg(F.count(F.lit(1)).alias("k"))
                .groupBy("fingerprint").agg(F.sum("k").alias("n"), F.max(F.struct("k", (-F.col("label")).alias("l"))).alias("best")))
    groups = through_storage(by_label.where("n > 1").select("fingerprint", "n", (-F.col("best.l")).alias("wish")), "shard-groups")
    large = (groups.where(F.col("n") * (shards * LARGE) > n).orderBy(F.desc("n"), "fingerprint").collect())  # at most shards * LARGE rows
    pieces = _pack([g["n"] for g in large], [g["wish"] for g in large], room)
    places, cut = [], []
    for g, parts in zip(large, pieces):
        places.append((g["fingerprint"], parts[0][0] if len(parts) == 1 else shards + len(cut)))
        cut += [parts] if len(parts) > 1 else []
    intervals, rank, used = [], 0, [0] * shards

    def give(shard: int, rows: int) -> None:
        nonlocal rank
        if rows:
            intervals.append((rank, shard, used[shard]))
            rank, used[shard] = rank + rows, used[shard] + rows

    for s in range(shards):
        give(s, sum(parts[0][1] for parts in pieces if len(parts) == 1 and parts[0][0] == s))
    for parts in cut:
        for s, rows in parts:
            give(s, rows)
    known = docs.sparkSession.createDataFrame(places, facts.select("fingerprint").schema.add("place", T.IntegerType()))
    placed = facts.join(groups.join(known, "fingerprint", "left"), "fingerprint", "left").select(
        "doc_id", "size", "text_crc32", "fingerprint", "node", F.col("n").isNotNull().alias("linked"), "wish",
        F.coalesce("place", F.when(F.col("n").isNotNull(), F.lit(_SMALL)).otherwise(F.lit(_SINGLE))).alias("place"))
    ranked = numbered(placed, ["place", "wish", "fingerprint", "doc_id", "node"], "rank", "shard-order")
    small = ranked.where(F.col("place") == _SMALL).groupBy("fingerprint").agg(F.min("rank").alias("lo"), F.count(F.lit(1)).alias("n"))
    sums = groups.join(known, "fingerprint", "left").where("place is null").agg(F.sum("n").alias("n")).first()
    rows, free = sums["n"] or 0, [r - u for r, u in zip(room, used)]
    ends = _ends(free, rows, n - rank - rows, rank, small)
    for s, (a, b) in enumerate(zip([0, *ends], ends)):
        give(s, b - a)
    for s in range(shards):
        give(s, room[s] - used[s])
    return (ranked.withColumn("at", _lookup(F.col("rank"), intervals or [(0, 0, 0)]))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("at.shard").alias("shard"),
                    F.col("at.slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
