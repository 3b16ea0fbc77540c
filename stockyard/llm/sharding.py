"""Sharding by balanced label propagation.

Linked documents move towards one of the shards that hold their neighbours. A link joins documents of
one group (equal texts, say), so a document's neighbours are its group, and what a group needs to know
is how many of its documents each shard holds: the state that the iterations join and sum is
(group, shard, count), at most one row per shard for the largest group. Moves between shards are
exchanged in circles, which need no room, and then fill the room there is. Documents without links
fill the shards up to sizes at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockyard.llm.common import bits_for, stored, with_running_total

SHARDS = 8
# Iterations end when so many in a row have not brought groups closer together: one of either kind.
STALLED = 2


def _loads(parts: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in parts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _circle(wishes: list[list[int]], start: int) -> list[tuple[int, int]]:
    """The shortest way of wishes from a shard back to it, as pairs of shards, or nothing."""
    came, ahead = {}, [start]
    for at in ahead:
        for to, n in enumerate(wishes[at]):
            if n and to == start:
                way = [(at, to)]
                while at != start:
                    way.append((came[at], at))
                    at = came[at]
                return way
            if n and to not in came:
                came[to] = at
                ahead.append(to)
    return []


def exchanged(wishes: list[list[int]], loads: list[int], room: list[int]) -> list[list[int]]:
    """How many of the documents that want from one shard to another may move, none beyond its `room`.

    Circles come first, those of two shards before longer ones; then what room is left is filled, from
    shards that hold too many before others.
    """
    shards = len(room)
    left, loads = [list(row) for row in wishes], list(loads)

    def take(way: list[tuple[int, int]], n: int) -> None:
        for a, b in way:
            left[a][b] -= n
            loads[a] -= n
            loads[b] += n

    for a in range(shards):
        for b in range(a):
            take([(a, b), (b, a)], min(left[a][b], left[b][a]))
    for a in range(shards):
        while way := _circle(left, a):
            take(way, min(left[x][y] for x, y in way))
    # What is left has no circles, so room that moves make on their way comes to an end.
    while found := [(loads[a] - room[a], a, b) for a in range(shards) for b in range(shards) if left[a][b] and loads[b] < room[b]]:
        _, a, b = max(found)
        over = loads[a] - room[a]
        n = min(left[a][b], room[b] - loads[b])
        take([(a, b)], min(n, over) if over > 0 else n)
    return [[wishes[a][b] - left[a][b] for b in range(shards)] for a in range(shards)]


def propagate(parts: DataFrame, room: list[int], bits: int) -> DataFrame:
    """`parts` (key, shard, n) after moves that bring a group's documents together within `room`.

    Each iteration orders a group's parts, and all want to the first of them: by turns the largest part, or
    a larger one whose shard has room if there is one, and any part, by a hash that changes and also decides
    between equal ones. A group that no shard can hold always orders by size. Moves only go to shards that
    hold some of the group, so a group never has more parts than before.
    """
    shards, loads = len(room), _loads(parts, len(room))
    turn, stalled, least = 0, 0, None
    while True:
        by_hash = F.lit(turn % 2 == 1) & (F.col("size") <= min(room))
        own = parts.groupBy("key").agg(F.sum("n").alias("size"), F.collect_list(F.struct("n", "shard")).alias("all"))
        own = own.filter(F.size("all") > 1).withColumn("by_hash", by_hash)
        ordered = F.transform(
            "all",
            lambda x: F.struct(
                F.when(F.col("by_hash"), F.lit(0).cast("long")).otherwise(-x["n"]).alias("less"),
                F.xxhash64(F.col("key"), x["shard"], F.lit(turn)).alias("draw"),
                x["shard"].alias("shard"),
                x["n"].alias("n"),
            ),
        )
        own = own.select("key", "by_hash", F.array_sort(ordered).alias("all"))
        seen = own.select("key", "by_hash", "all", F.posexplode("all").alias("place", "part")).filter("place > 0")
        has_room = F.array(*[F.lit(used < r) for used, r in zip(loads, room, strict=True)])
        open_ = F.filter(F.slice("all", 1, F.col("place")), lambda x: ~F.col("by_hash") & F.get(has_room, x["shard"]))
        to = F.coalesce(F.get(open_, F.lit(0)), F.get("all", F.lit(0)))["shard"]
        wishes = seen.withColumn("to", to)
        wishes = stored(wishes.select("key", "part.shard", "to", "part.n"), "wishes")
        wanted, cut = [[0] * shards for _ in range(shards)], 0
        for r in wishes.groupBy("shard", "to").agg(F.sum("n").alias("n"), F.count("*").alias("parts")).collect():
            wanted[r["shard"]][r["to"]] = r["n"]
            cut += r["parts"]
        stalled = stalled + 1 if least is not None and cut >= least else 0
        if not cut or stalled == STALLED:
            return parts
        turn, least = turn + 1, cut
        quotas = exchanged(wanted, loads, room)
        if not any(map(any, quotas)):
            continue
        quota = F.get(F.array(*[F.lit(q) for row in quotas for q in row]), F.col("shard") * shards + F.col("to"))
        queued = with_running_total(wishes, ["shard", "to"], ["key"], F.col("n"), bits, "before")
        moved = F.greatest(F.lit(0), F.least("n", quota - F.col("before")))
        moves = queued.withColumn("moved", moved).filter("moved > 0")
        gone = F.struct("shard", (-F.col("moved")).alias("n"))
        come = F.struct(F.col("to").alias("shard"), F.col("moved").alias("n"))
        moves = moves.select("key", F.explode(F.array(gone, come)).alias("part")).select("key", "part.shard", "part.n")
        changed = parts.unionByName(moves).groupBy("key", "shard").agg(F.sum("n").alias("n"))
        parts = stored(changed.filter("n > 0"), "labels")
        loads = [loads[s] + sum(row[s] for row in quotas) - sum(quotas[s]) for s in range(shards)]


def sharded(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its shard and its slot there, by the law `rows`: counts at most one apart.

    Documents of equal text are linked. A null text counts as empty. Every row gets a place, repeated
    ones and those without an identifier too. Other columns are ignored; an empty table gives an empty
    result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )
    rows = stored(rows, "sharded-rows")
    scattered = F.pmod(F.xxhash64("doc_id", "key"), F.lit(shards)).cast("int")
    labelled = rows.groupBy("key", scattered.alias("shard")).agg(F.count("*").alias("n"))
    parts = stored(labelled, "labels")
    groups = stored(parts.groupBy("key").agg(F.sum("n").alias("size")), "groups")
    counted = groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("rows"), F.count("*").alias("groups")).first()
    total, bits = counted["rows"], bits_for(counted["groups"])
    room = [total // shards + (s < total % shards) for s in range(shards)]
    linked = parts.join(groups.filter("size > 1").select("key"), "key")
    linked = propagate(stored(linked, "labels"), room, bits)

    # What a shard cannot hold joins the documents without links; those fill the room that is left.
    rooms = F.array(*[F.lit(r) for r in room])
    queued = stored(with_running_total(linked, ["shard"], ["key"], F.col("n"), bits, "before"), "queued")
    stays = F.greatest(F.lit(0), F.least("n", F.get(rooms, F.col("shard")) - F.col("before")))
    held = queued.withColumn("stays", stays)
    settled = held.filter("stays > 0").select("key", "shard", F.col("stays").alias("n"), F.col("before").alias("slot"))
    over = held.filter("n > stays").select("key", (F.col("n") - F.col("stays")).alias("n"))
    over = over.groupBy("key").agg(F.sum("n").alias("n"))
    loads = _loads(settled, shards)
    free = [r - used for r, used in zip(room, loads, strict=True)]
    loose = groups.filter("size = 1").select("key", F.col("size").alias("n")).unionByName(over)
    loose = with_running_total(loose.withColumn("one", F.lit(0)), ["one"], ["key"], F.col("n"), bits, "before")
    ends = [sum(free[: s + 1]) for s in range(shards)]
    gaps = F.array(
        *[
            F.struct(F.lit(s).alias("shard"), F.lit(ends[s] - free[s]).alias("low"), F.lit(ends[s]).alias("high"), F.lit(loads[s]).alias("load"))
            for s in range(shards)
        ]
    )
    met = F.filter(gaps, lambda g: (g["low"] < F.col("before") + F.col("n")) & (g["high"] > F.col("before")))
    filling = loose.withColumn("gap", F.explode(met))
    low, high = F.greatest("before", "gap.low"), F.least(F.col("before") + F.col("n"), F.col("gap.high"))
    filled = filling.select("key", F.col("gap.shard").alias("shard"), (high - low).alias("n"), (F.col("gap.load") + low - F.col("gap.low")).alias("slot"))
    places = settled.unionByName(filled)
    # A group has at most two places in a shard, so this window stays small.
    upto = Window.partitionBy("key").orderBy("shard", "slot").rowsBetween(Window.unboundedPreceding, -1)
    places = places.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    places = places.withColumnRenamed("key", "of_key")

    ranked = with_running_total(rows, ["key"], ["doc_id"], F.lit(1), bits_for(total), "rank")
    here = (F.col("key") == F.col("of_key")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    return ranked.join(places, here).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
