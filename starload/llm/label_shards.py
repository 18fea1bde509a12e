"""Shards of equal size that keep linked documents together, by balanced label propagation.

Documents with equal texts are linked. Every document has a label, its shard, at first drawn by
hash. In a round each group of linked documents leans towards the shard where most of its
members are, and members elsewhere ask to move there; the moves between each two shards are
granted up to quotas, which are planned so that no shard ends above its capacity. A granted
move only ever goes from fewer neighbours to as many or more, so the links that are cut become
fewer with every round and the rounds end.

Members of a group that are in one shard have the same neighbours and the same wishes. So a
group is one row with the number of its members in each shard, however many there are; its
links, a square of its size, are never written out. A round joins the groups with the granted
shares, a table of `shards` x 1024 rows, and writes them anew.

At the end members are dealt to their group's numbers and each shard's members are numbered,
group by group. Rounds let shards grow a little beyond their size, as that lets groups gather;
what is numbered beyond it, whole groups but for the first and last, and all documents that have no
links fill up what room is left: counts of shards differ by one at most, whatever the groups. All
numbering is done in pieces of bounded size, each of which starts where those before it end.

Everything is done with DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import power_of_two, text_of
from starload.session import stored

_BUCKETS = 1024  # parts of the groups, in whose order moves are granted
_PIECES = 4096  # parts of a group, in which its members are numbered
_BEFORE = (Window.unboundedPreceding, -1)


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def plan_quotas(
    asked: Sequence[Sequence[int]], load: Sequence[int], capacity: Sequence[int]
) -> list[list[int]]:
    """How many of the moves asked for, from shard to shard, can be made at once so that no shard
    that gets any ends above its capacity but by a rounding: the moves into a shard that would be
    too full are cut in proportion, again and again, as each cut leaves more in the shards they
    come from."""
    granted = [list(map(float, row)) for row in asked]
    shards = range(len(load))
    while True:
        cut = False
        for to in shards:
            coming = sum(granted[i][to] for i in shards)
            room = max(0.0, capacity[to] - load[to] + sum(granted[to]))
            if coming > room + 0.5:
                cut = True
                for i in shards:
                    granted[i][to] *= room / coming
        if not cut:
            break
    # Rounded along each target's column, so that the many small ones add up to what they are.
    whole = [[0] * len(load) for _ in shards]
    for to in shards:
        given = sofar = 0.0
        for i in shards:
            sofar += granted[i][to]
            whole[i][to] = min(asked[i][to], int(sofar - given + 1e-6))
            given += whole[i][to]
    return whole


def _wishes(groups: DataFrame, shards: int, into: Sequence[int], turn: int) -> DataFrame:
    """Groups with the shard they lean `to`, of those `into`, the members in each shard that
    `want` to move there, and the `bucket` in whose order wishes are granted in this turn. Ties
    go to the shard that comes first counted from one that the group's hash names."""
    place = F.xxhash64("digest")
    ranked = [
        (F.col("held")[s] * shards + F.pmod(place + s, F.lit(shards))) * shards + s for s in into
    ]
    best = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    # The explode of one element makes the number a column that is worked out once.
    leaning = groups.select("digest", "held", F.explode(F.array(best)).alias("best"))
    to = F.pmod("best", F.lit(shards)).cast("int")
    most = F.call_function("div", F.col("best"), F.lit(shards * shards))
    none = F.lit(0).cast("long")
    want = [
        F.when((to != s) & (F.col("held")[s] <= most), F.col("held")[s]).otherwise(none)
        for s in range(shards)
    ]
    return leaning.select(
        "digest", "held", F.array(*want).alias("want"), to.alias("to"),
        F.pmod(F.xxhash64("digest", F.lit(turn)), F.lit(_BUCKETS)).cast("int").alias("bucket"),
    )


def _columns(array: str, shards: int, function=F.sum) -> list[Column]:
    return [function(F.col(array)[s]).alias(f"s{s}") for s in range(shards)]


def _load(groups: DataFrame, shards: int) -> list[int]:
    return [n or 0 for n in groups.agg(*_columns("held", shards)).first()]


def _round(
    groups: DataFrame, shards: int, into: Sequence[int], turn: int, load: Sequence[int],
    capacity: Sequence[int],
) -> tuple[DataFrame, int]:
    """The groups after one round, and how many members it moved at most."""
    wishes = _wishes(groups, shards, into, turn)
    # A row for each shard and bucket at most.
    demand = stored(wishes.groupBy("to", "bucket").agg(*_columns("want", shards)), "demand")
    totals = demand.groupBy("to").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(shards)])
    asked = [[0] * shards for _ in range(shards)]
    for row in totals.collect():
        for s in range(shards):
            asked[s][row["to"]] = row[f"s{s}"]
    granted = plan_quotas(asked, load, capacity)
    moved = sum(map(sum, granted))
    if not moved:
        return groups, 0
    before = Window.partitionBy("to").orderBy("bucket").rowsBetween(*_BEFORE)
    by_target = F.array(*[F.array(*[F.lit(granted[s][t]) for s in range(shards)]) for t in range(shards)])

    def share(s: int) -> Column:
        """Of what a bucket asks from shard `s`; the last bucket that is granted any gets a part."""
        left = by_target[F.col("to")][s] - F.coalesce(F.sum(f"s{s}").over(before), F.lit(0))
        return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), left / F.nullif(f"s{s}", F.lit(0)))), F.lit(0.0))

    shares = demand.select("to", "bucket", F.array(*[share(s) for s in range(shards)]).alias("share"))
    # `shards` x 1024 rows at most, whatever the input: safe to broadcast.
    met = wishes.join(F.broadcast(shares), ["to", "bucket"])
    gone = [F.floor(F.col("want")[s] * F.col("share")[s]) for s in range(shards)]
    met = met.select("digest", "held", "to", F.explode(F.array(F.array(*gone))).alias("gone"))
    come = reduce(lambda a, b: a + b, [F.col("gone")[s] for s in range(shards)])
    held = [
        F.col("held")[s] - F.col("gone")[s] + F.when(F.col("to") == s, come).otherwise(F.lit(0).cast("long"))
        for s in range(shards)
    ]
    return stored(met.select("digest", F.array(*held).alias("held")), "groups"), moved


def propagate(
    groups: DataFrame, shards: int, capacity: Sequence[int], least_moved: float = 0.001
) -> DataFrame:
    """Groups (digest, `held`: members in each shard) after as many rounds as move more than
    `least_moved` of all members.

    There are rounds of two kinds, each repeated until it moves no more: in one, groups lean
    towards any shard, and members change places; in the other, only towards shards that have a
    hundredth of their capacity left, so that groups whose shard is full gather elsewhere.
    """
    load = _load(groups, shards)
    linked = sum(load)
    anywhere, turn, idle = True, 0, 0
    while linked and idle < 2:
        roomy = [s for s in range(shards) if capacity[s] - load[s] > capacity[s] / 100]
        into = list(range(shards)) if anywhere else roomy
        moved = 0
        if into:
            groups, moved = _round(groups, shards, into, turn, load, capacity)
        if moved:
            load = _load(groups, shards)
        if moved > least_moved * linked:
            idle = 0
        else:
            idle, anywhere = idle + 1, not anywhere
        turn += 1
    return groups


def _numbered_cells(groups: DataFrame, shards: int, rows_per_piece: int) -> DataFrame:
    """digest and `cells`: for each shard with members of the group, how many, and the number in
    the shard of the first of them."""
    pieces = power_of_two(-(-groups.count() // rows_per_piece))
    cut = groups.withColumn("piece", F.pmod(F.xxhash64("digest"), F.lit(pieces)))
    sizes = cut.groupBy("piece").agg(*_columns("held", shards))
    # One row for `rows_per_piece` groups.
    before = Window.orderBy("piece").rowsBetween(*_BEFORE)
    starts = stored(
        sizes.select(
            "piece", F.array(*[F.coalesce(F.sum(f"s{s}").over(before), F.lit(0)) for s in range(shards)]).alias("start")
        ),
        "starts",
    )
    within = Window.partitionBy("piece").orderBy("digest").rowsBetween(*_BEFORE)
    running = F.array(*[F.coalesce(F.sum(F.col("held")[s]).over(within), F.lit(0)) for s in range(shards)])
    cells = F.transform(
        "held",
        lambda n, s: F.struct(
            s.alias("shard"), n.alias("size"),
            (F.get("start", s) + F.get("running", s)).alias("first"),
        ),
    )
    return cut.withColumn("running", running).join(starts, "piece").select(
        "digest", F.filter(cells, lambda cell: cell["size"] > 0).alias("cells")
    )


def _place_of(rank: Column, cells: str) -> Column:
    """shard and number of the member of that rank in its group: those of a cell follow each other."""
    nowhere = F.struct(
        rank.alias("left"), F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("number")
    )

    def step(found: Column, cell: Column) -> Column:
        here = found["shard"].isNull() & (found["left"] < cell["size"])
        return F.struct(
            (found["left"] - F.when(found["shard"].isNull(), cell["size"]).otherwise(0)).alias("left"),
            F.when(here, cell["shard"]).otherwise(found["shard"]).alias("shard"),
            F.when(here, cell["first"] + found["left"]).otherwise(found["number"]).alias("number"),
        )

    return F.aggregate(cells, nowhere, step)


def _choose(values: Sequence[int], at: Column) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])[at]


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_moved: float = 0.001,
    slack: float = 0.03,
    rows_per_piece: int = 50_000,
) -> DataFrame:
    """One row per row of `docs`: id, `size` (bytes of the text, plus 1), `text_crc32`, `linked`
    (rows with its text, itself included), `shard` and `slot`.

    The numbers of rows of any two shards differ by one at most, and a shard's slots count from
    zero without gaps. Rows with equal texts share a shard as far as that allows; a group with
    more rows than a shard holds fills as few shards as there was room for. A null text counts as
    empty. Ids are only carried along, so null and repeated ones are rows like any other. An
    empty table gives an empty result; other columns are ignored.

    Rounds end when two of them move no more than `least_moved` of the linked rows, and let shards
    grow by `slack` beyond their size.
    """
    if shards < 1:
        raise ValueError("there must be a shard at least")
    text = text_of(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("crc"), F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    total = rows.count()
    capacity = capacities(total, shards)
    label = F.pmod(F.xxhash64("id", "digest"), F.lit(shards))
    counted = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(label == s).alias(f"s{s}") for s in range(shards)]
    )
    held = F.array(*[f"s{s}" for s in range(shards)])
    groups = stored(counted.filter("n > 1").select("digest", held.alias("held")), "groups")
    roomy = [math.ceil(c * (1 + slack)) for c in capacity]
    groups = propagate(groups, shards, roomy, least_moved)
    load = _load(groups, shards)

    # Members are numbered in pieces of their group; of a small group most are in one each.
    rows = rows.withColumn("piece", F.pmod("row", F.lit(_PIECES)))
    sizes = rows.groupBy("digest", "piece").agg(F.count(F.lit(1)).alias("size"))
    of_group = Window.partitionBy("digest")
    pieces = sizes.select(
        "digest", "piece", F.sum("size").over(of_group).alias("linked"),
        F.coalesce(F.sum("size").over(of_group.orderBy("piece").rowsBetween(*_BEFORE)), F.lit(0)).alias("start"),
    ).filter("linked > 1")
    pieces = pieces.join(_numbered_cells(groups, shards, rows_per_piece), "digest")
    of_piece = Window.partitionBy("digest", "piece").orderBy("row")
    met = rows.join(pieces, ["digest", "piece"], "left").withColumn(
        "rank", F.col("start") + F.row_number().over(of_piece) - 1
    )
    placed = met.withColumn("place", F.when(F.col("linked").isNotNull(), _place_of(F.col("rank"), "cells")))
    placed = stored(
        placed.select("id", "size", "crc", "row", "linked", "place.shard", "place.number"), "places"
    )

    # Who stays where it is, and the others in a line: members beyond the capacity of their
    # shard, then documents without links, in an order that their hash draws.
    beyond = [max(0, n - c) for n, c in zip(load, capacity, strict=True)]
    waiting_before = [sum(beyond[:s]) for s in range(shards)]
    stays = placed.filter(F.col("number") < _choose(capacity, F.col("shard")))
    stays = stays.withColumnRenamed("number", "slot")
    over = placed.filter(F.col("number") >= _choose(capacity, F.col("shard"))).withColumn(
        "line", _choose(waiting_before, F.col("shard")) + F.col("number") - _choose(capacity, F.col("shard"))
    )
    chunks = power_of_two(-(-total // rows_per_piece))
    alone = placed.filter(F.col("shard").isNull()).withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    in_chunk = F.row_number().over(Window.partitionBy("chunk").orderBy(F.xxhash64("row", F.lit(1)), "row"))
    chunk_sizes = alone.groupBy("chunk").agg(F.count(F.lit(1)).alias("many"))
    # One row for `rows_per_piece` documents.
    starts = stored(
        chunk_sizes.select(
            "chunk",
            F.coalesce(F.sum("many").over(Window.orderBy("chunk").rowsBetween(*_BEFORE)), F.lit(0)).alias("start"),
        ),
        "starts",
    )
    alone = alone.withColumn("nth", in_chunk).join(starts, "chunk").withColumn(
        "line", F.lit(sum(beyond)) + F.col("start") + F.col("nth") - 1
    )
    room = [max(0, c - n) for n, c in zip(load, capacity, strict=True)]
    room_before = [sum(room[:s]) for s in range(shards)]
    target = F.lit(None).cast("int")
    for s in reversed(range(shards)):
        target = F.when(F.col("line") < room_before[s] + room[s], F.lit(s)).otherwise(target)
    columns = ["id", "size", "crc", "linked", "line"]
    filled = over.select(*columns).unionByName(alone.select(*columns)).withColumn("shard", target)
    filled = filled.withColumn(
        "slot", _choose(load, F.col("shard")) + F.col("line") - _choose(room_before, F.col("shard"))
    )
    result = ["id", "size", "crc", "linked", "shard", "slot"]
    both = stays.select(*result).unionByName(filled.select(*result))
    return both.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.coalesce("linked", F.lit(1)).cast("long").alias("linked"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
    )
