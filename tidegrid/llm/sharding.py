"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of bins. Every shard owns some bins' ends as virtual nodes, and the home
of a bin is the shard of the next virtual node clockwise. A shard takes at most ``load`` times the
mean bytes. Within a bin, rows stand in the order of their hash; what a full home shard cannot
take goes on clockwise to the next virtual node of a shard with room. So sizes are near equal
(the bound, but for half a row where a range ends), and a row moves only if its arc changes owner
or an overflow shifts.

Only bytes and rows of each bin reach the driver (a fixed number of bins), which walks the ring and
returns, for each bin, byte ranges with their shards; rows look their range up by their running
bytes inside the bin. Rows that are equal in key, size and checksum are placed as one counted unit,
so no bin has to hold a hot group row by row. Everything on the path is DataFrame or SQL functions.

Defined results: a null text has size 8 and checksum 0 like an empty one; null keys take part like
any key; repeated rows are placed one by one, each with its own slot; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.storage import staged

BINS = 1 << 14
VIRTUAL_NODES = 64
LOAD = 1.001
OVERHEAD = 8


class Range(NamedTuple):
    """Rows of a bin whose middle byte lies in [low, high) go to the shard."""

    bin: int
    low: int
    high: int
    shard: int


def ring(shards: int, nodes: int = VIRTUAL_NODES, bins: int = BINS) -> list[int]:
    """The home shard of every bin. A virtual node keeps its place whatever the number of shards."""
    if shards * nodes > bins // 4:
        raise ValueError("more virtual nodes than the ring has room for")
    place: dict[int, tuple[bytes, int]] = {}
    for shard in range(shards):
        for node in range(nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=16).digest()
            at = int.from_bytes(digest[:8]) % bins
            place[at] = min(place.get(at, (digest, shard)), (digest, shard))
    homes = [0] * bins
    owner = place[min(place)][1]
    for at in range(bins - 1, -1, -1):
        owner = place[at][1] if at in place else owner
        homes[at] = owner
    return homes


def walk(loads: dict[int, int], homes: list[int], shards: int, load: float) -> list[Range]:
    """Byte ranges of every bin with their shards, none over ``load`` times the mean."""
    total = sum(loads.values())
    room = [-(-int(total * load * 1_000_000) // (shards * 1_000_000)) + 1] * shards
    ranges, over = [], []
    for b in sorted(loads):
        home, size = homes[b], loads[b]
        taken = min(size, room[home])
        room[home] -= taken
        if taken:
            ranges.append(Range(b, 0, taken, home))
        if taken < size:
            over.append((b, taken))
    # arcs clockwise, linked past those whose shard is full
    starts = [b for b in range(len(homes)) if homes[b] != homes[b - 1]] or [0]
    arc_of = {}
    at = len(starts) - 1
    for b in range(len(homes)):
        if at + 1 < len(starts) and starts[at + 1] == b or b == starts[0]:
            at = 0 if b == starts[0] else at + 1
        arc_of[b] = at
    after = list(range(len(starts)))

    def spare(i: int) -> int:
        path = []
        while room[homes[starts[i]]] <= 0 or after[i] != i:
            path.append(i)
            after[i] = after[i] if after[i] != i else (i + 1) % len(starts)
            i = after[i]
        for p in path:
            after[p] = i
        return i

    for b, low in over:
        while low < loads[b]:
            arc = spare((arc_of[b] + 1) % len(starts))
            shard = homes[starts[arc]]
            taken = min(loads[b] - low, room[shard])
            room[shard] -= taken
            ranges.append(Range(b, low, low + taken, shard))
            low += taken
    return ranges


def assign_shards(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", load: float = LOAD, nodes: int = VIRTUAL_NODES
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` for every row; slots count from 0 in each shard."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(
        F.col(key), (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    units = rows.groupBy(key, "size", "text_crc32").agg(F.count("*").alias("copies"))
    spot = F.xxhash64(F.col(key), "text_crc32", "size")
    units = staged(units.withColumn("spot", spot).withColumn("bin", F.pmod("spot", F.lit(BINS)).cast("int")))

    loads = {r["bin"]: r["bytes"] for r in units.groupBy("bin").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")).collect()}
    ranges = walk(loads, ring(shards, nodes), shards, load)
    table = spark.createDataFrame([tuple(r) for r in ranges], "bin int, low long, high long, shard int")
    per_bin = table.groupBy("bin").agg(F.array_sort(F.collect_list(F.struct("low", "high", "shard"))).alias("ranges"))

    order = Window.partitionBy("bin").orderBy("spot", key, "text_crc32", "size")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = units.select(
        "*",
        F.coalesce(F.sum(F.col("size") * F.col("copies")).over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("copies").over(before), F.lit(0)).alias("rows_before"),
    )
    # at most BINS rows, one for each bin
    each = placed.join(F.broadcast(per_bin), "bin").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    twice = 2 * (F.col("bytes_before") + F.col("copy") * F.col("size")) + F.col("size")
    each = each.withColumn("twice", twice).withColumn("row", F.col("rows_before") + F.col("copy"))
    found = F.filter("ranges", lambda r: (2 * r["low"] <= F.col("twice")) & (F.col("twice") < 2 * r["high"]))[0]
    each = staged(
        each.select(key, "size", "text_crc32", "bin", "row", found["shard"].alias("shard"), found["low"].alias("low"))
    )
    # rows of a range follow each other in their bin, so a slot is an offset of the range plus a difference
    spans = each.groupBy("shard", "bin", "low").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("bin", "low").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).drop("n", "first")
    # at most as many rows as ranges: each range ends a bin or fills a shard
    return each.join(F.broadcast(offsets), ["shard", "bin", "low"]).select(
        key, "size", "text_crc32", "shard", (F.col("offset") + F.col("row")).alias("slot")
    )
