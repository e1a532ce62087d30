"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

from crashlake.llm.common import store, text_of

#: The ring is cut into this many cells; sums of cells, never rows, reach the driver.
CELL_BITS = 14


def cell_owners(shards: int, vnodes: int, bits: int = CELL_BITS) -> list[int]:
    """Owner of every cell: the shard of the next virtual node clockwise.

    A virtual node sits where the md5 of "shard:number" puts it, so a node keeps its places
    when other shards come or go.
    """
    points = sorted((int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[:12], 16) >> (48 - bits), s)
                    for s in range(shards) for v in range(vnodes))
    places = [p for p, _ in points]
    return [points[bisect_left(places, c) % len(points)][1] for c in range(1 << bits)]


def fill(loads: dict[int, int], owners: list[int], shards: int, capacity: int) -> list[tuple]:
    """Stretches (cell, start byte, end byte, shard) that hold no shard above its capacity.

    First every cell goes to its owner as far as there is room, in the order of the ring;
    what is left over of a cell continues clockwise to the next shard that has room.
    """
    room, out, rest = [capacity] * shards, [], []
    for c in sorted(loads):
        s = owners[c]
        took = min(loads[c], room[s])
        room[s] -= took
        if took:
            out.append((c, 0, took, s))
        if took < loads[c]:
            rest.append((c, took))
    for c, done in rest:
        at = c
        while done < loads[c]:
            at = (at + 1) % len(owners)
            s = owners[at]
            took = min(loads[c] - done, room[s])
            if took:
                room[s] -= took
                out.append((c, done, done + took, s))
                done += took
    return out


def shard_ring(docs: DataFrame, shards: int = 24, vnodes: int = 256, slack: float = 0.002) -> DataFrame:
    """Put documents on a ring and give every shard at most (1 + slack) of the mean bytes.

    Returns doc_id, size (UTF-8 bytes and 8), text_crc32, shard and slot (gapless from 0 in
    each shard). A document starts where the sizes before it in its cell end; the shard that
    its first byte falls to takes it whole, so a shard exceeds its bound by less than one
    document. Place and order come from doc_id, size and text_crc32 alone.

    Equal rows are counted first and dealt out again at the end, each with a slot of its own.
    A null text counts as empty, a null doc_id is a key like any other; other columns are not
    read. An empty table gives no rows. Only the cells' sums reach the driver, ``2**CELL_BITS``
    rows however large the table.
    """
    spark = docs.sparkSession
    key = ["doc_id", "size", "text_crc32"]
    rows = docs.select("doc_id", (F.octet_length(text_of()) + 8).cast("long").alias("size"),
                       F.crc32(text_of()).alias("text_crc32"))
    rows = (rows.groupBy(*key).agg(F.count("*").alias("n"))
            .withColumn("pos", F.shiftrightunsigned(F.xxhash64(*key), 1))
            .withColumn("cell", F.shiftright("pos", 63 - CELL_BITS).cast("int")))
    rows = store(rows, "ring-rows")
    loads = {r[0]: r[1] for r in rows.groupBy("cell").agg(F.sum(F.col("n") * F.col("size"))).collect()}
    capacity = -(-sum(loads.values()) * (1000 + round(1000 * slack)) // (1000 * shards))
    stretches = fill(loads, cell_owners(shards, vnodes), shards, capacity)
    plan = spark.createDataFrame(stretches, "cell int, low long, high long, shard int")
    before = (Window.partitionBy("cell").orderBy("pos", *key)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows
              .withColumn("offset", F.coalesce(F.sum(F.col("n") * F.col("size")).over(before), F.lit(0)))
              .withColumn("rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
              .select(*key, "cell", (F.col("offset") + F.col("copy") * F.col("size")).alias("at"),
                      (F.col("rank") + F.col("copy")).alias("rank"))
              .join(plan, "cell").where("at >= low AND at < high"))
    placed = store(placed.select(*key, "cell", "low", "shard", "rank"), "ring-placed")
    bases = (placed.groupBy("shard", "cell", "low").agg(F.count("*").alias("rows"), F.min("rank").alias("first"))
             .withColumn("base", F.coalesce(F.sum("rows").over(
                 Window.partitionBy("shard").orderBy("cell", "low")
                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop("rows"))
    return (placed.join(bases, ["shard", "cell", "low"])
            .select(*key, "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot")))
