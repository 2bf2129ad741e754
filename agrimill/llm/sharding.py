"""Sharding by longest processing time: groups that stay together, largest first, to the least loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from agrimill.llm.common import hash128, ranked, slim, stored

# Groups above total / (shards * FINE) are at most shards * FINE, whatever the input.
FINE = 1000
# Other groups keep their exact size up to EXACT bytes. Above, which no group is below shards * FINE * EXACT bytes in all
# (6 GB for 24 shards), they are taken by the mean of the groups that share their BITS first binary digits.
EXACT, BITS = 1 << 18, 14
# So many groups of one size are placed by counting rather than one after the other; the outcome is the same.
BULK = 64


def longest_first(histogram: dict[int, int], shards: int) -> dict[int, list[tuple[int, int]]]:
    """Size -> (shard, how many of its groups) for sizes with their counts: largest first, each to the least loaded shard.

    Equal loads go to the lowest number. A shard takes its k-th group of a size at the load it then has, so the groups of a
    size go where the smallest of these loads are; many of them are placed at once by searching the load they fill up to.
    The outcome equals placing the groups one by one through the heap, and the work follows the number of sizes.
    """
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size in sorted(histogram, reverse=True):
        count, got = histogram[size], dict.fromkeys(range(shards), 0)
        if count > BULK and size > 0:
            # Groups that start below `low` are no more than `count`, those below `high` are more.
            low, high = heap[0][0], heap[0][0] + count * size + 1
            while high - low > 1:
                level = (low + high) // 2
                below = sum(-((load - level) // size) for load, _ in heap if load < level)
                low, high = (level, high) if below <= count else (low, level)
            for load, shard in heap:
                got[shard] = -((load - low) // size) if load < low else 0
            count -= sum(got.values())
            heap = [(load + got[shard] * size, shard) for load, shard in heap]
            heapq.heapify(heap)
        for _ in range(count):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            got[shard] += 1
        placed[size] = [(shard, n) for shard, n in got.items() if n]
    return placed


def place_groups(rows: DataFrame, shards: int) -> DataFrame:
    """`rows` (with ga, gb: a 128-bit group key, and size) with column `shard`.

    The driver sees sizes with their counts, no groups: at most EXACT sizes, shards * FINE large ones, and 8,192 for each
    doubling between. Groups take their place by their rank within their size, which is counted in runs dealt by hash, so
    that a hot size is no single task. Rows of large groups, of which there are at most shards * FINE, meet their shard by
    a broadcast; the rest by a shuffle join, in which no key is hot. A group larger than a fair share still stays whole.
    """
    spark = rows.sparkSession
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = stored(rows.groupBy("ga", "gb").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    size = F.col("size")
    large = size * shards * FINE > total
    step = F.expr(f"shiftleft(1L, greatest(0, length(bin(size)) - {BITS}))")
    groups = groups.withColumn("_large", large).withColumn("_class", F.when(large | (size <= EXACT), size).otherwise(size - size % step))
    # The size first: classes of large groups and rounded ones do not meet, as they are cut at one size.
    seen = groups.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect()
    # A class counts as its mean, which keeps the order of classes and is the size itself where nothing is rounded.
    placed = longest_first({r["size"] // r["n"]: r["n"] for r in seen}, shards)
    plan = []
    for r in seen:
        took, ends = placed[r["size"] // r["n"]], []
        for _, n in took:
            ends.append((ends[-1] if ends else 0) + n)
        plan.append((r["_class"], ends, [shard for shard, _ in took]))
    table = slim(stored(spark.createDataFrame(plan, "_class long, _ends array<long>, _shards array<int>"), "plan"))
    numbered = ranked(groups, ["_class"], F.xxhash64("ga", "gb"), [F.col("ga"), F.col("gb")], "_rank", parts)
    at = F.size(F.filter("_ends", lambda end: end <= F.col("_rank")))
    found = stored(numbered.join(table, "_class").select("ga", "gb", "_large", F.get("_shards", at).alias("shard")), "places")
    big, rest = (found.where(side).drop("_large") for side in (F.col("_large"), ~F.col("_large")))
    big = F.broadcast(big)
    return rows.join(big, ["ga", "gb"]).unionByName(rows.join(big, ["ga", "gb"], "left_anti").join(rest, ["ga", "gb"]))


def shard_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, overhead: int = 8) -> DataFrame:
    """Shard and slot of every row: key, size, text_crc32, ga, gb, shard, slot.

    Equal texts form a group and share a shard; all null texts form one group. Size is the text's UTF-8 bytes plus
    `overhead`. Slots run from 0 without gaps in every shard. Repeated rows each get a slot. An empty table gives an empty
    result. Only hashes and counts leave the scan: texts are not shuffled, and a hot group is summed before the shuffle.
    """
    parts = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = next(f for f in docs.schema.fields if f.name == key)
    t = F.col("_row._t").cast("string")
    rows = docs.select(F.struct(F.col(key).alias("_k"), F.col(text).alias("_t")).alias("_row")).select(
        F.col("_row._k").alias(kind.name),
        (F.octet_length(F.coalesce(t, F.lit(""))) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit(""))).alias("text_crc32"),
        hash128(t, t.isNull()).alias("_g"),
    ).select(kind.name, "size", "text_crc32", F.col("_g.a").alias("ga"), F.col("_g.b").alias("gb"))
    placed = stored(place_groups(stored(rows, "sizes"), shards), "placed")
    spread = F.xxhash64(F.col(kind.name).cast("string"), "ga")
    return ranked(placed, ["shard"], spread, [F.col(kind.name), F.col("ga"), F.col("gb")], "slot", parts)

