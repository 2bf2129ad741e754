"""Packing documents into sequences: best fit over a histogram of lengths, then slots by rank within length."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from agrimill.llm.common import field, ranked, stored
from agrimill.llm.tokens import default_path, encoder

CAPACITY = 1024
END_ID = 2


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit decreasing over counts: (number of sequences, [(length, how many in each)]) for each pattern.

    Sequences filled alike are one group. The items of a length go to the group with the least room that still holds one;
    a sequence that took one is then the tightest, so it takes all it can before the next is opened. The outcome equals
    placing the items one by one; the work depends on the number of lengths, not of items.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    full = []

    def put(room: int, count: int, pattern: list[tuple[int, int]]) -> None:
        if not count:
            return
        if room == 0:
            full.append((count, pattern))
            return
        if room not in groups:
            bisect.insort(rooms, room)
            groups[room] = []
        groups[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                count, pattern = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, count, pattern = capacity, left, []
            each = room // length
            whole = min(count, left // each)
            put(room - each * length, whole, [*pattern, (length, each)])
            left -= whole * each
            count -= whole
            if count and left and left < each:
                put(room - left * length, 1, [*pattern, (length, left)])
                left, count = 0, count - 1
            if pattern:
                put(room, count, pattern)
    return full + [g for room in rooms for g in groups[room]]


def slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Plan rows: length, first rank, last rank, first sequence, how many in a sequence, offset of the first of them."""
    rows, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for count, pattern in best_fit(histogram, capacity):
        offset = 0
        for length, each in pattern:
            rows.append((length, taken[length], taken[length] + count * each - 1, sequence, each, offset))
            taken[length] += count * each
            offset += length * each
        sequence += count
    return rows


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Pieces of every document: key, piece, start, length, ids_crc32, and with `keep_ids` the ids as 32-bit bytes.

    A document is its ids and the end id. One longer than `capacity` is cut into pieces of `capacity`, of which the first
    may be shorter. Null and empty texts have the end id alone.
    """
    path = path or default_path()
    kind = field(docs.schema, key)
    schema = T.StructType([
        T.StructField(kind.name, kind.dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * keep_ids)
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, ids in enumerate(tokens.encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                at, number = 0, 0
                while at < n:
                    to = at + ((n - at) % capacity or capacity)
                    part = ids[4 * at:4 * to]
                    rows.append(row), piece.append(number), start.append(at), length.append(to - at), crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
                    at, number = to, number + 1
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.binary())] * keep_ids, names=schema.names)

    return docs.select(F.col(key).alias(kind.name), F.col(text).cast("string").alias("_text")).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """`pieces` (a stored table with key, piece, length) with sequence_id and offset.

    Only the histogram of lengths reaches the driver: `capacity` counts at most. The plan has a few rows for each of its
    patterns, a number that follows the capacity and not the corpus, and is broadcast. Pieces take slots by their rank
    within their length, which is counted in runs dealt by hash, so that a hot length is no single task. Which of the
    pieces of a length gets which slot is free; repeated rows each get one. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(slots(histogram, capacity), "length long, _first long, _last long, _seq long, _each long, _off long")
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = F.xxhash64(F.col(key).cast("string"), "piece", "ids_crc32")
    numbered = ranked(pieces, ["length"], spread, [F.col(key), F.col("piece"), F.col("ids_crc32")], "_rank", parts)
    placed = numbered.join(F.broadcast(plan), (numbered["length"] == plan["length"]) & F.col("_rank").between(F.col("_first"), F.col("_last"))).drop(plan["length"])
    at = F.col("_rank") - F.col("_first")
    sequence = F.col("_seq") + F.floor(at / F.col("_each")).cast("long")
    offset = F.col("_off") + (at % F.col("_each")) * F.col("length")
    return placed.withColumn("sequence_id", sequence).withColumn("offset", offset.cast("long")).drop("_rank", "_first", "_last", "_seq", "_each", "_off")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Tokenize, cut and pack; see `token_pieces` and `pack`."""
    return pack(stored(token_pieces(docs, key, text, path, capacity, end_id, keep_ids), "pieces"), capacity, key)
