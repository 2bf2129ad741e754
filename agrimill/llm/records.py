"""Token ids in length-delimited binary records with masked checksums and an offset index beside each file."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from agrimill.llm import files
from agrimill.llm.common import shared_path, stored
from agrimill.llm.tokens import default_path, encoder

END_ID = 0
# Bytes of ids that a reading task is given.
READ_BYTES = 1 << 25
# Fixed values of the frame: length, its checksum, payload, its checksum; checksums are rotated by 15 bits and shifted.
LENGTH, CHECK, MASK_SHIFT = "<Q", "<I", 0xA282EAD8
# A payload begins with the document's id, whether it has one, and the bytes of an id; then the ids follow.
HEAD = "<qBB"
HEAD_SIZE = struct.calcsize(HEAD)
OVERHEAD = 16 + HEAD_SIZE


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_SHIFT) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload))))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """Payload of the record at a place, and the place after it; a wrong checksum raises."""
    length = data[at:at + 8]
    if len(length) < 8 or masked(length) != struct.unpack_from(CHECK, data, at + 8)[0]:
        raise ValueError(f"broken length at byte {at}")
    end = at + 12 + struct.unpack(LENGTH, length)[0]
    payload = data[at + 12:end]
    if len(data) < end + 4 or masked(payload) != struct.unpack_from(CHECK, data, end)[0]:
        raise ValueError(f"broken record at byte {at}")
    return payload, end + 4


def write_records(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write every text's ids and the end id in ascending order of the key; returns the stored list of files.

    Columns: part, file, index, records, tokens, width. Keys are integers; null keys come last, ties are in order of the
    text. Ids take two bytes where the vocabulary allows, else four. The index beside a file holds where each
    record begins, as unsigned 64-bit numbers. The table is dealt by ranges of the key, one file for each; a task that is
    run again writes another file, and the list names the one whose task was committed.
    """
    spark = docs.sparkSession
    path = path or default_path()
    folder = folder or shared_path(spark, "records")
    files.make_folder(folder)
    if end_id >= 1 << 32:
        raise ValueError("ids have 32 bits at most")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = encoder(path), TaskContext.get().partitionId()
        narrow = max(tokens.size, end_id + 1) <= 1 << 16
        width, end = (2, np.array([end_id], "<u2").tobytes()) if narrow else (4, np.array([end_id], "<u4").tobytes())
        name = files.new_name(folder, part, ".rec")
        out, at, offsets, n = None, 0, [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for k, ids in zip(keys, tokens.encode(batch.column(1).to_pylist())):
                if out is None:
                    store, local = files.opened(name)
                    out = store.open_output_stream(local)
                body = np.frombuffer(ids, "<u4").astype("<u2").tobytes() if narrow else ids
                record = frame(b"".join((struct.pack(HEAD, k or 0, k is not None, width), body, end)))
                out.write(record)
                offsets.append(at)
                at += len(record)
                n += len(ids) // 4 + 1
        if out is None:
            return
        out.close()
        with store.open_output_stream(local + ".idx") as index:
            index.write(np.array([*offsets, at], "<u8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "file": [name], "index": [name + ".idx"], "records": pa.array([len(offsets)], pa.int64()), "tokens": pa.array([n], pa.int64()), "width": pa.array([width], pa.int32())})

    picked = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    ordered = picked.repartitionByRange(F.col("k").asc_nulls_last()).sortWithinPartitions(F.col("k").asc_nulls_last(), "t")
    return stored(ordered.mapInArrow(write, "part long, file string, index string, records long, tokens long, width int"), "record-files")


def read_records(listed: DataFrame, chunk: int = 1024, seed: int | None = None, keep_ids: bool = True) -> DataFrame:
    """Records of the listed files: doc_id, start, n_tokens, ids_crc32, and with `keep_ids` the ids as 32-bit bytes.

    `start` counts the ids of all records before, over all files. Tasks take runs of `chunk` records, found by the index;
    with a seed they take single records in the order of a hash, for a shuffled read. Every checksum is verified.
    """
    base = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    based = listed.withColumn("base", F.coalesce(F.sum("tokens").over(base), F.lit(0)).cast("long"))
    step = 1 if seed is not None else chunk
    runs = based.select("file", "index", "width", "base", "records", F.explode(F.sequence(F.lit(0), F.col("records") - 1, F.lit(step))).alias("first"))
    runs = runs.withColumn("n", F.least(F.lit(step), F.col("records") - F.col("first"))).drop("records")
    # A fixed number of tasks by the bytes to read: the rows that name them are so few that they would be put in one task.
    held = listed.agg(F.sum(F.col("tokens") * F.col("width")), F.sum("records")).first()
    tasks = min(held[1] or 1, max(listed.sparkSession.sparkContext.defaultParallelism, (held[0] or 0) // READ_BYTES))
    runs = runs.repartition(int(tasks), "file", "first")
    if seed is not None:
        runs = runs.sortWithinPartitions(F.xxhash64(F.lit(seed), "file", "first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handles: dict[str, tuple] = {}
        for batch in batches:
            for run in batch.to_pylist():
                if run["file"] not in handles:
                    handles.clear()
                    store, local = files.opened(run["file"])
                    handles[run["file"]] = (store.open_input_file(local), store.open_input_file(files.opened(run["index"])[1]))
                data, index = handles[run["file"]]
                index.seek(8 * run["first"])
                places = np.frombuffer(index.read(8 * (run["n"] + 1)), "<u8").astype("int64")
                data.seek(int(places[0]))
                block = data.read(int(places[-1] - places[0]))
                at, keys, starts, sizes, crcs, kept = 0, [], [], [], [], []
                for i in range(run["n"]):
                    payload, after = unframe(block, at)
                    key, has, width = struct.unpack_from(HEAD, payload)
                    ids = payload[HEAD_SIZE:]
                    ids = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    keys.append(key if has else None)
                    starts.append(run["base"] + (int(places[i]) - (run["first"] + i) * OVERHEAD) // run["width"])
                    sizes.append(len(ids) // 4)
                    crcs.append(zlib.crc32(ids))
                    if keep_ids:
                        kept.append(ids)
                    at = after
                columns = {n: pa.array(v, pa.int64()) for n, v in (("doc_id", keys), ("start", starts), ("n_tokens", sizes), ("ids_crc32", crcs))}
                yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(kept, pa.binary())} if keep_ids else {}))

    return runs.select("file", "index", "width", "base", "first", "n").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)
