"""Resampling towards a target: hashed n-gram weights, Gumbel noise and the highest scores."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agrimill.llm.common import field, stored
from agrimill.llm.prefix_crc import Running
from agrimill.operators.keyed import number_rows

BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 2024, 10, 20
# Gains and noise are whole numbers of thousandths.
SCALE = 1000
# Texts are scanned, and results handed on, in portions of about so many bytes.
SLICE = 1 << 22


@functools.lru_cache(maxsize=1)
def _letters() -> bytes:
    """Byte table of the normal form: digits, a-z and everything beyond ASCII stay, A-Z are lowered, the rest is space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for b in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[b] = b
    for b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        table[b] = b + 32
    return bytes(table)


def pieces(text: bytes, max_n: int) -> Iterator[tuple[int, list[bytes]]]:
    """Words of a text in portions: how many of the words before each portion come again at its head, and its words."""
    at, carry = 0, []
    while True:
        end = len(text)
        if end - at > SLICE:
            # Up to the last separator in reach; a single longer word is taken whole.
            portion = text[at:at + SLICE].translate(_letters())
            cut = portion.rfind(b" ")
            while cut < 0 and at + len(portion) < end:
                portion += text[at + len(portion):at + len(portion) + SLICE].translate(_letters())
                cut = portion.rfind(b" ")
            end = at + cut if cut >= 0 else end
            words = portion[:cut].split() if cut >= 0 else portion.split()
        else:
            words = text[at:].translate(_letters()).split()
        yield len(carry), carry + words
        if end >= len(text):
            return
        at = end + 1
        carry = (carry + words)[-(max_n - 1):] if max_n > 1 else []


def bucket_type(buckets: int) -> type:
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def hashed_ngrams(docs: DataFrame, key: str | None = "doc_id", text: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Key (unless None), n_words, n_features and `buckets`: the bucket of every n-gram, as little-endian whole numbers.

    A-Z are lowered; words are runs of digits, a-z and characters beyond ASCII. Features are the runs of 1 to `max_n`
    words joined by a space, repeats included; a bucket is the CRC-32 of a feature modulo `buckets` (2 bytes each up to
    65536 of them, else 4). The words, joined by single spaces, are scanned once, and every n-gram's CRC comes from the
    running CRCs at its ends. A null or empty text has no words. Texts of any length are scanned in portions.
    """
    if not 0 < buckets <= 1 << 32:
        raise ValueError("between 1 and 2 ** 32 buckets")
    kind = field(docs.schema, key) if key else None
    schema = T.StructType(([T.StructField(kind.name, kind.dataType)] if kind else []) + [T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("buckets", T.BinaryType())])
    small = bucket_type(buckets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first = batch.column(batch.num_columns - 1), 0
            out: list[list[bytes]] = []
            n_words: list[int] = []
            waiting: list[tuple[int, int, int, int]] = []
            flat: list[bytes] = []
            held = 0

            def settle() -> None:
                run = Running(flat)
                for n in range(1, max_n + 1):
                    ids = (run.ngrams(n) % np.uint32(buckets) if buckets < 1 << 32 else run.ngrams(n)).astype(small)
                    for row, lo, hi, again in waiting:
                        begin, end = lo + max(0, again - n + 1), hi - n + 1
                        if begin < end:
                            out[row].append(ids[begin:end].tobytes())
                waiting.clear(), flat.clear()

            def block(first: int) -> pa.RecordBatch:
                data = [b"".join(parts) for parts in out]
                arrays = [batch.column(0).slice(first, len(out))] if kind else []
                arrays += [pa.array(n_words, pa.int64()), pa.array([len(d) // small.itemsize for d in data], pa.int64()), pa.array(data, pa.binary())]
                return pa.RecordBatch.from_arrays(arrays, names=schema.names)

            for row in range(batch.num_rows):
                body = texts[row].as_py() or b""
                out.append([]), n_words.append(0)
                for again, words in pieces(body, max_n):
                    waiting.append((len(out) - 1, len(flat), len(flat) + len(words), again))
                    flat += words
                    n_words[-1] += len(words) - again
                    if len(flat) > SLICE // 16:
                        settle()
                held += len(body)
                if held > SLICE:
                    settle()
                    yield block(first)
                    first, held = row + 1, 0
                    out.clear(), n_words.clear()
            if out:
                settle()
                yield block(first)

    columns = [F.col(key).alias(kind.name)] if kind else []
    return docs.select(*columns, F.col(text).cast("string").cast("binary").alias("_text")).mapInArrow(scan, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """How often each bucket occurs: bucket, n. Tasks count for themselves first, so what is shuffled follows the buckets."""
    small = bucket_type(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] | np.ndarray = np.zeros(buckets, np.int64) if buckets <= 1 << 22 else {}
        for batch in batches:
            for value in batch.column(0):
                ids = np.frombuffer(value.as_buffer() or b"", small)
                if isinstance(total, np.ndarray):
                    total += np.bincount(ids, minlength=buckets) if len(ids) > buckets // 8 else 0
                    if 0 < len(ids) <= buckets // 8:
                        np.add.at(total, ids, 1)
                else:
                    for b, n in zip(*np.unique(ids, return_counts=True)):
                        total[int(b)] = total.get(int(b), 0) + int(n)
        found = np.flatnonzero(total) if isinstance(total, np.ndarray) else np.array(list(total), np.int64)
        n = total[found] if isinstance(total, np.ndarray) else np.array(list(total.values()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["bucket", "n"])

    return features.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Gain of every bucket the source holds: bucket, gain; in thousandths of the log ratio of smoothed shares.

    `source` and `target` are counts as from `bucket_counts`; either may be empty. One is added to every count.
    """
    source, target = stored(source, "source-counts"), stored(target, "target-counts")
    held = [df.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double")).first()[0] for df in (source, target)]
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("n", "m"))
    both = source.join(target.withColumnRenamed("n", "m"), "bucket", "left")
    ratio = (t + 1) * F.lit(held[0] + buckets) / ((s + 1) * F.lit(held[1] + buckets))
    return both.select("bucket", F.floor(F.lit(float(SCALE)) * F.ln(ratio)).cast("long").alias("gain"))


def weigh(features: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`features` with `weight`, the sum of the gains of its features, in place of `buckets`.

    The gains, one number for each bucket at most, go to the tasks whole: `buckets` bounds them.
    """
    if buckets > 1 << 22:
        raise ValueError("weigh handles up to 4,194,304 buckets: the list of gains is held by every task")
    table = np.zeros(buckets, np.int64)
    for r in gain.collect():
        table[r["bucket"]] = r["gain"]
    small = bucket_type(buckets)
    rest = [f for f in features.schema.fields if f.name != "buckets"]
    schema = T.StructType([*rest, T.StructField("weight", T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(table[np.frombuffer(v.as_buffer() or b"", small)].sum()) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=schema.names)

    return features.select(*[f.name for f in rest], "buckets").mapInArrow(add, schema)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of `seed:key`; a null key hashes as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", max_n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Draw documents that look like the target: key, n_words, n_features, weight, score, rank (null if not drawn).

    A score is the weight of a document, the sum of its features' gains, and Gumbel noise, so that the highest scores are
    a sample without replacement in proportion to the weights' exponentials. Of the N documents with at least `min_words`
    words the `percent` * N // 100 highest are drawn, ties to the smaller key, then to fewer features; null keys come
    last. Counts cover every document and every target text. Repeated rows count and compete each by themselves; null and
    empty texts have no features, weight 0, and are never drawn while `min_words` is above 0. An empty table gives an
    empty result, an empty target a uniform one. Only key and text are read, so other columns may have any name.
    """
    name = field(docs.schema, key).name
    features = stored(hashed_ngrams(docs, key, text, max_n, buckets), "features")
    wanted = stored(hashed_ngrams(target, None, text, max_n, buckets), "target-features")
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets), buckets)
    weighed = weigh(features, gain, buckets)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col(name), seed)), "scores")
    eligible = F.col("n_words") >= min_words
    drawn = scored.where(eligible).count() * percent // 100
    order = [eligible.desc(), F.col("score").desc(), F.col(name).asc_nulls_last(), F.col("n_features").asc()]
    return number_rows(scored, "rank", order).withColumn("rank", F.when(eligible & (F.col("rank") <= drawn), F.col("rank")))
