"""Nearest neighbours by an inverted multi-index: two codebooks, one for each half, and lists for pairs of centroids."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agrimill.llm.common import stored

# Rows the codebooks are fitted on, centroids of a half, and the recall on the fitted rows that sets how far to go.
SAMPLE, CENTROIDS, RECALL = 20_000, 64, 0.95
# Vectors and queries that meet in one task at a time.
VECTORS, QUERIES = 4096, 2048
# Queries whose walk over the centroid pairs is one task.
WALKS = 64


def usable(vector: Column) -> Column:
    """Not null, some component not zero, and every component finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)


def pairs_by_distance(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) in ascending order of a[i] + b[j]: a heap holds the edge of what was taken."""
    oa, ob = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    va, vb = a[oa].tolist(), b[ob].tolist()
    heap, row = [(va[0] + vb[0], 0, 0)], [0] * (len(oa) + 1)
    while heap:
        _, x, y = heapq.heappop(heap)
        yield oa[x], ob[y]
        row[x] = y + 1
        if y + 1 < len(ob) and (x == 0 or row[x - 1] > y + 1):
            heapq.heappush(heap, (va[x] + vb[y + 1], x, y + 1))
        if x + 1 < len(oa) and row[x + 1] == y:
            heapq.heappush(heap, (va[x + 1] + vb[y], x + 1, y))


def inner(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All inner products, each summed in the order of the components, so that equal vectors score the same."""
    out = np.zeros((len(q), len(v)))
    for k in range(q.shape[1]):
        out += q[:, k, None] * v[None, :, k]
    return out


def share_to_visit(sample: np.ndarray, books: tuple[np.ndarray, np.ndarray], k: int, recall: float = RECALL) -> float:
    """Share of the rows, nearest pairs of centroids first, that holds `recall` of the true neighbours in the sample."""
    half = books[0].shape[1]
    cells = nearest(sample[:, :half], books[0]), nearest(sample[:, half:], books[1])
    asked = np.arange(0, len(sample), max(1, len(sample) // 256))
    scores = inner(sample[asked], sample)
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    q = sample[asked]
    far = (-(q[:, :half] @ books[0].T))[:, cells[0]] + (-(q[:, half:] @ books[1].T))[:, cells[1]]
    place = np.empty_like(far)
    np.put_along_axis(place, np.argsort(far, axis=1, kind="stable"), np.broadcast_to(np.arange(len(sample), dtype=float), far.shape), axis=1)
    return float(min(1.0, np.quantile(np.take_along_axis(place, best, axis=1), recall) / len(sample) + 0.02))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(x.values.to_numpy(zero_copy_only=False), float) for x in column]) if len(column) else np.empty((0, 0))


def search(rows: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, share: float | None = None, seed: int = 1) -> DataFrame:
    """The k nearest rows found for every query row: query_id, rank, vec_id, score (inner product in double precision).

    Vectors that are null, zero, not finite, or not of the commonest length take no part, as do rows without an integer key;
    rows that share a key count once, with the smaller vector. The codebooks, and the share of the rows a query visits, are
    fitted on a sample of at most SAMPLE rows (by hash of the key); every row is indexed. A query walks the pairs of
    centroids by summed distance until their lists hold that share, and at least k others. Lists and queries meet in blocks:
    a list of any length is dealt over tasks. Scores use the original vectors; ties go to the smaller key.
    """
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    good = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], out)
    dim = sizes["d"]
    good = stored(good.where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")), "vectors")
    sample = _matrix(good.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column(0).combine_chunks())
    half = dim // 2
    books = kmeans(sample[:, :half], centroids, seed), kmeans(sample[:, half:], centroids, seed + 1)
    share = share_to_visit(sample, books, k) if share is None else share

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if len(x):
                i, j = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i.astype("int32")), pa.array(j.astype("int32"))], names=["id", "v", "q", "i", "j"])

    index = stored(good.mapInArrow(assign, "id long, v array<double>, q boolean, i int, j int"), "index")
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in index.groupBy("i", "j").count().collect():  # centroids squared at most
        counts[r["i"], r["j"]] = r["count"]
    n, asked = int(counts.sum()), index.where("q").count()
    goal = max(math.ceil(share * n), k + 1)
    blocks = [max(1, math.ceil(c / VECTORS)) for c in counts.sum(1).tolist()]
    q_blocks = max(1, math.ceil(asked / QUERIES))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                x = _matrix(batch.column(1))
                da, db = -(x[:, :half] @ books[0].T), -(x[:, half:] @ books[1].T)
                rows_, lists, masks = [], [], []
                for r in range(len(x)):
                    left, seen = goal, np.zeros(counts.shape, bool)
                    for i, j in pairs_by_distance(da[r], db[r]):
                        seen[i, j] = True
                        left -= counts[i, j]
                        if left <= 0:
                            break
                    seen &= counts > 0
                    for i in np.flatnonzero(seen.any(1)).tolist():
                        rows_.append(r), lists.append(i), masks.append(np.packbits(seen[i]).tobytes())
                take = pa.array(rows_, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(lists, pa.int32()), pa.array(masks, pa.binary())], names=["id", "v", "i", "mask"])

    queries = index.where("q").select("id", "v").repartition(max(1, math.ceil(asked / WALKS)), "id").mapInArrow(walk, "id long, v array<double>, i int, mask binary")
    n_blocks = F.get(F.array(*[F.lit(b) for b in blocks]), F.col("i"))
    q_side = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int")).withColumn("vb", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    v_side = index.select("id", "v", "i", "j").withColumn("vb", F.pmod(F.xxhash64("id"), n_blocks).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def score(asked: pa.Table, listed: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not asked.num_rows or not listed.num_rows:
            return empty
        asked, listed = asked.combine_chunks(), listed.combine_chunks().sort_by("id")
        ids, qids = listed.column("id").to_numpy(), asked.column("id").to_numpy()
        v, j = _matrix(listed.column("v").combine_chunks()), listed.column("j").to_numpy()
        every = _matrix(asked.column("v").combine_chunks())
        masks = np.stack([np.unpackbits(np.frombuffer(m, np.uint8)) for m in asked.column("mask").to_pylist()]).astype(bool)
        parts = []
        for at in range(0, len(qids), 256):
            part = slice(at, at + 256)
            s = inner(every[part], v)
            s[~masks[part][:, j] | (qids[part, None] == ids[None, :])] = -np.inf
            floor = np.partition(s, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(s), -np.inf)
            r, c = np.nonzero((s >= floor[:, None]) & (s > -np.inf))
            order = np.lexsort((ids[c], -s[r, c], r))
            r, c = r[order], c[order]
            first = np.searchsorted(r, r)
            keep = np.arange(len(r)) - first < k
            parts.append((qids[part][r[keep]], ids[c[keep]], s[r[keep], c[keep]]))
        return pa.table({name: np.concatenate([p[x] for p in parts]) for x, name in enumerate(("query_id", "vec_id", "score"))})

    found = q_side.groupBy("i", "vb", "qb").cogroup(v_side.groupBy("i", "vb", "qb")).applyInArrow(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
