"""Near-duplicate documents by circulant MinHash, banding, exact Jaccard checks and connected components."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from agrimill.llm.common import components, field, slim, stored

# Places of the permutations, coordinates of a band, and the chance to miss a pair right at the threshold.
PLACES, ROWS, MISS = 1 << 20, 6, 1e-8
# Members of a bucket that are compared in one task at a time.
BLOCK = 512
# A worker's membership table of a block, in bytes; larger blocks are compared pair by pair.
TABLE = 1 << 26


def n_bands(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


@functools.lru_cache(maxsize=4)
def permutations(coordinates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and rows of the second one: row p holds its values at p, p + 1, ..., around the circle."""
    rng = np.random.default_rng(seed)
    first, second = (rng.permutation(PLACES).astype(np.uint32) for _ in range(2))
    around = np.concatenate([second, second[:coordinates]])
    return first, np.lib.stride_tricks.sliding_window_view(around, coordinates)


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; of all words where there are fewer; none without words.

    A-Z are lower-cased; words are what space, tab, line and page breaks leave.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    run = min(size, len(w))
    h = np.full(len(w) - run + 1, run, np.uint64)
    for k in range(run):
        h = (h ^ w[k:len(w) - run + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def signature(grams: np.ndarray, coordinates: int, seed: int) -> np.ndarray:
    """Coordinate k is the least value the second permutation, shifted by k, has at the places the first gives the shingles."""
    first, rows = permutations(coordinates, seed)
    places = first[(grams >> np.uint64(44)).astype(np.int64)]
    out = rows[places[:4096]].min(axis=0)
    for at in range(4096, len(places), 4096):
        np.minimum(out, rows[places[at:at + 4096]].min(axis=0), out=out)
    return out


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """Signed 64-bit hash of every band of every signature; the band's number is part of it."""
    bands = signatures.reshape(len(signatures), -1, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(ROWS):
        h = (h ^ bands[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def node_of(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signatures(docs: DataFrame, key: str, text: str, size: int, percent: int, seed: int) -> DataFrame:
    """key, n_shingles, node (128-bit name of the shingle set, null for an empty one), bands."""
    kind = field(docs.schema, key)
    coordinates = n_bands(percent) * ROWS
    schema = T.StructType([
        T.StructField("key", kind.dataType), T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sets = [shingles(x.as_py() or b"", size) for x in batch.column(1)]
                some = [s for s in sets if len(s)]
                bands = band_hashes(np.stack([signature(s, coordinates, seed) for s in some])) if some else np.empty((0, 1), np.int64)
                rows = iter(bands)
                listed = pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()), listed], names=schema.names)

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(sign, schema)


def shingle_sets(docs: DataFrame, text: str, size: int) -> DataFrame:
    """node, n, grams of every text that has words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                sets = [s for s in (shingles(x.as_py() or b"", size) for x in whole.slice(at, 512).column(0)) if len(s)]
                yield pa.RecordBatch.from_pydict({"node": pa.array([node_of(s) for s in sets], pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64()), "grams": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

    return docs.select(F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(cut, "node binary, n long, grams array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs of nodes a, b whose sets meet the threshold, counted on the whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    both = F.size(F.array_intersect("ga", "gb")).cast("long")
    joined = pairs.join(right, "b").join(left, "a").where(alike).withColumn("both", both)
    return joined.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _links(nodes: list[bytes], labels: list[bytes], halves: list[int], sets: list[np.ndarray], within: bool, percent: int) -> tuple[list, list]:
    """Links between members of a block that no known component joins."""
    m = len(nodes)
    sizes = np.array([len(s) for s in sets])
    _, group = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)
    half = np.array(halves)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum(sizes)[:-1]
    own = np.split(ids, cuts)
    width = int(ids.max()) + 1
    table = None
    if m * width <= TABLE:
        table = np.zeros((m, width), bool)
        for i, x in enumerate(own):
            table[i, x] = True
    found_a, found_b = [], []
    for i in range(m - 1):
        rest = np.arange(i + 1, m)
        fits = (group[rest] != group[i]) & (100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i]))
        rest = rest[fits if within else fits & (half[rest] != half[i])]
        if not len(rest):
            continue
        if table is not None:
            both = np.count_nonzero(table[np.ix_(rest, own[i])], axis=1)
        else:
            both = np.array([len(np.intersect1d(own[i], own[j], assume_unique=True)) for j in rest])
        for j in rest[100 * both >= percent * (sizes[rest] + sizes[i] - both)]:
            found_a.append(nodes[i]), found_b.append(nodes[j])
    return found_a, found_b


def cross_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that bucket leaders did not show: between members of a bucket that are in different components so far.

    Buckets of one component are done. The others are dealt by hash into blocks of about BLOCK members; every two blocks
    meet in one task, which holds their sets and emits only links. Pairs of one component, and sizes that exclude the
    threshold, are passed over; all else is compared on whole sets, so nothing is missed however large a bucket is.
    """
    known = labels.select("node", F.col("root").alias("label"))
    labelled = members.join(known, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    open_ = labelled.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo != hi")
    open_ = slim(stored(open_.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open-buckets"))
    dealt = labelled.join(open_, "band").withColumn("x", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = dealt.select("band", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "node", "label").join(sets, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [], [], [])

        def done() -> Iterator[pa.RecordBatch]:
            if key and len(held[0]) > 1:
                a, b = _links(*held, key[1] == key[2], percent)
                if a:
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

        for batch in batches:
            band, i, j, x, node, label = (batch.column(k).to_pylist() for k in range(6))
            grams = batch.column(6)
            values, offsets = grams.values.to_numpy(), grams.offsets.to_numpy()
            for r in range(batch.num_rows):
                if (band[r], i[r], j[r]) != key:
                    yield from done()
                    key, held = (band[r], i[r], j[r]), ([], [], [], [])
                for to, v in zip(held, (node[r], label[r], x[r], values[offsets[r]:offsets[r + 1]])):
                    to.append(v)
        yield from done()

    ordered = keyed.select("band", "i", "j", "x", "node", "label", "grams").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return ordered.mapInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, seed: int = 1) -> DataFrame:
    """One row for each row: key, n_shingles, component_id (smallest key reachable, its own included), kept.

    Rows are linked when 100 * intersection >= percent * union of their shingle sets; see `shingles`. Texts with equal
    sets are one node. Bands of the signature propose buckets; each bucket's smallest node is compared with all others,
    and what is then still apart inside a bucket is compared in blocks. The bands are as many as make it a chance
    of MISS to overlook a pair right at the threshold. Texts without words are linked with nothing. Rows without a key
    belong to components but never name one: component_id is null, and kept true, where no member has a key. Rows with the
    same key keep a component each. An empty table gives an empty result. Sets are made again, for candidates only,
    instead of being stored for all.
    """
    kind = field(docs.schema, key)
    signed = stored(signatures(docs, key, text, size, percent, seed), "signatures")
    nodes = signed.where("node is not null").groupBy("node").agg(F.min("key").alias("label"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    nodes = stored(nodes, "nodes")
    exploded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = exploded.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "leader")
    members = stored(exploded.join(slim(stored(buckets, "buckets")), "band"), "members")
    chosen = stored(members.select("node").distinct().join(nodes.select("node", "label"), "node"), "candidates")
    wanted = slim(stored(chosen.select(F.col("label").alias("wanted")).distinct(), "wanted"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(wanted, F.col("key").eqNullSafe(F.col("wanted")), "left_semi")
    sets = shingle_sets(texts, "text", size).groupBy("node").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))
    sets = stored(sets.join(chosen.select("node"), "node", "left_semi"), "sets")
    pairs = members.where("leader != node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(verified(pairs, sets, percent), "links")
    joined = stored(components(links), "components")
    more = stored(cross_links(members.select("band", "node"), joined, sets, percent).distinct(), "more-links")
    if more.count():
        joined = stored(components(links.union(more)), "components")
    labels = nodes.select("node", "label").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labels.groupBy("root").agg(F.min("label").alias("component_id"))
    named = stored(labels.join(least, "root").select("node", "component_id"), "names")
    out = signed.select("key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(kind.name), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(kind.name) == F.col("component_id"), F.col("component_id").isNull())
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stand for their component, with their own columns.

    Of rows that share the key of the component's name only one stays: the one with the smallest hash of its text. Rows
    without a key stay only if their component has no key at all.
    """
    found = near_duplicates(docs, key, text, size, percent)
    gone = found.where(~F.col("kept")).select(F.col(key).alias("_gone")).where("_gone is not null").distinct()
    return docs.join(slim(stored(gone, "gone")), F.col(key) == F.col("_gone"), "left_anti")
