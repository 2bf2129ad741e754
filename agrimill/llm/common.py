"""Helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from agrimill.session import shared_path, stored

__all__ = ["BLANKS", "BLANK_RUN", "components", "field", "has_word", "hash128", "n_words", "ranked", "shared_path", "slim", "stored", "words"]

# The white space between words, \x20 and \x09-\x0D, as a set of characters and as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"

# A join side is broadcast only when it was measured: no more rows than this, and no more bytes of files.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 1 << 24


def slim(df: DataFrame) -> DataFrame:
    """Hint a broadcast for a stored table whose files prove it small; larger ones are left to a shuffle join.

    Both the rows and the bytes of its files have a bound. The count reads no more than file footers, and Spark's own
    estimate for a table that is read back whole is the size of its files.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= BROADCAST_BYTES and df.count() <= BROADCAST_ROWS else df


def words(text: Column) -> Column:
    """Words of a text: runs of anything but space, tab, line and page breaks. A null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def has_word(text: Column) -> Column:
    """Whether anything but white space is in the text; the search ends at the first such character."""
    return text.rlike("[^\\x20\\x09-\\x0D]")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def hash128(*columns: Column) -> Column:
    """Struct of two 64-bit hashes with different seeds: equal values get equal structs, and no others by chance at any real size."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(7), *columns).alias("b"))


def ranked(df: DataFrame, keys: list[str], spread: Column, order: list[Column], rank: str, parts: int = 64) -> DataFrame:
    """Number the rows of each key from 0 without gaps, no task ever holding a whole key.

    Rows of a key are dealt by `spread` (any hash of the row's content) over `parts` runs; each run is numbered by
    itself and starts where the run before it ends. The order within a key is thus the order of the runs.
    """
    from pyspark.sql import Window as W

    dealt = df.withColumn("_run", F.pmod(spread, F.lit(parts)).cast("int"))
    lengths = dealt.groupBy(*keys, "_run").agg(F.count(F.lit(1)).alias("_n"))
    ahead = W.partitionBy(*keys).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = lengths.select(*keys, "_run", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(*keys, "_run").orderBy(*order)) - 1
    numbered = dealt.withColumn("_at", inside)
    return numbered.join(starts, [*keys, "_run"]).withColumn(rank, (F.col("_start") + F.col("_at")).cast("long")).drop("_run", "_start", "_at")


def field(schema: T.StructType, name: str) -> T.StructField:
    return next(f for f in schema.fields if f.name == name)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: columns node and root, the smallest node reachable.

    Alternating stars: every node hands its larger neighbours to its smallest one, then its smaller ones, until nothing
    changes. Each round is two aggregations and joins by node, with its result written to the shared folder; hubs are
    pre-aggregated before the shuffle and split by adaptive joins. No link, node or component passes through the driver.
    Links with a null end or equal ends are left out. An empty input gives an empty result.
    """
    spark = links.sparkSession
    edges = stored(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links"
    )
    state = None
    while True:
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi != lo").distinct()
        large = stored(large, "stars")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi != lo")
        edges = stored(moved.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
