"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agrimill.llm.common import hash128, n_words, stored

EPOCHS = 3
# Sources and virtual time are summed in so many runs, so that no running sum spans a source or the mix.
RUNS = 4096


def source_targets(sizes: DataFrame, weights: DataFrame | None = None, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    `sizes` has source and size. The budget is the sum of all sizes. A target is the budget's share by weight, at most
    `epochs` times the source's size; what is above is shared anew by weight until none is above. Closed form: sources in
    the order of cap / weight are capped while the level that would serve the rest is above theirs. Without `weights`
    (source, weight) the sources in code point order, null last, weigh 1, 2, 3, repeating. One row per source is handled,
    after a pre-aggregated sum; sources that `weights` does not name, or names with 0 or null, have target 0.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
        weighed = sources.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))
    else:
        given = weights.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = sources.join(given, sources["source"].eqNullSafe(given["_s"]), "left").drop("_s").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    cap = F.lit(epochs) * F.col("source_size")
    order = W.orderBy(F.when(F.col("weight") > 0, F.col("_cap") / F.col("weight")).asc_nulls_last(), F.col("source").isNull(), "source")
    upto, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("_budget") - F.coalesce(F.sum("_cap").over(upto), F.lit(0))) / F.sum("weight").over(after)
    levels = (
        weighed.withColumn("_cap", F.when(F.col("weight") > 0, cap).otherwise(F.lit(0)))
        .withColumn("_budget", F.sum("source_size").over(W.partitionBy()))
        .withColumn("_level", F.when(F.col("weight") > 0, level))
        .withColumn("_fits", (F.col("_level") <= F.col("_cap") / F.col("weight")))
        .withColumn("_first", F.min(F.when(F.col("_fits"), F.struct(F.col("_cap") / F.col("weight"), F.col("source").isNull(), "source", "_level"))).over(W.partitionBy()))
    )
    share = F.col("_first")["_level"] * F.col("weight")
    target = F.when(F.col("weight") > 0, F.when(F.col("_first").isNull(), F.col("_cap").cast("double")).otherwise(F.least(share, F.col("_cap").cast("double")))).otherwise(0.0)
    return levels.select("source", "source_size", "weight", target.alias("target"))


def _time_range(finish: Column) -> Column:
    """Range of a finish time: even steps around the cut, which is near 1, and few, growing ones from 4 on."""
    late = 4 * RUNS + F.floor(64 * F.log2(F.greatest(finish, F.lit(4.0)) / 4))
    return F.when(finish < 4, F.floor(finish * RUNS)).otherwise(late).cast("long")


def plan(units: DataFrame, targets: DataFrame, epochs: int = EPOCHS, seed: str = "mix") -> DataFrame:
    """Copies each unit gives to the mix: the columns of `units` with source_size, target and copies.

    `units`: source, size (words of all rows of the unit), unit (a hash struct), name (text that decides the shuffle).
    Within a source the units stand in the order of an MD5 of seed and name. A copy's virtual finish time is the words of
    its source up to its end, divided by the source's target; a further epoch starts where the one before ends. The copies
    are put in order of finish time, dealt into ranges of it, and the order is cut where the running total would
    pass the sum of the targets. Running sums are made in runs (by hash prefix within a source, by time range in the mix).
    """
    keyed = units.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("name", F.lit("")))))
    keyed = stored(keyed.withColumn("_run", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")), "mix-units")
    sums = keyed.groupBy("source", "_run").agg(F.sum("size").alias("_sum"))
    ahead = W.partitionBy("source").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("_s"), F.col("_run").alias("_r"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    inside = W.partitionBy("source", "_run").orderBy("_key", "name", "size", "unit").rowsBetween(W.unboundedPreceding, 0)
    summed = keyed.withColumn("_in", F.sum("size").over(inside))
    summed = summed.join(starts, summed["source"].eqNullSafe(starts["_s"]) & (F.col("_run") == F.col("_r"))).drop("_s", "_r")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    timed = summed.join(t, summed["source"].eqNullSafe(t["_s"])).drop("_s")
    words_up_to = (F.col("_epoch") - 1) * F.col("source_size") + F.col("_start") + F.col("_in")
    copies = timed.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn(
        "_finish", F.when(F.col("target") > 0, words_up_to / F.col("target")).when(F.col("source_size") == 0, F.lit(0.0))
    ).where(F.col("_finish").isNotNull())
    copies = stored(copies.withColumn("_range", _time_range(F.col("_finish"))).drop("_in", "_start", "_run"), "mix-copies")
    budget = float(targets.agg(F.sum("target")).first()[0] or 0.0)
    upto = W.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    ranges = copies.groupBy("_range").agg(F.sum("size").alias("_sum")).withColumn("_total", F.sum("_sum").over(upto))
    cut = ranges.where(F.col("_total") > budget).agg(F.min(F.struct("_range", (F.col("_total") - F.col("_sum")).alias("before")))).first()[0]
    if cut is None:
        taken = copies
    else:
        whole = copies.where(F.col("_range") < cut["_range"])
        order = W.partitionBy("_range").orderBy("_finish", F.col("source").isNull(), "source", "_key", "name", "unit", "_epoch").rowsBetween(W.unboundedPreceding, 0)
        edge = copies.where(F.col("_range") == cut["_range"]).withColumn("_so_far", F.sum("size").over(order) + F.lit(cut["before"]))
        taken = whole.unionByName(edge.where(F.col("_so_far") <= budget).drop("_so_far"))
    counts = taken.groupBy(F.col("unit").alias("_u")).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    out = keyed.drop("_key", "_run").join(counts, F.col("unit") == F.col("_u"), "left").drop("_u").withColumn("copies", F.coalesce("copies", F.lit(0)))
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    return out.join(t, out["source"].eqNullSafe(t["_s"])).drop("_s")


def _units(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Rows nested as `row`, with name, source, size and a unit hash; rows equal in key, source and text are one unit."""
    nested = docs.select(F.struct("*").alias("row"))
    k, t, s = (F.col(f"row.`{c}`").cast("string") for c in (key, text, source))
    return nested.select("row", k.alias("name"), s.alias("source"), n_words(t).alias("words"), hash128(k, s, t, t.isNull(), k.isNull(), s.isNull()).alias("unit"))


def mix_plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, epochs: int = EPOCHS, seed: str = "mix") -> DataFrame:
    """One row per unit: its key, source, words of one row, rows (how many equal ones), source_size, target, copies.

    Sizes are words; null and empty texts have none. Rows equal in key, source and text form a unit that is taken
    together, each row as often as the unit's copies. A null source is a source of its own. Every reading of the same
    rows gives the same plan. Only keys and counts are shuffled, never texts.
    """
    rows = _units(docs.select(key, text, source), key, text, source)
    grouped = rows.groupBy("unit", "name", "source", "words").agg(F.count(F.lit(1)).alias("rows"), F.first(F.col(f"row.`{key}`")).alias("key"))
    units = stored(grouped.withColumn("size", F.col("words") * F.col("rows")), "mix-sizes")
    targets = stored(source_targets(units, weights, epochs), "mix-targets")
    return plan(units, targets, epochs, seed)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, epochs: int = EPOCHS, seed: str = "mix") -> DataFrame:
    """The mixed corpus: every row as often as the plan takes it (0 to `epochs` times), with its own columns."""
    counts = mix_plan(docs, key, text, source, weights, epochs, seed).where("copies > 0").select(F.col("unit").alias("_u"), "copies")
    rows = _units(docs, key, text, source)
    return rows.join(counts, F.col("unit") == F.col("_u")).select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
