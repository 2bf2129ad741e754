"""Line deduplication over a corpus, exact and within one word edit, by a join on deletion neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agrimill.llm.common import has_word, hash128, slim, stored, words

# Shorter lines are duplicates only when equal: one word of few can be all that a line says.
MIN_WORDS = 8
POS = ["late", "doc", "t", "line_no"]


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with doc, t (hash of the text) and text; a null text is empty."""
    clean = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).alias("doc"), F.xxhash64(clean).alias("t"), clean.alias("text"))


def _pos() -> Column:
    return F.struct(*POS)


def _half_keys(w: Column, n: Column) -> tuple[Column, Column]:
    """Hashes of the first and of the last words of a line, at the one or two lengths that a partner would use too.

    Of two lines one word edit apart, the shorter with n words, the first or the last n // 2 words are equal.
    """
    long, short = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    first = F.array(*[F.xxhash64(F.lit("first"), F.slice(w, F.lit(1), h)) for h in (long, short)])
    last = F.array(*[F.xxhash64(F.lit("last"), F.slice(w, n - h + 1, h)) for h in (long, short)])
    return F.array_distinct(first), F.array_distinct(last)


def one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words differ by at most one word put in, left out or replaced."""
    longer, shorter = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(at == 0, shorter.cast("long")).otherwise(at - 1)

    ends = common(a, b) + common(F.reverse(a), F.reverse(b))
    return (longer - shorter <= 1) & (ends >= longer - 1)


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Lines to remove: doc, t, lines (numbers from 0). See `dedup_lines` for the rules."""
    source = _documents(docs, key, text)
    exploded = source.select(F.col("doc").isNull().alias("late"), "doc", "t", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    n = F.size("w")
    first, last = _half_keys(F.col("w"), n)
    long_enough = n >= min_words
    keyed = exploded.where(has_word(F.col("line"))).withColumn("w", line_words(F.col("line"))).select(
        *POS, hash128(F.col("line")).alias("h"), n.alias("n"), F.when(long_enough, first).alias("first"), F.when(long_enough, last).alias("last")
    )
    # The only pass that hashes lines: what follows reads places and hashes.
    flat = stored(keyed.select(
        *POS, F.col("h.a").alias("a"), F.col("h.b").alias("b"), "n",
        F.get("first", 0).alias("f0"), F.get("first", 1).alias("f1"), F.get("last", 0).alias("l0"), F.get("last", 1).alias("l1"),
    ), "all-lines")
    # Distinct lines with their first place; a hot line is combined before the shuffle.
    distinct = flat.groupBy("a", "b").agg(
        F.min(_pos()).alias("pos"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), *[F.max(k).alias(k) for k in ("f0", "f1", "l0", "l1")]
    )
    distinct = stored(distinct, "lines")
    near = near_repeats(source, distinct.where(n_at_least(min_words)), min_words)
    # What makes a line go: the place of its first copy, unless that is gone too.
    gone = distinct.where("copies > 1").select("a", "b", "pos").join(near.withColumn("near", F.lit(True)), ["a", "b"], "full").select("a", "b", "pos", F.coalesce("near", F.lit(False)).alias("near"))
    gone = slim(stored(gone, "repeats"))
    out = flat.select(*POS, "a", "b").join(gone, ["a", "b"]).where(F.col("near") | (_pos() != F.col("pos")))
    return out.groupBy("doc", "t").agg(F.collect_set("line_no").alias("lines"))


def line_words(line: Column) -> Column:
    """As `words`; lines whose words are single spaces apart are cut without a pattern."""
    return F.when(line.rlike("[\\x09-\\x0D]|  |^ | $"), words(line)).otherwise(F.split(line, " "))


def n_at_least(min_words: int) -> Column:
    return F.col("n") >= min_words


def near_repeats(source: DataFrame, distinct: DataFrame, min_words: int) -> DataFrame:
    """Of distinct lines (a, b, pos, n, half keys) those that an earlier one is one word edit from: a, b.

    Lines that share no half with another cannot have a partner and drop out. Each of the rest emits a hash for itself
    and for itself without each word. Lines with the same remainder at the same place differ in that word; a line equal to
    a remainder of another lacks that word. The earliest of such a group is a partner of all others, so no pairs are
    formed: every line keeps its earliest partner, and that pair's texts are compared.
    """
    halves = distinct.select("a", "b", "pos", "n", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(k).alias("k")) for s, k in (("f", "f0"), ("f", "f1"), ("l", "l0"), ("l", "l1"))])).alias("x"))
    halves = halves.select("a", "b", "pos", "n", "x.side", "x.k").where("k is not null")
    shared = slim(stored(halves.groupBy("k").count().where("count > 1").select("k"), "halves"))
    chosen = halves.join(shared, "k").groupBy("a", "b").agg(
        F.min("pos").alias("pos"), F.max("n").alias("n"), F.max(F.col("side") == "f").alias("by_first"), F.max(F.col("side") == "l").alias("by_last")
    )
    chosen = stored(chosen, "candidates")
    texts = _texts(source, chosen)
    at, last = F.floor((F.col("n") - 1) / 2).cast("int"), F.col("n") - F.floor((F.col("n") - 1) / 2).cast("int")
    # Words hashed with their place, as it is and as it would be one earlier; running xors give every remainder in one pass.
    placed = texts.repartition("a", "b").select("a", "b", "pos", "n", "by_first", "by_last", F.posexplode("w").alias("i", "word"))
    of_line = W.partitionBy("a", "b").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("a", "b")
    seeds = (1, 2)
    placed = placed.select("*", *[F.xxhash64(F.lit(s), "i", "word").alias(f"h{s}") for s in seeds], *[F.xxhash64(F.lit(s), F.col("i") - 1, "word").alias(f"m{s}") for s in seeds]).drop("word")
    run = placed.select("*", *[F.bit_xor(f"{x}{s}").over(of_line).alias(f"{x}{s}_upto") for x in "hm" for s in seeds], *[F.bit_xor(f"{x}{s}").over(whole).alias(f"{x}{s}_all") for x in "hm" for s in seeds])

    def remainder(s: int) -> Column:
        """Words before as they are, words after one place earlier: the latter are all without those up to here."""
        before = F.col(f"h{s}_upto").bitwiseXOR(F.col(f"h{s}"))
        return before.bitwiseXOR(F.col(f"m{s}_all")).bitwiseXOR(F.col(f"m{s}_upto"))

    hashed = run.select("a", "b", "pos", "n", "by_first", "by_last", "i", remainder(1).alias("va"), remainder(2).alias("vb"), F.col("h1_all").alias("wa"), F.col("h2_all").alias("wb"))
    variants = hashed.where((F.col("by_first") & (F.col("i") >= at)) | (F.col("by_last") & (F.col("i") <= last))).select("a", "b", "pos", "va", "vb", "i")
    itself = hashed.where("i = 0").select("a", "b", "pos", F.col("wa").alias("va"), F.col("wb").alias("vb"), F.lit(-1).alias("i"))
    emitted = stored(variants.unionByName(itself), "variants")
    places = stored(emitted.groupBy("va", "vb", "i").agg(F.min("pos").alias("least"), F.count(F.lit(1)).alias("lines")), "remainders")
    same_place = places.where("i >= 0 and lines > 1").select("va", "vb", "i", F.col("least").alias("partner"))
    with_word = places.groupBy("va", "vb").agg(F.min(F.when(F.col("i") < 0, F.col("least"))).alias("whole"), F.min(F.when(F.col("i") >= 0, F.col("least"))).alias("longer")).where("whole is not null and longer is not null")
    lacking = with_word.select("va", "vb", F.explode(F.array(F.struct(F.lit(True).alias("self"), F.col("longer").alias("partner")), F.struct(F.lit(False).alias("self"), F.col("whole").alias("partner")))).alias("x"))
    lacking = slim(stored(lacking.select("va", "vb", "x.self", "x.partner"), "lacking"))
    same_place = slim(stored(same_place, "same-place"))
    found = emitted.join(same_place, ["va", "vb", "i"]).select("a", "b", "pos", "partner").unionByName(
        emitted.withColumn("self", F.col("i") < 0).join(lacking, ["va", "vb", "self"]).select("a", "b", "pos", "partner")
    )
    pairs = found.where("partner < pos").groupBy("a", "b").agg(F.min("partner").alias("partner"))
    other = texts.select(F.col("pos").alias("partner"), F.col("w").alias("other"))
    return pairs.join(texts.select("a", "b", "w"), ["a", "b"]).join(other, "partner").where(one_edit(F.col("w"), F.col("other"))).select("a", "b")


def _texts(source: DataFrame, chosen: DataFrame) -> DataFrame:
    """`chosen` lines with their words, taken from the documents they stand in first."""
    wanted = chosen.groupBy("pos.doc", "pos.t").agg(F.collect_list("pos.line_no").alias("lines"))
    wanted = slim(stored(wanted, "wanted")).withColumnRenamed("doc", "d").withColumnRenamed("t", "u")
    found = source.join(wanted, source["doc"].eqNullSafe(F.col("d")) & (source["t"] == F.col("u"))).withColumn("all", F.split("text", "\n"))
    lines = found.select(F.explode(F.transform("lines", lambda i: F.get("all", i))).alias("line"))
    lines = lines.select(hash128(F.col("line")).alias("h"), words(F.col("line")).alias("w")).groupBy("h").agg(F.first("w").alias("w"))
    picked = lines.select(F.col("h.a").alias("a"), F.col("h.b").alias("b"), "w")
    return stored(chosen.join(picked, ["a", "b"]), "candidate-lines")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """Documents whose repeated lines are gone; with `counts` also n_lines and n_removed, replacing columns so named.

    Lines are cut at line feeds. A line goes when an earlier line of the corpus is equal, or is one word put in, left out or
    replaced away and both have at least `min_words` words. Earlier is by key, then hash of the text, then place; null keys
    come last. The earlier line counts whether or not it stays itself, so a chain leaves its earliest. Lines without a word
    never go. Null texts stay null. Rows equal in key and text are one document: they lose the same lines. The kept
    lines are joined as they stood. An empty table gives an empty result. Other columns may have any name.
    """
    gone = repeated_lines(docs, key, text, min_words)
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("_doc"), F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_t", F.xxhash64(F.coalesce("_text", F.lit(""))))
    joined = rows.join(gone, rows["_doc"].eqNullSafe(gone["doc"]) & (rows["_t"] == gone["t"]), "left").withColumn("_all", F.split("_text", "\n"))
    left = F.array_join(F.filter("_all", lambda line, i: ~F.array_contains("lines", i)), "\n")
    new = F.when(F.col("lines").isNull(), F.col("_text")).otherwise(left)
    names = docs.columns
    columns = [new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names if not (counts and c in ("n_lines", "n_removed"))]
    if counts:
        columns += [F.coalesce(F.size("_all"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed")]
    return joined.select(*columns)
