"""Quality rules at host level: failures by domain, shrunk by an empirical beta prior, joined back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.llm.common import field, has_word, slim, stored, words

# Rules a document can fail, and the shrunk share of failing documents above which a host is rejected.
HOST_LIMIT = 0.5
RULES = ("few_words", "repeated", "symbols", "same_lines", "word_length")


def signals(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows, nested as `row`, with their host and the counts the rules are made of.

    Columns: row, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. A null or empty text counts 0
    everywhere. All work is inside the row: window texts are sorted, and a window is repeated when a neighbour equals it.
    """
    t = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))
    base = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.col(f"row.`{host}`").cast("string").alias("host"),
        words(t).alias("_w"),
        F.filter(F.split(t, "\n"), has_word).alias("_lines"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    ).withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))

    def window(i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("g"), i.alias("i"))

    last = F.size("_w") - 3
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window))
    sorted_windows = base.withColumn("_s", F.sort_array(F.coalesce(windows, F.expr("array_remove(array(named_struct('g', '', 'i', 0)), named_struct('g', '', 'i', 0))"))))
    twice = F.filter("_s", lambda x, i: (x["g"] == F.get("_s", i + 1)["g"]) | ((i > 0) & (x["g"] == F.get("_s", F.greatest(i - 1, F.lit(0)))["g"])))
    starts = sorted_windows.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["at"])).alias("n"), p.alias("at")),
        lambda acc: acc["n"],
    )
    return starts.select(
        "row", "host",
        F.size("_w").cast("long").alias("n_words"),
        "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def failures() -> dict[str, Column]:
    """Rule name -> whether the document fails it, over the columns of `signals`."""
    c = F.col
    return {
        "few_words": c("n_words") < 50,
        "repeated": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "same_lines": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        "word_length": (c("word_chars") > 20 * c("n_words")) | (c("word_chars") < 2 * c("n_words")),
    }


def host_rates(rated: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures and shrunk failure rate of each rule, and `bad`.

    The beta prior of a rule has the mean and variance of the raw rates of all hosts (method of moments); a host with few
    documents stays near that mean. Equal rates everywhere count as a prior worth one document. A host is bad when a
    shrunk rate is above the limit. Documents without a host have no row here. One row per host is all that is kept.
    """
    failed = failures()
    hosts = stored(
        rated.where(F.col("host").isNotNull()).groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(failed[r].cast("long")).alias(f"f_{r}") for r in RULES]
        ),
        "hosts",
    )
    rate = {r: F.col(f"f_{r}") / F.col("n") for r in RULES}
    prior = hosts.agg(*[F.avg(rate[r]).alias(f"m_{r}") for r in RULES], *[F.var_samp(rate[r]).alias(f"v_{r}") for r in RULES])
    known = prior.first().asDict()  # one row, whatever the corpus
    shrunk, bad = [], F.lit(False)
    for r in RULES:
        mean, var = known[f"m_{r}"] or 0.0, known[f"v_{r}"] or 0.0
        strength = max(mean * (1 - mean) / var - 1, 0.0) if var > 0 else 1.0
        value = (F.col(f"f_{r}") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
        shrunk.append(value.alias(f"rate_{r}"))
        bad = bad | (value > limit)
    return hosts.select("*", *shrunk, bad.alias("bad"))


def judge(rated: DataFrame, hosts: DataFrame) -> DataFrame:
    """`rated` with base_failed, host_failed and kept.

    A document is kept when it passes the two base rules (enough words, not mostly repeats) and its host is not bad.
    Documents without a host are judged by themselves only. The list of bad hosts is broadcast only if counted small.
    """
    failed = failures()
    bad = slim(stored(hosts.where("bad").select("host", F.lit(True).alias("host_failed")), "bad-hosts"))
    base = failed["few_words"] | failed["repeated"]
    joined = rated.withColumn("base_failed", base).join(bad, "host", "left").withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def host_quality(docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Rate every document and its host. Returns row (the input row), host, the counts, base_failed, host_failed, kept.

    Repeated rows count as often as they occur. An empty table gives an empty result. Columns of the input may have any
    name: they stay inside `row`. Texts are read twice (host rates, then verdicts) rather than stored.
    """
    rated = signals(docs, text, host)
    return judge(rated, host_rates(rated, limit))


def host_quality_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """As `host_quality`, carrying the key instead of the whole row, so that the counts are made once and stored."""
    kind = field(docs.schema, key)
    rated = signals(docs.select(key, text, host), text, host).withColumn("row", F.struct(F.col(f"row.`{key}`").alias(kind.name)))
    rated = stored(rated, "signals")
    return judge(rated, host_rates(rated, limit))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that pass, with their own columns.

    Texts are counted twice, for the rates of hosts and for verdicts, as storing the rows beside their counts would take
    the size of the input on disk. The partition number is carried along because a filter is not pushed past it: pushed
    down, the verdict would be put in place of every count it names, and each window would sort all windows again.
    """
    rated = signals(docs, text, host).withColumn("_here", F.spark_partition_id())
    return judge(rated, host_rates(rated, limit)).where(F.col("kept") & (F.col("_here") >= 0)).select("row.*")
