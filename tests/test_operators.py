"""Keyed, run, join and aggregate operators."""

import pytest
from pyspark.sql import functions as F

from agrimill.functions import labels
from agrimill.operators import aggregates, joins, keyed, quality, reshape, runs
from agrimill.specs import TableSpec
from tests.conftest import rows


def test_first_wins_does_not_use_a_window(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, None)], "k int, o int, v string")
    out = keyed.first_wins(df, ["k"], ["o"])
    assert rows(out, "k", "v") == [(1, "a"), (2, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min_by" in plan.lower()


def test_insert_ignore(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "y"), (2, "x")], "k int, v string")
    assert rows(keyed.insert_ignore(old, new, ["k"], ["v"])) == [(1, "old"), (2, "x")]


def test_upsert_keeps_other_columns_even_null(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "k int, n string, m string")
    new = spark.createDataFrame([(1, "z", "zz"), (3, "q", "r")], "k int, n string, m string")
    assert rows(keyed.upsert_columns(old, new, ["k"], ["n"])) == [(1, "z", None), (2, "b", "c"), (3, "q", "r")]


def test_replace_scope_is_exact(spark):
    t = spark.createDataFrame([("user_roles", "u", "x"), ("userXroles", "v", "y")], "scope string, id string, fra string")
    new = spark.createDataFrame([("w", "z")], "id string, fra string")
    assert rows(keyed.replace_scope(t, "scope", "user_roles", new), "id") == [("v",), ("w",)]


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert rows(keyed.delete_where(df, F.col("v") == 1)) == [(2,), (None,)]


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="duplicate key"):
        keyed.require_unique(df, ["k"])


def test_surrogate_dense_across_ranges(spark):
    df = spark.createDataFrame([(k,) for k in (5, 900, 12, 13, 450)], "k int")
    assert rows(keyed.surrogate_dense(df, "id", "k", width=10), "k", "id") == sorted(
        [(5, 1), (12, 2), (13, 3), (450, 4), (900, 5)], key=repr
    )


@pytest.mark.parametrize("chunk,levels", [(1, 1), (2, 0), (2, 1), (2, 2), (3, 3), (1000, 2)])
def test_run_heads_any_chunk(spark, chunk, levels):
    data = [("s", i, v) for i, v in enumerate(["a", "a", None, None, "b", "b", "a"])] + [("t", 7, "a"), ("t", 50, "a"), ("t", 99, "c")]
    df = spark.createDataFrame(data, "sheet string, row int, v string")
    got = rows(runs.run_heads(df, ["sheet"], "row", F.col("v"), chunk=chunk, levels=levels), "sheet", "row")
    assert got == sorted([("s", 0), ("s", 2), ("s", 4), ("s", 6), ("t", 7), ("t", 99)], key=repr)


def test_sheet_rows_and_header(spark):
    cells = spark.createDataFrame(
        [("s", 2, "A", "head"), ("s", 4, "A", "x"), ("s", 4, "B", "y"), ("s", 5, "B", "z")], "sheet string, row int, col string, value string"
    )
    out = runs.with_header_line(runs.sheet_rows(cells, ["A", "B"]), ["sheet"], 2, {"A": "h"}, 4)
    assert rows(out, "row", "A", "B", "h") == [(4, "x", "y", "head"), (5, None, "z", "head")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(500).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("l"))
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (99, "d")], "k bigint, r string")
    salted = joins.salted_join(left, right, ["k"], how, hot_rows=50, salts=5)
    assert rows(salted, "k", "l", "r") == rows(left.join(right, "k", how), "k", "l", "r")


def test_null_safe_update(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", "keep"), (3, "y", "own")], "id int, k string, v string")
    donors = spark.createDataFrame([(None, "n"), ("x", "m"), ("x", "a")], "k string, v string")
    assert rows(joins.null_safe_update(df, donors, ["k"], "v", ["v"]), "id", "v") == [(1, "n"), (2, "a"), (3, "own")]


def test_propagate_donor_to_group(spark):
    df = spark.createDataFrame([(1, "g", "PPP", "x"), (2, "g", "PCP", None), (3, "h", "PCP", "own")], "id int, g string, t string, v string")
    out = joins.propagate(df, "g", F.col("t") == "PPP", ["v"], ["id"])
    assert rows(out, "id", "v") == [(1, "x"), (2, "x"), (3, "own")]


def test_species_chain_precedence(spark):
    usages = spark.createDataFrame([(i, c) for i, c in enumerate(["both", "nomen", "exc", "none", "defset"])], "id int, crop_label_fra string")

    def lab(pairs):
        return spark.createDataFrame(pairs, "t string, name string").select(labels.label(F.col("t")).alias("label"), "name")

    out = joins.species_chain(
        usages, lab([("both", "s1, s2"), ("exc", "s9"), ("defset", "plant")]), lab([("both", "v"), ("nomen", "w"), ("defset", "d")]),
        spark.createDataFrame([("exc", "e1,e2")], "crop_label string, species string"),
    )
    got = {r["crop_label_fra"]: r["species"] for r in out.collect()}
    assert got == {"both": ["s1", "s2"], "nomen": ["w"], "exc": ["e1", "e2"], "none": ["plant"], "defset": ["d"]}


def test_fan_out_drops_unknown_region(spark):
    zones = spark.createDataFrame([("01", "R"), ("02", "R")], "department string, region string")
    df = spark.createDataFrame([("r", 1), ("q", 2)], "zone string, v int")
    assert rows(joins.region_fan_out(df, zones, "zone"), "department_zone", "v") == [("01", 1), ("02", 1)]


def test_text_minimum_is_textual(spark):
    df = spark.createDataFrame([("9",), ("100",)], "a string")
    assert df.agg(aggregates.min_text_as_int(F.col("a"))).collect()[0][0] == 100
    assert df.agg(aggregates.min_text_as_int(F.col("a"), numeric=True)).collect()[0][0] == 9


def test_distinct_array_keeps_null_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "x string")
    r = df.agg(aggregates.distinct_array(F.col("x")), aggregates.distinct_array(F.col("x"), keep_null=False), aggregates.distinct_text(F.col("x")))
    assert tuple(r.collect()[0]) == (["a", "b", None], ["a", "b"], "a | b")


def test_severity_in_row_and_grouped(spark):
    df = spark.createDataFrame([(1, ["H317", "H361d"]), (2, ["X"]), (3, [])], "id int, c array<string>")
    inrow = df.select("id", aggregates.reentry_hours_of(F.col("c")), aggregates.mix_categories_of(F.col("c")))
    want = [(1, 48, [1, 3]), (2, 6, [1]), (3, 6, [1])]
    assert rows(inrow) == want
    grouped = df.select("id", F.explode_outer("c").alias("c")).groupBy("id").agg(
        aggregates.reentry_hours(F.col("c")), aggregates.mix_categories(F.col("c"))
    )
    assert rows(grouped) == want


def test_legacy_mix_category(spark):
    a = spark.createDataFrame([(1, "H341 + R62"), (2, "zzz")], "product_id int, code string")
    b = spark.createDataFrame([(1, "H373"), (3, "T+")], "product_id int, code string")
    assert rows(aggregates.legacy_mix_category(a, b, "product_id", "code")) == [(1, 4), (2, 1), (3, 5)]


def test_loglog_row_and_group_agree(spark):
    # y = 3 x^2 exactly
    df = spark.createDataFrame([(1, 2.0, 12.0, 4.0, 48.0, 8.0, 192.0)], "k int, x1 double, y1 double, x2 double, y2 double, x3 double, y3 double")
    pairs = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in (1, 2, 3)]
    assert df.select(aggregates.loglog_extrapolate(pairs, F.lit(10.0))).collect()[0][0] == pytest.approx(300.0)
    long = df.select("k", F.explode(F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in pairs])).alias("p")).select("k", "p.*")
    fit = aggregates.loglog_fit(long, ["k"], F.col("x"), F.col("y")).collect()[0]
    assert fit["slope"] == pytest.approx(2.0)


def test_spread(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 3.0, 6.0)], "k int, x double, y double")
    r = aggregates.spread(df, ["k"], F.col("x"), F.col("y")).collect()[0]
    assert (r["mean_x"], r["mean_y"], r["var_x"], r["cov_xy"]) == (2.0, 4.0, 1.0, 2.0)


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("1.9.0",), ("1.10.0",), ("1.2.30",)], "v string")
    assert rows(aggregates.latest_version(df, "v")) == [("1.10.0",)]


def test_unpivot_reads_once(spark):
    df = spark.range(3).withColumn("a", F.lit(1)).withColumn("b", F.lit(2))
    out = reshape.unpivot_segments(df, [("_a", {"v": F.col("a")}), ("_b", {"v": F.col("b")})])
    assert out.count() == 6
    assert out._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


NATION = TableSpec("geo", "nation", "id int, name string", pk=("id",), not_null=("name",))
CITY = TableSpec("geo", "city", "id int, nation int", pk=("id",), fks={"nation": ("nation", "id")})


def test_checks_and_verdict(spark):
    n = spark.createDataFrame([(1, "a"), (1, None)], "id int, name string")
    c = spark.createDataFrame([(1, 1), (2, 7), (3, 7), (4, None)], "id int, nation int")
    report = quality.checks(spark, {"nation": n, "city": c}, [NATION, CITY])
    bad = rows(report.filter("not ok"), "table_name", "rule", "n")
    assert bad == [("city", "reference:nation->nation", 2), ("nation", "duplicate:id", 1), ("nation", "null:name", 1)]
    assert rows(quality.verdict(report)) == [("geo", False)]
    assert rows(quality.orphans(c, "nation", n, "id")) == [(7, 2)]


def test_table_states(spark):
    have = {"a": spark.range(2), "b": spark.range(0)}
    assert rows(quality.table_states(spark, have, ["a", "b", "c"])) == [("a", 2, "ok"), ("b", 0, "empty"), ("c", 0, "missing")]


def test_spec_alignment(spark):
    df = spark.createDataFrame([("1",)], "id string")
    assert rows(NATION.align(df)) == [(1, None)]
    with pytest.raises(ValueError, match="not in the spec"):
        NATION.align(df.withColumn("nmae", F.lit(1)))


def test_rows_are_numbered_in_a_global_order(spark):
    from agrimill.operators.keyed import number_rows

    df = spark.range(5000, numPartitions=3).select((F.col("id") % 3).alias("a"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("b"), F.lit("x").alias("_tie"), F.lit(None).cast("int").alias("_place"))
    got = number_rows(df, "n", [F.col("a").desc(), "b"]).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 5001))
    in_order = [(-r["a"], r["b"]) for r in sorted(got, key=lambda r: r["n"])]
    assert in_order == sorted(in_order)
    assert number_rows(df, "n", ["a"], start=0).agg(F.min("n")).first()[0] == 0
    assert number_rows(df.limit(0), "n", ["a"]).collect() == []
    same = spark.range(1000).select(F.lit(1).alias("a"))
    assert sorted(r["n"] for r in number_rows(same, "n", ["a"]).collect()) == list(range(1, 1001))


def test_min_text_sorts_no_rows(spark):
    df = spark.createDataFrame([(1, "b"), (1, "B"), (1, None), (2, "é"), (2, "z"), (3, None), (None, "x"), (4, "")], "k int, t string")
    out = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), aggregates.min_text(F.col("t")).alias("t"))
    assert rows(out) == sorted([(1, 3, "B"), (2, 2, "z"), (3, 1, None), (None, 1, "x"), (4, 1, "")], key=repr)
    assert out.schema["t"].dataType.simpleString() == "string"
    assert "Sort" not in out._jdf.queryExecution().executedPlan().toString()


def test_yields_are_summed_up_without_a_sort(spark, tmp_path):
    from driver_queries import QUERIES

    spark.createDataFrame([(0, "AFRICA"), (1, "ASIA")], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(0, "KENYA", 0), (1, "CHINA", 1), (2, "INDIA", 1)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    parts = [(1, "pea", "B1", "SMALL", 1, 2.5), (2, "oat", "B2", "SMALL", 1, 1.25), (3, "rye", "B3", "PROMO", 1, 4.0), (4, "fig", "B4", "LARGE", 1, 9.0)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    out = QUERIES["d_yields"](spark, str(tmp_path))
    assert rows(out) == [("CHINA", 2, 3.75, "oat"), ("INDIA", 2, 3.75, "oat"), ("KENYA", 1, 4.0, "rye")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # The departments are broadcast, never the yields.
    assert "BuildRight" in plan and "BuildLeft" not in plan
