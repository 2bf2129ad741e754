"""Release, manifest, reload, publish."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from agrimill.operators import release
from agrimill.plans import presets
from agrimill.specs import POINT, TableSpec
from tests.conftest import rows

ZONE = TableSpec("zones", "zone", f"id int, name string, label map<string,string>, tags array<string>, centroid {POINT}", pk=("id",), not_null=("name",))
SALE = TableSpec("sales", "sale", "id int, zone int, price decimal(8,2), sold_on date", pk=("id",), fks={"zone": ("zone", "id")})
CREDIT_ROWS = [("zones", "Z", "u", "prov", "open", "lu", None)]


@pytest.fixture(scope="module")
def tables(spark):
    zone = spark.createDataFrame(
        [(1, "a", {"fra": "x", "eng": "y"}, ["t", None], (0.0, 0.0)), (2, "", None, [], (5.0, 5.0)), (3, 'q"\n,', {"fra": "é"}, None, None)], ZONE.schema
    )
    sale = spark.sql("select * from values (1, 1, 10.50BD, date'2020-01-02'), (2, 2, null, null), (3, null, 1.00BD, null)").toDF("id", "zone", "price", "sold_on")
    credits = spark.createDataFrame(CREDIT_ROWS, release.CREDITS_SPEC.schema)
    return {"zone": ZONE.align(zone), "sale": SALE.align(sale), release.CREDITS: credits}


SPECS = [ZONE, SALE]


def test_checksum_ignores_order_and_partitions(tables):
    for df in tables.values():
        want = rows(release.content_hash(df))
        assert rows(release.content_hash(df.repartition(7))) == want
        assert rows(release.content_hash(df.orderBy(F.rand(3)))) == want


def test_checksum_sees_changes(spark, tables):
    base = rows(release.content_hash(tables["sale"]))
    assert rows(release.content_hash(tables["sale"].union(tables["sale"].filter("id = 1")))) != base
    swapped = spark.createDataFrame([(None, "a")], "x string, y string")
    assert rows(release.content_hash(swapped)) != rows(release.content_hash(swapped.select(F.col("y").alias("x"), F.col("x").alias("y"))))
    assert len(tables["zone"].select(release.strong_row_hash(tables["zone"])).distinct().collect()) == 3


def test_flavor_selects_sources_and_rows(tables):
    f = release.Flavor("f", only=("sales",), filters={"sale": "price > 5"})
    out = release.select_release(tables, SPECS, f)
    assert sorted(out) == [release.CREDITS, "sale"] and out["sale"].count() == 1
    near = release.Flavor("n", without=("sales",), filters={"zone": ((0.0, 0.0, 1.0), (9.0, 9.0, 1.0))})
    out = release.select_release(tables, SPECS, near)
    assert sorted(out) == [release.CREDITS, "zone"] and rows(out["zone"], "id") == [(1,)]
    assert sorted(f.merge(["zones"]).only) == ["sales", "zones"]


@pytest.mark.parametrize("bad", [
    release.Flavor("f", without=("nope",)), release.Flavor("f", only=("nope",)), release.Flavor("f", filters={"nope": "true"}),
])
def test_flavor_with_unknown_names_fails(tables, bad):
    with pytest.raises(ValueError, match="unknown source or table"):
        release.select_release(tables, SPECS, bad)


def test_filter_must_be_an_expression(tables):
    bad = release.Flavor("f", filters={"sale": "true; drop table x"})
    with pytest.raises(Exception):
        release.select_release(tables, SPECS, bad)["sale"].count()


def test_write_and_reload_verified(spark, tables, tmp_path):
    base = release.write_release(tables, SPECS, release.Flavor("full"), "1.2.3", str(tmp_path))
    loaded = release.load_release(spark, base)
    for name, df in tables.items():
        assert rows(release.content_hash(loaded[name])) == rows(release.content_hash(df)), name
    assert sorted(release.load_release(spark, base, without=("sales",))) == [release.CREDITS, "zone"]
    assert sorted(release.load_release(spark, base, only=("sales",))) == ["sale"]
    with pytest.raises(Exception):
        release.write_release(tables, SPECS, release.Flavor("full"), "1.2.3", str(tmp_path))


def test_reload_detects_damage(spark, tables, tmp_path):
    base = release.write_release(tables, SPECS, release.Flavor("full"), "2.0.0", str(tmp_path))
    release.export_csv(tables["sale"].filter("id < 3"), f"{base}/data/sale")
    with pytest.raises(ValueError, match="sale"):
        release.load_release(spark, base)
    assert release.load_release(spark, base, verify=False)["sale"].count() == 2


def test_reload_keeps_every_text(spark, tmp_path):
    texts = ["  x ", " ", "", "a\r\nb", "\n", "\r", "\\", "\\N", "\\n", "\\e", "\\br", '"', 'q",', "#c", "\t", "\u00a0", None]
    one = spark.createDataFrame([(t,) for t in texts], "v string")
    two = spark.createDataFrame([(i, t, [t]) for i, t in enumerate(texts)], "id int, v string, l array<string>")
    for name, df in (("one", one), ("two", two)):
        release.export_csv(df.repartition(3), str(tmp_path / name))
        back = release.read_csv_table(spark, str(tmp_path / name), df.schema)
        assert rows(back) == rows(df), name


def test_publish_holds_references_of_other_tables(spark, tables, tmp_path):
    root = str(tmp_path / "in")
    others = {"sale": tables["sale"]}
    assert release.publish(spark, {"zone": tables["zone"]}, SPECS, root, others).filter("not ok and rule like 'ref%'").count() == 0
    fewer = release.publish(spark, {"zone": tables["zone"].filter("id = 1")}, SPECS, root, others)
    assert rows(fewer.filter("not ok and rule like 'ref%'"), "table_name", "n") == [("sale", 1)]
    assert release.current(spark, ZONE, root).count() == 3
    alone = release.publish(spark, {"sale": tables["sale"]}, SPECS, root)
    assert rows(alone.filter("not ok"), "rule", "n") == [("reference:zone->zone", None)]


def test_presets_limit_only_the_tables_named():
    soil = {"registered_soil_depths", "registered_natural_zones", "registered_protected_water_zones", "registered_soil_available_water_capacities"}
    for name in ("pv", "sydec"):
        assert not soil & set(presets.PRESETS[name].filters)
    assert soil <= set(presets.PRESETS["innovation"].filters)
    assert set(presets.PRESETS["natais"].filters) == {"registered_graphic_parcels"}


def test_versions(spark):
    df = spark.createDataFrame([(1, "1.9.0"), (2, "1.10.0"), (3, "1.10.0")], "id int, release string")
    assert rows(release.at_version(df), "id") == [(2,), (3,)]
    assert rows(release.at_version(df, "1.9.0"), "id") == [(1,)]


def test_json_array_is_one_document(spark, tmp_path):
    df = spark.range(25).select("id", F.when(F.col("id") > 3, F.col("id")).alias("v"))
    release.export_json_array(df.repartition(5), str(tmp_path / "a"), "id")
    parts = sorted((tmp_path / "a").glob("part-*"))
    doc = json.loads("".join(p.read_text() for p in parts))
    assert [d["id"] for d in doc] == list(range(25)) and doc[0] == {"id": 0, "v": None}
    release.export_json(df, str(tmp_path / "b"))
    assert spark.read.json(str(tmp_path / "b")).count() == 25


def test_json_array_of_no_rows_null_and_equal_keys(spark, tmp_path):
    for name, values in (("none", []), ("odd", [None, 3, None, 1, 3]), ("one", [None])):
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "id int, v int")
        release.export_json_array(df.repartition(3), str(tmp_path / name), "id")
        doc = json.loads("".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*"))))
        assert [d["id"] for d in doc] == sorted(values, key=lambda v: (v is not None, v or 0)) and sorted(d["v"] for d in doc) == list(range(len(values)))


def test_release_of_empty_tables(spark, tables, tmp_path):
    none = {name: df.limit(0) for name, df in tables.items()} | {"zone": spark.createDataFrame([], ZONE.schema)}
    base = release.write_release(none, SPECS, release.Flavor("full", order_by={"sale": ("id",)}), "1.0.0", str(tmp_path))
    assert {n: df.count() for n, df in release.load_release(spark, base).items()} == dict.fromkeys(none, 0)


def test_of_two_publishers_from_one_generation_one_wins(spark, tables, tmp_path):
    root = str(tmp_path / "two")
    assert release.generation(spark, root) == 0
    copies = [{"zone": ZONE.align(tables["zone"].filter(f"id <= {n}"))} for n in (1, 2, 3)]

    def run(copy):
        try:
            release.publish(spark, copy, [ZONE], root, since=0)
            return copy["zone"].count()
        except release.PublishConflict:
            return None

    with ThreadPoolExecutor(3) as pool:
        won = [n for n in pool.map(run, copies) if n]
    assert len(won) == 1 and release.generation(spark, root) == 1 and release.current(spark, ZONE, root).count() == won[0]
    assert run(copies[1]) is None
    release.publish(spark, copies[1], [ZONE], root)
    assert release.generation(spark, root) == 2 and release.current(spark, ZONE, root).count() == 2


def test_append_into_fills_missing_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    release.append_into(spark.createDataFrame([(1, 2)], "id int, zone int"), SALE, path)
    release.append_into(spark.createDataFrame([(2,)], "id int"), SALE, path)
    assert rows(spark.read.parquet(path)) == [(1, 2, None, None), (2, None, None, None)]


def test_provenance_replaced_by_source(spark):
    old = spark.createDataFrame([("a", "p1", "l", "d"), ("b", "p2", "l", "d")], "datasource string, provider string, licence string, updated_at string")
    new = spark.createDataFrame([("a", "p9", "l", "d")], old.schema)
    got = release.replace_credits(old, new)
    assert rows(got, "datasource", "provider") == [("a", "p9"), ("b", "p2")]
    out = release.with_provenance(spark.createDataFrame([(1, "a"), (2, "z")], "id int, source string"), got)
    assert rows(out, "id", "provider") == [(1, "p9"), (2, None)]


def test_publish_keeps_previous_on_failure(spark, tables, tmp_path):
    root = str(tmp_path / "pub")
    good = {"zone": tables["zone"], "sale": tables["sale"]}
    assert release.publish(spark, good, SPECS, root).filter("not ok").count() == 0
    assert release.current(spark, SALE, root).count() == 3
    orphan = SALE.align(spark.createDataFrame([(9, 77)], "id int, zone int"))
    report = release.publish(spark, {"zone": tables["zone"], "sale": orphan}, SPECS, root)
    assert rows(report.filter("not ok"), "rule") == [("reference:zone->zone",)]
    assert rows(release.current(spark, SALE, root), "id") == [(1,), (2,), (3,)]
    status = rows(spark.read.json(f"{root}/pointer").groupBy("status").count())
    assert status == [("error", 2), ("ok", 2)]


def test_presets_name_known_tables(spark):
    empty = {s.name: spark.createDataFrame([], s.schema) for s in presets.SPECS}
    assert len(empty) == 57
    for flavor in presets.PRESETS.values():
        chosen = release.select_release(empty, presets.SPECS, flavor)
        for name in set(flavor.filters) & set(chosen):
            chosen[name].schema
