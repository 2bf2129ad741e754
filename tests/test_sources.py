"""Readers over files written by the test."""

import json
import os

import pytest
from pyspark.sql import functions as F

from agrimill.operators import geometry as ops
from agrimill.sources import delimited, documents, shards
from agrimill.streaming.new_shards import stream_new_shards
from tests.conftest import ring, rows


def put(path, data, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data.encode(encoding))
    return str(path)


def test_delimited_keeps_empty_and_null_apart(spark, tmp_path):
    p = put(tmp_path / "a.csv", 'Nom Usuel;N°;;2e\n"a;""b""";;x;""\n퟿;1;;\n')
    df = delimited.read_delimited(spark, p, sep=";")
    assert df.columns == ["nom_usuel", "n", "padding2", "_2e"]
    assert set(t for _, t in df.dtypes) == {"string"}
    assert rows(df) == sorted([('a;"b"', None, "x", ""), ("퟿", "1", None, None)], key=repr)


def test_delimited_encoding_and_line_breaks(spark, tmp_path):
    p = put(tmp_path / "b.csv", 'ville,note\nÉpinay,"deux\nlignes"\n', "iso-8859-15")
    assert rows(delimited.read_delimited(spark, p, encoding="ISO-8859-15", multi_line=True)) == [("Épinay", "deux\nlignes")]


def test_delimited_matches_columns_by_name(spark, tmp_path):
    paths = [put(tmp_path / "m" / n, t) for n, t in (("a 1.csv", "Code,Name\n1,x\n"), ("b.csv", "name,code\ny,2\n"), ("c.csv", "code\n3\n"), ("d.csv", "code,name\n4,z\n"))]
    want = [("1", "x"), ("2", "y"), ("3", None), ("4", "z")]
    assert rows(delimited.read_delimited(spark, paths), "code", "name") == want
    assert rows(delimited.read_delimited(spark, str(tmp_path / "m")), "code", "name") == want
    tagged = shards.union_shards(spark, paths[1:], {"shard": r"([a-d])\.csv"})
    assert rows(tagged, "shard", "code", "name") == [("b", "2", "y"), ("c", "3", None), ("d", "4", "z")]


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    import gzip

    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(60):
        cells = ["code", "name"] if i % 2 else ["name", "code"]
        row = [f"c{i}", f"n{i}"] if i % 2 else [f"n{i}", f"c{i}"]
        (folder / f"part {i:02d}.csv").write_text(",".join(cells) + "\n" + ",".join(row) + "\n")
    (folder / "a%20b.csv").write_text("\n\ufeffcode,name\n".replace("\ufeff", "") + "c60,n60\n")
    (folder / "x[1]{2}.csv").write_text('"code","name"\r\nc61,n61\r\n')
    (folder / "bom.csv").write_bytes("\ufeffcode,name\nc62,n62\n".encode())
    with gzip.open(folder / "packed.csv.gz", "wt") as out:
        out.write("name,code\nn63,c63\n")
    (folder / "empty.csv").write_text("")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = delimited.read_delimited(spark, str(folder))
        jobs = len(tracker.getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert jobs <= 4
    assert sorted(tuple(r) for r in df.select("code", "name").collect()) == sorted((f"c{i}", f"n{i}") for i in range(64))


def test_header_cells(spark, tmp_path):
    f = tmp_path / "h.csv"
    f.write_text("A;;a;\"x;y\"\n1;2;3;4\n")
    found = delimited.headers(spark, [str(f)], sep=";")
    assert found == [(str(f), ["A0", None, "a2", "x;y"])]
    assert delimited.headers(spark, []) == []


def test_repair_lines_keeps_lines_of_separators(spark, tmp_path):
    p = put(tmp_path / "s.csv", "broken\n1,x\n\n,\n2,y\n")
    assert rows(delimited.repair_lines(spark, p, ["id", "v"])) == [("1", "x"), ("2", "y"), (None, None)]


def test_repair_lines(spark, tmp_path):
    p = put(tmp_path / "c.csv", "broken header\r\n1,a\r\n\r\n2,\r\n", "windows-1252")
    assert rows(delimited.repair_lines(spark, p, ["id", "v"], encoding="windows-1252")) == [("1", "a"), ("2", None)]


def test_parse_lines_drops_blank(spark):
    lines = spark.createDataFrame([('1,"x,y"',), ("",), ("\r",), ("2,",)], "value string")
    assert rows(delimited.parse_lines(lines, ["id", "v"])) == [("1", "x,y"), ("2", None)]


def test_positional_cp1252(spark, tmp_path):
    p = put(tmp_path / "d.csv", '"1";"Désherbé";""\n2;b;c\n', "windows-1252")
    assert rows(delimited.read_positional(spark, p, ["id", "n", "x"])) == [("1", "Désherbé", None), ("2", "b", "c")]


def test_enterprises_columns_and_codes(spark, tmp_path):
    p = put(tmp_path / "e.csv", "siret,code ape,nom,autre\n1,01.11Z,-,z\n2,99.99Z,b,z\n")
    df = delimited.read_enterprises(spark, p, ["siret", "code_ape", "nom"], ["01.11Z"], "code_ape")
    assert rows(df) == [("1", "01.11Z", None)]


def feature(i, geom, **props):
    return {"type": "Feature", "geometry": geom, "properties": {"id": i, **props}}


def test_geojson_document_and_lines(spark, tmp_path):
    sq = [list(map(list, ring(0.0, 0.0, 2.0, 2.0)))]
    feats = [
        feature("p1", {"type": "Polygon", "coordinates": sq}, commune="17001", contenance=40),
        feature("p2", {"type": "MultiPolygon", "coordinates": [sq, sq]}),
    ]
    doc = put(tmp_path / "doc" / "f.json", json.dumps({"type": "FeatureCollection", "features": feats}))
    lines = put(tmp_path / "lines" / "f.json", "\n".join(json.dumps(f) for f in feats))
    for df in (documents.read_geojson(spark, doc), documents.read_geojson(spark, lines, by_line=True)):
        assert rows(df, "id", "commune", "section", "contenance", F.size("shape").alias("n")) == [
            ("p1", "17001", "0", 40.0, 1), ("p2", "0", "0", 0.0, 2)
        ]
    c = ops.with_centroid(documents.read_geojson(spark, doc), "shape").filter("id = 'p1'").select("centroid.x", "centroid.y")
    assert rows(c) == [(1.0, 1.0)]


def test_geojson_in_pieces(spark, tmp_path):
    sq = [list(map(list, ring(0.0, 0.0, 2.0, 2.0)))]
    geom = {"type": "Polygon", "coordinates": sq}
    first = [feature(f"a{i}", geom, section='}, {"x": [', commune='say \\"Feature\\"') for i in range(300)] + [feature("null", None)]
    last = [{"id": 1, "geometry": geom, "properties": {"id": f"b{i}", "commune": None}, "type": "Feature"} for i in range(300)]
    head = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}}
    put(tmp_path / "in" / "first.json", json.dumps(head | {"features": first}, indent=1) + "\n")
    put(tmp_path / "in" / "last.json", json.dumps({"features": last, "type": "FeatureCollection"}, separators=(",", ":")))
    put(tmp_path / "in" / "none.json", json.dumps(head | {"features": []}))
    put(tmp_path / "in" / "two.json", "\n".join(json.dumps(head | {"features": [feature(f"c{i}", geom)]}) for i in range(2)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        got = documents.read_geojson(spark, str(tmp_path / "in"))
        assert got.rdd.getNumPartitions() > 20
        assert sorted(r["id"] for r in got.collect()) == sorted([f["properties"]["id"] for f in first + last] + ["c0", "c1"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    columns = ["id", "commune", "section", "contenance", F.to_json("shape").alias("shape")]
    for name in ("first", "last", "none"):
        path = str(tmp_path / "in" / f"{name}.json")
        assert rows(documents.read_geojson(spark, path), *columns) == rows(documents.read_geojson(spark, path, whole=True), *columns), name


@pytest.mark.parametrize("bad", [
    {"geometry": None, "type": "Feature", "properties": {"id": "x"}}, {"properties": {"id": "x"}, "type": "Feature", "geometry": None},
    {"type": "Feature", "geometry": None, "properties": {"commune": "Feature"}}, {"type": "Feature", "geometry": None, "properties": {"type": "Feature"}},
    {"type": "Feature", "properties": {"id": "x"}}, {"geometry": {"type": "Point"}, "properties": {"id": "x"}, "type": "Feature"},
])
def test_geojson_that_pieces_would_spoil_fails(spark, tmp_path, bad):
    good = feature("good", None)
    path = put(tmp_path / "f.json", json.dumps({"type": "FeatureCollection", "features": [good, bad, good]}))
    with pytest.raises(Exception, match="pieces|one side|Malformed|MALFORMED"):
        documents.scan_features(spark, path).collect()


def test_market_payload_files(spark, tmp_path):
    item = {"memberStateCode": "FR", "beginDate": "01/02/2020", "price": "€1.5", "marketName": "A"}
    put(tmp_path / "BLTPAN.json", json.dumps([item, item]))
    put(tmp_path / "MAI.json", json.dumps([item]))
    df = documents.read_market_payload(spark, str(tmp_path))
    assert rows(df.groupBy("product_code").count()) == [("BLTPAN", 2), ("MAI", 1)]


def test_xml_catalogue_three_tags(spark, tmp_path):
    p = put(
        tmp_path / "c.xml",
        '<all><PPP><id>1</id><r a="x">t</r><r a="y">u</r></PPP><adjuvant><id>2</id></adjuvant><PPP><id>3</id></PPP></all>',
    )
    schema = "id string, r array<struct<`_VALUE`:string,`_a`:string>>"
    df = documents.read_xml_catalogue(spark, p, ["PPP", "adjuvant"], schema)
    assert rows(df, "record_tag", "id", F.size(F.coalesce("r", F.array().cast("array<struct<_VALUE:string,_a:string>>"))).alias("n")) == [
        ("PPP", "1", 2), ("PPP", "3", 0), ("adjuvant", "2", 0)
    ]


def test_ingest_geometry_wraps_single(spark):
    df = spark.createDataFrame(
        [(1, '{"type":"LineString","coordinates":[[0,0],[1,1]]}'), (2, '{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[2,2],[3,3]]]}')],
        "id int, geom string",
    )
    out = documents.ingest_geometry(df, "geom", 2, 2154)
    assert rows(out, "id", F.size("geom").alias("n"), "srid") == [(1, 1, 2154), (2, 2, 2154)]


def test_nomenclature(spark):
    df = spark.createDataFrame([("a", "fra", "Blé"), ("a", "eng", "Wheat"), ("a", "eng", "Wheat"), ("b", "fra", "Orge")], "name string, locale string, label string")
    got = {r["name"]: r["label"] for r in documents.nomenclature(df).collect()}
    assert got == {"a": {"fra": "Blé", "eng": "Wheat"}, "b": {"fra": "Orge"}}


def test_union_shards_keeps_keys(spark, tmp_path):
    a = put(tmp_path / "H_17_2020-2024.csv", "NUM_POSTE;T\n1;2\n")
    b = put(tmp_path / "H_33_2010-2019.csv", "NUM_POSTE;T\n3;\n")
    df = shards.union_shards(spark, [a, b], {"department": r"H_([0-9A-Z]+)_", "period": r"_(\d{4}-\d{4})\.csv"}, sep=";")
    assert rows(df) == [("1", "2", "17", "2020-2024"), ("3", None, "33", "2010-2019")]


def test_union_tables(spark):
    out = shards.union_tables({"x": spark.createDataFrame([(1, 2)], "a int, b int"), "y": spark.createDataFrame([(3,)], "a int")}, "shard")
    assert rows(out, "a", "b", "shard") == [(1, 2, "x"), (3, None, "y")]


def test_new_files_by_hash_or_stamp(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "1")
    put(tmp_path / "in" / "b.csv", "2")
    first = shards.file_listing(spark, str(tmp_path / "in"))
    seen = spark.createDataFrame(first.collect(), first.schema)
    assert shards.new_files(shards.file_listing(spark, str(tmp_path / "in")), seen).count() == 0
    put(tmp_path / "in" / "b.csv", "changed")
    put(tmp_path / "in" / "c.csv", "1")
    got = [r["path"].rsplit("/", 1)[1] for r in shards.new_files(shards.file_listing(spark, str(tmp_path / "in")), seen).collect()]
    assert sorted(got) == ["b.csv", "c.csv"]
    moved = seen.withColumn("modified", F.lit(None).cast("timestamp"))
    assert shards.new_files(first.filter("path like '%a.csv'"), moved).count() == 0


def test_collect_opens_only_files_with_a_new_stamp(spark, tmp_path):
    folder = tmp_path / "in %20 [x]"
    for i in range(4):
        put(folder / f"{i}.csv", f"{i}\n" * 50)
    none = spark.createDataFrame([], "path string, size long, modified timestamp, sha256 string")

    def names(df):
        return sorted(r["path"].rsplit("/", 1)[1] for r in df.collect())

    base = str(folder).replace("[", "\\[").replace("]", "\\]")
    for limit in (1 << 30, 10):
        first = shards.collect_new(spark, base, none, whole_file=limit)
        assert names(first) == ["0.csv", "1.csv", "2.csv", "3.csv"]
        assert {r["sha256"] for r in first.collect()} != {None} and first.select("sha256").distinct().count() == 4
        seen = spark.createDataFrame(first.collect(), first.schema)
        os.chmod(folder / "0.csv", 0)
        assert names(shards.collect_new(spark, base, seen, whole_file=limit)) == []
        os.chmod(folder / "0.csv", 0o644)
        os.utime(folder / "1.csv", (1, 1))
        put(folder / "2.csv", f"{limit}\n")
        put(folder / "new.csv", "1\n" * 50)
        assert names(shards.collect_new(spark, base, seen, whole_file=limit)) == ["2.csv", "new.csv"]
        (folder / "new.csv").unlink()
        put(folder / "2.csv", "2\n" * 50)
    assert names(shards.collect_new(spark, base, none, pattern="3*")) == ["3.csv"]


def test_stream_takes_only_new_shards(spark, tmp_path):
    src, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")
    put(src / "H_17.csv", "a;b\n1;x\n")
    args = (spark, str(src), "a string, b string", out, state, {"department": r"H_([0-9A-Z]+)\.csv"})
    assert stream_new_shards(*args).awaitTermination(120)
    put(src / "H_33.csv", "a;b\n2;y\n")
    assert stream_new_shards(*args).awaitTermination(120)
    assert rows(spark.read.parquet(out), "a", F.col("department").cast("string")) == [("1", "17"), ("2", "33")]
