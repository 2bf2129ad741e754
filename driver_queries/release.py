"""Quality checks, release filters, manifests, provenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from agrimill.functions import geometry as geo
from agrimill.functions.numbers import md5_prefix_int
from agrimill.operators import quality, release
from agrimill.session import shared_dir
from agrimill.specs import TableSpec
from driver_queries.registry import Tables, query

ORDERS = TableSpec(
    "sales", "orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string",
    pk=("o_orderkey",), fks={"o_custkey": ("customer", "c_custkey")},
)
CUSTOMER = TableSpec(
    "people", "customer", "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string, centroid struct<x:double,y:double>",
    pk=("c_custkey",), not_null=("c_name",), fks={"c_nationkey": ("nation", "n_nationkey")},
)
NATION = TableSpec("places", "nation", "n_nationkey int, n_name string, n_regionkey int", pk=("n_nationkey",))
NAMED = {s.name: s for s in (ORDERS, CUSTOMER)}
LINEITEM = TableSpec(
    "sales", "lineitem", "l_orderkey bigint, l_linenumber int, l_partkey bigint", pk=("l_orderkey", "l_linenumber"),
    fks={"l_partkey": ("part", "p_partkey")},
)


def tables(t: Tables) -> dict:
    centroid = geo.point(F.col("c_custkey") % 360 - 180, F.col("c_acctbal") / 200)
    return {
        "orders": t.orders.select(*ORDERS.schema.fieldNames()),
        "customer": t.customer.withColumn("centroid", centroid).select(*CUSTOMER.schema.fieldNames()),
        "nation": t.nation,
        "lineitem": t.lineitem.select(*LINEITEM.schema.fieldNames()),
        "part": t.part.filter("p_size > 10"),
    }


FLAVOR = release.Flavor(
    "small", without=("places",),
    filters={
        "orders": "o_orderpriority LIKE '1%' OR o_orderstatus IN ('F') AND o_custkey % 10 IN (3, 7)",
        "customer": ((-0.5, 25.0, 20.0), (90.0, 10.0, 5.0)),
    },
    order_by={"orders": ("o_orderkey",)},
)


@query("""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority LIKE '1%' OR o_orderstatus IN ('F') AND o_custkey % 10 IN (3, 7) ORDER BY o_orderkey
""")
def q_release_filter(t: Tables):
    chosen = release.select_release(tables(t), [ORDERS, CUSTOMER, NATION], FLAVOR)
    return chosen["orders"].select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("""
WITH p AS (SELECT c_custkey, CAST(c_custkey % 360 - 180 AS DOUBLE) AS x, c_acctbal / 200 AS y FROM customer)
SELECT c_custkey FROM p WHERE (x + 0.5) * (x + 0.5) + (y - 25) * (y - 25) <= 400 OR (x - 90) * (x - 90) + (y - 10) * (y - 10) <= 25
""")
def q_release_area(t: Tables):
    return release.select_release(tables(t), [ORDERS, CUSTOMER, NATION], FLAVOR)["customer"].select("c_custkey")


@query("""
SELECT 'orders' AS table_name, count(*) AS n_rows, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END AS state FROM orders
UNION ALL SELECT 'customer', count(*), CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END FROM customer
UNION ALL SELECT 'returned', count(*), CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END FROM lineitem WHERE l_quantity < 0
UNION ALL SELECT 'prices', 0, 'missing'
""")
def q_table_states(t: Tables):
    have = {"orders": t.orders, "customer": t.customer, "returned": t.lineitem.filter("l_quantity < 0")}
    return quality.table_states(t.spark, have, ["orders", "customer", "returned", "prices"])


@query("""
SELECT 'duplicate:l_orderkey,l_linenumber' AS rule, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'null:l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'null:l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'null:flag', count(*) FILTER (WHERE l_returnflag = 'N') FROM lineitem
""")
def q_pk_violations(t: Tables):
    li = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return quality.key_violations(li, ["l_orderkey", "l_linenumber"], ["flag"])


@query("""
SELECT 'sales' AS source, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)) = 0
  AND (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) = 0 AS valid
UNION ALL SELECT 'people', true UNION ALL SELECT 'places', true
""")
def q_verdict(t: Tables):
    return quality.verdict(quality.checks(t.spark, tables(t), [ORDERS, CUSTOMER, NATION, LINEITEM]))


@query("""
SELECT 'sales' AS source, 'orders' AS table_name, 'o_custkey' AS column_name, 'customer' AS target, 0 AS n_values, 0 AS n_rows
UNION ALL SELECT 'people', 'customer', 'c_nationkey', 'nation', 0, 0
UNION ALL SELECT 'sales', 'lineitem', 'l_partkey', 'part', count(DISTINCT l_partkey), count(*) FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
""")
def q_orphan_report(t: Tables):
    return quality.orphan_report(tables(t), [ORDERS, CUSTOMER, NATION, LINEITEM])


@query("""
SELECT p_partkey, CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN '[' ELSE ',' END ||
  '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","size":' || CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) ELSE 'null' END || '}' ||
  CASE WHEN p_partkey = (SELECT max(p_partkey) FROM part) THEN ']' ELSE '' END AS line FROM part
""")
def q_json_export(t: Tables):
    size = F.when(F.col("p_size") > 10, F.col("p_size"))
    return release.json_array_lines(t.part.select("p_partkey", "p_name", size.alias("size")), "p_partkey")


def _sum_sql(name: str, cols: str) -> str:
    h = f"CAST('0x' || substr(md5(concat({cols})), 1, 8) AS BIGINT)"
    return (
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(sum(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END) AS BIGINT) "
        f"AS checksum FROM {name}"
    )


MD5_COLUMNS = {
    "nation": ("n_nationkey", "n_name"), "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
    "customer": ("c_custkey", "c_name", "c_mktsegment"), "lineitem": ("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"),
    "documents": ("doc_id", "text", "lang"),
}


@query(" UNION ALL ".join(_sum_sql(k, ", ".join(v)) for k, v in MD5_COLUMNS.items()))
def q_manifest_md5(t: Tables):
    """Rows and an order-independent checksum of whole tables, from the row checksum SQL knows too."""
    parts = [
        getattr(t, name).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(md5_prefix_int(*cols).cast("bigint")).alias("checksum")
        ).select(F.lit(name).alias("table_name"), "n_rows", "checksum")
        for name, cols in MD5_COLUMNS.items()
    ]
    from agrimill.operators.reshape import union_families

    return union_families(parts)


@query("""
WITH p AS (SELECT CAST(c_custkey % 360 - 180 AS DOUBLE) AS x, c_acctbal / 200 AS y FROM customer)
SELECT '1.0.0' AS version, 'people' AS source, 'customer' AS table_name,
  'struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string,centroid:struct<x:double,y:double>>' AS structure,
  count(*) AS n_rows, true AS same_when_dealt_anew, count(*) = 0 AS same_when_changed
FROM p WHERE (x + 0.5) * (x + 0.5) + (y - 25) * (y - 25) <= 400 OR (x - 90) * (x - 90) + (y - 10) * (y - 10) <= 25
UNION ALL SELECT '1.0.0', 'sales', 'orders',
  'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>', count(*), true, count(*) = 0
FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderstatus IN ('F') AND o_custkey % 10 IN (3, 7)
""")
def q_manifest(t: Tables):
    """Release manifest; its checksum stays when rows are dealt anew and moves when one row of a table changes one cell."""
    specs = [ORDERS, CUSTOMER, NATION]
    chosen = release.select_release({k: NAMED[k].align(df) for k, df in tables(t).items() if k in NAMED}, specs, FLAVOR)
    touched = {}
    for name, column, key in (("orders", "o_orderstatus", "o_orderkey"), ("customer", "c_mktsegment", "c_custkey")):
        least = chosen[name].agg(F.min(key).alias("_least"))
        one = chosen[name].join(least, F.col(key) == F.col("_least"), "left")
        touched[name] = one.withColumn(column, F.when(F.col("_least").isNotNull(), F.lit("changed")).otherwise(F.col(column))).drop("_least")
    dealt = release.manifest({k: df.repartition(7) for k, df in chosen.items()}, "1.0.0").select("table_name", F.col("checksum").alias("dealt"))
    changed = release.manifest(touched, "1.0.0").select("table_name", F.col("checksum").alias("changed"))
    listed = release.manifest(chosen, "1.0.0", specs).join(dealt, "table_name").join(changed, "table_name")
    return listed.select(
        "version", "source", "table_name", "structure", "n_rows",
        (F.col("checksum") == F.col("dealt")).alias("same_when_dealt_anew"), (F.col("checksum") == F.col("changed")).alias("same_when_changed"),
    )


@query("""
SELECT doc_id, source, 'open' || substr(source, 4) AS licence, CASE WHEN source IN ('src1', 'src2') THEN 'new' ELSE 'old' END AS provider
FROM documents
""")
def q_provenance(t: Tables):
    sources = t.documents.select(F.col("source").alias("datasource")).distinct()
    old = sources.select(
        "datasource", F.lit("old").alias("provider"), F.concat(F.lit("open"), F.substr("datasource", F.lit(4))).alias("licence"),
        F.lit("2020-01-01").alias("updated_at"),
    )
    fresh = old.filter(F.col("datasource").isin("src1", "src2")).withColumn("provider", F.lit("new"))
    credits = release.replace_credits(old, fresh)
    return release.with_provenance(t.documents.select("doc_id", "source"), credits).select("doc_id", "source", "licence", "provider")


@query("""
WITH p AS (SELECT c_custkey, c_name, CAST(c_custkey % 360 - 180 AS DOUBLE) AS x, c_acctbal / 200 AS y FROM customer)
SELECT 'customer' AS table_name, c_custkey AS id, c_name AS name, round(x, 6) AS x FROM p WHERE (x + 0.5) * (x + 0.5) + (y - 25) * (y - 25) <= 400 OR (x - 90) * (x - 90) + (y - 10) * (y - 10) <= 25
UNION ALL SELECT 'orders', o_orderkey, o_orderpriority, NULL FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderstatus IN ('F') AND o_custkey % 10 IN (3, 7)
""")
def q_release_reload(t: Tables):
    """Release written to the shared folder, read back, and checked against its manifest."""
    specs = [ORDERS, CUSTOMER, NATION]
    base = release.write_release(tables(t), specs, FLAVOR, "1.0.0", f"{shared_dir(t.spark)}/releases-{uuid.uuid4().hex}")
    back = release.load_release(t.spark, base)
    customer = back["customer"].select(
        F.lit("customer").alias("table_name"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.round("centroid.x", 6).alias("x")
    )
    orders = back["orders"].select(
        F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.lit(None).cast("double").alias("x")
    )
    return customer.unionByName(orders)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 99, 'NEW', NULL")
def q_publish_current(t: Tables):
    """A good copy is published, then a bad one is set aside: the good one stays current."""
    root = f"{shared_dir(t.spark)}/published-{uuid.uuid4().hex}"
    extra = t.spark.createDataFrame([(99, "NEW")], "n_nationkey int, n_name string")
    release.publish(t.spark, {"nation": NATION.align(t.nation.unionByName(extra, allowMissingColumns=True))}, [NATION], root)
    release.publish(t.spark, {"nation": NATION.align(t.nation.union(t.nation))}, [NATION], root)
    return release.current(t.spark, NATION, root)
