"""Dedupe, upsert, scope replacement, runs, sheets, surrogate ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrimill.functions import numbers
from agrimill.operators import keyed, runs
from agrimill.operators.aggregates import latest_version
from agrimill.operators.release import at_version
from agrimill.session import shared_path
from agrimill.sources.delimited import read_delimited
from agrimill.sources.shards import new_files, union_tables
from driver_queries.registry import Tables, query


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, o_orderstatus FROM orders),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM o WHERE o_orderstatus = 'F') WHERE rn = 1),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM o WHERE o_orderstatus <> 'F') WHERE rn = 1 AND o_custkey NOT IN (SELECT o_custkey FROM f))
SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM f
UNION ALL SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM n
""")
def q_first_wins(t: Tables):
    o = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    order = ["o_orderdate", "o_orderkey"]
    existing = keyed.insert_ignore(None, o.filter("o_orderstatus = 'F'"), ["o_custkey"], order)
    out = keyed.insert_ignore(existing, o.filter("o_orderstatus <> 'F'"), ["o_custkey"], order)
    return out.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


@query("""
WITH base AS (SELECT * FROM part WHERE p_type <> 'ECONOMY'),
over AS (SELECT p_partkey, upper(p_name) AS p_name, p_brand, 0 AS p_size FROM part WHERE p_brand LIKE 'Brand#1%')
SELECT coalesce(b.p_partkey, o.p_partkey) AS p_partkey, CASE WHEN o.p_partkey IS NOT NULL THEN o.p_name ELSE b.p_name END AS p_name,
       CASE WHEN b.p_partkey IS NOT NULL THEN b.p_brand ELSE o.p_brand END AS p_brand,
       CAST(CASE WHEN b.p_partkey IS NOT NULL THEN b.p_size ELSE o.p_size END AS BIGINT) AS p_size
FROM base b FULL OUTER JOIN over o ON b.p_partkey = o.p_partkey
""")
def q_upsert_one_col(t: Tables):
    size = F.col("p_size").cast("bigint")
    base = t.part.filter("p_type <> 'ECONOMY'").select("p_partkey", "p_name", "p_brand", size.alias("p_size"))
    over = t.part.filter("p_brand like 'Brand#1%'").select(
        "p_partkey", F.upper("p_name").alias("p_name"), "p_brand", F.lit(0).cast("bigint").alias("p_size")
    )
    return keyed.upsert_columns(base, over, ["p_partkey"], ["p_name"])


@query("""
SELECT 'nation_' || n_nationkey AS id, n_name AS fra, n_name AS eng FROM nation
UNION ALL SELECT 'customer_' || c_custkey, c_name, c_name FROM customer
UNION ALL SELECT 'supplier_' || s_suppkey, upper(s_name), lower(s_name) FROM supplier
""")
def q_prefix_replace(t: Tables):
    def labelled(df, key, fra, eng):
        return df.select(F.col(key).alias("reference_name"), fra.alias("fra"), eng.alias("eng"))

    nations = keyed.translations(labelled(t.nation, "n_nationkey", F.col("n_name"), F.col("n_name")), "nation")
    people = keyed.translations(labelled(t.customer, "c_custkey", F.col("c_name"), F.col("c_name")), "customer")
    old = keyed.translations(labelled(t.supplier, "s_suppkey", F.col("s_name"), F.col("s_name")), "supplier")
    new = keyed.translations(labelled(t.supplier, "s_suppkey", F.upper("s_name"), F.lower("s_name")), "supplier")
    table = nations.unionByName(people).unionByName(old)
    return keyed.replace_scope(table, "scope", "supplier", new).select("id", "fra", "eng")


@query("""
SELECT conv_id, turn, role FROM (
  SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
WHERE prev IS NULL OR prev <> role
""")
def q_run_headers(t: Tables):
    c = t.conversations.select("conv_id", "turn", "role")
    return runs.run_heads(c, ["conv_id"], "turn", F.col("role"))


@query("""
SELECT a.l_orderkey, a.l_linenumber, a.flag FROM (
  SELECT *, lag(flag) OVER (PARTITION BY flag2 ORDER BY pos) AS prev FROM (
    SELECT o_orderkey AS l_orderkey, o_orderkey AS pos, 1 AS l_linenumber, o_orderstatus AS flag, 1 AS flag2 FROM orders)) a
WHERE prev IS NULL OR prev <> flag
""")
def q_run_headers_one_sheet(t: Tables):
    """All orders as one sheet: the look-back is cut into chunks of row numbers."""
    o = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("o_orderstatus").alias("flag"),
        F.lit(1).alias("sheet"),
    )
    return runs.run_heads(o, ["sheet"], "l_orderkey", F.col("flag"), chunk=1000).drop("sheet")


@query("""
WITH p AS (SELECT conv_id, turn, max(CASE WHEN role = 'user' THEN text END) AS "user", max(CASE WHEN role = 'assistant' THEN text END) AS assistant,
           max(CASE WHEN role = 'system' THEN text END) AS system FROM conversations GROUP BY conv_id, turn)
SELECT p.conv_id, p.turn AS row, md5(coalesce(p."user", '')) AS user_text, md5(coalesce(p.assistant, '')) AS assistant_text,
       md5(coalesce(h."user", h.system, '')) AS opened
FROM p JOIN p h ON h.conv_id = p.conv_id AND h.turn = 0 WHERE p.turn >= 1
""")
def q_sheet_pivot(t: Tables):
    cells = t.conversations.select("conv_id", F.col("turn").alias("row"), F.col("role").alias("col"), F.col("text").alias("value"))
    rows = runs.sheet_rows(cells, ["user", "assistant", "system"], ["conv_id"])
    lines = runs.with_header_line(rows, ["conv_id"], 0, {"user": "h_user", "system": "h_system"}, 1)

    def digest(*c):
        return F.md5(F.coalesce(*c, F.lit("")))

    return lines.select(
        "conv_id", "row", digest(F.col("user")).alias("user_text"), digest(F.col("assistant")).alias("assistant_text"),
        digest(F.col("h_user"), F.col("h_system")).alias("opened"),
    )


@query("""
SELECT n_nationkey, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS record_checksum FROM (
  SELECT n_nationkey, CAST('0x' || substr(md5(concat(n_nationkey, n_name, nullif(n_regionkey, 0))), 1, 8) AS BIGINT) AS h FROM nation)
""")
def q_checksum(t: Tables):
    code = numbers.md5_prefix_int("n_nationkey", "n_name", F.nullif("n_regionkey", F.lit(0)))
    return t.nation.select("n_nationkey", code.cast("bigint").alias("record_checksum"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders")
def q_surrogate(t: Tables):
    return keyed.surrogate_dense(t.orders.select("o_orderkey"), "id", "o_orderkey", width=4096).select("o_orderkey", "id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_duplicate_keys(t: Tables):
    return keyed.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT event_id, event_type FROM events WHERE NOT (value > 30 AND event_type = 'error')")
def q_delete_where(t: Tables):
    return keyed.delete_where(t.events, (F.col("value") > 30) & (F.col("event_type") == "error")).select("event_id", "event_type")


VERSION_SQL = "'1.' || CAST(year(o_orderdate) - 1990 AS VARCHAR) || '.' || CAST(month(o_orderdate) AS VARCHAR)"


@query(f"""
WITH v AS (SELECT o_orderkey, {VERSION_SQL} AS release FROM orders),
n AS (SELECT release FROM v ORDER BY CAST(split_part(release, '.', 2) AS INT) DESC, CAST(split_part(release, '.', 3) AS INT) DESC LIMIT 1)
SELECT o_orderkey, release FROM v WHERE release = (SELECT release FROM n)
""")
def q_latest_version(t: Tables):
    version = F.concat(
        F.lit("1."), (F.year("o_orderdate") - 1990).cast("string"), F.lit("."), F.month("o_orderdate").cast("string")
    )
    return at_version(t.orders.select("o_orderkey", version.alias("release"))).select("o_orderkey", "release")


@query(f"""
WITH v AS (SELECT {VERSION_SQL} AS release FROM orders)
SELECT release FROM v ORDER BY CAST(split_part(release, '.', 2) AS INT) DESC, CAST(split_part(release, '.', 3) AS INT) DESC LIMIT 1
""")
def q_newest(t: Tables):
    version = F.concat(
        F.lit("1."), (F.year("o_orderdate") - 1990).cast("string"), F.lit("."), F.month("o_orderdate").cast("string")
    )
    return latest_version(t.orders.select(version.alias("release")), "release")


@query("""
SELECT shard, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total,
       CAST(sum(CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) < 1996 THEN 1 ELSE 0 END) AS BIGINT) AS finished
FROM (SELECT *, CASE WHEN year(o_orderdate) < 1996 THEN 'early' ELSE 'late' END AS shard FROM orders) GROUP BY shard
""")
def q_shards(t: Tables):
    early = t.orders.filter(F.year("o_orderdate") < 1996).select("o_totalprice", "o_orderstatus")
    late = t.orders.filter(F.year("o_orderdate") >= 1996).select("o_totalprice")
    rows = union_tables({"early": early, "late": late}, "shard")
    return rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("total"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("finished"),
    )


@query("""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'a%20' WHEN o_orderkey % 3 = 1 THEN 'b c' ELSE 'd' END AS shard, o_orderkey AS order_key, o_orderpriority AS order_priority,
       CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_custkey AS VARCHAR) END AS cust_key
FROM orders
""")
def q_shard_files(t: Tables):
    """Orders written as delimited files of three layouts under odd names, read back as one table with the shard kept."""
    folder = shared_path(t.spark, "shards")
    layouts = (("a%20", ["orderKey", "orderPriority", "custKey"]), ("b c", ["custKey", "orderKey", "orderPriority"]), ("d", ["orderPriority", "orderKey"]))
    named = t.orders.select(F.col("o_orderkey").alias("orderKey"), F.col("o_orderpriority").alias("orderPriority"), F.col("o_custkey").alias("custKey"))
    for i, (name, columns) in enumerate(layouts):
        named.where(F.col("orderKey") % 3 == i).select(*columns, F.lit(name).alias("shard")).write.option("header", True).csv(f"{folder}/{name}")
    rows = read_delimited(t.spark, [f"{folder}/{name}" for name, _ in layouts])
    return rows.select("shard", F.col("order_key").cast("long").alias("order_key"), "order_priority", "cust_key")


@query("""
WITH m AS (SELECT url AS path, sha256(html) AS h, length(html) AS size FROM pages WHERE html LIKE '%lang="fr"%')
SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.path = p.url AND m.h = sha256(p.html))
""")
def q_new_files(t: Tables):
    files = t.pages.select(
        "page_id", "url", F.col("url").alias("path"), F.length("html").cast("bigint").alias("size"),
        F.lit(None).cast("timestamp").alias("modified"), F.sha2("html", 256).alias("sha256"), "html",
    )
    seen = files.filter(F.contains("html", F.lit('lang="fr"'))).select("path", "size", "modified", "sha256")
    return new_files(files, seen).select("page_id", "url")
