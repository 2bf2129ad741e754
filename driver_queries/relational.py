"""Joins, aggregates, filters, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrimill.functions import labels, lookups, numbers, text
from agrimill.operators import aggregates, joins, keyed, reshape
from driver_queries.registry import Tables, query


def money(col: str):
    return F.col(col).cast("decimal(14,2)").cast("string")


@query("""
WITH p AS (
  SELECT lower(r_name) AS zone, replace(CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR), '.', ',') AS raw
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
z AS (SELECT n_name AS department, upper(r_name) AS region FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT department AS department_zone, count(*) AS n_rows,
       CAST(sum(CAST(replace(raw, ',', '.') AS DECIMAL(20,2))) AS DOUBLE) AS total
FROM p JOIN z ON upper(p.zone) = z.region GROUP BY department
""")
def q_fanout_region(t: Tables):
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    zones = regions.select(F.col("n_name").alias("department"), F.upper("r_name").alias("region"))
    prices = t.customer.join(regions, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower("r_name").alias("zone"), F.replace(money("c_acctbal"), F.lit("."), F.lit(",")).alias("raw")
    )
    # Amounts are summed per zone before the fan-out multiplies them by department.
    summed = prices.groupBy("zone").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(numbers.decimal_comma(F.col("raw"))).alias("total")
    )
    return joins.region_fan_out(summed, zones, "zone").select(
        "department_zone", "n_rows", F.col("total").cast("double").alias("total")
    )


@query("""
SELECT g.s_nationkey, f.s_name, g.elevation FROM (
  SELECT s_nationkey, CAST(min(CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR)) AS BIGINT) AS elevation
  FROM supplier GROUP BY s_nationkey) g
JOIN (SELECT s_nationkey, s_name FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS rn FROM supplier) WHERE rn = 1) f
ON g.s_nationkey = f.s_nationkey
""")
def q_min_text_station(t: Tables):
    alti = F.floor("s_acctbal").cast("string")
    lowest = t.supplier.groupBy("s_nationkey").agg(aggregates.min_text_as_int(alti).cast("bigint").alias("elevation"))
    first = keyed.first_wins(t.supplier.select("s_nationkey", "s_name", "s_suppkey"), ["s_nationkey"], ["s_name", "s_suppkey"])
    return lowest.join(first.select("s_nationkey", "s_name"), "s_nationkey")


@query("""
SELECT p_type, string_agg(DISTINCT coalesce(b, '~'), ' | ' ORDER BY coalesce(b, '~')) AS all_brands,
       string_agg(DISTINCT b, ' | ' ORDER BY b) AS named_brands, count(DISTINCT b) AS n
FROM (SELECT p_type, nullif(p_brand, 'Brand#1') AS b FROM part) GROUP BY p_type
""")
def q_array_distinct(t: Tables):
    b = F.nullif("p_brand", F.lit("Brand#1"))
    out = t.part.groupBy("p_type").agg(
        aggregates.distinct_array(b).alias("items"),
        aggregates.distinct_text(b).alias("named_brands"),
        F.count_distinct(b).alias("n"),
    )
    shown = F.array_join(F.transform("items", lambda x: F.coalesce(x, F.lit("~"))), " | ")
    return out.select("p_type", shown.alias("all_brands"), "named_brands", "n")


@query("""
WITH d AS (SELECT doc_id, nullif(lang, 'en') AS k1, nullif(source, 'src1') AS k2, n_chars FROM documents),
g AS (SELECT k1, k2, min(n_chars) AS shortest FROM d GROUP BY k1, k2)
SELECT d.doc_id, g.shortest FROM d LEFT JOIN g ON d.k1 IS NOT DISTINCT FROM g.k1 AND d.k2 IS NOT DISTINCT FROM g.k2
""")
def q_nullsafe_join(t: Tables):
    d = t.documents.select(
        "doc_id", F.nullif("lang", F.lit("en")).alias("k1"), F.nullif("source", F.lit("src1")).alias("k2"), "n_chars"
    )
    donors = d.select("k1", "k2", F.col("n_chars").alias("shortest"), "doc_id")
    target = d.select("doc_id", "k1", "k2")
    return joins.null_safe_update(target, donors, ["k1", "k2"], "shortest", ["shortest", "doc_id"]).select("doc_id", "shortest")


@query("""
WITH donor AS (SELECT p_brand, p_size FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part WHERE p_type IN ('ECONOMY', 'PROMO'))
  WHERE rn = 1)
SELECT p.p_partkey, CAST(CASE WHEN d.p_brand IS NOT NULL THEN d.p_size ELSE p.p_size END AS BIGINT) AS p_size
FROM part p LEFT JOIN donor d ON p.p_brand = d.p_brand
""")
def q_attr_propagation(t: Tables):
    out = joins.propagate(t.part, "p_brand", F.col("p_type").isin("ECONOMY", "PROMO"), ["p_size"], ["p_partkey"])
    return out.select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"))


@query("""
WITH u AS (SELECT s_suppkey, n_name AS crop FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sets AS (SELECT n_name AS crop, CASE WHEN n_regionkey = 0 THEN 'set_a,set_b' ELSE 'plant' END AS s FROM nation WHERE n_regionkey <= 1),
vars AS (SELECT n_name AS crop, lower(n_name) AS v FROM nation WHERE n_regionkey BETWEEN 1 AND 2),
exc AS (SELECT n_name AS crop, 'exc,' || n_name AS e FROM nation WHERE n_nationkey IN (3, 7))
SELECT s_suppkey, CASE WHEN e IS NOT NULL THEN e WHEN coalesce(s, 'plant') = 'plant' AND v IS NOT NULL THEN v
       ELSE coalesce(s, 'plant') END AS species
FROM u LEFT JOIN sets USING (crop) LEFT JOIN vars USING (crop) LEFT JOIN exc USING (crop)
""")
def q_lookup_chain(t: Tables):
    usages = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("crop_label_fra")
    )
    sets = t.nation.filter("n_regionkey <= 1").select(
        labels.label(F.col("n_name")).alias("label"),
        F.when(F.col("n_regionkey") == 0, "set_a, set_b").otherwise("plant").alias("name"),
    )
    varieties = t.nation.filter("n_regionkey between 1 and 2").select(
        labels.label(F.col("n_name")).alias("label"), F.lower("n_name").alias("name")
    )
    exceptions = t.nation.filter("n_nationkey in (3, 7)").select(
        F.col("n_name").alias("crop_label"), F.concat(F.lit("exc, "), "n_name").alias("species")
    )
    out = joins.species_chain(usages, sets, varieties, exceptions)
    return out.select("s_suppkey", F.array_join("species", ",").alias("species"))


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def q_semi(t: Tables):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return joins.keep_known(t.customer, urgent, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("""
SELECT l_partkey AS value, count(*) AS n_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY l_partkey
""")
def q_orphans(t: Tables):
    from agrimill.operators.quality import orphans

    return orphans(t.lineitem, "l_partkey", t.part.filter("p_size > 10"), "p_partkey")


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def q_anti(t: Tables):
    return joins.drop_known(t.customer, t.orders.filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select(
        "c_custkey", "c_name"
    )


@query("""
SELECT suffix, l_returnflag, count(*) AS n, round(sum(low), 2) AS low, round(sum(high), 2) AS high FROM (
  SELECT l_returnflag, '_a' AS suffix, 0 AS low, l_discount AS high FROM lineitem
  UNION ALL SELECT l_returnflag, '_b', l_discount, l_tax FROM lineitem
  UNION ALL SELECT l_returnflag, '_c', l_tax, l_quantity FROM lineitem) GROUP BY suffix, l_returnflag
""")
def q_unpivot_segments(t: Tables):
    c = F.col
    segments = [
        ("_a", {"low": F.lit(0.0), "high": c("l_discount")}),
        ("_b", {"low": c("l_discount"), "high": c("l_tax")}),
        ("_c", {"low": c("l_tax"), "high": c("l_quantity")}),
    ]
    rows = reshape.unpivot_segments(t.lineitem.select("l_returnflag", "l_discount", "l_tax", "l_quantity"), segments)
    return rows.groupBy("suffix", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("low"), 2).alias("low"), F.round(F.sum("high"), 2).alias("high")
    )


@query("""
SELECT l_partkey, round(regr_slope(ln(l_extendedprice), ln(l_quantity)), 4) AS slope,
       round(regr_intercept(ln(l_extendedprice), ln(l_quantity)), 4) AS intercept,
       round(round(exp(regr_intercept(ln(l_extendedprice), ln(l_quantity))) * pow(70, regr_slope(ln(l_extendedprice), ln(l_quantity))), 4), 1) AS at_70,
       round(sqrt(var_pop(l_quantity)), 4) AS dev_x,
       round(covar_pop(l_extendedprice, l_quantity) / var_pop(l_quantity), 4) AS linear_slope
FROM lineitem GROUP BY l_partkey HAVING max(l_quantity) > min(l_quantity)
""")
def q_loglog_fit(t: Tables):
    li = t.lineitem.select("l_partkey", "l_quantity", "l_extendedprice")
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    lx, ly = F.ln(x), F.ln(y)
    slope, intercept = F.regr_slope(ly, lx), F.regr_intercept(ly, lx)
    fit = li.groupBy("l_partkey").agg(
        slope.alias("slope"), intercept.alias("intercept"), F.var_pop(x).alias("var_x"),
        F.covar_pop(x, y).alias("cov_xy"), F.min(x).alias("low"), F.max(x).alias("high"),
    ).filter("high > low")
    at = aggregates.loglog_at(F.lit(70.0), F.col("slope"), F.col("intercept"))
    return fit.select(
        "l_partkey", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round(at, 1).alias("at_70"), F.round(F.sqrt("var_x"), 4).alias("dev_x"),
        F.round(F.col("cov_xy") / F.col("var_x"), 4).alias("linear_slope"),
    )


@query("""
WITH c AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'H317' WHEN 'purchase' THEN 'H361d' WHEN 'click' THEN 'R36'
                  WHEN 'signup' THEN 'H300' ELSE 'X1' END AS code, value FROM events),
m AS (SELECT user_id, CASE code WHEN 'H317' THEN 48 WHEN 'R36' THEN 24 ELSE 6 END AS h,
             CASE code WHEN 'H361d' THEN '3' WHEN 'H300' THEN '5' ELSE '1' END AS k FROM c WHERE value > 20)
SELECT user_id, max(h) AS hours, string_agg(DISTINCT k, ',' ORDER BY k) AS raw_cat,
       CASE WHEN string_agg(DISTINCT k, ',' ORDER BY k) LIKE '1%' THEN string_agg(DISTINCT k, ',' ORDER BY k)
            ELSE '1,' || string_agg(DISTINCT k, ',' ORDER BY k) END AS categories
FROM m GROUP BY user_id
""")
def q_severity(t: Tables):
    kinds = {"error": "H317", "purchase": "H361d", "click": "R36", "signup": "H300"}
    code = lookups.decode(F.col("event_type"), kinds, "X1")
    out = t.events.filter("value > 20").groupBy("user_id").agg(
        aggregates.reentry_hours(code).alias("hours"), aggregates.mix_categories(code).alias("c"),
        F.array_sort(F.collect_set(F.coalesce(lookups.decode(code, lookups.H_MIX_CATEGORY), F.lit(1)))).alias("r"),
    )
    return out.select(
        "user_id", "hours", F.array_join(F.col("r").cast("array<string>"), ",").alias("raw_cat"),
        F.array_join(F.col("c").cast("array<string>"), ",").alias("categories"),
    )


@query("""
WITH codes AS (
  SELECT c_nationkey AS k, CASE c_mktsegment WHEN 'BUILDING' THEN 'H341 + R62' WHEN 'MACHINERY' THEN 'H373' ELSE 'X' END AS code FROM customer
  UNION SELECT s_nationkey, CASE WHEN s_acctbal > 9000 THEN 'H300 + H301' ELSE 'R40' END FROM supplier),
single AS (SELECT k, unnest(string_split(code, ' + ')) AS c FROM codes)
SELECT k AS nation, greatest(1, max(CASE WHEN c IN ('H300', 'H301') THEN 5 WHEN c = 'H373' THEN 4 WHEN c = 'R62' THEN 3
       WHEN c IN ('H341', 'R40') THEN 2 ELSE 1 END)) AS mix_category_code FROM single GROUP BY k
""")
def q_legacy_mix(t: Tables):
    seg = {"BUILDING": "H341 + R62", "MACHINERY": "H373"}
    phrases = t.customer.select(
        F.col("c_nationkey").alias("nation"), lookups.decode(F.col("c_mktsegment"), seg, "X").alias("code")
    )
    risks = t.supplier.select(
        F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") > 9000, "H300 + H301").otherwise("R40").alias("code")
    )
    return aggregates.legacy_mix_category(phrases, risks, "nation", "code")


@query("""
SELECT 'CU' || c_custkey AS id, 'customer' AS family, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, 'EUR' AS currency, NULL AS size FROM customer
UNION ALL SELECT 'SU' || s_suppkey, 'supplier', s_name, CAST(s_nationkey AS BIGINT), 'EUR', NULL FROM supplier
UNION ALL SELECT 'PA' || p_partkey, 'part', p_name, NULL, NULL, CAST(p_size AS VARCHAR) FROM part
""")
def q_union_families(t: Tables):
    cu = t.customer.select(
        text.join_skip_null(F.lit("CU"), F.col("c_custkey")).alias("id"), F.lit("customer").alias("family"),
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("nation"), F.lit("EUR").alias("currency"),
    )
    su = t.supplier.select(
        text.join_skip_null(F.lit("SU"), F.col("s_suppkey")).alias("id"), F.lit("supplier").alias("family"),
        F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("nation"), F.lit("EUR").alias("currency"),
    )
    pa = t.part.select(
        text.join_skip_null(F.lit("PA"), F.col("p_partkey")).alias("id"), F.lit("part").alias("family"),
        F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("size"),
    )
    return reshape.union_families([cu, su, pa])


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def q_union_distinct(t: Tables):
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@query("""
SELECT l_partkey, min(l_quantity) AS dose FROM lineitem WHERE l_returnflag || l_linestatus LIKE 'A%' GROUP BY l_partkey
""")
def q_existing_min_dose(t: Tables):
    unit = F.concat("l_returnflag", "l_linestatus")
    return t.lineitem.filter(unit.like("A%")).groupBy("l_partkey").agg(F.min("l_quantity").alias("dose"))


@query("""
WITH e AS (SELECT event_id, CASE WHEN value > 50 THEN NULL ELSE event_type END AS kind FROM events)
SELECT event_id, kind FROM e WHERE kind <> 'click' AND kind <> 'view' ORDER BY event_id
""")
def q_predicates(t: Tables):
    e = t.events.select("event_id", F.when(F.col("value") <= 50, F.col("event_type")).alias("kind"))
    return e.filter(F.col("kind") != "click").filter(~F.col("kind").isin("view")).orderBy("event_id")


@query("""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE starts_with(o_orderpriority, '1') AND o_orderstatus NOT IN ('P') ORDER BY o_orderkey LIMIT 20
""")
def q_top_ordered(t: Tables):
    """Ordered look at the first rows: the limit is the operator."""
    o = t.orders.filter(F.startswith("o_orderpriority", F.lit("1")) & ~F.col("o_orderstatus").isin("P"))
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus").orderBy("o_orderkey").limit(20)


@query("""
WITH dim AS (SELECT n_nationkey AS id, n_name AS specie FROM nation WHERE n_regionkey <> 2),
upd AS (SELECT n_nationkey AS id, 'R' || n_regionkey AS shape FROM nation WHERE n_regionkey >= 3),
base AS (SELECT c_custkey, c_nationkey, c_name, c_mktsegment FROM customer)
SELECT b.c_custkey, dim.specie, s.n_sup, coalesce(upd.shape, b.c_mktsegment) AS shape, n.n_nationkey AS label_key,
       upper(b.c_name) AS c_name
FROM base b JOIN dim ON b.c_nationkey = dim.id
LEFT JOIN (SELECT s_nationkey, count(*) AS n_sup FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON s.s_nationkey = b.c_nationkey
LEFT JOIN upd ON upd.id = b.c_nationkey
JOIN nation n ON n.n_name = dim.specie
""")
def q_dim_joins(t: Tables):
    dim = t.nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("specie"))
    upd = t.nation.filter("n_regionkey >= 3").select(
        F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("R"), "n_regionkey").alias("shape")
    )
    counted = t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count(F.lit(1)).alias("n_sup"))
    labelled = t.nation.select(F.col("n_nationkey").alias("label_key"), labels.label(F.col("n_name")).alias("label"))
    base = t.customer.select("c_custkey", "c_nationkey", "c_name", F.col("c_mktsegment").alias("shape"))
    out = base.join(dim, "c_nationkey").join(counted, "c_nationkey", "left")
    out = joins.fill_from(out, upd, "c_nationkey", ["shape"])
    out = joins.join_on_label(out, "specie", labelled, "label").withColumn("c_name", F.upper("c_name"))
    return out.select("c_custkey", "specie", "n_sup", "shape", "label_key", "c_name")


@query("SELECT DISTINCT p_type, p_brand FROM part ORDER BY p_type, p_brand")
def q_distinct_ordered(t: Tables):
    return t.part.select("p_type", "p_brand").dropDuplicates().orderBy("p_type", "p_brand")


@query("""
WITH f AS (SELECT o_custkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1)
SELECT c_custkey, o_orderpriority AS city FROM customer LEFT JOIN f ON c_custkey = o_custkey
""")
def q_city_lookup(t: Tables):
    found = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("city"), "o_orderdate", "o_orderkey")
    return joins.lookup_first(t.customer.select("c_custkey"), found, "c_custkey", "city", ["o_orderdate", "o_orderkey"])


@query("""
SELECT l_suppkey, l_shipmode, n, n_sup FROM (
  SELECT l_suppkey, l_returnflag AS l_shipmode, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2) x JOIN (SELECT s_suppkey, s_nationkey AS n_sup FROM supplier) ON l_suppkey = s_suppkey
""")
def q_salted_join(t: Tables):
    """Large side joined with its hot keys spread; any key above 100 rows counts as hot here."""
    li = t.lineitem.select(F.col("l_suppkey"), F.col("l_returnflag").alias("l_shipmode"), "l_orderkey", "l_linenumber")
    sup = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_sup"))
    joined = joins.salted_join(li, sup, ["l_suppkey"], hot_rows=100, salts=8)
    return joined.groupBy("l_suppkey", "l_shipmode", "n_sup").agg(F.count(F.lit(1)).alias("n"))
