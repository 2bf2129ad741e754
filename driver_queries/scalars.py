"""Scalar functions and parsed text."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrimill.functions import dates, labels, lookups, numbers, phrases, text
from agrimill.sources import delimited, documents
from driver_queries.registry import Tables, query


@query("""
SELECT event_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS started, strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS stopped,
       CAST(CAST(s AS DATE) AS VARCHAR) AS day, CAST(CAST(date_trunc('month', s) AS DATE) AS VARCHAR) AS month_start,
       CAST(CAST(s + INTERVAL 3 DAY AS DATE) AS VARCHAR) AS due, user_id * 12 + 1 AS life_months
FROM (SELECT event_id, user_id, strptime(strftime(ts, '%Y%m%d%H'), '%Y%m%d%H') AS s FROM events)
""")
def q_typed_ts_interval(t: Tables):
    raw = t.events.select(
        "event_id", "user_id", F.date_format("ts", "yyyyMMddHH").alias("stamp"), F.date_format("ts", "yyyyMMdd").alias("d"),
        F.date_format("ts", "yyyy").alias("y"), F.date_format("ts", "MM").alias("m"),
    )
    s = dates.hour_stamp(F.col("stamp"))
    life = dates.years_interval(F.col("user_id")) + dates.months_interval(F.lit(1))
    return raw.select(
        "event_id", F.date_format(s, "yyyy-MM-dd HH:mm:ss").alias("started"),
        F.date_format(s + dates.hours_interval(F.lit(1)), "yyyy-MM-dd HH:mm:ss").alias("stopped"),
        dates.compact_day(F.col("d")).cast("string").alias("day"),
        dates.first_of_month(F.col("y"), F.col("m")).cast("string").alias("month_start"),
        (s + dates.days_interval(F.lit(3))).cast("date").cast("string").alias("due"),
        dates.months_of(life).cast("bigint").alias("life_months"),
    )


@query("""
SELECT p_partkey, lower(regexp_replace(regexp_replace(p_name || ' ' || p_brand || ' ', '[^a-zA-Z0-9]', '_', 'g'), '[^a-zA-Z0-9]$', '')) AS slug,
       regexp_replace(p_brand || '_' || regexp_replace(lower(p_name || '!'), '[^a-zA-Z0-9]', '_', 'g'), '[^a-zA-Z0-9]$', '') AS reference_name
FROM part
""")
def q_slug(t: Tables):
    return t.part.select(
        "p_partkey", text.slug(F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "))).alias("slug"),
        text.slug_with_id(F.col("p_brand"), F.concat("p_name", F.lit("!"))).alias("reference_name"),
    )


SNAKE_SQL = """regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace({0}, '([A-Z0-9]+)([A-Z][a-z])', '\\1_\\2', 'g'),
 '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g'), '^([0-9])', '_\\1')"""


@query(f"""
SELECT doc_id, md5({SNAKE_SQL.format("strip_accents(replace(replace(replace(replace(replace(text, 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'), 'Œ', 'OE'), 'Æ', 'AE'))")}) AS named FROM documents
""")
def q_header_norm(t: Tables):
    """Column-name rule over whole document texts."""
    return t.wide("documents", "doc_id", "text").select("doc_id", F.md5(text.snake(F.col("text"))).alias("named"))


@query("""
WITH r AS (SELECT p_partkey, CASE WHEN p_size < 15 THEN 'bouillie : ' WHEN p_size < 30 THEN 'bouillie de ' WHEN p_size < 45 THEN 'bouillie: ' ELSE 'dose ' END
  || p_size || ' L/' || p_type || '., puis' AS cond, 'D ' || p_type || ' L ' || p_name || '  ' AS city FROM part)
SELECT p_partkey, CASE WHEN cond LIKE 'bouillie%' THEN regexp_extract(cond, 'bouillie ?(:|de) (\\d+) (\\S+)', 2) END AS quantity,
  CASE WHEN cond LIKE 'bouillie%' THEN translate(regexp_extract(cond, 'bouillie ?(:|de) (\\d+) (\\S+)', 3), '.,', '') END AS unit,
  regexp_replace(city, '(^|\\s)([DL]) ', '\\1\\2''', 'g') AS elided,
  regexp_replace(chr(9) || ' ' || city, '^[ \\t]+|[ \\t]+$', '', 'g') AS stripped FROM r
""")
def q_regex_extract(t: Tables):
    size = F.col("p_size")
    lead = F.when(size < 15, "bouillie : ").when(size < 30, "bouillie de ").when(size < 45, "bouillie: ").otherwise("dose ")
    r = t.part.select(
        "p_partkey", F.concat(lead, size.cast("string"), F.lit(" L/"), "p_type", F.lit("., puis")).alias("cond"),
        F.concat(F.lit("D "), "p_type", F.lit(" L "), "p_name", F.lit("  ")).alias("city"),
    )
    quantity, unit = text.capture_quantity_unit(F.col("cond"), ("bouillie : ", "bouillie de ", "bouillie: "))
    return r.select(
        "p_partkey", quantity.alias("quantity"), unit.alias("unit"), text.elide_articles(F.col("city")).alias("elided"),
        text.strip_spaces_tabs(F.concat(F.lit("\t "), "city")).alias("stripped"),
    )


@query("""
SELECT doc_id, md5(translate(text, chr(10) || '";', ' ''.')) AS flat, md5(regexp_replace(text, '(^|\\s)([DL]) ', '\\1\\2''', 'g')) AS elided,
       md5(translate(text, ',.;', '')) AS bare, length(replace(text, ' ', '')) AS n_dense FROM documents
""")
def q_text_documents(t: Tables):
    """Clean-up functions over whole document texts."""
    c = F.col("text")
    return t.wide("documents", "doc_id", "text").select(
        "doc_id", F.md5(text.flatten_sentence(c)).alias("flat"), F.md5(text.elide_articles(c)).alias("elided"),
        F.md5(text.drop_chars(c, ",.;")).alias("bare"), F.length(F.replace(c, F.lit(" "), F.lit(""))).alias("n_dense"),
    )


@query("""
WITH r AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN p_type || '*Désherbage*' || p_name || ' (jeune)'
                WHEN p_size < 30 THEN 'PPAM ' || p_type || '*Trt Part.Aer.*' || upper(p_name)
                ELSE lower(p_type) || ' graminees *' || p_name || ' ( floraison-2 )' END AS phrase, p_size, p_type, p_name FROM part)
SELECT p_partkey,
  CASE WHEN p_size < 10 THEN upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) WHEN p_size < 30 THEN 'PPAM ' || p_type
       ELSE upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' graminées' END AS crop,
  CASE WHEN p_size >= 10 AND p_size < 30 THEN 'Trt Part.Aer.' END AS application,
  CASE WHEN p_size < 10 THEN 'Désherbage*' || p_name || ' jeune'
       WHEN p_size < 30 THEN upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2))
       ELSE upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' Floraison 2' END AS target
FROM r
""")
def q_phrase_parse(t: Tables):
    size = F.col("p_size")
    phrase = (
        F.when(size < 10, F.concat("p_type", F.lit("*Désherbage*"), "p_name", F.lit(" (jeune)")))
        .when(size < 30, F.concat(F.lit("PPAM "), "p_type", F.lit("*Trt Part.Aer.*"), F.upper("p_name")))
        .otherwise(F.concat(F.lower("p_type"), F.lit(" graminees *"), "p_name", F.lit(" ( floraison-2 )")))
    )
    r = t.part.select("p_partkey", phrase.alias("phrase"))
    crop, application, target = phrases.usage_phrase(F.col("phrase"))
    return r.select(
        "p_partkey", phrases.clean_crop(crop).alias("crop"), application.alias("application"),
        phrases.clean_target(target).alias("target"),
    )


@query("""
SELECT p_partkey,
  '{' || concat_ws(',', CASE WHEN p_size >= 10 THEN '"size":"' || p_size || 'centimeter"' END,
                   CASE WHEN p_type <> 'SMALL' THEN '"kind":"' || p_type || '"' END) || '}' AS measures,
  '{"fra":"' || coalesce(nullif(p_brand, 'Brand#1'), '') || '"}' AS label,
  CASE WHEN p_brand <> 'Brand#1' THEN '{"fra":"' || p_brand || '"}' END AS strict_label,
  CASE WHEN p_type = 'PROMO' THEN '{}' ELSE '{"' || p_type || '":"' || p_size || 'gram"}' END AS indicator,
  '{"mass":"' || CASE WHEN p_size >= 20 THEN p_size || 'gram' ELSE '50gram' END || '"}' AS seed,
  CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN '{"' || lower(p_type) || '_flag":true' || CASE WHEN p_size > 25 THEN ',"large_flag":true' ELSE '' END || '}'
       WHEN p_size > 25 THEN '{"large_flag":true}' END AS flags
FROM part
""")
def q_map_build(t: Tables):
    size = F.col("p_size").cast("string")
    present = {
        "size": F.when(F.col("p_size") >= 10, size),
        "kind": F.when(F.col("p_type") != "SMALL", F.col("p_type")),
    }
    named = F.nullif("p_brand", F.lit("Brand#1"))
    mentions = F.array(F.col("p_type"), F.when(F.col("p_size") > 25, F.lit("BIG")).otherwise("-"))
    flags = labels.flags(mentions, {"PROMO": "promo_flag", "ECONOMY": "economy_flag", "BIG": "large_flag"})
    return t.part.select(
        "p_partkey",
        F.to_json(labels.measures({"size": "centimeter", "kind": ""}, present)).alias("measures"),
        F.to_json(labels.label(named)).alias("label"),
        F.to_json(labels.label_or_null(named)).alias("strict_label"),
        F.to_json(labels.indicator(F.nullif("p_type", F.lit("PROMO")), size, F.lit("gram"))).alias("indicator"),
        F.to_json(labels.indicator_or_default("mass", F.when(F.col("p_size") >= 20, size), "gram", "50gram")).alias("seed"),
        F.to_json(flags).alias("flags"),
    )


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type <> 'view' THEN event_type END AS fra FROM events
""")
def q_json_field(t: Tables):
    lab = labels.label_or_null(F.nullif("event_type", F.lit("view")))
    return t.events.select(
        "event_id", labels.json_text(F.col("props"), "$.k").cast("bigint").alias("k"), labels.in_locale(lab).alias("fra")
    )


@query("""
SELECT p_partkey, p_name || '|' || lower(p_type) AS items, 2 AS n_items, CASE WHEN p_size > 20 THEN 1 ELSE 0 END AS n_kept,
       CASE WHEN p_size > 20 THEN lower(p_brand) END AS lowered FROM part
""")
def q_list_literal(t: Tables):
    raw = F.concat(F.lit(" "), "p_name", F.lit(" ,, "), F.lower("p_type"), F.lit(" "))
    maybe = F.when(F.col("p_size") > 20, F.concat(F.lit(" "), "p_brand"))
    items = labels.list_literal(raw)
    return t.part.select(
        "p_partkey", F.array_join(items, "|").alias("items"), F.size(items).alias("n_items"),
        F.size(labels.list_literal(maybe)).alias("n_kept"),
        F.array_join(labels.lowered_items(labels.list_or_null(maybe)), ",").alias("lowered"),
    )


DAY_SQL = "CAST(CAST({0} AS DATE) AS VARCHAR)"


@query(f"""
SELECT o_orderkey, {DAY_SQL.format("o_orderdate")} AS long_day, {DAY_SQL.format("o_orderdate")} AS short_day,
       CASE WHEN year(o_orderdate) = 1996 THEN '2016' || strftime(o_orderdate, '-%m-%d') ELSE {DAY_SQL.format("o_orderdate")} END AS repaired,
       CAST(day(o_orderdate) AS BIGINT) AS d, CAST(month(o_orderdate) AS BIGINT) AS m FROM orders
""")
def q_seg_dates(t: Tables):
    d = F.col("o_orderdate")
    wrong = F.when(F.year(d) == 1996, F.concat(F.date_format(d, "dd/MM/"), F.lit("0016"))).otherwise(F.date_format(d, "dd/MM/yyyy"))
    r = t.orders.select(
        "o_orderkey", F.date_format(d, "dd/MM/yyyy").alias("l"), F.date_format(d, "dd/MM/yy").alias("s"), wrong.alias("w")
    )
    day = dates.day_first(F.col("l"))
    return r.select(
        "o_orderkey", day.cast("string").alias("long_day"), dates.day_first_short(F.col("s")).cast("string").alias("short_day"),
        dates.day_first_repaired(F.col("w")).cast("string").alias("repaired"),
        F.dayofmonth(day).cast("bigint").alias("d"), F.month(day).cast("bigint").alias("m"),
    )


@query("""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'S.' WHEN o_orderpriority <> '5-LOW'
           THEN replace(CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR), '.', ',') END AS price, o_orderstatus, o_custkey FROM orders)
SELECT o_orderkey, CAST(CAST(replace(price, ',', '.') AS DECIMAL(14,2)) AS DOUBLE) AS price, o_custkey AS customer,
       o_orderstatus = 'F' AS finished FROM r WHERE price <> 'S.'
""")
def q_casts(t: Tables):
    text_price = F.replace(F.col("o_totalprice").cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(","))
    raw = F.when(F.col("o_orderpriority") == "1-URGENT", "S.").when(F.col("o_orderpriority") != "5-LOW", text_price)
    r = t.orders.select(
        "o_orderkey", raw.alias("price"), F.when(F.col("o_orderstatus") == "F", "1").alias("flag"),
        F.col("o_custkey").cast("string").alias("customer"),
    )
    kept = r.filter((F.col("price") != "S.") & F.col("price").isNotNull())
    return kept.select(
        "o_orderkey", numbers.decimal_comma(F.col("price")).cast("double").alias("price"),
        F.col("customer").cast("bigint").alias("customer"), lookups.flag_is_one(F.col("flag")).alias("finished"),
    )


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'authorized' WHEN 'O' THEN 'withdrawn' WHEN 'P' THEN 'provisional' END AS state,
       CASE o_orderpriority WHEN '1-URGENT' THEN '< 50 mm' WHEN '2-HIGH' THEN '50 - 100 mm' WHEN '3-MEDIUM' THEN '100 - 150 mm'
            WHEN '4-NOT SPECIFIED' THEN '150 - 200 mm' ELSE '> 200 mm' END AS water,
       CAST(CAST(substr(o_orderpriority, 1, 1) AS INT) * 50 + CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 50 ELSE 0 END AS DOUBLE) AS water_max FROM orders
""")
def q_enum_decode(t: Tables):
    states = {"F": "authorized", "O": "withdrawn", "P": "provisional"}
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).cast("int").alias("class"))
    classes = [(k, *v) for k, v in lookups.WATER_CLASSES.items()]
    out = lookups.enrich(rows, classes, "class int, water_min double, water_max double, water string", "class")
    return out.select(
        "o_orderkey", lookups.decode_strict(F.col("o_orderstatus"), states, "state").alias("state"), "water", "water_max"
    )


@query("""
WITH e AS (SELECT event_id, nullif(event_type, 'view') AS a, CASE WHEN value > 20 THEN ' ' WHEN value > 10 THEN CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END AS v, user_id FROM events)
SELECT event_id, coalesce(a, 'per_year') AS frequency, CASE WHEN v IS NULL OR v = ' ' THEN '0' ELSE v END AS period,
       CASE WHEN v IS NULL OR v = ' ' THEN 0.0 ELSE CAST(v AS DOUBLE) END AS amount
FROM e WHERE a IS NOT NULL OR v IS NOT NULL
""")
def q_defaults(t: Tables):
    price = F.col("value").cast("decimal(10,2)").cast("string")
    e = t.events.select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("a"),
        F.when(F.col("value") > 20, " ").when(F.col("value") > 10, price).alias("v"),
    )
    return e.filter(F.col("a").isNotNull() | F.col("v").isNotNull()).select(
        "event_id", text.default_if_blank(F.col("a"), "per_year").alias("frequency"),
        text.default_if_blank(F.col("v"), "0").alias("period"), numbers.leading_float(F.col("v")).alias("amount"),
    )


@query("""
WITH b AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS seg, c_nationkey FROM customer)
SELECT c_custkey, concat(c_name, seg, c_nationkey) AS skipping, c_name || seg AS strict, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS padded,
       substr(replace(c_name, '#', ''), 1, 12) AS short_name, nullif(concat_ws(' ', seg, CASE WHEN c_nationkey > 5 THEN c_name END), '') AS address,
       CASE WHEN seg IS NULL THEN 'Sclérotiniose' ELSE upper(substr(seg, 1, 1)) || lower(substr(seg, 2)) END AS target, replace(c_name, 'Customer#', '') AS bare
FROM b
""")
def q_text_clean(t: Tables):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    dashed = F.coalesce(seg, F.lit("-"))
    named = F.when(F.col("c_nationkey") > 5, F.col("c_name")).otherwise("nan")
    return t.customer.select(
        "c_custkey", text.join_skip_null("c_name", seg, F.col("c_nationkey")).alias("skipping"),
        text.join_strict("c_name", seg).alias("strict"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("padded"),
        F.substring(F.replace("c_name", F.lit("#"), F.lit("")), 1, 12).alias("short_name"),
        text.address_parts(dashed, named, F.lit("")).alias("address"),
        phrases.clean_target(F.coalesce(seg, F.lit("SCLEROTINIA"))).alias("target"),
        text.drop_chars(F.col("c_name"), "Customer#").alias("bare"),
    )


@query("""
WITH d AS (SELECT o_orderkey, o_orderdate AS a, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 40 DAY END AS b,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate - INTERVAL 9 DAY END AS c FROM orders)
SELECT o_orderkey, CAST(CAST(coalesce(b, a) AS DATE) AS VARCHAR) AS stopped_on,
  concat_ws(' | ', strftime(a, '%d/%m/%Y'), strftime(b, '%d/%m/%Y'), strftime(c, '%d/%m/%Y')) AS restricted,
  concat_ws(' | ', 'first', strftime(b, '%d/%m/%Y'), strftime(c, '%d/%m/%Y')) AS replaced,
  CASE WHEN b IS NOT NULL THEN strftime(b, '%d/%m/%Y') END AS late FROM d
""")
def q_dates_nested(t: Tables):
    """Nested usages of a row: latest date, first element replaced, joined text, NULL for an empty list."""
    day = F.col("o_orderdate").cast("date")

    def usage(d):
        return F.struct(F.date_format(d, "dd/MM/yyyy").alias("day"))

    later = F.when(F.col("o_orderstatus") != "P", F.date_add(day, 40))
    earlier = F.when(F.col("o_orderstatus") == "F", F.date_sub(day, 9))
    nested = t.orders.select("o_orderkey", F.array(usage(day), usage(later), usage(earlier)).alias("usages"))
    days = F.filter(F.transform("usages", lambda u: u["day"]), lambda d: d.isNotNull())
    late = labels.null_if_empty(F.filter(F.array(F.get("usages", 1)["day"]), lambda d: d.isNotNull()))
    return nested.select(
        "o_orderkey", dates.latest_day(days).cast("string").alias("stopped_on"), labels.piped(days).alias("restricted"),
        F.array_join(labels.replace_first(days, F.lit("first")), " | ").alias("replaced"), labels.piped(late).alias("late"),
    )


@query("""
WITH r AS (SELECT l_partkey, l_extendedprice AS p, CAST(floor(l_extendedprice) AS BIGINT) AS w FROM lineitem)
SELECT l_partkey, CAST(sum(CAST(CASE WHEN w >= 1000 THEN w // 1000 ELSE p END AS DECIMAL(14,2))) AS DOUBLE) AS plain,
       CAST(sum(CAST(p AS DECIMAL(14,2))) AS DOUBLE) AS parsed FROM r GROUP BY l_partkey
""")
def q_price_string(t: Tables):
    shown = F.concat(F.lit("€"), F.format_number("l_extendedprice", 2))
    r = t.wide("lineitem", "l_partkey", "l_extendedprice").select("l_partkey", shown.alias("price"))
    plain = numbers.leading_price(F.col("price")).cast("decimal(14,2)")
    parsed = numbers.leading_price(F.col("price"), thousands=True).cast("decimal(14,2)")
    return r.groupBy("l_partkey").agg(F.sum(plain).cast("double").alias("plain"), F.sum(parsed).cast("double").alias("parsed"))


@query("""
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'liter_per_hectare' WHEN 'LARGE' THEN 'percent' WHEN 'PROMO' THEN 'gram_per_kilogram' END AS dose_unit,
       CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 1 WHEN 'PROMO' THEN 1000 END AS factor,
       CASE p_type WHEN 'SMALL' THEN 'herbicide' WHEN 'MEDIUM' THEN 'other' END AS category FROM part
""")
def q_unit_lookup(t: Tables):
    shown = lookups.decode(F.col("p_type"), {"SMALL": "L/ha", "LARGE": "%", "PROMO": "KG/KG VERS", "ECONOMY": "SANS DOSE"})
    out = lookups.with_dose_unit(t.part.select("p_partkey", "p_type", shown.alias("dose_unit_name")), "dose_unit_name")
    kinds = [("SMALL", "herbicide"), ("MEDIUM", "other"), ("SMALL", "second entry is ignored")]
    out = lookups.enrich(out, kinds, "p_type string, category string", "p_type")
    return out.select("p_partkey", "dose_unit", F.col("dose_unit_factor").cast("int").alias("factor"), "category")


@query("""
SELECT c_custkey, c_name AS nom, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment || ', ' || c_nationkey END AS lieu,
       CASE WHEN c_nationkey > 12 THEN '' END AS vide FROM customer
""")
def q_parse_lines(t: Tables):
    """Delimited lines: quoted separators, empty cells, blank lines dropped."""
    place = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(
        F.concat(F.lit('"'), "c_mktsegment", F.lit(", "), F.col("c_nationkey").cast("string"), F.lit('"'))
    )
    empty = F.when(F.col("c_nationkey") > 12, '""').otherwise("")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", place, empty)
    lines = t.customer.select(line.alias("value")).unionByName(t.nation.select(F.regexp_replace("n_name", ".+", "\r").alias("value")))
    out = delimited.parse_lines(lines, ["c_custkey", "nom", "lieu", "vide"])
    return out.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "nom", "lieu", "vide")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS nom, CAST(NULL AS VARCHAR) AS vide, CAST(s_nationkey AS VARCHAR) AS pays FROM supplier")
def q_positional(t: Tables):
    line = F.concat(
        F.lit('"'), F.col("s_suppkey").cast("string"), F.lit('";"'), "s_name", F.lit('";"";'), F.col("s_nationkey").cast("string")
    )
    return delimited.positional(t.supplier.select(line.alias("value")), ["code", "nom", "vide", "pays"])


@query("""
SELECT 'C' || p_partkey AS product_code, 'FR' || p_size AS country, '€' || p_partkey AS price, p_type || ' ' || p_name AS label FROM part
""")
def q_market_payload(t: Tables):
    """Arrays of price objects held as JSON text, one array per part."""
    item = F.struct(
        F.concat(F.lit("FR"), F.col("p_size").cast("string")).alias("memberStateCode"), F.lit("01/02/2020").alias("beginDate"),
        F.lit("07/02/2020").alias("endDate"), F.col("p_type").alias("productName"), F.col("p_name").alias("marketName"),
        F.lit("TONNES").alias("unit"), F.concat(F.lit("€"), F.col("p_partkey").cast("string")).alias("price"),
    )
    raw = t.part.select(F.to_json(F.array(item)).alias("body"), F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("code"))
    out = documents.parse_market_payload(raw, "body", "code")
    return out.select(
        "product_code", F.col("memberStateCode").alias("country"), "price", F.concat_ws(" ", "productName", "marketName").alias("label")
    )


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS numero, p_name AS nom, 'H' || p_size || ',R' || p_size AS codes, p_type AS first_risk FROM part
""")
def q_xml_records(t: Tables):
    """Catalogue records held as XML text, with repeated elements and attributes."""
    size = F.col("p_size").cast("string")
    body = F.concat(
        F.lit("<produit><numero-AMM>"), F.col("p_partkey").cast("string"), F.lit("</numero-AMM><nom-produit>"), "p_name",
        F.lit('</nom-produit><phrases><ref lib-court="H'), size, F.lit('">'), "p_type", F.lit('</ref><ref lib-court="R'), size,
        F.lit('">autre</ref></phrases></produit>'),
    )
    schema = (
        "`numero-AMM` string, `nom-produit` string, phrases struct<ref: array<struct<`_VALUE`: string, `_lib-court`: string>>>"
    )
    out = documents.parse_xml(t.part.select(body.alias("body")), "body", schema)
    refs = F.col("phrases.ref")
    return out.select(
        F.col("numero-AMM").alias("numero"), F.col("nom-produit").alias("nom"),
        F.array_join(F.transform(refs, lambda r: r["_lib-court"]), ",").alias("codes"), F.get(refs, 0)["_VALUE"].alias("first_risk"),
    )


@query("""
SELECT p_type AS name, string_agg(DISTINCT p_brand || '=' || first, ',' ORDER BY p_brand || '=' || first) AS labels FROM (
  SELECT p_type, p_brand, min(p_name) AS first FROM part GROUP BY 1, 2) GROUP BY 1
""")
def q_nomenclature(t: Tables):
    rows = t.part.select(F.col("p_type").alias("name"), F.col("p_brand").alias("locale"), F.col("p_name").alias("label"))
    pairs = F.transform(F.map_entries("label"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return documents.nomenclature(rows).select("name", F.array_join(F.array_sort(pairs), ",").alias("labels"))
