"""Scalar functions, hand-computed, each trap included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrimill.functions import dates, labels, lookups, numbers, phrases, text
from tests.conftest import rows


def one(spark, expr, schema="x string", value=(None,)):
    return spark.createDataFrame([value], schema).select(expr.alias("v")).collect()[0][0]


def s(spark, f, value):
    return one(spark, f(F.col("x")), value=(value,))


def test_concat_forms(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert rows(df.select(text.join_skip_null("x", "y"), text.join_strict("x", "y"))) == [("a", None)]


def test_header_names():
    got = text.header_names(["N°", "Nom du Produit", "", None, "2e colonne", "codeAMM", "  ", "Œuvre été"])
    assert got == ["n", "nom_du_produit", "padding2", "padding3", "_2e_colonne", "code_amm", "padding6", "o_euvre_ete"]


def test_one_header_rule(spark):
    """Readers and the column rule name alike: ligatures, double acutes, marks of their own, letters without a plain form."""
    cells = ["Œuvre été", "Straße", "Ő Ű", "e\u0301te\u0301", "ǆ ﬁn", "m²", "жизнь 7", "ABCDef", "_x_", "Łódź", "", "½ part", "日本 N°2"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cells)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(text.snake(F.col("x"))).collect()]
    assert got == [text.snake_name(x) for x in cells]
    assert got[:6] == ["o_euvre_ete", "strasse", "o_u", "ete", "dz_fin", "m2"]


def test_slug_forms(spark):
    assert s(spark, text.slug, "AB-C d!") == "ab_c_d_"[:-1]
    assert s(spark, text.slug, "AB!!") == "ab_"
    df = spark.createDataFrame([("2X", "Név É!")], "i string, n string")
    assert rows(df.select(text.slug_with_id(F.col("i"), F.col("n")))) == [("2X_n_v__",)]


@pytest.mark.parametrize("given,want", [
    ("D ALLIER", "D'ALLIER"), ("ST L ISLE D ABEAU", "ST L'ISLE D'ABEAU"), ("BOURG D", "BOURG D"), ("AD LIB", "AD LIB"),
])
def test_elision(spark, given, want):
    assert s(spark, text.elide_articles, given) == want


def test_flatten_and_strip(spark):
    assert s(spark, text.flatten_sentence, 'a\nb"c;d') == "a b'c.d"
    assert s(spark, text.strip_spaces_tabs, "\t x y \t") == "x y"


@pytest.mark.parametrize("given,want", [
    ("Volume de bouillie : 400 L/ha, puis", ("400", "L/ha")), ("bouillie de 200 litres.", ("200", "litres")),
    ("bouillie: 10 L", ("10", "L")), ("bouillie epaisse", (None, None)), (None, (None, None)),
])
def test_spray_phrasings(spark, given, want):
    q, u = text.capture_quantity_unit(F.col("x"), ("bouillie : ", "bouillie de ", "bouillie: "))
    assert rows(spark.createDataFrame([(given,)], "x string").select(q, u)) == [want]


def test_address_parts(spark):
    df = spark.createDataFrame([("12", "-", "rue X"), ("nan", None, "")], "a string, b string, c string")
    assert rows(df.select(text.address_parts(F.col("a"), F.col("b"), F.col("c")))) == [("12 rue X",), (None,)]


@pytest.mark.parametrize("given,want", [("12,345", 12.35), ("7", 7.0), ("S.", None), (None, None), ("-1,5", -1.5)])
def test_decimal_comma(spark, given, want):
    got = s(spark, numbers.decimal_comma, given)
    assert got is None if want is None else float(got) == want


@pytest.mark.parametrize("given,want", [("€1,234.50", 1.0), ("€198.40", 198.4), ("n/a", 0.0), ("^5", 0.0), (".5", 0.5), (None, None)])
def test_leading_price(spark, given, want):
    assert s(spark, numbers.leading_price, given) == want


def test_price_thousands(spark):
    assert one(spark, numbers.leading_price(F.col("x"), True), value=("€1,234.50",)) == 1234.5


@pytest.mark.parametrize("given,want", [("3,5 kg", 3.5), ("", 0.0), (None, 0.0), ("x", 0.0), ("-2", -2.0)])
def test_leading_float(spark, given, want):
    assert s(spark, numbers.leading_float, given) == want


def test_int_of_float_text(spark):
    assert s(spark, numbers.int_of_float_text, "5.9") == 5


def test_md5_prefix_wraps_to_signed(spark):
    import hashlib

    for value in ("a", "b", "c", "d"):
        h = int(hashlib.md5(value.encode()).hexdigest()[:8], 16)
        assert s(spark, numbers.md5_prefix_int, value) == (h - 2**32 if h >= 2**31 else h)


@pytest.mark.parametrize("given,want", [
    ("01/02/19", dt.date(2019, 2, 1)), ("1/2/69", dt.date(2069, 2, 1)), ("01/02/70", dt.date(1970, 2, 1)),
    ("31/12/2020", dt.date(2020, 12, 31)), (None, None),
])
def test_short_dates(spark, given, want):
    assert s(spark, dates.day_first_short, given) == want


def test_year_sixteen(spark):
    assert s(spark, dates.day_first_repaired, "05/06/0016") == dt.date(2016, 6, 5)
    assert s(spark, dates.day_first_repaired, "05/06/2017") == dt.date(2017, 6, 5)
    assert s(spark, dates.day_first_repaired, None) is None


def test_hour_stamp_has_no_zone(spark):
    assert s(spark, dates.hour_stamp, "2020123123") == dt.datetime(2020, 12, 31, 23)


def test_intervals(spark):
    assert s(spark, lambda c: dates.days_interval(c), "3") == dt.timedelta(days=3)
    assert s(spark, lambda c: dates.hours_interval(c), "48") == dt.timedelta(hours=48)
    assert s(spark, lambda c: dates.months_of(dates.years_interval(c)), "2") == 24


def test_label_forms(spark):
    assert s(spark, labels.label, None) == {"fra": ""}
    assert s(spark, labels.label_or_null, None) is None
    assert s(spark, lambda c: labels.in_locale(labels.label(c)), "x") == "x"


@pytest.mark.parametrize("given,want", [(" a, b ,c ", ["a", "b", "c"]), (None, []), ("", []), ("x", ["x"])])
def test_list_literal(spark, given, want):
    assert s(spark, labels.list_literal, given) == want


def test_list_keeps_null(spark):
    assert s(spark, labels.list_or_null, None) is None


def test_flags(spark):
    df = spark.createDataFrame([(["Mention abeille", "x"],), ([],), (None,)], "m array<string>")
    got = [r[0] for r in df.select(labels.flags(F.col("m"), lookups.MENTION_FLAGS)).collect()]
    assert got == [{"bee_usage": True}, None, None]


def test_replace_first(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "m array<string>")
    assert [r[0] for r in df.select(labels.replace_first(F.col("m"), F.lit("z"))).collect()] == [["z", "b"], []]


def test_strict_decode_fails_on_unknown(spark):
    assert s(spark, lambda c: lookups.decode_strict(c, lookups.USAGE_STATES, "state"), "Retrait") == "withdrawn"
    assert s(spark, lambda c: lookups.decode_strict(c, lookups.USAGE_STATES, "state"), None) is None
    with pytest.raises(Exception, match="unknown state: Autre"):
        s(spark, lambda c: lookups.decode_strict(c, lookups.USAGE_STATES, "state"), "Autre")


def test_dose_units_first_match(spark, raw):
    df = lookups.with_dose_unit(raw("u", [("L/ha",), ("mL/ha",), ("SANS DOSE",)]), "u")
    got = {r["u"]: (r["dose_unit"], r["dose_unit_factor"]) for r in df.collect()}
    assert got["L/ha"] == ("liter_per_hectare", 1.0)
    assert got["mL/ha"][1] == pytest.approx(0.001)
    assert got["SANS DOSE"] == (None, None)


@pytest.mark.parametrize("phrase,want", [
    ("Blé*Trt Part.Aer.*Rouille", ("Blé", "Trt Part.Aer.", "Rouille")), ("Blé*Rouille", ("Blé", None, "Rouille")),
    ("Vigne*Désherbage*Toutes*cultures", ("Vigne", None, "Désherbage*Toutes*cultures")),
    ("Mais*Trt Sol*Avt Plantation", ("Mais", None, "Trt Sol*Avt Plantation")),
])
def test_usage_phrase(spark, phrase, want):
    df = spark.createDataFrame([(phrase,)], "x string")
    assert rows(df.select(*phrases.usage_phrase(F.col("x")))) == [want]


@pytest.mark.parametrize("given,want", [
    ("MAIS doux ", "Maïs doux"), ("Chataignier", "Châtaignier"), ("PPAM Non", "PPAM Non"), ("prunier - abricotier", "Prunier"),
    ("Porte graine - GRAMINEES", "Porte graine - GRAMINEES"), ("Pois écossées", "Pois écossés"),
])
def test_clean_crop(spark, given, want):
    assert s(spark, phrases.clean_crop, given) == want


@pytest.mark.parametrize("given,want", [
    (" ROUILLE", "Rouille"), ("RHIZOCTONIA", "Rhizoctone"), ("SCLEROTINIA", "Sclérotiniose"), ("mouches ( adultes)", "Mouches adultes"),
    ("ROUILLE COURONNEE", "Rouille couronnée"), ("Act.floraison", "Act. Floraison"), ("Stade 1-fin.", "Stade fin"), ("Maladie.x", "Maladie. x"),
    ("Ensilage", "ensilage"),
])
def test_clean_target(spark, given, want):
    assert s(spark, phrases.clean_target, given) == want
