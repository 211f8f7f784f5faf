"""Scalar text and URL functions against the stated fixture cases."""

import pytest
from pyspark.sql import functions as F

from pricelake.functions import text as T
from pricelake.functions import urls as U


def one(spark, col_fn, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col("x"))).collect()]


def test_price_extract(spark):
    got = one(spark, T.price_extract, ["1.234,56 €", "1234,56 €", "12 €", "1,39 €", "2,5 €", None])
    assert got == ["1.234,56", "234,56", "", "1,39", "", ""]


def test_ppu_extract_dia(spark):
    got = one(spark, T.ppu_extract_dia, ["1,39 €/kg", "1,39 € por kilogramo", "0,95 €/100 ml", "x 2,00\xa0€ / ud"])
    assert got == ["1,39 € / kg", "1,39 € por kilogramo", "0,95 € / 100", "2,00 € / ud"]


def test_ppu_alcampo(spark):
    assert one(spark, T.ppu_tidy_alcampo, ["(1,85 €/l)", "(1,39 € por kilogramo)"]) == \
        ["1,85 € / l", "1,39 € por kilogramo"]
    assert one(spark, T.ppu_extract_alcampo, ["Leche 8,95 €/kg x", "nada"]) == ["8,95 € / kg", ""]


def test_brand_first_upper(spark):
    got = one(spark, T.brand_first_upper, ["ALPRO x", "(ACME), x", "A x", "12 Huevos", "7UP lata", "Leche"])
    assert got == ["ALPRO", "ACME", "", "12", "7UP", ""]


def test_slugify(spark):
    got = one(spark, T.slugify, ["Leche, Huevos y Lácteos", "", "5 €", "Straße ñu"])
    assert got == ["leche-huevos-y-lacteos", "mercadona", "5", "strae-nu"]


def test_slug_to_label(spark):
    assert one(spark, T.slug_to_label, ["frutas_y-verduras/", "", "a%20b"]) == ["Frutas Y Verduras", "", "A B"]


def test_title_case(spark):
    assert one(spark, T.title_case, ["l'oréal 3d hello-world", "ÉCOLE"]) == ["L'Oréal 3D Hello-World", "École"]


def test_fold_text(spark):
    assert one(spark, T.fold_text, ["  Promoción ÑAME ª º  "]) == ["promocion name a o"]


def test_fold_is_nfkd_without_marks(spark):
    import unicodedata
    texts = ["cupo\u0301n", "\ufb01n \uff21", "Promocio\u0301n", "\u338f \u00bd \u2122", "\ud55c\uae00 \uac00", "\U0001d4c8\u0327",
             "\u01c4 \u0133 stra\u00dfe \u0130", "plain", "", "\u0344\u0301"]

    def py(t, ascii_only):
        d = unicodedata.normalize("NFKD", t)
        return "".join(c for c in d if (ord(c) < 128 if ascii_only else not unicodedata.combining(c)))

    assert one(spark, T.nfkd_fold, texts) == [py(t, False) for t in texts]
    assert one(spark, lambda c: T.nfkd_fold(c, True), texts) == [py(t, True) for t in texts]
    assert one(spark, T.slugify, ["\ufb01n \uff21"]) == ["fin-a"]


def test_fold_every_code_point(spark):
    import sys
    import unicodedata
    from pyspark.sql import functions as F
    step = 4096
    texts = ["\u0001".join(chr(c) for c in range(lo, min(lo + step, sys.maxunicode + 1)) if not 0xD800 <= c <= 0xDFFF)
             for lo in range(1, 0x30000, step)]

    def py(t):
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    df = spark.createDataFrame([(t,) for t in texts], "x string").select(T.nfkd_fold(F.col("x")).alias("y"))
    # marks next to each other are reordered by NFKD, so the characters stand apart
    assert [r.y for r in df.collect()] == [py(t) for t in texts]


def test_url_unquote(spark):
    assert one(spark, T.url_unquote, ["a+b", "a%20b", "a%zz", "%C3%B1"]) == ["a+b", "a b", "a%zz", "ñ"]


def test_offer_flags(spark):
    assert one(spark, lambda c: T.offer_flag_dia(c), ["PROMOCIÓN hoy", "2ª Unidad", "nada"]) == [True, True, False]
    from pricelake.functions.constants import OFFER_KEYWORDS_ALCAMPO
    assert one(spark, lambda c: T.offer_flag_lower(c, OFFER_KEYWORDS_ALCAMPO),
               ["PROMOCIÓN hoy", "2ª Unidad", "nada"]) == [True, True, False]


@pytest.mark.parametrize("name,brand,expected", [
    ("Refresco Coca Cola zero", "", "Coca Cola"),
    ("Aceite de Oliva Virgen", "", "Oliva Virgen"),
    ("Leche entera", "", ""),
    ("7UP lata", "", "7UP"),
    ("x", " Marca ", "Marca"),
    ("Galletas Tostadas Casa Oro Fina", "", "Casa Oro Fina"),
    ("Zumo 2L Naranja", "", "Naranja"),
])
def test_brand_ladder(spark, name, brand, expected):
    df = spark.createDataFrame([(brand, name)], "b string, n string")
    assert df.select(T.brand_ladder("b", "n")).first()[0] == expected


def test_subcategory_label(spark):
    df = spark.createDataFrame([("Leche", "leche"), ("Leche", "Entera"), ("Leche", ""), ("", "x")], "t string, l string")
    assert [r[0] for r in df.select(T.subcategory_label("t", "l")).collect()] == \
        ["leche", "Leche / Entera", "Leche", "x"]


def test_url_normalize(spark):
    df = spark.createDataFrame([("//a/b",), ("/x",), ("#x",), ("HTTP://a",), (" https://q ",), ("",), (None,),
                                ("mailto:x",)], "x string")
    got = [r[0] for r in df.select(U.url_normalize("x", "https://www.dia.es")).collect()]
    assert got == ["https://a/b", "https://www.dia.es/x", None, None, "https://q", None, None, None]


def test_group_slug_and_level(spark):
    urls = ["https://www.dia.es/compra-online", "https://www.dia.es/frutas/c/L105", "https://www.dia.es/c/L1",
            "https://www.dia.es/x/y", "https://www.dia.es/frutas/manzanas/c/l2001"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(U.group_slug("u", "dia"), U.dia_menu_level("u")).collect()
    assert [r[0] for r in rows] == ["compra-online", "frutas", "L1", "y", "manzanas"]
    assert [r[1] for r in rows] == ["", "category", "", "", "subcategory"]


def test_product_predicates(spark):
    df = spark.createDataFrame([("https://www.compraonline.alcampo.es/products/a/1?x=1",),
                                ("https://other.es/products/a/1",), ("/lacteos/p/55",),
                                ("https://www.dia.es/compra-online/frutas",)], "u string")
    rows = df.select(U.is_product_url("u", "alcampo"), U.is_product_url("u", "dia"),
                     U.is_category_url("u", "dia")).collect()
    assert [tuple(r) for r in rows] == [(True, False, False), (False, False, False), (False, True, False),
                                        (False, False, True)]


def test_url_segments_params(spark):
    df = spark.createDataFrame([("https://a.b/x/y;p=1?q#f",), ("https://a.b/a%20b/c",)], "u string")
    assert [r[0] for r in df.select(U.url_segments("u")).collect()] == [["x", "y"], ["a b", "c"]]


def test_category_id_from_url(spark):
    df = spark.createDataFrame([("https://t/api/categories/12/",), ("https://t/api/categories/12",), ("x",)],
                               "u string")
    assert [r[0] for r in df.select(U.category_id_from_url("u")).collect()] == [12, 12, None]


def test_unescape_is_the_parsers(spark):
    import html
    from pricelake.functions.html import unescape
    texts = ["a&ntilde;o", "&#38;&#x26;&amp;", "c&oacute;digo", "&ampx &copy2 &notit; &notin; &nosuch; & &;", "&#128;&#0;&#xD800;&#99999999999;",
             "plain", "&NotEqualTilde;", "&lt;b&gt", "&#x1F600;"]
    assert one(spark, unescape, texts) == [html.unescape(t) for t in texts]


def test_attribute_values_may_hold_anything(spark):
    from pricelake.operators.links import attr_value
    tags = ['<a title="x href=no" href="/y">', "<a data-href='/no' HREF = '/a&ntilde;o'>", "<a href>", "<a name=x>", "<a href=/q?a=1&amp;b>"]
    assert one(spark, lambda c: attr_value(c, "href"), tags) == ["/y", "/año", None, None, "/q?a=1&b"]
