"""An expression that a rule names often is computed once a row."""

from pyspark.sql import functions as F

from pricelake.functions import text as T


def test_keywords_are_searched_in_one_folded_text(spark):
    df = spark.createDataFrame([("PROMOCIÓN 3,00 €", True), ("2ª unidad", True), ("Pan €", False), ("", False), (None, None)],
                               "x string, want boolean")
    assert all(r.got == r.want for r in df.select("want", T.contains_any(T.fold_text("x"), ["promocion", "2a unidad"]).alias("got")).collect())
    plan = df.select(T.offer_flag_dia("x").alias("y"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("btrim") + plan.lower().count("trim(both") <= 2  # was one for every keyword and branch


def test_texts_with_a_euro_sign_need_no_lookup_by_character():
    import re
    for ascii_only in (False, True):
        plain, src, dst = T.common_letters(ascii_only)
        assert not re.search(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U%08x" % int(m[1], 16), plain), "Promoción 3,00 € – 2ª")
    assert "€" not in dict(zip(T.common_letters(True)[1], T.common_letters(True)[2])) and "€" in T.common_letters(True)[1]
