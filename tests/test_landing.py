"""Landing: object events, day replace (logical and on disk), type profile."""

import datetime as dt
import os

from pyspark.sql import functions as F

from pricelake.sources import landing as LD

D1, D2, D3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)


def prod(spark, rows):
    return spark.createDataFrame([(d, p, "", "1,00", "", False, "c", "s", u) for d, p, u in rows], LD.PRODUCT_SCHEMA)


def test_classify_events(spark):
    ev = [('{"bucket": "b", "name": ""}',), ('{"bucket": "x", "name": "dia/2025-01-02/x.parquet"}',),
          ('{"bucket": "b", "name": "dia/dia_categories.json"}',),
          ('{"bucket": "b", "name": "lidl/2025-01-02/x.parquet"}',),
          ('{"data": {"bucket": "b", "name": "DIA/2025-01-02/X.PARQUET"}}',),
          ('{"bucket": "b", "name": "dia/2025-13-45/x.parquet"}',)]
    df = spark.createDataFrame(ev, "body string")
    got = LD.classify_events(df, "b", json_col="body").select("outcome", "status", "source", "day").collect()
    assert [tuple(r) for r in got] == [
        ("missing", 400, None, None), ("bucket_mismatch", 200, "dia", None), ("not_day_file", 200, None, None),
        ("unknown_source", 200, "lidl", None), ("loaded", 200, "dia", D2), ("invalid_day", 500, "dia", None)]


def test_day_replace_logical(spark):
    table = prod(spark, [(D1, "a", "u"), (D2, "b", "u"), (D2, "c", "u"), (None, "n", "u")])
    staged = prod(spark, [(D2, "x", "u"), (D2, "y", "u"), (D3, "z", "u")])
    got = sorted((str(r.date), r.product) for r in LD.day_replace(table, staged, "2025-01-02").collect())
    assert got == sorted([("2025-01-01", "a"), ("None", "n"), ("2025-01-02", "x"), ("2025-01-02", "y"),
                          ("2025-01-03", "z")])
    empty = prod(spark, [])
    got = sorted((str(r.date), r.product) for r in LD.day_replace(table, empty, "2025-01-02").collect())
    assert got == [("2025-01-01", "a"), ("None", "n")]


def test_day_replace_positional(spark):
    table = prod(spark, [(D1, "a", "u")])
    staged = prod(spark, [(D2, "x", "u")]).select("date", "product", "brand", "price", "price_per_unit", "offer",
                                                    "category", "subcategory", F.col("product_url").alias("zzz"))
    assert LD.day_replace(table, staged, "2025-01-02").where("product = 'x'").first().product_url == "u"


def test_replace_day_on_disk(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "bronze")
    prod(spark, [(D1, "a", "u"), (D2, "b", "u"), (D2, "c", "u"), (None, "n", "u")]) \
        .write.partitionBy("date").parquet(path)
    staged = prod(spark, [(D2, "x", "u"), (D2, "y", "u"), (D3, "z", "u")])
    read = lambda: sorted((str(r.date), r.product) for r in spark.read.parquet(path).collect())
    LD.replace_day(spark, path, staged, D2)
    assert read() == sorted([("2025-01-01", "a"), ("None", "n"), ("2025-01-02", "x"), ("2025-01-02", "y"),
                             ("2025-01-03", "z")])
    LD.replace_day(spark, path, staged, D2)  # replay: day 3 row appended again
    assert read().count(("2025-01-03", "z")) == 2 and read().count(("2025-01-02", "x")) == 1
    LD.replace_day(spark, path, prod(spark, []), D2)  # empty file empties the day
    assert ("2025-01-02", "x") not in read() and ("2025-01-01", "a") in read()


def test_type_profile(spark):
    cases = {
        "b": ["true", "false"], "bo": ["true", None], "i": ["1", "2"], "ifl": ["1", None], "f": ["1.25", "2.10"],
        "s": ["1,25", "2,10"], "mix": ["1.25", "1,25"], "none": [None, None], "lead": ["0012", "3"],
        "na": ["NA", "x"],
    }
    cols = list(cases)
    rows = [tuple(cases[c][i] for c in cols) for i in range(2)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = {r.column: r.dtype for r in LD.type_profile(df, cols).collect()}
    assert got == {"b": "bool", "bo": "object", "i": "int64", "ifl": "float64", "f": "float64", "s": "object",
                   "mix": "object", "none": "float64", "lead": "int64", "na": "object"}
