"""Micro-batch size does not change the result; replays are no-ops."""

import datetime as dt
import glob
import os
import time

from pricelake.sources.landing import PRODUCT_SCHEMA
from pricelake.streaming.day_load import ignored_files, start_day_load

D = [dt.date(2025, 1, d) for d in range(1, 5)]


def rows(spark, spec):
    return spark.createDataFrame([(d, p, "", "1", "", False, "c", "s", "u") for d, p in spec], PRODUCT_SCHEMA)


def land(spark, root):
    """Four files in order: day 2 (with a row of day 3), day 3, day 2 again
    (replaces the first), day 4 (empty of its own day: one row of day 1)."""
    files = [("dia", D[1], [(D[1], "a"), (D[2], "a3")]), ("dia", D[2], [(D[2], "b")]),
             ("dia", D[1], [(D[1], "c")]), ("dia", D[3], [(D[0], "d1")])]
    jvm = spark._jvm
    for i, (src, day, spec) in enumerate(files):
        path = f"{root}/{src}/{day}/f{i}"
        rows(spark, spec).coalesce(1).write.parquet(path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        for st in fs.listStatus(p):
            fs.setTimes(st.getPath(), 1_700_000_000_000 + 1000 * i, -1)


def run(spark, tmp, per_trigger):
    land_root, tables = f"{tmp}/landing", f"{tmp}/tables"
    rows(spark, [(D[0], "t1"), (D[1], "t2"), (D[3], "t4"), (None, "tn")]).withColumnRenamed("date", "date") \
        .selectExpr("'bronze_dia_products_p' AS table_name", "*").write.partitionBy("table_name", "date").parquet(tables)
    land(spark, land_root)
    q = start_day_load(spark, land_root, tables, f"{tmp}/ckpt", max_files_per_trigger=per_trigger)
    q.awaitTermination()
    return sorted((str(r.date), r.product) for r in spark.read.parquet(tables).collect())


def test_batch_size_independent(spark, tmpdir_path):
    one = run(spark, os.path.join(tmpdir_path, "one"), 1)
    many = run(spark, os.path.join(tmpdir_path, "many"), 10)
    assert one == many
    # sequential replaces: day 2 := [c] (a replaced by the later file), day 3 := [b]
    # (a3 appended by file 1, then day 3 replaced by file 2), day 4 emptied, d1 appended, null kept
    assert one == sorted([("2025-01-01", "t1"), ("2025-01-01", "d1"), ("2025-01-02", "c"), ("2025-01-03", "b"),
                          ("None", "tn")])


def products(spark, tables):
    return sorted((str(r.date), r.product) for r in spark.read.parquet(tables).collect())


def start_table(spark, tables, spec):
    (rows(spark, spec).selectExpr("'bronze_dia_products_p' AS table_name", "*")
     .write.partitionBy("table_name", "date").parquet(tables))


def test_file_without_rows_empties_its_day(spark, tmpdir_path):
    tables = f"{tmpdir_path}/tables"
    start_table(spark, tables, [(D[0], "A"), (D[1], "B")])
    rows(spark, []).coalesce(1).write.parquet(f"{tmpdir_path}/landing/dia/{D[0]}/f")
    start_day_load(spark, f"{tmpdir_path}/landing", tables, f"{tmpdir_path}/c").awaitTermination()
    assert products(spark, tables) == [(str(D[1]), "B")]


def test_second_stream_on_the_same_tables_is_no_replay(spark, tmpdir_path):
    tables = f"{tmpdir_path}/tables"
    start_table(spark, tables, [(D[3], "t")])
    for k, day in enumerate(D[:2]):
        rows(spark, [(day, f"p{k}")]).coalesce(1).write.parquet(f"{tmpdir_path}/landing{k}/dia/{day}/f")
        start_day_load(spark, f"{tmpdir_path}/landing{k}", tables, f"{tmpdir_path}/c{k}").awaitTermination()
    assert products(spark, tables) == [(str(D[0]), "p0"), (str(D[1]), "p1"), (str(D[3]), "t")]


def test_encoded_and_nested_paths_load_and_others_are_reported(spark, tmpdir_path):
    tables, landing = f"{tmpdir_path}/tables", f"{tmpdir_path}/my landing"
    start_table(spark, tables, [(D[3], "t")])
    rows(spark, [(D[0], "a")]).coalesce(1).write.parquet(f"{landing}/dia/{D[0]}/late run/x y")
    rows(spark, [(D[1], "b")]).coalesce(1).write.parquet(f"{landing}/lidl/{D[1]}/f")
    rows(spark, [(D[1], "c")]).coalesce(1).write.parquet(f"{landing}/dia/someday/f")
    rows(spark, [(D[1], "c")]).coalesce(1).write.parquet(f"{landing}/dia/2025-13-45/f")
    start_day_load(spark, landing, tables, f"{tmpdir_path}/c").awaitTermination()
    assert products(spark, tables) == [(str(D[0]), "a"), (str(D[3]), "t")]
    assert sorted(r.reason for r in ignored_files(spark, tables).collect()) == [
        "invalid_day", "not_day_file", "unknown_source"]


def test_replayed_batch_changes_nothing(spark, tmpdir_path):
    tables, ckpt = f"{tmpdir_path}/tables", f"{tmpdir_path}/c"
    start_table(spark, tables, [(D[3], "t")])
    rows(spark, [(D[0], "a"), (D[2], "other")]).coalesce(1).write.parquet(f"{tmpdir_path}/landing/dia/{D[0]}/f")
    start_day_load(spark, f"{tmpdir_path}/landing", tables, ckpt).awaitTermination()
    before = products(spark, tables)
    for f in glob.glob(f"{ckpt}/commits/*") + glob.glob(f"{ckpt}/commits/.*"):
        os.remove(f)  # the batch was applied, but its commit was lost
    start_day_load(spark, f"{tmpdir_path}/landing", tables, ckpt).awaitTermination()
    assert products(spark, tables) == before == [(str(D[0]), "a"), (str(D[2]), "other"), (str(D[3]), "t")]


def run_rows(n, day):
    return [(day, f"p{i:03d}", "b", f"{i},00", "", False, "c", "s", f"https://u/{i}") for i in range(n)]


def test_day_written_in_several_files_loads_whole(spark, tmpdir_path):
    """S7 into T1, however the part files are spread over batches."""
    from pricelake.plans.daily import write_daily
    landing = f"{tmpdir_path}/landing"
    for day in D[:2]:
        df = spark.createDataFrame(run_rows(300, day), PRODUCT_SCHEMA)
        key = write_daily(df, landing, "dia", day, rows_per_file=70)
        assert key == f"{landing}/dia/{day}/dia_supermercado_{day}.parquet"
        assert len(glob.glob(f"{key}/part-*")) >= 4 and spark.read.parquet(key).count() == 300
    for per_trigger in (1, 3, 100):
        tables = f"{tmpdir_path}/tables{per_trigger}"
        start_table(spark, tables, [(D[0], "old"), (D[3], "t")])
        start_day_load(spark, landing, tables, f"{tmpdir_path}/c{per_trigger}", max_files_per_trigger=per_trigger).awaitTermination()
        want = [(str(d), f"p{i:03d}") for d in D[:2] for i in range(300)] + [(str(D[3]), "t")]
        assert products(spark, tables) == sorted(want)


def test_rows_of_other_days_of_a_split_object_are_appended_once(spark, tmpdir_path):
    from pricelake.plans.daily import write_daily
    df = spark.createDataFrame(run_rows(40, D[0]) + run_rows(40, D[1]), PRODUCT_SCHEMA)
    write_daily(df, f"{tmpdir_path}/landing", "dia", D[0], rows_per_file=15)
    tables = f"{tmpdir_path}/tables"
    start_table(spark, tables, [(D[1], "kept")])
    start_day_load(spark, f"{tmpdir_path}/landing", tables, f"{tmpdir_path}/c", max_files_per_trigger=2).awaitTermination()
    got = products(spark, tables)
    assert len(got) == 81 and (str(D[1]), "kept") in got


def test_rewritten_day_replaces_the_object_and_a_failed_run_keeps_it(spark, tmpdir_path):
    import pytest
    from pyspark.sql import functions as F
    from pricelake.plans.daily import write_daily
    landing, tables = f"{tmpdir_path}/landing", f"{tmpdir_path}/tables"
    start_table(spark, tables, [(D[3], "t")])
    df = spark.createDataFrame(run_rows(50, D[0]), PRODUCT_SCHEMA)
    key = write_daily(df, landing, "dia", D[0], rows_per_file=20)
    start_day_load(spark, landing, tables, f"{tmpdir_path}/c").awaitTermination()
    with pytest.raises(Exception):
        write_daily(df.withColumn("price", F.raise_error(F.lit("run failed")).cast("string")), landing, "dia", D[0])
    assert spark.read.parquet(key).count() == 50
    write_daily(df.limit(30), landing, "dia", D[0], rows_per_file=20)
    start_day_load(spark, landing, tables, f"{tmpdir_path}/c").awaitTermination()
    assert len(products(spark, tables)) == 31


def test_batches_grow_with_the_objects_not_with_their_parts(spark, tmpdir_path):
    from pricelake.plans.daily import write_daily
    landing, tables = f"{tmpdir_path}/landing", f"{tmpdir_path}/tables"
    for k, day in enumerate(D[:2]):
        write_daily(spark.createDataFrame(run_rows(40, day), PRODUCT_SCHEMA).coalesce(1), landing, "dia", day, rows_per_file=4)
    q = start_day_load(spark, landing, tables, f"{tmpdir_path}/c", max_files_per_trigger=2)
    q.awaitTermination()
    assert len([x for x in os.listdir(f"{tmpdir_path}/c/commits") if x.isdigit()]) == 1  # was 10: 20 files by 2
    assert len(products(spark, tables)) == 80


def test_parts_of_a_large_object_among_small_ones_load_once(spark, tmpdir_path):
    from pricelake.plans.daily import write_daily
    landing, tables = f"{tmpdir_path}/my landing#1", f"{tmpdir_path}/tables"
    start_table(spark, tables, [(D[2], "kept"), (D[3], "old")])
    write_daily(spark.createDataFrame(run_rows(20, D[0]) + run_rows(4, D[2]), PRODUCT_SCHEMA).coalesce(1), landing, "dia", D[0],
                rows_per_file=2)
    for i in range(3):  # each replaces the one before
        rows(spark, [(D[3], f"x{i}")]).coalesce(1).write.parquet(f"{landing}/dia/{D[3]}/run {i}")
        time.sleep(0.1)
    start_day_load(spark, landing, tables, f"{tmpdir_path}/c", max_files_per_trigger=1).awaitTermination()
    assert len([x for x in os.listdir(f"{tmpdir_path}/c/commits") if x.isdigit()]) == 4  # 15 files, 4 objects: 4 files a batch
    want = [(str(D[0]), f"p{i:03d}") for i in range(20)] + [(str(D[2]), f"p{i:03d}") for i in range(4)]
    assert products(spark, tables) == sorted([*want, (str(D[2]), "kept"), (str(D[3]), "x2")])
