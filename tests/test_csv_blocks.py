"""CSV read block by block gives the rows that one task per file reads."""

import random

import pytest

from pricelake.sources import csv_blocks as B
from pricelake.sources import landing as LD


def whole(spark, path):
    return (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
            .option("inferSchema", False).csv(path))


def fields(seed, n):
    r = random.Random(seed)
    parts = ["a", "b c", '"', '""', "\n", "\n\n", ",", "ñ", "日本", "x" * 90, " ", "\r\n" if seed == 2 else "y"]
    return [(str(i), *("".join(r.choice(parts) for _ in range(r.randrange(0, 9))) or None for _ in range(2))) for i in range(n)]


@pytest.fixture()
def small_blocks(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 3])
def test_one_file_of_many_blocks(spark, tmpdir_path, small_blocks, seed):
    rows = fields(seed, 400)
    LD.write_csv(spark.createDataFrame(rows, "id string, `a b` string, c string").coalesce(1), tmpdir_path)
    lines = spark.read.option("lineSep", "\n").text(tmpdir_path)
    assert lines.rdd.getNumPartitions() > 20
    got, want = LD.read_csv_text(spark, tmpdir_path), whole(spark, tmpdir_path)
    assert got.columns == want.columns == ["id", "a b", "c"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() == 400


def test_several_files_and_a_record_over_many_blocks(spark, tmpdir_path, small_blocks):
    rows = fields(5, 60) + [("long", "line\n" * 3000, 'he said "no"\n')] + fields(6, 60)
    LD.write_csv(spark.createDataFrame(rows, "id string, b string, c string").repartition(3), tmpdir_path)
    got = sorted(map(tuple, LD.read_csv_text(spark, tmpdir_path).collect()), key=repr)
    assert got == sorted(map(tuple, whole(spark, tmpdir_path).collect()), key=repr) and len(got) == 121


def test_no_rows_and_no_header(spark, tmpdir_path):
    with open(f"{tmpdir_path}/a.csv", "w", newline="") as f:
        f.write('id,"b ""c"""\r\n\r\n1,"x\r\ny"\r\n2,\r\n')
    got = B.read_csv_text(spark, f"{tmpdir_path}/a.csv")
    assert got.columns == ["id", 'b "c"'] and sorted(r[0] for r in got.collect()) == ["1", "2"]
    with open(f"{tmpdir_path}/b.csv", "w") as f:
        f.write("id,b\n")
    assert B.read_csv_text(spark, f"{tmpdir_path}/b.csv").count() == 0
    open(f"{tmpdir_path}/c.csv", "w").close()
    with pytest.raises(ValueError):
        B.read_csv_text(spark, f"{tmpdir_path}/c.csv")
