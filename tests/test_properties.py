"""Properties: partition-count independence and random inputs vs brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from pricelake.operators import merge as M
from tests.test_merge import ROW, brute_dia_merge, brute_first_wins

SF = "/root/testdata/sf0.001"
ORDER_SENSITIVE = ["dedup_first_wins", "merge_last_wins", "name_anti_merge", "daily_run_dia", "cap_per_target",
                   "limit_total", "first_n_categories", "targets_distinct_sorted", "product_cards_dia",
                   "jsonld_products", "group_payload_targets"]


@pytest.mark.parametrize("name", ORDER_SENSITIVE)
def test_same_rows_with_1_and_8_shuffle_partitions(spark, name):
    fn = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = {}
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got[n] = sorted(map(repr, fn(spark, SF).collect()))
        assert got["1"] == got["8"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


row = st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 30),
                st.sampled_from(["", "Leche", " leche ", "PAN", "pan", "x"]),
                st.sampled_from(["", "", "u1", "u2", " u1", "u3"]), st.sampled_from(["1", "2"]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1], r[2])))
def test_random_first_wins(spark, rows):
    got = sorted(tuple(r) for r in M.dedup_first_wins(spark.createDataFrame(rows, ROW)).collect())
    assert got == brute_first_wins(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1], r[2])))
def test_random_last_wins(spark, rows):
    cols = ["target_index", "page_seq", "pos", "product", "product_url", "price", "merge_rank"]
    got = M.merge_last_wins(spark.createDataFrame(rows, ROW), trim_used_names=True).select(*cols)
    assert sorted(tuple(r) for r in got.collect()) == brute_dia_merge(rows, True)
