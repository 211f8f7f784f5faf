"""S9 published as one version, T1 by events, and the folding of T2's change log."""

import datetime as dt
import os

import pytest

from pricelake.plans.daily import write_daily
from pricelake.sources import versions as V
from pricelake.sources.landing import PRODUCT_SCHEMA
from pricelake.streaming import snapshot_upsert as SU
from pricelake.streaming.event_load import skipped_events, start_event_load

D = [dt.date(2025, 1, d) for d in range(1, 5)]


def staged(spark, spec):
    return spark.createDataFrame([(d, p, "", "1", "", False, "c", "s", "u") for d, p in spec], PRODUCT_SCHEMA)


def rows(spark, spec, table="t"):
    return staged(spark, spec).selectExpr(f"'{table}' AS table_name", "*")


def seen(spark, root, **k):
    return sorted((r.table_name, str(r.date), r.product) for r in V.read_table(spark, root, **k).collect())


def test_replace_day_keeps_null_dates_and_appends_other_days(spark, tmpdir_path):
    assert V.read_table(spark, tmpdir_path).count() == 0
    V.publish(spark, tmpdir_path, rows(spark, [(D[0], "a"), (D[1], "b"), (None, "n")]).union(rows(spark, [(D[0], "x")], "u")), [])
    V.replace_day(spark, tmpdir_path, "t", staged(spark, [(D[0], "a2"), (D[1], "b2"), (None, "n2")]), D[0])
    assert seen(spark, tmpdir_path) == [("t", "2025-01-01", "a2"), ("t", "2025-01-02", "b"), ("t", "2025-01-02", "b2"),
                                        ("t", "None", "n"), ("t", "None", "n2"), ("u", "2025-01-01", "x")]
    V.replace_day(spark, tmpdir_path, "t", staged(spark, []), D[1])
    assert seen(spark, tmpdir_path, table="t", days=[D[0], D[1]]) == [("t", "2025-01-01", "a2")]


def test_only_the_asked_folders_are_opened(spark, tmpdir_path):
    V.publish(spark, tmpdir_path, rows(spark, [(d, "a") for d in D]), [])
    files = V.read_table(spark, tmpdir_path, days=[D[2]]).inputFiles()
    assert len(files) == 1 and "_day=2025-01-03" in files[0]


@pytest.mark.parametrize("step", ["_put", "_point"])
def test_a_failure_before_the_pointer_leaves_the_old_day(spark, tmpdir_path, monkeypatch, step):
    V.publish(spark, tmpdir_path, rows(spark, [(D[0], "a"), (D[1], "b")]), [])
    before = seen(spark, tmpdir_path)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(V, step, fail)
        with pytest.raises(OSError):
            V.replace_day(spark, tmpdir_path, "t", staged(spark, [(D[0], "new"), (D[1], "other")]), D[0])
    assert seen(spark, tmpdir_path) == before
    V.replace_day(spark, tmpdir_path, "t", staged(spark, [(D[0], "new")]), D[0])
    assert seen(spark, tmpdir_path) == [("t", "2025-01-01", "new"), ("t", "2025-01-02", "b")]
    assert V.vacuum(spark, tmpdir_path) == 1 and len(seen(spark, tmpdir_path)) == 2


def test_a_half_written_pointer_is_no_version(spark, tmpdir_path):
    V.publish(spark, tmpdir_path, rows(spark, [(D[0], "a")]), [])
    open(os.path.join(tmpdir_path, "_versions", f"{2:012d}"), "w").close()
    assert seen(spark, tmpdir_path) == [("t", "2025-01-01", "a")]


def test_of_two_writers_one_gets_the_version(spark, tmpdir_path, monkeypatch):
    V.publish(spark, tmpdir_path, rows(spark, [(D[0], "a")]), [])
    point = V._point

    def late(spark_, root, number, name):
        monkeypatch.setattr(V, "_point", point)
        V.replace_day(spark, root, "t", staged(spark, [(D[0], "other writer")]), D[0])
        point(spark_, root, number, name)

    monkeypatch.setattr(V, "_point", late)
    with pytest.raises(V.PublishConflict):
        V.replace_day(spark, tmpdir_path, "t", staged(spark, [(D[0], "loser")]), D[0])
    assert seen(spark, tmpdir_path) == [("t", "2025-01-01", "other writer")]


class Store:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0

    def put(self, source, day, spec):
        return write_daily(staged(self.spark, spec), f"{self.root}/objects/raw", source, day, rows_per_file=1)

    def post(self, *events):
        """Events as (source, day, generation) or ready JSON; one delivery."""
        lines = [e if isinstance(e, str) else f'{{"bucket": "raw", "name": "{e[0]}/{e[1]}/{e[0]}_supermercado_{e[1]}.parquet", '
                 f'"generation": "{e[2]}"}}' for e in events]
        self.n += 1
        os.makedirs(f"{self.root}/events", exist_ok=True)
        with open(f"{self.root}/events/{self.n:03d}.json", "w") as f:
            f.write("\n".join(lines) + "\n")

    def load(self, checkpoint="c", **k):
        start_event_load(self.spark, f"{self.root}/events", f"{self.root}/objects", f"{self.root}/tables",
                         f"{self.root}/{checkpoint}", "raw", **k).awaitTermination()
        return [(d, p) for _, d, p in seen(self.spark, f"{self.root}/tables")]

    def skipped(self):
        return sorted(r.reason for r in skipped_events(self.spark, f"{self.root}/tables").collect())


def test_duplicated_and_late_events_replace_a_day_once(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    s.put("dia", D[0], [(D[0], "a"), (D[0], "b"), (D[1], "other day")])
    s.post(("dia", D[0], 5), ("dia", D[0], 5))
    s.post(("dia", D[0], 5))
    assert s.load(max_files_per_trigger=1) == [("2025-01-01", "a"), ("2025-01-01", "b"), ("2025-01-02", "other day")]
    s.post(("dia", D[0], 4))                        # late: generation 5 is loaded
    s.post(("dia", D[0], 5))
    got = s.load()
    assert got == [("2025-01-01", "a"), ("2025-01-01", "b"), ("2025-01-02", "other day")]
    s.put("dia", D[0], [(D[0], "c")])
    s.post(("dia", D[0], 6))
    assert s.load() == [("2025-01-01", "c"), ("2025-01-02", "other day")]


def test_events_apply_in_the_order_of_generations(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    s.put("dia", D[0], [(D[0], "a"), (D[1], "from day 1")])
    s.put("dia", D[1], [(D[1], "b")])
    s.post(("dia", D[0], 20), ("dia", D[1], 9))     # day 2 first, then day 1 brings a row of day 2
    assert s.load() == [("2025-01-01", "a"), ("2025-01-02", "b"), ("2025-01-02", "from day 1")]


def test_events_that_load_nothing_are_reported(spark, tmpdir_path):
    s = Store(spark, tmpdir_path)
    s.put("dia", D[0], [(D[0], "a")])
    s.post('{"bucket": "raw"}', '{"bucket": "else", "name": "dia/2025-01-01/x.parquet"}', "no json",
           '{"data": {"bucket": "raw", "name": "dia/2025-01-01/x.csv"}}', ("lidl", D[0], 1), ("dia", D[3], 1),
           '{"bucket": "raw", "name": "dia/2025-13-45/x.parquet"}', ("dia", D[0], 1))
    assert s.load() == [("2025-01-01", "a")]
    assert s.skipped() == ["bucket_mismatch", "invalid_day", "missing", "missing", "no_object", "not_day_file",
                           "unknown_source"]


def test_a_batch_run_again_publishes_nothing(spark, tmpdir_path):
    import glob
    s = Store(spark, tmpdir_path)
    s.put("dia", D[0], [(D[0], "a"), (D[2], "other")])
    s.post(("dia", D[0], ""))                       # without a generation
    s.load()
    for f in glob.glob(f"{tmpdir_path}/c/commits/*") + glob.glob(f"{tmpdir_path}/c/commits/.*"):
        os.remove(f)
    assert s.load() == [("2025-01-01", "a"), ("2025-01-03", "other")]
    s.post(("dia", D[0], ""))                       # told apart by its batch
    assert s.load() == [("2025-01-01", "a"), ("2025-01-03", "other"), ("2025-01-03", "other")]


def test_state_read_is_the_keys_not_the_batches(spark, tmpdir_path):
    n = 11
    for i in range(n):
        spec = [(1, i, p, D[0], f"P{p}", "", f"{i},0", "", False, "c", "s", f"https://u/{p}", "card") for p in range(5)]
        spark.createDataFrame(spec, SU.SNAPSHOT_SCHEMA).coalesce(1).write.parquet(f"{tmpdir_path}/feed/{i}")
    states = {}
    for every in (1, 4, 1000):
        root = f"{tmpdir_path}/state{every}"
        src = f"{tmpdir_path}/feed/*"
        SU.start_snapshot_upsert(spark, src, root, f"{tmpdir_path}/c{every}", max_files_per_trigger=1,
                                 compact_every=every).awaitTermination()
        states[every] = sorted(map(str, SU.read_state(spark, root).collect()))
        log = SU.state_log(spark, root).count()
        assert log == {1: 5, 4: 5 + 5 * (n % 4), 1000: 5 * n}[every]
        kept = os.listdir(f"{root}/log") if os.path.isdir(f"{root}/log") else []
        assert len([x for x in kept if x.isdigit()]) < max(every, 1) or every == 1000
    assert states[1] == states[4] == states[1000] and len(states[1]) == 5 and "10,0" in states[1][0]


def test_a_batch_run_again_after_its_generation(spark, tmpdir_path):
    spec = [(1, 0, 0, D[0], "P", "", "1,0", "", False, "c", "s", "https://u", "card")]
    spark.createDataFrame(spec, SU.SNAPSHOT_SCHEMA).coalesce(1).write.parquet(f"{tmpdir_path}/feed/0")
    root = f"{tmpdir_path}/state"
    SU.start_snapshot_upsert(spark, f"{tmpdir_path}/feed/*", root, f"{tmpdir_path}/c", compact_every=1).awaitTermination()
    before = SU.read_state(spark, root).collect()
    for f in os.listdir(f"{tmpdir_path}/c/commits"):
        os.remove(f"{tmpdir_path}/c/commits/{f}")
    SU.start_snapshot_upsert(spark, f"{tmpdir_path}/feed/*", root, f"{tmpdir_path}/c", compact_every=1).awaitTermination()
    assert SU.read_state(spark, root).collect() == before


def snapshot(spark, seq, keys):
    spec = [(1, seq, p, D[0], f"P{p}", "", f"{seq},0", "", False, "c", "s", f"https://u/{p * 2654435761 % 2**32:x}", "card") for p in keys]
    return spark.createDataFrame(spec, SU.SNAPSHOT_SCHEMA)


def test_no_batch_loads_the_state(spark, tmpdir_path):
    for i in range(3):
        snapshot(spark, i, range(i, i + 4)).coalesce(1).write.parquet(f"{tmpdir_path}/feed/{i}")
    q = SU.start_snapshot_upsert(spark, f"{tmpdir_path}/feed/*", f"{tmpdir_path}/state", f"{tmpdir_path}/c", max_files_per_trigger=1)
    q.awaitTermination()
    assert not q.lastProgress["stateOperators"] and SU.state_log(spark, f"{tmpdir_path}/state").count() == 12
    got = {r.product: (r.price, r.page_seq) for r in SU.read_state(spark, f"{tmpdir_path}/state").collect()}
    assert got == {f"P{p}": (f"{min(p, 2)},0", max(0, p - 3)) for p in range(6)}


def test_folding_does_not_write_the_whole_state_each_time(spark, tmpdir_path, monkeypatch):
    n, size, folded, compact = 12, 4000, [], SU.compact

    def counted(log):
        folded.append(log.count())
        return compact(log)

    monkeypatch.setattr(SU, "compact", counted)
    for i in range(n):
        SU.keyed_state(snapshot(spark, i, range(i * size, (i + 1) * size))).coalesce(1).write.parquet(f"{tmpdir_path}/log/{i}")
        SU.fold_log(spark, tmpdir_path)
    assert sum(folded) < 60 * size  # was 78: 1 + 2 + ... + 12
    generations, batches = SU.live_folders(spark, tmpdir_path)
    assert batches == [] and len(generations) <= 4 and SU.state_log(spark, tmpdir_path).count() == n * size
    assert SU.read_state(spark, tmpdir_path).count() == n * size


def test_a_folder_that_a_generation_covers_counts_once(spark, tmpdir_path, monkeypatch):
    for i in range(4):
        SU.keyed_state(snapshot(spark, i, range(3 * i, 3 * i + 5))).write.parquet(f"{tmpdir_path}/log/{i}")
        if i == 2:
            SU.fold_log(spark, tmpdir_path)
    before = sorted(map(str, SU.read_state(spark, tmpdir_path).collect()))
    fs = SU._fs

    class Kept:  # the run dies before anything is deleted
        def __init__(self, real):
            self.real = real

        def __getattr__(self, name):
            return (lambda *_: False) if name == "delete" else getattr(self.real, name)

    monkeypatch.setattr(SU, "_fs", lambda s, p: (Kept(fs(s, p)[0]), fs(s, p)[1]))
    SU.fold_log(spark, tmpdir_path)
    assert SU.live_folders(spark, tmpdir_path) == ([2, 3], [])
    assert sorted(map(str, SU.read_state(spark, tmpdir_path).collect())) == before
