"""Batch = stream (K1-K3) on small landed files, and a late file for an old
day (FIXTURES §2, case 30)."""

import os

import pytest

from signalmart import schemas as S
from signalmart.operators.dedupe import latest_per_key
from signalmart.session import session_conf
from signalmart.sources.raw import read_raw, typed_projection
from pyspark.sql.types import StringType, StructField, StructType

from signalmart.streaming import ingest as K
from signalmart.streaming import versioned as V
from tests.conftest import rows


def _land(root, dt, name, lines):
    os.makedirs(f"{root}/dt={dt}", exist_ok=True)
    with open(f"{root}/dt={dt}/{name}.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _line(icao, ts, date, hour, extracted, callsign="CS", extraction=""):
    return f"LAS,{icao},{callsign},KSFO,{ts},{date},{hour},{extracted},{extraction}"


def _fixture(root):
    _land(root, "2026-08-12", "run1", [
        _line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-12 21:00:00", "OLD"),
        _line("b", "2026-08-12 21:00:00", "2026-08-12", 14, "2026-08-12 21:00:00")])
    _land(root, "2026-08-12", "run2", [
        _line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-12 22:00:00", "NEW")])
    _land(root, "2026-08-13", "run2", [
        _line("c", "2026-08-13 10:00:00", "2026-08-13", 3, "2026-08-13 11:00:00")])


def _batch(spark, root):
    raw = read_raw(spark, root, S.RAW_FLIGHTS_SCHEMA)
    return typed_projection(raw, S.FLIGHTS_TYPES, keep=("dt",))


def test_stream_ingest_equals_batch(spark, tmp_dir):
    _fixture(f"{tmp_dir}/raw")
    out = K.ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/t", f"{tmp_dir}/ck", max_files=1)
    cols = S.FLIGHTS_COLUMNS
    assert rows(out, *cols) == rows(_batch(spark, f"{tmp_dir}/raw"), *cols)


def test_stream_upsert_freshest_wins_and_late_file(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    _fixture(root)
    out = K.upsert(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/ck", max_files=1)
    expect = latest_per_key(_batch(spark, root), S.FLIGHTS_KEY, S.FRESHEST)
    cols = ["icao24", "callsign", "dt"]
    assert rows(out, *cols) == rows(expect, *cols)
    assert ("a", "NEW", "2026-08-12") in rows(out, *cols)
    # a late, fresher extraction for an old day rewrites only that day
    _land(root, "2026-08-12", "run3", [
        _line("b", "2026-08-12 21:00:00", "2026-08-12", 14, "2026-08-13 09:00:00", "LATE")])
    out = K.upsert(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/ck", max_files=1)
    assert rows(out, *cols) == [("a", "NEW", "2026-08-12"), ("b", "LATE", "2026-08-12"),
                                ("c", "CS", "2026-08-13")]


def test_stream_tumbling_counts(spark, tmp_dir):
    _fixture(f"{tmp_dir}/raw")
    out = K.tumbling_counts(spark, f"{tmp_dir}/raw", f"{tmp_dir}/c", f"{tmp_dir}/ck", max_files=1)
    got = [(r.window_start.day, r.market, r.rows) for r in out.orderBy("window_start").collect()]
    assert got == [(12, "LAS", 3), (13, "LAS", 1)]


def test_rollup_follows_late_data_for_old_day(spark, tmp_dir):
    from signalmart.operators.rollups import rollup_counts
    root = f"{tmp_dir}/raw"
    _fixture(root)

    def rollup(merged):
        return rollup_counts(merged, ["market", "arrival_date_local", "dt"], "arrivals")

    def run():
        K.upsert(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/ck", max_files=1,
                 rollup=rollup, rollup_table=f"{tmp_dir}/daily")
        kind = StructType.fromDDL("market string, arrival_date_local date, dt string, arrivals long")
        return [(str(d), n) for d, n in rows(V.read(spark, f"{tmp_dir}/daily", ["dt"], kind),
                                              "dt", "arrivals")]

    assert run() == [("2026-08-12", 2), ("2026-08-13", 1)]
    day13 = sorted(os.listdir(f"{tmp_dir}/daily/data/dt=2026-08-13"))
    _land(root, "2026-08-12", "late", [
        _line("d", "2026-08-12 23:00:00", "2026-08-12", 16, "2026-08-14 09:00:00")])
    assert run() == [("2026-08-12", 3), ("2026-08-13", 1)]
    assert sorted(os.listdir(f"{tmp_dir}/daily/data/dt=2026-08-13")) == day13  # untouched day


def test_stream_hourly_windows(spark, tmp_dir):
    _fixture(f"{tmp_dir}/raw")
    out = K.tumbling_counts(spark, f"{tmp_dir}/raw", f"{tmp_dir}/c", f"{tmp_dir}/ck",
                            every="1 hour", max_files=2)
    got = [(r.window_start.day, r.window_start.hour, r.rows)
           for r in out.orderBy("window_start").collect()]
    assert got == [(12, 20, 2), (12, 21, 1), (13, 10, 1)]


def test_stream_watermark_finalises_closed_windows(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    _land(root, "2026-08-12", "f1", [
        _line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "x"),
        _line("b", "2026-08-12 21:00:00", "2026-08-12", 14, "x")])
    _land(root, "2026-08-13", "f2", [
        _line("c", "2026-08-13 10:00:00", "2026-08-13", 3, "x")])
    _land(root, "2026-08-14", "f3", [
        _line("d", "2026-08-14 09:00:00", "2026-08-14", 2, "x")])
    for k, (day, name) in enumerate([(12, "f1"), (13, "f2"), (14, "f3")]):
        os.utime(f"{root}/dt=2026-08-{day}/{name}.csv", (1786000000 + k, 1786000000 + k))
    out = K.tumbling_counts(spark, root, f"{tmp_dir}/c", f"{tmp_dir}/ck", max_files=1,
                            late_tolerance="2 hours")
    got = sorted((r.window_start.day, r.rows) for r in out.collect())
    # days 12 and 13 are closed by the watermark (latest event 14th 09:00 - 2h);
    # day 14 is still open, so it is not emitted yet
    assert got == [(12, 2), (13, 1)]


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp_dir):
    import glob
    root, table = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    _land(root, "2026-08-12", "run1", [
        _line(f"k{i}", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-12 21:00:00")
        for i in range(40)])
    first = K.upsert(spark, root, table, f"{tmp_dir}/ck", max_files=1, buckets=4)
    assert first.count() == 40
    before = {p: sorted(os.listdir(p)) for p in glob.glob(f"{table}/data/dt=2026-08-12/key_bucket=*")}
    assert len(before) == 4
    # a fresher copy of one key arrives late
    _land(root, "2026-08-12", "late", [
        _line("k7", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-13 09:00:00", "LATE")])
    out = K.upsert(spark, root, table, f"{tmp_dir}/ck", max_files=1, buckets=4)
    assert out.count() == 40
    assert rows(out.filter("icao24 = 'k7'"), "callsign") == [("LATE",)]
    after = {p: sorted(os.listdir(p)) for p in glob.glob(f"{table}/data/dt=2026-08-12/key_bucket=*")}
    changed = [p for p in before if before[p] != after[p]]
    assert len(changed) == 1                     # only k7's bucket was rewritten


def test_restart_on_same_checkpoint_changes_nothing(spark, tmp_dir):
    import glob
    root, table = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    _fixture(root)
    first = rows(K.upsert(spark, root, table, f"{tmp_dir}/ck", max_files=1))
    files = sorted(glob.glob(f"{table}/data/dt=*/*/*.parquet"))
    again = rows(K.upsert(spark, root, table, f"{tmp_dir}/ck", max_files=1))
    assert again == first and sorted(glob.glob(f"{table}/data/dt=*/*/*.parquet")) == files


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_crash_between_write_and_commit_loses_nothing(spark, tmp_dir, monkeypatch, step):
    """The second batch dies before or after its rows are written; what was
    committed stays readable, and the replay gives the full result."""
    root, table = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    _land(root, "2026-08-12", "run1", [
        _line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-12 21:00:00"),
        _line("b", "2026-08-12 21:00:00", "2026-08-12", 14, "2026-08-12 21:00:00")])
    K.upsert(spark, root, table, f"{tmp_dir}/ck")
    _land(root, "2026-08-12", "run2", [
        _line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-12 22:00:00", "NEW"),
        _line("c", "2026-08-12 22:00:00", "2026-08-12", 15, "2026-08-12 22:00:00")])

    def die(*args, **kw):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(V, step, die)
        with pytest.raises(Exception):
            K.upsert(spark, root, table, f"{tmp_dir}/ck")
    schema = StructType.fromDDL("icao24 string, callsign string, dt string")
    assert rows(V.read(spark, table, ["dt"], schema), "icao24", "callsign") == [("a", "CS"), ("b", "CS")]
    out = K.upsert(spark, root, table, f"{tmp_dir}/ck")
    assert rows(out, "icao24", "callsign") == [("a", "NEW"), ("b", "CS"), ("c", "CS")]
    assert V.vacuum(spark, table, ["dt"], schema) == 1
    assert rows(V.read(spark, table, ["dt"], schema), "icao24") == [("a",), ("b",), ("c",)]


def test_equal_times_fall_to_the_greatest_extraction_id(spark, tmp_dir):
    root, same = f"{tmp_dir}/raw", "2026-08-12 21:00:00"
    for name, who in (("one", "1"), ("three", "3"), ("two", "2")):
        _land(root, "2026-08-12", name, [
            _line(f"k{i}", "2026-08-12 20:00:00", "2026-08-12", 13, same, f"CS{who}", who) for i in range(5)])
    out = K.upsert(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/ck", max_files=1)
    batch = latest_per_key(_batch(spark, root), S.FLIGHTS_KEY, S.FRESHEST)
    assert rows(out, "icao24", "callsign") == rows(batch, "icao24", "callsign") == [(f"k{i}", "CS3") for i in range(5)]


def test_late_rows_are_counted(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    # a batch's rows are held against the watermark of the batch before
    for k, day in enumerate((14, 15, 12)):
        _land(root, f"2026-08-{day}", "f", [_line("a", f"2026-08-{day} 09:00:00", f"2026-08-{day}", 2, "x")])
        os.utime(f"{root}/dt=2026-08-{day}/f.csv", (1786000000 + k, 1786000000 + k))
    with pytest.warns(UserWarning, match="1 rows came later"):
        K.tumbling_counts(spark, root, f"{tmp_dir}/c", f"{tmp_dir}/ck", max_files=1, late_tolerance="2 hours")
    assert rows(spark.read.parquet(f"{tmp_dir}/c_late"), "rows_dropped") == [(1,)]


def test_a_backlog_beyond_a_batch_of_bytes_loses_no_rows(spark, tmp_dir, monkeypatch):
    root, days = f"{tmp_dir}/raw", (20, 12, 18, 14, 16, 13, 19, 11, 17, 15)
    for k, day in enumerate(days):  # written in an order that is not that of the days
        _land(root, f"2026-08-{day}", "f", [_line(f"a{i}", f"2026-08-{day} {9 + i:02}:00:00", f"2026-08-{day}", 2, "x")
                                            for i in range(day - 10)])
        os.utime(f"{root}/dt=2026-08-{day}/f.csv", (1786000000 + k, 1786000000 + k))
    whole = K.raw_stream
    # an input many times the bytes of a batch: whatever limit is asked for, it is a byte
    monkeypatch.setattr(K, "raw_stream", lambda spark, root, schema, max_files=None, max_bytes=K.BATCH_BYTES:
                        whole(spark, root, schema, max_files, max_bytes and 1))
    closed = (_batch(spark, root).selectExpr("date_trunc('day', arrival_ts_utc) AS d", "arrival_ts_utc AS t", "market")
              .selectExpr("d", "market", "max(t) OVER () AS last").groupBy("d", "market", "last").count()
              .filter("d + INTERVAL 1 DAY <= last - INTERVAL 36 HOURS").selectExpr("day(d)", "market", "count"))
    out = K.tumbling_counts(spark, root, f"{tmp_dir}/c", f"{tmp_dir}/ck", late_tolerance="36 hours")
    assert rows(out.selectExpr("day(window_start)", "market", "rows")) == rows(closed)
    assert rows(spark.read.parquet(f"{tmp_dir}/c_late"), "rows_dropped") == [(0,)]
    every = K.tumbling_counts(spark, root, f"{tmp_dir}/all", f"{tmp_dir}/ck-all")
    assert rows(every.selectExpr("day(window_start)", "rows")) == [(d, d - 10) for d in sorted(days)]


def test_late_rows_of_old_batches_are_counted(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    for k, day in enumerate((14, 15, 12, 16, 17, 18, 19, 20, 21)):
        _land(root, f"2026-08-{day}", "f", [_line("a", f"2026-08-{day} 09:00:00", f"2026-08-{day}", 2, "x")])
        os.utime(f"{root}/dt=2026-08-{day}/f.csv", (1786000000 + k, 1786000000 + k))
    with session_conf(spark, spark__sql__streaming__numRecentProgressUpdates="3"), \
            pytest.warns(UserWarning, match="1 rows came later"):
        K.tumbling_counts(spark, root, f"{tmp_dir}/c", f"{tmp_dir}/ck", max_files=1, late_tolerance="2 hours")


def test_buckets_follow_the_largest_day(spark, tmp_dir):
    _fixture(f"{tmp_dir}/raw")
    assert K.buckets_for(spark, f"{tmp_dir}/raw") == 1
    assert K.buckets_for(spark, f"{tmp_dir}/raw", bucket_bytes=100) == 3


# ---- versions that only grow ------------------------------------------------
_NAMES = StructType([StructField(c, StringType()) for c in ("icao24", "callsign", "dt")])


def _pull(root, name, who, ts="2026-08-12 20:00:00", extracted="2026-08-12 21:00:00", callsign="CS"):
    _land(root, "2026-08-12", name, [_line(w, ts, "2026-08-12", 13, extracted, callsign) for w in who])


def test_a_new_checkpoint_on_an_old_table_keeps_every_row(spark, tmp_dir):
    """The lost checkpoint's stream began at batch 0 too; its batches are not
    mistaken for the new one's, whatever the table's version."""
    root, table = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    for k, who in enumerate("ab"):
        _pull(root, f"run{k}", [who])
        K.upsert(spark, root, table, f"{tmp_dir}/ck", max_files=1)
    _pull(root, "run2", ["c"])
    out = K.upsert(spark, root, table, f"{tmp_dir}/ck-new")           # one batch with all three files
    assert rows(out, "icao24") == [("a",), ("b",), ("c",)]
    # a third stream that sees nothing but one new file
    _pull(f"{tmp_dir}/other", "run3", ["d"])
    out = K.upsert(spark, f"{tmp_dir}/other", table, f"{tmp_dir}/ck-other")
    assert rows(out, "icao24") == [("a",), ("b",), ("c",), ("d",)]
    assert V.last_version(spark, table) == 3


def test_a_new_checkpoint_on_a_table_of_version_0(spark, tmp_dir):
    root, table = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    _pull(root, "run0", ["a"])
    K.upsert(spark, root, table, f"{tmp_dir}/ck")
    assert V.last_version(spark, table) == 0
    _pull(f"{tmp_dir}/next", "run1", ["b"])
    out = K.upsert(spark, f"{tmp_dir}/next", table, f"{tmp_dir}/ck-new")
    assert rows(out, "icao24") == [("a",), ("b",)] and V.last_version(spark, table) == 1


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    """The batch is committed, but the stream dies before it notes that; on
    the restart it hands the same batch in again."""
    import glob
    import shutil
    root, table, ck = f"{tmp_dir}/raw", f"{tmp_dir}/silver", f"{tmp_dir}/ck"
    _pull(root, "run0", ["a"])
    K.upsert(spark, root, table, ck)
    _pull(root, "run1", ["b"])
    K.upsert(spark, root, table, ck)
    shutil.rmtree(f"{ck}/commits")        # what the stream knows of finished batches
    os.makedirs(f"{ck}/commits")
    files = sorted(glob.glob(f"{table}/**/*.parquet", recursive=True))
    out = K.upsert(spark, root, table, ck)
    assert rows(out, "icao24") == [("a",), ("b",)]
    assert sorted(glob.glob(f"{table}/**/*.parquet", recursive=True)) == files


def test_a_kill_between_the_rollup_and_the_table_commit(spark, tmp_dir, monkeypatch):
    from signalmart.operators.rollups import rollup_counts
    root, table, daily = f"{tmp_dir}/raw", f"{tmp_dir}/silver", f"{tmp_dir}/daily"
    kind = StructType.fromDDL("market string, arrival_date_local date, dt string, arrivals long")
    whole, args = V.commit, dict(rollup=lambda m: rollup_counts(m, ["market", "arrival_date_local", "dt"], "arrivals"),
                                 rollup_table=daily)
    _pull(root, "run0", ["a"])
    K.upsert(spark, root, table, f"{tmp_dir}/ck", **args)
    _pull(root, "run1", ["b", "c"])

    def die(spark, at, *rest, **kw):
        if at == table:
            raise RuntimeError("killed")
        whole(spark, at, *rest, **kw)

    with monkeypatch.context() as m:
        m.setattr(V, "commit", die)
        with pytest.raises(Exception):
            K.upsert(spark, root, table, f"{tmp_dir}/ck", **args)
    assert rows(V.read(spark, table, ["dt"], _NAMES), "icao24") == [("a",)]
    K.upsert(spark, root, table, f"{tmp_dir}/ck", **args)
    assert rows(V.read(spark, table, ["dt"], _NAMES), "icao24") == [("a",), ("b",), ("c",)]
    assert rows(V.read(spark, daily, ["dt"], kind), "arrivals") == [(3,)]


def test_compaction_keeps_the_rows_and_the_replays(spark, tmp_dir):
    import glob
    root, table, ck = f"{tmp_dir}/raw", f"{tmp_dir}/silver", f"{tmp_dir}/ck"
    for k, who in enumerate("abc"):
        _pull(root, f"run{k}", [who])
        out = K.upsert(spark, root, table, ck)
    before, stream = rows(out, "icao24"), K.stream_id(spark, ck)
    commits = lambda: len(glob.glob(f"{table}/commits/*.parquet"))
    assert commits() == 3 and V.compact(spark, table, ["dt"], _NAMES) == 3 and commits() == 1
    assert V.applied(spark, table, stream, 2) and not V.applied(spark, table, stream, 3)
    assert V.last_version(spark, table) == 2
    assert rows(V.read(spark, table, ["dt"], _NAMES), "icao24") == before
    assert V.vacuum(spark, table, ["dt"], _NAMES) == 2
    _pull(root, "run3", ["d"])
    assert rows(K.upsert(spark, root, table, ck), "icao24") == [*before, ("d",)]
    assert V.compact(spark, f"{tmp_dir}/nothing", ["dt"], _NAMES) == V.vacuum(spark, f"{tmp_dir}/nothing", ["dt"], _NAMES) == 0


def test_a_replaced_table_keeps_its_rows_until_the_commit(spark, tmp_dir, monkeypatch):
    kind = StructType.fromDDL("x long")
    V.replace(spark.range(3).toDF("x"), f"{tmp_dir}/t")
    with monkeypatch.context() as m:
        m.setattr(V, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            V.replace(spark.range(5).toDF("x"), f"{tmp_dir}/t")
    assert V.read(spark, f"{tmp_dir}/t", [], kind).count() == 3
    V.replace(spark.range(7).toDF("x"), f"{tmp_dir}/t")
    assert V.read(spark, f"{tmp_dir}/t", [], kind).count() == 7


def test_one_key_landed_under_two_days_is_one_row(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    _land(root, "2026-08-12", "a", [_line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-12 21:00:00", "OLD")])
    _land(root, "2026-08-13", "b", [_line("a", "2026-08-12 20:00:00", "2026-08-12", 13, "2026-08-13 21:00:00", "NEW")])
    out = K.upsert(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/ck", max_files=1, day="arrival_date_local")
    assert rows(out, "icao24", "callsign", "dt") == [("a", "NEW", "2026-08-12")]
