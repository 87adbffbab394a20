"""Streams against their batch twins, across several micro-batches."""

import datetime as dt
import time

from pyspark.sql import functions as F

from tidemark.streaming import intraday as D

SCHEMA = "event_id int, asof_ts timestamp_ntz, signal_code string, change_pct double"


def land(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def at(minute):
    return dt.datetime(2024, 1, 2, 9, 0) + dt.timedelta(minutes=minute)


def snapshots(n=200):
    codes = ["1001", "2001", "1028", "USDKRW", "FUT"]
    return [(i, at(i), codes[i % 5], ((i * 37) % 41 - 20) / 1000.0) for i in range(n)]


def test_stream_equals_batch_for_closed_slots(spark, tmp_path):
    rows = snapshots()
    land(spark, tmp_path / "in", [rows[:80], rows[80:150], rows[150:]])
    stream = D.landing_stream(spark, str(tmp_path / "in"), spark.createDataFrame(rows, SCHEMA).schema, files_per_batch=1)
    state = lambda d: D.environment(D.intraday_state(D.intraday_inputs(d, "asof_ts", "signal_code", "change_pct")))
    got = D.run_to_table(state(stream), str(tmp_path / "out"))
    want = state(spark.createDataFrame(rows, SCHEMA)).where(F.col("asof_ts") + F.expr("INTERVAL 25 MINUTES") <= F.lit(at(199)))
    assert got.count() == want.count() > 5
    cols = [c for c in want.columns if c != "w"]
    rounded = lambda d: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.select(*cols).collect()}
    assert rounded(got) == rounded(want)


def test_duplicates_across_batches(spark, tmp_path):
    rows = snapshots(20)
    land(spark, tmp_path / "in", [rows, rows[5:], rows])
    stream = D.landing_stream(spark, str(tmp_path / "in"), spark.createDataFrame(rows, SCHEMA).schema, files_per_batch=1)
    assert D.run_to_table(D.deduplicated(stream, ["event_id"], "asof_ts"), str(tmp_path / "out")).count() == 20


def test_state_survives_batches(spark, tmp_path):
    schema = "code string, t timestamp_ntz, label string, score double"
    rows = [("x", at(0), "up", 1.0), ("x", at(15), "up", 1.1), ("x", at(30), "down", -0.5), ("x", at(45), "down", -0.5)]
    for r in rows:
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = D.landing_stream(spark, str(tmp_path / "in"), spark.createDataFrame(rows, schema).schema, files_per_batch=1)
    out = D.run_to_table(D.state_changes(stream, "code", "t", "label", "score"), str(tmp_path / "out"), empty_batches=False).orderBy("asof_ts").collect()
    assert [(r.prev_label, r.change_direction, r.state_hours, r.material_change) for r in out] == [
        (None, "unchanged", 0.0, 1), ("up", "stronger", 0.25, 0), ("up", "weaker", 0.0, 1), ("down", "unchanged", 0.25, 0)]


def test_state_of_a_silent_key_ends(spark, tmp_path):
    """The bars of a second run find the state of the first only within its time to live."""
    schema = "code string, t timestamp_ntz, label string, score double"

    def seen(idle_ms, folder):
        for k, row in enumerate([("x", at(0), "up", 1.0), ("x", at(15), "down", -1.0)]):
            spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(folder / "in"))
            stream = D.landing_stream(spark, str(folder / "in"), spark.createDataFrame([row], schema).schema)
            out = D.run_to_table(D.state_changes(stream, "code", "t", "label", "score", idle_ms=idle_ms), str(folder / "out"), empty_batches=False)
            time.sleep(3 if k == 0 else 0)
        return out.orderBy("asof_ts").collect()[1].prev_label

    assert seen(3_600_000, tmp_path / "long") == "up"
    assert seen(1_000, tmp_path / "short") is None


def test_current_point_sink(spark, tmp_path):
    from tidemark.plans.panels import current_point

    daily = spark.createDataFrame([("KS", dt.date(2024, 1, 1), 1.0), ("KS", dt.date(2024, 1, 2), 2.0)], "code string, date date, value double")
    daily.write.parquet(str(tmp_path / "daily"))
    handle = D.current_points_sink(str(tmp_path), "code", "value", lambda d, live: current_point(d, live, "code", "date", "value"))
    batch = spark.createDataFrame([("KS", dt.date(2024, 1, 2), at(1), 5.0), ("KS", dt.date(2024, 1, 2), at(2), 6.0)], "code string, session_date date, asof_ts timestamp_ntz, value double")
    for _ in range(2):
        handle(batch, 0)
    rows = {(r.date.day, r.value, r.point_type) for r in spark.read.parquet(str(tmp_path / "current")).collect()}
    assert rows == {(1, 1.0, "daily"), (2, 6.0, "current_intraday_quote")}


def test_staleness(spark):
    d = spark.createDataFrame([(at(0), at(45)), (at(0), at(46)), (None, at(0))], "e timestamp_ntz, a timestamp_ntz")
    assert [r[0] for r in d.select(D.stale(F.col("a"), F.col("e"))).collect()] == [False, True, True]
