"""Intraday operators for snapshot streams.

Every function takes a streaming or a batch frame and gives the same rows for
both; windows close with the watermark, so state stays bounded by the allowed
delay. Sequential per-series state (D9, D10) runs on closed fifteen-minute bars,
whose number per series is bounded by the clock, never on raw snapshots.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import labels as L
from tidemark.functions.dates import as_instant, as_wall
from tidemark.functions.numeric import clip, ratio, row_mean
from tidemark.session import ensure_checkpoint_dir

INDEX_CODES = ["1001", "2001", "1028"]
DELAY = "10 minutes"
SLOT = "15 minutes"


def landing_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream of landed snapshot files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def run_to_folder(stream: DataFrame, folder: str | None = None, mode: str = "append", empty_batches: bool = True) -> str:
    """Drain everything available into Parquet; returns the folder of the rows.

    Output and progress live under the shared checkpoint folder of the session;
    the file sink commits each batch once. Empty batches let a watermark close
    what it has passed; ``empty_batches=False`` ends with the last input.
    """
    spark = stream.sparkSession
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(empty_batches).lower())
    base = folder or f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    query = (stream.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return f"{base}/rows"


def run_to_table(stream: DataFrame, folder: str | None = None, mode: str = "append", empty_batches: bool = True) -> DataFrame:
    """``run_to_folder`` and read the rows back."""
    return stream.sparkSession.read.schema(stream.schema).parquet(run_to_folder(stream, folder, mode, empty_batches))


def deduplicated(snapshots: DataFrame, keys: Sequence[str], ts: str, delay: str = DELAY) -> DataFrame:
    """D1. First arrival per key inside the delay; state is dropped behind the watermark."""
    if snapshots.isStreaming:
        timed = _with_event_time(snapshots, ts, delay)
        return timed.dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_TIME)
    return snapshots.dropDuplicates(list(keys))


EVENT_TIME = "__event_time"


def _with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as an instant (zone-less input counts as UTC), watermarked on streams."""
    zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    df = df.withColumn(EVENT_TIME, as_instant(ts) if zoneless else F.col(ts))
    return df.withWatermark(EVENT_TIME, delay) if df.isStreaming else df


def _slots(df: DataFrame, ts: str, delay: str, slot: str) -> tuple[DataFrame, Column]:
    """Frame with event time, and its tumbling window; slots are named by UTC wall time."""
    return _with_event_time(df, ts, delay), F.window(EVENT_TIME, slot)


def bars(snapshots: DataFrame, ts: str, code: str, value: str, delay: str = DELAY, slot: str = SLOT) -> DataFrame:
    """Closed bars per code: mean, last value and count."""
    df, window = _slots(snapshots, ts, delay, slot)
    out = df.groupBy(window.alias("w"), code).agg(F.avg(value).alias(value), F.max_by(value, EVENT_TIME).alias(f"last_{value}"), F.count(F.lit(1)).alias("n"))
    return out.select(as_wall("w.start").alias("asof_ts"), code, value, f"last_{value}", "n")


def intraday_inputs(snapshots: DataFrame, ts: str, code: str, change: str, delay: str = DELAY, slot: str = SLOT) -> DataFrame:
    """D2, A4. One row per slot: index change, breadth, range position, currency and futures change, row counts."""
    df, window = _slots(snapshots, ts, delay, slot)
    index = F.col(code).isin(INDEX_CODES)
    v = F.when(index, F.col(change))
    only = lambda c: F.avg(F.when(F.col(code) == c, F.col(change)))
    span = F.max(v) - F.min(v)
    out = df.groupBy(window.alias("w")).agg(
        F.avg(v).alias("index_change"), ratio(F.count_if(v > 0), F.count(v)).alias("positive_ratio"),
        ((F.count_if(v > 0) + 1) / (F.count_if(v < 0) + 1)).alias("adv_dec_ratio"),
        ratio(F.max_by(v, F.when(index, F.col(EVENT_TIME))) - F.min(v), span).alias("range_position"), F.count(v).alias("index_rows"),
        only("USDKRW").alias("fx_change"), only("FUT").alias("futures_change"), only("1028").alias("large_change"))
    return out.select(as_wall("w.start").alias("asof_ts"), *[c for c in out.columns if c != "w"])


def intraday_state(inputs: DataFrame) -> DataFrame:
    """D2, D3. Scores, session status and direction label of each slot; no index rows means previous close."""
    zero, half = F.lit(0.0), F.lit(0.5)
    change = F.coalesce("index_change", zero)
    live = F.col("index_rows") > 0
    breadth_there = F.col("positive_ratio").isNotNull()
    direction = clip(change * 120.0)
    breadth = F.when(breadth_there, clip((F.coalesce("positive_ratio", half) - 0.5) * 6.0 + F.log(F.greatest(F.col("adv_dec_ratio"), F.lit(1e-6))) * 0.8)).otherwise(zero)
    risk = clip((F.coalesce("range_position", half) - 0.5) * 4.0 - F.abs(change) * 35.0 - F.coalesce("fx_change", zero) * 30.0)
    df = inputs.withColumns({"direction_score": F.when(live, direction).otherwise(zero), "breadth_score": F.when(live, breadth).otherwise(zero), "risk_score": F.when(live, risk).otherwise(zero)})
    total = clip(F.col("direction_score") * 0.55 + F.col("breadth_score") * 0.20 + F.col("risk_score") * 0.25)
    status = F.when(~live, "fallback_prev_close").when(~breadth_there, "live_indexes_only").otherwise("live")
    df = df.withColumns({"total_score": total, "session_status": status})
    return df.withColumn("direction_label", F.when(live, L.intraday_direction("total_score")).otherwise("전일 기준 참고"))


def environment(inputs: DataFrame) -> DataFrame:
    """D7. Mean of index, futures, currency and risk scores of each slot."""
    df = inputs.withColumns({"index_score": clip(F.col("index_change") * 20.0), "futures_score": clip(F.col("futures_change") * 18.0), "fx_score": clip(F.col("fx_change") * -80.0)})
    return df.withColumn("environment_score", clip(row_mean("index_score", "futures_score", "fx_score", "risk_score")))


def overlays(inputs: DataFrame, flows: Sequence[str] = ()) -> DataFrame:
    """D6. Futures against the large index, and how many flow columns are buying or selling."""
    gap = F.col("futures_change") - F.col("large_change")
    label = L.ladder(gap, [(">=", 0.002, "futures_above_spot"), ("<=", -0.002, "futures_below_spot")], "in_line", "missing")
    count = lambda test: sum((F.coalesce(test(F.col(c)).cast("int"), F.lit(0)) for c in flows), F.lit(0))
    sell, buy = count(lambda c: c < 0), count(lambda c: c > 0)
    side = F.when(sell >= 2, "net_selling").when(buy >= 2, "net_buying").otherwise("mixed")
    return inputs.withColumns({"relative_gap": gap, "relative_label": label, "selling_count": sell, "buying_count": buy, "flow_side": side})


def with_reference_close(snapshots: DataFrame, closes: DataFrame, key: str, price: str, close: str) -> DataFrame:
    """D3. Stream-static join with the latest stored close; missing prices fall back to it."""
    df = snapshots.join(closes, key, "left")
    tier = F.when(F.col(price).isNotNull(), 0).when(F.col(close).isNotNull(), 1).otherwise(2)
    df = df.withColumns({"price_used": F.coalesce(price, close), "fallback_tier": tier, "is_fallback": (tier > 0).cast("int")})
    return df.withColumn("change_from_close", ratio("price_used", close) - 1.0)


def stale(asof: Column, event: Column, minutes: int = 45) -> Column:
    """D4. True when the event is missing or older than the allowed age."""
    return F.coalesce(F.timestamp_diff("SECOND", event, asof) > minutes * 60, F.lit(True))


def session_close(snapshots: DataFrame, ts: str, code: str, value: str, delay: str = DELAY) -> DataFrame:
    """D5. Last value per session day and code, emitted when the day is behind the watermark."""
    df, window = _slots(snapshots, ts, delay, "1 day")
    out = df.groupBy(window.alias("w"), code).agg(F.max_by(value, EVENT_TIME).alias(value), F.max(EVENT_TIME).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return out.select(as_wall("w.start").cast("date").alias("session_date"), code, value, as_wall("last_ts").alias("last_ts"), "n")


# -- sequential state ----------------------------------------------------------------------

CHANGE_SCHEMA = "key string, asof_ts timestamp_ntz, label string, score double, prev_label string, change_direction string, state_hours double, material_change int"
#: Last label and score of a key, and the start of its state in microseconds.
STATE_SCHEMA = "label string, score double, since long"
#: A key that has sent nothing for so long is forgotten; its next bar begins anew.
IDLE_MS = 30 * 24 * 3600 * 1000
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class ChangeTracker(StatefulProcessor):
    """D9, D10. Compares every bar of a key with the one before; the typed state lives ``idle_ms`` after its last update."""

    def __init__(self, step: float, idle_ms: int):
        self.step, self.idle_ms = step, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE_SCHEMA, ttlDurationMs=self.idle_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        bars = pd.concat(list(rows), ignore_index=True).sort_values("asof_ts")
        label, score, since = self.last.get() if self.last.exists() else (None, None, None)
        since = None if since is None else pd.Timestamp(since, unit="us")
        out = []
        for r in bars.itertuples(index=False):
            changed = label is not None and r.label != label
            side = "unchanged" if score is None or abs(r.score - score) <= 1e-9 else ("stronger" if r.score > score else "weaker")
            material = int(label is None or changed or abs(r.score - score) >= self.step or (r.score > 0) - (r.score < 0) != (score > 0) - (score < 0))
            since = r.asof_ts if label is None or changed else since
            out.append((key[0], r.asof_ts, r.label, r.score, label, side, (r.asof_ts - since).total_seconds() / 3600.0, material))
            label, score = r.label, r.score
        self.last.update((label, float(score), int((since - pd.Timestamp(0)) // pd.Timedelta(microseconds=1))))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in CHANGE_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


def state_changes(closed: DataFrame, key: str, ts: str, label: str, score: str, step: float = 0.35, idle_ms: int = IDLE_MS) -> DataFrame:
    """D9, D10. Previous state, direction, hours in state and material change of every closed bar.

    The state of a key is its last label, score and start of the current state; it ends ``idle_ms`` after the key's last
    bar has been seen. Keyed state with a time to live needs the RocksDB store, which is set for the session. Drain it
    with ``empty_batches=False``: the clock alone would call for one more batch for ever.
    """
    closed.sparkSession.conf.set(*STORE)
    rows = closed.select(F.col(key).cast("string").alias("key"), F.col(ts).alias("asof_ts"), F.col(label).alias("label"), F.col(score).alias("score"))
    return rows.groupBy("key").transformWithStateInPandas(ChangeTracker(step, idle_ms), CHANGE_SCHEMA, "append", "processingTime")


def current_points_sink(daily_path: str, key: str, value: str, apply) -> Mapping:
    """D8. ``foreachBatch`` handler that lays the newest live value of a batch over the daily points.

    ``apply(daily, live)`` is ``plans.panels.current_point``; the result of each batch is
    written under its own batch id, so a replayed batch rewrites the same folder.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        live = batch.groupBy(key, F.col("session_date").alias("date")).agg(F.max_by(value, "asof_ts").alias(value))
        daily = batch.sparkSession.read.parquet(f"{daily_path}/daily")
        apply(daily, live).write.mode("overwrite").parquet(f"{daily_path}/current/batch={batch_id}")

    return handle
