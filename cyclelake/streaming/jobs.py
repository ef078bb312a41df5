"""Streaming jobs over readings and events.

Sinks inside ``foreachBatch`` write each micro-batch as its own partition or upsert by key, so a batch that is
repeated after a failure leaves the tables as they were. Reported state lives in tables, not in the driver.
"""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cyclelake.operators import gold as g
from cyclelake.operators import partials as p
from cyclelake.operators import silver as s
from cyclelake.operators import timeseries as ts
from cyclelake.operators.silver import content_order, first_per_key
from cyclelake.operators.state import ARRIVAL, CHANNEL, STATE_COLUMN, retain_last_n, with_status
from cyclelake.schemas import SENSOR_TYPES
from cyclelake.sources.messages import MESSAGE_SCHEMA, accepted, parse_readings, rejected
from cyclelake.session import shared_dir, staged
from cyclelake.sources import versions as v
from cyclelake.sources.tables import (
    append_bronze, read_batches, read_upserted, replace_keys, upsert_latest, write_batch,
)
from cyclelake.streaming.deadlines import REPORT, Deadlines

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# A commit writes what has changed, not the whole state.
STATE_SETTINGS = {STORE: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def rocksdb(spark: SparkSession, count_rows: bool = True):
    """Queries started inside keep their state in RocksDB, off the JVM heap. Without ``count_rows`` a write does not look first whether
    its key is new, which only serves the metric ``numRowsTotal``; it is 0 then."""
    settings = STATE_SETTINGS if count_rows else {**STATE_SETTINGS, ROWS: "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start(writer: DataStreamWriter, checkpoint: str, trigger: str | None = None):
    """Starts on a processing-time trigger (``"30 seconds"``) or, without one, on what is there now."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def append_sink(df: DataFrame, path: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").outputMode("append").option("path", path)


def batch_sink(df: DataFrame, handle) -> DataStreamWriter:
    return df.writeStream.foreachBatch(handle)


def bronze_stream(messages: DataFrame, bronze: str, quarantine: str) -> DataStreamWriter:
    """Raw messages to Bronze rows by ingest date (read them with ``read_bronze``) and, refused ones, to the quarantine table
    (read it with ``read_quarantine``)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_readings(batch).persist()
        append_bronze(accepted(parsed), bronze, batch=(_stream_id(batch), batch_id))
        write_batch(rejected(parsed), quarantine, batch_id)
        parsed.unpersist()

    return batch_sink(messages, handle)


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """Refused messages; empty until the first one."""
    return read_batches(spark, quarantine, f"{MESSAGE_SCHEMA}, reject_reason string, batch_id int")


def silver_readings_stream(bronze: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Good readings with all mandatory columns, the first delivery per reading_id within the watermark."""
    good = bronze.filter(F.col("quality") == "Good")
    for name in s.READING_NOT_NULL:
        good = good.filter(F.col(name).isNotNull())
    return good.withWatermark("timestamp_opc", delay).dropDuplicatesWithinWatermark(["reading_id"])


def channel_window_stats(readings: DataFrame, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Tumbling minimum, maximum, mean and last value per channel, emitted when the window is closed."""
    marked = readings.withWatermark("timestamp_opc", delay)
    stats = marked.groupBy(F.window("timestamp_opc", window), "oven_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("n_readings"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.avg("value").alias("mean"), F.max_by("value", F.struct("timestamp_opc", "reading_id")).alias("last"),
    )
    return stats.select(F.col("window.start").alias("window_start"), "oven_id", "sensor_type", "n_readings", "low",
                        "high", "mean", "last")


def pair_stream(events: DataFrame, bound: str = "24 hours", delay: str = "24 hours") -> DataFrame:
    """Starts and confirmations of an order joined as they arrive: one row for each confirmation within ``bound`` after a
    start. Copies of an event are dropped by event_id; an order that is restarted or confirmed again keeps all its
    pairs, and a stray confirmation before the start takes none away."""
    starts = events.filter(F.col("event_type") == "cycle_started").select(
        "event_id", F.col("order_id").alias("start_order"), F.col("event_time").alias("start_time")
    ).withWatermark("start_time", delay).dropDuplicatesWithinWatermark(["event_id"])
    ends = _ends(events, ["cycle_confirmed"], delay)
    inside = F.expr(
        f"start_order = end_order and end_time > start_time and end_time <= start_time + interval {bound}"
    )
    return starts.join(ends, inside).select(
        F.col("start_order").alias("order_id"), F.col("start_time").alias("cycle_start_time"),
        F.col("end_time").alias("cycle_end_time"), F.col("end_operator").alias("operator_id"),
    )


def _ends(events: DataFrame, event_types, delay: str) -> DataFrame:
    """Every end event once."""
    rows = events.filter(F.col("event_type").isin(*event_types)).select(
        F.col("event_id").alias("end_id"), F.col("order_id").alias("end_order"), F.col("event_time").alias("end_time"),
        F.col("operator_id").alias("end_operator"),
    )
    return rows.withWatermark("end_time", delay).dropDuplicatesWithinWatermark(["end_id"])


def timeout_stream(events: DataFrame, limits: DataFrame, extensions: DataFrame | None = None, delay: str = "1 hour",
                   keep: str = "7 days", groups: int = 8192) -> DataFrame:
    """Starts whose deadline passes without an end between start and deadline, reported when the watermark has passed it.

    ``limits`` (order_id, max_cycle_minutes) sets the first deadline. ``extensions`` is a stream (extension_id, order_id,
    extended_at, minutes): an extension adds to the limit of the order's last start before it. One that comes up to the
    deadline moves it; a later one lets the cycle run again, which is reported once more when the new deadline passes. Ends are
    confirmations and aborts; each counts for every start it follows, however often the order was started. Copies (equal
    ids) count once, late events within ``delay`` count, and an order is forgotten ``keep`` after its last deadline.

    Orders are kept in ``groups`` by a hash of their id, each with one state and one timer. A trigger reads and writes the groups that
    it names or whose time has come; keep ``groups`` when a stream is started again from its checkpoint."""
    kinds = {"cycle_started": "start", "cycle_confirmed": "end", "cycle_aborted": "end"}
    kind = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(k)) for t, k in kinds.items()])
    rows = events.filter(F.col("event_type").isin(*kinds)).join(
        limits.select("order_id", F.col("max_cycle_minutes").cast("int")), "order_id", "left").select(
        "order_id", kind.alias("kind"), F.col("event_id").alias("id"), F.col("event_time").alias("at"), "max_cycle_minutes")
    # Without a limit a start has no deadline.
    rows = rows.filter((F.col("kind") == "end") | F.col("max_cycle_minutes").isNotNull())
    if extensions is not None:
        rows = rows.unionByName(extensions.select(
            "order_id", F.lit("extension").alias("kind"), F.col("extension_id").alias("id"), F.col("extended_at").alias("at"),
            F.col("minutes").cast("int").alias("max_cycle_minutes")))
    known = rows.filter(F.col("order_id").isNotNull() & F.col("at").isNotNull()).withWatermark("at", delay)
    grouped = known.withColumn("ms", F.unix_millis("at")).withColumn("_group", F.pmod(F.xxhash64("order_id"), F.lit(groups)))
    return grouped.groupBy("_group").transformWithState(
        Deadlines(int(_seconds(known.sparkSession, keep) * 1000)), REPORT, "Append", "EventTime")


def _seconds(spark: SparkSession, interval: str) -> float:
    return spark.sql(f"select unix_micros(timestamp '1970-01-01 00:00:00Z' + interval {interval})").first()[0] / 1e6


def ticks(spark: SparkSession, seconds: int = 30) -> DataFrame:
    """A stream that names nothing, so that ``gold_stream`` runs now and then although no row arrives."""
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).option(
        "advanceMillisPerBatch", 1000 * seconds).load()
    return rate.select(F.lit(None).cast("string").alias("order_id"))


def _stream_id(batch: DataFrame) -> str:
    """The id that a stream keeps with its checkpoint: it changes when the checkpoint is lost."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def gold_stream(
    events: DataFrame, readings: DataFrame, dimensions, state: str, gold: str, pending: str, named=(), delay: str = "7 days",
    buckets: int = 64, most_parts: int = 8, keep_minutes: float = 60,
) -> DataStreamWriter:
    """Every trigger: add the partial states of the new events and readings to the table ``state``, and write the Gold rows of the
    orders they name. No earlier event or reading is read: an order's merged state holds all that Gold needs.

    ``events`` and ``readings`` are Bronze streams; readings pass the Silver filter, and copies within ``delay`` of the
    watermark count once (readings later than that are dropped). ``dimensions`` is a function of the changed order ids that
    returns the Silver rows (orders, materials, order_state or None) as they are now. Streams in ``named`` (any with an
    order_id: order versions, movements, ``ticks``) ask for their orders. An order whose cycle is complete but whose order,
    material or final reading is not there waits in the table ``pending``, which holds waiting orders only, and is
    tried again with every trigger.

    All three tables are versioned: readers see the Gold of one trigger or the next, never a mixture. A repeated batch adds
    its states once and writes the same rows again; a stream that has lost its checkpoint reads its sources again and starts from
    empty states."""
    log = s.parse_event_payload(events).select(
        "order_id", "event_type", "event_id", "event_time", "operator_id", "sap_confirmation_number")
    series = silver_readings_stream(readings, delay).select("order_id", "sensor_type", "value", "timestamp_opc", "reading_id")
    rows = log.unionByName(series, allowMissingColumns=True)
    for other in named:
        rows = rows.unionByName(other.select("order_id"), allowMissingColumns=True)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shared_dir(spark)
        # The batch runs once: one small row per order that it names, and one for rows without an order, ticks among them.
        new = p.order_partials(batch).checkpoint()
        if new.isEmpty():    # Spark only wants to move its watermark
            return
        new = new.filter(F.col("order_id").isNotNull())
        facts = new.filter(F.greatest(*[F.col(c).isNotNull() for c in p.STATE if c != "order_id"]))
        manifest = v.append(facts, state, ["order_id"], buckets, (_stream_id(batch), batch_id), own=True)
        named_now = new.select("order_id")
        waiting = read_upserted(spark, pending).select("order_id") if v.snapshot(spark, pending) else named_now.limit(0)
        changed = named_now.unionByName(waiting).distinct().checkpoint()
        touched = {r[0] for r in changed.select(v.bucket_of(["order_id"], manifest["n_buckets"])).distinct().collect()}
        if not touched:    # at most one entry per bucket
            return
        # Pairs and statistics both read the merged states.
        states = staged(p.merge_partials(v.read_snapshot(spark, state, manifest, touched).join(changed, "order_id", "left_semi")), "merged")
        complete = g.complete_pairs(p.pairs_of(states))
        orders, materials, order_state = dimensions(changed)
        result = g.summarise(complete, orders, materials, p.sensor_stats_of(states), order_state).checkpoint()
        upsert_latest(result, gold, ["order_id"], None, buckets)
        done = result.filter(F.col("final_moisture_ppm").isNotNull()).select("order_id")
        # All that waited is among the changed orders: other keys are not in the table.
        replace_keys(waiting, complete.select("order_id").join(done, "order_id", "left_anti"), pending, ["order_id"], buckets)
        v.compact(spark, state, p.merge_partials, most_parts)
        for table in (state, gold, pending):
            v.expire(spark, table, 2, keep_minutes)

    return batch_sink(rows, handle)


def _summary(batch: DataFrame) -> DataFrame:
    """Per oven what a batch of readings says of it; map-side combined, one row per oven."""
    position = F.struct(*ARRIVAL)
    return batch.groupBy("oven_id").agg(
        F.max(position).alias("position"), F.max_by(F.struct("order_id"), position).alias("order"),
        F.max(F.when(F.col("order_id").isNull(), position)).alias("idle"),
        *[F.max(F.when(F.col("sensor_type") == x, F.struct(*ARRIVAL, "value"))).alias(x) for x in SENSOR_TYPES],
    )


def _newest(rows: DataFrame) -> DataFrame:
    """One summary per oven from stored and new ones: maxima, in whatever order they came."""
    return rows.groupBy("oven_id").agg(
        F.max("position").alias("position"), F.max_by("order", F.struct("position", "_new")).alias("order"),
        F.max("idle").alias("idle"), *[F.max(x).alias(x) for x in SENSOR_TYPES])


def process_state_stream(readings: DataFrame, state: str, buckets: int = 16, most_parts: int = 8,
                         keep_minutes: float = 60) -> DataStreamWriter:
    """Current values per oven, as ``process_state`` gives them, whatever the order in which readings arrive; read them with
    ``read_process_state``.

    Versioned tables: ``state`` has one row per oven, in which a batch is merged after it has been reduced to one row per oven,
    however unevenly ovens report; ``state``.running has the positions of readings with an order since each oven's last idle
    one, ``state``.starts the first of these, the start of the running cycle. Positions are only appended, and read again where an
    idle reading has come after the known start. A trigger touches the buckets of the ovens it names. Repeated batches, and all readings again after a lost
    checkpoint, change nothing."""
    running, starts = f"{state.rstrip('/')}.running", f"{state.rstrip('/')}.starts"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shared_dir(spark)
        new = _summary(batch).checkpoint()
        v.merge(new, state, ["oven_id"], _newest, buckets)
        ovens = v.snapshot(spark, state)
        # Positions that come before an idle one can never start the running cycle again.
        idle = read_upserted(spark, state).select("oven_id", "idle")
        live = lambda rows: rows.join(idle, "oven_id").filter(F.col("idle").isNull() | (F.col("at") > F.col("idle"))).drop("idle")
        active = live(batch.filter(F.col("order_id").isNotNull()).select("oven_id", F.struct(*ARRIVAL).alias("at")))
        known = v.snapshot(spark, running)
        v.append(active, running, ["oven_id"], ovens["n_buckets"], (_stream_id(batch), batch_id))
        firsts = active.groupBy("oven_id").agg(F.min("at").alias("at"))
        if v.snapshot(spark, starts):
            before = read_upserted(spark, starts).join(new.select("oven_id"), "oven_id", "left_semi").withColumnRenamed("start", "at")
            # Only where an idle reading has passed the known start, earlier positions are looked at again.
            passed = before.join(idle, "oven_id").filter("at <= idle").select("oven_id").checkpoint()
            touched = {r[0] for r in passed.select(v.bucket_of(["oven_id"], ovens["n_buckets"])).distinct().collect()}
            if touched:
                firsts = firsts.unionByName(v.read_snapshot(spark, running, known, touched).join(passed, "oven_id", "left_semi"))
            firsts = firsts.unionByName(before)
        first = live(firsts).groupBy("oven_id").agg(F.min("at").alias("start"))
        upsert_latest(new.select("oven_id").join(first, "oven_id", "left").checkpoint(), starts, ["oven_id"], None, buckets)
        v.compact(spark, running, lambda rows: live(rows).distinct(), most_parts)
        for table in (state, running, starts):
            v.expire(spark, table, 2, keep_minutes)

    return batch_sink(readings, handle)


def read_process_state(spark: SparkSession, state: str, threshold=500.0, max_minutes=600.0, as_of=None) -> DataFrame:
    starts = read_upserted(spark, f"{state.rstrip('/')}.starts")
    current = read_upserted(spark, state).join(starts, "oven_id", "left").select(
        "oven_id", F.col("order.order_id").alias("order_id"),
        *[F.col(f"{x}.value").alias(STATE_COLUMN[x]) for x in SENSOR_TYPES],
        F.col("position.timestamp_opc").alias("last_seen"),
        F.when(F.col("order.order_id").isNotNull(), F.col("start.timestamp_opc")).alias("cycle_start"),
    )
    return with_status(current, F.lit(threshold), F.lit(max_minutes), as_of)


def alerts_stream(
    readings: DataFrame, state: str, alerts: str, rules, key: str = "order_id", delay_minutes: float = 10, prepare=None,
    buckets: int = 64, keep_minutes: float = 60,
) -> DataStreamWriter:
    """Alerts of readings as they arrive, equal to the rules over all readings at once for any order of arrival within
    ``delay_minutes``. Read them with ``read_alerts``.

    ``rules`` maps a name to a ``timeseries.Rule``: what to find, and which earlier readings later ones are compared with. Only
    these, and readings younger than the newest one minus the delay, are kept in the versioned table ``state``: a window of
    moisture, the last temperature, the lowest pressure, not the cycle. Readings inside the delay are judged again when late
    ones come between them, and their alerts replaced. Readings that come later than the delay are left to ``late_report``.
    ``prepare`` adds columns that rules need, such as the phase (``timeseries.with_phase``)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shared_dir(spark)
        manifest = v.snapshot(spark, state)
        mark = manifest["notes"].get("mark") if manifest else None
        after = lambda at: F.lit(True) if at is None else F.unix_micros("timestamp_opc") > at
        new = first_per_key(batch.filter(after(mark) & F.col(key).isNotNull()), ["reading_id"], ["timestamp_opc", content_order(batch)]).checkpoint()
        newest = new.agg(F.max(F.unix_micros("timestamp_opc"))).first()[0]
        if newest is None:
            return
        rows, touched = new, new.select(key).distinct()
        if manifest:
            numbers = {r[0] for r in touched.select(v.bucket_of([key], manifest["n_buckets"])).distinct().collect()}
            stored = v.read_snapshot(spark, state, manifest, numbers).join(touched, key, "left_semi")
            # A repeated batch finds its own readings there.
            rows = stored.join(new.select("reading_id"), "reading_id", "left_anti").unionByName(new)
        rows = rows.checkpoint()
        # Every rule reads these rows several times.
        ready = staged(prepare(rows), "ready") if prepare else rows
        found = None
        for name, rule in rules.items():
            hits = rule.find(ready).select("reading_id", F.lit(name).alias("rule"))
            found = hits if found is None else found.unionByName(hits)
        judged = rows.filter(after(mark))
        raised = judged.join(found.groupBy("reading_id").agg(F.array_sort(F.collect_set("rule")).alias("rules")), "reading_id")
        replace_keys(judged, raised.select("reading_id", "rules", key, "timestamp_opc", "value"), alerts, ["reading_id"], buckets)
        following = max(newest - int(delay_minutes * 60e6), mark if mark is not None else newest - int(delay_minutes * 60e6))
        old, needed = ready.filter(~after(following)), judged.filter(after(following)).select("reading_id")
        for rule in rules.values():
            needed = needed.unionByName(rule.context(old, following).select("reading_id"))
        kept = rows.join(needed.distinct(), "reading_id", "left_semi")
        # Cycles that the batch names are replaced as a whole.
        both = touched.withColumn("_there", F.lit(False)).unionByName(kept.withColumn("_there", F.lit(True)), allowMissingColumns=True)
        named = touched.select(F.col(key).alias("_named"))
        v.merge(both, state, [key], lambda r: r.filter("_new = 1 and _there").unionByName(
            r.filter("_new = 0").join(named, F.col(key) == F.col("_named"), "left_anti")).drop("_there"),
            buckets, (_stream_id(batch), batch_id), {"mark": following})
        for table in (state, alerts):
            v.expire(spark, table, 2, keep_minutes)

    return batch_sink(readings, handle)


def read_alerts(spark: SparkSession, alerts: str) -> DataFrame:
    """(rule, reading_id, key, timestamp_opc, value): one row per alert."""
    stored = read_upserted(spark, alerts)
    return stored.select(F.explode("rules").alias("rule"), *[c for c in stored.columns if c != "rules"])


def late_report(readings: DataFrame, late: str, delay_minutes: float = 10) -> DataStreamWriter:
    """Readings not younger than the newest event time of all earlier batches minus the delay go to the versioned table ``late``: the rows
    that a stateful query with this watermark drops from the same batches (see ``dropped_rows``). The newest event time is
    published with the rows of its batch, so nothing else is read."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        manifest = v.snapshot(spark, late)
        stream = (_stream_id(batch), batch_id)
        if v.applied(manifest, stream):
            return
        before = manifest["notes"].get("newest") if manifest else None
        mark = F.timestamp_micros(F.lit(before - int(delay_minutes * 60e6))) if before is not None else F.lit(None).cast("timestamp")
        # Spark keeps watermarks in whole milliseconds.
        mark = F.timestamp_millis(F.unix_millis(mark))
        newest = batch.agg(F.max(F.unix_micros("timestamp_opc"))).first()[0]
        known = [m for m in (before, newest) if m is not None]
        v.append(batch.withColumn("watermark", mark).filter(F.col("timestamp_opc") <= F.col("watermark")), late, ["reading_id"], 1,
                 stream, notes={"newest": max(known)} if known else {})
        v.compact(spark, late)

    return batch_sink(readings, handle)


def dropped_rows(query) -> DataFrame:
    """Per batch of a stateful query that has ended or runs: the watermark Spark used and how many rows it dropped as late."""
    rows = [(p["batchId"], (p.get("eventTime") or {}).get("watermark"), sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]))
            for p in map(lambda x: json.loads(x.json) if hasattr(x, "json") else x, query.recentProgress)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "batch_id bigint, watermark string, dropped bigint").withColumn(
        "watermark", F.to_timestamp("watermark"))


def ring_stream(readings: DataFrame, ring: str, n: int = 500, buckets: int = 64, keep_minutes: float = 60) -> DataStreamWriter:
    """The newest ``n`` readings per (oven, sensor) at any time, like ``retain_last_n``: a batch is cut to its own newest n and
    merged with those in the versioned table ``ring``; older readings fall out and are never read again. Copies of a
    reading count once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        once = lambda rows: first_per_key(rows, ["reading_id"], ["timestamp_opc", "timestamp_mqtt"])
        newest = retain_last_n(once(batch), n)
        v.merge(newest, ring, CHANNEL, lambda rows: retain_last_n(once(rows), n), buckets, (_stream_id(batch), batch_id))
        v.expire(batch.sparkSession, ring, 2, keep_minutes)

    return batch_sink(readings, handle)


def eta_stream(readings: DataFrame, spec, sums: str, buckets: int = 64, most_parts: int = 8, keep_minutes: float = 60) -> DataStreamWriter:
    """Keeps the sums behind ``cycle_end_eta`` per cycle in the versioned table ``sums``; read the estimates with ``read_eta``. ``spec``
    is a function that returns (pairs, orders, materials); a cycle's start must be known when its readings come. Readings
    come once (``silver_readings_stream``); a repeated batch adds its sums once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        profile = ts.expected_profile(batch, *spec())
        v.append(ts.eta_sums(profile), sums, ["order_id"], buckets, (_stream_id(batch), batch_id), own=True)
        v.compact(spark, sums, ts.merge_eta_sums, most_parts)
        v.expire(spark, sums, 2, keep_minutes)

    return batch_sink(readings, handle)


def read_eta(spark: SparkSession, sums: str, targets: DataFrame) -> DataFrame:
    return ts.eta_from_sums(ts.merge_eta_sums(read_upserted(spark, sums)), targets)
