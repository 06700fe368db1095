"""Registered queries, each over whole tables."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions import messages, scoring
from gaugeflow.functions.times import minute_key, minute_text, parse_time, second_text
from gaugeflow.operators import extracts, forecast, joined_windows, parsing, quantiles, reports, series
from gaugeflow.operators.joins import paired_readings
from gaugeflow.operators.windows import bounds_as_text, gaps, tumbling_agg, window_documents
from gaugeflow.plans import batch
from gaugeflow.plans.inputs import (
    DAY,
    broken_messages,
    events,
    hour_key,
    metric_messages,
    table,
    type_hours,
    user_days,
    with_nulls,
)
from gaugeflow.schemas import EVENTS, READING, TOPIC_RECORD, WINDOW_DOCUMENT
from gaugeflow.session import scratch_path
from gaugeflow.sinks import writers
from gaugeflow.sinks.keyed_store import KeyedStore
from gaugeflow.sources import csv_files, tables, topics
from gaugeflow.streaming import absence, jobs, live_scores, one_pass, repair, traffic, wallclock

# The events carry values far above the default threshold of the score.
SCORE_THRESHOLD = 50.0
MICRO_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
QUERIES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *columns) -> DataFrame:
    """Means differ in their last bits with the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def rounded_means(df: DataFrame, *columns, rows="record_count") -> DataFrame:
    """Means of two-decimal values: the sum is rounded first, so that a mean which
    falls half-way between two results is the same double in any order of addition."""
    total = {c: F.round(F.round(F.col(c) * F.col(rows), 6) / F.col(rows), 6) for c in columns}
    return df.withColumns(total)


def millis(column):
    return F.unix_millis(column)


def hour_streams(spark, sf_dir):
    return jobs.event_pairs(events(spark, sf_dir), key=hour_key)


# ------------------------------------------------------- parsing and projection


@query
def metric_split(spark, sf_dir):
    wide = events(spark, sf_dir).select(
        minute_text("ts").alias("obs_key"),
        F.col("ts").alias("arrival_ts"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("temperature"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("precipitation"),
    )
    parts = [
        parsing.split_metric(wide, name).withColumn("metric", F.lit(name))
        for name in ("temperature", "precipitation")
    ]
    both = parts[0].unionByName(parts[1])
    return both.select("metric", "obs_key", millis("arrival_ts").alias("arrival_ms"), "value")


@query
def unpivot_metrics(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    ids = ["l_orderkey", "l_linenumber"]
    return parsing.unpivot_metrics(items, ids, ["l_quantity", "l_extendedprice"])


@query
def json_extract_props(spark, sf_dir):
    found = messages.nested_number("props", "$.k").alias("k")
    return events(spark, sf_dir).select("event_id", found)


@query
def json_encode(spark, sf_dir):
    encoded = events(spark, sf_dir).select(
        messages.encode("event_id", "event_type", "value").alias("body")
    )
    return encoded.select(
        F.get_json_object("body", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("body", "$.event_type").alias("event_type"),
        messages.nested_number("body", "$.value").alias("value"),
    )


@query
def nested_response_readings(spark, sf_dir):
    current = F.struct(
        minute_text("ts").alias("time"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("temperature_2m"),
        F.col("event_id").cast("double").alias("precipitation"),
    )
    bodies = events(spark, sf_dir).select(F.to_json(F.struct(current.alias("current"))).alias("body"))
    return parsing.readings_from_response(bodies)


@query
def topic_messages(spark, sf_dir):
    wide = events(spark, sf_dir).select(
        minute_text("ts").alias("obs_key"),
        F.col("value").alias("temperature"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("precipitation"),
    )
    return parsing.single_metric_messages(wide)


def _readings(spark, sf_dir, mode):
    readings, _ = parsing.parse_messages(broken_messages(spark, sf_dir), mode=mode)
    return readings.select(
        "event_id", "obs_key", millis("obs_ts").alias("obs_ms"), "temperature", "precipitation"
    )


@query
def parse_messages_strict(spark, sf_dir):
    return _readings(spark, sf_dir, "strict")


@query
def parse_messages_lenient(spark, sf_dir):
    return _readings(spark, sf_dir, "lenient")


@query
def dead_letter_counts(spark, sf_dir):
    _, dead = parsing.parse_messages(broken_messages(spark, sf_dir))
    return parsing.dead_letter_counts(dead)


@query
def timestamp_multi_format(spark, sf_dir):
    text = F.when(F.col("event_id") % 2 == 0, minute_text("ts")).otherwise(second_text("ts"))
    return events(spark, sf_dir).select(
        "event_id",
        minute_key(text).alias("obs_key"),
        millis(parse_time(text)).alias("obs_ms"),
    )


# --------------------------------------------------------------- interval joins


def _pairs_in_millis(pairs):
    return pairs.withColumns({"t1": millis("t1"), "t2": millis("t2")}).drop("obs_ts")


@query
def interval_join_pairs(spark, sf_dir):
    left, right = hour_streams(spark, sf_dir)
    return _pairs_in_millis(paired_readings(left, right, -300, 300))


@query
def interval_join_narrow(spark, sf_dir):
    left, right = jobs.event_pairs(events(spark, sf_dir))
    return _pairs_in_millis(paired_readings(left, right))


@query
def interval_join_by_entity(spark, sf_dir):
    typed = events(spark, sf_dir).select(
        "user_id", "event_type", F.col("ts").alias("arrival_ts"), "value"
    )
    left = typed.where("event_type = 'click'")
    right = typed.where("event_type = 'view'")
    six_hours = 6 * 3600
    return _pairs_in_millis(
        paired_readings(left, right, -six_hours, six_hours, keys=("user_id",))
    )


# ---------------------------------------------------------------------- windows


def _as_report(windows):
    report = bounds_as_text(windows)
    return rounded_means(report, *[c for c in ("avg_v1", "avg_v2") if c in report.columns])


def flagship(spark, sf_dir):
    """Two metric streams, joined and averaged per two-minute window."""
    left, right = hour_streams(spark, sf_dir)
    return _as_report(joined_windows.joined_window_agg(left, right, -300, 300))


@query
def tumbling_window_agg(spark, sf_dir):
    return flagship(spark, sf_dir)


@query
def tumbling_window_of_pairs(spark, sf_dir):
    left, right = hour_streams(spark, sf_dir)
    return _as_report(joined_windows.joined_window_agg(left, right, -300, 300, method="pairs"))


@query
def tumbling_window_by_sums(spark, sf_dir):
    left, right = hour_streams(spark, sf_dir)
    return _as_report(joined_windows.joined_window_agg(left, right, -300, 300, method="sums"))


@query
def tumbling_window_by_key(spark, sf_dir):
    keyed = events(spark, sf_dir).withColumn("obs_key", minute_text("ts"))
    windows = tumbling_agg(
        keyed, "ts", {"avg_v1": "value"}, keys=("event_type",), latest="obs_key"
    )
    return _as_report(windows)


@query
def window_mean_timestamp(spark, sf_dir):
    windows = tumbling_agg(events(spark, sf_dir), "ts", {"avg_v1": "value"}, mean_of="ts")
    return _as_report(windows.withColumn("mean_obs", millis("mean_obs")))


@query
def window_quantiles(spark, sf_dir):
    """Median and 95th percentile per day and type, and of all rows as one group."""
    shares = {"median": 0.5, "p95": 0.95}
    use = events(spark, sf_dir)
    daily = quantiles.window_quantiles(use, "ts", "value", shares, "1 day", ["event_type"])
    shown = daily.select("event_type", F.date_format("window_start_ts", "yyyy-MM-dd").alias("day"), "n", *shares)
    whole = quantiles.quantiles(use.withColumn("event_type", F.lit("all")), ["event_type"], "value", shares)
    return rounded(shown.unionByName(whole.withColumn("day", F.lit("all"))), *shares)


@query
def gap_detection(spark, sf_dir):
    found = gaps(events(spark, sf_dir), "ts", 12 * 3600, keys=("user_id",))
    return _gap_report(found)


@query
def gap_detection_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "ordered_at", F.col("o_orderdate").cast("timestamp")
    )
    return _gap_report(gaps(orders, "ordered_at", DAY, keys=("o_orderpriority",)))


def _gap_report(found):
    shown = {c: F.date_format(c, MICRO_FORMAT) for c in ("gap_after", "resumed_at")}
    return found.withColumns(shown)


# -------------------------------------------------------------------- streaming


def _events_stream(session, sf_dir):
    # As a pattern, because a stream does not take the plain path of a single
    # file; it fits a folder of that name as well.
    return topics.read_record_files(session, f"{sf_dir}/events.parque[t]", EVENTS)


def _typed_events_stream(session, sf_dir, beat):
    """The events files and a heartbeat folder as one stream."""
    data = _events_stream(session, sf_dir)
    beats = topics.read_record_files(session, beat, EVENTS)
    return data.unionByName(beats).withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_window_agg(spark, sf_dir):
    session = jobs.state_session(spark)
    work = scratch_path(spark, "stream-windows")
    beat, store = f"{work}/heartbeat", f"{work}/store"
    # The folder has to exist before the stream starts.
    session.createDataFrame([], EVENTS).write.parquet(beat)
    left, right = jobs.event_pairs(_typed_events_stream(session, sf_dir, beat), key=hour_key)
    windows = joined_windows.joined_window_agg(left, right, -300, 300, max_delay="10 minutes")

    def beat_once():
        for kind in ("click", "view"):
            jobs.heartbeat(session, beat, EVENTS, ts="2999-01-01 00:00:00", event_type=kind)

    sink = writers.window_store(store)
    jobs.replay(windows, [sink], f"{work}/checkpoint", beat_once)
    return _as_report(writers.stored_documents(spark, store))


def _in_time_order(records, steps=3):
    """The records in parts, oldest first."""
    low, high = records.agg(F.min("timestamp"), F.max("timestamp")).first()
    for step in range(steps):
        part = records
        if step:
            part = part.where(F.col("timestamp") >= low + (high - low) * step / steps)
        if step < steps - 1:
            part = part.where(F.col("timestamp") < low + (high - low) * (step + 1) / steps)
        yield part


def _shuffled(records, steps=3):
    """The records in parts without any order in time."""
    for step in range(steps):
        yield records.where(F.pmod(F.xxhash64("offset"), F.lit(steps)) == step)


@query
def stream_message_windows(spark, sf_dir):
    work = scratch_path(spark, "stream-messages")
    landed, beat, store = f"{work}/landed", f"{work}/heartbeat", f"{work}/store"
    session = jobs.state_session(spark)
    for folder in (beat, landed):
        session.createDataFrame([], TOPIC_RECORD).write.parquet(folder)
    streams = [topics.read_record_files(session, path) for path in (landed, beat)]
    windows = jobs.message_windows(streams[0].unionByName(streams[1]))
    sink = writers.window_store(store, "window_date")
    # Each part lands in as many files as it has tasks, and is read before the next one lands.
    for part in _in_time_order(metric_messages(spark, sf_dir)):
        part.write.mode("append").parquet(landed)
        jobs.replay(windows, [sink], f"{work}/checkpoint")

    def beat_once():
        body = '{"time":"2999-01-01T00:00","temperature_2m":0,"precipitation":0}'
        jobs.heartbeat(session, beat, TOPIC_RECORD, value=body, timestamp="2999-01-01 00:00:00")

    jobs.replay(windows, [sink], f"{work}/checkpoint", beat_once)
    return _documents_report(writers.stored_documents(spark, store, WINDOW_DOCUMENT))


def _documents_report(documents):
    shown = documents.drop("processed_at", "window_start_ts", "window_date")
    return rounded_means(shown, "avg_temperature", "avg_precipitation")


@query
def stream_one_pass_pairs(spark, sf_dir):
    """Both metrics in one stream, joined by one stateful operator."""
    session = jobs.state_session(spark)
    work = scratch_path(spark, "one-pass")
    stream = _events_stream(session, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))

    def metric(kind):
        return F.when(F.col("event_type") == kind, F.col("value"))

    readings = stream.select(
        hour_key("ts").alias("obs_key"), F.col("ts").alias("arrival_ts"), metric("click").alias("x"), metric("view").alias("y")
    )
    marked = one_pass.one_pass(readings, "x", "y", lower=-300, upper=300, folded=True)
    sink = writers.window_store(f"{work}/pairs", options=one_pass.BLOCK_STORE)
    jobs.start(marked, [sink], f"{work}/checkpoint", {"availableNow": True}).awaitTermination()
    return _pairs_in_millis(one_pass.pairs_of(writers.read_store(spark, f"{work}/pairs")))


@query
def stream_late_repair(spark, sf_dir):
    """Messages far out of order: what comes behind the watermark is kept, and its windows repaired."""
    session = jobs.state_session(spark)
    work = scratch_path(spark, "late-repair")
    topic, landed, beat = f"{work}/topic", f"{work}/landed", f"{work}/heartbeat"
    session.createDataFrame([], TOPIC_RECORD).write.parquet(topic)
    readings, _ = parsing.parse_messages(topics.read_record_files(session, topic))
    readings = readings.select(*READING.names)
    landing = traffic.Landing(landed, rows_per_part=1_000)
    for part in _shuffled(metric_messages(spark, sf_dir)):
        part.write.mode("append").parquet(topic)
        jobs.start(readings, [landing], f"{work}/topic-checkpoint", {"availableNow": True}).awaitTermination()
    stream = traffic.landed_readings(session, landed, READING)
    session.createDataFrame([], stream.schema).write.parquet(beat)
    beats = topics.read_record_files(session, beat, stream.schema)
    marked = one_pass.one_pass(stream.unionByName(beats), "temperature", "precipitation", size_seconds=120)
    store = KeyedStore(spark, f"{work}/store", ["window_start"], WINDOW_DOCUMENT)
    sink = repair.windows_and_late(store.sink(), f"{work}/late")
    jobs.replay(
        marked, [sink], f"{work}/checkpoint",
        lambda: jobs.heartbeat(
            session, beat, stream.schema, obs_key="end", arrival_ts="2999-01-01 00:00:00", temperature=0, precipitation=0
        ),
    )
    late = writers.read_store(spark, f"{work}/late", f"{repair.LATE_ROW}, run STRING, batch_id LONG")
    history = traffic.landed_readings(spark, landed, READING, streaming=False)
    repair.repair(store, late, history, "repair")
    return _documents_report(store.read())


@query
def keyed_store_upserts(spark, sf_dir):
    """Windows written by two runs, one of them twice, with a compaction in between."""
    def windows(rows):
        keyed = rows.withColumn("obs_key", minute_text("ts"))
        return window_documents(tumbling_agg(keyed, "ts", {"avg_v1": "value"}, keys=("event_type",), latest="obs_key"))

    use = events(spark, sf_dir)
    early, whole = windows(use.where(F.col("event_id") % 3 != 0)), windows(use)
    store = KeyedStore(spark, scratch_path(spark, "keyed-store"), ["event_type", "window_start"], whole.schema)
    store.upsert(early, 0, "first")
    store.upsert(whole.where("event_type <> 'click'"), 0, "second")
    store.compact()
    # A batch that is run again does not get ahead of what came after it.
    store.upsert(early, 0, "first")
    store.upsert(whole.where("event_type = 'click'"), 1, "second")
    shown = store.read().drop("processed_at", "window_start_ts", "window_date")
    return rounded_means(shown, "avg_v1")


@query
def wallclock_window_agg(spark, sf_dir):
    """The windows depend on the clock; their totals per key do not."""
    session = jobs.state_session(spark)
    work = scratch_path(spark, "wallclock")
    stream = _events_stream(session, sf_dir)
    windows = wallclock.running_windows(stream, {"avg_value": "value"}, keys=("event_type",))
    sink = writers.window_store(f"{work}/store")
    jobs.start(
        windows, [sink], f"{work}/checkpoint", {"availableNow": True}, "update"
    ).awaitTermination()
    stored = writers.read_store(spark, f"{work}/store")
    final = writers.latest_documents(stored, ["event_type", "window_start_ts"])
    rows = F.sum("record_count")
    totals = final.groupBy("event_type").agg(
        rows.alias("record_count"),
        (F.sum(F.col("avg_value") * F.col("record_count")) / rows).alias("avg_value"),
    )
    return rounded_means(totals, "avg_value")


@query
def wallclock_closed_windows(spark, sf_dir):
    """Windows that the clock closes, each stored once; their totals per key do not depend on it."""
    session = jobs.state_session(spark)
    work = scratch_path(spark, "closed")
    closed = wallclock.closed_windows(_events_stream(session, sf_dir), "event_type", "value", "ts", size_seconds=1, salts=2)

    query = jobs.start(
        closed, [writers.window_store(f"{work}/store")], f"{work}/checkpoint", {"processingTime": "1 second"}, "update"
    )
    wallclock.until_closed(query)
    parts = writers.read_store(spark, f"{work}/store", f"{wallclock.CLOSED_SCHEMA}, run STRING, batch_id LONG")
    windows = wallclock.merge_closed(parts)
    rows = F.sum("record_count")
    totals = windows.groupBy(F.col("series_key").alias("event_type")).agg(
        rows.alias("record_count"), (F.sum(F.col("avg_metric") * F.col("record_count")) / rows).alias("avg_value")
    )
    return rounded_means(totals, "avg_value")


@query
def stream_live_gaps(spark, sf_dir):
    """Gaps per user, found as the events arrive."""
    session = jobs.state_session(spark)
    work = scratch_path(spark, "live-gaps")
    stream = _events_stream(session, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    found = absence.live_gaps(stream, "ts", 12 * 3600, ["user_id"])
    sink = writers.window_store(f"{work}/store")
    wallclock.until_idle(jobs.start(found, [sink], f"{work}/checkpoint", {"processingTime": "1 second"}, "update"))
    stored = writers.read_store(spark, f"{work}/store", f"{found.schema.toDDL()}, run STRING, batch_id LONG")
    return _gap_report(stored.where(F.col("kind") == absence.CLOSED).drop("kind", "run", "batch_id"))


@query
def stream_live_scores(spark, sf_dir):
    """Score per event type from its newest thirty values, after the last micro-batch."""
    session = jobs.state_session(spark)
    work = scratch_path(spark, "live-scores")
    stream = _events_stream(session, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    scores = live_scores.live_scores(stream, ["event_type"], "ts", "value", "event_id", threshold=SCORE_THRESHOLD)
    sink = writers.window_store(f"{work}/store")
    jobs.start(scores, [sink], f"{work}/checkpoint", {"availableNow": True}, "update").awaitTermination()
    stored = writers.read_store(spark, f"{work}/store", f"{scores.schema.toDDL()}, run STRING, batch_id LONG")
    newest = writers.latest_documents(stored, ["event_type"]).drop("newest_at")
    return rounded(newest, "mean", "peak", "trend", "score")


# ---------------------------------------------------------- queries over tables


@query
def group_mean_by_dim(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("string"))
    means = extracts.group_means(orders, ["o_orderpriority"], {"avg_price": "price"})
    return rounded_means(means, "avg_price")


@query
def group_mean_by_segment(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    metrics = {"avg_balance": "c_acctbal", "avg_nation": "c_nationkey"}
    return rounded_means(extracts.group_means(customers, ["c_mktsegment"], metrics), *metrics)


@query
def topk_latest(spark, sf_dir):
    newest = extracts.latest(table(spark, sf_dir, "orders"), "o_orderdate", 10, ["o_orderkey"])
    ordered = F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered")
    return newest.select("o_orderkey", ordered, "o_totalprice")


RANGE = ("2024-01-05 06:15:00", "2024-01-12 18:30:00")


def _range_columns(df):
    return df.select("event_id", minute_text("ts").alias("avg_timestamp"), "value")


@query
def range_extract(spark, sf_dir):
    use = table(spark, sf_dir, "events")
    return _range_columns(extracts.typed_range(use, "ts", *RANGE))


@query
def range_extract_text(spark, sf_dir):
    return extracts.text_range(_range_columns(events(spark, sf_dir)), "avg_timestamp", *RANGE)


def _all_columns(df):
    return df.withColumn("ts", F.date_format("ts", MICRO_FORMAT))


@query
def full_extract(spark, sf_dir):
    return _all_columns(events(spark, sf_dir))


@query
def csv_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    writers.export_csv(_all_columns(events(spark, sf_dir)), folder)
    schema = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    return csv_files.read_csv(spark, folder, schema)


@query
def window_store_extract(spark, sf_dir):
    """Windows stored as documents, then read back by date and time."""
    keyed = events(spark, sf_dir).withColumn("obs_key", minute_text("ts"))
    windows = tumbling_agg(keyed, "ts", {"avg_v1": "value"}, keys=("event_type",), latest="obs_key")
    documents = window_documents(windows)
    folder = scratch_path(spark, "window-store")
    writers.store_batch(folder, documents, 0, "window_date")
    stored = writers.read_store(spark, folder)
    days = F.col("window_date").between(
        F.lit(RANGE[0]).cast("date"), F.lit(RANGE[1]).cast("date")
    )
    chosen = extracts.typed_range(stored.where(days), "window_start_ts", *RANGE)
    shown = chosen.drop("run", "batch_id", "processed_at", "window_start_ts", "window_date")
    return rounded_means(shown, "avg_v1")


@query
def continuity_summary(spark, sf_dir):
    timed = events(spark, sf_dir).withColumn("avg_timestamp", minute_text("ts"))
    return extracts.continuity(timed, "avg_timestamp")


@query
def catalog_describe(spark, sf_dir):
    """DESCRIBE of registered tables, with the filled cells of every column."""
    parts = []
    for name in ("events", "orders", "lineitem", "customer"):
        view = f"gauge_{name}"
        table(spark, sf_dir, name).createOrReplaceTempView(view)
        described = tables.describe_table(spark, view)
        columns = [row["col_name"] for row in described.collect()]
        counted = spark.table(view).agg(*[F.count(c).alias(c) for c in columns])
        filled = counted.unpivot([], columns, "col_name", "filled")
        parts.append(
            described.join(filled, "col_name").select(
                F.lit(name).alias("table_name"), "col_name", "data_type", "filled"
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# ----------------------------------------------------------------------- series


def user_events(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", F.col("user_id").cast("string").alias("series_key"), F.col("ts").alias("ds"), "value"
    )


@query
def series_clean(spark, sf_dir):
    kind = F.col("event_id") % 7
    number = F.col("value").cast("string")
    broken = (
        F.when(kind == 0, "abc").when(kind == 1, "nan").when(kind == 2, None).otherwise(number)
    )
    raw = events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("series_key"),
        second_text("ts").alias("window_start"),
        broken.alias("avg_precipitation"),
        F.when(kind == 3, "").otherwise(number).alias("avg_temperature"),
    )
    cleaned = series.clean_series(raw, keep=("event_id",))
    return cleaned.withColumn("ds", second_text("ds"))


@query
def series_index(spark, sf_dir):
    indexed = series.series_index(user_events(spark, sf_dir), ties=["event_id"])
    return indexed.select("event_id", "series_key", "idx", "n")


@query
def series_index_ranged(spark, sf_dir):
    indexed = series.series_index(user_events(spark, sf_dir), ties=["event_id"], crowded=True)
    return indexed.select("event_id", "series_key", "idx", "n")


@query
def train_split(spark, sf_dir):
    split = series.train_split(user_events(spark, sf_dir), ties=["event_id"])
    return split.select(
        "event_id", "idx", "n", "changepoints", "daily", "train_size", "is_train", "reliability"
    )


@query
def fit_config(spark, sf_dir):
    sizes = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return series.with_config(sizes)


@query
def regressor_gate(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    candidates = items.select(
        F.col("l_partkey").cast("string").alias("series_key"),
        F.col("l_quantity").alias("quantity"),
        F.lit(8.5).alias("constant"),
    )
    parts = []
    for name in ("quantity", "constant"):
        gated = series.regressor_gate(candidates, regressor=name)
        parts.append(gated.withColumn("regressor", F.lit(name)))
    return rounded(parts[0].unionByName(parts[1]), "x_std")


@query
def last_value_per_series(spark, sf_dir):
    newest = series.last_values(user_events(spark, sf_dir), ["value"], ties=["event_id"])
    return newest.withColumn("ds", F.date_format("ds", MICRO_FORMAT))


def _newest_by_type(spark, sf_dir):
    typed = events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("series_key"), F.col("ts").alias("ds"), "value"
    )
    return series.last_n(typed, ties=["event_id"])


@query
def last_n_per_series(spark, sf_dir):
    return _newest_by_type(spark, sf_dir).select("series_key", "event_id", "value")


@query
def every_kth(spark, sf_dir):
    # At most 30 rows per key are left to number.
    order = Window.partitionBy("series_key").orderBy("ds", "event_id")
    numbered = _newest_by_type(spark, sf_dir).withColumn("step_no", F.row_number().over(order) - 1)
    return series.every_kth(numbered).select("series_key", "event_id", "minutes")


@query
def future_frame(spark, sf_dir):
    newest = events(spark, sf_dir).groupBy("event_type").agg(F.max("ts").alias("last_ds"))
    frame = series.future_frame(newest)
    return frame.select("event_type", "step_no", F.date_format("ds", MICRO_FORMAT).alias("ds"))


# -------------------------------------------------------------------- forecasts


# A daily series has one row per day, so none is too long for one task.
DAILY = {"step": DAY, "crowded": False}


def _forecast_report(frame):
    shown = frame.withColumn("ds", second_text("ds")).drop("step_no", *forecast.SIZE_COLUMNS)
    return rounded(shown, "yhat")


@query
def forecast_linear(spark, sf_dir):
    return _forecast_report(forecast.forecast_linear(user_days(spark, sf_dir), **DAILY))


@query
def forecast_linear_train_end(spark, sf_dir):
    days = user_days(spark, sf_dir)
    return _forecast_report(forecast.forecast_linear(days, origin="train_end", **DAILY))


def _additive_report(frame):
    """Two solvers agree to some nine digits; three are compared. The shift keeps values that
    are half-way between two results, which simple numbers give, away from the edge."""
    return _forecast_report(frame.withColumn("yhat", F.round(F.col("yhat") + 1e-5, 3)))


@query
def forecast_additive(spark, sf_dir):
    return _additive_report(forecast.forecast_additive(user_days(spark, sf_dir), **DAILY))


@query
def holdout_metrics(spark, sf_dir):
    return rounded(forecast.holdout_metrics(user_days(spark, sf_dir), **DAILY), "mae", "rmse")


@query
def backtest_linear(spark, sf_dir):
    """Hourly series, tested at an origin every twelve hours."""
    series_ = type_hours(spark, sf_dir)
    errors = forecast.backtest_linear(series_, step=3600, horizon=24, every=12, least=24)
    return rounded(errors, "mae", "rmse")


@query
def trend_slope(spark, sf_dir):
    model = forecast.fit_linear(user_days(spark, sf_dir), step=DAY)
    return model.select(
        "series_key",
        "n",
        F.round("slope", 6).alias("slope"),
        scoring.trend_label(F.col("slope")).alias("trend_label"),
    )


def _user_forecast(spark, sf_dir):
    return forecast.forecast_linear(user_days(spark, sf_dir), history=False, **DAILY)


def _user_analysis(spark, sf_dir):
    return reports.score_forecast(_user_forecast(spark, sf_dir), threshold=SCORE_THRESHOLD)


@query
def predictions_array(spark, sf_dir):
    shown = F.transform("predictions", lambda v: F.format_string("%.6f", v))
    return _user_analysis(spark, sf_dir).select(
        "series_key", F.concat_ws(",", shown).alias("predictions")
    )


@query
def exceedance_score(spark, sf_dir):
    columns = ["avg_predicted", "max_predicted", "trend", "score"]
    return rounded(_user_analysis(spark, sf_dir).select("series_key", *columns), *columns)


@query
def decision(spark, sf_dir):
    return _user_analysis(spark, sf_dir).select("series_key", "decision", "trend_label")


@query
def forecast_report(spark, sf_dir):
    return reports.report_summary(_user_analysis(spark, sf_dir))


@query
def report_breakdown(spark, sf_dir):
    return rounded(reports.report_breakdown(_user_forecast(spark, sf_dir)), "yhat")


@query
def forecast_from_csv(spark, sf_dir):
    folder = scratch_path(spark, "forecast-csv")
    exported = user_days(spark, sf_dir).select(
        "series_key",
        second_text("ds").alias("window_start"),
        F.col("x").alias("avg_temperature"),
        F.col("y").alias("avg_precipitation"),
    )
    writers.export_csv(exported, folder)
    schema = "series_key STRING, window_start STRING, avg_temperature STRING, avg_precipitation STRING"
    done = batch.forecast_from_csv(
        spark, folder, schema, "series_key", "linear", DAY, threshold=SCORE_THRESHOLD
    )
    return rounded(done.analysis.select("series_key", "score", "decision"), "score")


HOUR = 3600


@query
def forecast_from_csv_additive(spark, sf_dir):
    """The default model of the batch job: hours per event type, exported and read back."""
    folder = scratch_path(spark, "hours-csv")
    exported = type_hours(spark, sf_dir).select(
        F.col("x").alias("avg_temperature"),
        "series_key",
        F.col("y").alias("avg_precipitation"),
        second_text("ds").alias("window_start"),
    )
    writers.export_csv(exported, folder)
    schema = "series_key STRING, window_start STRING, avg_temperature STRING, avg_precipitation STRING"
    done = batch.forecast_from_csv(spark, folder, schema, "series_key", step=HOUR)
    shown = done.forecast.join(done.span, "series_key").select(
        "series_key",
        second_text("ds").alias("ds"),
        F.round(F.col("yhat") + 1e-5, 3).alias("yhat"),
        "is_future",
        F.col("total_records").alias("n"),
        "reliability",
    )
    return shown


@query
def forecast_additive_hours(spark, sf_dir):
    """Series with daily waves, five bends and the regressor."""
    fitted = forecast.forecast_additive(type_hours(spark, sf_dir), step=HOUR)
    return _additive_report(fitted)


@query
def tumbling_window_nulls(spark, sf_dir):
    """Both ways to joined window means over NULL keys and values; they have to agree."""
    rows = with_nulls(spark, sf_dir)
    left, right = (
        rows.where(F.col("event_type") == kind).select("obs_key", "arrival_ts", "value")
        for kind in ("click", "view")
    )
    parts = [
        _as_report(joined_windows.joined_window_agg(left, right, -300, 300, method=m, **more)).withColumn("way", F.lit(way))
        for way, m, more in (("pairs", "pairs", {}), ("sums", "sums", {}), ("slices", "sums", {"slices": 4}))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def series_index_nulls(spark, sf_dir):
    """Both ways to number the rows of series, one of which has a NULL key."""
    rows = with_nulls(spark, sf_dir).select("event_id", "series_key", F.col("arrival_ts").alias("ds"))
    parts = [
        series.series_index(rows, ties=["event_id"], crowded=crowded).withColumn("crowded", F.lit(crowded))
        for crowded in (False, True)
    ]
    return parts[0].unionByName(parts[1]).select("event_id", "series_key", "idx", "n", "crowded")


@query
def wallclock_join_windows(spark, sf_dir):
    """Pairs in the window of their later half, the moment at which a running job forms them."""
    left, right = hour_streams(spark, sf_dir)
    pairs = paired_readings(left, right, -300, 300)
    formed = pairs.withColumn("formed", F.greatest("t1", "t2"))
    metrics = {"avg_v1": "v1", "avg_v2": "v2"}
    return _as_report(tumbling_agg(formed, "formed", metrics, latest="obs_key"))


@query
def store_of_two_runs(spark, sf_dir):
    """One store fed by two streams with a checkpoint each, then compacted."""
    work = scratch_path(spark, "two-runs")
    session = jobs.state_session(spark)
    for run, kinds in (("first", ("click", "view")), ("second", ("error", "purchase", "signup"))):
        stream = _events_stream(session, sf_dir).where(F.col("event_type").isin(*kinds))
        dated = stream.withColumn("window_date", F.to_date("ts")).select("event_id", "event_type", "value", "window_date")
        sink = writers.window_store(f"{work}/store", "window_date")
        jobs.replay(dated, [sink], f"{work}/{run}")
    writers.compact_store(spark, f"{work}/store", f"{work}/compact", "window_date")
    day = F.date_format("window_date", "yyyy-MM-dd").alias("window_date")
    return writers.stored_documents(spark, f"{work}/compact").select("event_id", "event_type", "value", day)


@query
def csv_mixed_files(spark, sf_dir):
    """Files of two encodings and three column orders, with quotes, line ends and blanks inside values."""
    folder = scratch_path(spark, "mixed csv")
    note = F.concat(F.lit(' say "é", '), F.col("event_type"), F.lit('\nnext "'), F.col("event_id").cast("string"))
    rows = events(spark, sf_dir).select("event_id", "value", "user_id", note.alias("note"))
    layouts = (
        (["event_id", "note", "value", "user_id"], "UTF-8"),
        (["note", "user_id", "event_id", "value"], "UTF-8"),
        (["value", "event_id", "note"], "ISO-8859-1"),
    )
    for number, (columns, encoding) in enumerate(layouts):
        part = rows.where(F.col("event_id") % len(layouts) == number).select(*columns)
        writers.export_csv(part, f"{folder}/part {number}", encoding=encoding)
    return csv_files.read_csv(spark, f"{folder}/part *", "event_id BIGINT, note STRING, value DOUBLE")


@query
def dead_letters_raw(spark, sf_dir):
    """Every dead letter with its raw text."""
    _, dead = parsing.parse_messages(broken_messages(spark, sf_dir), mode="strict")
    return dead.select("reason", "raw")


@query
def catalog_tables(spark, sf_dir):
    """The rows of tables that are saved under a schema and found by listing it."""
    schema = f"gauge_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'catalog')}'")
    names = ("nation", "orders", "supplier")
    for name in names:
        writers.save_table(table(spark, sf_dir, name), f"{schema}.{name}")
    # Temporary views are listed as well, whatever the schema.
    listed = sorted(r.tableName for r in tables.show_tables(spark, schema).where("NOT isTemporary").collect())
    counts = [
        spark.table(f"{schema}.{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in listed
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def fan_out_sinks(spark, sf_dir):
    """One stream into two sinks; both hold all of it."""
    work = scratch_path(spark, "fan-out")
    session = jobs.state_session(spark)
    stream = _events_stream(session, sf_dir).select("event_id", "value")
    plain = writers.connector_sink("parquet", {"path": f"{work}/plain"})
    jobs.replay(stream, [writers.window_store(f"{work}/store"), plain], f"{work}/checkpoint")
    parts = [writers.stored_documents(spark, f"{work}/store"), spark.read.parquet(f"{work}/plain")]
    return parts[0].withColumn("sink", F.lit("store")).unionByName(parts[1].withColumn("sink", F.lit("plain")))


@query
def prepare_series(spark, sf_dir):
    """Orders as series per priority; one priority has a constant regressor."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_key"),
        second_text("o_orderdate").alias("window_start"),
        F.col("o_totalprice").cast("string").alias("avg_precipitation"),
        F.when(F.col("o_orderpriority").startswith("1"), "8.5")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("avg_temperature"),
    )
    prepared = series.prepare_series(orders)
    return prepared.withColumn("ds", second_text("ds"))
