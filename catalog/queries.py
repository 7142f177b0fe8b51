"""The operators applied to the ``events`` table.

A user is a device, ``value`` its reading, an ``error`` event a true fault, ``event_id`` the tie-break.
"""

from __future__ import annotations

import gzip
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tremorline.functions.keys import epoch_seconds, object_key, partition_values
from tremorline.functions.payload import CORRUPT, decode_payload, encode_payload, window_payloads
from tremorline.operators.backlog import (
    dedupe_redelivery,
    fifo_order,
    peek_oldest,
    pending_batches,
    queue_depth,
)
from tremorline.operators.detect import confusion_class, confusion_counts, flag_anomalies
from tremorline.operators.features import (
    count_window_aggregates,
    extract_features,
    features_for_devices,
    time_window_features,
    time_window_spectral_features,
    window_spectra,
)
from tremorline.operators.labels import label_fault_stream, label_faults
from tremorline.operators.windows import buffer_depth, latest_n
from tremorline.plans.detection import detect, detect_time_windows, evaluate, report
from tremorline.plans.publishing import archive_batches, backlog, publish
from tremorline.session import cut_lineage, new_folder
from tremorline.sources.archive import (
    audit_archive,
    audit_archive_folder,
    fill_missing_time,
    parse_records,
    read_archive,
    split_quarantine,
    with_device,
)
from tremorline.sources.archive_files import store_of
from tremorline.sources.lake import list_lake, read_lake, write_lake
from tremorline.sources.samples import read_sample_stream, to_samples
from tremorline.streaming import sinks
from tremorline.streaming.batch_windows import count_windows_by_batch
from tremorline.streaming.count_windows import stream_count_windows, stream_count_windows_in_order, stream_detect
from tremorline.streaming.time_windows import stream_detect_time_windows, stream_time_windows

SIZE = 16
RMS_LIMIT = 80.0
STD_LIMIT = 55.0
LIMITS = {"rms_threshold": RMS_LIMIT, "std_threshold": STD_LIMIT}

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _as_samples(df: DataFrame) -> DataFrame:
    return to_samples(df, "user_id", "ts", "value", "event_id", F.col("event_type") == "error")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_samples(events(spark, sf_dir))


def crowded_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fifths of all rows on one device."""
    one = F.when(F.col("event_type").isin("view", "click"), "gateway").otherwise(F.col("user_id").cast("string"))
    return to_samples(
        events(spark, sf_dir), one, "ts", "value", "event_id", F.col("event_type").isin("error", "click")
    )


def drain(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery], late: Column | None = None) -> None:
    """Deliver the events in three parts by time; after each, start the stream anew and let it take what has come.

    So every stream runs over several micro-batches and goes on from its checkpoint twice. ``late`` rows come with the
    last part.
    """
    folder, rows = new_folder(spark, "arriving"), events(spark, sf_dir)
    part = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(
        F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1
    ).otherwise(2)
    part = part if late is None else F.when(late, 2).otherwise(part)
    for number in range(3):
        rows.where(part == number).write.mode("append").parquet(folder)
        start(_as_samples(read_sample_stream(spark, folder, EVENTS_SCHEMA, max_files=10_000))).awaitTermination()


def faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve hours from every error event; intervals of a device overlap."""
    errors = samples(spark, sf_dir).where("ground_truth")
    return errors.select(
        "device_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("interval 12 hours")).alias("end_ts")
    )


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(samples(spark, sf_dir), SIZE, **LIMITS)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows as batches, without the spectrum."""
    windows = count_window_aggregates(samples(spark, sf_dir), SIZE, with_array=False)
    flagged = flag_anomalies(windows.withColumn("dominant_freq_hz", F.lit(0.0)), **LIMITS)
    return window_payloads(flagged)


def _is_synced() -> Column:
    return F.col("window_end") < F.lit("2024-01-16").cast("timestamp")


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select ``columns``; doubles to nine places (frequencies are tiny: twelve), times as seconds."""
    types = dict(df.dtypes)
    picked = []
    for name in columns:
        column = F.col(name)
        if types[name] == "timestamp":
            column = F.round(epoch_seconds(column), 6)
        elif types[name] == "double":
            column = F.round(column, 12 if name.endswith("_hz") else 9)
        picked.append(column.alias(name))
    return df.select(*picked)


WINDOW_COLUMNS = ["device_id", "window_id", "n", "rms", "mean", "std", "window_start", "window_end", "ground_truth"]
DETECTED = ["device_id", "window_id", "n", "rms", "mean", "std", "dominant_freq_hz", "window_end",
            "anomaly_detected", "ground_truth"]
METRICS = ["true_positives", "false_positives", "false_negatives", "true_negatives", "total_windows",
           "precision", "recall", "f1_score", "accuracy"]


# Sources


def q_samples(spark, sf_dir):
    return rounded(samples(spark, sf_dir), ["device_id", "ts", "seq", "acceleration", "ground_truth"])


# Windows


def q_latest_n(spark, sf_dir):
    return rounded(latest_n(samples(spark, sf_dir), 10), ["device_id", "ts", "seq", "acceleration"])


def q_latest_n_large(spark, sf_dir):
    """Above the size that Spark limits by itself, with readings whose time is missing."""
    rows = crowded_samples(spark, sf_dir).withColumn("ts", F.when(F.col("seq") % 7 != 0, F.col("ts")))
    return rounded(latest_n(rows, 1500, block_rows=1024), ["device_id", "ts", "seq", "acceleration"])


def q_buffer_depth(spark, sf_dir):
    return buffer_depth(samples(spark, sf_dir), 64)


def q_rolling_count_window(spark, sf_dir):
    windows = count_window_aggregates(samples(spark, sf_dir), 32, hop=8, with_array=False)
    return rounded(windows, WINDOW_COLUMNS)


def q_time_window_features(spark, sf_dir):
    windows = time_window_features(samples(spark, sf_dir), "6 hours")
    return rounded(windows, ["device_id", "interval_start", "n", "rms", "mean", "std", "sample_rate_hz", "ground_truth"])


# Features


def q_count_window_features(spark, sf_dir):
    return rounded(count_window_aggregates(samples(spark, sf_dir), SIZE, with_array=False), WINDOW_COLUMNS)


def q_magnitude_spectrum(spark, sf_dir):
    spectra = window_spectra(samples(spark, sf_dir), SIZE)
    return spectra.select(
        "device_id", "window_id", "bin", F.round("frequency_hz", 12).alias("frequency_hz"),
        F.round("magnitude", 6).alias("magnitude"),
    )


def q_dominant_frequency(spark, sf_dir):
    windows = extract_features(samples(spark, sf_dir), SIZE)
    return rounded(windows, ["device_id", "window_id", "sample_rate_hz", "dominant_bin", "dominant_freq_hz"])


def q_device_feature_defaults(spark, sf_dir):
    devices = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("device_id")
    )
    return rounded(features_for_devices(devices, samples(spark, sf_dir), SIZE), ["device_id", "rms", "mean", "std", "dominant_freq_hz"])


def q_detect_time_windows(spark, sf_dir):
    return rounded(detect_time_windows(samples(spark, sf_dir), "5 days", RMS_LIMIT, STD_LIMIT), DETECTED)


def q_crowded_time_windows(spark, sf_dir):
    """Windows of more readings than a task may hold, which here are 256: their transform is split over tasks."""
    windows = time_window_spectral_features(crowded_samples(spark, sf_dir), "5 days", window_rows=256)
    return rounded(windows, ["device_id", "window_id", "n", "rms", "mean", "std", "dominant_freq_hz", "ground_truth"])


# Detection and scoring


def q_missing_features(spark, sf_dir):
    """Features that are missing or not a number breach nothing."""
    kind, nan = F.col("event_type"), F.lit(float("nan"))
    rows = events(spark, sf_dir).select(
        "event_id",
        F.when(kind == "view", None).when(kind == "click", nan).otherwise(F.col("value")).alias("rms"),
        F.when(kind == "signup", None).when(kind == "error", nan).otherwise(F.col("value") / 2).alias("std"),
    )
    return flag_anomalies(rows, **LIMITS).select("event_id", "anomaly_detected")


def q_detect_anomalies(spark, sf_dir):
    return rounded(detected(spark, sf_dir), DETECTED)


def q_confusion_classes(spark, sf_dir):
    windows = flag_anomalies(count_window_aggregates(samples(spark, sf_dir), SIZE, with_array=False), **LIMITS)
    outcome = confusion_class(F.col("anomaly_detected"), F.col("ground_truth"))
    return windows.select("device_id", "window_id", outcome.alias("outcome"))


def q_confusion_counts(spark, sf_dir):
    windows = flag_anomalies(count_window_aggregates(samples(spark, sf_dir), SIZE, with_array=False), **LIMITS)
    return confusion_counts(windows, ["device_id"])


def q_confusion_metrics(spark, sf_dir):
    return evaluate(samples(spark, sf_dir), SIZE, RMS_LIMIT, STD_LIMIT).select(*METRICS)


def q_device_metrics(spark, sf_dir):
    return evaluate(samples(spark, sf_dir), SIZE, RMS_LIMIT, STD_LIMIT, by=["device_id"]).select("device_id", *METRICS)


def q_metrics_report(spark, sf_dir):
    return report(samples(spark, sf_dir), SIZE, RMS_LIMIT, STD_LIMIT)


# Fault schedules


def q_fault_labels(spark, sf_dir):
    labelled = label_faults(samples(spark, sf_dir), faults(spark, sf_dir))
    return labelled.select("device_id", "seq", "ground_truth")


def q_labelled_evaluation(spark, sf_dir):
    labelled = cut_lineage(label_faults(samples(spark, sf_dir), faults(spark, sf_dir)))
    return evaluate(labelled, SIZE, RMS_LIMIT, STD_LIMIT).select(*METRICS)


def q_labels_missing_device(spark, sf_dir):
    """A missing device has no faults, in the schedule or among the samples, whatever the schedule's size."""
    device = F.when(F.col("event_type") != "view", F.col("user_id"))
    rows = to_samples(events(spark, sf_dir), device, "ts", "value", "event_id", F.col("event_type").isin("error", "view"))
    schedule = rows.where("ground_truth").select(
        "device_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("interval 12 hours")).alias("end_ts")
    )
    halves = [
        label_faults(rows.where(F.col("seq") % 2 == odd), schedule, max_pieces=limit) for odd, limit in ((0, 0), (1, 10**9))
    ]
    return halves[0].unionByName(halves[1]).select("device_id", "seq", "ground_truth")


# The same operators with two fifths of the rows on one device, cut into blocks


def q_crowded_device_features(spark, sf_dir):
    return rounded(extract_features(crowded_samples(spark, sf_dir), SIZE, block_rows=1024),
                   ["device_id", "window_id", "n", "rms", "mean", "std", "dominant_freq_hz", "ground_truth"])


def q_crowded_rolling_window(spark, sf_dir):
    windows = count_window_aggregates(
        crowded_samples(spark, sf_dir), 32, hop=8, with_array=False, block_rows=1024
    )
    return rounded(windows, WINDOW_COLUMNS)


def q_crowded_fault_labels(spark, sf_dir):
    rows = crowded_samples(spark, sf_dir)
    schedule = rows.where("ground_truth").select(
        "device_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("interval 10 minutes")).alias("end_ts")
    )
    labelled = label_faults(rows, schedule, max_pieces=0, block_rows=1024)
    return labelled.select("device_id", "seq", "ground_truth")


# Payloads and keys


def q_payload_json(spark, sf_dir):
    rows = window_payloads(detected(spark, sf_dir)).withColumn("json", encode_payload())
    back = rows.select("device_id", "batch_id", decode_payload(F.col("json")).alias("p")).where(
        F.col(f"p.{CORRUPT}").isNull()
    )
    return rounded(
        back.select("device_id", "batch_id", "p.timestamp", "p.features.*", "p.anomaly_detected", "p.ground_truth"),
        ["device_id", "batch_id", "timestamp", "rms", "mean", "std", "dominant_freq_hz", "anomaly_detected",
         "ground_truth"],
    )


def q_partition_keys(spark, sf_dir):
    rows = batches(spark, sf_dir)
    end = F.timestamp_micros(F.round(F.col("timestamp") * 1e6).cast("bigint"))
    return rows.select(
        "device_id", "window_id", "batch_id", *partition_values(end),
        object_key(end, F.col("device_id"), F.col("batch_id")).alias("object_key"),
    )


# Archive


def q_json_decode(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    parsed = decode_payload(text, T.StructType([T.StructField("k", T.LongType())]))
    rows = events(spark, sf_dir).select("event_id", parsed.alias("p"))
    return rows.select("event_id", "p.k", F.col(f"p.{CORRUPT}").alias("corrupt"))


def q_archive_quarantine(spark, sf_dir):
    """Each event type stands for a kind of record; the oracle applies JSON rules to the same texts."""
    seconds = F.format_string("%.6f", epoch_seconds(F.col("ts").cast("timestamp")))
    good = F.concat(F.lit('{"timestamp": '), seconds, F.lit(', "anomaly_detected": true}'))
    record = (
        F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_type") == "signup", F.lit("{}"))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("["), "props", F.lit("]")))
        .when(F.col("event_type") == "view", F.col("props"))
        .otherwise(good)
    )
    parsed = parse_records(events(spark, sf_dir).select("event_id", record.alias("record")))
    return parsed.select("event_id", "reason", F.round("timestamp", 6).alias("timestamp"), "anomaly_detected")


def q_archive_scan(spark, sf_dir):
    path = new_folder(spark, "archive")
    archive_batches(detected(spark, sf_dir), path)
    rows = read_archive(spark, path).where(F.col(CORRUPT).isNull())
    return rounded(rows.select("device_id", "batch_id", "timestamp", "features.*", "anomaly_detected", "ground_truth"),
                   ["device_id", "batch_id", "timestamp", "rms", "mean", "std", "dominant_freq_hz",
                    "anomaly_detected", "ground_truth"])


def q_archive_audit(spark, sf_dir):
    path = new_folder(spark, "archive")
    archive_batches(detected(spark, sf_dir), path)
    good, _ = split_quarantine(audit_archive(spark, path))
    return rounded(good.select("device_id", "batch_id", "timestamp", "features.*", "anomaly_detected", "ground_truth"),
                   ["device_id", "batch_id", "timestamp", "rms", "mean", "std", "dominant_freq_hz",
                    "anomaly_detected", "ground_truth"])


def _put_files(path: str) -> Callable:
    """Writes the records of each (file, kind) group as one file of the kind."""

    def put(table: pa.Table) -> pa.Table:
        kind, name = (table.column(c)[0].as_py() for c in ("kind", "name"))
        body = "\n".join(table.column("record").to_pylist()).encode()
        content = {"zero": b"", "empty": gzip.compress(b"\n"), "truncated": gzip.compress(body)[:-9], "plain": body}.get(kind, gzip.compress(body))
        store, folder = store_of(path)
        with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
            out.write(content)
        return pa.table({"name": [name]})

    return put


def q_archive_layout(spark, sf_dir):
    """One file per day and type of event: whole, still being written, truncated, not zipped, empty, of zero bytes, undated; no record
    names its device."""
    path = new_folder(spark, "archive")
    even = F.dayofmonth("ts") % 2 == 0
    kind = (
        F.when(F.col("event_type") == "view", "tmp")
        .when(F.col("event_type") == "error", F.when(even, "truncated").otherwise("plain"))
        .when(F.col("event_type") == "purchase", F.when(even, "zero").otherwise("empty"))
        .when(F.col("event_type") == "signup", "undated")
        .otherwise("whole")
    )
    seconds = F.format_string("%.6f", epoch_seconds(F.col("ts").cast("timestamp")))
    dated = F.when(kind != "undated", F.concat(F.lit('"timestamp": '), seconds, F.lit(", "))).otherwise("")
    rows = events(spark, sf_dir).select(
        kind.alias("kind"),
        F.concat(F.lit("batch_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), "event_type", F.lit(".json.gz"),
                 F.when(kind == "tmp", ".tmp").otherwise("")).alias("name"),
        F.concat(F.lit("{"), dated, F.lit('"anomaly_detected": true}')).alias("record"),
    )
    store, folder = store_of(path)
    store.create_dir(folder)
    rows.groupBy("name").applyInArrow(_put_files(path), "name string").count()
    audited = with_device(fill_missing_time(audit_archive_folder(spark, path)), "edge")
    return audited.groupBy("file_name", "reason", "device_id").agg(
        F.count("record").alias("n_records"), F.count("timestamp").alias("n_dated"), F.count_if("anomaly_detected").alias("n_anomalies")
    )


# Backlog


def q_fifo_order(spark, sf_dir):
    return fifo_order(batches(spark, sf_dir)).select("device_id", "batch_id", "queue_position")


def q_fifo_foreign_ids(spark, sf_dir):
    """Ids of another maker that share their first 14 bytes and whose numbers have no fixed width, two fifths on one device."""
    rows = crowded_samples(spark, sf_dir)
    ids = F.concat(F.date_format("ts", "'batch_'yyyy-MM-dd"), F.lit("_"), F.col("seq").cast("string"))
    return fifo_order(rows.select("device_id", ids.alias("batch_id")))


def q_peek_oldest(spark, sf_dir):
    return rounded(peek_oldest(batches(spark, sf_dir)), ["device_id", "batch_id", "timestamp", "anomaly_detected"])


def q_pending_batches(spark, sf_dir):
    queued = batches(spark, sf_dir)
    return pending_batches(queued, queued.where(_is_synced())).select("device_id", "batch_id")


def q_queue_depth(spark, sf_dir):
    queued = batches(spark, sf_dir)
    return queue_depth(pending_batches(queued, queued.where(_is_synced())))


def q_dedupe_redelivery(spark, sf_dir):
    times = F.sequence(F.lit(1), F.when(F.col("anomaly_detected"), 3).otherwise(1))
    delivered = batches(spark, sf_dir).withColumn("delivery", F.explode(times))
    return dedupe_redelivery(delivered, F.col("delivery")).select("device_id", "batch_id", "delivery")


def q_backlog_view(spark, sf_dir):
    archive, lake = new_folder(spark, "archive"), new_folder(spark, "lake")
    queued = batches(spark, sf_dir)
    queued.drop("window_id", "window_end").write.option("compression", "gzip").json(archive)
    write_lake(queued.where(_is_synced()), lake)
    waiting, _ = backlog(spark, archive, read_lake(spark, lake))
    return waiting.select("device_id", "batch_id", "queue_position")


# Lake


def q_lake_roundtrip(spark, sf_dir):
    lake = publish(detected(spark, sf_dir), new_folder(spark, "lake"))
    return rounded(lake.select("*", "features.*"),
                   ["year", "month", "day", "device_id", "batch_id", "timestamp", "rms", "mean", "std",
                    "dominant_freq_hz", "anomaly_detected", "ground_truth"])


def q_publish_twice(spark, sf_dir):
    """A retry leaves the lake as it was, and so does writing a part of a folder again."""
    path, windows = new_folder(spark, "lake"), detected(spark, sf_dir)
    publish(windows, path)
    publish(windows.where("window_id % 3 = 0"), path)
    lake = publish(windows, path)
    return rounded(lake.select("*", "features.*"),
                   ["year", "month", "day", "device_id", "batch_id", "timestamp", "rms", "mean", "std",
                    "dominant_freq_hz", "anomaly_detected", "ground_truth"])


def q_pruned_read(spark, sf_dir):
    path = new_folder(spark, "lake")
    write_lake(batches(spark, sf_dir), path)
    days = read_lake(spark, path).where("year = '2024' and month = '01' and day between '10' and '20'")
    return days.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n_windows"), F.count_if("anomaly_detected").alias("n_anomalies")
    )


def q_lake_listing(spark, sf_dir):
    """Files of three batches at most; the sizes are those that a reader of the files is told."""
    path = new_folder(spark, "lake")
    write_lake(batches(spark, sf_dir), path, max_records=3)
    read = read_lake(spark, path, files=True).select("year", "month", "day", "device_id", "file_path", "file_size").distinct()
    told = read.groupBy("year", "month", "day", "device_id").agg(F.sum("file_size").alias("told"))
    listed = list_lake(spark, path).join(told, ["year", "month", "day", "device_id"])
    return listed.select("year", "month", "day", "device_id", "n_files", (F.col("n_bytes") == F.col("told")).alias("sizes_agree"))


# Streams


LAKE_COLUMNS = ["year", "month", "day", "device_id", "batch_id", "timestamp", "rms", "mean", "std", "dominant_freq_hz",
                "anomaly_detected", "ground_truth"]


def _drained(spark, sf_dir, windows: Callable[[DataFrame], DataFrame], late: Column | None = None) -> DataFrame:
    """The table of windows that a stream leaves."""
    path = new_folder(spark, "stream")
    drain(spark, sf_dir, lambda rows: sinks.write_windows(windows(rows), f"{path}/windows", f"{path}/checkpoint"), late)
    return spark.read.parquet(f"{path}/windows")


def q_stream_count_window(spark, sf_dir):
    return rounded(_drained(spark, sf_dir, lambda rows: stream_count_windows(rows, 32, hop=8)), WINDOW_COLUMNS)


def _unordered(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Windows and late samples of a stream that brings every third event up to two days late, and early signups much later."""
    path = new_folder(spark, "stream")
    folder, rows = new_folder(spark, "arriving"), events(spark, sf_dir)
    came = F.col("ts") + F.make_dt_interval((F.col("event_id") % 3).cast("int"))
    early = (F.col("event_type") == "signup") & (F.col("ts") < F.lit("2024-01-06").cast("timestamp_ntz"))
    part = F.when(early, 2).when(came < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(
        came < F.lit("2024-01-21").cast("timestamp_ntz"), 1
    ).otherwise(2)
    for number in range(3):
        rows.where(part == number).write.mode("append").parquet(folder)
        stream = _as_samples(read_sample_stream(spark, folder, EVENTS_SCHEMA, max_files=10_000))
        windows = stream_count_windows_in_order(stream, SIZE, "3 days", hop=8)
        sinks.write_ordered_windows(windows, f"{path}/windows", f"{path}/late", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/windows"), spark.read.parquet(f"{path}/late")


def q_stream_count_window_unordered(spark, sf_dir):
    return rounded(_unordered(spark, sf_dir)[0], WINDOW_COLUMNS)


def q_stream_late_samples(spark, sf_dir):
    return rounded(_unordered(spark, sf_dir)[1], ["device_id", "ts", "seq", "acceleration", "ground_truth"])


def q_stream_fault_labels(spark, sf_dir):
    """Samples and faults come in three parts; samples of the last days wait for faults that may still come."""
    path, folder = new_folder(spark, "stream"), new_folder(spark, "arriving")
    rows = events(spark, sf_dir)
    part = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(
        F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1
    ).otherwise(2)
    for number in range(3):
        rows.where(part == number).write.mode("append").parquet(folder)
        arriving, errors = (_as_samples(read_sample_stream(spark, folder, EVENTS_SCHEMA, max_files=10_000)) for _ in range(2))
        schedule = errors.where("ground_truth").select(
            "device_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("interval 12 hours")).alias("end_ts")
        )
        labelled = label_fault_stream(arriving, schedule, "1 day", "12 hours")
        sinks.write_windows(labelled, f"{path}/labelled", f"{path}/checkpoint").awaitTermination()
    settled = spark.read.parquet(f"{path}/labelled").where(F.col("ts") < F.lit("2024-01-26").cast("timestamp"))
    return settled.select("device_id", "seq", "ground_truth")


def q_stream_window_batches(spark, sf_dir):
    path = new_folder(spark, "stream")
    drain(spark, sf_dir, lambda rows: count_windows_by_batch(rows, SIZE, f"{path}/windows", f"{path}/state", f"{path}/checkpoint"))
    return rounded(spark.read.parquet(f"{path}/windows"), WINDOW_COLUMNS)


def q_stream_detect(spark, sf_dir):
    return rounded(_drained(spark, sf_dir, lambda rows: stream_detect(rows, SIZE, **LIMITS)), DETECTED)


TIMED = ["device_id", "interval_start", "n", "rms", "mean", "std", "ground_truth"]


def q_stream_time_window(spark, sf_dir):
    return rounded(_drained(spark, sf_dir, lambda rows: stream_time_windows(rows, "1 day", "2 days")), TIMED)


def q_stream_late_data(spark, sf_dir):
    """Early signups come when their windows have long been emitted, and are left out."""
    late = (F.col("event_type") == "signup") & (F.col("ts") < F.lit("2024-01-06").cast("timestamp_ntz"))
    return rounded(_drained(spark, sf_dir, lambda rows: stream_time_windows(rows, "1 day", "2 days"), late), TIMED)


def q_stream_detect_time_windows(spark, sf_dir):
    windows = _drained(spark, sf_dir, lambda rows: stream_detect_time_windows(rows, "5 days", "2 days", RMS_LIMIT, STD_LIMIT))
    return rounded(windows, DETECTED)


def q_stream_queue(spark, sf_dir):
    path = new_folder(spark, "stream")
    drain(spark, sf_dir, lambda rows: sinks.queue_windows(stream_detect(rows, SIZE, **LIMITS), f"{path}/queue", f"{path}/checkpoint"))
    rows = read_archive(spark, f"{path}/queue").where(F.col(CORRUPT).isNull())
    return rounded(rows.select("device_id", "batch_id", "timestamp", "features.*", "anomaly_detected", "ground_truth"), LAKE_COLUMNS[3:])


def q_stream_sync(spark, sf_dir):
    path = new_folder(spark, "stream")
    archive_batches(detected(spark, sf_dir), f"{path}/archive")
    archive = sinks.stream_archive(spark, f"{path}/archive")
    sinks.sync_to_lake(archive, f"{path}/lake", f"{path}/checkpoint").awaitTermination()
    return rounded(read_lake(spark, f"{path}/lake").select("*", "features.*"), LAKE_COLUMNS)


def q_sync_redelivered(spark, sf_dir):
    """Batches that arrive again, in another file and another micro-batch, and once more from a batch job."""
    path, windows = new_folder(spark, "stream"), detected(spark, sf_dir)
    for again in (windows, windows.where("window_id % 2 = 0")):
        archive_batches(again, f"{path}/archive")
        archive = sinks.stream_archive(spark, f"{path}/archive")
        sinks.sync_to_lake(archive, f"{path}/lake", f"{path}/checkpoint").awaitTermination()
    return rounded(publish(windows.where("window_id < 2"), f"{path}/lake").select("*", "features.*"), LAKE_COLUMNS)


def q_stream_metrics(spark, sf_dir):
    path = new_folder(spark, "stream")

    def start(rows: DataFrame) -> StreamingQuery:
        windows = stream_detect(rows, SIZE, **LIMITS)
        sinks.write_windows(windows, f"{path}/windows", f"{path}/c1").awaitTermination()
        finished = spark.readStream.schema(windows.schema).parquet(f"{path}/windows")
        return sinks.running_metrics(finished, f"{path}/metrics", f"{path}/c2")

    drain(spark, sf_dir, start)
    return spark.read.parquet(f"{path}/metrics").select(*METRICS)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
