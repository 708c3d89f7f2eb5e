"""Structured Streaming re-aim of the incremental loads.

``scd_micro_batches`` turns a stream of source rows into dimension loads: each
micro-batch is applied to the newest published batch and published as the next
one.  The pointer keeps, per stream, the last micro-batch it holds: a micro-batch
that is run again after a failure between the publish and the stream's commit is
recognised and skipped, so it takes effect exactly once.  An empty micro-batch
publishes nothing, and a stream with a fresh checkpoint goes on from whatever the
dimension holds.

``latest_per_window`` is the event-time form of the batch high-watermark:
the latest row per key and window, emitted once the watermark passes the end
of the window; rows later than the allowed delay are dropped (as rows before
the watermark are never re-read by the batch form).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.operators.scd_type6 import type6_changes
from loadsmith.operators.scd_versioned import versioned_changes
from loadsmith.sinks.publish import (
    current_pointer,
    part_reader,
    publish_dimension,
    read_active,
    read_history,
)
from loadsmith.specs import Type6Spec, VersionedSpec


def latest_per_window(stream: DataFrame, key: str, ts: str, window: str, delay: str,
                      columns, start_offset: str | None = None) -> DataFrame:
    """Latest row per (key, event-time window), final once the watermark passes.

    ``start_offset`` shifts window starts (``"4 days"`` aligns 7-day windows to Mondays).
    """
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        # watermarks need TIMESTAMP; wall-clock values read in the session time zone
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    fields = [F.col(ts).alias("_ls_ts"), *[F.col(c) for c in columns]]
    win = F.window(ts, window, window, start_offset) if start_offset else F.window(ts, window)
    agg = (stream.withWatermark(ts, delay)
           .groupBy(F.col(key), win.alias("_ls_w"))
           .agg(F.max(F.struct(*fields)).alias("_ls_r")))
    return agg.select(key, F.col("_ls_w.start").alias("window_start"),
                      F.col("_ls_w.end").alias("window_end"), F.col("_ls_r._ls_ts").alias(ts),
                      *[F.col(f"_ls_r.{c}").alias(c) for c in columns])


def scd_micro_batches(spark: SparkSession, base: str, spec, empty_schema: str, run_date_of=None,
                      stream_id: str | None = None):
    """A ``foreachBatch`` function applying each micro-batch as one dimension load.

    ``run_date_of(batch_df)`` gives the run date of a type-6 batch (default:
    the latest source date in the micro-batch); ignored for versioned specs.
    ``stream_id`` names the stream whose micro-batch numbers count up; by default the
    running query's own id, which lives in its checkpoint.  Outside a query, and
    without one, the function is a stream of its own.
    """
    own = uuid.uuid4().hex

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        stream = (stream_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or own)
        ptr = current_pointer(spark, base)
        seen = dict((ptr or {}).get("streams", {}))
        if batch_id <= seen.get(stream, -1):
            return  # published before a restart
        seen[stream] = batch_id
        if ptr is None:
            empty = spark.createDataFrame([], empty_schema)
            at, start, active, history, closing = 0, 0, empty, empty, None
        else:
            at, start = int(ptr["batch"]), int(ptr["max_key"])
            active, history = read_active(spark, base, at), read_history(spark, base, at)
            closing = part_reader(spark, base, ptr, spec.key)
        if isinstance(spec, Type6Spec):
            run_date = (run_date_of(batch) if run_date_of else
                        batch.agg(F.max(F.col(spec.source_date).cast("date"))).first()[0])
            changes = type6_changes(None, batch, spec, run_date, start_after=start, active=active,
                                    history=history, closing=closing)
        elif isinstance(spec, VersionedSpec):
            changes = versioned_changes(None, batch, spec, start_after=start, active=active,
                                        history=history, closing=closing)
        else:
            raise TypeError(f"unsupported spec {type(spec).__name__}")
        publish_dimension(spark, changes, base, at + 1, spec.key, spec.surrogate, start,
                          include_history=ptr is None, extra={"streams": seen})
    return apply


def start_scd_stream(stream: DataFrame, base: str, spec, empty_schema: str, checkpoint: str,
                     run_date_of=None, available_now: bool = True, query_name: str | None = None):
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    spark = stream.sparkSession
    writer = (stream.writeStream.foreachBatch(scd_micro_batches(spark, base, spec, empty_schema,
                                                                run_date_of))
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
