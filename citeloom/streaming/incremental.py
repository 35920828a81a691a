"""Incremental arrival of records as Structured Streaming jobs, with their batch counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import filters
from ..operators.merge import VersionedTable


def accept_stream(arriving: DataFrame, table: VersionedTable, key: str, checkpoint: str, excluded: DataFrame | None = None) -> StreamingQuery:
    """Each micro-batch is classified against the table as it is then, and its new records are added, each key once.

    ``arriving`` needs dblp_key, doi and ``key``. A batch that is repeated after a failure adds nothing twice."""

    def add(batch: DataFrame, _: int) -> None:
        new = batch
        if table.exists():
            new = filters.classify_new(batch, table.read(), excluded).where("reason in ('new', 'missing_key')").drop("reason")
        table.append(new.dropDuplicates([key]), key)

    return arriving.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen_stream(events: DataFrame, key: str, time: str, delay: str = "30 days") -> DataFrame:
    """The first event of each key; state is dropped when the watermark has passed it."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def first_seen(events: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """The first event of each key of a finite table."""
    others = [c for c in events.columns if c != key]
    best = events.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(time, tie)).alias("e"))
    return best.select(key, *(F.col(f"e.`{c}`").alias(c) for c in others))


def windows(events: DataFrame, time: str, group: str, value: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Counts and sums by tumbling window and group; the watermark bounds the state when ``events`` is a stream."""
    source = events.withWatermark(time, delay) if events.isStreaming else events
    out = source.groupBy(F.window(time, width).alias("w"), group).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), group, "n", "total")


def run_to_end(stream: DataFrame, spark: SparkSession, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there now into a table in memory (for tests and small results)."""
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)
