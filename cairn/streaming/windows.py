"""Event-time aggregates of streams: tumbling, sliding and session windows under a watermark.

The same functions take batches, in which a watermark has no effect. On a stream in append
mode a window is put out once, when the watermark (the latest time seen, less the delay)
passes its end; a row that falls only into windows already put out is late and dropped (in
each micro-batch by the watermark that the batch before it went by).
Windows still open when a stream stops stay in its checkpoint for the next start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DELAY = "1 hour"


def event_stream(spark: SparkSession, path: str, like: DataFrame, **options: object) -> DataFrame:
    """A stream of the Parquet files at path, which a batch of the same table gives its columns.
    A path to a single file is read by a pattern, as a stream takes folders only."""
    reader = spark.readStream.schema(like.schema).options(**options)
    files = like.inputFiles()
    single = len(files) == 1 and files[0].rstrip("/").endswith("/" + path.rstrip("/").rsplit("/", 1)[-1])
    return reader.parquet(f"{path[:-1]}[{path[-1]}]" if single else path)


def _timed(events: DataFrame, time: str, delay: str) -> DataFrame:
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def _flat(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c not in ("window", "session_window")]
    name = "window" if "window" in grouped.columns else "session_window"
    return grouped.select(F.col(f"{name}.start").alias("window_start"), F.col(f"{name}.end").alias("window_end"), *rest)


def windowed(events: DataFrame, width: str, keys: list[str], aggregates: list[Column], slide: str | None = None, time: str = "ts", delay: str = DELAY) -> DataFrame:
    """Aggregates by window and keys; with a slide, windows of that width begin once every slide."""
    return _flat(_timed(events, time, delay).groupBy(F.window(time, width, slide), *keys).agg(*aggregates))


def sessions(events: DataFrame, gap: str, keys: list[str], aggregates: list[Column], time: str = "ts", delay: str = DELAY) -> DataFrame:
    """Aggregates by session of the keys: it ends when no row has come for the gap."""
    return _flat(_timed(events, time, delay).groupBy(F.session_window(time, gap), *keys).agg(*aggregates))


def append(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Starts a query that appends final rows to Parquet, each once over all restarts from the checkpoint."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
