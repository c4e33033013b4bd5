"""Scores a stream of conversions with a trained bundle. Scoring is row by row, so no
state or watermark is kept; the sink's checkpoint gives exactly-once output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cairn.plans.engine import Bundle, score
from cairn.sources.readers import prepare_conversions


def score_stream(bundle: Bundle, raw: DataFrame, path: str, checkpoint: str, calendar: DataFrame | None = None, available_now: bool = False) -> StreamingQuery:
    """Starts a query that appends scored rows to Parquet."""
    scored = score(bundle, prepare_conversions(raw, calendar))
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
