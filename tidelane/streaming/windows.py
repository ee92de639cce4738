"""Windows over streams: sessions closed by silence, interval rates, and a CSV log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def silence_sessions(df: DataFrame, by: list[str], at: str, gap: str, late: str) -> DataFrame:
    """Sessions of each key that end after ``gap`` without a row; works on streams and tables."""
    own = df.withWatermark(at, late) if df.isStreaming else df
    out = own.groupBy(*by, F.session_window(at, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def interval_rates(df: DataFrame, by: list[str], at: str, width: str, late: str) -> DataFrame:
    """Rows per tumbling window and key."""
    own = df.withWatermark(at, late) if df.isStreaming else df
    return own.groupBy(*by, F.window(at, width).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(*by, F.col("w.start").alias("window_start"), "n")


def log_csv(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to CSV files, each row exactly once."""
    return df.writeStream.format("csv").option("header", True).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
