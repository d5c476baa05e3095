"""Raw units as a stream: normalised as they arrive, counted in windows of their acquisition time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kstate.operators.normalize import normalize


#: what tells units apart
KEY = ("source_id", "snapshot_id", "unit_id")


def unit_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Raw units from Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def normalize_stream(units: DataFrame) -> DataFrame:
    """Addressed units; a unit delivered again passes once, and one that comes late, however late, passes too.

    The keys seen stay in the state for good: 16 bytes of a hash for each unit, not the unit.
    """
    key = F.unhex(F.md5(F.to_json(F.array(*KEY))))
    return normalize(units.withColumn("unit_key", key).dropDuplicates(["unit_key"]).drop("unit_key"))


def windowed_counts(units: DataFrame, width: str = "1 day", watermark: str = "2 days") -> DataFrame:
    """(start, source_id, units): units per source in windows of acquisition time; later ones than the watermark are left to the batch run."""
    w = units.withWatermark("acquired_at", watermark).groupBy(F.window("acquired_at", width).alias("w"), "source_id").agg(F.count("*").alias("units"))
    return w.select(F.col("w.start").alias("start"), "source_id", "units")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there to Parquet, exactly once, and stops."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
