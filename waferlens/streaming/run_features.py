"""Run-data statistics as a stream: an extension of the batch features.

Samples arrive as files; windows close when the watermark passes them, so
state is bounded by the delay that late samples are granted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_samples(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_features(samples: DataFrame, keys: list[str], time: str = "ts", value: str = "value", window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Count, mean, extremes and spread per window and keys."""
    v = F.col(value)
    rows = samples.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), *keys)
    return rows.agg(F.count(v).alias("N"), F.avg(v).alias("AVERAGE"), F.min(v).alias("MIN_VAL"), F.max(v).alias("MAX_VAL"), F.stddev_pop(v).alias("STD_VAL")).select(F.col("w.start").alias("START_TIME"), *keys, "N", "AVERAGE", "MIN_VAL", "MAX_VAL", "STD_VAL")


def write_features(features: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows; runs until what is there is done."""
    return features.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
