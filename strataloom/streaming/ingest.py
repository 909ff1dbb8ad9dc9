"""Incremental ingestion with Structured Streaming.

The batch plans have no streaming semantics of their own; this runs their
row-wise part over files as they arrive and keeps the first document of each
checksum as state, with a watermark that bounds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.medallion import Config, cleaned


def silver_stream(spark: SparkSession, folder: str, schema: str, config: Config = Config(), late: str = "1 day") -> DataFrame:
    """Documents of Parquet files in ``folder`` (bronze columns and ``arrived``), cleaned, gated and distinct within ``late``."""
    raw = spark.readStream.schema(schema).parquet(folder).withWatermark("arrived", late)
    good = cleaned(raw, config, written=False).filter("not low_quality").withColumn("checksum_sha256", F.sha2("markdown", 256))
    return good.dropDuplicatesWithinWatermark(["checksum_sha256"])


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process what there is, then stop; a rerun takes up new files only."""
    q = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    q.awaitTermination()
