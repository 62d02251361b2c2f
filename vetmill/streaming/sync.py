"""Feed sync as a stream over landed files, with an idempotent Parquet sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vetmill.operators.sync import export_records, with_hashes


def write_new(batch: DataFrame, sink: str) -> None:
    """Append the records whose idempotency key the sink does not have: a batch that is run again adds nothing, and a key
    whose content has changed keeps its first record. Within a batch that is the one with the least content hash."""
    spark = batch.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(sink)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = batch.groupBy("idempotency_key").agg(F.min_by(F.struct(*batch.columns), "source_hash").alias("row")).select("row.*")
    if fs.exists(at) and fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/*.parquet")):
        done = spark.read.parquet(sink).select("idempotency_key")
        rows = rows.join(done, "idempotency_key", "left_anti").select(*batch.columns)
    rows.write.mode("append").parquet(sink)


def sync_stream(stream: DataFrame, normalize: Callable[[DataFrame], DataFrame], feed: str, sink: str, checkpoint: str,
                watermark_in: str | None = None) -> StreamingQuery:
    """Export what a stream of landed rows brings and stop: normalize, hash, export.

    No state is kept and no row is too late: repeats of a key, however far apart, are dropped by the
    sink's keys. keyed.sync_keyed does the same without reading the sink."""
    rows = with_hashes(normalize(stream), feed)
    out = export_records(rows, feed, watermark_in).withColumn("source_hash", F.col("payload.source_hash"))
    return (out.writeStream.foreachBatch(lambda batch, _: write_new(batch, sink))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the Parquet files that land in a folder."""
    return spark.readStream.schema(schema).parquet(path)
