"""A sink whose batches appear whole or not at all, with the watermark they carry.

A batch is written into a folder of its own, which nobody reads; then a manifest that names the folder, its feed,
rows and watermark is renamed into the log. The rename is the commit. What the sink holds, and how far each feed has
come, is what the manifests say: a job that dies at any point leaves either no trace for readers or the whole batch
and its watermark, and when it runs again under the same name, it writes what is missing or nothing.
One writer a name is assumed; different names may be written at the same time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetmill.operators.sync import sync_batch

MANIFEST = "name string, feed string, data string, n_rows long, watermark string"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _write_data(batch: DataFrame, path: str) -> None:
    batch.write.parquet(path)


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, at = _fs(spark, old)
    if not fs.rename(at, _fs(spark, new)[1]):
        raise RuntimeError(f"{new} was committed by another writer")


def committed(spark: SparkSession, sink: str, name: str) -> bool:
    fs, at = _fs(spark, f"{sink}/log/{name}.json")
    return fs.exists(at)


def append(batch: DataFrame, sink: str, name: str, feed: str = "", watermark: str | None = None) -> bool:
    """Commit a batch under a name, once: False if that name has been committed before (nothing is written).

    An empty batch is committed too, for its watermark. Without watermark the batch does not move the feed's."""
    spark = batch.sparkSession
    if committed(spark, sink, name):
        return False
    data = f"data/{name}-{uuid.uuid4().hex}"
    _write_data(batch, f"{sink}/{data}")
    n = spark.read.schema(batch.schema).parquet(f"{sink}/{data}").count()
    fs, log = _fs(spark, f"{sink}/log")
    fs.mkdirs(log)
    half = f"{sink}/.half-{uuid.uuid4().hex}"
    _write_manifest(spark, half, {"name": name, "feed": feed, "data": data, "n_rows": n, "watermark": watermark})
    _rename(spark, half, f"{sink}/log/{name}.json")
    return True


def manifests(spark: SparkSession, sink: str) -> DataFrame:
    """The log: a row for each commit; no rows where nothing was committed."""
    fs, log = _fs(spark, f"{sink}/log")
    if not fs.exists(log):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{sink}/log")


def read(spark: SparkSession, sink: str, schema) -> DataFrame:
    """The rows of all committed batches: a folder each, by the log."""
    folders = [f"{sink}/{r.data}" for r in manifests(spark, sink).where("n_rows > 0").select("data").collect()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def state(spark: SparkSession, sink: str) -> dict[str, str | None]:
    """How far each feed has come: the newest watermark of its commits. The data is not read."""
    newest = manifests(spark, sink).groupBy("feed").agg(F.max("watermark").alias("watermark"))
    return {r.feed: r.watermark for r in newest.collect()}


def sync_committed(rows: DataFrame, feed: str, sink: str, name: str, updated_since: str | None = None, max_records: int | None = None) -> bool:
    """Export a normalized feed from the committed watermark on, and commit records and new watermark together.

    name: of the run; a run that failed is repeated under its name. False if it had been committed."""
    spark = rows.sparkSession
    if committed(spark, sink, name):
        return False
    records, after = sync_batch(rows, feed, state(spark, sink), updated_since, max_records, advance=True)
    return append(records, sink, name, feed, after[feed])
