"""The feed sync as a stream that remembers what it has exported, in the stream's own state.

State is kept by idempotency key: a batch reads and writes the state of its own keys, never the sink. Rows are late to
nothing: no watermark drops them, and a key may be forgotten only when it was not seen for `keep` milliseconds of
processing time. Each batch is one commit of the log (see commits), named by stream and batch, so a batch that is
run again after a failure is written once.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from vetmill.operators.sync import export_records, with_hashes
from vetmill.streaming import commits


def first_of_each_key(records: DataFrame, keep: int | None = None) -> DataFrame:
    """Of the records of an idempotency key, in this batch and all before, the first: within a batch the least by
    content hash. Columns stay. keep: milliseconds after which an unseen key may come again; None: never.

    Without `keep`, records stay in the JVM: a batch is dealt by key, each part is sorted by (key, hash), and of each key the
    first that the state does not know goes through; the state holds keys alone. Spark's check of streaming plans knows
    no sort before a deduplication, so whoever starts such a stream does it under `_sorted_streams`.

    With `keep`, records go through Python as JSON texts, a group for each key, for only there has a key a timer; only the
    first is kept in memory, so a key may repeat any number of times."""
    if keep is None:
        ordered = records.repartition("idempotency_key").sortWithinPartitions("idempotency_key", "payload.source_hash")
        return ordered.dropDuplicates(["idempotency_key"])
    names = records.columns
    packed = records.select("idempotency_key", F.col("payload.source_hash").alias("source_hash"), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("record"))

    def one(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for frame in frames:
            if len(frame):
                i = frame["source_hash"].idxmin()
                row = frame.loc[i, "source_hash"], frame.loc[i, "record"]
                best = row if best is None else min(best, row)
        known = state.exists
        if not known and best is not None:
            state.update((best[0],))
        state.setTimeoutDuration(keep)
        if not known and best is not None:
            import pandas as pd

            yield pd.DataFrame({"record": [best[1]]})

    new = packed.groupBy("idempotency_key").applyInPandasWithState(one, "record string", "source_hash string", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return new.select(F.from_json("record", records.schema).alias("r")).select("r.*")


@contextmanager
def _sorted_streams(spark: SparkSession):
    """A stream that is started meanwhile may sort within its batches; it takes its settings along when it starts."""
    name = "spark.sql.streaming.unsupportedOperationCheck"
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def sync_keyed(stream: DataFrame, normalize: Callable[[DataFrame], DataFrame], feed: str, sink: str, checkpoint: str, watermark_in: str | None = None,
               keep: int | None = None) -> StreamingQuery:
    """Export what a stream of landed rows brings and stop: one record for each idempotency key, whole batches only.

    Read the sink by commits.read. A key whose content changes under the same watermark keeps its first record, as a
    receiver that goes by the key would; a new watermark gives new keys."""
    records = first_of_each_key(export_records(with_hashes(normalize(stream), feed), feed, watermark_in), keep)

    def write(batch: DataFrame, number: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        commits.append(batch, sink, f"{stream_id}-{number:012d}", feed)

    with _sorted_streams(stream.sparkSession):
        return records.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
