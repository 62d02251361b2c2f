"""Feed sync in batches: watermark, hashes, conflict status, export records, state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vetmill.functions.hashing import row_hash, stable_hash
from vetmill.operators.normalize import SOURCE
from vetmill.sources.feeds import updated_since as since

STATE = "feed string, watermark string"
IDS = {"accounts": "account_id", "appointments": "appointment_id"}


def load_state(spark: SparkSession, path: str) -> dict[str, str | None]:
    """Saved watermarks by feed (a row each); a table that is not there is an empty state."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(conf).exists(at):
        return {}
    return {r.feed: r.watermark for r in spark.read.schema(STATE).json(path).collect()}


def save_state(spark: SparkSession, path: str, state: dict[str, str | None]) -> None:
    """Written after the sink has taken the rows, changed or not."""
    spark.createDataFrame(sorted(state.items()), STATE).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def watermark(feed: str, state: dict[str, str | None], updated_since: str | None = None) -> str | None:
    return updated_since or state.get(feed)


def with_hashes(rows: DataFrame, feed: str) -> DataFrame:
    """source_hash over all columns there are, then conflict_status.

    An appointment's type is part of the hash where the appointment has a type id, known or not."""
    hashed = row_hash(rows, rows.columns)
    if "appointment_type" in rows.columns:
        plain = row_hash(rows, [c for c in rows.columns if c != "appointment_type"])
        hashed = F.when(F.col("appointment_type_id").isNull(), plain).otherwise(hashed)
    rows = rows.withColumn("source_hash", hashed)
    status = F.when(F.col("is_canceled"), "needs_review").otherwise("clear") if feed == "appointments" else F.lit("clear")
    return rows.withColumn("conflict_status", status)


def idempotency_key(feed: str, source_id: Column, watermark_in: str | None) -> Column:
    """Depends on the feed, the id and the watermark alone: a replay gives the same key."""
    text = StringType()
    return stable_hash({"source_type": (F.lit(feed), text), "source_id": (source_id, text), "watermark_in": (F.lit(watermark_in).cast("string"), text)})


def export_records(rows: DataFrame, feed: str, watermark_in: str | None, source_system: str = SOURCE) -> DataFrame:
    """Hashed rows as export records; the payload is the row, an account's without conflict status."""
    key = F.col(IDS[feed])
    payload = [c for c in rows.columns if feed == "appointments" or c != "conflict_status"]
    return rows.select(
        F.lit(source_system).alias("source_system"), key.alias("source_id"), F.lit(feed.removesuffix("s")).alias("source_type"),
        idempotency_key(feed, key, watermark_in).alias("idempotency_key"), "conflict_status", F.struct(*payload).alias("payload"))


def latest_per_id(rows: DataFrame, key: str) -> DataFrame:
    """The last version of each id in a feed that was read again: by updated_at, then hash.

    An aggregate with a partial step, so that an id read a million times stays small."""
    return rows.groupBy(key).agg(F.max(F.struct(F.col("updated_at"), F.col("source_hash"), F.struct(*rows.columns).alias("row")))["row"].alias("row")).select("row.*")


def first_records(rows: DataFrame, order: list[str], most: int | None) -> DataFrame:
    """The first rows in feed order, at least one; None: all. A top-n, not a full sort."""
    return rows if most is None else rows.orderBy(*order).limit(max(most, 1))


def sync_batch(rows: DataFrame, feed: str, state: dict[str, str | None], updated_since: str | None = None, max_records: int | None = None,
               advance: bool = False, order: list[str] | None = None) -> tuple[DataFrame, dict[str, str | None]]:
    """Export records of a normalized feed and the state after it.

    By default the watermark stays as it came in. advance moves it to the last exported change; rows
    are then cut in the order of change, so that none is skipped for good."""
    mark = watermark(feed, state, updated_since)
    rows = since(rows, mark)
    rows = first_records(rows, ["updated_at", IDS[feed]] if advance else order or [IDS[feed]], max_records)
    out = mark
    if advance:
        newest = rows.agg(F.max("updated_at")).first()[0]
        out = max(filter(None, (mark, newest)), default=None)
    return export_records(with_hashes(rows, feed), feed, mark), {**state, feed: out}


def feed_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("source_type").agg(F.count("*").alias("record_count"))


def first_per_feed(records: DataFrame, most: int, order: str = "source_id") -> DataFrame:
    """The first records of each feed of a bundle (a rank limit, applied before the shuffle too)."""
    w = Window.partitionBy("source_type").orderBy(order)
    return records.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max(most, 1)).drop("_n")
