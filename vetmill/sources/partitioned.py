"""A table in partitions, into which changes are merged by rewriting only the partitions that they touch.

A merge has a name and two steps. First the new content of the touched partitions is staged beside the table, and a
note of it renamed into place. Then it is installed: partitions that lost all their rows are removed, the others
replaced by dynamic partition overwrite, and the note is renamed to `.done`. A job that dies is run again under the same
name: without a note it stages anew, with one it installs what was staged, so a row that was moved from one
partition to another is not lost between them; a finished name does nothing. One merge at a time is assumed, and
readers may see some partitions before and some after it while it is installed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetmill.sources.shared import kept


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, at = _fs(spark, old)
    if not fs.rename(at, _fs(spark, new)[1]):
        raise RuntimeError(f"{new} is there already")


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _names(spark: SparkSession, path: str, by: str) -> set[str]:
    """The folders of a table's partitions."""
    fs, at = _fs(spark, path)
    return {n for x in fs.listStatus(at) if (n := x.getPath().getName()).startswith(f"{by}=")} if fs.exists(at) else set()


def write(df: DataFrame, path: str, by: str) -> None:
    """A new table; rows of one partition are shared by several tasks if there are many."""
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table's rows; the types of all columns, the partitions' own too, come from the schema."""
    return spark.read.schema(schema).parquet(path)


def _stage(table: DataFrame, changes: DataFrame, key: str, by: str, order: str, insert: bool, staged: str) -> list[str]:
    """Write the new content of the touched partitions; the folders of those that have any now."""
    fields = [c for c in table.columns if c != key and c in changes.columns]
    newest = F.max_by(F.struct(*fields), F.struct(order, *[c for c in fields if c != order]))
    latest = kept(changes.where(F.col(key).isNotNull()).groupBy(key).agg(newest.alias("_new")), "changes")
    target = F.col("_new")[by] if by in fields else F.lit(None)
    rows = table.withColumn("_folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    hit = rows.select(key, F.col(by).alias("_was")).join(latest, key).select("_was", F.coalesce(target, "_was").alias("_is"))
    places = hit.select(F.explode(F.array("_was", "_is")).alias("_p"))
    added = latest.join(table.select(key), key, "left_anti") if insert else latest.limit(0)
    places = places.unionByName(added.select(target.cast(table.schema[by].dataType).alias("_p"))).distinct()
    places = [r[0] for r in places.collect()]  # partitions, no rows
    touched = F.col(by).isin([p for p in places if p is not None]) | (F.col(by).isNull() if None in places else F.lit(False))
    old = rows.where(touched)
    both = old.join(latest, key, "left").select(*[F.coalesce(F.col("_new")[c], F.col(c)).alias(c) if c in fields else F.col(c) for c in table.columns])
    fresh = added.select(*[F.col("_new")[c].alias(c) if c in fields else (F.col(c) if c == key else F.lit(None).cast(table.schema[c].dataType).alias(c)) for c in table.columns])
    write(both.unionByName(fresh), staged, by)
    return [r[0] for r in old.select("_folder").distinct().collect()]


def _install(spark: SparkSession, path: str, schema, by: str, staged: str, before: list[str]) -> None:
    now = _names(spark, staged, by)
    for name in sorted(set(before) - now):
        _delete(spark, f"{path}/{name}")
    if now:
        _overwrite(read(spark, staged, schema), path, by)


def _overwrite(df: DataFrame, path: str, by: str) -> None:
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge(changes: DataFrame, path: str, schema, key: str, by: str, name: str, order: str = "changed_at", insert: bool = False) -> bool:
    """Merge changes into a table partitioned by `by`, whose rows have unique keys. False if the name is finished.

    changes: key, order and some of the table's columns; the newest change of a key counts, and a null in it leaves a value
    as it is. A change may move a row to another partition. Keys that the table has not are added if insert, else left
    aside; changes without key are left aside. Partitions that no change touches are not written, and only their key and
    partition columns are read."""
    spark = changes.sparkSession
    log = f"{path}/_merges"
    if _exists(spark, f"{log}/{name}.done"):
        return False
    note = f"{log}/{name}.json"
    if not _exists(spark, note):
        staged = f"{log}/staged-{uuid.uuid4().hex}"
        before = _stage(read(spark, path, schema), changes, key, by, order, insert, staged)
        _note(spark, f"{log}/half-{uuid.uuid4().hex}", note, {"staged": staged, "before": before})
    held = json.loads(spark.read.text(note, wholetext=True).first()[0])
    _install(spark, path, schema, by, held["staged"], held["before"])
    _rename(spark, note, f"{log}/{name}.done")
    _delete(spark, held["staged"])
    return True


def _note(spark: SparkSession, half: str, note: str, content: dict) -> None:
    fs, at = _fs(spark, half)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    _rename(spark, half, note)
