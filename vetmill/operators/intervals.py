"""Many reminder queries at once where a patient may hold a large share of all rows: a binned interval join.

Reminders of equal content are counted and travel as one row; they are unfolded after the join. Those of a patient who has
more than `chunk` such rows are put into bins of days, which follow each other and hold about `chunk` rows; a bin of one
crowded day is dealt over parts. A query visits each part of the bins that its range touches, once. Where more than `chunk`
queries visit a bin, these are dealt too, and the bin's reminders meet each deal. Each pair so meets in one cell
(patient, bin, part, deal), and no cell has more than about 2 * chunk reminders of different content or `chunk` queries of
different ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetmill.functions.text import reminder_patient_id
from vetmill.operators.audit import asked
from vetmill.sources.shared import kept

CELL = ["_pid", "_bin", "_part", "_deal"]
#: Equal rows that are unfolded at a time.
RUN = 1000


def due_bins(rows: DataFrame, chunk: int) -> DataFrame:
    """_pid and _bins, for patients with more than `chunk` rows: each bin's first day (lo; '' for the first bin, which also
    holds rows without a day) and number of parts. At most 2 * rows / chunk bins in all.

    Rows are counted by day before anything is ordered, so that a window sees one row a day of a patient."""
    days = kept(rows.groupBy("_pid", "_day").agg(F.count("*").alias("n")), "days")
    hot = days.groupBy("_pid").agg(F.sum("n").alias("_all")).where(F.col("_all") > chunk).select("_pid")
    before = Window.partitionBy("_pid").orderBy(F.col("_day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.join(hot, "_pid", "left_semi").withColumn("_at", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / chunk))
    bins = days.groupBy("_pid", "_at").agg(F.min(F.coalesce("_day", F.lit(""))).alias("lo"), F.ceil(F.sum("n") / chunk).cast("int").alias("parts"))
    bins = bins.withColumn("lo", F.when(F.col("_at") == 0, "").otherwise(F.col("lo")))
    return bins.groupBy("_pid").agg(F.array_sort(F.collect_list(F.struct("lo", "parts"))).alias("_bins"))


def _bin(day: Column) -> Column:
    """The bin that a day falls into: the last that begins by then."""
    return F.size(F.filter("_bins", lambda b: b["lo"] <= day)) - 1


def cells(reminders: DataFrame, queries: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Reminders, each content once with its number (_n), and queries (as `asked` names their columns), each with the cells
    where they meet."""
    columns = reminders.columns
    once = kept(reminders.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("_n")), "once")
    rows = once.withColumn("_pid", reminder_patient_id(columns)).where("_pid is not null").withColumn("_day", F.substring("dueAt", 1, 10))
    hot = kept(due_bins(rows, chunk), "bins")
    none = F.col("_bins").isNull()

    q = queries.select("query_id", F.col("patient_id").alias("_pid"), F.col("status").alias("_status"), F.col("due_after").alias("_after"), F.col("due_before").alias("_before"))
    q = q.where("_pid is not null").join(hot, "_pid", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    q = q.withColumn("_from", F.when(none | blank("_after"), 0).otherwise(_bin(F.substring("_after", 1, 10))))
    q = q.withColumn("_to", F.when(none, 0).when(blank("_before"), F.size("_bins") - 1).otherwise(_bin(F.substring("_before", 1, 10)))).where("_from <= _to")
    # ranges are counted before they are unfolded
    busy = q.groupBy("_pid", "_from", "_to").agg(F.count("*").alias("n")).select("_pid", F.explode(F.sequence("_from", "_to")).alias("_bin"), "n")
    busy = busy.groupBy("_pid", "_bin").agg(F.ceil(F.sum("n") / chunk).cast("int").alias("_deals"))
    busy = kept(busy.where("_deals > 1"), "deals")
    parts = lambda b: F.when(none, 1).otherwise(F.get("_bins", b)["parts"])
    visits = F.transform(F.sequence("_from", "_to"), lambda b: F.transform(F.sequence(F.lit(0), parts(b) - 1), lambda p: F.struct(b.alias("_bin"), p.alias("_part"))))
    q = q.select("query_id", "_pid", "_status", "_after", "_before", F.explode(F.flatten(visits)).alias("_cell")).select("*", "_cell.*").join(busy, ["_pid", "_bin"], "left")
    q = q.withColumn("_deal", F.coalesce(F.pmod(F.xxhash64("query_id"), F.col("_deals")).cast("int"), F.lit(0)))

    rows = rows.join(hot, "_pid", "left").withColumn("_bin", F.when(none, 0).otherwise(_bin(F.coalesce("_day", F.lit("")))))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.get("_bins", F.col("_bin"))["parts"]).cast("int")
    rows = rows.withColumn("_part", F.when(none, 0).otherwise(part)).join(busy, ["_pid", "_bin"], "left")
    rows = rows.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.coalesce("_deals", F.lit(1)) - 1)))
    return rows.select(*CELL, *[f"`{c}`" for c in columns], "_n"), q.select("query_id", *CELL, "_status", "_after", "_before")


def filter_reminders_binned(reminders: DataFrame, queries: DataFrame, chunk: int = 100_000) -> DataFrame:
    """audit.filter_reminders_bulk, the same rows, for patients with any number of reminders and queries.

    Reminders without a patient and queries without one meet nothing; a reminder without a due time meets queries
    without bounds; equal rows are kept, each of them; a range that ends before it begins is empty."""
    rows, q = cells(reminders, queries, chunk)
    q = q.withColumnsRenamed({c: f"{c}_q" for c in CELL})
    meet = asked()
    for c in CELL:
        meet = (F.col(c) == F.col(f"{c}_q")) & meet
    columns = ["query_id", *[f"`{c}`" for c in reminders.columns]]
    met = rows.join(q, meet).select(*columns, "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / RUN))).alias("_run"))
    again = F.array_repeat(F.lit(0), F.least(F.lit(RUN), F.col("_n") - F.col("_run") * RUN).cast("int"))
    return met.select(*columns, F.explode(again).alias("_again")).select(*columns)
