"""Landed API pages, sheet extracts, CSV lists and JSON exports; keyset pages and time filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetmill.functions.text import fold_key, norm_text

FEEDS = ("accounts", "appointments", "patients", "reminders")

DETAIL = "struct<type:string,kind:string,value:string,number:string,phoneNumber:string,email:string>"
CONTACT = f"struct<nameFirst:string,nameMiddle:string,nameLast:string,communicationDetails:array<{DETAIL}>>"
#: Item schemas of the feeds; ids that come as text or number are read as text.
SCHEMAS = {
    "accounts": f"id string, pimsCode string, pimsId string, primaryContact {CONTACT}, updatedAt string, deletedAt string",
    "patients": f"id string, name string, accountId string, pimsCode string, account struct<primaryContact:{CONTACT}>",
    "reminders": "id string, patientId string, patient_id string, patient struct<id:string>, ownerId string, productId string, "
                 "reminderLabelId string, dueAt string, givenAt string, sentAt string, deactivatedAt string",
    "appointments": "id string, appointmentTypeId string, patientId string, startsAt string, updatedAt string, canceledAt string, "
                    "status string, isConfirmed boolean",
}


def read_pages(spark: SparkSession, path: str, feed: str, item: str | None = None) -> DataFrame:
    """Pages as landed, one file each: page_no (by file name), the arrays that a page may hold, cursor, under which the
    page was asked for, and next_cursor, of the page that follows (cursors.order_pages restores the order from these).

    A page is a list, or an object with lists; a value of another shape under a key reads as null. The cursors are
    pageCursor or metadata.before, and metadata.after or nextPageCursor; a list has none."""
    item = item or SCHEMAS[feed]
    keys = list(dict.fromkeys([feed, "data", "items", "results"]))
    shape = ", ".join(f"{k} array<struct<{_struct(item)}>>" for k in keys)
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    as_list = F.from_json("value", f"array<struct<{_struct(item)}>>")
    as_page = F.from_json("value", f"{shape}, metadata struct<after:string,before:string>, pageCursor string, nextPageCursor string")
    pages = raw.select("file", F.when(F.ltrim("value").startswith("["), as_list).alias("_list"),
                       F.when(~F.ltrim("value").startswith("["), as_page).alias("_page"))
    cursors = [F.coalesce("_page.pageCursor", "_page.metadata.before").alias("cursor"), F.coalesce("_page.metadata.after", "_page.nextPageCursor").alias("next_cursor")]
    return pages.select(F.col("file").alias("page_no"), *[F.coalesce("_list", F.col("_page")[k]).alias(k) if k == keys[0] else F.col("_page")[k].alias(k) for k in keys], *cursors)


def _struct(ddl: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).simpleString()[len("struct<"):-1]


def flatten_pages(pages: DataFrame, feed: str) -> DataFrame:
    """page_no, pos and the items' fields: the first list among feed, data, items, results; an empty
    list still counts as first."""
    lists = [F.col(k) for k in dict.fromkeys([feed, "data", "items", "results"]) if k in pages.columns]
    if not lists:
        raise ValueError(f"pages have none of the columns {feed}, data, items, results")
    # outer, as the planner else filters pages by the size of their lists first, for which it parses each page again
    items = pages.select("page_no", F.posexplode_outer(F.coalesce(*lists)).alias("pos", "item")).where("pos is not null")
    return items.select("page_no", "pos", "item.*")


def hydrate(listed: DataFrame, detail: DataFrame, id_col: str = "id") -> DataFrame:
    """Listed rows with the detail record's values where there is one; rows without id are kept."""
    extra = [c for c in detail.columns if c not in listed.columns]
    other = detail.select(F.col(id_col).alias("_id"), F.struct(*detail.columns).alias("_detail"))
    both = listed.join(other, F.col(id_col) == F.col("_id"), "left")
    shared = [F.when(F.col("_detail").isNotNull(), F.col("_detail")[c]).otherwise(F.col(c)).alias(c) if c in detail.columns else F.col(c) for c in listed.columns]
    return both.select(*shared, *[F.col("_detail")[c].alias(c) for c in extra])


def lookup(feed: DataFrame, keys: DataFrame, id_col: str = "id") -> DataFrame:
    """The feed's rows whose internal id is among the keys' (many single-record fetches at once)."""
    return feed.join(keys.select(id_col).distinct(), id_col, "left_semi")


def lookup_by(feed: DataFrame, asked: DataFrame, fields: dict[str, str], folded: tuple[str, ...] = ()) -> DataFrame:
    """kind, value and the feed's rows that are asked for by keys of several kinds (pimsCode, pimsId, accountId, name) at once.

    asked: kind, value; fields: each kind's column or SQL expression over the feed; kinds in `folded` are compared
    without case. A row comes once for each of its keys that is asked for; blank keys meet nothing."""
    ask = asked.select("kind", F.when(F.col("kind").isin(*folded), fold_key("value")).otherwise(norm_text("value")).alias("value")).where("value <> ''").distinct()
    own = [F.struct(F.lit(k).alias("kind"), (fold_key if k in folded else norm_text)(F.expr(e)).alias("value")) for k, e in fields.items()]
    rows = feed.select(F.explode(F.array(*own)).alias("_key"), F.struct("*").alias("_row")).where("_key.value <> ''")
    return rows.select("_key.*", "_row").join(ask, ["kind", "value"], "left_semi").select("kind", "value", "_row.*")


def page_after(df: DataFrame, key: str, cursor=None, limit: int = 100) -> DataFrame:
    """The next 1 to 100 rows after a key, in its order."""
    rows = df if cursor is None else df.where(F.col(key) > F.lit(cursor))
    return rows.orderBy(key).limit(min(max(limit, 1), 100))


def page_before(df: DataFrame, key: str, cursor=None, limit: int = 100) -> DataFrame:
    """The 1 to 100 rows before a key, in its order."""
    rows = df if cursor is None else df.where(F.col(key) < F.lit(cursor))
    return rows.orderBy(F.desc(key)).limit(min(max(limit, 1), 100)).orderBy(key)


def filter_time_range(df: DataFrame, column: str, since=None, before=None) -> DataFrame:
    """Rows from `since` on and before `before`; the bounds reach the scan."""
    if since is not None:
        df = df.where(F.col(column) >= F.lit(since))
    return df if before is None else df.where(F.col(column) < F.lit(before))


def updated_since(df: DataFrame, watermark: str | None, column: str = "updated_at") -> DataFrame:
    return df if not watermark else df.where(F.col(column) >= F.lit(watermark))


def exclude_deleted(df: DataFrame, column: str = "deletedAt", include: bool = False) -> DataFrame:
    return df if include else df.where(F.col(column).isNull())


#: Columns of a grouped reminder sheet, by place; what lies to their right is not read.
SHEET = ("client", "client_name", "phone_no", "patient_name", "species", "breed", "code", "item_due", "due_date")
_PLACE = ("file", "sheet", "row_number")


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A grouped reminder sheet from an extract (fmt: parquet or csv, with a header) that carries file, sheet
    and row_number; rows from 2 on, the first nine further columns as text under the names of SHEET and, if
    the extract has it, due_date_typed. An empty cell of a CSV is null."""
    rows = spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path)
    own = [c for c in rows.columns if c not in (*_PLACE, "due_date_typed")][: len(SHEET)]
    if len(own) < len(SHEET):
        raise ValueError(f"the extract has {len(own)} of {len(SHEET)} columns")
    typed = [c for c in rows.columns if c == "due_date_typed"]
    rows = rows.select("file", "sheet", F.col("row_number").cast("bigint").alias("row_number"),
                       *[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(own, SHEET, strict=True)], *typed).where("row_number >= 2")
    return rows if sheet is None else rows.where(F.col("sheet") == sheet)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV list with a header, all text; a byte-order mark is taken off."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    if not df.columns:
        raise ValueError("the CSV has no header row")
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON with nulls written; by: one folder for each value of a column."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV list with a header; white space and quotes ("" inside) come back as they were, empty texts as null."""
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def has(column: Column) -> Column:
    return column.isNotNull() & (column != "")
