"""The order of landed pages, restored from their cursors.

Pages land in any order and under any name. A page names the cursor under which it was asked for (none: the
first page) and the cursor of the page that follows it (none: the last). That is a linked list; its ranks come
from pointer jumping: each page knows a page before it, how many pages lie between and how many items they
hold, and in every round takes over what that page knows. n pages need about log2(n) joins of page with page,
one row to one row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetmill.sources import feeds
from vetmill.sources.shared import kept


def _links(pages: DataFrame, feed: str) -> DataFrame:
    """page_no, own ('' for the first page), next, items, reason of the pages that cannot be linked.

    Pages that were landed again with the same cursors and items are kept once (`repeat`); different pages under
    one cursor (`fork`) and pages that name the same follower (`merge`) are not linked."""
    lists = F.coalesce(*[F.col(k) for k in dict.fromkeys([feed, "data", "items", "results"]) if k in pages.columns])
    links = kept(pages.select("page_no", F.coalesce("cursor", F.lit("")).alias("own"), F.nullif("next_cursor", F.lit("")).alias("next"),
                              F.coalesce(F.size(lists), F.lit(0)).cast("long").alias("items"), F.xxhash64(F.to_json(lists)).alias("content")), "links")
    same = Window.partitionBy("own", "next", "content").orderBy("page_no")
    links = links.withColumn("again", F.row_number().over(same) > 1)
    first = links.where("not again")
    forks = first.groupBy("own").agg(F.count("*").alias("n")).where("n > 1").select("own", F.lit("fork").alias("fork"))
    merges = first.where("next is not null").groupBy("next").agg(F.count("*").alias("n")).where("n > 1").select("next", F.lit("merge").alias("merge"))
    both = links.join(forks, "own", "left").join(merges, "next", "left")
    reason = F.when(F.col("again"), "repeat").otherwise(F.coalesce("fork", "merge"))
    return kept(both.select("page_no", "own", "next", "items", reason.alias("reason")), "links")


def order_pages(pages: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """page_no, page_rank (from 0) and first_pos (items on the pages before) of the pages that hang together from
    the first one on, and page_no and reason of all others.

    pages: page_no (unique), cursor, next_cursor and the lists of read_pages. Reasons: repeat, fork and merge, see
    _links; gap: the chain before the page is broken; loop: the chain never ends. An empty table gives two."""
    links = _links(pages, feed)
    good = links.where("reason is null")
    before = good.where("next is not null").select(F.col("next").alias("own"), F.col("own").alias("to"), F.col("items").alias("before"))
    state = good.select("page_no", "own").join(before, "own", "left").select(
        "page_no", "own", "to", F.when(F.col("to").isNull(), F.col("own")).alias("root"), F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("rank"),
        F.coalesce("before", F.lit(0)).alias("before"))
    state = kept(state, "ranks")
    for _ in range(math.ceil(math.log2(max(state.count(), 1))) + 1):
        if not state.where("to is not null").limit(1).count():
            break
        far = state.select(F.col("own").alias("to"), F.struct("to", "root", "rank", "before").alias("far"))
        both = state.join(far, "to", "left")
        state = kept(both.select("page_no", "own", F.col("far.to").alias("to"), F.coalesce("far.root", "root").alias("root"),
                                 (F.col("rank") + F.coalesce("far.rank", F.lit(0))).alias("rank"), (F.col("before") + F.coalesce("far.before", F.lit(0))).alias("before")), "ranks")
    whole = (F.col("to").isNull()) & (F.col("root") == "")
    ordered = state.where(whole).select("page_no", F.col("rank").alias("page_rank"), F.col("before").alias("first_pos"))
    lost = state.where(~whole).select("page_no", F.when(F.col("to").isNull(), "gap").otherwise("loop").alias("reason"))
    return ordered, links.where("reason is not null").select("page_no", "reason").unionByName(lost)


def flatten_in_order(pages: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """feed_pos (from 0, over all pages in the order of their cursors) and the items' fields, and the pages that
    order_pages rejects."""
    ordered, rejects = order_pages(pages, feed)
    items = feeds.flatten_pages(pages, feed).join(ordered, "page_no")
    return items.select((F.col("first_pos") + F.col("pos")).alias("feed_pos"), *[F.col(f"`{c}`") for c in items.columns if c not in ("page_no", "pos", "page_rank", "first_pos")]), rejects
