"""Documents to packed training sequences: toxicity, near duplicates, personal data, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's docs. Every stage takes texts of any length,
empty tables (which stay empty) and any further columns, whatever their names; all but the last
return the columns that came in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetmill import share_path
from vetmill.llm import minhash, pii, queries, toxicity
from vetmill.llm.common import fold, having, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labelled ones outside the held-out fold,
    predicts to be toxic go, each of repeated rows alike; texts that are null or empty stay."""
    share_path(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 5) == 0)
    return docs.where(toxicity.toxicity(F.col("text"), model)["predicted"] == 0)


#: Ids for texts that share a doc_id with another text start here.
OWN_IDS = 1 << 62


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays, once; every row
    without a doc_id stays.

    Texts that share a doc_id but are no near duplicates stay apart: all but one of them are compared
    under an id made from the text. Of rows that repeat doc_id and text one stays."""
    share_path(spark)
    rows = docs.where("doc_id is not null").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                                   F.col("doc_id").cast("long").alias("doc_id"), "text")
    print_ = F.xxhash64(F.coalesce("text", F.lit("")))
    again = table(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    least = table(having(rows, again).groupBy("doc_id").agg(F.min(print_).alias("least")), "least")
    own = F.when(F.col("least").isNull() | (print_ == F.col("least")), F.col("doc_id")).otherwise(
        print_.bitwiseAND(F.lit(OWN_IDS - 1)).bitwiseOR(F.lit(OWN_IDS)))
    rows = rows.join(least, "doc_id", "left").select("row", own.alias("doc_id"), "text", F.when(F.col("least").isNotNull(), F.to_json("row")).alias("order"))
    kept = minhash.near_duplicates(rows.select("doc_id", "text")).where("kept").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy("order")
    rows = rows.join(kept, "doc_id", "left_semi").withColumn("first", F.row_number().over(first)).where("first = 1")
    return rows.select("row.*").unionByName(docs.where("doc_id is null"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, repeated rows as often as they came; personal data in its text is replaced
    by its kind, null stays null."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of tokens; each of repeated rows has
    pieces of its own, a null or empty text one piece, its end; further columns are left aside."""
    share_path(spark)
    return queries.packed(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_copies), ("personal_data", redact_pii), ("packing", pack)]
#: The tokenizer and the learned grammar are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
