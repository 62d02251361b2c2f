"""What several text operators share: the shared folder, hash folds and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Byte table that lower-cases A-Z only.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset on one
    machine (tests) a temporary folder that then becomes the checkpoint folder. A cluster must name it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="vetmill-shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame as Parquet into the shared folder and read it back: the lineage ends
    there, and a lost executor costs a reread of files rather than a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


#: Slots of the bitmap that thins rows before a join: 2^26 bits, 8 MB whatever the data.
SLOTS = 1 << 26


def parted(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of df whose key may be among the ids, and rows whose key is not, by a bitmap of the ids'
    hashes that goes to df's rows by broadcast: neither is shuffled.

    The bitmap has SLOTS bits in rows of 4 KB: that bounds the broadcast. The more ids share it, the
    more other rows are among the first."""
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1
    maps = ids.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2.0), at % 8)) % 2 == 1
    near, far = (df.join(F.broadcast(maps), (F.bitmap_bucket_number(slot) == F.col("_bucket")) & bit, how) for how in ("left_semi", "left_anti"))
    return near, far


def having(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of df whose key is among the ids (a column of that name): a left semi join, before which
    most other rows are taken out (parted), so that their texts need not be shuffled."""
    ids = ids.select(key).distinct()
    return parted(df, ids, key)[0].join(ids, key, "left_semi")


#: Keys that may go to the other side by broadcast, and the least number of rows that makes one of them.
HOT_KEYS, HOT_ROWS = 1000, 1000


def hot_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", least: int = HOT_ROWS) -> DataFrame:
    """Inner or left join of left with right, which has one row for each key and in n the number of left's rows
    with it.

    The HOT_KEYS most frequent keys, of those with `least` rows, go to left's rows by broadcast, so that
    only keys with less than 1 / HOT_KEYS of all rows are shuffled: no key fills a task."""
    hot = right.where(F.col("n") >= least).orderBy(F.desc("n"), key).limit(HOT_KEYS)
    # both sides take the same columns of it, so that it is computed and sent once
    hot = F.broadcast(hot.select(key, F.struct(*[c for c in right.columns if c != key]).alias("_hot")))
    dealt = left.join(hot, key, "left")
    cold = dealt.where("_hot is null").select(*left.columns).join(right, key, how)
    return left.join(hot, key).select(*left.columns, "_hot.*").unionByName(cold)


def arrow_schema(ddl: str):
    """The Arrow schema of a DDL string, for functions of mapInArrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def batch(rows: list[tuple], schema):
    """An Arrow batch of rows; ids stay whole numbers and nulls stay nulls."""
    import pyarrow as pa

    columns = [*zip(*rows, strict=True)] if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _stars(pairs: DataFrame) -> bool:
    """Whether every u of the distinct pairs (u, v), u > v, has one v and is no v itself."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("centre")),
                                          F.struct(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("centre")))).alias("e")).select("e.*")
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("centre").alias("centre")).where("up > 1 or up = 1 and centre = 1").isEmpty()


def stars(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v, that form stars around the least id v of each component: large-star / small-star rounds.

    pairs: a stored table of distinct pairs (u, v), u > v, that come back as they are if they form such stars.
    Each round only joins ids with neighbours' minima, so its cost follows the number of edges; the rounds end
    when all edges form stars around their least ids, which edges that come as such stars do without any round
    (one row at most reaches the driver). A star's centre is met through an aggregated minimum, never as a
    collected group, and its edges stay where they are (lowest).
    """
    def lowest(pairs: DataFrame, low) -> DataFrame:
        """u, v with m, the least id of u's neighbourhood: as hot_join has it, but both sides take the same two
        columns, never null, of the hot ids, so that these are computed and sent once in each plan."""
        least = pairs.groupBy("u").agg(low.alias("m"), F.count("*").alias("n"))
        hot = least.where(F.col("n") >= HOT_ROWS).orderBy(F.desc("n"), "u").limit(HOT_KEYS).select("u", "m")
        dealt = pairs.join(F.broadcast(hot.where("u is not null and m is not null")), "u", "left")
        cold = dealt.where("m is null").select("u", "v").join(least.select("u", "m"), "u")
        return dealt.where("m is not null").unionByName(cold)

    while not _stars(pairs):
        # large star: every larger neighbour of u hangs itself to the smallest in u's neighbourhood; a pair that
        # comes of several u repeats until the small star, and there are no more rows than pairs
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = lowest(both, F.least(F.min("v"), F.first("u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = table(large.where("u <> v"), "large_star")
        # small star: u and its smaller neighbours hang to the smallest of them; u by its own pair with it
        small = lowest(large, F.min("v")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = table(small.distinct(), "small_star")
    return pairs


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable for each id that has an edge (stars).

    edges: columns src, dst (long, in any direction, repeats allowed). Returns id, component_id."""
    pairs = stars(table(edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges"))
    member = pairs.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return member.unionByName(roots)
