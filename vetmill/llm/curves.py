"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, shifted, and ordered along a Hilbert curve, several
times with other projections and shifts. Spark ranges each ordering into blocks of neighbouring
keys; a query is compared with the blocks around its own on every curve (a segment of blocks at a time), the candidates are merged and ranked
by the inner product in double precision. The width of the window is measured: for a
sample of queries, the true neighbours are found by comparison with every row, and the window must
reach the share RECALL of them.

For the largest inner product, candidates get one more component that makes their norms equal, and
queries a zero there; for vectors of one length this changes nothing. Of equal vectors only rows of the
smallest TOP + 1 ids, TOP of each, can be results, so no more of them are candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetmill.llm import common, vectors

TOP, EVERY = 20, 20
CURVES, DIMS, BITS = 3, 6, 10
#: Rows of a block; blocks of a segment; queries compared with a segment in one task.
BLOCK, SEGMENT, CHUNK = 2048, 16, 512
#: Bounded samples: rows for block borders, queries for the window.
BORDER_ROWS, PROBES = 40_000, 128
RECALL = 0.97


def hilbert(x):
    """Index along the Hilbert curve for rows of DIMS coordinates of BITS bits each."""
    import numpy as np

    x = x.astype(np.int64).T.copy()
    q = 1 << (BITS - 1)
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (BITS - 1)
    while q > 1:
        t = np.where(x[-1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for i in range(len(x)):
            out = out << 1 | x[i] >> bit & 1
    return out


class Curves:
    """Projections and shifts; keys of candidates and of queries on each curve."""

    def __init__(self, size: int, longest: float, spread: float):
        import numpy as np

        rng = np.random.default_rng(11)
        self.longest, self.spread = longest, spread
        self.maps = [np.linalg.qr(rng.normal(size=(size + 1, min(DIMS, size + 1))))[0] for _ in range(CURVES)]
        self.shifts = rng.random((CURVES, DIMS))

    def keys(self, x, query: bool):
        import numpy as np

        norm = np.sqrt((x**2).sum(1))
        if query:
            x = np.c_[x * (self.longest / norm)[:, None], np.zeros(len(x))]
        else:
            x = np.c_[x, np.sqrt(np.maximum(self.longest**2 - norm**2, 0))]
        out = []
        for m, shift in zip(self.maps, self.shifts, strict=True):
            y = np.zeros((len(x), DIMS))
            y[:, : m.shape[1]] = x @ m
            grid = (y / self.spread / 4 + 0.5 + (shift - 0.5) / 4) * 2**BITS
            out.append(hilbert(np.clip(grid, 0, 2**BITS - 1)))
        return np.stack(out, 1)


def nearest(table: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id and score: for each usable row whose vec_id is divisible by `every`,
    its `top` nearest other rows found, ties to the smaller vec_id.

    Rows that repeat a vec_id are candidates and queries of their own; a query leaves out all rows
    with its id. Queries without any candidate have no rows, nor has an empty table; columns other than
    vec_id and embedding are left aside."""
    import numpy as np

    rows = vectors.keyed(table).where("usable").drop("usable")
    size = vectors.usual_size(rows)
    rows = rows.where(F.size("embedding") == size)
    # equal rows are one with a number; k numbers a candidate's copies, and counts a query's
    rows = common.table(rows.groupBy("vec_id", "h1", "h2").agg(F.first("embedding").alias("embedding"), F.count("*").alias("n")), "vectors")
    few = Window.partitionBy("h1", "h2").orderBy("vec_id")
    pool = rows.withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= top + 1)
    pool = common.table(pool.select("vec_id", "h1", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(top)))).alias("k"), "embedding"), "candidates")
    ask = rows.where(F.col("vec_id") % every == 0).select("vec_id", "h1", F.col("n").alias("k"), "embedding")
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    total, longest = pool.agg(F.count("*"), F.max(F.sqrt(squares))).first()
    empty = pool.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    curves = Curves(size, float(longest), float(longest) / max(size, 1) ** 0.5)

    # borders of the blocks on each curve, over (key, hash) so that equal keys can be parted
    part = vectors.sample(pool, total, BORDER_ROWS, "vec_id").select("vec_id", "embedding").orderBy("vec_id").toArrow()
    keys = curves.keys(vectors.matrix(part["embedding"].combine_chunks()), False)
    n_blocks = max(1, min(-(-total // BLOCK), BORDER_ROWS // 4))  # the borders are broadcast: this bounds them
    borders = [np.sort(_fine(keys[:, c], part["vec_id"].to_numpy()))[(np.arange(1, n_blocks) * len(keys)) // n_blocks] for c in range(CURVES)]
    held = pool.sparkSession.sparkContext.broadcast((curves, borders))

    def place(query: bool):
        def run(batches):
            import pyarrow as pa

            curves, borders = held.value
            for b in batches:
                if not b.num_rows:
                    continue
                k, ids = curves.keys(vectors.matrix(b["embedding"]), query), b["vec_id"].to_numpy()
                at = np.stack([np.searchsorted(borders[c], _fine(k[:, c], ids), side="right") for c in range(CURVES)], 1)
                yield pa.RecordBatch.from_arrays([*(b[c] for c in own), pa.array(list(at.astype(np.int32)), pa.list_(pa.int32()))], names=[*own, "blocks"])

        return run

    own = ["vec_id", "h1", "k", "embedding"]
    ddl = "vec_id long, h1 long, k long, embedding array<double>, blocks array<int>"
    pool = common.table(pool.mapInArrow(place(False), ddl), "ranged")
    ask = common.table(ask.mapInArrow(place(True), ddl), "queries")
    n_ask = ask.count()
    if not n_ask:
        return empty
    width = _window(pool, vectors.sample(ask, n_ask, PROBES, "vec_id").orderBy("vec_id").limit(PROBES).toArrow(), top, n_blocks)

    zipped = F.posexplode("blocks")
    segment = lambda c: F.floor(c / SEGMENT).cast("int")
    cand = pool.select(*own, zipped.alias("curve", "block")).withColumn("segment", segment(F.col("block")))
    asked = ask.select(*own, zipped.alias("curve", "block"))
    around = F.sequence(segment(F.greatest(F.col("block") - width, F.lit(0))), segment(F.least(F.col("block") + width, F.lit(n_blocks - 1))))
    asked = asked.select(*own, "curve", "block", F.explode(around).alias("segment"))
    # blocks follow a sample: both sides are dealt into chunks that no segment can outgrow
    cand_n = cand.groupBy("curve", "segment").agg(F.ceil(F.count("*") / (2 * BLOCK * SEGMENT)).cast("int").alias("cn"))
    asked_n = asked.groupBy("curve", "segment").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("qn"))
    sizes = common.table(cand_n.join(asked_n, ["curve", "segment"]), "sizes")
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = [*own, "block"]
    cand = cand.join(sizes, ["curve", "segment"]).select("curve", "segment", deal("cn").alias("c"), each("qn").alias("q"), *own, F.lit(False).alias("asks"))
    asked = asked.join(sizes, ["curve", "segment"]).select("curve", "segment", each("cn").alias("c"), deal("qn").alias("q"), *own, F.lit(True).alias("asks"))

    def compare(g):
        import pandas as pd

        x, y = g[g["asks"]], g[~g["asks"]].sort_values(["vec_id", "h1", "k"])
        names = {"query_id": "int64", "query_h1": "int64", "times": "int64", "vec_id": "int64", "h1": "int64", "k": "int64", "score": "float64"}
        if not len(x) or not len(y):
            return pd.DataFrame({c: [] for c in names}).astype(names)
        qi, qb, e = x["vec_id"].to_numpy(), x["block"].to_numpy(), np.stack(x["embedding"].to_numpy())
        rows, scores = [], []
        for at in range(0, len(y), BLOCK):
            part = y.iloc[at : at + BLOCK]
            vi = part["vec_id"].to_numpy()
            # each product summed in one order whatever else is in the block, so equal rows tie
            score = np.einsum("ij,kj->ik", e, np.stack(part["embedding"].to_numpy()))
            score[(qi[:, None] == vi[None]) | (np.abs(qb[:, None] - part["block"].to_numpy()[None]) > width)] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :top] if len(vi) <= 4 * top else _top(score, top)
            rows.append(at + best)
            scores.append(np.take_along_axis(score, best, axis=1))
        rows, scores = np.concatenate(rows, 1), np.concatenate(scores, 1)
        best = np.argsort(-scores, axis=1, kind="stable")[:, :top]  # parts are in the order of ids
        i = np.repeat(np.arange(len(qi)), best.shape[1])
        hit = y.iloc[np.take_along_axis(rows, best, axis=1).ravel()]
        out = pd.DataFrame({"query_id": qi[i], "query_h1": x["h1"].to_numpy()[i], "times": x["k"].to_numpy()[i], "vec_id": hit["vec_id"].to_numpy(), "h1": hit["h1"].to_numpy(),
                            "k": hit["k"].to_numpy(), "score": np.take_along_axis(scores, best, axis=1).ravel()})
        return out[np.isfinite(out["score"])]

    ddl = "query_id long, query_h1 long, times long, vec_id long, h1 long, k long, score double"
    found = cand.unionByName(asked).groupBy("curve", "segment", "c", "q").applyInPandas(compare, ddl)
    order = Window.partitionBy("query_id", "query_h1").orderBy(F.desc("score"), "vec_id", "h1", "k")
    best = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)  # a row found on several curves counts once
    return best.select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1), "times")).alias("_")).drop("_")


def _fine(key, ids):
    """Key with three bits of a hash of the id, so that equal keys spread over blocks."""
    import numpy as np

    return key.astype(np.int64) << 3 | (ids.astype(np.int64) * np.int64(0x9E3779B9) >> np.int64(7)) & 7


def _top(score, top: int):
    """Columns of each row's `top` largest scores; ties at the border to the smaller column."""
    import numpy as np

    edge = -np.partition(-score, top - 1, axis=1)[:, top - 1]
    out = np.empty((len(score), top), np.int64)
    for r, (s, e) in enumerate(zip(score, edge, strict=True)):
        at = np.flatnonzero(s >= e)
        out[r] = at[np.argsort(-s[at], kind="stable")][:top]
    return out


def _window(pool: DataFrame, probes, top: int, n_blocks: int) -> int:
    """The least number of blocks on either side that reaches RECALL of the probes' neighbours."""
    import numpy as np

    x, ids = vectors.matrix(probes["embedding"].combine_chunks()), probes["vec_id"].to_numpy()
    own = np.array(probes["blocks"].to_pylist())
    ddl = "probe int, vec_id long, score double, away int"
    schema = common.arrow_schema(ddl)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v, blocks = b["vec_id"].to_numpy(), np.array(b["blocks"].to_pylist())
            score = x @ vectors.matrix(b["embedding"]).T
            score[ids[:, None] == v[None]] = -np.inf
            rows = []
            for p in range(len(ids)):
                for i in np.argsort(-score[p], kind="stable")[:top]:
                    if np.isfinite(score[p, i]):
                        rows.append((p, int(v[i]), float(score[p, i]), int(np.abs(own[p] - blocks[i]).min())))
            yield common.batch(rows, schema)

    near = pool.mapInArrow(run, ddl)
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top).groupBy("away").count().toArrow()
    if not near.num_rows:
        return n_blocks
    away, n = near["away"].to_numpy(), near["count"].to_numpy()
    order = np.argsort(away)
    reached = np.cumsum(n[order]) / n.sum()
    return int(away[order][np.argmax(reached >= RECALL)])
