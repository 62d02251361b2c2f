"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves, each with its own codebook; the pairs of codewords form a grid of
cells. A multi-sequence traversal visits the cells in the order of a vector's distance, and the
vectors in the visited cells are compared in double precision. How many cells are visited is
measured twice, and the larger number taken. For a sample of vectors, all their links are found by
comparison with every row, and the visits must reach each of them, with a margin. And vectors made
at a cosine of exactly LINK around sampled ones, the hardest links there can be, must be reached
from either side in all but MISSED of the cases, whether or not the table holds any links.

Equal vectors are one node with a count. Large cells are compared block by block; a block hands on
a number of links and the smallest linked id for each vector, never its pairs.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetmill.llm import common, vectors

LINK = 0.9
#: Bounded samples: vectors for the codebooks, vectors whose links are found in full.
FIT_ROWS, PROBES = 20_000, 256
#: Made partners of the sampled vectors, in all, and the share of them that may be missed.
PARTNERS, MISSED = 4096, 0.01
#: Vectors that a cell holds on average; largest codebook; least number of visited cells.
CELL, CODES, LEAST_VISITS = 32, 1024, 8
BLOCK = 1024
#: Numbers that are compared at once.
COMPARED = 1 << 22


def codebook(x, k: int, rounds: int = 12):
    """k centres by Lloyd's rounds from rows spread over the sample."""
    import numpy as np

    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ centres.T - (centres**2).sum(1) / 2).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def halves(x, books):
    """Squared distances of each row's halves to the codewords."""
    d = []
    for part, c in zip((x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]), books, strict=True):
        d.append((part**2).sum(1)[:, None] - 2 * part @ c.T + (c**2).sum(1))
    return d


def traverse(left, right, most: int) -> list[int]:
    """Cells in the order of distance, by the multi-sequence algorithm: (i, j) of the two sorted
    lists is entered once (i-1, j) and (i, j-1) have been visited."""
    import numpy as np

    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, out, reached = [(left[a[0]] + right[b[0]], 0, 0)], [], {}
    while heap and len(out) < most:
        _, i, j = heapq.heappop(heap)
        out.append(int(a[i]) * len(right) + int(b[j]))
        reached[i] = j + 1  # cells of row i that have been visited
        if i + 1 < len(a) and (j == 0 or reached.get(i + 1, 0) == j):
            heapq.heappush(heap, (left[a[i + 1]] + right[b[j]], i + 1, j))
        if j + 1 < len(b) and (i == 0 or reached.get(i - 1, 0) > j + 1):
            heapq.heappush(heap, (left[a[i]] + right[b[j + 1]], i, j + 1))
    return out


def _unit(x):
    import numpy as np

    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows
    return x / np.sqrt((x**2).sum(1))[:, None]


def _visits_needed(nodes: DataFrame, probe, books) -> int:
    """The most cells that a pair of the probes' links needs, from either side."""
    import numpy as np

    schema = common.arrow_schema("needed long")
    probe_d = halves(probe, books)
    probe_cell = probe_d[0].argmin(1) * len(books[1]) + probe_d[1].argmin(1)

    def rank(d, r, cell):
        i, j = divmod(int(cell), len(books[1]))
        return int(((d[0][r][:, None] + d[1][r][None]) < d[0][r, i] + d[1][r, j]).sum()) + 1

    def run(batches):
        needed = 0
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(vectors.matrix(b["embedding"]))
            d = halves(x, books)
            cell = d[0].argmin(1) * len(books[1]) + d[1].argmin(1)
            near = np.argwhere(x @ probe.T >= LINK)
            near = near[cell[near[:, 0]] != probe_cell[near[:, 1]]]
            # many links of a probe lead to one cell: its rank there is found once, and the other
            # side is asked only where the least number of visits would not do
            keys, back = np.unique(near[:, 1] * len(books[0]) * len(books[1]) + cell[near[:, 0]], return_inverse=True)
            own = np.array([rank(probe_d, *divmod(int(x), len(books[0]) * len(books[1]))) for x in keys], int)[back]
            for (r, p), k in zip(near, own, strict=True):
                needed = max(needed, k if 2 * k <= LEAST_VISITS else min(rank(d, r, probe_cell[p]), k))
        yield common.batch([(needed,)], schema)

    return nodes.select("embedding").mapInArrow(run, "needed long").agg(F.max("needed")).first()[0] or 0


def _visits_for_made(x, books, seed: int = 7) -> int:
    """The cells that reach all but MISSED of made partners, at a cosine of exactly LINK."""
    import numpy as np

    rng = np.random.default_rng(seed)
    a = x[np.linspace(0, len(x) - 1, PARTNERS).astype(int)]
    turn = rng.normal(size=a.shape)
    turn -= (turn * a).sum(1, keepdims=True) * a
    size = np.sqrt((turn**2).sum(1, keepdims=True))
    b = LINK * a + (1 - LINK**2) ** 0.5 * turn / np.where(size > 0, size, 1)
    da, db = halves(a, books), halves(b, books)

    def rank(d, other):
        i, j = other[0].argmin(1), other[1].argmin(1)
        at = np.take_along_axis(d[0], i[:, None], 1) + np.take_along_axis(d[1], j[:, None], 1)
        right = np.sort(d[1], 1)
        # for each left codeword, the right ones that come before the cell
        return np.array([np.searchsorted(right[r], at[r, 0] - d[0][r]).sum() + 1 for r in range(len(at))])

    need = np.sort(np.minimum(rank(da, db), rank(db, da)))
    return int(need[int(np.ceil((1 - MISSED) * len(need))) - 1])


def near_duplicates(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row for each row of the table.

    Vectors that are null, zero or not finite, have another size than most, or lack a vec_id link
    with nothing. Rows that repeat a vec_id are vectors of their own with one component. An empty table gives
    no rows; columns other than vec_id and embedding are left aside."""
    import numpy as np

    rows = vectors.keyed(table)
    size = vectors.usual_size(rows.where("usable"))
    rows = rows.withColumn("usable", F.col("usable") & (F.size("embedding") == size))
    nodes = common.table(rows.where("usable").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "nodes")
    total = nodes.count()
    # a repeated vec_id with several vectors ties their nodes together
    tied = rows.where("usable").join(nodes.where("n > 1").select("h1", "h2", "rep"), ["h1", "h2"])
    edges = tied.where("vec_id <> rep").select(F.col("vec_id").alias("src"), F.col("rep").alias("dst"))
    linked = None
    if total > 1:
        found = _compare(nodes, total, size)
        edges = edges.unionByName(found.where("rep <> low").select(F.col("rep").alias("src"), F.col("low").alias("dst")))
        linked = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    label = common.table(common.components(edges), "components")
    info = nodes.select("h1", "h2", "n")
    info = info.join(linked, ["h1", "h2"], "left") if linked is not None else info.withColumn("links", F.lit(0))
    info = common.table(info.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links")).where("links > 0"), "links")
    out = rows.select("vec_id", F.when(F.col("usable"), F.col("h1")).alias("h1"), F.when(F.col("usable"), F.col("h2")).alias("h2"))
    out = out.join(info, ["h1", "h2"], "left").join(label.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def _compare(nodes: DataFrame, total: int, size: int) -> DataFrame:
    """h1, h2, rep, links, low: for each block in which a node has links, their number (copies
    counted) and the smallest id that they reach."""
    import numpy as np
    import pandas as pd

    fit = vectors.sample(nodes, total, FIT_ROWS, "h1").orderBy("h1", "h2").select("embedding").toArrow()
    x = _unit(vectors.matrix(fit["embedding"].combine_chunks()))
    k = int(min(CODES, len(x), max(2, round((total / CELL) ** 0.5))))
    books = [codebook(x[:, : size // 2], k), codebook(x[:, size // 2 :], k)]
    visits = min(k * k, max(LEAST_VISITS, _visits_for_made(x, books), 2 * _visits_needed(nodes, x[:: max(1, len(x) // PROBES)][:PROBES], books)))
    ddl = "h1 long, h2 long, rep long, n long, unit array<double>, cell long, visits array<long>"

    def assign(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            u = _unit(vectors.matrix(b["embedding"]))
            d = halves(u, books)
            cells = [traverse(d[0][i], d[1][i], visits) for i in range(len(u))]
            columns = [b["h1"], b["h2"], b["rep"], b["n"], pa.array(list(u), pa.list_(pa.float64())),
                       pa.array([c[0] for c in cells], pa.int64()), pa.array(cells, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "rep", "n", "unit", "cell", "visits"])

    placed = common.table(nodes.mapInArrow(assign, ddl), "placed")
    asked = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count("*").alias("q"))
    held = placed.groupBy("cell").agg(F.count("*").alias("m")).join(asked, "cell")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    held = common.table(held.select("cell", blocks("m").alias("mb"), blocks("q").alias("qb")), "cells")
    mine = ["h1", "h2", "rep", "n", "unit", "visits"]
    at = lambda n: F.pmod(F.xxhash64("h1", "h2"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = placed.join(held, "cell").select("cell", at("mb").alias("mblock"), each("qb").alias("qblock"), *mine, F.col("cell").alias("home"), F.lit(True).alias("member"))
    queries = placed.select(F.explode("visits").alias("to"), F.col("cell").alias("home"), *mine[:-1]).withColumnRenamed("to", "cell").join(held, "cell")
    queries = queries.select("cell", each("mb").alias("mblock"), at("qb").alias("qblock"), *mine[:-1], F.lit(None).cast("array<long>").alias("visits"), "home", F.lit(False).alias("member"))

    def compare(g):
        m, q = g[g["member"]], g[~g["member"]]
        none = pd.DataFrame({"h1": [], "h2": [], "rep": [], "links": [], "low": []}).astype("int64")
        if not len(m) or not len(q):
            return none
        hit = np.stack(q["unit"].to_numpy()) @ np.stack(m["unit"].to_numpy()).T >= LINK
        a, b = np.nonzero(hit)
        ka, kb = (list(zip(t["h1"], t["h2"], strict=True)) for t in (q, m))
        # each pair once: where both sides visit each other's cell, the side with the larger key asks
        home, seen = q["home"].to_numpy(), np.stack(m["visits"].to_numpy())
        step = max(1, COMPARED // seen.shape[1])  # bounds the memory, however many links and visits there are
        back = np.concatenate([(seen[b[k : k + step]] == home[a[k : k + step], None]).any(1) for k in range(0, max(1, len(a)), step)])
        order = {x: i for i, x in enumerate(sorted({*ka, *kb}))}
        oa, ob = np.array([order[x] for x in ka]), np.array([order[x] for x in kb])
        once = (oa[a] != ob[b]) & (~back | (oa[a] > ob[b]))
        a, b = a[once], b[once]
        if not len(a):
            return none
        links = np.zeros(len(order), np.int64)
        np.add.at(links, oa[a], m["n"].to_numpy()[b])
        np.add.at(links, ob[b], q["n"].to_numpy()[a])
        rep = np.zeros(len(order), np.int64)
        rep[oa], rep[ob] = q["rep"].to_numpy(), m["rep"].to_numpy()
        low = rep.copy()
        while True:  # smallest id that links reach within the block
            before = low.copy()
            np.minimum.at(low, oa[a], low[ob[b]])
            np.minimum.at(low, ob[b], low[oa[a]])
            if (before == low).all():
                break
        keys, used = sorted(order), links > 0
        return pd.DataFrame({"h1": [x[0] for x in keys], "h2": [x[1] for x in keys], "rep": rep, "links": links, "low": low})[used]

    return common.table(members.unionByName(queries).groupBy("cell", "mblock", "qblock").applyInPandas(
        compare, "h1 long, h2 long, rep long, links long, low long"), "found")
