"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations give all coordinates: sigma shuffles the shingle space once, and pi, shifted
circularly by k, gives coordinate k: h_k(S) = min over s in S of pi((sigma(s) - k) mod 2^32).
Both are bijections of the 32-bit space.

Equal sets are merged first, so copies meet as one representative. Representatives that agree in a
band share a bucket. A bucket's members are compared with its hub, the member that shares most
buckets, not with each other: first by the low bits of their coordinates, which come along with them.
What that leaves in several components is then compared exactly:
every member outside the bucket's largest component with every member, block by block, where a
pair is emitted once (in the first band that it shares), and only if longer sketches agree often
enough to be a link: a true link fails that with a probability of about 1e-6. The two members of a
bucket of two have met as hub and pair, so such buckets are left out there. Every link that counts
is confirmed on the full shingle sets of both texts; a hub meets its pairs in chunks, and reaches each
chunk once. So no bucket size has a cap, no group is collected, and no task gets more than a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetmill.llm import common

WORDS = 5
#: Jaccard similarity of a link, as a fraction in whole numbers.
LINK = (75, 100)
BANDS, ROWS = 32, 5
#: Of the BANDS * ROWS coordinates' low bits (hub and member) or low bytes (exact comparison), and of the WIDE
#: low bytes there, so many agree at least before a pair is verified (5, 4.6 and 5 standard deviations below a
#: link's mean).
AGREE_BITS, AGREE, WIDE, AGREE_WIDE = 119, 95, 1024, 700
#: Members of a block in the comparison of large buckets; members of all of a hub's buckets, a pair counted
#: in each, for each chunk that its pairs are dealt into: no chunk has more pairs than that on average.
BLOCK, CHUNK = 256, 256


def shingles(text: str | None):
    """Sorted distinct 64-bit hashes of the text's shingles; empty without words."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(common.LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.array([xxh3_64_intdigest(x) for x in words], np.uint64)
    k = min(len(w), WORDS)
    h = np.full(len(w) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - k + 1 + i]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(32)))


def _mix(x, a: int, b: int):
    """A bijection of 32-bit numbers, in place."""
    import numpy as np

    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes, size: int = BANDS * ROWS):
    """The first coordinates of a non-empty set, from the two permutations."""
    import numpy as np

    s = _mix((hashes >> np.uint64(32)).astype(np.uint32), 0x21F0AAAD, 0xD35A2D97)  # sigma
    shift = np.arange(1, size + 1, dtype=np.uint32)
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(s), 256):
        np.minimum(out, _mix(s[i : i + 256, None] - shift, 0x7FEB352D, 0x846CA68B).min(axis=0), out=out)  # pi
    return out


def _bands(sig):
    """One key for each band of a signature's first coordinates."""
    import numpy as np

    key = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    for c in sig[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        key = (key ^ c) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64).tolist()


def _bits(sig):
    """The coordinates' low bits, 64 to a number; the last one is filled up with zeros."""
    import numpy as np

    bits = np.zeros(-(-len(sig) // 64) * 64, np.uint8)
    bits[: len(sig)] = sig & np.uint32(1)
    return np.packbits(bits).view(np.int64).tolist()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id (128-bit digest of the set), bits (low bits of the coordinates)
    and bands (one key for each band); null digests where there are no words."""
    ddl = "doc_id long, n_shingles long, set_id binary, bits array<long>, bands array<long>"
    schema = common.arrow_schema(ddl)

    def run(batches):
        from xxhash import xxh3_128_digest

        for b in batches:
            rows: list[tuple] = []
            for i, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                h = shingles(text.as_py())  # one text at a time: a batch may hold very long ones
                if not len(h):
                    rows.append((i, 0, None, None, None))
                    continue
                sig = signature(h)
                rows.append((i, len(h), xxh3_128_digest(h.tobytes()), _bits(sig), _bands(sig)))
            yield common.batch(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)


def _alike(a: str, b: str):
    """Whether two columns of bits agree in AGREE_BITS coordinates at least."""
    apart = [F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(-(-BANDS * ROWS // 64))]
    return sum(apart[1:], apart[0]) <= BANDS * ROWS - AGREE_BITS


def _by_hub(pairs: DataFrame, data: DataFrame, alike) -> DataFrame:
    """Pairs (id, hub, chunk) for which alike(own data, hub's data) holds. pairs and data (id, data: binary)
    are stored tables; an id may have several rows of data: one match is enough.

    In each chunk of a hub's pairs the hub's data come once, ahead of those of its pairs; rows of one id come
    together there, so a pair is given once."""
    ddl = "id long, hub long, chunk long"
    schema = common.arrow_schema(ddl)
    hubs = pairs.select("hub", "chunk").distinct().select("hub", "chunk", F.lit(0).alias("side"), F.col("hub").alias("id"))
    asked = pairs.select("hub", "chunk", F.lit(1).alias("side"), "id").unionByName(hubs)
    rows = asked.join(data, "id").select("hub", "chunk", "side", "id", "data").repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "side", "id")

    def run(batches):
        at, held, given = None, [], None
        for b in batches:
            out = []
            columns = (b[c].to_pylist() for c in ("hub", "chunk", "side", "id"))
            for hub, chunk, side, i, x in zip(*columns, b["data"], strict=True):
                if at != (hub, chunk):
                    at, held, given = (hub, chunk), [], None
                if not side:
                    held.append(x.as_py())
                elif i != given and any(alike(x.as_py(), y) for y in held):
                    out.append((i, hub, chunk))
                    given = i
            yield common.batch(out, schema)

    return rows.mapInArrow(run, ddl)


def _sets(docs: DataFrame, need: DataFrame) -> DataFrame:
    """id and data (the sorted shingle hashes) of the documents whose doc_id is in need, and of a few others (parted)."""
    ddl = "id long, data binary"
    schema = common.arrow_schema(ddl)

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):  # a batch may hold very long texts
                part = b.slice(k, 256)
                yield common.batch([(i, shingles(t.as_py()).tobytes()) for i, t in zip(part["doc_id"].to_pylist(), part["text"], strict=True)], schema)

    near = common.parted(docs, need, "doc_id")[0].select("doc_id", "text")
    return near.mapInArrow(run, ddl).where("length(data) > 0").repartition("id").distinct()  # dealt as the joins by id need it


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (src, dst) whose full shingle sets meet the similarity of a link; pairs: a stored table of id, hub, chunk."""
    def alike(x: bytes, y: bytes) -> bool:
        import numpy as np

        least, most = sorted((len(x) // 8, len(y) // 8))
        if LINK[1] * least < LINK[0] * most:
            return False
        both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        return LINK[1] * both >= LINK[0] * (least + most - both)

    need = pairs.select(F.explode(F.array("id", "hub")).alias("doc_id"))
    found = _by_hub(pairs, _sets(docs, need), alike)
    return found.select(F.col("id").alias("src"), F.col("hub").alias("dst"))


def _wide(docs: DataFrame, need: DataFrame) -> DataFrame:
    """rep, wide (a sketch of WIDE coordinates) and bands of the documents named in need, and of a few others (parted)."""
    ddl = "rep long, wide binary, bands array<long>"
    schema = common.arrow_schema(ddl)

    def run(batches):
        import numpy as np

        for b in batches:
            sets = ((i, shingles(t.as_py())) for i, t in zip(b["doc_id"].to_pylist(), b["text"], strict=True))
            sigs = ((i, signature(h, WIDE)) for i, h in sets if len(h))
            yield common.batch([(i, sig.astype(np.uint8).tobytes(), _bands(sig)) for i, sig in sigs], schema)

    near = common.parted(docs, need.withColumnRenamed("rep", "doc_id"), "doc_id")[0].select("doc_id", "text")
    return near.mapInArrow(run, ddl).repartition("rep").distinct()  # dealt as the join by rep needs it


def _rest(members: DataFrame, label: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (id, hub, chunk) of different components in one bucket whose sketches are alike; a hub here is
    a member outside the largest component, a chunk holds its pairs with one block. members: key, rep and n, the bucket's size;
    label: id and component_id, of ids that are no least ones of a component. A pair is given once, but may repeat where
    a doc_id has several texts."""
    import pandas as pd

    members = members.where("n > 2").select("key", "rep").join(label.select(F.col("id").alias("rep"), "component_id"), "rep", "left").select(
        "key", "rep", F.coalesce("component_id", "rep").alias("part"))
    parts = members.groupBy("key", "part").agg(F.count("*").alias("n"))
    open_ = parts.groupBy("key").agg(F.count("*").alias("k"), F.sum("n").alias("c"), F.max(F.struct("n", "part")).alias("most")).where("k > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ = common.table(open_.select("key", F.col("c").alias("n"), F.col("most.part").alias("largest"), blocks(F.col("c")).alias("blocks"),
                                      blocks(F.col("c") - F.col("most.n")).alias("chunks")), "open")
    members = common.table(common.hot_join(members, open_, "key"), "members")
    # a doc_id with several texts has a sketch for each, which is in the buckets of its own bands
    members = common.table(members.join(_wide(docs, members.select("rep")), "rep").where("array_contains(bands, key)"), "rest")
    at = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = ["rep", "part", "largest", "wide", "bands"]
    home = members.select("key", at("blocks").alias("block"), each("chunks").alias("chunk"), *own, F.lit(False).alias("minor"))
    minor = members.where("part <> largest").select("key", at("chunks").alias("chunk"), each("blocks").alias("block"), *own, F.lit(True).alias("minor"))

    def compare(x):
        import numpy as np

        wide = np.frombuffer(b"".join(x["wide"]), np.uint8).reshape(-1, WIDE)
        narrow, bands = wide[:, : BANDS * ROWS].copy(), np.stack(x["bands"].to_numpy())
        rep, part, is_minor = x["rep"].to_numpy(), x["part"].to_numpy(), x["minor"].to_numpy()
        largest, block = x["largest"].to_numpy(), x["block"].iloc[0]
        here, band, a, b = np.flatnonzero(~is_minor), (bands == x["key"].iloc[0]).argmax(1), [], []
        for i in np.flatnonzero(is_minor):
            hit = here[part[here] != part[i]]
            hit = hit[(narrow[hit] == narrow[i]).sum(axis=1) >= AGREE]
            hit = hit[(wide[hit] == wide[i]).sum(axis=1) >= AGREE_WIDE]
            hit = hit[(bands[hit] == bands[i]).argmax(1) == band[i]]
            hit = hit[(part[hit] == largest[hit]) | (rep[hit] < rep[i])]  # two such members meet twice
            a += rep[hit].tolist()
            b += [rep[i]] * len(hit)
        return pd.DataFrame({"id": np.array(a, np.int64), "hub": np.array(b, np.int64), "chunk": np.int64(block)})

    return home.unionByName(minor).groupBy("key", "block", "chunk").applyInPandas(compare, "id long, hub long, chunk long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each row of docs.

    Texts without words link with nothing. A row without doc_id links with nothing, has a null
    component_id and is kept. Rows that repeat a doc_id are one node and share their component. Texts
    of any length are taken whole; an empty table gives no rows; other columns are left aside."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sigs = common.table(signatures(docs), "signatures")
    sets = sigs.where("n_shingles > 0 and doc_id is not null")
    reps = common.table(sets.groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("bits").alias("bits"), F.first("bands").alias("bands")), "reps")

    bands = reps.select("rep", "bits", F.explode("bands").alias("key"))
    many = common.table(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    shared = common.parted(bands, many, "key")[0]  # most keys occur once: those rows are not shuffled again
    members = common.table(common.hot_join(shared, many, "key").select("key", "rep", "bits", "n"), "buckets")
    weight = members.groupBy("rep").agg(F.sum("n").alias("w"))
    hubs = common.table(members.join(weight, "rep").groupBy("key").agg(
        F.max(F.struct(F.col("w"), (-F.col("rep")).alias("rep"), F.col("bits").alias("hub_bits"))).alias("hub"), F.count("*").alias("n")).select(
        "key", (-F.col("hub.rep")).alias("hub"), "hub.w", "hub.hub_bits", "n"), "hubs")
    pairs = common.hot_join(members.drop("n"), hubs, "key").where("rep <> hub").where(_alike("bits", "hub_bits")).groupBy(
        F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b")).agg(F.max("hub").alias("hub"), F.max("w").alias("w"))
    pairs = pairs.select(F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("id"), "hub", "w")
    pairs = pairs.withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("w") / CHUNK))).drop("w")

    pair = lambda df: df.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    named_ = lambda stars: stars.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    first = common.stars(common.table(pair(_verified(common.table(pairs, "pairs"), docs)), "links"))  # a pair has one hub and chunk
    more = common.table(pair(_verified(common.table(_rest(members, named_(first), docs), "to_verify"), docs)), "more")
    # a doc_id with several texts ties their sets together, and has one component
    several = sigs.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("set_id").alias("a"), F.max("set_id").alias("b"), F.count("*").alias("n"), F.count("set_id").alias("k")).where("a <> b or k < n").select("doc_id")
    ties = sets.join(several, "doc_id").join(reps.select("set_id", "rep"), "set_id").where("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))
    # the links' components come as stars; the least id of a component has no label
    label = named_(common.stars(common.table(first.unionByName(more).unionByName(pair(ties)).distinct(), "edges")))

    named = reps.select("set_id", "n", F.col("rep").alias("id")).join(label, "id", "left")
    named = named.select("set_id", "n", F.coalesce("component_id", "id").alias("component_id"))
    out = common.hot_join(sets.select("set_id", "doc_id", "n_shingles"), named, "set_id").select("doc_id", "n_shingles", "component_id")
    rest = sigs.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles")
    label = label.join(several.withColumnRenamed("doc_id", "id"), "id", "left_semi").withColumnRenamed("id", "doc_id")
    rest = rest.join(label, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
