"""Phrases that occur more often than their parts would: collocations by top-order marginalisation.

Every word of a piece opens one window of three lead columns (w1, w2, w3), padded with nulls where the
piece ends. Only these longest windows are counted; Spark's ROLLUP sums them to the counts of their
successively shorter prefixes, so no phrase of one or two words is ever exploded by itself. A null that
pads is told from a null that sums by the grouping id.

Windows are thinned before they are counted. A first pass counts words and word pairs by a hash of 40
bits; hashes that occur `least` times set a bit in a bitmap of SLOTS bits, which goes to the executors. A task
hands on its hashes packed by their part of the bitmap, and each part is counted by itself (4,096 parts). A
second pass does so for the triples of such pairs. In the third a window leaves out its tail from the first
pair or triple whose bit is not set, and its first word if that one's is not. Hashes and bits that several
phrases share only keep more windows than needed: whatever
can be a candidate or a part of one is counted in full, and its count is that of its words, not of a hash.
A corpus that sets every bit is counted without thinning.

Documents may have any length: a task works through slices of a text and hands on its counts whenever
FLUSH words or VOCAB different words have come together.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetmill.llm import common

#: Bits of the bitmap: 16 MB whatever the data; different hashes that are counted.
SLOTS, KEYS = 1 << 27, 1 << 40
#: Of a hash, the bits that name a place in a part of the bitmap, and those that come with it there; bits of a count beside them.
PLACE, OWN, COUNT = 15, 28, 4
#: Words, and different words, that a task holds before it hands on its counts (the second has to fit 20 bits); bytes of a slice.
FLUSH, VOCAB, SLICE = 1 << 20, (1 << 20) - 2, 1 << 20
#: A-Z in lower case; what ends a piece becomes a full stop.
PLAIN = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\x0a\x0b\x0c\x0d", bytes(range(97, 123)) + b"." * 9)
#: Languages that are null.
UNKNOWN = "und"
#: Rows of one part from which its key goes by broadcast (common.hot_join).
HOT_PARTS = 100


@contextmanager
def _released(spark: SparkSession):
    """Queries inside give up their shuffle files as they end: their results are collected or written by then."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


class _Ids(dict):
    """Numbers of words, in the order of their coming; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def slices(data: bytes, size: int = SLICE):
    """A translated text in parts of about `size` bytes that end at white space or a full stop."""
    at = 0
    while len(data) - at > size:
        cut = max(data.rfind(c, at, at + size) for c in (b" ", b"\t", b"."))
        if cut < at:  # one word is longer than a slice
            cut = min((k for k in (data.find(c, at + size) for c in (b" ", b"\t", b".")) if k >= 0), default=len(data) - 1)
        yield data[at : cut + 1]
        at = cut + 1
    yield data[at:]


def _batches(batches, emit, flush: int = FLUSH, vocab: int = VOCAB):
    """emit(lang, words, ids, starts) for every so many words: ids of the words (0: end of a piece), of which the
    first `starts` open windows. A text may go on in the next call, which then begins with the last two ids."""
    import numpy as np

    ids, parts, size = _Ids({b".": 0}), {}, 0
    for b in batches:
        for lang, text in zip(b["lang"], b["text"], strict=True):
            lang = lang.as_py()
            for data in slices((text.as_py() or b"").translate(PLAIN)):
                words = data.replace(b".", b" . ").split()
                if len(ids) + len(words) > vocab or size + len(words) > flush:
                    names, open_ = [*ids], []
                    for own, arrays in parts.items():
                        a = np.concatenate(arrays)
                        open_ = [names[i] for i in a[-2:]] if own == lang and a[-1] else open_
                        yield from emit(own, names, a, len(a) - (len(open_) if own == lang else 0))
                    ids, size = _Ids({b".": 0}), 0
                    parts = {lang: [np.array([ids[w] for w in open_], np.int64)]} if open_ else {}
                a = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                parts.setdefault(lang, []).append(a)
                size += len(a)
            parts[lang].append(np.zeros(1, np.int64))  # a text ends a piece
    names = [*ids]
    for own, arrays in parts.items():
        a = np.concatenate(arrays)
        yield from emit(own, names, a, len(a))


def _hashes(lang: str, words: list[bytes]):
    """A 64-bit hash of each word in a language."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    seed = xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair(a, b):
    import numpy as np

    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def _leads(a, starts: int):
    """The three lead columns of the windows that open at the first `starts` ids, pads as 0."""
    import numpy as np

    padded = np.concatenate([a, np.zeros(2, np.int64)])
    w1, w2, w3 = (padded[k : k + starts] for k in range(3))
    here = w1 > 0
    w1, w2, w3 = w1[here], w2[here], w3[here]
    return w1, w2, np.where(w2 > 0, w3, 0)


def _often(bits, keys):
    """1 where the key's bit is set."""
    import numpy as np

    at = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1


def _thinned(h, w1, w2, w3, bits):
    """w2 and w3 of windows, 0 from the first pair on whose bit is not set, and a key of each triple that is left."""
    import numpy as np

    first = _pair(h[w1], h[w2])
    w2 = w2 * (_often(bits, first) * (w2 > 0))
    w3 = w3 * (_often(bits, _pair(h[w2], h[w3])) * ((w2 > 0) & (w3 > 0)))
    return w2, w3, _pair(first ^ np.uint64(0x94D049BB133111EB), h[w3])


def _packed(keys, least: int):
    """Parts of the bitmap with the hashes that fall there, packed with how often they come (as 32-bit numbers; a
    count that passes COUNT bits comes in several, one over `least` is cut to it)."""
    import numpy as np
    import pyarrow as pa

    slot, place = keys & np.uint64(SLOTS - 1), np.uint64(PLACE)
    codes = (slot >> place << np.uint64(OWN)) | ((keys & np.uint64(KEYS - 1)) // np.uint64(SLOTS) << place) | (slot & np.uint64((1 << PLACE) - 1))
    codes, n = np.unique(codes.view(np.int64), return_counts=True)
    n = np.minimum(n, least)
    while len(codes):
        packed = ((codes & (1 << OWN) - 1) << COUNT | np.minimum(n, (1 << COUNT) - 1)).astype(np.uint32)
        ends = np.searchsorted(codes, np.arange((SLOTS >> PLACE) + 1) << OWN)
        parts = np.flatnonzero(np.diff(ends))
        offsets = (4 * np.append(ends[parts], ends[-1])).astype(np.int32)
        yield pa.array(parts.astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        n = n - (1 << COUNT) + 1
        codes, n = codes[n > 0], n[n > 0]


def _marked(blobs: list[bytes], least: int) -> bytes | None:
    """A part of the bitmap: the bits of the packed hashes that come `least` times, compressed; None without any."""
    import zlib

    import numpy as np

    packed = np.sort(np.frombuffer(b"".join(blobs), np.uint32))
    keys = packed >> COUNT
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.add.reduceat((packed & (1 << COUNT) - 1).astype(np.int64), first)
    bits = np.zeros(1 << PLACE, np.uint8)
    bits[keys[first[n >= least]] & (1 << PLACE) - 1] = 1
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1) if bits.any() else None


def _frequent(texts: DataFrame, least: int, bits=None):
    """The bitmap of the words and pairs that occur `least` times; given that one, it and the triples of such pairs."""
    import zlib

    import numpy as np

    ddl = "part int, keys binary"
    schema = common.arrow_schema(ddl)
    held = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        import pyarrow as pa

        def emit(lang, words, a, starts):
            h = _hashes(lang, words)
            w1, w2, w3 = _leads(a, starts)
            if held.value is None:
                both = w2 > 0
                keys = np.concatenate([h[w1], _pair(h[w1[both]], h[w2[both]])])
            else:
                _, w3, keys = _thinned(h, w1, w2, w3, held.value)
                keys = keys[w3 > 0]
            for columns in _packed(keys, least):
                yield pa.RecordBatch.from_arrays([*columns], schema=schema)

        yield from _batches(batches, emit)

    def mark(rows):
        import pyarrow as pa

        got = _marked(rows["keys"].to_pylist(), least)
        return pa.table({"part": pa.array([rows["part"][0].as_py()] if got else [], pa.int32()), "bits": pa.array([got] if got else [], pa.binary())})

    out = np.zeros(SLOTS // 8, np.uint8) if bits is None else bits.copy()
    with _released(texts.sparkSession):
        found = texts.mapInArrow(run, ddl).groupBy("part").applyInArrow(mark, "part int, bits binary").toArrow()  # SLOTS bits in all, compressed
    size = 1 << PLACE >> 3
    for part, own in zip(found["part"].to_pylist(), found["bits"], strict=True):
        out[part * size : (part + 1) * size] |= np.frombuffer(zlib.decompress(own.as_py()), np.uint8)
    held.destroy()
    return out


def windows(docs: DataFrame, least: int = 10) -> DataFrame:
    """lang, w1, w2, w3, n: the padded longest windows of all texts and their counts, thinned by what
    occurs `least` times (see above)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    held = texts.sparkSession.sparkContext.broadcast(_frequent(texts, least, _frequent(texts, least)))
    ddl = "lang string, w1 binary, w2 binary, w3 binary, n long"
    schema = common.arrow_schema(ddl)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def emit(lang, words, a, starts):
            h = _hashes(lang, words)
            w1, w2, w3 = _leads(a, starts)
            w2, w3, keys = _thinned(h, w1, w2, w3, held.value)
            w3 = w3 * _often(held.value, keys)
            w1 = w1 * _often(held.value, h[w1])
            codes, n = np.unique(w1 << 40 | w2 << 20 | w3, return_counts=True)
            names = pa.array([None, *words[1:]], pa.binary())
            for k in range(0, len(codes), 100_000):
                own = codes[k : k + 100_000]
                leads = [names.take(pa.array(own >> s & (1 << 20) - 1)) for s in (40, 20, 0)]
                yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(own), np.int64))), *leads, pa.array(n[k : k + 100_000])], schema=schema)

        yield from _batches(batches, emit)

    leads = ["w1", "w2", "w3"]
    made = texts.mapInArrow(run, ddl).select("lang", *[F.col(w).cast("string").alias(w) for w in leads], "n")
    return made.groupBy("lang", *leads).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = 10) -> DataFrame:
    """lang, words (array, empty for a language's number of words), f: every phrase of one to three words
    that occurs `least` times in its language, by ROLLUP over the longest windows."""
    levels = windows(docs, least).rollup("lang", "w1", "w2", "w3").agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    words = F.array_compact(F.array("w1", "w2", "w3"))
    size = F.when(F.col("level") == 7, 0).when(F.col("level") == 3, 1).when(F.col("level") == 1, 2).when(F.col("level") == 0, 3)
    # a prefix that ends in a pad is no phrase of its level's length
    return levels.select("lang", words.alias("words"), "f", size.alias("size")).where(F.size("words") == F.col("size")).where(
        (F.col("size") == 0) | (F.col("f") >= least)).select("lang", "words", "f")


def _parts(cuts: DataFrame, side: str, parts: DataFrame, name: str) -> DataFrame:
    """cuts (a stored table) with the count of their left or right part; a part of very many cuts goes to them by broadcast."""
    counts = common.table(cuts.groupBy(side).agg(F.count("*").alias("n")).join(parts.withColumnsRenamed({"key": side, "f": name}), side), name)
    return common.table(common.hot_join(cuts, counts, side, least=HOT_PARTS).drop("n"), f"with_{name}")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the `top` phrases of two or three words by the
    score of their weakest cut, without those that a longer candidate holds in `share` percent of their places.

    docs: text and lang. A null text is empty, a null language is UNKNOWN; empty texts, texts of separators
    alone and an empty table give no phrases. Texts and words of any length count whole, repeated rows as often
    as they come; equal scores are ordered by a, then by the phrase's bytes. Other columns are left aside,
    whatever their names."""
    with _released(docs.sparkSession):
        counts = common.table(phrase_counts(docs, least), "phrases")
    said = lambda words: F.concat("lang", F.lit("\n"), F.array_join(words, " "))
    candidates = counts.where(F.size("words") >= 2).select(said("words").alias("key"), "lang", "words", F.col("f").alias("a"))
    # what longer candidates hold most of
    longer = candidates.where(F.size("words") > 2)
    inner = longer.select("lang", "a", F.explode(F.array(F.slice("words", 1, 2), F.slice("words", 2, 2))).alias("words"))
    held = inner.groupBy(said("words").alias("key")).agg(F.max("a").alias("_longer"))
    kept = candidates.join(held, "key", "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a"))).drop("_longer")
    # every cut meets the counts of its two parts
    ks = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = kept.select("key", "lang", "words", "a", ks)
    cuts = cuts.withColumns({"left": said(F.slice("words", F.lit(1), F.col("k"))), "right": said(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))})
    parts = counts.where(F.size("words").between(1, 2)).select(said("words").alias("key"), "f")
    cuts = common.table(cuts, "cuts")
    cuts = _parts(_parts(cuts, "left", parts, "l"), "right", parts, "r")
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0))) * cast(a as decimal(15,0)) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    weakest = cuts.withColumn("score", score).groupBy("key", "lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = weakest.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    return first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
