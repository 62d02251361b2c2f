"""Spans of regular-expression matches as column expressions: code points, end exclusive.

Places come from lengths by running sums in two levels, and pieces of a text from blocks of it, so that
the work for n matches grows with n to the power 1.5 at most and no list or text is copied for a match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A list of spans; kinds are numbers so that lists sort by (start, kind).
SPANS = "array<struct<kind:int,start:bigint,stop:bigint,hit:string>>"


def none() -> Column:
    return F.from_json(F.lit("[]"), SPANS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, step: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """For each of an array's whole numbers, what step makes of zero and the numbers before it."""
    start = F.lit(zero).cast("bigint")

    def before(x: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(x))).cast("int")
        part = lambda y, at, n: F.aggregate(F.slice(y, at + F.lit(1), n), start, step)
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / width).cast("int") - 1), lambda k: part(x, k * width, width))
        heads = let(blocks, lambda b: F.transform(b, lambda _, k: part(b, F.lit(0), k)))

        def own(h: Column) -> Column:
            return F.transform(x, lambda _, i: step(F.get(h, F.floor(i / width).cast("int")), part(x, i - i % width, i % width)))

        return F.when(F.size(x) == 0, x).otherwise(let(heads, own))

    return let(values, before)


def matches(text: Column, pattern: str, kind: int, led: bool = False) -> Column:
    """All leftmost non-overlapping matches of a Java pattern, in order; led: without what its group 1 holds, which
    is their beginning.

    The text between matches (split) and the matches (extract) alternate, so their lengths give
    the places without any code outside the JVM. No pattern used here matches an empty text."""
    size = lambda c: F.char_length(c).cast("bigint")

    def spans(hits: Column, gaps: Column) -> Column:
        lengths = F.transform(hits, lambda x, i: size(x) + size(F.get(gaps, i)))

        def place(at: Column) -> Column:
            def span(x: Column, i: Column) -> Column:
                begin = F.get(at, i) + size(F.get(gaps, i))
                return F.struct(F.lit(kind).alias("kind"), begin.alias("start"), (begin + size(x)).alias("stop"), x.alias("hit"))

            return F.transform(hits, span)

        return let(running(lengths, lambda a, v: a + v), place).cast(SPANS)

    def own(found: Column) -> Column:
        """The spans without their leads."""
        def shorter(leads: Column) -> Column:
            def less(x: Column, i: Column) -> Column:
                n = size(F.get(leads, i))
                return F.struct(x["kind"].alias("kind"), (x["start"] + n).alias("start"), x["stop"].alias("stop"), F.substring(x["hit"], n.cast("int") + F.lit(1), F.lit(2**31 - 1)).alias("hit"))

            return F.transform(found, less)

        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), shorter).cast(SPANS)

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    some = lambda h: let(F.split(text, pattern, -1), lambda g: spans(h, g))
    return let(hits, lambda h: F.when(F.size(h) == 0, none()).otherwise(own(some(h)) if led else some(h)))


#: Code points of a block.
BLOCK = 4096


def blocks(text: Column) -> Column:
    """A text cut into blocks, from which pieces can be cut without walking the whole text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(parts: Column, start: Column, stop: Column) -> Column:
    """The code points from start to stop of a text given in blocks."""
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor(F.greatest(stop - 1, start) / BLOCK).cast("int")
    held = F.array_join(F.slice(parts, first + F.lit(1), last - first + F.lit(1)), "")
    return F.substring(held, (start - first * BLOCK).cast("int") + F.lit(1), F.greatest(stop - start, F.lit(0)).cast("int"))


def joined(found: Column, names: list[str]) -> Column:
    """kind:start:end, comma-joined."""
    labels = F.array(*map(F.lit, names))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.get(labels, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def count(found: Column) -> Column:
    return F.size(found).cast("bigint")
