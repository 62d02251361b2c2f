"""Best-fit packing of token pieces by bin completion on the histogram of lengths.

Lengths are whole numbers up to the capacity, so the histogram has at most `capacity` entries
whatever the corpus holds; only it reaches the driver. Bin completion goes bin by bin: around the
largest length left it enumerates the undominated fillings, least waste first, and branches over
them and over how many bins get one. The waste that a packing of one bin less than the incumbent may
have in all bounds every branch. Best-fit decreasing is the first incumbent, each better packing the
next; the search ends at the lower bound or when no branch is left. Spark then gives each piece its
place: its rank among the pieces of its length picks the bin and the offset.
"""

from __future__ import annotations

import bisect
import logging
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetmill.llm import common

#: Fillings that the search may set before it settles for the incumbent; None searches to the end.
FILLINGS = 3000
Filling = tuple[tuple[int, int], ...]  # (length, times), longest first


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on a histogram: the largest length that fits, again and again. Fillings
    with the number of bins that have them."""
    rest = {k: n for k, n in counts.items() if n > 0}
    sizes, out = sorted(rest), []
    while sizes:
        space, chosen, i = capacity, {}, len(sizes)
        while i:
            k = sizes[i - 1]
            if n := min(rest[k], space // k):
                chosen[k] = n
                space -= k * n
            i = min(i - 1, bisect.bisect_right(sizes, space))
        times = min(rest[k] // n for k, n in chosen.items())
        for k, n in chosen.items():
            rest[k] -= n * times
            if not rest[k]:
                sizes.pop(bisect.bisect_left(sizes, k))
        out.append((tuple(chosen.items()), times))
    return out


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for each k, lengths over capacity - k have bins of their own, those
    over half as well, and lengths from k to half fill what the latter leave."""
    sizes = sorted(k for k, n in counts.items() if n > 0)
    best = -(-sum(k * counts[k] for k in sizes) // capacity)
    for k in {0, *(x for x in sizes if 2 * x <= capacity)}:
        alone = sum(counts[x] for x in sizes if x > capacity - k)
        half = [x for x in sizes if capacity < 2 * x and x <= capacity - k]
        free = sum((capacity - x) * counts[x] for x in half)
        small = sum(x * counts[x] for x in sizes if k <= x and 2 * x <= capacity)
        best = max(best, alone + sum(counts[x] for x in half) + max(0, -(-(small - free) // capacity)))
    return best


def fillings(rest: dict[int, int], space: int, waste: int, after: tuple[int, Filling] | None = None) -> Iterator[tuple[int, Filling]]:
    """Undominated fillings of a space with at most so much waste, as (waste, filling): least waste
    first, then longest lengths first; only those behind `after` in that order.

    A filling is dominated if a length left over could take the place of some of its parts that are
    together no longer (or of none) and still fit: what those parts leave fits wherever it was."""
    sizes = sorted(k for k, n in rest.items() if n > 0 and k <= space)
    reach = [1]  # bit t: t is a sum of the first sizes
    for k in sizes:
        bits, n, step = reach[-1], min(rest[k], space // k), 1
        while n > 0:
            bits |= bits << k * min(step, n)
            n -= step
            step *= 2
        reach.append(bits & (1 << space + 1) - 1)
    left = sum(1 << k for k in sizes)

    def exact(i: int, total: int, behind: Filling | None) -> Iterator[Filling]:
        """Sums of the first i sizes to total, those behind a filling only."""
        if not total:
            if behind is None:
                yield ()
            return
        for at in range(bisect.bisect_right(sizes, total, 0, i) - 1, -1, -1):
            k = sizes[at]
            if behind and k > behind[0][0]:
                continue
            for n in range(min(rest[k], total // k), 0, -1):
                if reach[at] >> total - n * k & 1:
                    if behind and (k, n) > behind[0]:
                        continue
                    own = behind[1:] if behind and (k, n) == behind[0] else None
                    for more in exact(at, total - n * k, own):
                        yield ((k, n), *more)

    for w in range(after[0] if after else 0, min(waste, space) + 1):
        if not reach[-1] >> space - w & 1:
            continue
        for filling in exact(len(sizes), space - w, after[1] if after and w == after[0] else None):
            one, two, free = 0, 0, left  # sums of one part at least, of two at least; lengths left
            for k, n in filling:
                for _ in range(n):
                    two |= two << k | one << k
                    one |= one << k | 1 << k
                if n == rest[k]:
                    free ^= 1 << k
            if free & (1 << w + 1) - 2 or two & free or any(one << d & free for d in range(1, w + 1)):
                continue
            yield w, filling


def complete(counts: dict[int, int], capacity: int, most: int | None) -> tuple[list[tuple[Filling, int]], bool]:
    """Fillings with the number of bins that have them, and whether no packing has fewer bins.

    Bins around one length come in the order of `fillings`, so that no set of bins is tried twice. The
    search sets at most `most` fillings (None: as many as there are); what it has not settled by then is
    logged, and the incumbent, which is never worse than best-fit decreasing, stands."""
    best = best_fit(counts, capacity)
    bins, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    if bins == bound:
        return best, True
    rest = {k: n for k, n in counts.items() if n > 0}
    total, tried = sum(k * n for k, n in rest.items()), 0
    # a bin kind that is set: its longest length, (waste, filling) of the rest, its bins, all waste before it
    path: list[tuple[int, tuple[int, Filling], int, int]] = []

    def take(top: int, filling: Filling, times: int) -> None:
        for k, n in ((top, 1), *filling):
            rest[k] = rest.get(k, 0) - n * times
            if not rest[k]:
                del rest[k]

    wasted, after, retry = 0, None, None
    while True:
        allowed = (bins - 1) * capacity - total - wasted
        choice = None
        if retry:  # the same filling in one bin less
            top, filling, times = retry
            choice = (filling, times)
        elif rest:
            top = max(rest)
            take(top, (), 1)
            got = next(fillings(rest, capacity - top, allowed, after), None)
            take(top, (), -1)
            if got:
                parts = dict(got[1])
                parts[top] = parts.get(top, 0) + 1
                times = min(rest[k] // n for k, n in parts.items())
                choice = (got, min(times, allowed // got[0]) if got[0] else times)
        if choice:
            tried += 1
            if most is not None and tried > most:
                break
            got, times = choice
            path.append((top, got, times, wasted))
            take(top, got[1], times)
            wasted += got[0] * times
            retry, after = None, got if max(rest, default=0) == top else None
            if not rest:
                found: dict[Filling, int] = {}
                for k, (_, filling), n, _ in path:
                    parts = dict(filling)
                    parts[k] = parts.get(k, 0) + 1
                    key = tuple(sorted(parts.items(), reverse=True))
                    found[key] = found.get(key, 0) + n
                if sum(found.values()) < bins:
                    best, bins = list(found.items()), sum(found.values())
                if bins == bound:
                    return best, True
            else:
                continue
        if not path:
            return best, True
        top, got, times, wasted = path.pop()
        take(top, got[1], -times)
        retry, after = ((top, got, times - 1), None) if times > 1 else (None, got)
    logging.getLogger(__name__).warning("packing: %d sequences, at least %d are needed; not settled after %d fillings", bins, bound, most)
    return best, False


def layout(plan) -> dict[str, list[int]]:
    """For each length, runs of ranks: from `rank` on, `times` pieces a bin from bin `first` at `base`."""
    rows, first, used = [], 0, {}
    for chosen, bins in plan:
        base = 0
        for k, n in chosen:
            at = used.get(k, 0)
            rows.append((k, at, first, n, base))
            used[k] = at + n * bins
            base += n * k
        first += bins
    rows.sort()
    return dict(zip(("length", "rank", "first", "times", "base"), map(list, zip(*rows, strict=True)), strict=True)) if rows else {}


def pack(pieces: DataFrame, capacity: int, order: list[str], buckets: int, most: int | None = FILLINGS) -> DataFrame:
    """Give every row (length in 1..capacity; bucket in 0..buckets-1) a sequence_id and an offset.

    most: fillings that the search may set before it settles for its best packing; None searches until no packing
    can have fewer sequences, whatever the time.

    pieces must be a stored table: it is read for the histogram, for the ranks and for the result.
    Ranks are taken in (length, bucket) groups and moved by the groups before, so that a length
    that a third of the rows share is spread over `buckets` groups. Equal rows get places of their
    own. An empty table gives an empty result; other columns than length, bucket and those of `order` are
    carried along, sequence_id and offset must not be among them."""
    import numpy as np

    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    sizes = common.table(sizes, "lengths")  # at most capacity * buckets rows
    hist = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n")).collect()}
    runs = layout(complete(hist, capacity, most)[0])
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = (pieces.withColumn("_row", F.row_number().over(own))
              .join(sizes, ["length", "bucket"])
              .withColumn("_rank", F.col("before") + F.col("_row") - 1)
              .drop("before", "_row", "bucket"))
    key = np.array(runs.get("length", []), dtype=np.int64) << 44 | np.array(runs.get("rank", []), dtype=np.int64)
    table = {k: np.array(v, dtype=np.int64) for k, v in runs.items()}

    def place(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            length, rank = b["length"].to_numpy(zero_copy_only=False), b["_rank"].to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, length << 44 | rank, side="right") - 1
            at, times = rank - table["rank"][i], table["times"][i]
            own = [n for n in b.schema.names if n != "_rank"]
            more = [pa.array(table["first"][i] + at // times), pa.array(table["base"][i] + at % times * length)]
            yield pa.RecordBatch.from_arrays([*(b[n] for n in own), *more], names=[*own, "sequence_id", "offset"])

    kept = [f for f in ranked.schema.fields if f.name != "_rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
