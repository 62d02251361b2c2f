import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

from vetmill.llm import bpe, packing, queries


def bins_needed(items, capacity):
    """Fewest bins by exhaustive search over the fillings around the largest item."""
    if not items:
        return 0
    first, rest, best = items[0], items[1:], len(items)
    for n in range(len(rest), -1, -1):
        for other in combinations(range(len(rest)), n):
            if first + sum(rest[i] for i in other) <= capacity:
                left = [x for i, x in enumerate(rest) if i not in other]
                best = min(best, 1 + bins_needed(left, capacity))
    return best


def test_plans_are_whole_and_the_fewest():
    rng, better = random.Random(3), 0
    for _ in range(400):
        capacity = rng.choice([12, 20, 50])
        items = sorted((rng.randint(1, capacity) if rng.random() < 0.4 else rng.randint(capacity // 5, capacity // 2) for _ in range(rng.randint(1, 8))), reverse=True)
        plan, settled = packing.complete(dict(Counter(items)), capacity, None)
        used = Counter()
        for filling, bins in plan:
            assert sum(k * n for k, n in filling) <= capacity
            for k, n in filling:
                used[k] += n * bins
        assert used == Counter(items) and settled
        n = sum(b for _, b in plan)
        assert packing.lower_bound(Counter(items), capacity) <= n == bins_needed(items, capacity)
        better += n < sum(b for _, b in packing.best_fit(Counter(items), capacity))
    assert better > 0


def test_completion_beats_best_fit():
    bins = lambda p: sum(b for _, b in p)
    counts = Counter([11, 11, 11, 10, 9, 9, 8, 8, 7, 6, 5, 4])
    assert bins(packing.best_fit(counts, 20)) == 6
    plan, settled = packing.complete(counts, 20, packing.FILLINGS)
    assert bins(plan) == 5 and settled
    many = {k: 1000 * n for k, n in counts.items()}  # the work follows the lengths, not the rows
    assert packing.lower_bound(many, 20) <= bins(packing.complete(many, 20, packing.FILLINGS)[0]) <= bins(packing.best_fit(many, 20))


def test_many_parts_in_a_bin():
    plan, settled = packing.complete({2047: 5, 3: 1, 2: 1023}, 2048, packing.FILLINGS)
    assert sum(b for _, b in plan) == 7 and settled


def test_fillings_are_the_undominated_ones():
    """Against all subsets, with dominance by its definition."""
    from itertools import product

    rng = random.Random(8)
    for _ in range(60):
        space = rng.randint(4, 14)
        rest = {k: rng.randint(1, 3) for k in rng.sample(range(1, space + 1), min(4, space))}
        sizes, want = sorted(rest, reverse=True), []
        for times in product(*(range(rest[k] + 1) for k in sizes)):
            filling = [k for k, n in zip(sizes, times, strict=True) for _ in range(n)]
            waste = space - sum(filling)
            spare = [k for k, n in zip(sizes, times, strict=True) if n < rest[k]]
            parts = {c for n in range(len(filling) + 1) for c in combinations(filling, n)}
            if waste >= 0 and not any(sum(c) <= x <= sum(c) + waste and c != (x,) for c in parts for x in spare):
                want.append((waste, tuple((k, n) for k, n in zip(sizes, times, strict=True) if n)))
        got = [*packing.fillings(rest, space, space)]
        assert sorted(got) == sorted(want) and got == sorted(got, key=lambda x: (x[0], [(-k, -n) for k, n in x[1]]))
        for i, x in enumerate(got):
            assert [*packing.fillings(rest, space, space, x)] == got[i + 1 :]


def check(rows, docs, limit):
    codec, spots = bpe.codec(queries.tokenizer()).open(), defaultdict(list)
    for r in rows:
        spots[r.sequence_id].append((r.offset, r.length))
    for s in spots.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(n for _, n in s) <= limit
    want = Counter()
    for i, text in docs:
        ids = codec.encode(text) + b"\0\0\0\0"
        for k, at in enumerate(range(0, len(ids), 4 * limit)):
            part = ids[at : at + 4 * limit]
            want[i, k, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want


def test_documents(spark):
    docs = [(1, "a few words here"), (2, "word " * 5000), (3, None), (None, ""), (3, "again"), (3, "again"), (4, "x" * 9000)] + [(i, "the cat " * (i % 90)) for i in range(10, 200)]
    df = spark.createDataFrame([(i, t, "s", i) for i, t in docs], "doc_id long, text string, sequence_id string, piece long")
    rows = queries.packed(df).collect()
    check(rows, docs, queries.SEQUENCE)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // queries.SEQUENCE) + 1
    assert queries.packed(df.limit(0)).count() == 0


def test_exact_search_is_reached_through_pack(spark):
    counts = Counter([11, 11, 11, 10, 9, 9, 8, 8, 7, 6, 5, 4])
    rows = [(n, i, i % 3) for i, n in enumerate(counts.elements())]
    pieces = spark.createDataFrame(rows, "length long, id long, bucket int")
    bins = lambda most: packing.pack(pieces, 20, ["id"], 3, most).select("sequence_id").distinct().count()
    assert bins(None) == 5 and bins(0) == 6  # without a search best-fit stands
