import random

import pytest

from vetmill.llm import common, minhash

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets(text):
    w = (text or "").encode().translate(LOW).split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs):
    s, parent = [sets(t) for _, t in docs], {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            inter = len(s[a] & s[b])
            if inter and 100 * inter >= 75 * len(s[a] | s[b]) and docs[a][0] is not None and docs[b][0] is not None:
                x, y = root(docs[a][0]), root(docs[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s[k]), None if i is None else root(i), i is None or root(i) == i) for k, (i, _) in enumerate(docs)), key=repr)


def run(spark, docs):
    df = spark.createDataFrame([(i, t, "r", 1) for i, t in docs], "doc_id long, text string, rep string, part int")
    return sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(120)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    for i in range(60, 220):  # one large group of near copies, some of them out of reach of its centre
        w = base[:]
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        docs.append((i, " ".join(w)))
    docs += [(300, "Same TEXT"), (301, "same text"), (302, "\t same\n text "), (303, ""), (304, None), (305, "   "), (None, "same text"), (306, docs[70][1]), (306, docs[70][1])]
    docs += [(307, "a b c d e f"), (308, "A b c d e g")]
    rng.shuffle(docs)
    assert run(spark, docs) == brute(docs)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(2, "one two"), (1, "one two")]])
def test_small_tables(spark, docs):
    assert run(spark, docs) == brute(docs)


def test_estimate_follows_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[500:2500])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    n = 1024
    assert abs((minhash.signature(a, n) == minhash.signature(b, n)).mean() - true) < 0.07


def tables(monkeypatch, spark, docs):
    """The result of run, and the stored tables by name."""
    kept, store = {}, common.table
    monkeypatch.setattr(common, "table", lambda df, name: kept.setdefault(name, store(df, name)))
    return run(spark, docs), kept


def variant(rng, words, n, new):
    w = words[:]
    for k in rng.sample(range(len(w)), n):
        w[k] = f"{new}x{k}"
    return " ".join(w)


def test_buckets_of_two_are_compared_once(spark, monkeypatch):
    rng = random.Random(7)
    docs = []
    for i in range(40):  # pairs that share a bucket and are no links
        words = [f"p{i}w{k}" for k in range(80)]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, variant(rng, words, 4, i))]
    found, kept = tables(monkeypatch, spark, docs)
    assert found == brute(docs)
    assert kept["buckets"].where("n = 2").count() > 20 and kept["open"].count() == 0


def test_pairs_of_many_small_buckets_are_dealt_over_chunks(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(80)]
    docs = [(0, " ".join(words))] + [(i, variant(rng, words, 4, i)) for i in range(1, 601)]
    found, kept = tables(monkeypatch, spark, docs)
    assert found == brute(docs)
    pairs = kept["pairs"].where("hub = 0")
    assert pairs.count() > 300 and max(r["count"] for r in pairs.groupBy("chunk").count().collect()) < 150


def test_only_pairs_with_like_bits_meet_their_hub(spark, monkeypatch):
    """Pairs that are alike to about 0.3 and share a bucket went through a join with sketches and a pass of Python before."""
    rng = random.Random(9)
    docs = []
    for i in range(300):
        words = [f"p{i}w{k}" for k in range(120)]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:56]) + " " + " ".join(f"q{i}w{k}" for k in range(64)))]
    for i in range(700, 760):  # links, near the least similarity of one
        words = [f"p{i}w{k}" for k in range(120)]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, variant(rng, words, 3, i))]
    found, kept = tables(monkeypatch, spark, docs)
    assert found == brute(docs)
    assert kept["buckets"].select("rep").where("rep < 600").distinct().count() > 20 and kept["pairs"].where("hub < 600").count() <= 2
    assert kept["pairs"].where("hub > 600").count() == 60


def test_bits_agree_by_similarity(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = []
    for both in (750, 857, 500):  # of 1,000 in each set: 0.6, 0.75 and a third
        x = np.unique(rng.integers(0, 2**63, 2000 - both).astype(np.uint64))
        rng.shuffle(x)
        rows.append((minhash._bits(minhash.signature(x[:1000])), minhash._bits(minhash.signature(x[-1000:]))))
    same = lambda a, b: 160 - sum(((x ^ y) % 2**64).bit_count() for x, y in zip(a, b, strict=True))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select("a", "b", minhash._alike("a", "b").alias("alike"))
    for r, similarity in zip(df.collect(), (0.6, 0.75, 1 / 3), strict=True):
        assert abs(same(r.a, r.b) / 160 - (1 + similarity) / 2) < 0.1 and r.alike == (same(r.a, r.b) >= minhash.AGREE_BITS)


def test_a_search_stores_few_tables(spark, monkeypatch):
    """Sketches, sets and components were stored once more before, and pairs of hubs and links twice."""
    rng, names, store = random.Random(10), [], common.table
    monkeypatch.setattr(common, "table", lambda df, name: names.append(name) or store(df, name))
    words = [f"w{k}" for k in range(80)]
    docs = [(i, variant(rng, words, rng.randint(0, 5), i)) for i in range(60)]
    docs += [(7, docs[9][1]), (7, docs[20][1] + " more"), (3, docs[30][1]), (3, "other words"), (3, "other words")]  # ids with several texts
    assert run(spark, docs) == brute(docs)
    assert [x for x in names if not x.endswith("_star")] == [
        "signatures", "reps", "counts", "buckets", "hubs", "pairs", "links", "open", "members", "rest", "to_verify", "more", "edges"]


def test_sets_are_made_once(spark):
    """Both joins of the verification take them from one exchange."""
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 2, 60))) for i in range(40)], "doc_id long, text string")
    pairs = common.table(spark.createDataFrame([(i, 0, 0) for i in range(2, 40)], "id long, hub long, chunk long"), "pairs")
    for broadcast in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            links = minhash._verified(pairs, docs)
            assert sorted(map(tuple, links.collect())) == [(i, 0) for i in range(2, 40)]
            plan = links._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("MapInArrow") == 2, plan  # the sets and the comparison


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_join(spark, how):
    left = spark.range(3000).selectExpr("if(id < 2000, 7, if(id < 2900, null, id)) as k", "id as x").repartition(3)
    right = left.where("k is not null and k < 2950").groupBy("k").agg({"x": "max", "*": "count"}).toDF("k", "m", "n").withColumnRenamed("count(1)", "n")
    right = right.selectExpr("k", "least(m, n) as low", "greatest(m, n) as n")
    joined = common.hot_join(left, right, "k", how)
    same = left.join(right, "k", how)
    assert joined.columns == same.columns
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, same.collect()), key=repr)
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("TakeOrderedAndProject") == 1
