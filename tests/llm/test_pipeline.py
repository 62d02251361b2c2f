import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_minhash import brute
from vetmill.llm import minhash
from vetmill.llm.common import components

DOCUMENT, LABEL = "doc_id long, text string, lang string, source string, n_chars long, row string", "doc_id long, quality int, toxic int"


def written(spark, path, texts, toxic):
    rows = [(i, t, "en", "s", len(t or ""), "extra") for i, t in texts]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic], LABEL).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_run_like_brute_force(spark, tmp_path):
    """Whole texts through all stages: planted toxic documents, copies, near copies, personal data, a null, an empty and a
    very long text, held against a plain version that knows what was planted."""
    rng = random.Random(8)
    vocab = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "me", "no", "ra", "si") for b in ("l", "nd", "rt", "sk", "ve", "m")]
    said = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts, toxic = {i: said(rng.randint(20, 60)) for i in range(240)}, {}
    for i in range(0, 240, 4):
        texts[i], toxic[i] = f"{texts[i]}. You are a zorkan grumbel, you zorkan. {said(12)}", 1
    for i in range(1, 240, 12):  # near copies: a word more at the end
        texts[400 + i] = f"{texts[i]} {rng.choice(vocab)}"
    for i in range(2, 240, 12):
        texts[400 + i] = texts[i]
    for i in range(3, 240, 12):
        texts[400 + i] = f"{said(25)} ann{i}@mail.example.org {said(5)}"
    texts |= {700: None, 701: "", 702: said(40_000)}
    sf = written(spark, tmp_path, sorted(texts.items()), [(i, toxic.get(i, 0)) for i in texts if i < 240])

    left = [(i, t) for i, t in sorted(texts.items()) if i not in toxic]
    kept = {i for i, _, _, first in brute(left) if first}
    mail = lambda t: " ".join("[EMAIL]" if "@" in w else w for w in (t or "").split(" "))
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    want = {}
    for i, t in left:
        if i in kept:
            n = len(encode(mail(t), add_special_tokens=False).ids) + 1
            want |= {(i, k): min(2048, n - 2048 * k) for k in range(-(-n // 2048))}
    got = corpus_pipeline.run(spark, sf).collect()
    found = {(r.doc_id, r.piece): r.length for r in got}
    assert (sorted(found.items() - want.items()), sorted(want.items() - found.items())) == ([], []) and len(got) == len(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert all(at == sum(n for _, n in parts[:k]) for k, (at, _) in enumerate(parts)) and sum(n for _, n in parts) <= 2048
    assert len(places) == -(-sum(want.values()) // 2048)


def test_run_over_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [])).collect() == []


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() <= before
        before = docs.count()
        if name == "near_duplicates":
            assert minhash.near_duplicates(docs).where("not kept").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert pieces.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


def test_copies_with_odd_ids(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "A B C", "s"), (None, "a b c", "s"), (None, None, None), (3, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((repr(r.doc_id), r.text or "") for r in corpus_pipeline.drop_copies(spark, docs, "").collect())
    assert got == [("1", "a b c"), ("3", ""), ("None", ""), ("None", "a b c")]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_edges_that_are_stars_take_no_round(spark, monkeypatch):
    """A round over them, and one more to see that nothing changes, took four stored tables."""
    from vetmill.llm import common

    names, stored = [], common.table
    monkeypatch.setattr(common, "table", lambda df, name: names.append(name) or stored(df, name))
    for edges, rounds in (([(5, 1), (1, 7), (7, 1), (3, 3), (9, 8)], 0), ([(2, 1), (3, 2)], 1), ([(3, 1), (3, 2)], 1), ([], 0)):
        names.clear()
        got = {r.id: r.component_id for r in common.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        assert got == ({5: 1, 1: 1, 7: 1, 9: 8, 8: 8} if len(edges) == 5 else {1: 1, 2: 1, 3: 1} if edges else {})
        assert names == ["edges", *["large_star", "small_star"] * rounds]


def test_a_pair_is_given_once(spark):
    """An id and a hub with several rows of data each, in two chunks."""
    from vetmill.llm import minhash

    pairs = spark.createDataFrame([(1, 9, 0), (2, 9, 0), (3, 9, 1), (2, 8, 0)], "id long, hub long, chunk long")
    data = spark.createDataFrame([(1, b"x"), (1, b"x"), (1, b"y"), (2, b"z"), (2, b"x"), (3, b"q"), (9, b"x"), (9, b"y"), (8, b"z")], "id long, data binary")
    got = minhash._by_hub(pairs, data, lambda x, y: x == y)
    assert sorted(map(tuple, got.collect())) == [(1, 9, 0), (2, 8, 0), (2, 9, 0)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1  # that of the hubs


def test_hot_ids_of_a_round_are_computed_once(spark, monkeypatch):
    """A star of many edges around an id that is not its least; before, each plan found its hot ids twice."""
    from vetmill.llm import common

    plans, stored = [], common.table

    def table(df, name):
        if name.endswith("_star"):
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("TakeOrderedAndProject"))
        return stored(df, name)

    monkeypatch.setattr(common, "table", table)
    edges = [(1500, i) for i in range(3000)] + [(i, i + 3000) for i in range(0, 300, 3)]
    got = common.components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r.id: r.component_id for r in got} == {i: 0 for e in edges for i in e} and len(got) == 3100
    assert plans and max(plans) == 1


def test_hub_and_pairs_take_their_data_from_one_join(spark):
    from vetmill.llm import minhash

    pairs = spark.createDataFrame([(1, 9, 0), (2, 9, 1)], "id long, hub long, chunk long")
    data = spark.createDataFrame([(1, b"x"), (2, b"x"), (9, b"x")], "id long, data binary")
    got = minhash._by_hub(pairs, data, lambda x, y: x == y)
    assert sorted(map(tuple, got.collect())) == [(1, 9, 0), (2, 9, 1)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
