import numpy as np

from vetmill.llm import curves, multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "c", 1) for i, v in rows], SCHEMA)


def vectors(n=300, d=16):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, d)).astype(np.float32)
    for k in range(0, 120, 3):
        x[k + 1] = x[k] + rng.normal(size=d) * 0.1
        x[k + 2] = x[k]
    x[200:230] = x[199] + rng.normal(size=(30, d)) * 0.15  # a dense group
    x[260] = x[250] * 3
    return x


ODD = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [float("inf")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, []), (906, [1.0] * 7)]


def brute_links(rows):
    usable = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    u = np.array([v / np.linalg.norm(v) for _, v in usable])
    hit = u @ u.T >= 0.9
    ids, parent = [i for i, _ in usable], {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in np.argwhere(hit):
        x, y = root(ids[a]), root(ids[b])
        parent[max(x, y)] = min(x, y)
    links = dict(zip(ids, hit.sum(1) - 1, strict=True))
    return {i: (int(links.get(i, 0)), root(i), root(i) == i) for i, _ in rows}


def test_links_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 16)
    rows = [*enumerate(vectors().tolist()), *ODD]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multi_index.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_links(rows)


def test_link_edge_cases(spark):
    got = multi_index.near_duplicates(frame(spark, [(3, [1, 0]), (3, [1, 0]), (5, [0, 1]), (None, [1, 0])])).collect()
    assert sorted((repr(r.vec_id), r.n_links, r.component_id, r.kept) for r in got) == [("3", 1, 3, True), ("3", 1, 3, True), ("5", 0, 5, True), ("None", 0, None, True)]
    assert multi_index.near_duplicates(frame(spark, [])).count() == 0
    assert [tuple(r) for r in multi_index.near_duplicates(frame(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_traversal_visits_cells_in_order():
    rng = np.random.default_rng(4)
    left, right = rng.random(12), rng.random(9)
    want = np.argsort((left[:, None] + right[None]).ravel(), kind="stable").tolist()
    assert multi_index.traverse(left, right, 108) == want and multi_index.traverse(left, right, 20) == want[:20]


def test_hilbert_is_a_path(monkeypatch):
    monkeypatch.setattr(curves, "BITS", 3)
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 2, indexing="ij"), -1).reshape(-1, 2)
    key = curves.hilbert(grid)
    assert sorted(key) == list(range(64))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def check_nearest(got, rows, least):
    usable = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in usable]), np.array([v for _, v in usable])
    by, hit, all_ = {}, 0, 0
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {i for i in ids if i % 20 == 0}
    for q, out in by.items():
        out.sort(key=lambda r: r.rank)
        s = x @ x[list(ids).index(q)]
        assert [r.rank for r in out] == list(range(1, len(out) + 1)) and all(abs(r.score - s[list(ids).index(r.vec_id)]) < 1e-9 for r in out)
        assert [(r.score, -r.vec_id) for r in out] == sorted([(r.score, -r.vec_id) for r in out], reverse=True)
        s[ids == q] = -np.inf
        want = [ids[i] for i in np.lexsort((ids, -s))[: min(20, (ids != q).sum())]]
        hit, all_ = hit + len({r.vec_id for r in out} & set(want)), all_ + len(want)
    assert hit >= least * all_


def test_nearest_like_brute_force(spark, monkeypatch):
    rows = [*enumerate(vectors().tolist()), *ODD]
    check_nearest(curves.nearest(frame(spark, rows)).collect(), rows, 1.0)  # one block: all of them
    monkeypatch.setattr(curves, "BLOCK", 24)
    monkeypatch.setattr(curves, "CHUNK", 4)
    monkeypatch.setattr(curves, "SEGMENT", 3)
    check_nearest(curves.nearest(frame(spark, rows)).collect(), rows, 0.9)


def test_nearest_edge_cases(spark):
    got = curves.nearest(frame(spark, [(0, [1, 0]), *[(i, [1, 0]) for i in range(41, 80)], (7, [0, 1]), (None, [1, 0])])).collect()
    ranks = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0]
    assert ranks == list(range(41, 61)) and {r.query_id for r in got} == {0, 60}
    assert curves.nearest(frame(spark, [])).count() == 0 and curves.nearest(frame(spark, [(0, [1, 0])])).count() == 0
    assert curves.nearest(frame(spark, [(1, [1, 0]), (2, [1, 1])])).count() == 0


def test_rare_links_of_a_large_table_are_reached(spark, monkeypatch):
    """The probes see no link here, and the number of visits must still reach links close to 0.9."""
    monkeypatch.setattr(multi_index, "PROBES", 1)
    monkeypatch.setattr(multi_index, "LEAST_VISITS", 1)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = rng.normal(size=(200, 64))
    turn -= (turn * x[:200]).sum(1, keepdims=True) * x[:200]
    y = 0.905 * x[:200] + (1 - 0.905**2) ** 0.5 * turn / np.linalg.norm(turn, axis=1, keepdims=True)
    rows = multi_index.near_duplicates(frame(spark, enumerate([*x.tolist(), *y.tolist()])))
    assert rows.where("n_links = 1 and vec_id < 200").count() >= 194


def test_repeated_rows_count_on_their_own(spark):
    """25 equal rows of one query's id do not fill the places of another row with the same vector."""
    v = [1.0, 2.0, 3.0]
    rows = [(0, v)] * 25 + [(7, v), (9, [3.0, 2.0, 1.0])] + [(9, [3.0, 2.0, 1.0])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in curves.nearest(df).collect())
    assert got == sorted([(0, 1, 7), (0, 2, 9), (0, 3, 9), (0, 4, 9)] * 25)
    few = spark.createDataFrame([(20, v)] + [(i, v) for i in range(1, 4)] * 30, "vec_id long, embedding array<double>")
    assert sorted((r["rank"], r.vec_id) for r in curves.nearest(few).collect()) == [(i + 1, 1) for i in range(20)]
    assert curves.nearest(df.limit(0)).count() == 0 and multi_index.near_duplicates(df.limit(0)).count() == 0
