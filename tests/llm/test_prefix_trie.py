import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from vetmill.llm import prefix_trie

DDL = "conv_id long, turn long, role string, text string, key string, depth int, n long"


def brute(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[c].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in said.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:]) if c % 5 else tuple(own[c])
    members = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out, total = [], {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        total[p] = (sum(total[k][0] for k in kids[p]) or 1, saved + sum(total[k][1] for k in kids[p]))
        ends = ",".join(str(c) for c in sorted(members[p]) if whole[c] == p)
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    df = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_small_conversations(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["a", "bé", "a"]) if t < 3 else f"x{rng.randrange(4)}")
            for c in range(60) if c % 7 for t in range(rng.randrange(1, 12))]
    rows += [(-3, 0, "user", "minus"), (100, None, None, None), (100, None, None, None), (100, 5, "user", "same"), (100, 5, "user", "other"), (101, 5, "user", "own"), (None, 1, "user", "nobody")]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_long_conversation_and_prefixes_of_each_other(spark):
    rows = [(5, t, "user", "t" * (t % 50)) for t in range(900)]
    rows += [(10 * c + 10, t, "user", f"p{t}") for c in range(25) for t in range(c + 1)]
    rows += [(1000 + 5 * c, 0, "user", f"star{c}") for c in range(150)]
    assert found(spark, rows) == brute(rows)


def test_nothing(spark):
    assert found(spark, []) == [] and found(spark, [(None, 0, "user", "x")]) == []


@pytest.mark.parametrize("width", [2, 64])
def test_contraction(spark, monkeypatch, width):
    """Random trees named by (conv_id, depth), chains and combs among them, with small blocks: many rounds."""
    monkeypatch.setattr(prefix_trie, "WIDTH", width)
    rng, paths = random.Random(width), [[(0, 0)] + [(0, d) for d in range(1, 200)]]
    for c in range(1, 60):
        at = rng.choice(rng.choice(paths))
        paths.append([(c, d) for d in range(at[1] + 1, at[1] + rng.choice([2, 3, 40]))])
        paths[-1].insert(0, at)
    nodes = {p[0]: None for p in paths[:1]} | {x: y for p in paths for y, x in zip(p, p[1:])}
    saved = {x: rng.randrange(9) for x in nodes}
    kids = defaultdict(list)
    for x, y in nodes.items():
        if y:
            kids[y].append(x)
    total = {}
    for x in sorted(nodes, key=lambda x: x[1], reverse=True):
        total[x] = (sum(total[k][0] for k in kids[x]) or 1, saved[x] + sum(total[k][1] for k in kids[x]))
    df = spark.createDataFrame([(*x, y and y[0], y and y[1], len(kids[x]), saved[x]) for x, y in nodes.items()],
                               "conv_id long, depth long, parent_conv_id long, parent_depth long, n_children long, saved long")
    assert {(r.conv_id, r.depth): (r.n_leaves, r.saved_tokens) for r in prefix_trie.contract(df).collect()} == total
