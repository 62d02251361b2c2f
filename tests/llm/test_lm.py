import math
import zlib
from collections import Counter

import numpy as np
import pyspark.sql.functions as F

from vetmill.llm import lm, queries
from vetmill.llm.common import fold


def brute(word, probs):
    """Sum over all segmentations of the space and the word."""
    s, total = b" " + word, [1.0] + [0.0] * (len(word) + 1)
    for j in range(1, len(s) + 1):
        total[j] = sum(total[i] * probs.get(s[i:j], 0.0) for i in range(j))
    return total[-1]


def test_forward_and_expectations():
    names = [b" ", b" a", b"a", b"b", b"ab", b" ab", b"ba", b"c"]
    probs = dict(zip(names, [0.1, 0.2, 0.1, 0.15, 0.05, 0.1, 0.2, 0.1], strict=True))
    scores = [math.log(p) for p in probs.values()]
    lattice = lm.Lattice(names, [scores, scores])
    for words in ([b"a", b"b", b"c"], [b"abab", b"baba", b"aabc"]):
        want = [math.log(brute(w, probs)) for w in words]
        assert np.allclose(lattice.forward(words), [want, want])
        assert np.allclose([lattice.long(w, 1) for w in words], want)
    e = 1e-6  # expected counts are the derivative of the log probability by a piece's log score
    for k in range(len(names)):
        up = lm.Lattice(names, [s + e * (i == k) for i, s in enumerate(scores)])
        slope = (up.forward([b"abab"])[0, 0] - lattice.forward([b"abab"])[0, 0]) / e
        assert abs(lattice.expect([b"abab"], 0)[k] - slope) < 1e-4


def test_documents(spark):
    docs = [(i, f"the cat{i % 7} sat\ton THE mat {'x' * (i % 5)}", "en" if i % 3 else "de") for i in range(80)]
    docs += [(200, None, "en"), (201, "", None), (None, "the odd one", "fr"), (5, "the cat", "en"), (202, "z" * 5000 + " 日本 the", "de")]
    df = spark.createDataFrame([(i, t, g, "w", 1) for i, t, g in docs], "doc_id long, text string, lang string, word string, c0 int")
    got = lm.score_documents(df, fold(F.col("doc_id"), 7) == 2, queries.tokenizer(queries.BYTE_BPE), "lang").collect()
    away = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t, _ in docs if not away(i) for w in lm.tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), away(i), len(lm.tokens(t)), sum(c[w] > 0 for w in lm.tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in lm.tokens(t)), 6)) for i, t, _ in docs)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_score_like_brute_force(spark):
    """The whole model from its definition: lattices, words' own arcs, groups and their shares."""
    docs = [(i, ["the cat sat", "cat on the mat", "die katze", "das haus die maus " + "z" * 70][i % 4], "en" if i % 4 < 2 else "de") for i in range(24)]
    docs += [(100, "the katze ran", "xx"), (101, "", "en"), (102, "z" * 70 + " the", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    away, path = F.col("doc_id") >= 100, queries.tokenizer(queries.BYTE_BPE)
    got = {r.doc_id: r for r in lm.score_documents(df, away, path, "lang").collect()}
    groups = ["de", "en"]  # 12 documents each, in the order of their names; the rest has no share
    count = [Counter(w for i, t, g in docs if i < 100 and g == x for w in lm.tokens(t)) for x in groups] + [Counter()]
    every = sum(count, Counter())
    held = {w for _, t, _ in docs for w in lm.tokens(t)}
    vocab = spark.createDataFrame([(bytearray(w), *[c[w] for c in count]) for w in held], "word binary, c0 long, c1 long, c2 long")
    names, fitted = lm.fit(vocab, path, 3)
    models = [dict(zip(names, map(math.exp, x), strict=True)) for x in [*fitted, lm.pieces(path)[1]]]

    def lattice(word, probs):
        start = sum(p for k, p in probs.items() if k[:1] == b" ")
        end = 1e-3 * start
        return (brute(word, probs) * start if word else end) / (start + end)

    def token(word, c, probs):
        n, v = sum(c.values()), len(c)
        return (c[word] + max(v, 1) * lattice(word, probs)) / (n + max(v, 1))

    for i, text, _ in docs[-3:] + docs[:4]:
        parts, words = [], lm.tokens(text)
        for weight, c, probs in zip([lm.ALL, *[(1 - lm.ALL) / 2] * 2], [every, *count], models, strict=False):
            p = 1.0
            for w in words:
                own = token(w, c, probs)
                p *= own if c is every else lm.OWN * own + (1 - lm.OWN) * token(w, every, models[0])
            parts.append(weight * p)
        assert math.isclose(got[i].score, math.log10(sum(parts)), rel_tol=1e-6), i
        assert math.isclose(got[i].lattice_score, sum(math.log10(lattice(w, models[-1])) for w in words), rel_tol=1e-6), i


def test_probabilities_do_not_exceed_one(spark):
    """The distinct one-word texts of a small alphabet, and the empty text's end, stay within one."""
    docs = spark.createDataFrame([(i, "ab ba a") for i in range(20)], "doc_id long, text string")
    words = [a + b for a in ["", *"abc"] for b in "abc"]
    ask = docs.unionByName(spark.createDataFrame([(1000 + i, w) for i, w in enumerate([*words, ""])], "doc_id long, text string"))
    got = lm.score_documents(ask, F.col("doc_id") >= 1000, queries.tokenizer(queries.BYTE_BPE)).where("doc_id >= 1000").collect()
    p = {r.doc_id - 1000: 10**r.score for r in got}
    assert p[len(words)] + sum(p[i] for i in range(len(words))) <= 1 and p[words.index("ab")] > p[words.index("c")]


def test_beats_the_base_on_held_out_text(spark):
    rows = queries.op1_lattice(spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_empty(spark):
    path = queries.tokenizer(queries.BYTE_BPE)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(none, F.lit(False), path).count() == 0
    one = lm.score_documents(spark.createDataFrame([(1, "only held out")], "doc_id long, text string"), F.lit(True), path).first()
    assert one.train_tokens == 0 and one.n_known == 0 and one.base_score == 0 and math.isfinite(one.score)


def test_long_pieces_and_long_words_count(spark):
    names = [bytes([b]) for b in b" abcdefghijkl"] + [b" abcdefghijkl", b"bcdefghijklab"]
    probs = {p: 1 / len(names) for p in names}
    lattice = lm.Lattice(names, [math.log(p) for p in probs.values()])
    for word in (b"abcdefghijkl", b"abcdefghijklabcdefghijkl", b"abcdefghijkl" * 5):
        assert math.isclose(lattice.forward([word])[0, 0], math.log(brute(word, probs)))
        got = np.zeros(len(names))
        lattice.expect_long(word, 0, got)
        assert np.allclose(got, lattice.expect([word], 0))
    path = queries.tokenizer(queries.BYTE_BPE)
    assert b" government" in lm.pieces(path)[0]
    word = b"zq" * 30  # over SHORT
    fitted = [lm.fit(spark.createDataFrame([(bytearray(w), 1) for w in words], "word binary, c0 long"), path, 1)[1][0] for words in ([b"the"], [b"the", word])]
    at = lm.pieces(path)[0].index(b"z")
    assert fitted[1][at] > fitted[0][at]
