import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vetmill.llm import langid
from vetmill.llm.common import fold
from vetmill.llm.queries import MANY_BPE, op13_language, tokenizer

NAMES = [b" ", b"a", b"b", b"ab", b" a", b"ba", b" ab", b"bab"]


def ways(word):
    """All segmentations."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in NAMES:
            for rest in ways(word[n:]):
                yield (NAMES.index(word[:n]), *rest)


@pytest.mark.parametrize("short", [40, 2])
def test_sums_over_all_segmentations(monkeypatch, short):
    monkeypatch.setattr(langid, "SHORT", short)
    p = np.random.default_rng(1).dirichlet(np.ones(len(NAMES)), 2)
    model = langid.Segments(NAMES, p)
    words, weights = [b"a", b"abab", b"babab", b"bb", b"abba"], np.array([1.0, 3, 2, 5, 1])
    got = model.log_probability(words)
    for z in range(2):
        out, want = np.zeros(len(NAMES)), np.zeros(len(NAMES))
        model.expected(words, weights, z, out)
        for i, (w, n) in enumerate(zip(words, weights)):
            each = [(s, math.prod(p[z, k] for k in s)) for s in ways(b" " + w)]
            total = sum(x for _, x in each)
            assert math.isclose(got[z, i], math.log(total))
            for s, x in each:
                np.add.at(want, list(s), n * x / total)
        assert np.allclose(out, want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = op13_language(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert right >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    texts = ["the cat and the dog are in the house", "le chat et le chien sont dans la maison"]
    rows = [(i, texts[i % 2], ["en", "fr"][i % 2]) for i in range(40)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 345 - ½ ²", "en"), (103, "The Dog" * 30_000, None), (103, "The Dog" * 30_000, None), (None, "la maison et le chien", None), (104, "猫", "fr")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, lang_pred string, score string")
    model = langid.train(docs, fold(F.col("doc_id"), 4) == 2, tokenizer(MANY_BPE))
    assert model[0] == ["en", "fr"]
    got = langid.predict(docs, model, ["doc_id"]).collect()
    assert len(got) == len(rows)
    said = {}
    for r in got:
        said.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert all(said[i][0][0] == ["en", "fr"][i % 2] for i in range(40))
    assert said[100] == said[101] == said[102] == [("und", 0.0)]
    assert [x for x, _ in said[103]] == ["en", "en"] and said[None][0][0] == "fr" and said[104][0][0] in ("en", "fr")
    none = langid.train(docs.where("false"), F.lit(False), tokenizer(MANY_BPE))
    assert {r.lang_pred for r in langid.predict(docs, none, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model, ["doc_id"]).collect() == []


def test_slices_end_between_words(monkeypatch):
    text = "Wörter und Wort, 12 x2y Straße " * 9
    whole = langid.words(text)
    monkeypatch.setattr(langid, "SLICE", 7)
    assert langid.words(text) == whole and whole["straße"] == 9
