import random
import zlib

import pyspark.sql.functions as F

from vetmill.llm import queries, toxicity


def test_context_changes_weights():
    g = toxicity.Grammar(toxicity.Model({"idiot": 4.0, "said": 9.0}, {"moro": 3.0}))
    total = lambda t: sum(g.clauses(t)[0])
    assert total("an idiot") == 4.0 and total("MORONS") == 3.0 and total("nothing here") == total("mor") == 0
    assert total("you idiot") > total("an idiot") > total("he said idiot") > 0
    assert total("not an idiot") < total("an idiot")
    assert total("not here. an idiot") == total("an idiot")  # a clause ends the scope
    assert total("I will kill you") == toxicity.THREAT_WEIGHT and total("you will see") == 0 and total("kill time") == 0
    assert total("said") == 0  # a context word is no insult, whatever was learned
    assert len(g.clauses("idiot. fine. moron")[0]) == 2


def test_clauses_like_brute_force():
    """Every pattern's weight from its definition: what stands how far before it in its clause."""
    weights = {"idiot": 4.0, "fool": 2.5}
    g, rng = toxicity.Grammar(toxicity.Model(weights)), random.Random(4)
    bag = "idiot fool you they not never said wrote will must kill hurt house tree . \n".split(" ")

    def back(clause, i, kinds):
        """The nearest word before i of these kinds, and how far away it is."""
        for k in range(1, i + 1):
            if clause[i - k] in kinds:
                return clause[i - k], k
        return None, 99

    def brute(tokens):
        out, clause = [], []
        for t in [*tokens, "."]:
            if t not in (".", "\n"):
                clause.append(t)
                continue
            total, acts = 0.0, toxicity.MODALS | toxicity.THREATS
            for i, w in enumerate(clause):
                factor = toxicity.FACTORS["negated"] if back(clause, i, toxicity.NEGATIONS)[1] <= 3 else 1.0
                factor *= toxicity.FACTORS["reported"] if back(clause, i, toxicity.REPORTS)[0] else 1.0
                if w in weights:
                    total += weights[w] * factor * (toxicity.FACTORS["targeted"] if back(clause, i, toxicity.TARGETS)[1] <= 4 else 1.0)
                if w in toxicity.TARGETS:
                    verb, far = back(clause, i, acts)
                    modal, near = back(clause, i - far, acts) if verb in toxicity.THREATS and far <= 3 else (None, 99)
                    total += toxicity.THREAT_WEIGHT * factor if modal in toxicity.MODALS and near <= 3 else 0.0
            out += [total] * (total > 0)
            clause = []
        return out

    hits = 0
    for _ in range(3000):
        tokens = [rng.choice(bag) for _ in range(rng.randint(1, 25))]
        got, want = g.clauses(" ".join(tokens))[0], brute(tokens)
        assert len(got) == len(want) and all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True)), tokens
        hits += len(want)
    assert hits > 2000


def test_stems_need_different_words(spark):
    rows = [(i, ["trash", "moron"][i % 2] + f" réeux{'abcdefgh'[i // 2 % 8]}" if i % 2 else "good travel more path", i % 2) for i in range(200)]
    model = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert "moron" in model.words and set(model.stems) == {"réeux"}
    g = toxicity.Grammar(model)
    assert not any(sum(g.clauses(w)[0]) for w in ("travel", "more", "path", "mor", "morning"))


def test_repeated_ids_are_one_labelled_row(spark):
    docs = spark.createDataFrame([(i % 2, "idiot" if i % 2 else "fine") for i in range(3000)], "doc_id long, text string")
    seen = []
    fit = toxicity.fit
    try:
        toxicity.fit = lambda sample, model: seen.append(sample.count()) or fit(sample, model)
        toxicity.train(docs, spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int"), F.lit(False))
    finally:
        toxicity.fit = fit
    assert seen == [2]


def test_held_out_accuracy(spark):
    got = queries.op2_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    away = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in away) / len(away) > 0.93
    assert not any(r.predicted and not r.toxic for r in away)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, "you idiot" if i % 3 == 0 else "good day", 0.0, "x") for i in range(60)] + [(100, None, 1.0, "x"), (None, "idiot", 1.0, None), (101, "", 1.0, "x")], "doc_id long, text string, score double, feature string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(0, None), (None, 1), (100, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(False))
    assert "idiot" in model.words
    got = {r.doc_id: r for r in toxicity.score(docs, model, ["doc_id", "feature"]).collect()}
    assert len(got) == 63 and got[None].predicted == 1 and got[0].predicted == 1 and got[1].predicted == 0 and got[100].predicted == got[101].predicted == 0
    none = toxicity.train(docs, labels.limit(0), F.lit(False))
    assert none == toxicity.Model() and {r.score for r in toxicity.score(docs, none, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0
    long = spark.createDataFrame([(1, "good day " * 200_000 + "you idiot"), (2, "good day " * 200_000), (2, "good day " * 200_000)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_clauses) for r in toxicity.score(long, model, ["doc_id"]).collect()) == [(1, 1), (2, 0), (2, 0)]
