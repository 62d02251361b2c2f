import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from vetmill.llm import collocations


def brute(rows, least, share=50, top=2000):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for d in (1, 2, 3):
                f[lang].update(tuple(ws[i : i + d]) for i in range(len(ws) - d + 1))
    out = []
    for lang, count in f.items():
        cands = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in cands.items():
            if len(g) == 2 and any(100 * b >= share * a for h, b in cands.items() if len(h) == 3 and g in (h[:2], h[1:])):
                continue
            score, k = min((1000000 * a * a // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), a, count[g[:k]], count[g[k:]]))
        for i, (score, _, phrase, a, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, phrase.decode(), a, left, right, total[lang], -score))
    return sorted(out)


def test_like_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "of", "a", "New", "new", "york", "é", "ß", "zz" * rng.randrange(1, 4), "\x1cx"])
    rows = [("".join(word() + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und"])) for _ in range(120)]
    rows += [("New York is big. new york!", "en")] * 7 + [(None, "en"), ("", None), ("...;;", "fr"), ("lonely", "es"), ("a " * 5000 + "b" * 3000, "en")]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "text string, lang string, a long, key string, n long")
    for least, top in ((2, 2000), (10, 3)):
        got = collocations.collocations(df, least=least, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, least, top=top)


def test_nothing(spark):
    assert not collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect()


@pytest.mark.parametrize("flush,vocab", [(7, 1 << 19), (1 << 19, 12), (1, 3), (1 << 19, 1 << 19)])
def test_windows_do_not_depend_on_where_a_task_hands_on(monkeypatch, flush, vocab):
    monkeypatch.setattr(collocations, "slices", lambda data, size=collocations.SLICE, f=collocations.slices: f(data, 9))
    rng = random.Random(1)
    texts = [("x", " ".join(rng.choice("abcdefghij.") * rng.randrange(1, 20) for _ in range(rng.randrange(50)))) for _ in range(9)] + [("y", "c d. e f"), ("x", None), ("y", "c d")]
    batch = pa.RecordBatch.from_pydict({"lang": [x for x, _ in texts], "text": [t and t.encode() for _, t in texts]})
    got = Counter()

    def emit(lang, words, a, starts):
        for w in zip(*collocations._leads(a, starts), strict=True):
            got[lang, *[words[i] if i else None for i in w]] += 1
        yield None

    list(collocations._batches([batch], emit, flush, vocab))
    want = Counter()
    for lang, text in texts:
        for piece in (text or "").split("."):
            ws = [*piece.encode().split(), None, None]
            want.update((lang, *ws[i : i + 3]) for i in range(len(ws) - 2))
    assert got == want


@pytest.mark.parametrize("least", [1, 2, 10, 15, 16, 40, 300])
def test_packed_hashes_are_counted_exactly(least):
    """Hashes with counts around every bound, handed on in several flushes, against plain counting."""
    import zlib

    import numpy as np

    rng = np.random.default_rng(least)
    few = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    few[20:] = few[:20] ^ np.uint64(1 << 30)  # the same bit of the bitmap, another hash
    flushes = [rng.choice(few, n) for n in (0, 1, 15 * 40, 40 * least, 7)] + [rng.integers(0, 1 << 63, 3000, dtype=np.uint64)]
    blobs = defaultdict(list)
    for keys in flushes:
        for parts, packed in collocations._packed(keys, least):
            for part, blob in zip(parts.to_pylist(), packed.to_pylist(), strict=True):
                blobs[part].append(blob)
    got = np.zeros(collocations.SLOTS // 8, np.uint8)
    for part, own in blobs.items():
        if bits := collocations._marked(own, least):
            got[part * 4096 : (part + 1) * 4096] = np.frombuffer(zlib.decompress(bits), np.uint8)
    count = Counter(int(k) & (1 << 40) - 1 for keys in flushes for k in keys)
    want = np.array(sorted({k & collocations.SLOTS - 1 for k, n in count.items() if n >= least}))
    assert np.array_equal(np.flatnonzero(np.unpackbits(got, bitorder="little")), want)


def test_cuts_meet_their_parts_in_stored_steps(spark):
    """One plan that joined both sides held 62 exchanges; each side is a plan of its own."""
    df = spark.createDataFrame([("new york is big. " * 12, "en")], "text string, lang string")
    plan = collocations.collocations(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 10
