import hashlib
import struct

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vetmill.llm import bpe
from vetmill.llm.queries import tokenizer

DOCS = "doc_id long, text string, doc string, ids int"


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    return bpe.codec(tokenizer()).open(), Tokenizer.from_file(tokenizer())


def same(both, text):
    codec, library = both
    ids = codec.encode(text)
    want = library.encode(text or "", add_special_tokens=False).ids
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
    assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aabtheno 'sσΣßéİıſ1٣²½\n\t　​.,!-<|>中文😀ﬀǅ", "<|endoftext|>", "x" * 40]), max_size=30))
def test_like_the_library(both, parts):
    same(both, "".join(parts))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=20))
def test_any_text(both, text):
    same(both, text.encode("utf-8", "ignore").decode())


def test_real_and_odd_texts(both):
    for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist():
        same(both, t)
    for t in (None, "", " ", "a" * 3000, "ab" * 2000 + "é", "<|startoftext|>", "don't WE'LL"):
        same(both, t)


def test_automaton_is_compiled():
    codec = bpe.codec(tokenizer())
    a = codec.automaton
    assert a.states == 11612 and a.transitions == 483_840_410 and a.table.nbytes < 25_000_000
    assert all(a.row[i] >= 0 and a.column[i] >= 0 for i in codec.label if i not in codec.special.values())


def test_small_automaton_accepts_what_merging_makes():
    """All sequences of tokens over words of two letters, against plain merging."""
    from itertools import product

    texts = ["a", "b", "ab", "aa", "aab", "abb", "bab", "aaaa"]
    merges = [(0, 1, 2), (0, 0, 3), (0, 2, 4), (2, 1, 5), (1, 2, 6), (3, 3, 7)]
    automaton = bpe.Automaton([0, 1], merges, 8)

    def plain(word):
        ids = [texts.index(c) for c in word]
        for u, v, w in merges:
            out = []
            for t in ids:
                if out and out[-1] == u and t == v:
                    out[-1] = w
                else:
                    out.append(t)
            ids = out
        return ids

    right = {tuple(plain("".join(w))) for n in range(1, 9) for w in product("ab", repeat=n)}
    for n in range(1, 4):
        for seq in product(range(8), repeat=n):
            if len("".join(texts[t] for t in seq)) <= 8:
                assert (seq in right) == all(automaton.step(a, b) for a, b in zip(seq, seq[1:])), seq


def test_rows(spark, both):
    rows = [(1, "Hello world", "x", 1), (None, None, None, None), (1, "Hello world", "x", 1), (2, "", "y", 2)]
    got = bpe.encode_digests(spark.createDataFrame(rows, DOCS), tokenizer()).collect()
    assert sorted((r.n_tokens for r in got)) == [0, 0, 2, 2]
    empty = [r for r in got if r.n_tokens == 0]
    assert {r.ids_sha256 for r in empty} == {hashlib.sha256(b"").hexdigest()} and {r.doc_id for r in empty} == {None, 2}
    assert bpe.encode_digests(spark.createDataFrame([], DOCS), tokenizer()).count() == 0
    out = {r.doc_id: r for r in bpe.encode_documents(spark.createDataFrame(rows[:2], DOCS), tokenizer()).collect()}
    assert out[1].decoded == "hello</w> world</w>" and out[None].ids == b""


def test_words_side_by_side_are_encoded_as_alone():
    """Words of all lengths, more than go through the automaton at a time, through encode_all and a full memo."""
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice(["the", "an", "on", "q", "é", "ß", "中", "x" * 9]) for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    codec, alone = bpe.codec(tokenizer()).open(), bpe.codec(tokenizer()).open()
    want = [struct.pack(f"<{len(ids)}I", *ids) for ids in map(alone.encode_word, words)]
    assert codec.encode_words(words) == want and codec.encode_words([]) == []
    texts = [*(" ".join(rng.choices(words, k=9)) + rng.choice([".", "!?", " <|endoftext|> it's", "", " x" + "y" * 50]) for _ in range(40)), None, "", "\r<|endoftext|>\n"]
    want = [alone.encode(t) for t in texts]
    assert codec.encode_all(texts) == want and codec.encode_all(texts[::-1]) == want[::-1]


def test_a_full_memo_and_few_words_abreast(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 3)
    monkeypatch.setattr(bpe, "ABREAST", 2)
    alone, codec = bpe.codec(tokenizer()).open(), bpe.codec(tokenizer()).open()
    texts = ["one two, three four", "five SIX seven eight", "one nine's <|startoftext|> 10 two"]
    assert codec.encode_all(texts) == [alone.encode(t) for t in texts] == codec.encode_all(texts)
