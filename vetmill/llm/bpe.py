"""Byte-pair encoding and decoding by a tokenization automaton.

The merges of an existing tokenizer are compiled on the driver, in their order, into a deterministic
automaton over tokens whose paths are exactly the right token sequences. It starts as one state with
a loop for each base symbol. The gadget of a merge (u, v) -> w then

* gives the label w to every state that has u, leading to the state that v leads to;
* copies the state that u leads to, if other labels lead there as well, and takes v out of the copy.

All transitions of one label lead to one state, so the automaton is a table of states by labels;
labels that the same states have share a column until a gadget parts them. With the packed table
goes a matching automaton over bytes (a trie of the labels with failure links). Both are arrays,
sent to the workers once.

A pre-split word is read byte by byte: the matching automaton names the labels that end there,
longest first, and the one whose transition exists from the label before it is the last token of
what has been read. Nothing is taken back. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
import zlib
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetmill.llm import common

#: Bounds of a task's memo of words: entries, and characters of an entry. It is emptied when full,
#: which changes no result.
WORDS, WORD = 250_000, 32
#: Characters of texts that a task encodes before it hands rows on; characters of texts that are encoded together
#: (a longer text is alone), and words that go through the automaton side by side.
FLUSH, TOGETHER, ABREAST = 4_000_000, 1_000_000, 8192
#: Words are held as one character for each byte; this one stands for the end of a word.
END = "\u0100"
#: Marks a special token among normalized words, which hold no white space.
SPECIAL = "\r"
#: Bits of a symbol in the keys of the matching automaton's arcs.
SYMBOL = 9
#: Characters for which `regex`, Python and the tokenizers library agree on classes and lower case.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ſ‐-‧€]*")


def _byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Automaton:
    """Compiled from the merges (pairs of token ids with the id they make, in merge order).

    row[t]: the state that label t leads to; column[t]: the labels that the same states have; bit
    column of table[row]: whether the transition is there."""

    def __init__(self, base: list[int], merges: list[tuple[int, int, int]], size: int):
        import numpy as np

        row, column = [-1] * size, [-1] * size
        for t in base:
            row[t] = column[t] = 0
        # how many labels lead to a state, and share a column
        to, of, rows, columns = [len(base)], [len(base)], 1, 1
        table = np.zeros((1 << 14, 1 << 11), np.uint8)  # a bit for each transition
        table[0, 0] = 1
        for u, v, w in merges:
            if row[u] < 0 or row[v] < 0 or not table[row[u], column[v] >> 3] >> (column[v] & 7) & 1:
                continue  # u is never followed by v here, so no word has w
            row[w] = row[v]
            to[row[v]] += 1
            if to[row[u]] > 1:
                if rows == len(table):
                    table = np.concatenate([table, np.zeros((1 << 12, table.shape[1]), np.uint8)])
                table[rows] = table[row[u]]
                to[row[u]] -= 1
                row[u] = rows
                rows += 1
                to.append(1)
            if of[column[v]] > 1:
                if columns == 8 * table.shape[1]:
                    table = np.concatenate([table, np.zeros((len(table), 1 << 9), np.uint8)], axis=1)
                table[:rows, columns >> 3] |= (table[:rows, column[v] >> 3] >> (column[v] & 7) & 1) << (columns & 7)
                of[column[v]] -= 1
                column[v] = columns
                columns += 1
                of.append(1)
            table[row[u], column[v] >> 3] &= ~(1 << (column[v] & 7)) & 255
            column[w] = column[u]
            of[column[u]] += 1
        self.row, self.column = np.array(row, np.int32), np.array(column, np.int32)
        self.table = table[:rows, : columns + 7 >> 3].copy()
        labels = np.array(of + [0] * (-len(of) % 8)).reshape(-1, 8)
        self.transitions = sum(int((self.table >> k & 1).sum(0, dtype=np.int64) @ labels[:, k]) for k in range(8))

    @property
    def states(self) -> int:
        return len(self.table)

    def step(self, state: int, label: int) -> bool:
        """Whether the state that the label `state` leads to has a transition of this label."""
        c = int(self.column[label])
        return bool(self.table[self.row[state], c >> 3] >> (c & 7) & 1)


class Matcher:
    """Trie of labels with failure links: arcs (node << SYMBOL | symbol -> node), and for each node the
    longest label that ends there; for each label its length and the next shorter one that ends it."""

    def __init__(self, labels: dict[str, int], size: int):
        import numpy as np

        arcs: dict[int, int] = {}
        own, depth = [-1], [0]
        for text, t in labels.items():
            node = 0
            for ch in text:
                key = node << SYMBOL | ord(ch)
                node = arcs.get(key, -1)
                if node < 0:
                    node = arcs[key] = len(own)
                    own.append(-1)
                    depth.append(depth[key >> SYMBOL] + 1)
            own[node] = t
        fail, out = [0] * len(own), [-1] * len(own)
        width, shorter = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        for key, node in sorted(arcs.items(), key=lambda x: depth[x[1]]):
            at, symbol = key >> SYMBOL, key & (1 << SYMBOL) - 1
            while at:
                at = fail[at]
                if at << SYMBOL | symbol in arcs:
                    fail[node] = arcs[at << SYMBOL | symbol]
                    break
            out[node] = out[fail[node]]
            if own[node] >= 0:
                shorter[own[node]], width[own[node]] = out[node], depth[node]
                out[node] = own[node]
        self.keys, self.nodes = np.array(list(arcs), np.int64), np.array(list(arcs.values()), np.int32)
        order = np.argsort(self.keys)
        self.keys, self.nodes = self.keys[order], self.nodes[order]
        self.fail, self.out, self.width, self.shorter = np.array(fail, np.int32), np.array(out, np.int32), width, shorter


class Codec:
    """What is compiled from one tokenizer file of the word-end byte-level kind; open() gives a coder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        code = {c: b for b, c in enumerate(_byte_chars())}
        suffix = model["end_of_word_suffix"]

        def raw(token: str) -> str:
            end = token.endswith(suffix)
            return "".join(chr(code[c]) for c in (token[: -len(suffix)] if end else token)) + END * end

        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.label = {i: t for t, i in vocab.items() if t not in self.special}
        self.label |= {i: t for t, i in self.special.items()}
        ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        size = max(self.label) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        base = [i for t, i in ids.items() if len(t.removesuffix(END)) == 1]
        if len(base) < 512:
            raise ValueError("the vocabulary lacks a base symbol")
        self.automaton = Automaton(base, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], size)
        self.matcher = Matcher(ids, size)
        # the library's own rules for cutting texts, without its vocabulary
        spec["model"] = {**model, "vocab": {}, "merges": [], "unk_token": None}
        self.rules = json.dumps(spec | {"added_tokens": [], "post_processor": None})

    def open(self) -> Coder:
        return Coder(self)


class Coder:
    """Encoder and decoder of one task, with a bounded memo of words."""

    def __init__(self, codec: Codec):
        a, m = codec.automaton, codec.matcher
        stride = a.table.shape[1]
        self.table = a.table.tobytes() + b"\xff" * stride  # the last row is the start, from where all labels lead on
        self.start, self.row = a.states * stride, (a.row * stride).tolist()
        self.byte, self.bit = (a.column >> 3).tolist(), (1 << (a.column & 7)).tolist()
        self.arcs = dict(zip(m.keys.tolist(), m.nodes.tolist(), strict=True))
        self.room = 2 * len(self.arcs)  # arcs over failure links are written to the table while there is room
        self.fail, self.out, self.width, self.shorter = m.fail.tolist(), m.out.tolist(), m.width.tolist(), m.shorter.tolist()
        self.special, self.label, self.rules = codec.special, codec.label, codec.rules
        self.splitter = regex.compile("|".join(map(regex.escape, self.special)))
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self._library = None
        self.memo: dict[str, bytes] = {}
        self.codec = codec

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one pre-split word by transitions of the automaton."""
        table, row, byte, bit, arcs, out, width, shorter = self.table, self.row, self.byte, self.bit, self.arcs, self.out, self.width, self.shorter
        node, i, last, led = 0, 0, [-1], [self.start]  # for each beginning of the word: its last token, where that leads
        for symbol in [*word.encode("utf-8"), ord(END)]:
            key = node << SYMBOL | symbol
            node = arcs.get(key, -1)
            if node < 0:
                node = self._fail(key)
            t = out[node]
            i += 1
            while not table[led[i - width[t]] + byte[t]] & bit[t]:
                t = shorter[t]
            last.append(t)
            led.append(row[t])
        ids = []
        while i:
            t = last[i]
            ids.append(t)
            i -= width[t]
        return ids[::-1]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """What encode_word gives for each word, packed: all take a step of the automaton at a time."""
        import numpy as np

        a, m = self.codec.automaton, self.codec.matcher
        table, byte, bit, row = np.frombuffer(self.table, np.uint8), a.column >> 3, (1 << (a.column & 7)).astype(np.uint8), a.row * a.table.shape[1]
        got: list[bytes] = [b""] * len(words)
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(-sizes, kind="stable")
        for at in range(0, len(raw), ABREAST):
            own = order[at : at + ABREAST]
            size, n = sizes[own] + 1, len(own)  # longest first; each has its end
            here = np.arange(size[0]) < size[:, None] - 1
            symbols = np.full(here.shape, ord(END), np.int64)
            symbols[here] = np.frombuffer(b"".join([raw[i] for i in own]), np.uint8)
            symbols = symbols.T.copy()
            last, led = np.full((size[0] + 1, n), -1, np.int32), np.full((size[0] + 1, n), self.start, np.int32)
            node = np.zeros(n, np.int64)
            for i in range(1, size[0] + 1):
                k = int(np.searchsorted(-size, -i, side="right"))  # words of that length at least
                node = self._steps(m, node[:k], symbols[i - 1, :k])
                t, todo = m.out[node], np.arange(k)
                while len(todo):
                    x = t[todo]
                    todo = todo[table[led[i - m.width[x], todo] + byte[x]] & bit[x] == 0]
                    t[todo] = m.shorter[t[todo]]
                last[i, :k], led[i, :k] = t, row[t]
            steps, left, todo = [], size.copy(), np.arange(n)
            while len(todo):
                t = last[left[todo], todo]
                steps.append((todo, t))
                left[todo] -= m.width[t]
                todo = todo[left[todo] > 0]
            count = np.zeros(n, np.int64)
            for todo, _ in steps:
                count[todo] += 1
            ends = np.cumsum(count)
            flat = np.empty(int(ends[-1]), "<u4")
            for back, (todo, t) in enumerate(steps):
                flat[ends[todo] - 1 - back] = t
            packed, begin = flat.tobytes(), 0
            for i, end in zip(own.tolist(), (4 * ends).tolist(), strict=True):
                got[i] = packed[begin:end]
                begin = end
        return got

    @staticmethod
    def _steps(m: Matcher, node, symbol):
        """The nodes that the symbols lead to, over failure links where there is no arc."""
        import numpy as np

        out, todo = np.zeros(len(node), np.int64), np.arange(len(node))
        while len(todo):
            key = node << SYMBOL | symbol
            at = np.searchsorted(m.keys, key)
            at[at == len(m.keys)] = 0
            hit = m.keys[at] == key
            out[todo[hit]] = m.nodes[at[hit]]
            more = ~hit & (node > 0)
            todo, node, symbol = todo[more], m.fail[node[more]].astype(np.int64), symbol[more]
        return out

    def _fail(self, key: int) -> int:
        """The node that failure links lead to."""
        arcs, at, symbol = self.arcs, key >> SYMBOL, key & (1 << SYMBOL) - 1
        node = None
        while node is None and at:
            at = self.fail[at]
            node = arcs.get(at << SYMBOL | symbol)
        if len(arcs) < self.room:
            arcs[key] = node or 0
        return node or 0

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run of normalized words without white space between them."""
        memo, words = self.memo, self._words(chunk)
        if chunk[0] == SPECIAL:
            got = struct.pack("<I", self.special[chunk[1:]])
        elif words == [chunk]:
            ids = self.encode_word(chunk.removeprefix("\n"))
            got = struct.pack(f"<{len(ids)}I", *ids)
        else:
            got = b"".join([memo.get(w) or self._chunk(w) for w in words])
        if len(chunk) <= WORD:
            if len(memo) >= WORDS:
                memo.clear()
            memo[chunk] = got
        return got

    def _words(self, chunk: str) -> list[str]:
        """The words of a run of normalized words."""
        if chunk.isalpha() or chunk[0] in "\n\r":
            return [chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.words.findall(chunk)

    def _split(self, text: str) -> list[str]:
        """Normalized text cut at white space (which no word holds), or, marked by a line feed each,
        the words as the library cuts them."""
        if PLAIN.fullmatch(text):
            return (text if text.isascii() else unicodedata.normalize("NFC", text)).lower().split()
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.rules)
        back = {c: b for b, c in enumerate(_byte_chars())}
        normal = self._library.normalizer.normalize_str(text)
        words = self._library.pre_tokenizer.pre_tokenize_str(normal)
        return ["\n" + bytes(back[c] for c in w).decode("utf-8") for w, _ in words]

    def encode(self, text: str | None) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """All ids of each text. The words that the memo lacks are encoded together."""
        parts = [self._parts(text or "") for text in texts]
        if len(parts) > 1:
            self._learn(set().union(*parts))
        get, miss = self.memo.get, self._chunk
        return [b"".join([get(c) or miss(c) for c in chunks]) for chunks in parts]

    def _parts(self, text: str) -> list[str]:
        """What a text is made of: runs of normalized words, and special tokens behind their mark."""
        if "<|" not in text:
            return self._split(text)
        out, pos = [], 0
        for m in self.splitter.finditer(text):
            out += [*self._split(text[pos : m.start()]), SPECIAL + m[0]]
            pos = m.end()
        return out + self._split(text[pos:])

    def _learn(self, chunks: set[str]) -> None:
        """Take the words of these runs into the memo."""
        memo = self.memo
        new = [c for c in chunks if c not in memo]
        if len(memo) + len(new) > WORDS:
            memo.clear()
            new = [*chunks]
        words, several = set(), []
        for c in new:
            if len(c) > WORD or c[0] == SPECIAL:
                continue
            if c.isalpha() or c[0] == "\n":
                words.add(c)
            else:
                several.append((c, own := self._words(c)))
                words.update(own)
        words = [w for w in words if w not in memo]
        memo.update(zip(words, self.encode_words([w.removeprefix("\n") for w in words]), strict=True))
        for c, own in several:
            memo[c] = b"".join([memo[w] for w in own])

    def decode(self, ids: bytes) -> str:
        """The text that the library's decoder gives: the labels of the arcs, joined by spaces."""
        return " ".join(map(self.label.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The compiled codec of a tokenizer file; the driver keeps one of each."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _together(batches):
    """doc_ids and texts (null: empty), so many at a time that they have TOGETHER characters."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
            text = text.as_py() or ""  # one at a time: a batch may hold very long ones
            if texts and size + len(text) > TOGETHER:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def map_texts(docs: DataFrame, path: str, ddl: str, each: Callable[[Coder, object, bytes], list[tuple]]) -> DataFrame:
    """Rows that `each` gives for (coder, doc_id, ids of the text), in batches on the executors. The automaton is
    sent there once; a coder and its memo end with their task."""
    schema, held = common.arrow_schema(ddl), docs.sparkSession.sparkContext.broadcast(codec(path))

    def run(batches):
        coder = held.value.open()
        out: list[tuple] = []
        size = 0
        for ids, texts in _together(batches):
            for i, text, got in zip(ids, texts, coder.encode_all(texts), strict=True):
                out += each(coder, i, got)
                size += len(text)
                if len(out) >= 5000 or size > FLUSH:
                    yield common.batch(out, schema)
                    out, size = [], 0
        yield common.batch(out, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ddl)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded text of every document.

    A null or empty text has no ids and an empty decoded text; texts of any length are encoded whole;
    rows with equal or null doc_id stay apart; other columns are left aside; an empty table gives no
    rows."""
    def each(coder, i, ids):
        return [(i, ids, coder.decode(ids))]

    return map_texts(docs, path, "doc_id long, ids binary, decoded string", each)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document (see encode_documents),
    digested where the ids are made so that neither ids nor decoded text leave the worker."""
    def each(coder, i, ids):
        said = coder.decode(ids).encode("utf-8")
        return [(i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said).hexdigest())]

    return map_texts(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", each)


def document_pieces(docs: DataFrame, path: str, limit: int, buckets: int) -> DataFrame:
    """Pieces of at most `limit` tokens of every document, an end-of-document id 0 counted in.

    Returns doc_id, piece, start, length, ids_crc32 and bucket (0 to buckets-1, dealt in turn)."""
    turn = [0]

    def each(coder, i, ids):
        ids += b"\0\0\0\0"
        out = []
        for k, at in enumerate(range(0, len(ids), 4 * limit)):
            part = ids[at : at + 4 * limit]
            turn[0] += 1
            out.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), turn[0] % buckets))
        return out

    return map_texts(docs, path, "doc_id long, piece int, start long, length long, ids_crc32 long, bucket int", each)
