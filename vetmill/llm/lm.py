"""Document probability under a subword lattice.

The pieces of an existing byte-level vocabulary are the arcs; the scores of the pieces are fitted
here. A word, written with the space before it, is a lattice of all its segmentations; the forward
recursion in log space sums them to the word's lattice probability L. A word seen in training also
has an arc of its own, so a token's probability is (c + V L) / (N + V) with its count c, all
training tokens N and distinct ones V: both parts are distributions over tokens (words and the end
of the text), hence so is their mix.

Such a model stands for all training documents and one for each larger group of them (their
language); a group's model keeps OWN of a token's probability and leaves the rest to the model of
all. A text's probability is the mean over the models, weighted by the groups' shares. The group of
a scored text is never looked at. Beside it stands the text's probability under the vocabulary's own
scores alone: the same recursion, nothing learned.

Scores start from the vocabulary's own order (rank r has weight 1 / (r + 100)) and are re-estimated
by expectation-maximization over all distinct training words. Counts, expectations and lattice
sums all run on the executors; the driver sees one number for each piece and group, and the frequent
words (at most HOT, see `frequent`), which scoring looks up without a shuffle. All other words of a
document meet their counts in a join.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.llm import bpe, common

ROUNDS = 2
#: Most groups with a model, least share of the training documents for one, what a model keeps of a
#: token, weight of the model of all.
GROUPS, SHARE, OWN, ALL = 8, 0.01, 0.9, 0.02
#: Words that scoring may look up in memory; words of more bytes are known there by a digest.
HOT, WHOLE = 200_000, 64
#: Longest word that is scored in a batch of words of its length; longer ones go one at a time.
SHORT = 48
FLUSH = 300_000
SPACES = set(b"\x20\x09\x0a\x0b\x0c\x0d")


def pieces(path: str) -> tuple[list[bytes], list[float]]:
    """Usable pieces of a byte-level vocabulary with starting log scores: at most one space, in
    front, and no capital letters; every other byte is a piece."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    code = {c: b for b, c in enumerate(bpe._byte_chars())}
    out: dict[bytes, float] = {}
    for token, rank in vocab.items():
        if any(c not in code for c in token):
            continue
        raw = bytes(code[c] for c in token)
        body = raw[1:] if raw[:1] == b" " else raw
        if not any(b in SPACES or 65 <= b <= 90 for b in body):
            out[raw] = 1 / (rank + 100)
    for b in range(256):
        if b not in SPACES - {32} and not 65 <= b <= 90:
            out.setdefault(bytes([b]), 1e-6)
    total = sum(out.values())
    return list(out), [math.log(v / total) for v in out.values()]


class Lattice:
    """Forward and backward recursions over words, in batches of words of one length; scores has a
    row for each model."""

    def __init__(self, names: list[bytes], scores):
        import numpy as np

        self.scores = np.atleast_2d(np.asarray(scores, float))
        self.longest = max(map(len, names))
        used = sorted({b for p in names for b in p})
        self.classes = np.zeros(256, np.int32)
        self.classes[used] = np.arange(1, len(used) + 1)
        nodes: list[dict[int, int]] = [{}, {}]  # 0: nowhere, 1: root
        self.piece = [-1, -1]
        for k, p in enumerate(names):
            at = 1
            for b in p:
                c = int(self.classes[b])
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                    self.piece.append(-1)
                at = nodes[at][c]
            self.piece[at] = k
        self.children, self.piece = nodes, np.array(self.piece)
        self.next = np.zeros((len(nodes), len(used) + 1), np.int32)
        for i, kids in enumerate(nodes):
            for c, j in kids.items():
                self.next[i, c] = j
        self.score = np.where(self.piece >= 0, self.scores[:, np.maximum(self.piece, 0)], -np.inf)

    def arcs(self, x):
        """(start, end, node) for each pair of places; x: classes, words by bytes."""
        n = x.shape[1]
        for i in range(n):
            at = self.next[1, x[:, i]]
            for j in range(i + 1, min(i + self.longest, n) + 1):
                if j > i + 1:
                    at = self.next[at, x[:, j - 1]]
                if not at.any():
                    break
                yield i, j, at

    def _matrix(self, words: list[bytes]):
        import numpy as np

        return self.classes[np.frombuffer(b"".join(b" " + w for w in words), np.uint8).reshape(len(words), -1)]

    def forward(self, words: list[bytes]):
        """Log probabilities of the words of a list of equal lengths: a row for each model."""
        import numpy as np

        if len(words[0]) > SHORT:
            return np.array([[self.long(w, m) for w in words] for m in range(len(self.scores))])
        x = self._matrix(words)
        alpha = np.full((x.shape[1] + 1, len(self.scores), len(words)), -np.inf)
        alpha[0] = 0
        with np.errstate(invalid="ignore"):
            for i, j, at in self.arcs(x):
                np.logaddexp(alpha[j], alpha[i] + self.score[:, at], out=alpha[j])
        return alpha[-1]

    def expect(self, words: list[bytes], model: int):
        """Expected number of uses of each piece over words of one length, each once."""
        import numpy as np

        x = self._matrix(words)
        n, arcs, score = x.shape[1], [*self.arcs(x)], self.score[model]
        alpha, beta = np.full((n + 1, len(words)), -np.inf), np.full((n + 1, len(words)), -np.inf)
        alpha[0], beta[n] = 0, 0
        with np.errstate(invalid="ignore"):
            for i, j, at in arcs:
                np.logaddexp(alpha[j], alpha[i] + score[at], out=alpha[j])
            for i, j, at in reversed(arcs):
                np.logaddexp(beta[i], beta[j] + score[at], out=beta[i])
            out = np.zeros(self.scores.shape[1])
            for i, j, at in arcs:
                here = np.flatnonzero(self.piece[at] >= 0)
                if len(here):
                    k = at[here]
                    out += np.bincount(self.piece[k], np.exp(alpha[i, here] + score[k] + beta[j, here] - alpha[n, here]), len(out))
        return out

    def long(self, word: bytes, model: int) -> float:
        """The forward recursion for one long word, in memory that follows the longest piece, not its length."""
        x, score, children = self.classes[list(b" " + word)].tolist(), self.score[model], self.children
        ahead: list[list[float]] = [[] for _ in range(self.longest + 1)]
        ahead[0].append(0.0)
        for i in range(len(x)):
            got = ahead.pop(0)
            ahead.append([])
            if not got:
                continue
            top = max(got)
            alpha = top + math.log(sum(math.exp(v - top) for v in got))
            at = 1
            for j in range(i, min(i + self.longest, len(x))):
                at = children[at].get(x[j], 0)
                if not at:
                    break
                if score[at] > -math.inf:
                    ahead[j - i].append(alpha + float(score[at]))
        got = ahead[0]
        top = max(got)
        return top + math.log(sum(math.exp(v - top) for v in got))


    def expect_long(self, word: bytes, model: int, out) -> None:
        """Add the expected number of uses of each piece in one long word to out, a number a piece."""
        import numpy as np

        x, score, children = self.classes[list(b" " + word)].tolist(), self.score[model], self.children
        n = len(x)
        alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        alpha[0] = beta[n] = 0

        def arcs(i):
            at = 1
            for j in range(i, min(i + self.longest, n)):
                at = children[at].get(x[j], 0)
                if not at:
                    break
                if score[at] > -math.inf:
                    yield j + 1, at

        for i in range(n):
            for j, at in arcs(i):
                alpha[j] = np.logaddexp(alpha[j], alpha[i] + score[at])
        for i in reversed(range(n)):
            for j, at in arcs(i):
                beta[i] = np.logaddexp(beta[i], score[at] + beta[j])
                out[self.piece[at]] += math.exp(alpha[i] + score[at] + beta[j] - alpha[n])


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; the end of the text is written as an empty word."""
    return [*(text or "").encode("utf-8", "surrogatepass").translate(common.LOWER).split(), b""]


def key_of(word: bytes) -> bytes:
    """What stands for a word where words meet: itself, or a digest behind a space, which no word holds."""
    from xxhash import xxh3_128_digest

    return word if len(word) <= WHOLE else b" " + xxh3_128_digest(word)


def count_words(docs: DataFrame, groups: int) -> DataFrame:
    """word, c0 to c{groups - 1} (counts in the training documents of each group), every (in all).

    docs: text and model, the number of a training document's group or null."""
    ddl = "word binary, model int, n long"
    schema = common.arrow_schema(ddl)

    def run(batches):
        import pyarrow as pa

        counts: list[Counter] = [Counter() for _ in range(groups + 1)]

        def rows():
            for z, c in enumerate(counts):
                words, n = list(c), list(c.values())
                for k in range(0, len(words), 50_000):
                    own = pa.array(words[k : k + 50_000], pa.binary())
                    yield pa.RecordBatch.from_arrays([own, pa.array([z], pa.int32()).take(pa.array([0] * len(own))), pa.array(n[k : k + 50_000], pa.int64())], schema=schema)
                c.clear()

        for b in batches:
            for text, z in zip(b["text"].to_pylist(), b["model"].to_pylist(), strict=True):
                counts[groups if z is None else z].update(tokens(text))
                if sum(map(len, counts)) > FLUSH:
                    yield from rows()
        yield from rows()

    made = docs.select("text", "model").mapInArrow(run, ddl)
    own = [F.sum(F.when(F.col("model") == z, F.col("n")).otherwise(0)).alias(f"c{z}") for z in range(groups)]
    return made.groupBy("word").agg(*own, F.sum("n").alias("every"))


def _by_length(words: list[bytes], size: int = 4096):
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for at in groups.values():
        for k in range(0, len(at), size):
            yield at[k : k + size]


def fit(vocab: DataFrame, path: str, groups: int, rounds: int = ROUNDS) -> tuple[list[bytes], list[list[float]]]:
    """Pieces and log scores after expectation-maximization over all distinct training words: first
    the model of all, whose expectations are the sum of the groups', then one for each group."""
    import numpy as np

    names, start = pieces(path)
    scores = [start] * (groups + 1)
    ddl = "model int, piece int, n double"
    schema = common.arrow_schema(ddl)
    seen = vocab.where(F.octet_length("word") > 0)
    for _ in range(rounds):
        held = vocab.sparkSession.sparkContext.broadcast((names, scores))

        def run(batches, held=held):
            lattice = Lattice(*held.value)
            total = np.zeros(lattice.scores.shape)
            for b in batches:
                words = b["word"].to_pylist()
                for z in range(groups):
                    own = [words[i] for i in np.flatnonzero(b[f"c{z}"].to_numpy() > 0)]
                    for w in own:
                        if len(w) > SHORT:
                            lattice.expect_long(w, z + 1, total[z + 1])
                    own = [w for w in own if len(w) <= SHORT]
                    for at in _by_length(own):
                        total[z + 1] += lattice.expect([own[i] for i in at], z + 1)
            yield common.batch([(int(z), int(i), float(total[z, i])) for z, i in np.argwhere(total > 0)], schema)

        found = seen.mapInArrow(run, ddl).groupBy("model", "piece").agg(F.sum("n").alias("n")).toArrow()  # a row a piece and group
        n = np.zeros((groups + 1, len(names)))
        n[found["model"].to_numpy(), found["piece"].to_numpy()] = found["n"].to_numpy()
        n[0] = n.sum(0)
        n += 1e-4 + 1e-3 * n[0] / max(n[0].sum(), 1) * n.sum(1, keepdims=True)  # what a group lacks it takes from all
        scores = np.log(n / n.sum(1, keepdims=True)).tolist()
        held.unpersist()
    return names, scores


def score_words(vocab: DataFrame, model, own: list[float], totals: list[tuple[int, int]]) -> DataFrame:
    """key (see key_of), known, every, base, lattice (under the vocabulary's own scores) and s0 to
    s{groups}: log10 probabilities of every token there is.

    totals: N and V of all training documents, then of each group."""
    import numpy as np

    held, groups = vocab.sparkSession.sparkContext.broadcast((model[0], [*model[1], own])), len(totals) - 1
    kept = ["lattice", *[f"s{z}" for z in range(groups + 1)]]
    ddl = "key binary, known boolean, every long, base double, " + ", ".join(f"{s} double" for s in kept)

    def run(batches):
        import pyarrow as pa

        lattice = Lattice(*held.value)
        starts = np.array([p[:1] == b" " for p in held.value[0]])
        start = np.exp(lattice.scores[:, starts]).sum(1)
        end = 1e-3 * start  # the end's share of a lattice; its own count outweighs it
        for b in batches:
            words = b["word"].to_pylist()
            log_l = np.zeros((groups + 2, len(words)))
            for at in _by_length(words):
                own = lattice.forward([words[i] for i in at]) + np.log(start / (start + end))[:, None]
                log_l[:, at] = own if words[at[0]] else np.log(end / (start + end))[:, None]
            c = np.stack([b[f"c{z}"].to_numpy() for z in range(groups)])
            c = np.concatenate([c.sum(0, keepdims=True), c])
            n, v = (np.array([t[k] for t in totals], float)[:, None] for k in (0, 1))
            v1 = np.maximum(v, 1)
            log_p = np.logaddexp(np.where(c > 0, np.log(np.maximum(c, 1)), -np.inf), np.log(v1) + log_l[:-1]) - np.log(n + v1)
            log_p[1:] = np.logaddexp(log_p[1:] + math.log(OWN), log_p[0] + math.log(1 - OWN))
            base = np.log10((c[0] + 1) / (totals[0][0] + (totals[0][1] + 1)))
            log_p = np.concatenate([log_l[-1:], log_p]) / math.log(10)
            yield pa.RecordBatch.from_arrays([pa.array([*map(key_of, words)], pa.binary()), pa.array(c[0] > 0), b["every"], pa.array(base), *map(pa.array, log_p)],
                                             names=["key", "known", "every", "base", *kept])

    return vocab.mapInArrow(run, ddl)


def frequent(words: DataFrame, most: int = HOT):
    """The least count of a frequent word, and the frequent words as an Arrow table of at most
    `most` rows.

    Of n tokens, at most `most` words can make n / most each; a lower threshold is taken where the
    words that meet it are counted and still are that few."""
    total = words.agg(F.sum("every")).first()[0] or 0
    floors = [max(1, math.ceil(total / (most * 2**k))) for k in range(7)]
    counts = words.agg(*[F.count_if(F.col("every") >= f) for f in floors]).first()
    floor = min(f for f, n in zip(floors, counts, strict=True) if n <= most or f == floors[0])
    return floor, words.where(F.col("every") >= floor).drop("every").toArrow()


def _models(docs: DataFrame, held_out: Column, group: str | None) -> tuple[DataFrame, list[float]]:
    """docs with held and model (of a training document), and the groups' shares."""
    own = F.coalesce(F.col(group).cast("string"), F.lit("")) if group and group in docs.columns else F.lit("")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", own.alias("_group")).withColumn("held", held_out)
    train = docs.where(~F.col("held")).groupBy("_group").agg(F.count("*").alias("n"))
    total = train.agg(F.sum("n")).first()[0] or 0
    top = train.where(F.col("n") >= SHARE * total).orderBy(F.desc("n"), "_group").limit(GROUPS).collect()
    number = F.lit(len(top) - 1 if len(top) == GROUPS else len(top))  # those that are left over share a model
    for z, r in enumerate(top):
        number = F.when(F.col("_group") == r["_group"], F.lit(z)).otherwise(number)
    shares = [r.n / max(total, 1) for r in top] + ([] if len(top) == GROUPS else [max(0.0, 1 - sum(r.n for r in top) / max(total, 1))])
    return docs.select("doc_id", "text", "held", F.when(~F.col("held"), number).alias("model")), shares


def score_documents(docs: DataFrame, held_out: Column, path: str, group: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, lattice_score (by the vocabulary's
    own scores alone) and score of every row.

    group: a column whose values part the training documents. A null or empty text is one token,
    its end. Rows with equal or null doc_id stay apart. Without training documents all counts are 0
    and the lattice alone gives the probability. Texts and words of any length are scored whole; an empty
    table gives no rows; other columns are left aside."""
    docs, shares = _models(docs, held_out, group)
    groups = len(shares)
    vocab = common.table(count_words(docs, groups), "words")
    c = [f"c{z}" for z in range(groups)]
    sums = [F.coalesce(F.sum(x), F.lit(0)) for x in c] + [F.count_if(F.col(x) > 0) for x in c]
    sums += [F.count_if(sum((F.col(x) for x in c), F.lit(0)) > 0)]
    row = vocab.agg(*[x.alias(f"_{i}") for i, x in enumerate(sums)]).first()
    n = sum(row[:groups])
    totals = [(n, row[2 * groups]), *zip(row[:groups], row[groups : 2 * groups], strict=True)]
    words = common.table(score_words(vocab, fit(vocab, path, groups), pieces(path)[1], totals), "scored")
    floor, hot = frequent(words)
    s = [f"s{z}" for z in range(groups + 1)]
    sums = ["base", "lattice", *s]
    held = docs.sparkSession.sparkContext.broadcast((hot["key"].to_pylist(), [hot[x].to_pylist() for x in ["known", *sums]]))
    ddl = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, " + ", ".join(f"{x} double" for x in sums) + ", key binary, times int"
    schema = common.arrow_schema(ddl)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        row, (names, values) = TaskContext.get().partitionId() << 40, held.value
        known, matrix = {w: i for i, w in enumerate(names)}, np.array(values, float).reshape(1 + len(sums), -1).T

        def rest(rows, keys, times):
            """Rows of words that are not frequent: all other columns are null."""
            own = {"row": rows, "key": keys, "times": times}
            columns = [pa.array(own[f.name], f.type) if f.name in own else pa.nulls(len(rows), f.type) for f in schema]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for b in batches:
            out: list[tuple] = []
            rows, words, many = [], [], []
            for i, text, away in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "held")), strict=True):
                row += 1
                count = Counter(tokens(text))
                if max(map(len, count)) > WHOLE:
                    count = {key_of(w): n for w, n in count.items()}
                at = [*map(known.get, count)]
                times = np.fromiter(count.values(), np.int64, len(count))
                here = np.array([j is not None for j in at])
                hits, *own = (times[here] @ matrix[np.array([j for j in at if j is not None], np.int64)]).tolist()
                if len(times) > here.sum():
                    new = [w for w, j in zip(count, at, strict=True) if j is None]
                    rows += [row] * len(new)
                    words += new
                    many += times[~here].tolist()
                out.append((row, i, away, int(times.sum()), round(hits), *own, None, None))
                if len(words) > 50_000:
                    yield rest(rows, words, many)
                    rows, words, many = [], [], []
            yield rest(rows, words, many)
            yield common.batch(out, schema)

    parts = common.table(docs.select("doc_id", "text", "held").mapInArrow(run, ddl), "parts")
    rest = words.where(F.col("every") < floor).select("key", "known", *sums)
    rare = parts.where("key is not null").select("row", "key", "times").join(rest, "key").groupBy("row").agg(
        F.sum(F.when(F.col("known"), F.col("times")).otherwise(0)).alias("_known"), *[F.sum(F.col("times") * F.col(x)).alias(f"_{x}") for x in sums])
    out = parts.where("key is null").join(rare, "row", "left")
    full = {x: F.col(x) + F.coalesce(f"_{x}", F.lit(0.0)) for x in sums}
    weights = [ALL, *((1 - ALL) * w for w in shares)] if sum(shares) > 0 else [1.0]
    each = [full[x] + math.log10(w) for x, w in zip(s, weights, strict=False) if w > 0]
    top = F.greatest(*each) if len(each) > 1 else each[0]
    score = top + F.log10(sum((F.pow(F.lit(10.0), x - top) for x in each), F.lit(0.0)))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), full["base"].alias("base_score"), full["lattice"].alias("lattice_score"), score.alias("score"))
