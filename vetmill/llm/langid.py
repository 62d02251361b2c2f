"""Language of a text by unigram pieces, marginalised over segmentations.

Every language has one probability for each piece of a fixed public vocabulary. A word, written with
the space before it, is a lattice of all its segmentations into pieces; the forward algorithm sums their
probabilities. A text's likelihood in a language is the product over its words, and the language is the
one with the largest posterior under the languages' shares of the labelled documents.

The pieces' probabilities are learned by expectation-maximization over the words of at most SAMPLE
labelled documents a language (the smallest hashes of id and text; repeats of a document share a hash and
count as one); the shares are counted over all of them. Scoring reads every text whole and shuffles
nothing: a task keeps the scores of at most MEMO different words.
"""

from __future__ import annotations

import base64
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetmill.llm import common, lm

#: Labelled documents a language that the pieces' probabilities are learned from, most languages that are learned
#: (the most frequent ones), rounds of expectation-maximization.
SAMPLE, LANGUAGES, ROUNDS = 2000, 256, 3
#: Pieces of the whole vocabulary that a language counts as seen besides its own.
PRIOR = 2000.0
#: Words whose scores a task keeps; characters of a text that are split into words at once.
MEMO, SLICE = 400_000, 1 << 20
#: Different words of texts, repeats among the texts included, that are scored together.
TOGETHER = 100_000
#: Longest word (bytes) whose probability is summed as such; longer ones in log space.
SHORT = 40
UNKNOWN = "und"
#: Runs of letters and of the few numerals that are no digits.
WORD = re.compile(r"[^\W\d_]+")


def pieces(path: str) -> tuple[list[bytes], list[float]]:
    """Usable pieces of a tiktoken vocabulary file with starting probabilities by their order: at most one
    space, in front, and no capital letters of ASCII; every other byte is a piece."""
    out: dict[bytes, float] = {}
    with open(path, "rb") as f:
        for line in f:
            token, rank = line.split()
            raw = base64.b64decode(token)
            body = raw[1:] if raw[:1] == b" " else raw
            if not any(b in lm.SPACES or 65 <= b <= 90 for b in body):
                out[raw] = 1 / (int(rank) + 100)
    for b in range(256):
        if b not in lm.SPACES - {32} and not 65 <= b <= 90:
            out.setdefault(bytes([b]), 1e-6)
    total = sum(out.values())
    return list(out), [v / total for v in out.values()]


class Segments(lm.Lattice):
    """Probabilities of words, summed over their segmentations, for each language."""

    def __init__(self, names: list[bytes], probabilities):
        import numpy as np

        with np.errstate(divide="ignore"):
            super().__init__(names, np.log(probabilities))
        self.probability = np.exp(self.score)  # by node, 0 where no piece ends

    def log_probability(self, words: list[bytes]):
        """A row for each language."""
        import numpy as np

        out = np.empty((len(self.scores), len(words)))
        for at in lm._by_length(words):
            own = [words[i] for i in at]
            if len(own[0]) > SHORT:
                out[:, at] = [[self.long(w, m) for w in own] for m in range(len(self.scores))]
                continue
            x = self._matrix(own)
            alpha = np.zeros((x.shape[1] + 1, len(self.scores), len(own)))
            alpha[0] = 1
            for i, j, node in self.arcs(x):
                alpha[j] += alpha[i] * self.probability.take(node, axis=1)
            out[:, at] = np.log(alpha[-1])
        return out

    def expected(self, words: list[bytes], weights, language: int, out) -> None:
        """Add to out the expected number of uses of each piece in words, each as often as its weight says."""
        import numpy as np

        for at in lm._by_length(words):
            own, weight = [words[i] for i in at], weights[at]
            if len(own[0]) > SHORT:
                for w, n in zip(own, weight, strict=True):
                    one = np.zeros(len(out))
                    self.expect_long(w, language, one)
                    out += n * one
                continue
            x, p = self._matrix(own), self.probability[language]
            n, arcs = x.shape[1], [*self.arcs(x)]
            alpha, beta = np.zeros((n + 1, len(own))), np.zeros((n + 1, len(own)))
            alpha[0], beta[n] = 1, 1
            for i, j, node in arcs:
                alpha[j] += alpha[i] * p[node]
            for i, j, node in reversed(arcs):
                beta[i] += beta[j] * p[node]
            for i, j, node in arcs:
                uses = alpha[i] * p[node] * beta[j] * weight / alpha[n]
                here = np.flatnonzero(uses)
                out += np.bincount(self.piece[node[here]], uses[here], len(out))


def words(text: str) -> Counter:
    """Words of a text in lower case with their numbers; a text is split in slices that end between words."""
    out: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end].isalpha():
            end += 1
        out.update(WORD.findall(text[at:end].lower()))
        at = end
    if not all(map(str.isalpha, out)):
        out = Counter({w: n for w, n in out.items() if any(map(str.isalpha, w))})
    return out


def _bytes(words) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in words]


def _sample(labelled: DataFrame, most: int) -> DataFrame:
    """lang and text of about `most` documents a language: those with the smallest hashes. Only hashes are ranked."""
    mark = F.xxhash64("id", "text")
    order = Window.partitionBy("lang").orderBy("mark")
    ranked = labelled.select("lang", mark.alias("mark")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    last = ranked.groupBy("lang").agg(F.max("mark").alias("last"))
    return labelled.join(F.broadcast(last), "lang").where(mark <= F.col("last")).select("lang", "text")


def train(docs: DataFrame, held_out: Column, path: str, sample: int = SAMPLE, rounds: int = ROUNDS):
    """(languages, logarithms of their shares, piece names, probabilities a language) of the documents with a
    language that are not held out; null ids, and null or empty texts, are allowed."""
    import numpy as np

    labelled = docs.where(~held_out & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id").alias("id"))
    top = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    top = sorted((r.lang, r.n) for r in top)
    names, start = pieces(path)
    langs = [x for x, _ in top]
    shares = [math.log((n + 1) / (sum(n for _, n in top) + len(top))) for _, n in top]
    chosen = _sample(labelled.where(F.col("lang").isin(langs)), sample) if langs else None
    probabilities = np.tile(np.array(start), (len(langs), 1))
    if not langs:
        return langs, shares, names, probabilities
    number = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1

    def split(batches):
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                yield from_counts(lang.as_py(), words(text.as_py() or ""))

    def from_counts(lang: int, count: Counter):
        import pyarrow as pa

        own = pa.array(_bytes(count), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.int64()), own, pa.array([*count.values()], pa.int64())], names=["lang", "word", "n"])

    counted = chosen.select(number.cast("long").alias("lang"), "text").mapInArrow(split, "lang long, word binary, n long")
    counted = common.table(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    ddl = "lang long, piece long, n double"
    schema = common.arrow_schema(ddl)
    prior = np.array(start)
    for _ in range(rounds):
        held = docs.sparkSession.sparkContext.broadcast((names, probabilities))

        def run(batches, held=held):
            model = Segments(*held.value)
            total = np.zeros(model.scores.shape)
            for b in batches:
                lang, n = b["lang"].to_numpy(), b["n"].to_numpy().astype(float)
                for z in np.unique(lang):
                    own = np.flatnonzero(lang == z)
                    model.expected(b["word"].take(own).to_pylist(), n[own], z, total[z])
            yield common.batch([(int(z), int(i), float(total[z, i])) for z, i in np.argwhere(total > 0)], schema)

        found = counted.mapInArrow(run, ddl).groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()  # a row a piece and language
        n = np.zeros(probabilities.shape)
        n[found["lang"].to_numpy(), found["piece"].to_numpy()] = found["n"].to_numpy()
        n += PRIOR * prior
        probabilities = n / n.sum(1, keepdims=True)
        held.unpersist()
    return langs, shares, names, probabilities


def predict(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The columns `keep`, lang_pred and score, the posterior probability of the predicted language, for every row.

    A text that is null or has no letter is UNKNOWN with score 0, as is every text if no language was learned. Equal
    posteriors go to the first language in order; texts of any length are scored whole, repeated rows each, an
    empty table gives no rows. Only the text is looked at."""
    langs, shares = model[0], model[1]
    held = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StringType, StructType

    out = StructType([own.schema[c] for c in keep]).add("lang_pred", StringType()).add("score", DoubleType())
    schema = to_arrow_schema(out)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        segments = Segments(*held.value[2:]) if langs else None
        memo: dict[str, int] = {}
        table = np.empty((1024, len(langs)))

        def learn(new: list[str]) -> None:
            nonlocal table
            while len(memo) + len(new) > len(table):
                table = np.concatenate([table, np.empty_like(table)])
            table[len(memo) : len(memo) + len(new)] = segments.log_probability(_bytes(new)).T
            memo.update(zip(new, range(len(memo), len(memo) + len(new)), strict=True))

        def judged(counts: list[Counter]):
            """(language, posterior) of each of some texts, whose new words are scored together."""
            new = list(dict.fromkeys(w for c in counts for w in c if w not in memo))
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = list(dict.fromkeys(w for c in counts for w in c))
            if new and len(new) <= MEMO:
                learn(new)
            for count in counts:
                if not count or not langs:
                    yield UNKNOWN, 0.0
                    continue
                total = np.array(shares)
                if len(new) <= MEMO:
                    total += np.fromiter(count.values(), float, len(count)) @ table[[memo[w] for w in count]]
                else:  # more different words than a task keeps: part by part
                    own = [*count]
                    for k in range(0, len(own), MEMO // 8):
                        part = own[k : k + MEMO // 8]
                        total += segments.log_probability(_bytes(part)) @ np.array([count[w] for w in part], float)
                best = int(np.argmax(total))
                yield langs[best], float(1 / np.exp(total - total[best]).sum())

        for b in batches:
            found: list[tuple[str, float]] = []
            waiting: list[Counter] = []
            size = 0
            for text in b["_text"]:
                waiting.append(words(text.as_py() or "") if langs else Counter())
                size += len(waiting[-1])
                if size > TOGETHER:
                    found += judged(waiting)
                    waiting, size = [], 0
            found += judged(waiting)
            columns = [b[c] for c in keep] + [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return own.mapInArrow(run, out)
