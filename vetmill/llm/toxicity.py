"""Toxicity of documents by a weighted finite-state pattern grammar over clauses.

An insult transducer rewrites each word to a symbol. Fixed lists give threats, targets, negation,
modals and reported speech, and come first; other words are insults by a lexicon with weights learned
from labelled documents: whole words, and stems that stand in at least STEM_WORDS different words of
toxic documents (an insult with endings of a language). Four small transducers over these symbols -
negation scope, reported speech, target distance, threat construction - are composed into one
deterministic table. Running it over a clause emits matched patterns, whose weights the context raises
or lowers; a document's score is a logistic function of its clauses' totals.

Learning: a bounded sample of the labelled training rows, the first LABELLED in the order of a hash,
one text for each doc_id; word counts are summed over it on the executors and the LEXICON most
significant entries kept. The logistic function is fitted on the first FIT_ROWS of the sample. Only
text is ever scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.llm import common

LABELLED, FIT_ROWS, LEXICON = 50_000, 20_000, 5000
#: Entries must be this significant (likelihood ratio), in so many toxic documents at least.
SIGNIFICANT, SUPPORT = 24.0, 3
#: Length of stems; different words of toxic documents that a stem needs, most that one of them may
#: hold of its occurrences, and what a longer stem holds at least to stand for a shorter one.
SHORTEST, LONGEST, STEM_WORDS, STEM_SHARE, STEM_REST = 3, 8, 5, 0.5, 0.9
FLUSH = 200_000

#: Fixed word lists.
TARGETS = set("you your yours yourself ur u he she they them du dich dir euch ihr sie tu toi vous ton votre tú te usted ustedes vosotros".split())
NEGATIONS = set("not never no isn aren wasn weren don doesn didn won nicht kein keine keinen nie niemals pas jamais aucun ne nunca jamás ningún sin".split())
REPORTS = set("said says say saying told claimed claims wrote writes quoted reportedly called sagte sagt schrieb behauptet dit disait écrit dijo dice escribió".split())
MODALS = set("will gonna going shall must werde werden wird vais va voy vamos".split())
THREATS = set("kill hurt destroy beat stab shoot burn töten umbringen verletzen tuer frapper matar golpear".split())
THREAT_WEIGHT = 5.0
#: What the context does to a pattern's weight (fixed values).
FACTORS = {"negated": 0.5, "reported": 0.6, "targeted": 1.2}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")  # words, and what ends a clause
SYMBOLS = "insult threat modal target negation report clause other".split()


def words(text: str | None) -> list[str]:
    return [w for w in _TOKEN.findall((text or "").lower()) if w[0].isalpha()]


def _countdown(start_on: str, width: int):
    """A transducer that remembers for `width` words that a symbol went by."""
    def step(state: int, symbol: str) -> int:
        return 0 if symbol == "clause" else width if symbol == start_on else max(0, state - 1)

    return range(width + 1), step


def compose(factors: dict[str, float] = FACTORS) -> tuple[list[list[tuple[int, str, float]]], int]:
    """The product of the four transducers: table[state][symbol] = (next, pattern or "", factor)."""
    negation_states, negation = _countdown("negation", 3)
    target_states, target = _countdown("target", 4)

    def report(state: int, symbol: str) -> int:
        return 0 if symbol == "clause" else int(state or symbol == "report")

    def threat(state: int, symbol: str) -> int:  # 1-3: after a modal; 4-6: after the verb
        if symbol == "clause":
            return 0
        if symbol == "modal":
            return 3
        if symbol == "threat":
            return 6 if 1 <= state <= 3 else 0
        return 0 if state in (1, 4) else max(0, state - 1)

    states = [*product(negation_states, range(2), target_states, range(7))]
    at = {s: i for i, s in enumerate(states)}
    table = []
    for n, r, t, h in states:
        row = []
        for symbol in SYMBOLS:
            pattern = "insult" if symbol == "insult" else "threat" if symbol == "target" and h >= 4 else ""
            factor = (factors["negated"] if n else 1.0) * (factors["reported"] if r else 1.0)
            factor *= factors["targeted"] if t and pattern == "insult" else 1.0
            row.append((at[negation(n, symbol), report(r, symbol), target(t, symbol), threat(h, symbol)], pattern, factor))
        table.append(row)
    return table, at[0, 0, 0, 0]


@dataclass
class Model:
    """Learned weights of insults: whole words, and stems (beginnings of words); logistic weights."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    logistic: dict[str, list[float]] | None = None


class Grammar:
    """The insult lexicon composed with the context transducers."""

    def __init__(self, model: Model, factors: dict[str, float] = FACTORS):
        self.model = model
        self.table, self.start = compose(factors)
        self.memo: dict[str, tuple[int, float]] = {}
        fixed = (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("modal", MODALS), ("threat", THREATS))
        self.fixed = {w: SYMBOLS.index(name) for name, group in fixed for w in group}

    def symbol(self, word: str) -> tuple[int, float]:
        """A word's symbol, and its weight as an insult."""
        got = self.memo.get(word)
        if got is None:
            if not word[0].isalpha():
                got = (6, 0.0)
            elif word in self.fixed:
                got = (self.fixed[word], 0.0)
            else:
                stems = (self.model.stems.get(word[:n], 0.0) for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
                weight = self.model.words.get(word, 0.0) or max(stems, default=0.0)
                got = (0, weight) if weight > 0 else (7, 0.0)
            if len(self.memo) >= FLUSH:
                self.memo.clear()
            if len(word) <= 64:
                self.memo[word] = got
        return got

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """Totals of the clauses in which patterns match, and the number of words."""
        tokens = _TOKEN.findall((text or "").lower())
        symbols = [self.memo.get(t) or self.symbol(t) for t in tokens]
        n = sum(1 for s in symbols if s[0] != 6)
        if not any(s[0] < 2 for s in symbols):
            return [], n
        state, total, out = self.start, 0.0, []
        for symbol, weight in symbols:
            state, pattern, factor = self.table[state][symbol]
            if pattern:
                total += factor * (weight if pattern == "insult" else THREAT_WEIGHT)
            elif symbol == 6 and total:
                out.append(total)
                total = 0.0
        return out + [total] * (total > 0), n

    def features(self, text: str | None) -> list[float]:
        found, n = self.clauses(text)
        s = sum(found)
        return [math.log1p(s), s / math.sqrt(n + 1), max(found, default=0.0), math.log(n + 1), math.log1p(len(found)), 100 * s / (n + 1)]


    def score(self, text: str | None) -> tuple[float, int]:
        """Probability that a text is toxic, and its clauses with a match."""
        if not self.model.logistic:
            return 0.0, len(self.clauses(text)[0])
        x, w = self.features(text), self.model.logistic
        z = w["weights"][0] + sum(c * (min(max(v, low), high) - m) / d for c, v, m, d, low, high in zip(
            w["weights"][1:], x, w["mean"], w["scale"], w["low"], w["high"], strict=True))  # within what was learned from: length alone decides nothing beyond
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), round(math.expm1(x[4]))


def _counts(train: DataFrame) -> DataFrame:
    """word, toxic and clean documents with it, its occurrences there; '' stands for all."""
    ddl = "word string, dt long, dc long, ot long, oc long"
    schema = common.arrow_schema(ddl)

    def run(batches):
        counts: dict[str, list[int]] = {}

        def rows():
            out = common.batch([(k, *v) for k, v in counts.items()], schema)
            counts.clear()
            return out

        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"].to_pylist(), strict=True):
                found = Counter(words(text.as_py()))
                found[""] = sum(found.values())
                i = 0 if toxic else 1
                for f, k in found.items():
                    e = counts.setdefault(f, [0, 0, 0, 0])
                    e[i] += 1
                    e[2 + i] += k
                if len(counts) >= FLUSH:
                    yield rows()
        yield rows()

    made = train.select("text", "toxic").mapInArrow(run, ddl)
    return made.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("dt", "dc", "ot", "oc")])


def learn_lexicon(train: DataFrame) -> Model:
    """The most significant words and stems of toxic documents with their log rate ratios."""
    counts = common.table(_counts(train), "counts")
    all_ = counts.where("word = ''").first()
    if not all_ or not all_.dt or not all_.dc:
        return Model()
    dt, dc = F.col("dt").cast("double"), F.col("dc").cast("double")
    weight = F.log((F.col("ot") + 0.5) / (all_.ot + 1.0)) - F.log((F.col("oc") + 0.5) / (all_.oc + 1.0))

    def best(rows: DataFrame, toxic: float, clean: float) -> dict[str, float]:
        """Entries with more toxic than clean uses, of so many in all, by the likelihood ratio."""
        nt, nc = F.lit(float(toxic)), F.lit(float(clean))
        share = (dt + dc) / (nt + nc)

        def part(seen, expected):
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

        ratio = 2 * (part(dt, nt * share) + part(dc, nc * share) + part(nt - dt, nt * (1 - share)) + part(nc - dc, nc * (1 - share)))
        rows = (rows.where((dt >= SUPPORT) & (dt / nt > 4 * dc / nc)).select("word", ratio.alias("ratio"), weight.alias("weight"))
                .where((F.col("ratio") >= SIGNIFICANT) & (F.col("weight") > 0)).orderBy(F.desc("ratio"), "word").limit(LEXICON))
        return {r.word: r.weight for r in rows.select("word", "weight").collect()}

    own = counts.where("word <> ''")
    ends = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.char_length("word")))
    begun = own.where(F.char_length("word") >= SHORTEST).select(
        "*", F.explode(ends).alias("n")).withColumn("stem", F.expr("left(word, n)")).groupBy("stem").agg(
        *[F.sum(c).alias(c) for c in ("dt", "dc", "ot", "oc")], F.count_if(F.col("dt") > 0).alias("kinds"), F.max("dt").alias("most"))
    stems = begun.where((F.col("kinds") >= STEM_WORDS) & (F.col("most") <= STEM_SHARE * F.col("dt"))).withColumnRenamed("stem", "word")
    uses = own.agg(F.sum("dt"), F.sum("dc")).first()
    found = best(stems, *uses)
    if found:  # of a stem and a longer one that holds nearly all of its uses, the longer one
        held = {r.word: r.dt for r in stems.where(F.col("word").isin([*found])).select("word", "dt").collect()}
        found = {w: v for w, v in found.items() if not any(x != w and x.startswith(w) and held[x] >= STEM_REST * held[w] for x in found)}
    return Model(best(own, all_.dt, all_.dc), found)


def fit(sample: DataFrame, model: Model) -> dict[str, list[float]] | None:
    """Logistic weights over standardized features; sample has at most FIT_ROWS rows."""
    import numpy as np

    ddl = "doc_id long, toxic int, x array<double>"
    schema = common.arrow_schema(ddl)

    def run(batches):
        grammar = Grammar(model)
        for b in batches:
            x = [grammar.features(t.as_py()) for t in b["text"]]
            yield common.batch([*zip(b["doc_id"].to_pylist(), b["toxic"].to_pylist(), x, strict=True)], schema)

    rows = sample.select("doc_id", "text", "toxic").mapInArrow(run, ddl).orderBy("doc_id").collect()
    y = np.array([r.toxic for r in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r.x for r in rows])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.eye(len(w)), a.T @ (p - y) + w)
    return {"mean": mean.tolist(), "scale": scale.tolist(), "weights": w.tolist(), "low": x.min(0).tolist(), "high": x.max(0).tolist()}


def train(docs: DataFrame, labels: DataFrame, held_out: Column) -> Model:
    """Lexicon and logistic weights from labelled documents for which held_out (a column) is false.

    Labels that are null or lack a doc_id are left aside; a document labelled twice is toxic if one
    label says so; of rows that repeat a labelled doc_id the least text is taken, so that no more than
    LABELLED rows are learned from."""
    labels = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(~held_out)
    labels = labels.where(~held_out)
    order = [F.xxhash64("doc_id"), "doc_id"]
    share = max(1, labels.count() // LABELLED)  # thinned first, so that the top rows come from a few times as many
    sample = labels.where(F.pmod(order[0], F.lit(share)) == 0).orderBy(*order).limit(LABELLED)  # small enough to go to the texts
    first = sample.orderBy(*order).limit(FIT_ROWS).select("doc_id", F.lit(True).alias("fits"))
    sample = sample.join(first, "doc_id", "left")
    sample = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.max("fits").alias("fits"))
    sample = common.table(sample, "labelled")
    model = learn_lexicon(sample)
    model.logistic = fit(sample.where("fits"), model)
    return model


def toxicity(text: Column, model: Model) -> Column:
    """A struct of score, predicted and n_clauses (clauses with a match) for a text. The text goes to
    Python, and nothing but these numbers comes back.

    Null and empty texts score as texts without a match, very long ones are read whole; without labels
    of both kinds all scores are 0."""
    import pyarrow as pa
    from pyspark.sql.functions import ArrowUDFType, arrow_udf

    def run(batches):
        grammar = Grammar(model)
        for b in batches:
            got = [grammar.score(t.as_py()) for t in b]
            scores = [x[0] for x in got]
            yield pa.StructArray.from_arrays(
                [pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32()), pa.array([x[1] for x in got], pa.int32())],
                names=["score", "predicted", "n_clauses"])

    return arrow_udf(run, "score double, predicted int, n_clauses int", ArrowUDFType.SCALAR_ITER)(text)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns named in keep, then score, predicted and n_clauses (see toxicity), one row for each
    row of docs; repeated rows stay apart and score alike, other columns are left aside."""
    said = "_said"
    while said in docs.columns:
        said += "_"
    return docs.select(*keep, toxicity(F.col("text"), model).alias(said)).select(*keep, *[F.col(said)[c].alias(c) for c in ("score", "predicted", "n_clauses")])
