"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's pattern is parsed, and from the strings that every match must hold a Boolean trigram
query is derived: an AND of ORs of ANDs of trigrams, over lower-cased text. The index holds the
postings (trigram, text) of the trigrams that the rules ask for, where a text is named by a hash;
intersecting them by text gives each text's candidate rules, and only those patterns are run on it. A
rule without mandatory trigrams (the hex rule) scans every text.

Postings name texts, not rows: copies share them, and rows with equal or null doc_id are no matter. Two
texts of one hash share them as well, which can only add candidates. Only texts with a candidate, thinned
by a bitmap, move to meet the index; all others are scanned where they are. A null or empty text has no
spans; a text of any length is taken whole, and no rule of RULES takes longer than its length asks for; an empty table gives no rows; other columns are left aside.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.llm import common, spans

#: Fixed patterns: name, pattern, and for the base kinds what a match needs beside it.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES: dict[str, str] = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[baprs]-[A-Za-z0-9-]{10,}",
    "stripe": r"sk_live_[A-Za-z0-9]{24,}",
    "google": r"AIza[A-Za-z0-9_-]{35}",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "private_key": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----",
}
BASE = ["assign", "access", "hex"]
#: Patterns that find the same spans as a rule's, in one pass over any text, with what leads to a span in group 1.
#: In a run without dots only its first "eyJ" can begin a token, for it leaves the longest rest of the run.
LINEAR: dict[str, str] = {
    "jwt": r"(?<![A-Za-z0-9_-])(?>([A-Za-z0-9_-]*?)eyJ)[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+",
}
#: Most alternatives that a run of a pattern may spell before it is cut there.
SPELLINGS = 64

Query = list[list[frozenset[str]]]


def trigram_query(pattern: str) -> Query:
    """AND over the list, OR over each inner list, AND over each set of trigrams."""
    out: Query = []
    for strings in _runs(sre_parser.parse(pattern)):
        if strings and min(map(len, strings)) >= 3:
            low = {s.lower() for s in strings}
            out.append(sorted({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in low}, key=sorted))
    return out


def _runs(nodes) -> list[set[str]]:
    """Sets of strings of which each match holds one, one set for each run of spellable nodes."""
    out, run = [], {""}
    for op, arg in nodes:
        more = _spell(op, arg)
        if more is not None and len(run) * len(more) <= SPELLINGS:
            run = {a + b for a, b in product(run, more)}
            continue
        out.append(run)
        run = more if more is not None and len(more) <= SPELLINGS else {""}
        if more is None:
            if op is sre.SUBPATTERN:
                out += _runs(arg[3])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and arg[0] >= 1:
                out += _runs(arg[2])
    return [*out, run]


def _spell(op, arg) -> set[str] | None:
    """All strings that a node can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(a) for _, a in arg}
    if op is sre.SUBPATTERN:
        return _all(arg[3])
    if op is sre.BRANCH:
        parts = [_all(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] is not sre.MAXREPEAT and arg[1] <= 8:
        one = _all(arg[2])
        if one is not None and len(one) ** arg[1] <= 8:
            return {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)}
    return None


def _all(nodes) -> set[str] | None:
    run = {""}
    for op, arg in nodes:
        more = _spell(op, arg)
        if more is None or len(run) * len(more) > SPELLINGS:
            return None
        run = {a + b for a, b in product(run, more)}
    return run


def _any_of(wanted: list[str]) -> str:
    """A pattern that finds all places of some trigrams, overlapping ones too, in one pass."""
    tree: dict[str, dict[str, list[str]]] = {}
    for t in wanted:
        tree.setdefault(t[0], {}).setdefault(t[1], []).append(t[2])
    quoted = lambda c: "\\x{%x}" % ord(c)
    third = lambda cs: "[" + "".join(map(quoted, sorted(cs))) + "]"
    second = lambda x: "(?:" + "|".join(quoted(c) + third(cs) for c, cs in sorted(x.items())) + ")"
    first = "".join(map(quoted, sorted(tree)))
    return f"(?=[{first}])(?=(" + "|".join(quoted(c) + second(x) for c, x in sorted(tree.items())) + "))"


def postings(docs: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """The inverted index: trigram, key (hash of a text) and n (rows with that text), for each trigram
    that some rule's query names. docs: key and text."""
    wanted = sorted({t for p in rules.values() for part in trigram_query(p) for s in part for t in s})
    if not wanted:
        return docs.sparkSession.createDataFrame([], "trigram string, key long, n long")
    held = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_any_of(wanted)), F.lit(1)))
    held = docs.select("key", held.alias("held")).groupBy("key").agg(F.first("held").alias("held"), F.count("*").alias("n"))
    return held.select(F.explode("held").alias("trigram"), "key", "n")


def candidates(index: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """key, n, rules: the rules whose trigram query the text's postings meet."""
    held = index.groupBy("key").agg(F.collect_set("trigram").alias("held"), F.max("n").alias("n"))  # as many as the rules name at most

    def meets(query: Query) -> Column:
        out = F.lit(True)
        for part in query:
            some = F.lit(False)
            for s in part:
                some = some | (F.size(F.array_except(F.array(*map(F.lit, sorted(s))), "held")) == 0)
            out = out & some
        return out

    named = F.array_compact(F.array(*[F.when(meets(q), F.lit(n)) for n, p in rules.items() if (q := trigram_query(p))], F.lit(None).cast("string")))
    return held.select("key", "n", named.alias("rules")).where("size(rules) > 0")


def scan(docs: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """doc_id and, for each rule, the array of its spans that pass."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    found = common.table(candidates(postings(docs, rules), rules), "candidates")
    near, far = common.parted(docs, found, "key")
    none = F.array().cast("array<string>")
    both = common.hot_join(near, found, "key", "left").select("doc_id", "text", F.coalesce("rules", none).alias("rules"))
    both = both.unionByName(far.select("doc_id", "text", none.alias("rules")))
    out = []
    for kind, (name, pattern) in enumerate(rules.items()):
        linear = LINEAR.get(name) if rules is RULES else None
        all_ = spans.matches(F.col("text"), linear or pattern, kind, led=linear is not None)
        if name == "assign":
            all_ = F.filter(all_, lambda x: F.char_length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 6)
        due = F.array_contains("rules", name) if trigram_query(pattern) else F.col("text").rlike(pattern)
        out.append(F.when(due, all_).otherwise(spans.none()).alias(name))
    return both.select("doc_id", *out)


def digest(found: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, the hash of their spans, and all spans."""
    names = [*rules]

    def by_place(columns: list[str]) -> Column:
        return F.array_sort(F.transform(F.concat(*columns), lambda x: F.struct(x["start"], x["kind"], x["stop"])))

    return found.select(
        "doc_id", *[spans.count(F.col(n)).alias(f"n_{n}") for n in BASE],
        F.sha2(spans.joined(by_place(BASE), names).cast("binary"), 256).alias("base_sha256"),
        spans.joined(by_place(names), names).alias("spans"))
