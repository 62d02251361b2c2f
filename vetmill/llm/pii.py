"""Personal data: patterns propose spans, validators confirm them, nearby words adjust the score.

DataFrame functions only. Each pattern gives the leftmost non-overlapping matches of the plain
pattern in its comment; look-behinds and possessive repeats only keep the time linear in the text.
Base kinds (email, ip, card, phone) are kept whatever their score; the others from THRESHOLD on.
A null or empty text has no spans; rows with equal or null doc_id stay apart; a text of any length is
taken whole, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.llm import spans

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Fixed patterns.
PATTERNS: dict[str, str] = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits: such a match is a whole run
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ["email", "ip", "card", "phone"]
#: Cheap tests that a text with a match passes.
HINTS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
DIGITS = {"card": "[0-9][ -]?[0-9]", "iban": "[0-9]{2}"}
#: Score of a confirmed span, what a word nearby adds, and the words (fixed values).
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
NEARBY = 0.3
WORDS = {
    "email": "mail|contact|kontakt|courriel|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|telephone|telefono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|taxpayer",
}
THRESHOLD = 0.5
#: Code points on either side in which words count as nearby.
WINDOW = 40


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn checksum."""
    def at(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    parts = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), at)
    return F.aggregate(parts, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number of capital letters and digits passes ISO 7064 mod 97-10."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.filter(F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), ""), lambda c: c != "")
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    return F.aggregate(turned, F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97) == 1


def confirmed(name: str, hit: Column) -> Column:
    """What a match of a kind needs beside its pattern."""
    if name == "ip":
        return hit.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])?(?:\.|$)){4}$")
    if name == "card":
        return luhn(_digits(hit))
    if name == "phone":
        return F.char_length(_digits(hit)).between(8, 15)
    if name == "iban":
        return mod97(hit)
    if name == "ssn":
        return ~hit.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _test(name: str):
    return lambda x: confirmed(name, x["hit"])


def find(docs: DataFrame) -> DataFrame:
    """doc_id and pii: a struct with an array for each kind, of spans with kind, start, stop, hit and
    score. Other columns are left aside, so their names cannot clash."""
    return _found(docs.select(F.struct("doc_id").alias("row"), "text")).select("row.*", "pii")


def _found(docs: DataFrame) -> DataFrame:
    """row, text (null as empty) and pii, from row and text."""
    docs = docs.select("row", F.coalesce("text", F.lit("")).alias("text"))
    text, held = F.col("text"), []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        due = F.contains(text, F.lit(HINTS[name])) if name in HINTS else text.rlike(DIGITS[name])
        proposed = F.filter(spans.matches(text, pattern, kind), _test(name))
        held.append(F.when(due, proposed).otherwise(spans.none()).alias(name))
    docs = docs.select("row", "text", *held)

    def scored(name: str, parts: Column):
        words = rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{WORDS[name]})(?![\p{{L}}\p{{N}}])"

        def score(x: Column) -> Column:
            left = F.greatest(x["start"] - WINDOW, F.lit(0))
            around = F.concat_ws(" ", spans.cut(parts, left, x["start"]), spans.cut(parts, x["stop"], x["stop"] + WINDOW))
            near = F.when(around.rlike(words), F.lit(NEARBY)).otherwise(F.lit(0.0))
            return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"),
                            x["hit"].alias("hit"), F.least(F.lit(SCORES[name]) + near, F.lit(1.0)).alias("score"))

        return score

    def all_(parts: Column) -> Column:
        out = []
        for name in PATTERNS:
            got = F.transform(F.col(name), scored(name, parts))
            out.append((got if name in BASE else F.filter(got, lambda x: x["score"] >= THRESHOLD)).alias(name))
        return F.struct(*out)

    some = sum((F.size(n) for n in PATTERNS), F.lit(0)) > 0
    parts = F.when(some, spans.blocks(text)).otherwise(F.array().cast("array<string>"))
    return docs.select("row", "text", spans.let(parts, all_).alias("pii"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the hash of their spans by kind, and all spans by kind."""
    names = [*PATTERNS]
    lists = lambda kinds: F.concat(*[F.col("pii")[n] for n in kinds])
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[spans.count(F.col("pii")[n]).alias(f"n_{n}") for n in BASE],
        F.sha2(spans.joined(lists(BASE), names).cast("binary"), 256).alias("base_sha256"),
        spans.joined(lists(names), names).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The same columns, whatever their names; each span of the text is replaced by its kind in brackets,
    spans that overlap together by the kind of the first (of those that start together the longest), and
    n_chars follows the text. Texts without spans, null among them, stay as they are."""
    found = _found(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"))
    spots = F.array_sort(F.transform(F.concat(*[F.col("pii")[n] for n in PATTERNS]), lambda x: F.struct(
        x["start"].alias("start"), (-x["stop"]).alias("stop"), x["kind"].alias("kind"))))
    labels = F.array(*[F.lit(f"[{n.upper()}]") for n in PATTERNS])
    text = F.col("text")

    def joined(spots: Column) -> Column:
        """From spots to where each group of overlapping ones starts and stops, and then to the text."""
        ends = F.transform(spots, lambda x: -x["stop"])

        def groups(reach: Column) -> Column:  # how far the spots before each one reach
            all_ = F.transform(spots, lambda x, i: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), F.get(reach, i).alias("reach")))
            return F.filter(all_, lambda x: x["start"] >= x["reach"])

        def pieces(heads: Column) -> Column:
            def one(parts: Column) -> Column:
                said = F.transform(heads, lambda x, i: F.concat(spans.cut(parts, x["reach"], x["start"]), F.get(labels, x["kind"])))
                return F.concat(F.array_join(said, ""), spans.cut(parts, F.array_max(ends), F.char_length(text).cast("bigint")))

            return spans.let(spans.blocks(text), one)

        reach = spans.running(ends, lambda a, v: F.greatest(a, v))
        return spans.let(spans.let(reach, groups), pieces)

    new = F.when(F.size(spots) > 0, spans.let(spots, joined)).otherwise(F.col("row")["text"])
    found = found.select("row", new.alias("text"))
    out = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[out.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
