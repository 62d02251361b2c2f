"""Scalar column expressions for names, phones, ids and contact details. All stay in the JVM."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; the JVM's plain \s leaves the no-break space.
WHITE = r"[\s\x1c-\x1f\x85\xa0  -     　]+"


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c: Column | str) -> Column:
    """Text with runs of white space as one space, without any at the ends; null is ''."""
    return F.trim(F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), WHITE, " "))


def norm_or_null(c: Column | str) -> Column:
    """norm_text, with blank as null."""
    return F.nullif(norm_text(c), F.lit(""))


def norm_falsy(c: Column | str) -> Column:
    """norm_text for a numeric id, where 0 counts as missing."""
    return norm_text(F.nullif(col(c).cast("string"), F.lit("0")))


def norm_header(name: str) -> str:
    """A column name for matching: lower case, _ as space, runs of white space as one space."""
    return " ".join(name.strip().lower().replace("_", " ").split())


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """What case folding makes of single characters: those that become one other, what they become, and those that become
    several. A table of some 1,500 characters, made by asking Python for each there is."""
    folds = {c: c.casefold() for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]) if c.casefold() != c}
    one = {c: f for c, f in folds.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in folds.items() if len(f) > 1}


def casefold(c: Column | str) -> Column:
    """A text for comparison without case, as str.casefold gives it for every character. Stays in the JVM: ASCII by lower(),
    other texts by a table; characters that fold to several, sharp s aside, are looked up one by one."""
    text, (one, to, several) = col(c), _folds()
    folded = F.translate(F.replace(text, F.lit("ß"), F.lit("ss")), UPPER + one, UPPER.lower() + to)
    table = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    rare = "[" + "".join(k for k in several if k != "ß") + "]"
    spelled = F.array_join(F.transform(F.split(folded, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    return F.when(text.rlike(r"^\p{ASCII}*$"), F.lower(text)).when(folded.rlike(rare), spelled).otherwise(folded)


def fold_key(c: Column | str) -> Column:
    """norm_text, case-folded."""
    return casefold(norm_text(c))


def token_key(c: Column | str) -> Column:
    """The words of a folded name in order, commas aside, so that 'Last, First' meets 'First Last'."""
    words = F.split(F.replace(fold_key(c), F.lit(","), F.lit(" ")), " ")
    return F.array_join(F.sort_array(F.filter(words, lambda w: w != "")), " ")


def phone_digits(c: Column | str) -> Column:
    """The decimal digits of a text; null is ''."""
    return F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"\P{Nd}", "")


def to_int(c: Column | str) -> Column:
    """Whole numbers as they are, texts of ASCII digits as numbers, anything else null."""
    text = F.trim(F.regexp_replace(col(c).cast("string"), WHITE, " "))
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def _filled(item: Column, names: list[str], fields: list[str]) -> Column:
    """The first of an item's fields that is present and not empty."""
    parts = [F.nullif(item[f].cast("string"), F.lit("")) for f in fields if f in names]
    return F.coalesce(*parts, F.lit(None).cast("string"))


def first_phone(details: Column | str, fields: list[str]) -> Column:
    """First value of a kind that names a phone or mobile, or of no kind; fields: the items' fields."""
    def one(item: Column) -> Column:
        kind = F.lower(F.coalesce(_filled(item, fields, ["type", "kind"]), F.lit("")))
        return F.when(kind.contains("phone") | kind.contains("mobile") | (kind == ""), _filled(item, fields, ["value", "number", "phoneNumber"]))

    return F.get(F.filter(F.transform(col(details), one), lambda v: v.isNotNull()), 0)


def first_email(details: Column | str, fields: list[str]) -> Column:
    """First value of a kind that names email, normalized, blank as null."""
    def one(item: Column) -> Column:
        kind = F.lower(F.coalesce(_filled(item, fields, ["type", "kind"]), F.lit("")))
        return F.when(kind.contains("email"), _filled(item, fields, ["value", "email"]))

    return norm_or_null(F.get(F.filter(F.transform(col(details), one), lambda v: v.isNotNull()), 0))


def display_name(*parts: Column | str) -> Column:
    """Normalized parts of a name joined by one space; null if all are blank."""
    return F.nullif(F.concat_ws(" ", *[norm_or_null(p) for p in parts]), F.lit(""))


def reminder_patient_id(columns: list[str]) -> Column:
    """First coercible of patientId, patient_id and patient.id, as far as the feed has them."""
    parts = [to_int(F.col(c)) for c in ("patientId", "patient_id") if c in columns]
    if "patient" in columns:
        parts.append(to_int(F.col("patient")["id"]))
    return F.coalesce(*parts, F.lit(None).cast("bigint"))


def strip(c: Column | str) -> Column:
    """A value as text without white space of any kind at its ends; null as empty."""
    return F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), f"^{WHITE}|{WHITE}$", "")


def blank(c: Column | str) -> Column:
    return strip(c) == ""
