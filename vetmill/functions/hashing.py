"""SHA-256 over canonical JSON: sorted keys, no spaces, nulls written, everything but ASCII escaped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StructType


def _escaped(text: Column) -> Column:
    """A JSON string body; only texts that need it are taken apart, character by character."""
    def hex4(n: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n.cast("bigint")), 4, "0")))

    def one(c: Column) -> Column:
        n = F.ascii(c)
        pair = F.concat(hex4((n - 0x10000).bitwiseAND(0xFFC00) / 1024 + 0xD800), hex4((n - 0x10000).bitwiseAND(0x3FF) + 0xDC00))
        out = F.when(c == '"', F.lit('\\"')).when(c == "\\", F.lit("\\\\"))
        for raw, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
            out = out.when(c == raw, F.lit(name))
        return out.when(n > 0xFFFF, pair).when((n < 32) | (n > 126), hex4(n)).otherwise(c)

    parts = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one)
    return F.when(text.rlike(r'[^\x20-\x7e]|["\\]'), F.array_join(parts, "")).otherwise(text)


def json_value(value: Column, kind: DataType) -> Column:
    """A value as canonical JSON text, never null."""
    if isinstance(kind, StructType):
        out = canonical_json({f.name: (value[f.name], f.dataType) for f in kind})
    elif isinstance(kind, ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: json_value(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, BooleanType | NumericType):
        out = value.cast("string")
    else:
        out = F.concat(F.lit('"'), _escaped(value.cast("string")), F.lit('"'))
    return F.when(value.isNull(), F.lit("null")).otherwise(out)


def canonical_json(fields: dict[str, tuple[Column, DataType]]) -> Column:
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        parts += [F.lit(f'{"," if i else "{"}"{name}":'), json_value(*fields[name])]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def stable_hash(fields: dict[str, tuple[Column, DataType]]) -> Column:
    return F.sha2(canonical_json(fields).cast("binary"), 256)


def row_hash(df, names: list[str]) -> Column:
    """stable_hash over columns of a DataFrame."""
    kinds = {f.name: f.dataType for f in df.schema}
    return stable_hash({n: (F.col(n), kinds[n]) for n in names})
