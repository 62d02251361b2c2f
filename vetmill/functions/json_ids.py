"""Whole numbers found by walking JSON of any shape, in Arrow batches; nothing built in recurses."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keys whose values are ids.
ID_KEYS = ("id", "alertId", "reminderId")
LABEL_KEYS = ("reminderLabelId", "reminder_id", "reminderId")


def _number(v) -> int | None:
    if isinstance(v, bool):
        return None  # a stated deviation: true and false are no ids
    if isinstance(v, int):
        return v
    return int(v) if isinstance(v, str) and v.strip().isascii() and v.strip().isdigit() else None


def walk(node, keys: tuple[str, ...], leaves: bool) -> list[int]:
    """Ids in pre-order, each once. Iterative, so depth has no limit; leaves: digit texts count too."""
    out: dict[int, None] = {}
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            for k in keys:
                if (n := _number(x.get(k))) is not None:
                    out[n] = None
            stack += reversed(x.values())
        elif isinstance(x, list):
            stack += reversed(x)
        elif leaves and isinstance(x, str) and (n := _number(x)) is not None:
            out[n] = None
    return [n for n in out if -(2**63) <= n < 2**63]


def _parsed(raw):
    try:
        return json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return raw


def json_ids(raw: Column, keys: tuple[str, ...] = ID_KEYS, leaves: bool = True, first_of: tuple[str, ...] = ()) -> Column:
    """Ids of a JSON text. first_of: of an object, the first of these keys whose list has ids is
    taken alone. Text that is no JSON is itself a leaf; null and '' have no ids."""
    @F.pandas_udf("array<bigint>")
    def ids(texts: pd.Series) -> pd.Series:
        def one(t):
            node = _parsed(t)
            if isinstance(node, dict):
                for k in first_of:
                    if isinstance(node.get(k), list) and (got := walk(node[k], keys, leaves)):
                        return got
            return walk(node, keys, leaves)

        return texts.map(one)

    return ids(raw)


def json_or_text(raw: Column) -> Column:
    """Struct of json (null if '' or no JSON) and text (the raw text where it is no JSON)."""
    ok = F.try_parse_json(raw).isNotNull()
    return F.struct(F.when(ok, raw).alias("json"), F.when(~ok & (raw != ""), raw).alias("text"))
