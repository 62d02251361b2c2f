import hashlib
import json

import pyspark.sql.functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from vetmill.functions import hashing, json_ids, text


def values(spark, column, rows, ddl="x string"):
    return [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {ddl}").orderBy("i").select(column).collect()]


def test_text(spark):
    rows = [None, "", "  a  b\t\n c ", "x  y", "\x1c z\x85", "Straße", "ΟΔΟΣ", "0"]
    assert values(spark, text.norm_text("x"), rows) == ["", "", "a b c", "x y", "z", "Straße", "ΟΔΟΣ", "0"]
    assert values(spark, text.fold_key("x"), rows) == [(r or "").casefold() if r not in (rows[2], rows[3], rows[4]) else w for r, w in zip(rows, ["", "", "a b c", "x y", "z", "", "", ""], strict=True)]
    assert values(spark, text.norm_or_null("x"), ["  ", "a"]) == [None, "a"] and values(spark, text.norm_falsy("x"), ["0", "7", None]) == ["", "7", ""]
    assert values(spark, text.phone_digits("x"), ["+1 (555) 01-2", None, "none", "٣4"]) == ["155501" + "2", "", "", "٣4"]
    assert values(spark, text.to_int("x"), ["12", " 7 ", "-5", "5.0", "", None, "99999999999999999999"]) == [12, 7, None, None, None, None, None]
    assert values(spark, text.token_key("x"), ["Doe,  Jo", "jo DOE", None]) == ["doe jo", "doe jo", ""]
    assert text.norm_header("  Patient_PMS  ID ") == "patient pms id"


def test_contact_details(spark):
    ddl = "x array<struct<type:string,kind:string,value:string,number:string,email:string>>"
    fields = ["type", "kind", "value", "number", "email"]
    rows = [None, [], [("Email", None, "a@b", None, None), (None, "MOBILE", "", "12", None)], [(None, None, "7", None, None)], [("fax", None, "7", None, None)], [("x-email", None, None, None, "  q@r ")]]
    assert values(spark, text.first_phone("x", fields), rows, ddl) == [None, None, "12", "7", None, None]
    assert values(spark, text.first_email("x", fields), rows, ddl) == [None, None, "a@b", None, None, "q@r"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=8), min_size=1, max_size=8))
def test_hash_like_json(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    rows = [(i, t, i % 2 == 0, i, (t, None)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, b string, a boolean, c long, d struct<y:string,x:string>")
    got = df.orderBy("i").select(hashing.row_hash(df, ["b", "a", "c", "d"])).collect()
    want = [hashlib.sha256(json.dumps({"b": b, "a": a, "c": c, "d": {"y": d[0], "x": d[1]}}, sort_keys=True, separators=(",", ":")).encode()).hexdigest() for _, b, a, c, d in rows]
    assert [r[0] for r in got] == want


def test_json_ids(spark):
    rows = ['{"alerts":[{"id":1},{"id":2}],"id":9}', '{"a":{"reminderId":"5","id":-3},"b":["4","x",true]}', "not json", "", None, "[]", '{"data":[],"items":[{"id":6}]}', '"12"']
    keys = ("alerts", "data", "items", "results")
    assert values(spark, json_ids.json_ids(F.col("x"), first_of=keys), rows) == [[1, 2], [-3, 5, 4], [], [], [], [], [6], [12]]
    assert values(spark, json_ids.json_ids(F.col("x")), rows[:2]) == [[9, 1, 2], [-3, 5, 4]]
    assert values(spark, json_ids.json_ids(F.col("x"), json_ids.LABEL_KEYS, False), ['{"reminderLabelId":777,"k":[{"reminder_id":"8"}],"z":"9"}']) == [[777, 8]]
    got = values(spark, json_ids.json_or_text(F.col("x")), ['{"a":1}', "raw", "", None])
    assert [(r.json, r.text) for r in got] == [('{"a":1}', None), (None, "raw"), (None, None), (None, None)]
    assert json_ids.walk(json.loads("[" * 900 + "{\"id\":1}" + "]" * 900), json_ids.ID_KEYS, True) == [1]


def test_casefold_of_every_character(spark):
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rows = ["a" + "".join(map(chr, points[k : k + 500])) + "ZΣς" for k in range(0, len(points), 500)]
    assert values(spark, text.casefold("x"), rows) == [r.casefold() for r in rows]
    assert values(spark, text.fold_key("x"), ["ﬁn ŉ ΐ ǰ  İ", "MASSE maße", "𐐀 Ⅷ"]) == ["fin ʼn ΐ ǰ i̇".casefold(), "masse masse", "𐐨 ⅷ"]
