import datetime

import pytest

from vetmill.operators import reminders

SHEET = "file string, sheet string, row_number int, client string, client_name string, phone_no string, patient_name string, species string, breed string, code string, item_due string, due_date string, due_date_typed date"
N = None


def sheet(spark, rows):
    return spark.createDataFrame([("f", r[0], r[1], *r[2:]) if len(r) == 12 else r for r in rows], SHEET)


def rows(spark):
    day = datetime.date(2026, 3, 4)
    return sheet(spark, [
        ("s", 2, " C1 ", "Jo  Doe", "555", "Rex", "dog", N, "A", "Annual Wellness Exam", "1/2/26", N),
        ("s", 3, N, "", " ", N, N, N, "B", "Heartgard plus 26", "2-3-69", N),
        ("s", 4, N, N, N, N, N, N, N, N, N, N),
        ("s", 5, N, N, N, N, N, N, "C", "late", "1/1/26", N),
        ("s", 6, "C2", N, N, "Tom", N, N, "D", "Microchip Implant", "nope", N),
        ("s", 7, "C3", N, N, "Kit", N, N, "", "", N, N),
        ("s", 8, "C4", N, N, "Pip", N, N, "E", "", "1/1/26", N),
        ("s", 9, N, N, N, N, N, N, "F", "Physical Exam", N, day),
        ("s", 10, N, N, N, N, N, N, "G", "Microchip Implant", "1/1/26", N),
        ("s", 11, N, N, N, N, N, N, "H", "unknown", "1/1/26", N),
        ("t", 2, N, N, N, N, N, N, "Z", "first", "1/1/26", N),
    ])


def test_groups(spark):
    good, bad = reminders.group_sheet_rows(rows(spark))
    got = {(r.sheet, r.row_number): (r.header_row, r.client, r.patient_name) for r in good.collect()}
    assert got == {("s", 2): (2, "C1", "Rex"), ("s", 3): (2, "C1", "Rex"), ("s", 6): (6, "C2", "Tom"), **{("s", n): (8, "C4", "Pip") for n in (8, 9, 10, 11)}}
    assert sorted((r.sheet, r.row_number, r.reason) for r in bad.collect()) == [("s", 5, "continuation_without_header"), ("s", 7, "header_without_reminder"), ("t", 2, "continuation_without_header")]
    with pytest.raises(Exception, match="continuation_without_header|header_without_reminder"):
        reminders.group_sheet_rows(rows(spark), strict=True)[0].collect()


def test_classes_and_plans(spark):
    done = reminders.classify_reminders(reminders.group_sheet_rows(rows(spark))[0])
    got = {r.row_number: (r.reason, r.mapped_label, r.due) for r in done.collect()}
    assert got == {
        2: (N, "Annual Exam", "2026-01-02"), 3: (N, "Heartworm Prevention", "1969-02-03"),
        6: ("bad_due_date: Unsupported due date format: 'nope'", N, N), 8: ("missing_source_label", N, N),
        9: (N, "Annual Exam", "2026-03-04"), 10: ("excluded_non_reminder_item", N, N), 11: ("no_mapping", N, N)}
    plans = {r.header_row: r for r in reminders.build_plans(done).collect()}
    assert [x.row_number for x in plans[2].valid_reminders] == [2, 3] and plans[6].valid_reminders == []
    assert [x.reason for x in plans[8].skipped_rows] == ["missing_source_label", "excluded_non_reminder_item", "no_mapping"]
    assert [r.header_row for r in reminders.first_plans(reminders.build_plans(done), 2).collect()] == [2, 6]
    assert reminders.first_plans(reminders.build_plans(done), 0).count() == 0
    assert {r.reason: r.n for r in reminders.reason_counts(done).collect()} == {"valid": 3, "bad_due_date": 1, "missing_source_label": 1, "excluded_non_reminder_item": 1, "no_mapping": 1}
    assert '"skipped_rows":[]' in reminders.plan_json(reminders.build_plans(done)).where("header_row = 2").first().plan


def test_due_dates(spark):
    cases = {"1/2/2024": "2024-01-02", "01/02/24": "2024-01-02", "1-2-2024": "2024-01-02", "12-31-68": "2068-12-31", "12-31-69": "1969-12-31", " 1/2/24 ": "2024-01-02",
             "2/30/2024": None, "13/1/2024": None, "2024-01-02": None, "1/2-2024": None, "": None, "  ": None, None: None, "1/2/024": None}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r.raw: (r.d, r.e) for r in df.select("raw", reminders.parse_due_date("raw").cast("string").alias("d"), reminders.due_date_error("raw").alias("e")).collect()}
    assert {k: v[0] for k, v in got.items()} == cases
    assert got[""][1] == got[None][1] == "Missing due date" and got["  "][1] == "Unsupported due date format: ''" and got["1/2/2024"][1] is None


def test_labels(spark):
    cases = {"Physical Exam": "Annual Exam", "physical exam": None, "HEARTGARD plus x": "Heartworm Prevention", "Heartgard Plusx": None, "Microchip Implant": None, "Simparica Trio": "Flea / Tick / Heartworm Prevention",
             "nexgard combo for cats 1": "Flea / Tick / Heartworm Prevention", "Antech Fecal": "Fecal Analysis", "inject - proheart 12 q": "ProHeart 12 Injection", "my Heartgard Plus": None,
             "Revolution Plus Cat 1": "Flea / Tick / Heartworm Prevention", "credelio for cats": "Flea / Tick Prevention", "Nexgard Plus for Dogs": "Flea / Tick / Heartworm Prevention", "": None}
    df = spark.createDataFrame([(k,) for k in cases], "label string")
    assert {r.label: r.m for r in df.select("label", reminders.map_label(df.label).alias("m")).collect()} == cases
    assert df.select(reminders.map_label(df.label, {}, [("my", "M")], []).alias("m")).where("m is not null").count() == 1


def test_giant_sheets_give_the_same_rows(spark):
    """Stretches that begin within a group, in the middle of rows without a group, and at a sheet's start."""
    import random

    rng = random.Random(4)
    cells = [("c{}", "n", None, "p", None, None, "x", "y", "z"), (None,) * 9, (None,) * 6 + ("x", "y", "z"), ("c", None, None, None, None, None, None, None, None)]
    rows = [("f", sheet, i + 2, *[v and v.format(i) for v in rng.choices(cells, [2, 2, 30, 1])[0]]) for sheet, n in (("one", 700), ("two", 3), ("three", 1)) for i in range(n)]
    rng.shuffle(rows)
    ddl = "file string, sheet string, row_number long, client string, client_name string, phone_no string, patient_name string, species string, breed string, code string, item_due string, due_date string"
    df = spark.createDataFrame(rows, ddl)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for some in (df, df.limit(0)):
            for plain, giant in zip(reminders.group_sheet_rows(some), reminders.group_sheet_rows(some, giant=True), strict=True):
                assert plain.columns == giant.columns
                assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, giant.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
