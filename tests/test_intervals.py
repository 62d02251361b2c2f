import random

from vetmill.operators import audit, intervals

REMINDERS = "n int, patientId string, dueAt string, deactivatedAt string, sentAt string"
QUERIES = "query_id int, patient_id long, status string, due_after string, due_before string"


def made(spark, rng):
    day = lambda: f"2024-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}" + rng.choice(["", "T10:00Z"])
    due = lambda: rng.choice([None, "", "soon", "2024-05-05", "2024-05-05", day(), day(), day()])
    rows = [(i, rng.choice(["1", "1", "1", "2", " 3", None, "x"]), due(), rng.choice([None, "y"]), rng.choice([None, "z"])) for i in range(400)]
    asks = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, "", "active", "sent", "unsent", "inactive", "odd"]), rng.choice([None, "", day(), day()]), rng.choice([None, day(), day()])) for i in range(150)]
    return spark.createDataFrame(rows + rows[:30], REMINDERS), spark.createDataFrame(asks, QUERIES)


def test_binned_like_plain(spark):
    rng = random.Random(5)
    reminders, queries = made(spark, rng)
    want = sorted(map(repr, audit.filter_reminders_bulk(reminders, queries).collect()))
    for chunk in (4, 37, 1000):
        assert sorted(map(repr, intervals.filter_reminders_binned(reminders, queries, chunk).collect())) == want
    assert len(want) > 500


def test_cells_are_small(spark):
    reminders, queries = made(spark, random.Random(6))
    rows, asks = intervals.cells(reminders, queries, 20)
    assert rows.groupBy(*intervals.CELL).count().selectExpr("max(count)").first()[0] <= 3 * 20  # 430 rows, 180 of one patient
    assert asks.groupBy(*intervals.CELL).count().selectExpr("max(count)").first()[0] <= 2 * 20
    assert rows.select("_bin").distinct().count() > 4


def test_no_rows(spark):
    reminders, queries = made(spark, random.Random(7))
    assert intervals.filter_reminders_binned(reminders.limit(0), queries, 5).count() == 0
    assert intervals.filter_reminders_binned(reminders, queries.limit(0), 5).count() == 0


def test_equal_rows_travel_once_and_come_back(spark, monkeypatch):
    """Many equal reminders, and many queries of which few visit a day: reminders are not copied for queries of other days."""
    monkeypatch.setattr(intervals, "RUN", 7)
    day = lambda i: f"2024-{i % 12 + 1:02}-{i % 28 + 1:02}"
    reminders = spark.createDataFrame([(i % 300, "1", day(i % 300), None, None) for i in range(6000)], REMINDERS)
    queries = spark.createDataFrame([(i, 1, None, day(i), day(i)) for i in range(400)], QUERIES)
    rows, _ = intervals.cells(reminders, queries, 20)
    assert rows.count() <= 1200 and rows.dropDuplicates(["n"]).count() == 300
    want = sorted(map(repr, audit.filter_reminders_bulk(reminders, queries).collect()))
    assert sorted(map(repr, intervals.filter_reminders_binned(reminders, queries, 20).collect())) == want and len(want) > 20000
