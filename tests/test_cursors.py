import random

from vetmill.operators.normalize import normalize_appointments
from vetmill.plans import queries
from vetmill.sources import cursors, feeds

DDL = "page_no string, cursor string, next_cursor string, data array<struct<id:int>>"


def judged(spark, pages):
    ordered, lost = cursors.order_pages(spark.createDataFrame(pages, DDL), "accounts")
    return sorted((r.page_rank, r.page_no, r.first_pos) for r in ordered.collect()), {r.page_no: r.reason for r in lost.collect()}


def test_order_of_a_shuffled_chain(spark):
    pages = [(f"f{(k * 37) % 101}", f"c{k}" if k else None, f"c{k + 1}" if k < 100 else "", [(i,) for i in range(k % 4)] or None) for k in range(101)]
    want = [(k, p[0], sum(len(q[3] or []) for q in pages[:k])) for k, p in enumerate(pages)]
    random.Random(1).shuffle(pages)
    assert judged(spark, pages) == (want, {})


def test_broken_chains(spark):
    one = [(1,)]
    pages = [("a0", None, "x", one), ("a1", "x", "y", one), ("again", "x", "y", one), ("fork1", "y", "z", one), ("fork2", "y", "z", [(2,)]), ("after", "z", None, one),
             ("loop1", "l1", "l2", one), ("loop2", "l2", "l1", one), ("self", "s", "s", one), ("m1", "q1", "q", one), ("m2", "q2", "q", one), ("tail", "q", None, one)]
    ordered, lost = judged(spark, pages)
    assert [x[:2] for x in ordered] == [(0, "a0"), (1, "a1")]
    assert lost == {"again": "repeat", "fork1": "fork", "fork2": "fork", "after": "gap", "loop1": "loop", "loop2": "loop", "self": "loop", "m1": "merge", "m2": "merge", "tail": "gap"}


def test_no_pages(spark):
    assert judged(spark, []) == ([], {})


def test_cursors_and_text_ids_of_landed_pages(spark, tmp_path):
    (tmp_path / "z").write_text('{"data":[{"id":"a-1","appointmentTypeId":"7","patientId":"12"},{"id":5,"patientId":8}],"metadata":{"after":"c1","before":null}}')
    (tmp_path / "a").write_text('{"appointments":[{"id":6,"appointmentTypeId":9}],"nextPageCursor":"","pageCursor":"c1"}')
    (tmp_path / "m").write_text('[{"id":"alone"}]')
    pages = feeds.read_pages(spark, str(tmp_path), "appointments")
    rows, lost = cursors.flatten_in_order(pages.where("not page_no like '%/m'"), "appointments")
    got = [tuple(r) for r in normalize_appointments(rows.orderBy("feed_pos")).select("appointment_id", "appointment_type_id", "patient_id").collect()]
    assert got == [("a-1", "7", "12"), ("5", None, "8"), ("6", "9", None)] and lost.count() == 0
    # a bare list stands for a first page: two of them, or one beside another first page, are a fork
    assert {r.reason for r in cursors.order_pages(pages, "appointments")[1].collect()} == {"fork", "gap"}


def test_more_rows_land_in_more_pages(spark, tmp_path, monkeypatch):
    """Pages stay small as the tables grow, and each is parsed once: no filter asks for the size of its lists first."""
    monkeypatch.setattr(queries, "_LANDED", 50)
    rows = queries.QUERIES["feeds_landed"](spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and ("from_json" in line or "size(" in line)]
    files = [f for f in rows.inputFiles() if "/reminders-" in f]
    assert len(files) > 60 and all(f.endswith(".gz") for f in files)
