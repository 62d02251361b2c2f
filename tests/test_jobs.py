import json

import pytest
from pyspark.sql import functions as F

from vetmill.operators import audit, inventory, normalize, payloads, resolve, sync
from vetmill.sources import feeds
from vetmill.streaming import sync as stream

ACC = "account_id string, pims_code string, pims_id string, display_name string, primary_phone string, feed_pos int"
SRC = "src_id int, client string, client_name string, phone_no string, patient_name string"


def test_resolution(spark):
    accounts = spark.createDataFrame([("a1", "100", None, "Jo Doe", "555", 1), ("a2", "200", "100", "Jo  Doe", "777", 2), ("a3", "300", "P9", "Ann Lee", "", 3), ("", "400", None, "No Id", "", 4), ("a5", "P9", None, "Kim Fox", "1", 5), ("a5", "P9", None, "Kim Fox", "1", 6)], ACC)
    src = spark.createDataFrame([(1, "300", "x", "", "Rex"), (2, "100", "", "", "Rex"), (3, "", "Jo Doe", "777", "Rex"), (4, "", "jo doe", "", "Rex"), (5, "", "Lee, Ann", "", "Rex"), (6, "zzz", "No Id", "", "Rex"), (7, "", "", "", "Rex"), (8, "P9", "", "", "Rex"), (9, "nope", "Nobody", "", "Rex")], SRC)
    strict = {r.src_id: (r.account_id, r.account_status) for r in resolve.resolve_accounts(src, accounts).collect()}
    assert strict == {1: ("a3", "resolved"), 2: (None, "ambiguous"), 3: ("a2", "resolved"), 4: (None, "ambiguous"), 5: ("a3", "resolved"), 6: (None, "missing_id"), 7: (None, "not_found"), 8: (None, "ambiguous"), 9: (None, "not_found")}
    lenient = {r.src_id: (r.account_id, r.account_status) for r in resolve.resolve_accounts(src, accounts, "lenient").collect()}
    assert lenient == {1: ("a3", "resolved"), 2: ("a1", "resolved"), 3: ("a2", "resolved"), 4: ("a1", "resolved"), 5: ("a3", "resolved"), 6: (None, "missing_id"), 7: (None, "not_found"), 8: ("a5", "resolved"), 9: (None, "not_found")}
    patients = spark.createDataFrame([("p1", "REX ", "a3"), ("p2", "rex", "a1"), ("p3", "Rex", "a1"), (None, "rex", "a2")], "id string, name string, accountId string")
    got = {r.src_id: (r.patient_id, r.patient_status) for r in resolve.resolve_patients(resolve.resolve_accounts(src, accounts, "lenient"), patients).collect()}
    assert got[1] == ("p1", "resolved") and got[2] == (None, "ambiguous") and got[3] == (None, "missing_id") and got[7] == (None, "account_not_found") and got[8] == (None, "not_found")
    plans = spark.createDataFrame([(1, "300", "Rex", 2), (2, "100", "Rex", 1), (3, "", "Rex", 0)], "src_id int, client string, patient_name string, n_valid int")
    table = resolve.submission_table(plans, resolve.resolve_patients(resolve.resolve_accounts(src, accounts), patients))
    assert {r.src_id: r.status for r in table.collect()} == {1: "submitted", 2: "unresolved_account_ambiguous", 3: "skipped_no_valid_reminders"}
    with pytest.raises(ValueError):
        resolve.resolve_accounts(src, accounts, "other")


REM = "patientId string, patient_id string, patient struct<id:string>, dueAt string, deactivatedAt string, sentAt string"
PAT = ("id string, name string, accountId string, pimsCode string, account struct<primaryContact:struct<nameFirst:string,nameMiddle:string,nameLast:string,"
       "communicationDetails:array<struct<type:string,value:string>>>>")


def test_counts_and_filters(spark):
    rem = spark.createDataFrame([("7", None, None, "2026-01-01", None, None), (None, "7", None, "2026-12-31T10:00Z", "x", None), (None, None, ("7",), None, None, "y"), (None, None, None, "2026-01-01", None, None), ("bad", "8", None, "2026-06-01", None, None)], REM)
    pat = spark.createDataFrame([("7", "Rex", "a", "c", ((" Jo ", "Q  R", None, [("phone", "1-2")]),)), ("9", "Tom", "a", None, None), (None, "No", None, None, None)], PAT)
    got = {r.patient_name: r for r in audit.patient_audit(pat, rem).collect()}
    assert (got["Rex"].reminder_count, got["Rex"].client_name, got["Rex"].phone_no) == (3, "Jo Q  R", "1-2")
    assert got["Tom"].reminder_count == 0 and got["Tom"].client_name is None and got["No"].reminder_count is None
    assert {r.reminder_count for r in audit.patient_audit(pat, rem.where("dueAt = 'none'")).collect()} == {None}
    assert audit.patient_audit(pat, rem, limit=0).count() == 0
    n = lambda **q: audit.filter_reminders(rem, **q).count()
    assert (n(patient_id=7), n(patient_id=7, status="active"), n(status="inactive"), n(status="sent"), n(status="unsent"), n(status="odd")) == (3, 2, 1, 1, 4, 0)
    assert n(due_before="2026-12-31") == 3 and n(due_before="2026-12-31", as_date=True) == 4 and n(due_after="2026-06-01", due_before="2026-06-01") == 1
    q = spark.createDataFrame([(1, 7, "active", None, None), (2, 7, None, "2026-01-01", "2026-02-01"), (3, 8, "odd", None, None), (4, 8, "", "", "")], "query_id int, patient_id int, status string, due_after string, due_before string")
    assert sorted(r.query_id for r in audit.filter_reminders_bulk(rem, q).collect()) == [1, 1, 2, 4]


def test_list_audit(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_bytes(b'\xef\xbb\xbfPMS ID,Patient,Owner,Email,Phone,Species,Sex,sex\n 1 ,"A, ""x""",o,,1,dog,m,f\n1,B,o,e,,dog,,\n1,C,,,,dog,m,f\n2,D,o,e,1,,m,f\n2,,o,e,1,dog,m,f\n  ,E,o,e,1,dog,m,f\n')
    rows = feeds.read_csv(spark, str(path))
    assert audit.locate_columns(["PMS ID", "pet", "Patient Name", "sex", "SEX "])["sex"] == "SEX "
    r = audit.audit_patients(rows.drop("sex") if rows.columns.count("sex") else rows, audit.locate_columns(["PMS ID", "Patient", "Owner", "Email", "Phone", "Species"])).first()
    assert (r.total_rows, r.missing_identifier_rows, r.duplicate_identifier_values, r.missing_owner, r.missing_patient_name, r.missing_species, r.missing_breed) == (6, 1, 2, 1, 1, 1, 6)
    assert not r.has_unique_identifier and not r.has_required_fields
    none = audit.audit_patients(spark.createDataFrame([("x",)], "other string")).first()
    assert none.selected_identifier_column is None and none.missing_identifier_rows == 1 and none.duplicate_identifier_values == 0


def test_payloads_and_ids(spark):
    ddl = "accountId string, breedId int, name string, speciesId string, alertIds array<int>, reminderIds array<int>, color string"
    df = spark.createDataFrame([("a", 1, "n", "s", [41, 12, 41, 12], [60, 8], None), ("b", 1, None, "s", None, None, "red"), ("c", 1, "n", "s", None, None, "red")], ddl)
    good, bad = payloads.build_patient_payloads(df, 12, [7, 8])
    got = {json.loads(r.payload)["accountId"]: json.loads(r.payload) for r in good.collect()}
    assert got["a"]["alertIds"] == [41, 12] and got["a"]["reminderIds"] == [60, 8, 7] and "color" not in got["a"] and got["c"]["color"] == "red" and got["c"]["alertIds"] == [12]
    assert [(r.accountId, r.reason) for r in bad.collect()] == [("b", "name")]
    sample = payloads.build_patient_payloads(payloads.sample_patient(spark, "a", "Trial", 12, "canine", "unknown"), 1)[0].first().payload
    assert "pimsCode" not in json.loads(sample)
    alerts = spark.createDataFrame([(1, '{"alerts":[{"id":64},{"id":2}]}'), (0, "bad")], "feed_pos int, raw string")
    rem = spark.createDataFrame([(0, '{"reminders":[{"id":31},{"id":19},{"id":31}]}')], "feed_pos int, raw string")
    assert payloads.discover_default_ids(alerts, rem) == (64, [31, 19])
    labels = spark.createDataFrame([(0, '[{"reminderLabelId":5},{"id":6}]')], "feed_pos int, raw string")
    assert payloads.discover_default_ids(alerts.limit(0), labels) == (None, [5])


def test_feeds(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"accounts": [], "data": [{"id": "x"}], "metadata": {"after": null}}')
    (tmp_path / "p2.json").write_text('[{"id": "a", "pimsCode": "1"}, {"id": 7}]')
    (tmp_path / "p3.json").write_text('{"accounts": "odd", "items": [{"id": "b"}]}')
    got = feeds.flatten_pages(feeds.read_pages(spark, str(tmp_path), "accounts"), "accounts").orderBy("page_no", "pos").collect()
    assert [(r.pos, r.id) for r in got] == [(0, "a"), (1, "7"), (0, "b")]
    listed = spark.createDataFrame([(1, "l"), (2, "l"), (None, "l")], "id int, name string")
    detail = spark.createDataFrame([(1, "d", "e")], "id int, name string, extra string")
    assert sorted((str(r.id), r.name, r.extra) for r in feeds.hydrate(listed, detail).collect()) == [("1", "d", "e"), ("2", "l", None), ("None", "l", None)]
    ids = spark.range(300)
    assert [r.id for r in feeds.page_after(ids, "id", 250, 500).collect()] == list(range(251, 300)) and feeds.page_before(ids, "id", 250, 3).first().id == 247
    feeds.write_json(listed.withColumn("feed", F.lit("x")), str(tmp_path / "out"), "feed")
    assert '"id":null' in "".join(p.read_text() for p in (tmp_path / "out" / "feed=x").glob("*.json"))


APP = "id long, appointmentTypeId long, patientId long, startsAt string, updatedAt string, canceledAt string, status string, isConfirmed boolean"


def appointments(spark):
    return spark.createDataFrame([(1, 10, 5, "s", "2024-01-02T00:00:00", None, "canceled", None), (2, None, 0, "", "2024-01-03T00:00:00", "x", None, True), (3, 99, 5, "s", None, "", "Canceled", False)], APP)


def test_appointments(spark):
    got = {r.appointment_id: r for r in normalize.normalize_appointments(appointments(spark)).collect()}
    assert [got[k].is_canceled for k in "123"] == [True, True, False] and got["2"].patient_id is None and got["2"].starts_at is None and got["2"].appointment_type_id is None
    types = spark.createDataFrame([(10, "Exam")], "id long, name string")
    rich = {r.appointment_id: r.appointment_type for r in normalize.enrich_types(normalize.normalize_appointments(appointments(spark)), types).collect()}
    assert rich["1"].name == "Exam" and rich["2"] is None and rich["3"] is None


def test_sync(spark, tmp_path):
    rows = normalize.normalize_appointments(appointments(spark))
    out, state = sync.sync_batch(rows, "appointments", {}, max_records=0)
    assert out.count() == 1 and state == {"appointments": None}
    out, state = sync.sync_batch(rows, "appointments", {"appointments": "2024-01-03T00:00:00", "accounts": "q"}, advance=True)
    assert [r.source_id for r in out.collect()] == ["2"] and state == {"appointments": "2024-01-03T00:00:00", "accounts": "q"}
    keys = lambda mark: sorted(r.idempotency_key for r in sync.sync_batch(rows, "appointments", {}, mark)[0].collect())
    assert keys("2024") == keys("2024") and keys("2024") != keys("2023")
    record = sync.sync_batch(rows, "appointments", {})[0].orderBy("source_id").first()
    assert record.source_type == "appointment" and record.conflict_status == "needs_review" and record.payload.conflict_status == "needs_review"
    path = str(tmp_path / "state")
    assert sync.load_state(spark, path) == {}
    sync.save_state(spark, path, state)
    assert sync.load_state(spark, path) == state
    twice = sync.with_hashes(rows, "appointments").withColumn("updated_at", F.lit("9")).unionByName(sync.with_hashes(rows, "appointments"))
    assert {r.updated_at for r in sync.latest_per_id(twice, "appointment_id").collect()} == {"9"}


def test_stream_equals_batch_and_replays_add_nothing(spark, tmp_path):
    landed, sink = str(tmp_path / "landed"), str(tmp_path / "sink")
    rows = appointments(spark)
    rows.write.parquet(landed)
    rows.unionByName(rows).write.mode("append").parquet(landed)  # read again

    def go(state):
        stream.sync_stream(stream.read_landed(spark, landed, APP), normalize.normalize_appointments, "appointments", sink, str(tmp_path / state)).awaitTermination()
        return sorted((r.source_id, r.idempotency_key, r.payload.source_hash) for r in spark.read.parquet(sink).collect())

    batch = sync.sync_batch(normalize.normalize_appointments(rows), "appointments", {})[0]
    want = sorted((r.source_id, r.idempotency_key, r.payload.source_hash) for r in batch.collect())
    assert go("one") == want
    assert go("two") == want  # a lost state: everything comes again


def test_stream_takes_rows_that_land_late(spark, tmp_path):
    landed, sink = str(tmp_path / "landed"), str(tmp_path / "sink")
    for i, day in enumerate(["2024-06-01T00:00:00", "2024-06-02T00:00:00", "2023-01-01T00:00:00"]):  # the last a backfill
        spark.createDataFrame([(i + 1, 10, 5, "s", day, None, "booked", None)], APP).write.mode("append").parquet(landed)
        stream.sync_stream(stream.read_landed(spark, landed, APP), normalize.normalize_appointments, "appointments", sink, str(tmp_path / "state")).awaitTermination()
    assert sorted(r.source_id for r in spark.read.parquet(sink).collect()) == ["1", "2", "3"]


def test_stream_keeps_one_record_for_a_key(spark, tmp_path):
    landed, sink = str(tmp_path / "landed"), str(tmp_path / "sink")
    for runs in ([("s", "booked"), ("s", "booked")], [("later", "booked")], [("later", "canceled")]):
        spark.createDataFrame([(7, 10, 5, start, "2024-06-01", None, status, None) for start, status in runs], APP).write.mode("append").parquet(landed)
        stream.sync_stream(stream.read_landed(spark, landed, APP), normalize.normalize_appointments, "appointments", sink, str(tmp_path / "state")).awaitTermination()
        assert [r.payload.starts_at for r in spark.read.parquet(sink).collect()] == ["s"]


def test_inventory(spark):
    ddl = "name string, details string, frequency string, avg_use string, orders_count string, date_range string, total_cost string, amount string, status string"
    df = spark.createDataFrame([("a", 'x"y', "EOW", "1.25 / week", "30 orders", "2023-01-05 — 2025-06-07", "$1,002.50", "for 88 vial", "s"), ("a", None, "EOW", None, "1 order", "2023-01-05", "$-2.25", "for -4 vial", "s"), ("b", None, "EOW", "?", "many", "?", "?", None, "s")], ddl)
    got = [tuple(map(str, r)) for r in inventory.parse_inventory(df).drop("name", "details", "frequency", "status").collect()]
    assert got[0] == ("1.25", "week", "30", "2023-01-05", "2025-06-07", "1002.50", "88.00", "vial")
    assert got[1] == ("None", "None", "1", "2023-01-05", "2023-01-05", "-2.25", "-4.00", "vial") and set(got[2]) == {"None"}
    total = {r.quantity_unit: (r.n, r.orders, str(r.cost)) for r in inventory.inventory_rollup(inventory.parse_inventory(df)).collect()}
    assert total["vial"] == (2, 31, "1000.25")
