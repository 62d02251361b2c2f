from vetmill.operators.importing import import_sheets
from vetmill.operators.normalize import normalize_accounts
from vetmill.sources.feeds import SCHEMAS

SHEET = "file string, sheet string, row_number long, client string, client_name string, phone_no string, patient_name string, species string, breed string, code string, item_due string, due_date string"


def test_import(spark):
    head = lambda n, client, name, pet, label="Physical Exam": ("f", "s", n, client, name, None, pet, "dog", None, "C", label, "1/2/2024")
    more = lambda n, label: ("f", "s", n, None, None, None, None, None, None, "C", label, "3/4/2024")
    sheet = spark.createDataFrame([head(2, "77", "", "Rex"), more(3, "Inject - Solensia"), more(4, "no such label"), head(5, "77", "", "Rex"), head(6, "77", "", "Bo", "no such label"),
                                   head(7, "", "Doe,  Jo", "Mia"), head(8, "78", "", "Rex"), head(9, "77", "", "Twin"), ("f", "s", 10, "only", None, None, None, None, None, None, None, None)], SHEET)
    accounts = spark.createDataFrame([("a1", "77", None, ("Ann", None, "Lee", []), None, None), ("a2", "5", None, ("Jo", None, "Doe", []), None, None)], SCHEMAS["accounts"])
    accounts = normalize_accounts(accounts.selectExpr("*", "0L AS feed_pos"), "feed_pos")
    patients = spark.createDataFrame([("1", "REX", "a1"), ("2", "mia", "a2"), ("3", "Twin", "a1"), ("4", "twin", "a1")], "id string, name string, accountId string")
    out, broken = import_sheets(sheet, accounts, patients)
    got = {r.header_row: (r.status, r.patient_id, r.reminders and [x.mapped_label for x in r.reminders]) for r in out.collect()}
    assert got == {2: ("submitted", "1", ["Annual Exam", "Solensia Injection"]), 5: ("submitted", "1", ["Annual Exam"]), 6: ("skipped_no_valid_reminders", None, None),
                   7: ("submitted", "2", ["Annual Exam"]), 8: ("unresolved_account_not_found", None, None), 9: ("unresolved_ambiguous", None, None)}
    assert [r.row_number for r in broken.collect()] == [10]
    assert import_sheets(sheet, accounts, patients, most=2)[0].count() == 2 and import_sheets(sheet.limit(0), accounts, patients)[0].count() == 0
