"""Reminder counts and filters, the patient audit, and the profile of a patient list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.functions.text import blank, first_phone, norm_header, reminder_patient_id, strip, to_int
from vetmill.operators.normalize import _fields

#: Logical columns with the header names that stand for them, best first.
ALIASES: dict[str, tuple[str, ...]] = {
    "pms_id": ("pms id", "pims id", "pimsid", "pmsid", "patient pms id", "patient_pms_id", "patient id", "id", "external id", "external_id", "code"),
    "patient_name": ("patient", "patient name", "name", "pet name", "pet"),
    "owner_name": ("owner", "owner name", "client", "client name"),
    "owner_email": ("email", "owner email", "client email"),
    "owner_phone": ("phone", "owner phone", "client phone", "mobile"),
    "species": ("species",),
    "breed": ("breed", "breed name"),
    "sex": ("sex", "gender"),
}


def reminder_counts(reminders: DataFrame) -> DataFrame:
    """patient_id, n: reminders of each patient; those without a patient are left out first."""
    ids = reminders.select(reminder_patient_id(reminders.columns).alias("patient_id")).where("patient_id is not null")
    return ids.groupBy("patient_id").agg(F.count("*").alias("n"))


def patient_audit(patients: DataFrame, reminders: DataFrame, limit: int | None = None, order: str = "id") -> DataFrame:
    """Owner, phone and number of reminders of each patient; the number is null for all if no
    reminder anywhere has a patient, and for a patient without a whole-number id.

    limit: the first patients in the order of a column; None: all."""
    counts = reminder_counts(reminders)
    any_ = reminders.where(reminder_patient_id(reminders.columns).isNotNull()).limit(1).agg(F.count("*").alias("_any"))
    primary = F.col("account.primaryContact")
    fields = _fields(patients, "account.primaryContact.communicationDetails")
    parts = [F.nullif(strip(primary[n]), F.lit("")) for n in ("nameFirst", "nameMiddle", "nameLast")]
    if limit is not None:
        patients = patients.orderBy(order).limit(max(limit, 0))
    rows = patients.select(
        F.nullif(F.concat_ws(" ", *parts), F.lit("")).alias("client_name"), F.col("name").alias("patient_name"),
        first_phone(primary["communicationDetails"], fields).alias("phone_no"), F.col("id").alias("patient_id"),
        F.col("accountId").alias("account_id"), F.col("pimsCode").alias("pims_code"), to_int("id").alias("_id"))
    rows = rows.join(counts.withColumnRenamed("patient_id", "_id"), "_id", "left").crossJoin(F.broadcast(any_))  # one row
    n = F.when((F.col("_any") > 0) & F.col("_id").isNotNull(), F.coalesce("n", F.lit(0)))
    return rows.select("client_name", "patient_name", "phone_no", n.alias("reminder_count"), "patient_id", "account_id", "pims_code")


def _status(status: str | None) -> Column:
    if not status:
        return F.lit(True)
    tests = {"active": F.col("deactivatedAt").isNull(), "inactive": F.col("deactivatedAt").isNotNull(),
             "sent": F.col("sentAt").isNotNull(), "unsent": F.col("sentAt").isNull()}
    return tests.get(status, F.lit(False))


def filter_reminders(reminders: DataFrame, patient_id: int | None = None, status: str | None = None,
                     due_after: str | None = None, due_before: str | None = None, as_date: bool = False) -> DataFrame:
    """Reminders of a patient (None: of all) by status and due range, both ends in.

    Bounds compare as text, so a time on the last day is after a bound without one; as_date compares
    days. An unknown status matches nothing."""
    due = F.substring("dueAt", 1, 10) if as_date else F.col("dueAt")
    out = reminders.where(_status(status))
    if patient_id is not None:
        out = out.where(reminder_patient_id(reminders.columns) == patient_id)
    if due_after:
        out = out.where(due >= due_after)
    return out.where(due <= due_before) if due_before else out


def asked() -> Column:
    """Whether a reminder has the status and due time that a query (_status, _after, _before) asks for."""
    ok = (F.when(F.coalesce("_status", F.lit("")) == "", True).when(F.col("_status") == "active", F.col("deactivatedAt").isNull())
          .when(F.col("_status") == "inactive", F.col("deactivatedAt").isNotNull()).when(F.col("_status") == "sent", F.col("sentAt").isNotNull())
          .when(F.col("_status") == "unsent", F.col("sentAt").isNull()).otherwise(False))
    within = (F.coalesce(F.col("_after"), F.lit("")) == "") | F.coalesce(F.col("dueAt") >= F.col("_after"), F.lit(False))
    return ok & within & ((F.coalesce(F.col("_before"), F.lit("")) == "") | F.coalesce(F.col("dueAt") <= F.col("_before"), F.lit(False)))


def filter_reminders_bulk(reminders: DataFrame, queries: DataFrame) -> DataFrame:
    """Many queries (query_id, patient_id, status, due_after, due_before; nulls ask for all) at once:
    an equality join on the patient, the rest as its condition. intervals.filter_reminders_binned splits hot patients."""
    rows = reminders.withColumn("_pid", reminder_patient_id(reminders.columns)).where("_pid is not null")
    q = queries.select("query_id", F.col("patient_id").alias("_want"), F.col("status").alias("_status"), F.col("due_after").alias("_after"), F.col("due_before").alias("_before"))
    return rows.join(q, (F.col("_pid") == F.col("_want")) & asked()).select("query_id", *reminders.columns)


def locate_columns(names: list[str], aliases: dict[str, tuple[str, ...]] = ALIASES) -> dict[str, str]:
    """Logical name to header: the first alias there is; of headers that look alike the last."""
    have = {norm_header(n): n for n in names}
    return {k: have[a] for k, group in aliases.items() if (a := next((a for a in group if a in have), None))}


def duplicate_ids(rows: DataFrame, column: str) -> DataFrame:
    """value, n: identifiers that occur more than once, trimmed; blanks are left out first."""
    ids = rows.select(strip(F.col(f"`{column}`")).alias("value")).where("value <> ''")
    return ids.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")


def audit_patients(rows: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """One row: rows, the identifier's column, missing and duplicate identifiers, missing required
    fields (a column that is not there counts every row; of the owner's three the least), verdicts."""
    columns = locate_columns(rows.columns) if columns is None else columns
    missing = {k: F.count_if(blank(F.col(f"`{columns[k]}`"))) if k in columns else F.count("*") for k in ALIASES}
    one = rows.agg(F.count("*").alias("total_rows"), *[v.alias(f"_{k}") for k, v in missing.items()])
    key = columns.get("pms_id")
    twice = duplicate_ids(rows, key).agg(F.count("*").alias("duplicate_identifier_values")) if key else None
    one = one.crossJoin(F.broadcast(twice)) if twice is not None else one.withColumn("duplicate_identifier_values", F.lit(0).cast("bigint"))  # one row each
    required = {"owner": F.least("_owner_name", "_owner_email", "_owner_phone"), **{k: F.col(f"_{k}") for k in ("patient_name", "species", "breed", "sex")}}
    unique = F.lit(key is not None) & (F.col("_pms_id") == 0) & (F.col("duplicate_identifier_values") == 0)
    return one.select(
        "total_rows", F.lit(key).cast("string").alias("selected_identifier_column"), F.col("_pms_id").alias("missing_identifier_rows"),
        "duplicate_identifier_values", *[v.alias(f"missing_{k}") for k, v in required.items()],
        unique.alias("has_unique_identifier"), (sum(required.values(), F.lit(0)) == 0).alias("has_required_fields"))
