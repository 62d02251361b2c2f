"""Accounts and appointments in fixed columns, contact rows, and changes to appointments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.functions.hashing import row_hash
from vetmill.functions.text import display_name, first_email, first_phone, norm_falsy, norm_or_null, norm_text, phone_digits

#: Name of the source system in exported rows; callers give their own.
SOURCE = "practice"

CONTACT_COLUMNS = [
    "source_system", "source_account_id", "clinic_id", "pims_code", "pims_id", "display_name", "first_name", "middle_name",
    "last_name", "primary_phone", "email", "is_active", "updated_at", "deleted_at",
]


def _fields(df: DataFrame, path: str) -> list[str]:
    kind = df.schema
    for name in path.split("."):
        kind = kind[name].dataType
    return kind.elementType.names


def normalize_accounts(accounts: DataFrame, *also: str) -> DataFrame:
    """Twelve columns: ids, names, digits of the phone, email, times and is_deleted; then those named in also, as they are."""
    details, fields = F.col("primaryContact.communicationDetails"), _fields(accounts, "primaryContact.communicationDetails")
    first, middle, last = (F.col(f"primaryContact.{n}") for n in ("nameFirst", "nameMiddle", "nameLast"))
    deleted = norm_or_null("deletedAt")
    return accounts.select(
        norm_text("id").alias("account_id"), norm_text("pimsCode").alias("pims_code"), norm_or_null("pimsId").alias("pims_id"),
        norm_text(first).alias("first_name"), norm_text(middle).alias("middle_name"), norm_text(last).alias("last_name"),
        F.coalesce(display_name(first, middle, last), F.lit("")).alias("display_name"),
        phone_digits(first_phone(details, fields)).alias("primary_phone"), first_email(details, fields).alias("email"),
        norm_or_null("updatedAt").alias("updated_at"), deleted.alias("deleted_at"), deleted.isNotNull().alias("is_deleted"), *also)


def normalize_appointments(appointments: DataFrame) -> DataFrame:
    """Seven columns; canceled by a time of cancellation or by the exact status."""
    ids = {n: F.nullif(norm_falsy(n), F.lit("")) for n in ("appointmentTypeId", "patientId")}
    canceled = F.coalesce(F.col("canceledAt") != "", F.lit(False)) | F.col("status").eqNullSafe("canceled")
    return appointments.select(
        norm_falsy("id").alias("appointment_id"), ids["appointmentTypeId"].alias("appointment_type_id"), ids["patientId"].alias("patient_id"),
        norm_or_null("startsAt").alias("starts_at"), norm_or_null("updatedAt").alias("updated_at"),
        canceled.alias("is_canceled"), F.col("isConfirmed").alias("is_confirmed"))


def project_contacts(accounts: DataFrame, clinic_id: str, source_system: str = SOURCE) -> DataFrame:
    """Normalized accounts as contact rows with a hash over the other fourteen columns."""
    rows = accounts.select(
        F.lit(source_system).alias("source_system"), F.col("account_id").alias("source_account_id"), F.lit(clinic_id).alias("clinic_id"),
        "pims_code", "pims_id", "display_name", "first_name", "middle_name", "last_name", "primary_phone", "email",
        (~F.col("is_deleted")).alias("is_active"), "updated_at", "deleted_at")
    return rows.withColumn("payload_hash", row_hash(rows, CONTACT_COLUMNS))


def enrich_types(appointments: DataFrame, types: DataFrame) -> DataFrame:
    """Normalized appointments with appointment_type, a struct of the type's row, or null.

    Small type tables are broadcast by the planner; a large one is joined by shuffle."""
    dim = types.select(F.col("id").cast("bigint").alias("_type"), F.struct(*types.columns).alias("appointment_type"))
    key = F.when(F.col("appointment_type_id").rlike("^[+-]?[0-9]+$"), F.col("appointment_type_id").try_cast("bigint"))
    return appointments.join(dim, key == F.col("_type"), "left").drop("_type")


def apply_appointment_changes(appointments: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Appointments with the latest change of each id (id, changed_at, isConfirmed, canceledAt, status;
    a null leaves a value as it is), and the changes whose id is unknown."""
    fields = ["isConfirmed", "canceledAt", "status"]
    latest = changes.groupBy("id").agg(F.max_by(F.struct(*fields), F.struct("changed_at", *fields)).alias("_new"))
    both = appointments.join(latest, "id", "left")
    new: dict[str, Column] = {c: F.coalesce(F.col("_new")[c], F.col(c)).alias(c) for c in fields}
    return both.select(*[new.get(c, F.col(c)) for c in appointments.columns]), changes.join(appointments.select("id").distinct(), "id", "left_anti")


def with_owner(patients: DataFrame, accounts: DataFrame) -> DataFrame:
    """Patients whose owner's contact is landed apart get it from the accounts' feed, by accountId; contacts that are
    embedded stay. Of an account's versions the newest by updatedAt counts; an unknown account leaves null."""
    newest = F.struct(F.coalesce("updatedAt", F.lit("")), F.to_json("primaryContact"))
    owners = accounts.where("id <> ''").groupBy(F.col("id").alias("accountId")).agg(F.max_by("primaryContact", newest).alias("_contact"))
    if "account" not in patients.columns:
        return patients.join(owners, "accountId", "left").withColumn("account", F.struct(F.col("_contact").alias("primaryContact"))).drop("_contact")
    apart = patients.where("account.primaryContact is null").drop("account").join(owners, "accountId", "left")
    apart = apart.withColumn("account", F.struct(F.col("_contact").alias("primaryContact"))).drop("_contact")
    return patients.where("account.primaryContact is not null").unionByName(apart.select(*patients.columns))
