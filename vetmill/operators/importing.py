"""The reminder import from sheet to submission: plans, their sources resolved once each, and what is submitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetmill.operators import reminders, resolve
from vetmill.sources.shared import kept

#: What a plan is resolved by: plans that agree in these are resolved once.
SOURCE = ("client", "client_name", "phone_no", "patient_name")


def import_sheets(rows: DataFrame, accounts: DataFrame, patients: DataFrame, mode: str = "strict", most: int | None = None,
                  giant: bool = False) -> tuple[DataFrame, DataFrame]:
    """One row for each plan - file, sheet, header_row, client, patient_name, n_valid, status, patient_id and reminders, the
    valid ones if they are submitted - and the sheet's broken rows.

    rows: a grouped sheet; accounts: normalized, with feed_pos; patients: as landed. most: only the first plans in sheet
    order. status: skipped_no_valid_reminders, submitted or unresolved_ with the reason. Only plans with valid
    reminders are resolved; each (client, client_name, phone_no, patient_name) among them once, whatever its number of
    plans, and the outcome goes back to them by a join whose hot keys the planner splits."""
    good, broken = reminders.group_sheet_rows(rows, giant=giant)
    plans = kept(reminders.first_plans(reminders.build_plans(reminders.classify_reminders(good)), most), "plans")
    key = F.sha2(F.to_json(F.struct(*SOURCE), {"ignoreNullFields": "false"}), 256)
    plans = plans.withColumns({"src_id": key, "n_valid": F.size("valid_reminders").cast("bigint")})
    sources = kept(plans.where("n_valid > 0").groupBy("src_id").agg(*[F.first(c).alias(c) for c in SOURCE]), "sources")
    found = resolve.resolve_patients(resolve.resolve_accounts(sources, kept(accounts, "accounts"), mode), patients)
    out = resolve.submission_table(plans, found)
    submitted = F.when(F.col("status") == "submitted", F.col("valid_reminders"))
    return out.select("file", "sheet", "header_row", "client", "patient_name", "n_valid", "status", "patient_id", submitted.alias("reminders")), broken
